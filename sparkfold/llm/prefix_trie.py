"""Prefix trie of conversations by a splitter skeleton.

Every rebuilt conversation is a path: one 128-bit digest of (role, text) per turn.  Paths are cut into
ranges by splitters drawn from a sample, as a range-partitioned sort does; (path, conv_id) is the sort key, so
copies of one conversation spread over several shards.  A node with members in two shards is a prefix of
the splitter between them.  So the trie of all splitter paths, the skeleton, is broadcast, and

* every other node lies whole in one shard: a sweep over the sorted paths with a stack of the open nodes
  finishes it there;
* a skeleton node gets one partial aggregate of each shard that meets it; these are reduced by aggregation
  and rolled up along the skeleton.

Scale.  Turns move once, as digests with lengths; rebuilt conversations move once more, to their shard.  A
third of all conversations under one first turn, or equal as a whole, is a skeleton node with one partial row
a shard.  A conversation is one row of 20 bytes a turn.  The skeleton is at most ``SKELETON_BYTES`` (fewer splitters are
taken if they are long).  Conversation numbers that end at a skeleton node travel to their digest as chunks of
``CHUNK`` numbers; SHA-256 takes them one after the other.

Cases.  Null role or text: empty.  Null conv_id: no conversation, left out.  Null turn: first.  Equal turns: by
role, then by digest of the text.  Repeated rows are repeated turns.  Conversations that have no turn left are
members of the root.  Empty tables: no node.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import settled

DIGEST = 16
CHUNK = 4096
#: Upper bound of all splitter paths together.
SKELETON_BYTES = 16 << 20
OVERSAMPLE = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
FINISHED, UNDER_SKELETON, PARTIAL, ENDS = range(4)
SWEPT = ("kind int, skel int, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, chars long, ends string")
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


# --- conversations as paths -------------------------------------------------------------------------------------

def turn_rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (conversations.where(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).cast("long").alias("conv_id"),
                    F.struct(F.col(turn_col).alias("turn"), role.alias("role"), F.unhex(F.md5(text)).alias("of_text"),
                             F.length(text).alias("chars")).alias("t")))


def _ordered() -> Column:
    return F.sort_array(F.collect_list("t"))


def rebuild(conversations: DataFrame, block: int = 100, most: int = 6, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, chars): conversation c takes its first h = crc32(c) mod ``most`` turns from c - c mod ``block``."""
    rows = (turn_rows(conversations, conv_col, turn_col, role_col, text_col)
            .withColumn("base", F.col("conv_id") - F.col("conv_id") % F.lit(block)))
    heads = rows.where("conv_id = base").groupBy("base").agg(F.slice(_ordered(), 1, most - 1).alias("head"))
    own = rows.repartition("base").groupBy("base", "conv_id").agg(_ordered().alias("own"))       # one shuffle, shared with the join
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.slice("own", 1, 0)), F.slice("own", h + 1, F.size("own")))
    digest = F.transform("turns", lambda t: F.md5(F.concat(F.length(t["role"]).cast("string").cast("binary"), F.lit(":").cast("binary"),
                                                           t["role"].cast("binary"), t["of_text"])))
    return (own.join(heads, "base", "left").select("conv_id", turns.alias("turns"))
            .select("conv_id", F.unhex(F.array_join(digest, "")).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars")))


# --- splitters and skeleton -------------------------------------------------------------------------------------

def choose_splitters(paths: DataFrame, rows: int, shards: int) -> list[tuple[bytes, int]]:
    """Borders of ``shards`` ranges of about equal size, from about ``OVERSAMPLE`` rows a shard."""
    draw = F.pmod(F.xxhash64("conv_id"), F.lit(max(rows, 1)))
    sample = sorted((bytes(r.path), r.conv_id) for r in paths.where(draw < OVERSAMPLE * shards).select("path", "conv_id").collect())
    step = max(1, len(sample) // shards)
    while True:
        borders = sample[step::step]
        if sum(len(p) for p, _ in borders) <= SKELETON_BYTES:
            return borders
        step *= 2


def skeleton_of(borders: list[tuple[bytes, int]]) -> dict[tuple[int, bytes], int]:
    """(node, digest of the next turn) -> node; 0 is the root, and children have larger numbers."""
    below: dict[tuple[int, bytes], int] = {}
    for path, _ in borders:
        node = 0
        for at in range(0, len(path), DIGEST):
            node = below.setdefault((node, path[at:at + DIGEST]), len(below) + 1)
    return below


# --- sweep of one shard -----------------------------------------------------------------------------------------

class _Open:
    """A node on the stack of the sweep."""

    __slots__ = ("skel", "least", "convs", "children", "leaves", "saved", "chars", "ids", "digest", "waiting")

    def __init__(self, skel: int, chars: int):
        self.skel, self.chars = skel, chars
        self.least, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ids: list[int] = []
        self.digest = None                              # of the numbers seen so far, once there are many
        self.waiting: list[tuple] = []                  # finished children, which lack this node's smallest member

    def take(self, least: int, convs: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.convs += convs

    def hash_ids(self) -> None:
        if self.ids:
            numbers = ",".join(map(str, self.ids))
            if self.digest is None:
                self.digest = hashlib.sha256(numbers.encode())
            else:
                self.digest.update(f",{numbers}".encode())
            self.ids = []


class _Sweep:
    def __init__(self, below: dict[tuple[int, bytes], int]):
        self.below, self.stack, self.path, self.out = below, [], b"", []

    def end_here(self, conv_id: int) -> None:
        top = self.stack[-1]
        top.take(conv_id, 1)
        top.ids.append(conv_id)
        if len(top.ids) == CHUNK:
            if top.skel >= 0:
                self.send_ends(top)
            else:
                top.hash_ids()

    def send_ends(self, node: _Open) -> None:
        self.out.append((ENDS, node.skel, node.ids[0], None, None, None, None, None, None, None, ",".join(map(str, node.ids))))
        node.ids = []

    def close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.take(node.least, node.convs)
        if node.skel >= 0:
            if node.ids:
                self.send_ends(node)
            self.out.append((PARTIAL, node.skel, node.least, None, depth, node.convs, node.children, node.leaves, node.saved, node.chars, None))
            return
        saved, leaves = node.saved + (node.convs - 1) * node.chars, node.leaves or 1
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        self.out.extend((FINISHED, None, row[0], node.least, *row[1:]) for row in node.waiting)
        node.hash_ids()
        row = (node.least, depth, node.convs, node.children, leaves, saved, node.chars, node.digest.hexdigest() if node.digest else NO_ENDS)
        if above.skel >= 0:
            self.out.append((UNDER_SKELETON, above.skel, row[0], None, *row[1:]))
        else:
            above.waiting.append(row)

    def feed(self, path: bytes, chars: list[int], conv_id: int) -> None:
        if not self.stack:
            self.stack.append(_Open(0, 0))
        same = 0
        while path[same:same + DIGEST] == self.path[same:same + DIGEST] and same < min(len(path), len(self.path)):
            same += DIGEST
        while len(self.stack) - 1 > same // DIGEST:
            self.close()
        for at in range(same, len(path), DIGEST):
            skel = self.stack[-1].skel
            self.stack.append(_Open(self.below.get((skel, path[at:at + DIGEST]), -1) if skel >= 0 else -1, chars[at // DIGEST]))
        self.path = path
        self.end_here(conv_id)

    def finish(self) -> None:
        while self.stack:
            self.close()
        self.path = b""


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 8192):
        columns = list(zip(*rows[at:at + 8192]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def sweep_shards(below: dict[tuple[int, bytes], int]):
    """Batches of (shard, path, conv_id, chars), sorted, -> rows of ``SWEPT``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
        schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in SWEPT.split(", ")])
        work, shard = _Sweep(below), None
        for batch in batches:
            for s, path, conv_id, chars in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if s != shard:
                    work.finish()
                    shard = s
                work.feed(path, chars, conv_id)
                if len(work.out) >= 8192:
                    yield from _batches(work.out, schema)
                    work.out = []
        work.finish()
        yield from _batches(work.out, schema)
    return run


def deal(borders: list[tuple[bytes, int]]):
    """Batches of (path, conv_id, chars) -> with the number of the shard in front."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([bisect_right(borders, k) for k in keys], pa.int32()), *batch.columns],
                                             ["shard", *batch.schema.names])
    return run


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (skel, first number, numbers), sorted, -> (skel, digest)."""
    at, whole = None, None
    for batch in batches:
        done = []
        for skel, numbers in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if skel != at:
                if whole is not None:
                    done.append((at, whole.hexdigest()))
                at, whole = skel, hashlib.sha256(numbers.encode())
            else:
                whole.update(f",{numbers}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done])], ["skel", "sha"])
    if whole is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([whole.hexdigest()])], ["skel", "sha"])


# --- the trie ---------------------------------------------------------------------------------------------------

def roll_up(partials: list, below: dict[tuple[int, bytes], int]) -> list[tuple]:
    """(skel, node columns without the digest) of the skeleton nodes, from their reduced partials."""
    parent = {child: above for (above, _), child in below.items()}
    node = {p.skel: [p.n_children, p.n_leaves, p.saved_tokens + (p.n_convs - 1) * p.chars] for p in partials}
    least = {p.skel: p.conv_id for p in partials}
    for k in sorted(node, reverse=True):                # children first
        node[k][1] = node[k][1] or 1
        if k:
            up = node[parent[k]]
            up[0], up[1], up[2] = up[0] + 1, up[1] + node[k][1], up[2] + node[k][2]
    return [(p.skel, p.conv_id, p.depth, least[parent[p.skel]] if p.skel else None, p.n_convs, *node[p.skel]) for p in partials]


def build_trie(paths: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``paths`` (conv_id, path, chars), conv_id distinct; see ``NODE``."""
    spark = paths.sparkSession
    paths = settled(paths.select("path", "conv_id", "chars"), "trie-paths")
    rows = paths.count()
    shards = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 8))
    borders = choose_splitters(paths, rows, shards)
    below = skeleton_of(borders)
    swept = settled(paths.mapInArrow(deal(borders), "shard int, path binary, conv_id long, chars array<int>")
                    .repartitionById(len(borders) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
                    .mapInArrow(sweep_shards(below), SWEPT), "trie-swept")
    partials = (swept.where(F.col("kind") == PARTIAL).groupBy("skel")
                .agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("chars").alias("chars"),
                     *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]).collect())  # one row a skeleton node
    skeleton = spark.createDataFrame(roll_up(partials, below), "skel int, " + NODE.removesuffix(", ends_sha256 string"))
    digests = (swept.where(F.col("kind") == ENDS).select("skel", F.col("conv_id").alias("first"), "ends")
               .repartition("skel").sortWithinPartitions("skel", "first").mapInArrow(hash_ends, "skel int, sha string"))
    own = F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256")
    top = skeleton.join(digests, "skel", "left").select(*NODE_COLUMNS[:-1], own)
    finished = swept.withColumnRenamed("ends", "ends_sha256")
    under = (finished.where(F.col("kind") == UNDER_SKELETON).drop("parent_conv_id")
             .join(F.broadcast(skeleton.select("skel", F.col("conv_id").alias("parent_conv_id"))), "skel"))
    return (finished.where(F.col("kind") == FINISHED).select(NODE_COLUMNS).unionByName(under.select(NODE_COLUMNS))
            .unionByName(top.select(NODE_COLUMNS)))


def conversation_trie(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return build_trie(rebuild(conversations, block, most))
