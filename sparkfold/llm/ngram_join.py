"""N-gram Jaccard join with a token-group matrix.

Two documents link when the Jaccard similarity of their sets of word n-grams
("tokens") is at least ``num / den``; the result is every document's component.

1. One pass gives each document's set size, a 128-bit digest of its set, four
   min-hash keys, and a small sketch of token frequencies.  Equal sets are one
   representative.
2. *Groups*: representatives that share a min-hash key meet in blocks of at most
   ``BLOCK``, where connected ones follow their smallest, the leader.  Rounds, one
   for each key, only leaders going on, turn families of any size into few
   connected sets; each is cut into groups of at most ``BLOCK`` members.
3. *Token-group matrix*: a document's rarest tokens (see below) are its
   signature.  Sorted by token, they form the matrix's rows: which groups hold
   a token in some member's signature.  A query document and a group of another
   connected set are counted together once for each signature token they share.
4. *Bound*: a document of n tokens that links with a member of a group must
   share at least ``need(0.75 n)`` signature tokens with the group's union.  Only
   groups that reach it are *opened*: the query is compared with their members,
   exactly, until one links.  Sets found to be linked are one component.

Signatures.  Tokens are ordered by (frequency class, hash); frequent ones come
last.  If x and y link, they share at least a = 3/7 (|x| + |y|) tokens for 0.75,
so their first ``l`` common tokens stand among the first |x| - a + l of x and
the first |y| - a + l of y (``reach``); l = need of the smaller makes the bound
strong.  A signature is as long as the farthest reach, that for the smallest
set that can link; a token counts for a pair within the pair's own reach only.
No link is lost, in any order.

Scale: what moves for all documents is their keys and signatures (about a
third of the tokens, 8 bytes each); texts move only for documents in a block
or an opened group.  A token of a third of all documents stands out in the sketch
and is dealt into parts before the first shuffle; runs of equal tokens are read
batch by batch.  A token shared by many groups is cut into chunks whose
pairs are separate pieces of work; a family of near copies is compared with
its leaders, not pair by pair.

Cases.  Null text, no words: empty set, a component of its own.  Fewer than
``n`` words: the whole sequence is the one token.  Rows repeated with one id
are one document (if the texts differ, the one with the smallest digest), and
each gets its result.  A null id: size 0, no component.  Empty tables give
empty results.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, settled
from sparkfold.llm.components import connected
from sparkfold.llm.textbytes import SPACE, column_bytes, mix, range_hashes, run_starts, slices, sorted_runs, words

KEYS = 4
BLOCK = 256
NEED = 12                       # a signature is longer by a twelfth of the set, and the bound as much stronger
TILE = 2048
MOSTLY, HOT_CLASS = 64, 11      # buckets that are mostly excess are dealt into parts of some 2^11 rows
SKETCH_BITS = 16
SKETCH_PARTS = 16
_SEED = np.random.default_rng(99).integers(1, 1 << 62, KEYS + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NOT_SPACE = ~SPACE


# --- sets -------------------------------------------------------------------------------------------------------

def token_sets(buf: np.ndarray, borders: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct tokens of every row."""
    start, end, row = words(buf, borders, NOT_SPACE)
    h = range_hashes(buf, start, end)
    rows = len(borders) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    grams = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        grams = mix(grams + h[k:len(h) - n + 1 + k] + np.uint64(k + 1)) if len(grams) else grams
    out = []
    for r in range(rows):
        a, b = first[r], first[r + 1]
        if b - a >= n:
            t = np.sort(grams[a:b - n + 1])
            out.append(t[np.concatenate([[True], t[1:] != t[:-1]])])
        elif b > a:
            short = np.array([b - a], np.uint64)         # the whole sequence, apart from n-grams
            for w in h[a:b]:
                short = mix(short * _SEED[0] + w)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """Two 63-bit sums over a set, whatever its order."""
    return tuple(int(mix(tokens ^ _SEED[KEYS + k]).sum(dtype=np.uint64) >> np.uint64(1)) for k in (0, 1))


def need(n):
    """Signature tokens that a linked pair shares at least, by the size of the smaller set."""
    return 1 + n // NEED


def common(x, y, num: int, den: int):
    """Tokens that linked sets of these sizes share at least."""
    return -(-num * (x + y) // (num + den))


def reach(x, y, num: int, den: int):
    """How far into a set of size x its first ``need`` tokens shared with a linked set of size y can stand."""
    return x - common(x, y, num, den) + need(np.minimum(x, y))


def signature_length(n: int, num: int, den: int) -> int:
    """The farthest reach into a set of size n: that for the smallest set it can link with, or its own need."""
    return min(n, n - -(-num * n // den) + need(n))


def similar(a: int, b: int, both: int, num: int, den: int) -> bool:
    return den * both >= num * (a + b - both)


def _each_text(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(id, tokens) for (id, text) batches."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        buf, borders = column_bytes(batch.column(1))
        for a, b in slices(borders):
            for k, tokens in enumerate(token_sets(buf[borders[a]:borders[b]], borders[a:b + 1] - borders[a], n)):
                yield int(ids[a + k]), tokens


def describe(n: int):
    """Batches of (doc, text) -> a row for each document; at the end of a task, its frequency sketch in parts."""
    fields = ["doc", "n", "d1", "d2", *[f"k{i}" for i in range(KEYS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        rows: list[list] = [[] for _ in fields]

        def flush() -> pa.RecordBatch:
            size = len(rows[0])
            batch = pa.RecordBatch.from_arrays(
                [*[pa.array(r, pa.int64()) for r in rows], pa.nulls(size, pa.int32()), pa.nulls(size, pa.list_(pa.int64()))],
                [*fields, "part", "counts"])
            for r in rows:
                r.clear()
            return batch
        for doc, tokens in _each_text(batches, n):
            keys = [0] * KEYS
            d = (0, 0)
            if len(tokens):
                np.add.at(counts, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                keys = [int(mix(tokens ^ s).min() >> np.uint64(1)) for s in _SEED[:KEYS]]
                d = digest(tokens)
            for r, v in zip(rows, (doc, len(tokens), *d, *keys)):
                r.append(v)
            if len(rows[0]) >= 4096:
                yield flush()
        yield flush()
        if counts.any():
            parts = counts.reshape(SKETCH_PARTS, -1)
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(SKETCH_PARTS, pa.int64()) for _ in fields], pa.array(range(SKETCH_PARTS), pa.int32()),
                 pa.array(list(parts), pa.list_(pa.int64()))], [*fields, "part", "counts"])
    return run, ", ".join(f"{f} long" for f in fields) + ", part int, counts array<long>"


def frequency_classes(described: DataFrame) -> np.ndarray:
    """A class for each of the sketch's buckets: 0, or the size of its excess over chance as a power of two, and ``MOSTLY`` more
    if the excess is most of the bucket."""
    total = (described.where("part IS NOT NULL").select("part", F.posexplode("counts").alias("at", "c"))
             .groupBy("part", "at").agg(F.sum("c").alias("c")).collect())            # 2^16 rows at any input size
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS))
    for part, at, c in total:
        counts[part, at] = c
    usual = np.median(counts)
    excess = counts.ravel() - usual - 8 * np.sqrt(usual + 1)
    level = np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1)), 0).astype(np.int8)
    return np.where(excess > usual, level + MOSTLY, level).astype(np.int8)


def spread_of(classes: np.ndarray) -> np.ndarray:
    """Into how many parts a bucket's tokens are dealt: 1, or for buckets that are mostly excess as many as keep a part small."""
    return 2 ** np.clip(classes.astype(np.int64) - MOSTLY - HOT_CLASS, 0, 20)


# --- groups -----------------------------------------------------------------------------------------------------

def linked_rows(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """For every set of a block the number of the first one it is connected with (itself if none)."""
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    posting, first = owner[order], np.searchsorted(place[order], np.arange(len(tokens) + 1))
    label = np.arange(len(sets))
    for k, own in enumerate(np.split(place, np.cumsum(size)[:-1])):
        count = first[own + 1] - first[own]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[own], count)
        both = np.bincount(posting[at], minlength=len(sets))
        near = np.flatnonzero((both > 0) & (den * both >= num * (size[k] + size - both)))
        label[np.isin(label, label[near])] = label[near].min() if len(near) else label[k]
    return label


def join_leaders(n: int, num: int, den: int):
    """Sorted batches of (k1, k2, doc, d1, text) -> (doc, leader): the smallest document of its block that it is connected with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, ["k1", "k2"], 512):
            ids, marks = group["doc"].to_numpy(), group["d1"].to_numpy()
            buf, borders = column_bytes(group["text"].combine_chunks())
            docs, heads = [], []
            starts = run_starts(group, ["k1", "k2"])
            for s, e in zip(starts, np.append(starts[1:], len(ids))):
                sets = token_sets(buf[borders[s]:borders[e]], borders[s:e + 1] - borders[s], n)
                own = [k for k in np.argsort(ids[s:e], kind="stable") if digest(sets[k])[0] == marks[s + k]]   # else another text with this id
                if len(own) < 2:
                    continue
                label = linked_rows([sets[k] for k in own], num, den)
                names = ids[s:e][own]
                led = names != names[label]
                docs.append(names[led]), heads.append(names[label][led])
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(heads))], ["doc", "leader"])
    return run


def connected_sets(reps: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc, d1, n, comp): every representative with the leader it ended at."""
    label = reps.select("doc", "d1", "n", F.col("doc").alias("comp"))
    left = reps
    for k in range(KEYS):
        key = F.col(f"k{k}")
        sizes = left.groupBy(key.alias("k1")).agg(F.count("*").alias("size")).where("size > 1")
        blocks = settled(left.select(key.alias("k1"), "doc", "d1").join(sizes, "k1")
                         .select("k1", F.pmod(F.xxhash64("doc", F.lit(k)), F.ceil(F.col("size") / BLOCK)).alias("k2"), "doc", "d1"), "tgm-blocks")
        rows = texts.join(bounded_broadcast(blocks), "doc")
        led = settled(rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2").select("k1", "k2", "doc", "d1", "text")
                      .mapInArrow(join_leaders(n, num, den), "doc long, leader long").dropDuplicates(["doc"]), "tgm-led")
        left = left.join(led.select("doc"), "doc", "left_anti")
        label = settled(label.join(led.select(F.col("doc").alias("comp"), "leader"), "comp", "left")
                        .select("doc", "d1", "n", F.coalesce("leader", "comp").alias("comp")), "tgm-label")
        left = settled(left, "tgm-left")
    return label


# --- token-group matrix -----------------------------------------------------------------------------------------

def signatures(n: int, num: int, den: int, classes):
    """Batches of (doc, text) -> (token, doc, n, rank, salt): the document's first tokens.

    ``salt``: 0, or for tokens of very full sketch buckets (``spread_of``) the part of its documents that this one is in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        spread = spread_of(table)
        held: list[tuple] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate([h[i] for h in held])) for i in range(5)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["token", "doc", "n", "rank", "salt"])
        for doc, tokens in _each_text(batches, n):
            if not len(tokens):
                continue
            level = table[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            if level.any():
                tokens = tokens[np.argsort(level, kind="stable")]
            first = signature_length(len(tokens), num, den)
            own = spread[(tokens[:first] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            salt = np.where(own > 1, 1 + int(mix(np.array([doc], np.int64).view(np.uint64))[0] >> np.uint64(1)) % np.maximum(own, 1), 0)
            held.append((tokens[:first].view(np.int64), np.full(first, doc, np.int64), np.full(first, len(tokens), np.int32),
                         np.arange(first, dtype=np.int32), salt.astype(np.int32)))
            rows += first
            if rows >= 1 << 17:
                yield flush()
                rows = 0
        if held:
            yield flush()
    return run


def shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches sorted by token, the rows whose token stands in more than one row, and those of spread tokens.

    A row is compared with its neighbours; only the last one of a batch waits, so a run of any length is read batch by batch."""
    held, seen = None, False                            # the waiting row, and whether its token stood in the row before it
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        token, salt = table["token"].to_numpy(), table["salt"].to_numpy()
        same = token[1:] == token[:-1]
        keep = (salt > 0) | np.append(seen, same) | np.append(same, False)
        held, seen = table.slice(table.num_rows - 1).combine_chunks().to_batches()[0], bool(keep[-1])
        yield from table.slice(0, table.num_rows - 1).filter(pa.array(keep[:-1])).drop_columns(["salt"]).combine_chunks().to_batches()
    if held is not None and seen:
        yield held.drop_columns(["salt"])


def candidates(num: int, den: int):
    """Sorted batches of matrix rows -> (doc, gid): a query and a group of another set that share a token."""
    keys = ["token", "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, keys, 1 << 16):
            starts = run_starts(group, keys)
            doc, gid, comp = (group[c].to_numpy() for c in ("doc", "gid", "comp"))
            size, rank, side = (group[c].to_numpy().astype(np.int64) for c in ("n", "rank", "side"))
            out_doc, out_gid = [], []
            for s, e in zip(starts, np.append(starts[1:], group.num_rows)):
                c = comp[s:e]
                if e - s < 2 or (c == c[0]).all():
                    continue
                m, k, at = size[s:e], rank[s:e], side[s:e]
                x, y = m[:, None], m[None, :]
                fits = (c[:, None] < c[None, :]) & (den * x >= num * y) & (den * y >= num * x)
                fits &= (k[:, None] < reach(x, y, num, den)) & (k[None, :] < reach(y, x, num, den))
                if at.any() and not at.all():
                    fits &= at[:, None] != at[None, :]
                i, j = np.nonzero(fits)
                if len(i):
                    _, one = np.unique(np.stack([i, gid[s:e][j]]), axis=1, return_index=True)
                    out_doc.append(doc[s:e][i[one]]), out_gid.append(gid[s:e][j[one]])
            if out_doc:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_doc)), pa.array(np.concatenate(out_gid))], ["doc", "gid"])
    return run


def open_groups(n: int, num: int, den: int):
    """Sorted batches of (k1, k2, role, comp, d1, text) -> (a, b): connected sets of which two members link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, ["k1", "k2"], 512):
            starts = run_starts(group, ["k1", "k2"])
            role, comp, marks = (group[c].to_numpy() for c in ("role", "comp", "d1"))
            buf, borders = column_bytes(group["text"].combine_chunks())
            a, b = [], []
            for s, e in zip(starts, np.append(starts[1:], len(role))):
                sets = token_sets(buf[borders[s]:borders[e]], borders[s:e + 1] - borders[s], n)
                right = np.array([digest(x)[0] for x in sets]) == marks[s:e]       # else another text with this id
                members = np.flatnonzero((role[s:e] == 0) & right)
                if not len(members):
                    continue
                union = np.unique(np.concatenate([sets[k] for k in members]))
                held = []
                for k in members:
                    mask = np.zeros(len(union) + 1, bool)
                    mask[np.searchsorted(union, sets[k])] = True
                    held.append(mask)
                done = set()
                for k in np.flatnonzero((role[s:e] == 1) & right):
                    size, query = len(sets[k]), int(comp[s + k])
                    if query in done:
                        continue
                    place = np.searchsorted(union, sets[k])
                    place[(place >= len(union)) | (union[np.minimum(place, len(union) - 1)] != sets[k])] = len(union)
                    if den * int((place < len(union)).sum()) < num * size:
                        continue                          # less than three quarters of it stand anywhere in the group
                    for m, mask in zip(members, held):
                        other = len(sets[m])
                        if den * min(size, other) >= num * max(size, other) and similar(size, other, int(mask[place].sum()), num, den):
                            a.append(query), b.append(int(comp[s + m]))
                            done.add(query)
                            break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    run, schema = describe(n)
    described = settled(texts.mapInArrow(run, schema), "tgm-described")
    classes = spark.sparkContext.broadcast(frequency_classes(described))             # 64 KB at any input size
    keys = [f"k{i}" for i in range(KEYS)]
    whole = (described.where("part IS NULL").groupBy("doc").agg(F.min(F.struct("d1", "d2", "n", *keys)).alias("s")).select("doc", "s.*"))
    whole = settled(whole, "tgm-docs")
    same = ["d1", "d2", "n"]
    reps = settled(whole.where("n > 0").groupBy(*same).agg(F.min(F.struct("doc", *keys)).alias("r")).select("n", "d1", "r.*"), "tgm-reps")
    label = connected_sets(reps, texts, n, num, den)
    sizes = label.groupBy("comp").agg(F.count("*").alias("size"))
    groups = settled(label.join(sizes, "comp").select(
        "doc", "d1", "comp", F.xxhash64("comp", F.pmod(F.xxhash64("doc"), F.ceil(F.col("size") / BLOCK))).alias("gid")), "tgm-groups")
    tokens = texts.mapInArrow(signatures(n, num, den, classes), "token long, doc long, n int, rank int, salt int")
    shared = settled(tokens.repartition("token", "salt").sortWithinPartitions("token", "salt")
                     .mapInArrow(shared_rows, "token long, doc long, n int, rank int"), "tgm-shared")
    matrix = settled(shared.join(groups.drop("d1"), "doc").distinct(), "tgm-matrix")
    spread = matrix.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows"))
    spread = spread.where("lo < hi").select("token", F.ceil(F.col("rows") / TILE).cast("int").alias("chunks"))
    own, other = F.col("own"), F.col("other")
    pieces = (matrix.join(spread, "token").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("token", (F.least(own, other) * F.col("chunks").cast("long") + F.greatest(own, other)).alias("piece"),
                      (own > other).cast("int").alias("side"), "doc", "gid", "comp", "n", "rank"))
    met = pieces.repartition("token", "piece").sortWithinPartitions("token", "piece").mapInArrow(candidates(num, den), "doc long, gid long")
    queries = (met.groupBy("doc", "gid").agg(F.count("*").alias("overlap")).join(label.select("doc", "n"), "doc")
               .where(F.col("overlap") >= 1 + F.floor(F.ceil(F.lit(num) * F.col("n") / F.lit(den)) / NEED)).select("doc", "gid"))
    queries = settled(queries, "tgm-queries")
    load = queries.groupBy("gid").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    members = (groups.join(load, "gid").withColumn("k2", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .select(F.col("gid").alias("k1"), "k2", F.lit(0).alias("role"), "doc", "comp", "d1"))
    asked = (queries.join(load, "gid").join(groups.select("doc", "comp", "d1"), "doc")
             .select(F.col("gid").alias("k1"), F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int").alias("k2"), F.lit(1).alias("role"), "doc", "comp", "d1"))
    work = settled(members.unionByName(asked), "tgm-work")
    opened = (texts.join(bounded_broadcast(work), "doc").repartition("k1", "k2").sortWithinPartitions("k1", "k2")
              .select("k1", "k2", "role", "comp", "d1", "text").mapInArrow(open_groups(n, num, den), "a long, b long"))
    joined = connected(opened)
    final = settled(label.join(joined, F.col("comp") == F.col("node"), "left").select("doc", F.coalesce("component", "comp").alias("root")), "tgm-final")
    least = final.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_rep = final.join(least, "root").select(F.col("doc").alias("rep"), "component_id")
    of_class = whole.where("n > 0").groupBy(*same).agg(F.min("doc").alias("rep")).join(of_rep, "rep")
    of_doc = (whole.join(of_class, same, "left")
              .select(F.col("doc").alias("_doc"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id")))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id")).join(of_doc, F.col("doc_id") == F.col("_doc"), "left")
            .select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), "component_id"))
