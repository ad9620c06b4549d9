"""Removal of byte spans that repeat an earlier string of 100 bytes, by bucket-pointer refinement.

A window is a string of ``LENGTH`` bytes of a document; it is removed if an equal window starts earlier (smaller document, or
same document and smaller offset).  As in bucket-pointer refinement of suffix arrays, positions start in buckets of equal
q-grams, and a bucket is refined by the bucket identifiers at later offsets, where identifiers found once are
used again: the identifier of 16 bytes is made of those of 8 bytes at offsets 0 and 8, that of 32 of those at 0 and 16, that
of 64 of those at 0 and 32, that of 100 of those at 0 and 36.  Identifiers are 64-bit names that every task computes alike,
so buckets need no numbering; two independent ones are compared, 128 bits in all.  Buckets with one member are final and leave.

To sort few rows rather than all positions, pointers are kept at anchors: every window holds as its anchor the q-gram (32
bytes) with the least identifier in it, leftmost if tied.  Equal windows have equal anchors at equal places.  An anchor owns
a run of neighbouring windows (some 35), and the rounds are

1. anchors in buckets of their q-gram, refined by the identifiers at the first and last window they own.  Members of one
   refined bucket own equal windows: all but the earliest are removed.  What stays alone with its q-gram is final.
2. the windows of the remaining anchors, by eights, in buckets of the identifier of the 93 bytes they share.  What stays alone is final.
3. the windows of the remaining eights, refined by the bytes left and right of the shared ones.  All but the earliest are removed.

Skew.  A task compares the rows of some MiB of text with each other before the shuffle, and sends one row for equal ones:
a passage in a third of all documents is one row for that much text.  An identifier met with different surroundings sends one row
to its bucket, and the others, known not to be alone, to the next round.  No bucket is collected: ranks
come from sorted windows, which spill.

Scale.  Round 1 shuffles about 3 rows of some 27 bytes for 100 bytes of text.  The lists of open and of removed spans are sent to the texts
while they are measured to be small; beyond that, texts move once for round 2 and once for the result.

Cases.  Null text: empty.  Null id: smaller than all others.  Rows with one id and different texts are
documents ordered by a hash of the text; equal rows are one document and have equal results.  Texts under 100 bytes: nothing
is removed.  Empty tables: empty result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, settled
from sparkfold.llm.textbytes import column_bytes, mix, slices

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM + 1                       # q-grams in a window
#: Bytes that are named at once, and bytes whose rows are compared before the shuffle.
PIECE, COMPARED = 1 << 18, 8 << 20
PLACE = np.uint64((1 << 20) - 1)                # low bits of a key: place in the piece
EIGHT = 8                                       # windows that round 2 takes together
SHARED = LENGTH - EIGHT + 1
ALONE, FRONT, KNOWN, REMOVED = range(4)         # states of a row, in its two low bits
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# --- identifiers ------------------------------------------------------------------------------------------------

def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of a string from those of two strings that cover it."""
    h = a * _C1
    h ^= h >> np.uint64(32)
    h += b * _C2
    h ^= h >> np.uint64(29)
    h *= _C1
    h ^= h >> np.uint64(32)
    return h


def gram_names(buf: np.ndarray) -> np.ndarray:
    """Identifier of the 32 bytes at every position (the last ones run over the end and mean nothing)."""
    n = len(buf)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = buf
    name = np.empty(n + 8, np.uint64)
    for s in range(8):
        part = name[s::8]
        part[:] = np.frombuffer(padded, "<u8", len(part), s)
    name = paired(name[:-8], name[8:])
    tail = np.zeros(16, np.uint64)
    return paired(name, np.concatenate([name, tail])[16:16 + n])


def shared_names(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifier of the 93 bytes at the positions ``at``."""
    half = paired(grams[at], grams[at + 32])
    return paired(half, paired(grams[at + 29], grams[at + SHARED - GRAM]))


def window_names(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifier of the 100 bytes at the positions ``at``."""
    half = paired(grams[at], grams[at + 32])
    return paired(half, paired(grams[at + 36], grams[at + 68]))


def anchor_runs(grams: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last) position of each run of ``valid`` windows that share their anchor."""
    n = len(grams) - REACH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < REACH:
        least = np.minimum(least[:n], least[REACH - span:REACH - span + n])
    anchor = (least[:n] & PLACE).astype(np.int64)
    ok = valid[:n]
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1])
    stop = ok.copy()
    stop[:-1] &= ~ok[1:] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    return anchor[first], first, np.flatnonzero(stop)


def pieces(borders: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, from byte, to byte): rows together, or a part of a long one with its neighbour's first bytes."""
    for a, b in slices(borders, PIECE):
        lo, hi = int(borders[a]), int(borders[b])
        for at in range(lo, max(hi - LENGTH, lo) + 1, PIECE) if b == a + 1 else (lo,):
            yield a, b, at, min(hi, at + PIECE + LENGTH - 1) if b == a + 1 else hi


def valid_windows(borders: np.ndarray, a: int, b: int, lo: int, hi: int) -> np.ndarray:
    """Which positions of [lo, hi) start a window inside one of the rows a..b."""
    delta = np.zeros(hi - lo + 1, np.int32)
    start = np.clip(borders[a:b], lo, hi) - lo
    stop = np.clip(np.maximum(borders[a:b], np.minimum(borders[a + 1:b + 1], hi) - LENGTH + 1), lo, hi) - lo
    np.add.at(delta, start, 1)
    np.add.at(delta, stop, -1)
    return np.cumsum(delta[:-1]) > 0


def document_order(ids: pa.Array, digest: np.ndarray) -> np.ndarray:
    """Rank of every row by (null id first, id, digest); equal rows have equal ranks."""
    null = np.asarray(ids.is_null())
    number = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((digest, number, ~null))
    new = np.ones(len(order), bool)
    new[1:] = (digest[order][1:] != digest[order][:-1]) | (number[order][1:] != number[order][:-1]) | (null[order][1:] != null[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


# --- rounds, before the shuffle ---------------------------------------------------------------------------------

def earliest(one: np.ndarray, two: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by both identifiers and place: (order, earliest of its bucket, later than the earliest).

    A row at the very place of the earliest (a document that stands there twice) is neither."""
    order = np.lexsort((place, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    place = place[order]
    return order, new, place != place[np.flatnonzero(new)][np.cumsum(new) - 1]


def merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray, gap: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts, those at most ``gap`` apart joined."""
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    upto = np.maximum.accumulate((row << 32) + hi) - (row << 32)         # rows ascend, so none sees an earlier one's end
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (lo[1:] > upto[:-1] + gap)
    start = np.flatnonzero(new)
    return row[start], lo[start], np.maximum.reduceat(hi, start) if len(start) else hi


#: ``at``: offset of the first window (31 bits), a number (31 bits: windows less one; for anchors with 128 times the anchor's
#: distance; for eights the mask of the live windows) and the state (2 bits)
ROUND_1 = "b long, full long, doc_id long, digest long, at long"
ROUND_2 = "b long, name long, left long, right long, doc_id long, digest long, at long"


def _rows(docs: pa.RecordBatch, row: np.ndarray, names: dict[str, np.ndarray], lo, number, state) -> pa.RecordBatch:
    take = pa.array(row)
    at = (lo.astype(np.int64) << 33) | (np.asarray(number, np.int64) << 2) | state
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x.view(np.int64)) for x in names.values()), docs.column(0).take(take), docs.column(1).take(take), pa.array(at)],
        [*names, "doc_id", "digest", "at"])


def _removed(docs: pa.RecordBatch, names: list[str], row, lo, hi) -> Iterator[pa.RecordBatch]:
    """Spans of windows known to be removed; they go through the shuffle, each in a bucket of its own."""
    if len(row):
        own = mix((row.astype(np.uint64) << np.uint64(40)) ^ lo.astype(np.uint64))
        yield _rows(docs, row, dict.fromkeys(names, own), lo, hi - lo, REMOVED)


def _states(name: np.ndarray) -> np.ndarray:
    """States of sorted rows: alone with their name, the first of several, or known not to be alone."""
    front = np.ones(len(name), bool)
    front[1:] = name[1:] != name[:-1]
    alone = front.copy()
    alone[:-1] &= front[1:]
    return np.where(alone, ALONE, np.where(front, FRONT, KNOWN))


def _parts(batch: pa.RecordBatch, borders: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for a, b in slices(borders, COMPARED):
        yield batch.slice(a, b - a), borders[a:b + 1]


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, digest, text) -> rows of round 1, equal ones compared."""
    for batch in batches:
        buf, all_borders = column_bytes(batch.column(2))
        for docs, borders in _parts(batch, all_borders):
            found = []
            for a, b, lo, hi in pieces(borders):
                grams = gram_names(buf[lo:hi])
                anchor, first, last = anchor_runs(grams, valid_windows(borders, a, b, lo, hi))
                row = np.searchsorted(borders, first + lo, "right") - 1         # of rows with one border, the one that is not empty
                full = paired(paired(window_names(grams, first), window_names(grams, last)),
                              ((anchor - first) * 128 + (last - first)).astype(np.uint64))
                found.append((row, grams[anchor], full, first + lo - borders[row], last + lo - borders[row], anchor - first))
            if not found:
                continue
            row, gram, full, lo, hi, offset = (np.concatenate(c) for c in zip(*found))
            if not len(row):
                continue
            rank = document_order(docs.column(0), docs.column(1).to_numpy())
            order, new, later = earliest(gram, full, (rank[row] << 32) + lo)
            row, gram, full, lo, hi = row[order], gram[order], full[order], lo[order], hi[order]
            offset = offset[order]
            yield from _removed(docs, ["b", "full"], *merged(row[later], lo[later], hi[later]))
            row, gram, full, lo, hi, offset = (x[new] for x in (row, gram, full, lo, hi, offset))
            state = _states(gram)
            bucket = np.where(state == KNOWN, paired(gram, full), gram)
            yield _rows(docs, row, {"b": bucket, "full": full}, lo, hi - lo + 128 * offset, state)


def side_key(left: np.ndarray, right: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The ``j`` last bytes of ``left``, the 7 - j first bytes of ``right``, and j: what a window has beside the shared bytes."""
    bits = (8 * j).astype(np.uint64)
    before = np.where(j > 0, left >> (np.uint64(64) - np.maximum(bits, np.uint64(8))), np.uint64(0))
    after = right & ((np.uint64(1) << (np.uint64(56) - bits)) - np.uint64(1))
    return (j.astype(np.uint64) << np.uint64(56)) | (before << (np.uint64(56) - bits)) | after


def _near_spans(begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of sorted spans that lie close together, of about ``PIECE`` bytes at most."""
    begin, end, at = begin.tolist(), end.tolist(), 0
    for k in range(1, len(begin) + 1):
        if k == len(begin) or begin[k] > end[k - 1] + 4 * LENGTH or end[k] - begin[at] > PIECE:
            yield at, k
            at = k


def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, digest, text, spans) -> rows of round 2, by eights of the windows in the spans, equal windows compared."""
    for batch in batches:
        buf, all_borders = column_bytes(batch.column(2))
        for docs, borders in _parts(batch, all_borders):
            spans = docs.column(3)
            owner = np.repeat(np.arange(len(docs)), spans.value_lengths().to_numpy(zero_copy_only=False))
            packed = spans.flatten().to_numpy()
            order = np.lexsort((packed, owner))
            owner, packed = owner[order], packed[order]
            lo = packed >> 14
            begin, end, anchor = borders[owner] + lo, borders[owner] + lo + ((packed >> 7) & 127), borders[owner] + lo + (packed & 127)
            found = []
            for s, e in _near_spans(begin, end):
                from_, to = int(begin[s]), int(end[e - 1]) + LENGTH
                grams, eights = gram_names(buf[from_:to]), (anchor[s:e] - begin[s:e]) // EIGHT - (anchor[s:e] - end[s:e]) // EIGHT + 1
                span = np.repeat(np.arange(s, e), eights)
                k = (anchor[span] - end[span]) // EIGHT + np.arange(len(span)) - np.repeat(np.cumsum(eights) - eights, eights)
                place = anchor[span] - EIGHT * k                         # the last window of the eight; it may lie past the span's end
                j = np.arange(EIGHT)
                live = (place[:, None] - j >= begin[span][:, None]) & (place[:, None] - j <= end[span][:, None])
                padded = np.zeros(to - from_ + 24, np.uint8)
                padded[8:8 + to - from_] = buf[from_:to]
                eight_bytes = np.lib.stride_tricks.sliding_window_view(padded, 8)
                left, right = (np.ascontiguousarray(eight_bytes[x]).view("<u8").ravel() for x in (place - from_, place - from_ + 8 + SHARED))
                found.append((owner[span], shared_names(grams, place - from_), left, right, place - borders[owner[span]], live))
            if not found:
                continue
            row, name, left, right, lo, live = (np.concatenate(c) for c in zip(*found))
            rank = document_order(docs.column(0), docs.column(1).to_numpy())
            k, j = np.nonzero(live)
            order, new, later = earliest(name[k], side_key(left[k], right[k], j), (rank[row[k]] << 32) + lo[k] - j)
            gone = (lo[k] - j)[order][later]
            yield from _removed(docs, ["b", "name", "left", "right"], *merged(row[k][order][later], gone, gone))
            mask = np.bincount(k[order][new], 2.0 ** j[order][new], len(row)).astype(np.int64)
            order = np.lexsort((lo, rank[row], name))
            order = order[mask[order] > 0]
            row, name, left, right, lo, mask = (x[order] for x in (row, name, left, right, lo, mask))
            state = _states(name)
            spread = mix(name ^ mix((row.astype(np.uint64) << np.uint64(40)) + lo.astype(np.uint64)))
            yield _rows(docs, row, {"b": np.where(state == KNOWN, spread, name), "name": name, "left": left, "right": right}, lo, mask, state)


def joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc, digest, packed spans) -> with spans whose bytes meet joined: (start << 31) + bytes, in order."""
    for batch in batches:
        lists = batch.column(2)
        row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
        packed = lists.flatten().to_numpy()
        lo = packed >> 31
        row, lo, hi = merged(row, lo, lo + (packed & ((1 << 31) - 1)), LENGTH)
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)),
                                         pa.array((lo << 31) + hi - lo + LENGTH))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans], batch.schema.names)


def cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text, joined spans or null) -> doc_id, sizes, kept bytes' digest and removed byte ranges."""
    ranges = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        buf, borders = column_bytes(batch.column(1))
        out = []
        for k, own in enumerate(batch.column(2)):
            text = buf[borders[k]:borders[k + 1]]
            cuts = [(lo, lo + size) for lo, size in (divmod(x, 1 << 31) for x in own.as_py() or ())]
            whole, at = hashlib.sha256(), 0
            for lo, hi in cuts:
                whole.update(text[at:lo])
                at = hi
            whole.update(text[at:])
            out.append((len(text), sum(hi - lo for lo, hi in cuts), len(cuts), whole.hexdigest(), [{"start": lo, "end": hi} for lo, hi in cuts]))
        if out:
            n_bytes, n_removed, n_spans, sha, removed = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(sha), pa.array(removed, ranges)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


# --- the rounds -------------------------------------------------------------------------------------------------

def kind() -> Column:
    return F.col("at").bitwiseAND(3)


def number() -> Column:
    return F.shiftrightunsigned("at", 2).bitwiseAND((1 << 31) - 1)


def place() -> Column:
    return F.shiftrightunsigned("at", 33)


def not_earliest(*columns: str) -> Column:
    """Whether rows with equal ``columns`` stand at a smaller place."""
    return F.rank().over(Window.partitionBy(*columns).orderBy(F.col("doc_id").asc_nulls_first(), "digest", "lo")) > 1


def round_1(rows: DataFrame) -> DataFrame:
    """(doc_id, digest, lo, hi, offset, removed) of the anchors that are removed or whose q-gram stands elsewhere as well."""
    bucket = Window.partitionBy("b")
    several = F.max(kind().isin(FRONT, KNOWN)).over(bucket) | (F.min("full").over(bucket) != F.max("full").over(bucket))
    whole = kind() == REMOVED
    return (rows.repartition("b").withColumn("lo", place()).withColumn("removed", whole | not_earliest("b", "full"))
            .withColumn("open", several).where("removed OR open")
            .select("doc_id", "digest", "lo", (F.col("lo") + F.when(whole, number()).otherwise(number().bitwiseAND(127))).alias("hi"),
                    F.shiftright(number(), 7).alias("offset"), "removed"))


def round_2(rows: DataFrame) -> DataFrame:
    """Eights whose shared bytes stand elsewhere as well, with ``removed`` where an earlier one has the same windows; spans known to be removed."""
    bucket = F.count("*").over(Window.partitionBy("b"))
    # eights that agree in the seven bytes on each side and in the mask have equal windows
    whole = [F.shiftright("left", 8).alias("_l"), F.col("right").bitwiseAND(F.lit((1 << 56) - 1)).alias("_r"), number().alias("mask")]
    return (rows.repartition("b").select("*", place().alias("lo"), *whole)
            .withColumn("removed", (kind() == REMOVED) | not_earliest("b", "_l", "_r", "mask"))
            .withColumn("n", bucket).where((F.col("n") > 1) | (kind() != ALONE))
            .withColumn("spans", F.when(kind() == REMOVED, F.array(F.struct("lo", (F.col("lo") + F.col("mask")).alias("hi"))))
                        .when(F.col("removed"), _live(lambda j: F.struct((F.col("lo") - j).alias("lo"), (F.col("lo") - j).alias("hi")))))
            .select("name", "left", "right", "doc_id", "digest", "lo", "mask", "removed", "spans"))


def _live(of: Callable[[int], Column]) -> Column:
    """``of(j)`` for the live windows j of an eight."""
    return F.filter(F.array(*[F.when(F.col("mask").bitwiseAND(1 << j) != 0, of(j)) for j in range(EIGHT)]), lambda x: x.isNotNull())


def round_3(eights: DataFrame) -> DataFrame:
    """(doc_id, digest, lo, hi) of the windows that are not the earliest of their kind (``side_key``)."""
    def key(j: int) -> Column:
        before = F.shiftleft(F.shiftrightunsigned("left", 64 - 8 * j), 56 - 8 * j) if j else F.lit(0).cast("long")
        after = F.col("right").bitwiseAND(F.lit((1 << (56 - 8 * j)) - 1))
        return F.lit(j << 56).bitwiseOR(before).bitwiseOR(after)
    windows = (eights.where("NOT removed")
               .select("name", "doc_id", "digest", F.explode(_live(lambda j: F.struct(key(j).alias("key"), (F.col("lo") - j).alias("at")))).alias("w"))
               .select("name", "w.key", "doc_id", "digest", F.col("w.at").alias("lo")))
    return (windows.repartition("name", "key").withColumn("gone", not_earliest("name", "key")).where("gone")
            .select("doc_id", "digest", "lo", F.col("lo").alias("hi")))


def span_lists(spans: DataFrame, packed: Column) -> DataFrame:
    return (spans.groupBy(F.col("doc_id").alias("_d"), F.col("digest").alias("_g")).agg(F.collect_list(packed).alias("spans")))


def with_spans(docs: DataFrame, lists: DataFrame, how: str, name: str) -> DataFrame:
    """``docs`` (doc_id, digest, text) joined with the lists of their spans."""
    same = (F.col("digest") == F.col("_g")) & F.col("doc_id").eqNullSafe(F.col("_d"))
    return docs.join(bounded_broadcast(settled(lists, name)), same, how).select("doc_id", "digest", "text", "spans")


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, text); ``digest`` tells the texts of one id apart and is 0 where an id stands once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    twice = settled(docs.groupBy(F.col("doc_id").alias("_d")).agg(F.count("*").alias("_n")).where("_n > 1"), "repeated-ids")
    found = docs.join(bounded_broadcast(twice), F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    return found.select("doc_id", F.when(F.col("_n").isNull(), 0).otherwise(F.xxhash64("text")).cast("long").alias("digest"), "text")


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte ranges of every row of ``docs``."""
    docs = numbered(docs, id_col, text_col)
    anchors = settled(round_1(docs.mapInArrow(anchor_rows, ROUND_1)), "anchors")
    owned = F.shiftleft(F.col("lo").cast("long"), 14) + F.shiftleft(F.col("hi") - F.col("lo"), 7) + F.col("offset")
    left = with_spans(docs, span_lists(anchors.where("NOT removed"), owned), "inner", "open-spans")
    eights = settled(round_2(left.mapInArrow(window_rows, ROUND_2)), "open-eights")
    where = ["doc_id", "digest", "lo", "hi"]
    gone = (anchors.where("removed").select(where)
            .unionByName(eights.where("removed").select("doc_id", "digest", F.inline("spans")).select(where))
            .unionByName(round_3(eights).select(where)))
    removed = span_lists(gone, F.shiftleft(F.col("lo").cast("long"), 31) + (F.col("hi") - F.col("lo")))
    return (with_spans(docs, removed.mapInArrow(joined_spans, removed.schema), "left", "removed-spans").select("doc_id", "text", "spans")
            .mapInArrow(cut_spans, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                   "removed array<struct<start:int,end:int>>"))
