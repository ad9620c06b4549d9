"""Positions of aligned reads: CIGAR walks, pileups, genotype calls and quality recalibration.

* ``aligned_bases`` walks the CIGAR of every read and gives one row per base that stands on a reference position.
* ``pileup`` sums them per position.  Every sum has a map-side partial stage, so a position covered by a
  third of all reads is one row per task, and no position's reads are ever collected.
* ``pileup_on_reference`` and ``read_covariates`` do the same for many reads (``operators/basewise``): reads are dealt by chunk of the
  reference and summed there in numpy, so no row per base is ever made.  Chunks in which more than ``HOT`` reads start are dealt into
  parts, whose sums are added.
* ``call_variants`` turns the sums of a position into likelihoods of the three genotypes of its reference base and its most
  frequent other base.  The sums hold log10 likelihoods in millionths as integers, so they do not depend on the order of addition.
* ``covariates`` counts mismatches outside known sites per reported quality, machine cycle and preceding base pair, and
  ``recalibrate`` replaces reported qualities by the empirical ones.
* ``clip_past_end`` soft-clips what reaches past the end of a sequence.

``aligned_bases``, ``pileup`` and ``covariates`` are built-in expressions and state what the sums are.  Reads without a CIGAR (``*``, empty, null), null positions and bases other
than A, C, G, T count nowhere.  Qualities missing at the end of a short quality string leave their bases out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.operators.basewise import (BASES, SITES, TOP_QUALITY, Finish, code_points, covariate_counts, cut_pieces, every_site, finished, on_chunks, ragged,
                                           summed_sites)
from sparkfold.operators.reads import PHRED_OFFSET
from sparkfold.session import checkpoint_root

#: one log10 unit in the integer sums
UNIT = 1_000_000
#: reads that start in one chunk of the reference
HOT = 100_000
#: reads dealt to one task
DEAL = 400_000
#: cells of a table of covariates that is held as an array
DENSE = 1 << 26


def _error(q: int) -> float:
    return min(10 ** (-q / 10), 0.75)


def _values(of) -> list[int]:
    """``of(error)`` in log10 millionths, by quality."""
    return [round(log10(of(_error(q))) * UNIT) for q in range(TOP_QUALITY + 1)]


#: what a base adds to the sums of its position, by quality
VALUES = {"n": [1] * (TOP_QUALITY + 1), "right": _values(lambda e: 1 - e), "wrong": _values(lambda e: e / 3), "half": _values(lambda e: (1 - e + e / 3) / 2)}


# --- CIGAR walks ------------------------------------------------------------------------------------------------

def cigar_ops(cigar: Column) -> Column:
    """Array of (n, op)."""
    counts = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), 1)
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), 1)
    return F.zip_with(counts, ops, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op")))


def aligned_blocks(cigar: Column, pos: Column) -> Column:
    """Array of (ref, read, n): stretches of ``n`` bases on reference positions from ``ref``, read offsets from ``read``."""
    none = F.array().cast("array<struct<ref:int,read:int,n:int>>")

    def step(acc: Column, x: Column) -> Column:
        both, n = x["op"].isin("M", "=", "X"), x["n"]
        return F.struct(
            F.when(both | x["op"].isin("D", "N"), acc["ref"] + n).otherwise(acc["ref"]).alias("ref"),
            F.when(both | x["op"].isin("I", "S"), acc["read"] + n).otherwise(acc["read"]).alias("read"),
            F.when(both, F.concat(acc["out"], F.array(F.struct(acc["ref"].alias("ref"), acc["read"].alias("read"), n.alias("n")))))
            .otherwise(acc["out"]).alias("out"))
    walked = F.aggregate(cigar_ops(cigar), F.struct(pos.cast("int").alias("ref"), F.lit(0).alias("read"), none.alias("out")), step)["out"]
    # most reads match as a whole
    plain = F.array(F.struct(pos.cast("int").alias("ref"), F.lit(0).alias("read"), F.substring_index(cigar, "M", 1).try_cast("int").alias("n")))
    return F.when((F.translate(cigar, "0123456789", "") == "M") & F.endswith(cigar, F.lit("M")) & (F.length(cigar) > 1), plain).otherwise(walked)


def aligned_bases(reads: DataFrame, *keep: str) -> DataFrame:
    """(rname, pos, base, q, at, before) and ``keep``: every base on a reference position, its offset in the read and the base before it."""
    walked = (reads.where("pos IS NOT NULL AND rname IS NOT NULL").select(*keep, "rname", "seq", "qual", F.explode(aligned_blocks(F.col("cigar"), F.col("pos"))).alias("b"))
              .where("b.n > 0").select(*keep, "rname", "seq", "qual", "b", F.explode(F.sequence(F.lit(0), F.col("b.n") - 1)).alias("k")))
    at = F.col("b.read") + F.col("k")
    base = walked.select(*keep, "rname", (F.col("b.ref") + F.col("k")).alias("pos"), F.substring(F.col("seq"), at + 1, F.lit(1)).alias("base"),
                         (F.ascii(F.substring(F.col("qual"), at + 1, F.lit(1))) - PHRED_OFFSET).alias("q"), at.alias("at"),
                         F.when(at > 0, F.substring(F.col("seq"), at, F.lit(1))).otherwise(F.lit("")).alias("before"))
    return base.where(F.col("base").isin(*BASES) & F.col("q").between(0, TOP_QUALITY))


def clip_past_end(reads: DataFrame, lengths: DataFrame) -> DataFrame:
    """``reads`` with ``clean_cigar`` and ``clean_end``.

    Bases past the end of their sequence (``lengths``: name, length) become a soft clip; the end
    follows from the new CIGAR.  A read that lies past the end as a whole is clipped as a whole, and ends before its start.
    Sequences without a known length clip nothing."""
    d = lengths.select(F.col("name").alias("rname"), F.col("length").alias("_len"))
    room = F.col("_len") - F.col("pos") + 1

    def step(acc: Column, x: Column) -> Column:
        n, op = x["n"], x["op"]
        on_ref, on_read = op.isin("M", "=", "X", "D", "N"), op.isin("M", "=", "X", "I", "S")
        left = F.greatest(room - acc["ref"], F.lit(0)).cast("int")
        inside = F.when(on_ref, F.least(n, left)).when((op == "I") & (left == 0), 0).otherwise(n)
        keep = F.when(op == "S", acc["clip"] == 0).otherwise((inside > 0) & ((op != "H") | (acc["clip"] == 0)))
        clipped = F.when(on_read & (op != "S"), n - inside).when((op == "S") & (acc["clip"] > 0), n).otherwise(0)
        return F.struct(
            F.when(on_ref, acc["ref"] + n).otherwise(acc["ref"]).alias("ref"), (acc["clip"] + clipped).alias("clip"),
            F.when(keep, F.concat(acc["out"], inside.cast("string"), op)).otherwise(acc["out"]).alias("out"),
            F.when((op == "H") & (acc["clip"] > 0), F.concat(n.cast("string"), op)).otherwise(acc["hard"]).alias("hard"),
            F.when(on_ref, acc["end"] + inside).otherwise(acc["end"]).alias("end"))
    zero = F.lit(0)
    done = F.aggregate(cigar_ops(F.col("cigar")), F.struct(zero.alias("ref"), zero.alias("clip"), F.lit("").alias("out"), F.lit("").alias("hard"),
                                                           zero.alias("end")), step)
    over = (F.col("_len") > 0) & (F.col("aln_end") > F.col("_len"))
    clip = F.col("_c.clip")
    return (reads.join(d, "rname", "left").withColumn("_c", F.when(over, done))
            .withColumn("clean_cigar", F.when(F.col("_c").isNull(), F.col("cigar")).otherwise(
                F.concat("_c.out", F.when(clip > 0, F.concat(clip.cast("string"), F.lit("S"))).otherwise(""), "_c.hard")))
            .withColumn("clean_end", F.when(F.col("_c").isNull(), F.col("aln_end")).otherwise(F.col("pos") + F.col("_c.end") - 1).cast("int"))
            .drop("_c", "_len"))


# --- pileup and calls -------------------------------------------------------------------------------------------

def pileup(bases: DataFrame, *keys: str) -> DataFrame:
    """(rname, pos, keys, n, right, wrong, half): per position (and ``keys`` that belong to it) arrays over A, C, G, T.

    ``n``: bases; sums of log10 likelihoods of these bases if they are what was read from (``right``), if another base
    was (``wrong``), and if it was one of two alleles (``half``)."""
    q1 = F.col("q") + 1
    values = {k: F.element_at(F.array(*[F.lit(x).cast("long") for x in v]), q1) for k, v in VALUES.items()}
    by = ["rname", "pos", *keys]
    rows = bases.select(*by, "base", *[v.alias(k) for k, v in values.items()])
    sums = [F.sum(F.when(F.col("base") == b, F.col(k)).otherwise(0)).alias(f"{k}_{b}") for k in values for b in BASES]
    return rows.groupBy(*by).agg(*sums).select(*by, *[F.array(*[f"{k}_{b}" for b in BASES]).alias(k) for k in values])


def with_reference(sites: DataFrame, reference: DataFrame, chunk: int) -> DataFrame:
    """``sites`` (rname, pos, 1-based) with ``ref``: the base in ``reference`` (name, chunk number, bases of ``chunk`` positions)."""
    d = reference.select(F.col("name").alias("rname"), F.col("number").alias("_number"), F.col("bases").alias("_bases"))
    place = F.col("pos") - 1
    return (sites.withColumn("_number", F.floor(place / chunk).cast("long")).join(d, ["rname", "_number"])
            .withColumn("ref", F.upper(F.substring(F.col("_bases"), (place % chunk + 1).cast("int"), F.lit(1)))).drop("_number", "_bases"))


def frequent_chunks(reads: DataFrame, chunk: int) -> tuple[int, DataFrame | None]:
    """The number of placed reads, and (rname, number, parts): the chunks where more than ``HOT`` reads start and those after them, if any."""
    placed, wide = reads.where("pos IS NOT NULL AND rname IS NOT NULL").select("rname", "pos"), 1000 * chunk

    def counted(some: DataFrame, size: int, name: str) -> DataFrame:
        return some.groupBy("rname", F.floor((F.col("pos") - 1) / size).alias(name)).agg(F.count("*").alias("n"))
    bins = counted(placed, wide, "bin")                     # a few rows, also of reads in any order
    total, most = bins.agg(F.sum("n"), F.max("n")).first()
    if (most or 0) <= HOT:
        return total or 0, None
    few = F.broadcast(bins.where(F.col("n") > HOT).select("rname", "bin"))          # at most one row for every HOT reads
    starts = counted(placed.withColumn("bin", F.floor((F.col("pos") - 1) / wide)).join(few, ["rname", "bin"], "left_semi"), chunk, "number")
    hot = (starts.where(F.col("n") > HOT).select("rname", F.explode(F.array(F.col("number"), F.col("number") + 1)).alias("number"), "n")
           .groupBy("rname", "number").agg(F.ceil(F.sum("n") / HOT).cast("int").alias("parts")))
    checkpoint_root(reads.sparkSession)
    hot = hot.checkpoint()                                  # at most two rows for every HOT reads
    return total, None if hot.isEmpty() else F.broadcast(hot)


def _tasks(reads: DataFrame, total: int) -> int:
    return max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // DEAL))


def _in_parts(df: DataFrame, hot: DataFrame | None, name: str = "rname", every: bool = True) -> DataFrame:
    """``df`` with ``part``: rows of frequent chunks once for ``every`` part, or each row in one of them."""
    if hot is None:
        return df.withColumn("part", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    number = F.explode(F.sequence(F.lit(0), parts - 1)) if every else F.pmod(F.monotonically_increasing_id(), parts).cast("int")
    return df.join(hot.withColumnRenamed("rname", name), [name, "number"], "left").withColumn("part", number).drop("parts")


def pileup_on_reference(reads: DataFrame, reference: DataFrame, chunk: int, finish: Finish = every_site, schema: str = SITES,
                        values: tuple[str, ...] = tuple(VALUES)) -> DataFrame:
    """``finish`` of (rname, pos, ref, n, right, wrong, half): ``with_reference(pileup(aligned_bases(reads)), ...)`` without rows of bases.

    ``finish`` gets whole positions, batch by batch, and gives rows of ``schema``; ``values``: the sums it needs."""
    total, hot = frequent_chunks(reads, chunk)
    tasks, pieces = _tasks(reads, total), cut_pieces(reads, chunk)
    added = {c: np.array(VALUES[c], np.float64) for c in values}
    if hot is None:
        return summed_sites(on_chunks(_in_parts(pieces, None), _in_parts(reference, None), tasks), chunk, added, finish, schema)
    cold = summed_sites(on_chunks(_in_parts(pieces.join(hot, ["rname", "number"], "left_anti"), None), _in_parts(reference, None), tasks), chunk, added, finish, schema)
    named = reference.join(hot.withColumnRenamed("rname", "name"), ["name", "number"], "left_semi")
    stream = on_chunks(_in_parts(pieces.join(hot, ["rname", "number"], "left_semi"), hot, every=False), _in_parts(named, hot, "name"), tasks)
    partial = summed_sites(stream, chunk, added, every_site, "rname string, pos int, ref string, " + ", ".join(f"{c} array<long>" for c in values))
    sums = [F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(len(BASES))]).alias(c) for c in values]
    return cold.unionByName(finished(partial.groupBy("rname", "pos", "ref").agg(*sums), finish, schema))


def call_variants(sites: DataFrame, min_quality: int = 30) -> DataFrame:
    """(rname, pos, ref, alt, gt, pl, dp, ad_ref, ad_alt, qual) of the positions of ``pileup`` (with ``ref``) that vary.

    ``pl``: phred-scaled likelihoods of 0/0, 0/1 and 1/1, the best one 0; ``qual``: that of 0/0.  The alternative is
    the most frequent base other than the reference's, the first by letter if tied."""
    ri = F.instr(F.lit(BASES), F.col("ref")) - 1
    def once(df: DataFrame, *cols: Column) -> DataFrame:
        """``df`` with further columns; the row of an explode, as a later filter would compute them anew for every use."""
        return df.select("*", F.explode(F.array(F.struct(*cols))).alias("_c")).select(*df.columns, "_c.*")
    # count and letter of a base in one number
    best = F.greatest(*[F.when(ri == i, -1).otherwise(F.get("n", F.lit(i)) * 4 + (3 - i)) for i in range(4)])
    s = sites.where(F.col("ref").isin(*BASES)).where(best > 3)
    s = once(s, ri.alias("ri"), (3 - best % 4).cast("int").alias("ai"))

    def of(name: str, i: str) -> Column:
        return F.get(name, F.col(i))

    def total(name: str) -> Column:
        return sum((F.get(name, F.lit(i)) for i in range(1, 4)), F.get(name, F.lit(0)))
    off = total("wrong")
    s = once(s, F.substring(F.lit(BASES), F.col("ai") + 1, F.lit(1)).alias("alt"), total("n").alias("dp"),
             of("n", "ri").alias("ad_ref"), of("n", "ai").alias("ad_alt"),
             (of("right", "ri") + off - of("wrong", "ri")).alias("l0"),
             (of("half", "ri") + of("half", "ai") + off - of("wrong", "ri") - of("wrong", "ai")).alias("l1"),
             (of("right", "ai") + off - of("wrong", "ai")).alias("l2"))
    top = F.greatest("l0", "l1", "l2")
    pl = [F.floor((top - F.col(x) + UNIT // 20) / (UNIT // 10)).cast("int") for x in ("l0", "l1", "l2")]
    s = s.where((F.col("l0") < top) & (pl[0] >= min_quality))
    gt = F.when(F.col("l1") == top, "0/1").otherwise("1/1")
    return s.select("rname", "pos", "ref", "alt", gt.alias("gt"), F.array(*pl).alias("pl"), "dp", "ad_ref", "ad_alt", pl[0].alias("qual"))


def vcf_body(calls: DataFrame) -> Column:
    """One VCF line per call."""
    info = F.concat(F.lit("DP="), F.col("dp").cast("string"))
    sample = F.concat_ws(":", "gt", F.concat_ws(",", F.col("ad_ref").cast("string"), F.col("ad_alt").cast("string")), F.array_join(F.col("pl").cast("array<string>"), ","))
    return F.concat_ws("\t", "rname", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.col("qual").cast("string"), F.lit("PASS"), info,
                       F.lit("GT:AD:PL"), sample)


# --- recalibration ----------------------------------------------------------------------------------------------

COVARIATES = ["q", "cycle", "context"]


def with_covariates(bases: DataFrame) -> DataFrame:
    """``bases`` (with is_reverse and length) with the machine cycle (1-based, from the read's own start) and the pair of bases."""
    cycle = F.when(F.col("is_reverse"), F.col("length") - F.col("at")).otherwise(F.col("at") + 1)
    return bases.withColumn("cycle", cycle).withColumn("context", F.concat("before", "base"))


def covariates(bases: DataFrame, known: DataFrame) -> DataFrame:
    """(q, cycle, context, n, wrong, empirical) over ``bases`` (with ``ref``) outside the ``known`` sites (rname, pos).

    ``empirical``: phred of (mismatches + 1) / (bases + 2), rounded.  The table is as long as qualities x cycles x contexts."""
    return covariate_table(bases.join(known.select("rname", "pos").distinct(), ["rname", "pos"], "left_anti"))


def read_covariates(reads: DataFrame, reference: DataFrame, known: DataFrame, chunk: int) -> DataFrame:
    """``covariates`` of all bases of ``reads`` (with is_reverse and length): reads meet the chunks and their known sites, and bases are
    counted where they are."""
    total, hot = frequent_chunks(reads, chunk)
    sites = (known.where("rname IS NOT NULL AND pos IS NOT NULL")
             .select("rname", F.floor((F.col("pos") - 1) / chunk).alias("number"), F.col("pos").cast("int").alias("pos")))
    turned = reads.withColumn("origin", F.when(F.col("is_reverse"), F.col("length")).otherwise(1)).withColumn("step", F.when(F.col("is_reverse"), -1).otherwise(1))
    keep = ["origin", "step"]
    stream = on_chunks(_in_parts(cut_pieces(turned, chunk, *keep), hot, every=False), _in_parts(reference, hot, "name"), _tasks(reads, total), _in_parts(sites, hot), *keep)
    return _covariate_sums(covariate_counts(stream, chunk))


def covariate_table(bases: DataFrame) -> DataFrame:
    """The sums of ``covariates`` over ``bases`` as they are."""
    return _covariate_sums(with_covariates(bases).withColumn("wrong", (F.col("base") != F.col("ref")).cast("long")).withColumn("more", F.lit(0)))


def _covariate_sums(rows: DataFrame) -> DataFrame:
    """A row stands for one base and ``more`` like it."""
    table = rows.groupBy(*COVARIATES).agg((F.count("*") + F.sum("more")).alias("n"), F.sum("wrong").alias("wrong"))
    return table.withColumn("empirical", F.round(-10 * F.log10((F.col("wrong") + 1) / (F.col("n") + 2))).cast("int"))


class _Lookup:
    """New quality letters by (q, cycle, context), as an array over all of them; contexts are pairs of the code points seen."""

    def __init__(self, q: np.ndarray, cycle: np.ndarray, context: list[str | None], letter: np.ndarray):
        fits = np.array([c is not None and len(c) <= 2 for c in context], bool)
        pairs = [c.rjust(2, "\0") for c, f in zip(context, fits) if f]
        q, cycle, self.letter = q[fits].astype(np.int64), cycle[fits].astype(np.int64), letter[fits]
        before, base = (np.array([ord(p[i]) for p in pairs], np.int64) for i in (0, 1))
        self.points = np.unique(np.concatenate((before, base)))
        self.low = (q.min(initial=0), cycle.min(initial=0))
        self.size = (int(q.max(initial=0)) - int(self.low[0]) + 1, int(cycle.max(initial=0)) - int(self.low[1]) + 1)
        key = self._key(q, cycle, before, base)[0]
        order = np.argsort(key)
        self.key, self.letter = key[order], self.letter[order]
        self.dense = None
        cells = self.size[0] * self.size[1] * len(self.points) ** 2
        if cells <= DENSE:
            self.dense = np.zeros(cells, np.uint8)
            self.dense[self.key] = self.letter

    def _key(self, q: np.ndarray, cycle: np.ndarray, before: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, cycle = q - self.low[0], cycle - self.low[1]
        good = (q >= 0) & (q < self.size[0]) & (cycle >= 0) & (cycle < self.size[1])
        key, top = cycle * self.size[0] + q, max(len(self.points) - 1, 0)
        for points in (before, base):
            if len(self.points) and self.points[-1] < 256:
                place = self._small()[np.minimum(points, 255)]
                good &= (place >= 0) & (points < 256)
            else:
                place = np.minimum(np.searchsorted(self.points, points), top)
                good &= self.points[place] == points if len(self.points) else False
            key = key * len(self.points) + place
        return key, good

    def _small(self) -> np.ndarray:
        table = np.full(256, -1, np.int64)
        table[self.points] = range(len(self.points))
        return table

    def of(self, q: np.ndarray, cycle: np.ndarray, before: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Letters, 0 where there is none."""
        if not len(self.key):
            return np.zeros(len(q), np.uint8)
        key, good = self._key(q, cycle, before, base)
        if self.dense is not None:
            return np.where(good, self.dense[np.where(good, key, 0)], 0)
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(good & (self.key[place] == key), self.letter[place], 0).astype(np.uint8)


def recalibrate(reads: DataFrame, table: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """``reads`` with ``new_qual``: every base's quality replaced by the empirical one of its covariates, if the table has them.

    The table is bounded by its covariates (refused beyond ``max_rows``) and sent to every task; reads are not shuffled."""
    reads = reads.drop("new_qual")
    rows = table.select(*[F.col(c).cast("long").alias(c) for c in ("q", "cycle", "empirical")], "context").where("q IS NOT NULL AND cycle IS NOT NULL").limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        raise ValueError(f"more than {max_rows} combinations of covariates")
    q, cycle, empirical = (rows[c].to_numpy() for c in ("q", "cycle", "empirical"))
    letter = (PHRED_OFFSET + np.clip(empirical, 0, TOP_QUALITY)).astype(np.uint8)
    sent = reads.sparkSession.sparkContext.broadcast(_Lookup(q, cycle, rows["context"].to_pylist(), letter))
    at = [reads.columns.index(c) for c in ("seq", "qual", "flag")]
    schema = T.StructType([*reads.schema.fields, T.StructField("new_qual", T.StringType())])

    def renewed(seq: pa.Array, qual: pa.Array, flag: pa.Array) -> pa.Array:
        bases, begin = code_points(seq)
        old, qual_begin = code_points(qual)
        n, reverse = np.diff(qual_begin), (flag.fill_null(0).to_numpy() & 16) > 0
        k, of = ragged(np.zeros(len(n), np.int64), n), np.repeat(np.arange(len(n)), n)
        size, place = np.diff(begin)[of], begin[of] + k
        bases = np.append(bases, 0).astype(np.int64)

        def read_at(offset: int) -> np.ndarray:
            here = k + offset
            inside = (here >= 0) & (here < size)
            return np.where(inside, bases[np.where(inside, place + offset, 0)], 0)
        before, base = read_at(-1), read_at(0)
        ended = base == 0                                   # past the last base: it stands alone
        before, base = np.where(ended, 0, before), np.where(ended, before, base)
        cycle = np.where(reverse[of], n[of] - k, k + 1)
        new = sent.value.of(old.astype(np.int64) - PHRED_OFFSET, cycle, before, base)
        new = np.where((new > 0) & ~(seq.is_null().to_numpy(zero_copy_only=False))[of], new, old)
        if new.max(initial=0) > 127:
            text = new.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            out = pa.array([text[a:z] for a, z in zip(qual_begin[:-1].tolist(), qual_begin[1:].tolist())], pa.string())
        else:
            out = pa.StringArray.from_buffers(len(n), pa.py_buffer(qual_begin.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(new, np.uint8)))
        return pc.if_else(qual.is_null(), pa.scalar(None, pa.string()), out) if qual.null_count else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, renewed(*(batch.column(i) for i in at))], [*batch.schema.names, "new_qual"])
    return reads.mapInArrow(run, schema)
