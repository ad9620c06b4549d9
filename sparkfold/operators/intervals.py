"""Interval operators.

``merge_intervals`` (gaps and islands): intervals sorted by (chrom, start)
join the current island while ``start - pad <= island_end + gap`` (or ``<``
when ``inclusive=False``).  A window partitioned by chromosome would sort a
whole chromosome inside one task, so the merge is a distributed scan:

1. pre-aggregate per (chrom, start): max end and a count.  Keys are then
   unique, so a hot coordinate cannot overload one range partition;
2. range-partition on (chrom, start) and sweep every partition once with a
   vectorised pandas pass (``mapInPandas``) -> local islands;
3. per (partition, chrom) summary (bounded by the partition count): the
   running max end carried in from earlier partitions decides which local
   islands continue an island from an earlier partition, and which island
   start they inherit;
4. a final hash aggregate (with map-side partial stage) folds continued
   pieces into their islands.

``intersect_intervals`` (range join): bins of nested widths, each four times
the one below.  An interval is at home on the level whose bins are just as wide
as it is, and covers two of them at most; it asks for its bins there and on the
wider levels that the other side uses.  A pair meets on the wider of its two
levels, once, in the bin that holds the start of the overlap.  So an interval
is two rows a level whatever its length, and long ones among short ones do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.session import checkpoint_root

_LOCAL_SCHEMA = "pid int, key string, first_s long, max_e long, n long"


def _sweep(thr: int):
    """Per partition (sorted by key, s): local islands, streaming over batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None  # [pid, key, first_s, max_e, n]
        for b in batches:
            if b.empty:
                continue
            pid = int(b["pid"].iloc[0])
            k = b["key"].to_numpy(dtype=object)
            s = b["s"].to_numpy(dtype=np.int64)
            e = b["e"].to_numpy(dtype=np.int64)
            n = b["n"].to_numpy(dtype=np.int64)
            seg_start = np.ones(len(b), dtype=bool)
            seg_start[1:] = k[1:] != k[:-1]
            seg_id = np.cumsum(seg_start) - 1
            # running max of e within each key segment (islands are contiguous,
            # so the segment running max equals the island running max)
            runmax = pd.Series(e).groupby(seg_id).cummax().to_numpy()
            prev = np.empty(len(b), dtype=np.float64)
            prev[1:] = runmax[:-1]
            prev[seg_start] = np.nan
            if carry is not None and carry[1] == k[0]:
                first_seg = seg_id == 0
                prev[first_seg] = np.fmax(prev[first_seg], carry[3])
                prev[0] = carry[3]
            new = np.isnan(prev) | (s > prev + thr)
            isl = np.cumsum(new)          # 0 = continues the carried island
            g = pd.DataFrame({"isl": isl, "key": k, "s": s, "e": e, "n": n})
            agg = g.groupby("isl", sort=True).agg(key=("key", "first"), first_s=("s", "first"),
                                                  max_e=("e", "max"), n=("n", "sum")).reset_index()
            agg.insert(0, "pid", pid)
            if agg["isl"].iloc[0] == 0:                 # continues the carried island
                carry[3] = max(carry[3], int(agg["max_e"].iloc[0]))
                carry[4] += int(agg["n"].iloc[0])
                agg = agg.iloc[1:]
            if len(agg):
                done = agg.iloc[:-1][["pid", "key", "first_s", "max_e", "n"]]
                if carry is not None:
                    done = pd.concat([pd.DataFrame([carry], columns=done.columns), done], ignore_index=True)
                last = agg.iloc[-1]
                carry = [pid, last["key"], int(last["first_s"]), int(last["max_e"]), int(last["n"])]
                if len(done):
                    yield done
        if carry is not None:
            yield pd.DataFrame([carry], columns=["pid", "key", "first_s", "max_e", "n"])

    return run


def merge_intervals(df: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end",
                    gap: int = 51, inclusive: bool = True, pad: int = 0, clamp_start: int | None = None,
                    case_insensitive: bool = False, num_partitions: int | None = None) -> DataFrame:
    """-> (chrom, start, end, n) per island; ``start`` = first ``start - pad``
    (clamped to ``clamp_start`` when given), ``end`` = max end."""
    spark = df.sparkSession
    checkpoint_root(spark)
    thr = gap if inclusive else gap - 1
    key = F.lower(F.col(chrom)) if case_insensitive else F.col(chrom)
    pre = (df.select(key.cast("string").alias("key"), (F.col(start) - pad).cast("long").alias("s"),
                     F.col(chrom).alias("_name"), F.col(end).cast("long").alias("e"))
           .groupBy("key", "s")
           .agg(F.max("e").alias("e"), F.count(F.lit(1)).alias("n"), F.min("_name").alias("_name")))     # equal starts: smallest spelling
    # without an explicit count AQE may coalesce neighbouring ranges (still in order)
    ranged = (pre.repartitionByRange(num_partitions, "key", "s") if num_partitions
              else pre.repartitionByRange("key", "s"))
    ordered = (ranged.sortWithinPartitions("key", "s")
               .select(F.spark_partition_id().alias("pid"), "key", "s", "e", "n"))
    local = ordered.mapInPandas(_sweep(thr), _LOCAL_SCHEMA).checkpoint(eager=True)

    # per (partition, key): bounded by partitions + keys
    summ = local.groupBy("pid", "key").agg(F.max("max_e").alias("pmax"))
    w = Window.partitionBy("key").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select("pid", "key", F.max("pmax").over(w).alias("carry_in"))
    tagged = local.join(summ, ["pid", "key"]).withColumn(
        "cont", F.col("carry_in").isNotNull() & (F.col("first_s") <= F.col("carry_in") + thr))
    last_new = tagged.where(~F.col("cont")).groupBy("pid", "key").agg(F.max("first_s").alias("lns"))
    starts = (summ.select("pid", "key").join(last_new, ["pid", "key"], "left")
              .select("pid", "key", F.max("lns").over(w).alias("inherit")))
    pieces = tagged.join(starts, ["pid", "key"]).withColumn(
        "island", F.when(F.col("cont"), F.col("inherit")).otherwise(F.col("first_s")))
    isl = pieces.groupBy("key", "island").agg(F.max("max_e").alias(end), F.sum("n").alias("n"))
    out_start = F.col("island")
    if clamp_start is not None:
        out_start = F.greatest(out_start, F.lit(clamp_start))
    if case_insensitive:    # the spelling of the island's first interval
        isl = isl.join(pre.select("key", F.col("s").alias("island"), F.col("_name").alias("name")), ["key", "island"])
    else:
        isl = isl.withColumn("name", F.col("key"))
    return isl.select(F.col("name").alias(chrom), out_start.alias(start), end, "n")


def island_extent(islands: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Per chrom, number of ranges, first start, last end and a label
    ``<n>regions_<chrom>-<first start>``."""
    e = islands.groupBy(chrom).agg(F.count(F.lit(1)).alias("n_ranges"), F.min(start).alias("first_start"),
                                   F.max_by(end, start).alias("last_end"))
    return e.withColumn("label", F.format_string("%dregions_%s-%d", "n_ranges", chrom, "first_start"))


def bed_lines(islands: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end",
              compat: bool = False) -> DataFrame:
    """1-based inclusive -> BED ``chrom<TAB>start-1<TAB>end``
    (``compat=True`` writes ``end-1`` like the original writer)."""
    e = F.col(end) - 1 if compat else F.col(end)
    return islands.select(F.concat_ws("\t", F.col(chrom), (F.col(start) - 1).cast("string"),
                                      e.cast("string")).alias("value"))


def region_strings(islands: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """K5: ``chrom:start-end``."""
    return islands.select(F.format_string("%s:%d-%d", chrom, start, end).alias("value"))


_FOUR = 4


def _level(s, e, unit: int):
    """The lowest level whose bins (``unit`` times a power of four) are as wide as the interval."""
    return F.length(F.conv(F.floor((e - s - 1) / unit).cast("string"), 10, _FOUR))


def _width(level, unit: int):
    return (F.pow(F.lit(float(_FOUR)), level) * unit).cast("long")


def _binned(df: DataFrame, start: str, end: str, own: str, others: list[int], unit: int) -> DataFrame:
    """``df`` with ``_l`` and ``_b``: its bins on its own level and on the wider ones among ``others``."""
    wider = F.filter(F.array(*[F.lit(x) for x in others]).cast("array<int>"), lambda x: x > F.col(own))
    at = df.withColumn("_l", F.explode(F.concat(F.array(F.col(own)), wider)))
    wide = _width(F.col("_l"), unit)
    return at.withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / wide), F.floor((F.col(end) - 1) / wide))))


def auto_bin_size(a: DataFrame, b: DataFrame, start: str = "start", end: str = "end") -> int:
    """Median interval length of both sides (one small approximate job): an
    interval then covers about two bins on average, whatever its scale."""
    lens = a.select((F.col(end) - F.col(start)).alias("l")).unionByName(
        b.select((F.col(end) - F.col(start)).alias("l")))
    med = lens.agg(F.percentile_approx("l", 0.5, 1000).alias("m")).first()["m"]
    return max(int(med or 1), 1)


def intersect_intervals(a: DataFrame, b: DataFrame, bin_size: int | None = None, chrom: str = "chrom",
                        start: str = "start", end: str = "end") -> DataFrame:
    """Half-open overlap of every (a, b) pair on the same chrom -> a's columns
    with start/end cut to the overlap (``bedtools intersect -a A -b B``).
    ``bin_size`` is the unit of the bin widths (any gives the same result)."""
    unit = bin_size or 1
    a_cols = [c for c in a.columns]
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    ax = a.where(e > s).select(*[F.col(c).alias(f"a_{c}") for c in a_cols], s.alias("_as"), e.alias("_ae"), _level(s, e, unit).alias("_al"))
    bx = b.where(e > s).select(F.col(chrom).alias("b_chrom"), s.alias("_bs"), e.alias("_be"), _level(s, e, unit).alias("_bl"))
    # at most one row per power of four and side
    used = ax.select(F.lit(0).alias("side"), F.col("_al").alias("l")).unionByName(bx.select(F.lit(1).alias("side"), F.col("_bl").alias("l"))).distinct().collect()
    ax = _binned(ax, "_as", "_ae", "_al", sorted(r["l"] for r in used if r["side"] == 1), unit)
    bx = _binned(bx, "_bs", "_be", "_bl", sorted(r["l"] for r in used if r["side"] == 0), unit).withColumnsRenamed({"_l": "_lb", "_b": "_bb"})
    ov_s, ov_e = F.greatest("_as", "_bs"), F.least("_ae", "_be")
    j = ax.join(bx, (F.col(f"a_{chrom}") == F.col("b_chrom")) & (F.col("_l") == F.col("_lb")) & (F.col("_b") == F.col("_bb"))
                & (F.col("_as") < F.col("_be")) & (F.col("_bs") < F.col("_ae")))
    j = j.where((F.col("_l") == F.greatest("_al", "_bl")) & (F.col("_b") == F.floor(ov_s / _width(F.col("_l"), unit))))
    cut = {start: ov_s, end: ov_e}
    types = {f.name: f.dataType for f in a.schema.fields}
    wide = {c: "int" if types[c].simpleString() == "int" and dict(b.dtypes)[c] == "int" else "long" for c in cut}
    return j.select(*[cut[c].cast(wide[c]).alias(c) if c in cut else F.col(f"a_{c}").alias(c) for c in a_cols])
