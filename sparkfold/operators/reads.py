"""Alignment-record operators.

Steps that are often left to single-machine tools, as plain DataFrame
expressions and aggregates:

* quality decoding / re-encoding with split, translate and regex
  expressions (code-generated; no per-character lambda on the hot path);
* duplicate marking as "best read per (reference, 5' position, strand)"
  found by an aggregate with a map-side partial stage (a hot position is
  pre-combined on every mapper), then joined back;
* cleaning as a lookup of the sequence length (one row per reference
  sequence) and clipping;
* concordance as one union + group-by over the comparison keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phred offsets and the encoding threshold.
PHRED_OFFSET = 33
ILLUMINA_SHIFT = 31
SANGER_MAX = 60


def quality_chars(qual: Column) -> Column:
    """Quality string -> array of its characters (one linear split)."""
    return F.slice(F.split(qual, ""), 1, F.length(qual))


def decode_quals(qual: Column, offset: int = PHRED_OFFSET) -> Column:
    """Quality string -> array<int> of ``ascii(c) - offset``."""
    return F.when(F.length(qual) > 0, F.transform(quality_chars(qual), lambda c: F.ascii(c) - offset))


def _byte_sums(q: pd.Series) -> pd.Series:
    """Sum of the character codes of every string, vectorised per Arrow batch."""
    enc = q.fillna("").str.encode("latin-1", errors="replace")
    lens = enc.str.len().to_numpy(dtype=np.int64)
    buf = np.frombuffer(b"".join(enc.tolist()), dtype=np.uint8).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    sums = np.zeros(len(lens), dtype=np.int64)
    nz = lens > 0
    if nz.any():
        sums[nz] = np.add.reduceat(buf, starts[nz])
    return pd.Series(sums)


def quality_sum(qual: Column, offset: int = PHRED_OFFSET) -> Column:
    """Sum of decoded base qualities (no per-character lambda)."""
    return F.pandas_udf(_byte_sums, "long")(qual) - F.length(qual) * offset


def max_quality(qual: Column, offset: int = PHRED_OFFSET) -> Column:
    """Highest decoded quality, without a per-character lambda."""
    return F.when(F.length(qual) > 0, F.ascii(F.array_max(quality_chars(qual))) - offset)


def quality_encoding(reads: DataFrame, group: str, qual: str = "qual", first_only_by: str | None = None) -> DataFrame:
    """Per group, max decoded quality and the encoding guess
    (> 60 -> ILLUMINA, else SANGER).  ``first_only_by`` = order column to use
    only the first read of the group (the original behaviour)."""
    mq = max_quality(F.col(qual))
    if first_only_by:
        agg = F.min_by(mq, F.col(first_only_by))
    else:
        agg = F.max(mq)
    g = reads.groupBy(group).agg(agg.alias("max_qual"))
    return g.withColumn("encoding", F.when(F.col("max_qual") > SANGER_MAX, "ILLUMINA").otherwise("SANGER"))


def fix_quality(qual: Column, shift: int = ILLUMINA_SHIFT, offset: int = PHRED_OFFSET) -> tuple[Column, Column]:
    """every base quality lowered by ``shift``.  Returns (fixed string,
    invalid flag): invalid when a shifted quality would fall below zero
    (such characters are left as they are).  One ``translate`` and one
    ``rlike``: both code-generated, no per-character lambda."""
    lowest = offset + shift                      # first character that stays valid
    src = "".join(chr(c) for c in range(lowest, 127))
    dst = "".join(chr(c - shift) for c in range(lowest, 127))
    bad = qual.rlike("[\\x00-\\x%02x]" % (lowest - 1))
    return F.translate(qual, src, dst), bad


def with_read_groups(reads: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Constant read-group tags as columns."""
    return reads.withColumns({k: F.lit(v) for k, v in tags.items()})


def clip_lengths(cigar: Column) -> tuple[Column, Column]:
    """Leading / trailing clipped bases, hard and soft (0 when absent)."""
    def run(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(cigar, pattern, 1).try_cast("int"), F.lit(0))
    clipped = cigar.rlike("[HS]")                    # most reads have none
    lead = F.when(clipped, run(r"^(\d+)H") + run(r"^(?:\d+H)?(\d+)S")).otherwise(0)
    trail = F.when(clipped, run(r"(\d+)H$") + run(r"(\d+)S(?:\d+H)?$")).otherwise(0)
    return lead, trail


def five_prime(pos: Column, aln_end: Column, cigar: Column, reverse: Column) -> Column:
    lead, trail = clip_lengths(cigar)
    return F.when(reverse, aln_end + trail).otherwise(pos - lead)


def with_ends(reads: DataFrame) -> DataFrame:
    """``reads`` with strand, ``mapped``, 5' position and quality sum."""
    return (reads.withColumn("is_reverse", F.col("flag").bitwiseAND(16) != 0)
            .withColumn("mapped", F.col("flag").bitwiseAND(4) == 0)
            .withColumn("pos5", five_prime(F.col("pos"), F.col("aln_end"), F.col("cigar"), F.col("is_reverse")))
            .withColumn("qsum", quality_sum(F.col("qual"))))


def mark_duplicates(reads: DataFrame, name: str = "qname") -> DataFrame:
    """Among mapped reads with the same (rname, 5' position, strand), all
    but the one with the highest quality sum (then smallest name, flag,
    CIGAR and qualities) are duplicates.  Unmapped reads are never duplicates.

    Plan: one aggregate per key keeps the best (quality sum, name) pair --
    with a map-side partial stage, so a hot position is pre-combined on every
    mapper -- and one join brings the flag back to every read.
    """
    r = with_ends(reads)
    rank_key = F.struct((-F.col("qsum")).alias("nq"), F.col(name).alias("nm"), F.xxhash64("flag", "cigar", "qual").alias("tie"))
    keys = ["rname", "pos5", "is_reverse"]
    best = r.where("mapped").groupBy(*keys).agg(F.min(rank_key).alias("_best"))
    out = r.join(best, keys, "left")
    return out.withColumn("is_dup", F.col("mapped") & (rank_key != F.col("_best"))).drop("_best")


def templates(reads: DataFrame, name: str = "qname", library: str = "library") -> DataFrame:
    """One row per (library, name): ``reads``, ``mapped``, both 5' ends (``lo``, ``hi``: rname, pos5, strand) and the quality sum.

    A template with two mapped primary reads is a pair; its key is both ends in order.  All others are
    fragments.  Ends are a minimum and a maximum, so a name that a third of all reads carry is combined map-side."""
    primary = with_ends(reads.where(F.col("flag").bitwiseAND(0x900) == 0))
    end = F.when(F.col("mapped"), F.struct("rname", "pos5", "is_reverse"))
    return (primary.groupBy(F.col(library).alias("library"), F.col(name).alias("name"))
            .agg(F.count("*").alias("reads"), F.count_if("mapped").alias("mapped"), F.min(end).alias("lo"), F.max(end).alias("hi"),
                 F.sum(F.when(F.col("mapped"), F.col("qsum"))).alias("score")))


def mark_template_duplicates(found: DataFrame) -> DataFrame:
    """``templates`` with ``kind`` (pair, fragment, unmapped; ``other`` for more than two mapped reads) and ``is_dup``.

    Of pairs of one library with both ends equal, all but the one with the highest score (then smallest name) are duplicates.  Of
    fragments at one end, all but the best are; and all are where a pair has an end.  Others never are."""
    kind = (F.when(F.col("mapped") == 2, "pair").when(F.col("mapped") == 1, "fragment").when(F.col("mapped") == 0, "unmapped").otherwise("other"))
    t = found.withColumn("kind", kind)
    order = F.struct((-F.col("score")).alias("s"), "name")
    key = ["library", "kind", "lo", "hi"]
    best = t.where(F.col("kind").isin("pair", "fragment")).groupBy(*key).agg(F.min(order).alias("best"))
    taken = (t.where("kind = 'pair'").select("library", F.explode(F.array("lo", "hi")).alias("lo")).distinct()
             .withColumns({"taken": F.lit(True), "kind": F.lit("fragment")}))
    return (t.join(best, key, "left").join(taken, ["library", "kind", "lo"], "left")
            .withColumn("is_dup", F.col("best").isNotNull() & ((order != F.col("best")) | F.coalesce("taken", F.lit(False))))
            .drop("best", "taken"))


def library_size(pairs: Column, unique: Column) -> Column:
    """Distinct templates X in the library from which ``pairs`` draws gave ``unique`` ones: unique / X = 1 - exp(-pairs / X).

    Bisection on log2(X / unique); null without duplicates or without pairs."""
    n, c = pairs.cast("double"), unique.cast("double")

    def step(acc: Column, _: Column) -> Column:
        mid = (acc["a"] + acc["b"]) / 2
        x = c * F.pow(F.lit(2.0), mid)
        more = c / x - 1 + F.exp(-n / x) > 0               # the root lies at a larger X
        return F.struct(F.when(more, mid).otherwise(acc["a"]).alias("a"), F.when(more, acc["b"]).otherwise(mid).alias("b"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(F.lit(0.0).alias("a"), F.lit(64.0).alias("b")), step)
    return F.when((n > c) & (c > 0), F.round(c * F.pow(F.lit(2.0), found["a"])).cast("long"))


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    """One row per library of ``mark_template_duplicates``."""
    pair, single, dup = F.col("kind") == "pair", F.col("kind") == "fragment", F.col("is_dup")
    m = marked.groupBy("library").agg(
        F.count_if(single).alias("unpaired_examined"), F.count_if(pair).alias("pairs_examined"),
        F.sum(F.col("reads") - F.col("mapped")).alias("unmapped_reads"), F.count_if(single & dup).alias("unpaired_duplicates"),
        F.count_if(pair & dup).alias("pair_duplicates"))
    read = F.col("unpaired_examined") + 2 * F.col("pairs_examined")
    share = (F.col("unpaired_duplicates") + 2 * F.col("pair_duplicates")) / read
    return (m.withColumn("duplicate_share", F.when(read > 0, share))
            .withColumn("library_size", library_size(F.col("pairs_examined"), F.col("pairs_examined") - F.col("pair_duplicates"))))


def clean_alignments(reads: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """Clip alignment ends past the sequence end; MAPQ 0 for unmapped."""
    d = seq_dict.select(F.col("name").alias("rname"), F.col("length").alias("_len"))
    r = reads.join(d, "rname", "left")
    unmapped = F.col("flag").bitwiseAND(4) != 0
    end = F.when((F.col("_len") > 0) & (F.col("aln_end") > F.col("_len")), F.col("_len")).otherwise(F.col("aln_end"))
    mapq = F.when(unmapped, F.lit(0)).otherwise(F.col("mapq"))
    return (r.withColumn("clean_end", end.cast("int")).withColumn("clean_mapq", mapq)
            .withColumn("changed", (F.col("clean_end") != F.col("aln_end")) | (F.col("clean_mapq") != F.col("mapq")))
            .drop("_len"))


def concordance(ref: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``ref`` (total), found in ``other`` (matches),
    missing (diff) and keys only in ``other`` (extra) -- one shuffle."""
    u = (ref.select(*keys, F.lit(True).alias("a"), F.lit(False).alias("b"))
         .unionByName(other.select(*keys, F.lit(False).alias("a"), F.lit(True).alias("b"))))
    k = u.groupBy(*keys).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return k.agg(F.count_if("a").alias("total"), F.count_if(F.col("a") & F.col("b")).alias("matches"),
                 F.count_if(F.col("a") & ~F.col("b")).alias("diff"),
                 F.count_if(F.col("b") & ~F.col("a")).alias("extra"))
