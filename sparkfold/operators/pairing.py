"""Positional pairing and chunking of records.

``interleave`` pairs the i-th record of one input with the i-th record of
the other by an equi-join on the record ordinal (no zip of partitions, so
both inputs may be split differently).  A record without a mate fails the
job through ``raise_error`` instead of silently mis-pairing.

``write_chunks`` spreads pairs round-robin over ``n`` partitions and writes
each as one gzip text file; a pair is one row, so it is never split across
chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.sources.fastq import fastq_text


def interleave(a: DataFrame, b: DataFrame, on: str = "ordinal", strict: bool = True) -> DataFrame:
    """-> (ordinal, pair): ``pair`` = record a + newline + record b (4+4 lines)."""
    ra = a.select(F.col(on), fastq_text("name", "sequence", "plus", "quality").alias("_r1"))
    rb = b.select(F.col(on), fastq_text("name", "sequence", "plus", "quality").alias("_r2"))
    j = ra.join(rb, on, "full_outer")
    missing = F.col("_r1").isNull() | F.col("_r2").isNull()
    pair = F.concat_ws("\n", "_r1", "_r2")
    if strict:
        pair = F.when(missing, F.raise_error(F.concat(F.lit("unpaired record at ordinal "),
                                                      F.col(on).cast("string")))).otherwise(pair)
    else:
        j = j.where(~missing)
    return j.select(on, pair.alias("pair"))


def write_chunks(pairs: DataFrame, n: int, path: str, col: str = "pair") -> str:
    """Round-robin into ``n`` partitions, one gzip text chunk each."""
    pairs.select(col).repartition(n).write.mode("overwrite").option("compression", "gzip").text(path)
    return path
