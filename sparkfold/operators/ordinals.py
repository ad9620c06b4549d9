"""Distributed ordinals (W3, W4, J6 building blocks).

``with_dense_index`` numbers rows 0..n-1 in a given total order without a
single-partition window: a range-partitioned sort, a per-partition count
(one row per partition), prefix sums over that tiny table, and a join back.
The tagged, sorted data is checkpointed to the shared checkpoint folder so
partition ids and positions stay fixed if a task is retried.

``with_file_ordinal`` numbers the lines of every text file in file order
without any sort: rows of one file split are contiguous and in order inside
a scan partition, so the ordinal is (rows of earlier splits of the same
file) + (position inside the split).  Only a per-split summary is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.session import checkpoint_root

_ROW_BITS = 33  # monotonically_increasing_id = partition << 33 | row


def _position_in_partition() -> Column:
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), _ROW_BITS)


def with_dense_index(df: DataFrame, order: list, name: str = "idx", start: int = 0) -> DataFrame:
    """Add ``name`` = rank of the row in ``order`` (ties: any stable order)."""
    checkpoint_root(df.sparkSession)
    tagged = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", _position_in_partition())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition of the sorted data: bounded by the partition count
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_pos") + F.lit(start))
        .drop("_pid", "_pos", "_off")
    )


def with_file_ordinal(lines: DataFrame, name: str = "line_no", file_col: str = "file") -> DataFrame:
    """Lines of a text scan -> (file, line_no, value...); ``line_no`` from 0 per file.

    ``lines`` must come straight from a file scan (``spark.read.text``) so that
    its hidden ``_metadata`` column is available.
    """
    tagged = lines.select(
        "*",
        F.col("_metadata.file_path").alias(file_col),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = tagged.groupBy(file_col, "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(file_col).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(file_col, "_blk", "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        tagged.join(splits, [file_col, "_blk"])
        .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first"))
        .drop("_blk", "_mid", "_first", "_off")
    )
