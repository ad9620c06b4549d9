"""Broadcast behind a size check.

``small(df, max_rows)`` counts a dimension-like table (one cheap job) and
returns it with a broadcast hint only when it has at most ``max_rows`` rows;
otherwise the table is returned as is and the join stays a shuffle join
(AQE may still broadcast it at run time, and splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 1_000_000


def small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when ``df`` has at most ``max_rows`` rows (checked with one cheap job)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a small input over the cluster's default parallelism when
    it arrives in fewer partitions (one small file = one task); inputs that
    already have enough partitions are returned unchanged (no shuffle)."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
