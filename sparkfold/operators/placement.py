"""Balanced placement and ordering of keyed records.

``greedy_groups``: largest key first onto the least-loaded of ``n`` groups
(ties: lowest group; equal weights: smaller key first), for any number of keys.

``place_and_sort``: records ordered by (group, sort keys).  The default is a
range partitioning on (group, sort keys): a hot group spans several
partitions instead of one task.  ``exact=True`` reproduces one partition per
group (``repartitionById``) for tools that need a whole group in one task.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.ordinals import with_dense_index


def key_counts(df: DataFrame, key: str, weight_col: str = "n") -> DataFrame:
    """Records per key, heaviest first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(weight_col)).orderBy(F.desc(weight_col), key)


def greedy_groups(counts: DataFrame, key: str, weight: str, n: int, group_col: str = "grp") -> DataFrame:
    """-> (key, weight, group) for every key of ``counts``.

    The rule looks at one key after the other, so one task streams the sorted
    (key, weight) rows past a heap of ``n`` loads; its memory does not grow
    with the number of keys, and each key costs log n steps."""
    ktype = counts.schema[key].dataType.simpleString()
    rows = counts.select(F.col(key).alias("k"), F.col(weight).cast("bigint").alias("w")).orderBy(F.desc("w"), "k").coalesce(1)

    def assign(batches):
        loads = [(0, g) for g in range(n)]
        for pdf in batches:
            groups = []
            for w in pdf["w"].tolist():
                load, g = loads[0]
                heapq.heapreplace(loads, (load + w, g))
                groups.append(g)
            yield pdf.assign(g=groups)
    return (rows.mapInPandas(assign, f"k {ktype}, w bigint, g int")
            .select(F.col("k").alias(key), F.col("w").alias(weight), F.col("g").alias(group_col)))


def assign_groups(df: DataFrame, groups: DataFrame, key: str, group_col: str = "grp") -> DataFrame:
    """Key -> group lookup (AQE broadcasts the map when it is measured to be small)."""
    return df.join(groups.select(key, group_col), key)


def place_and_sort(df: DataFrame, group_col: str, sort_cols: list, exact: bool = False,
                   n: int | None = None) -> DataFrame:
    """Order records by (group, sort keys): range placement by default, ``exact`` = one partition per group."""
    if exact:
        if n is None:
            raise ValueError("exact placement needs the number of groups")
        return df.repartitionById(n, F.col(group_col).cast("int")).sortWithinPartitions(*sort_cols)
    return df.repartitionByRange(group_col, *sort_cols).sortWithinPartitions(group_col, *sort_cols)


def rank_in_group(df: DataFrame, group_col: str, sort_cols: list, rank_col: str = "rank") -> DataFrame:
    """1-based position of each record inside its group in ``sort_cols`` order,
    from a distributed dense index (no per-group window)."""
    idx = with_dense_index(df, [group_col, *sort_cols], "_i")
    first = idx.groupBy(group_col).agg(F.min("_i").alias("_f"))
    return idx.join(first, group_col).withColumn(rank_col, F.col("_i") - F.col("_f") + 1).drop("_i", "_f")


def write_regions(df: DataFrame, path: str, group_col: str, sort_cols: list, exact: bool = False,
                  n: int | None = None) -> str:
    """K6: coordinate-sorted records, one folder per group (parquet)."""
    place_and_sort(df, group_col, sort_cols, exact, n).write.mode("overwrite").partitionBy(group_col).parquet(path)
    return path
