"""Per-group total plus the top item of the group.

``top_per_group`` is the plan to use: one hash aggregate with a partial
(map-side) stage, so a hot group is pre-combined on every mapper and never
gathered into a single task.  The arg-max is ``max(struct(value, item))``,
which makes ties deterministic: the greatest item wins.

``top_per_group_window`` is the ranking formulation (``row_number`` over the
group ordered by value).  It returns the same rows and exists as the
differential twin.  The rank is limited to 1 (pre-filtered in every task) and
the total is an aggregate of its own, so no group meets in one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, key: str, item: str, value: str,
                  total_col: str = "total", top_item_col: str = "top_item",
                  top_value_col: str = "top_value") -> DataFrame:
    """Per ``key``: sum of ``value`` and the item with the largest value (ties: greatest item)."""
    best = F.max(F.struct(F.col(value).alias("v"), F.col(item).alias("i")))
    return (
        df.groupBy(key)
        .agg(F.sum(value).alias(total_col), best.alias("_best"))
        .select(key, total_col,
                F.col("_best.i").alias(top_item_col),
                F.col("_best.v").alias(top_value_col))
    )


def top_per_group_window(df: DataFrame, key: str, item: str, value: str,
                         total_col: str = "total", top_item_col: str = "top_item",
                         top_value_col: str = "top_value") -> DataFrame:
    """Same result through ``row_number`` over a per-key window (differential twin)."""
    ranked = Window.partitionBy(key).orderBy(F.col(value).desc(), F.col(item).desc())
    # a rank limit alone: Spark keeps one row per key and task before the shuffle
    first = (df.select(F.col(key).alias("_key"), F.col(item).alias(top_item_col), F.col(value).alias(top_value_col),
                       F.row_number().over(ranked).alias("_rn")).where(F.col("_rn") == 1))
    totals = df.groupBy(key).agg(F.sum(value).alias(total_col))
    return (totals.join(first, totals[key].eqNullSafe(F.col("_key")))
            .select(key, total_col, top_item_col, top_value_col))
