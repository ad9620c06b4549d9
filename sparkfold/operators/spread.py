"""Spread report (A3, J1, A6, W2, P2-P4, O2): per-id count spread and
per-group totals over distinct rows.

Semantics kept from the retweet roll-up:

* ``count(id) = max(hi) - min(lo) + 1`` over every row of the id;
* rows are reduced to distinct ``(group, id, carry..., count)``;
* the group total sums ``count`` over those distinct rows *before* the
  ``count >= min_count`` filter (an id logged with two texts counts twice);
* output sorted by (group total desc, count desc).

Plan: both aggregates are hash aggregates with map-side partial stages, so a
hot id or a hot group is pre-combined before any shuffle.  The per-group
totals are joined back without a hint: AQE measures the aggregated side at
run time and broadcasts it when small, and otherwise keeps a sort-merge join
whose skewed partitions it splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_spread(df: DataFrame, id_col: str, hi: str, lo: str,
              count_col: str = "retweet_count") -> DataFrame:
    """Per id: max, min and ``max - min + 1``."""
    return (
        df.groupBy(id_col)
        .agg(F.max(hi).alias("max_count"), F.min(lo).alias("min_count"))
        .withColumn(count_col, F.col("max_count") - F.col("min_count") + 1)
    )


def spread_report(df: DataFrame, id_col: str, group: str, hi: str, lo: str,
                  carry: list[str], min_count: int = 2,
                  count_col: str = "retweet_count",
                  total_col: str = "group_total") -> DataFrame:
    """Distinct (group, id, carry) rows with the id spread and the group total; spread >= ``min_count``."""
    per_id = id_spread(df, id_col, hi, lo, count_col).select(id_col, count_col)
    rows = df.select(group, id_col, *carry).distinct().join(per_id, id_col)
    totals = rows.groupBy(group).agg(F.sum(count_col).alias(total_col))
    return (
        rows.join(totals, group)
        .where(F.col(count_col) >= min_count)
        .select(group, total_col, id_col, count_col, *carry)
        .orderBy(F.desc(total_col), F.desc(count_col))
    )
