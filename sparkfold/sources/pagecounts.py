"""Space-delimited page-count lines -> (language_code, page_title, view_count).

Line layout: ``<project> <title> <views> [ignored...]``; the language is the
project text up to its first dot, so ``en``, ``en.m`` and ``en.b`` merge.
Rows whose title equals the language code are dropped.

``mode="permissive"`` sets short / non-numeric lines aside (``rejected_pagecounts``
gives them back, to be counted or kept); ``mode="failfast"`` raises on them (the
behaviour of a strict parser).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_pagecounts(lines: DataFrame, mode: str = "permissive", value_col: str = "value") -> DataFrame:
    """Page-count text lines -> (language_code, page_title, view_count)."""
    parts = F.split(F.col(value_col), " ")
    parsed = lines.select(
        F.substring_index(F.get(parts, 0), ".", 1).alias("language_code"),
        F.get(parts, 1).alias("page_title"),
        F.get(parts, 2).try_cast("bigint").alias("view_count"),
    )
    bad = F.col("page_title").isNull() | F.col("view_count").isNull()
    if mode == "failfast":
        parsed = parsed.withColumn(
            "view_count",
            F.when(bad, F.raise_error(F.lit("malformed page-count line"))).otherwise(F.col("view_count")),
        )
    elif mode == "permissive":
        parsed = parsed.where(~bad)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return parsed.where(F.col("language_code") != F.col("page_title"))


def rejected_pagecounts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines that the permissive parser leaves out as malformed, whole."""
    parts = F.split(F.col(value_col), " ")
    bad = F.get(parts, 1).isNull() | F.get(parts, 2).try_cast("bigint").isNull()
    return lines.where(bad)


def read_pagecounts(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """Read page-count text files (any Hadoop-FS path) and parse them."""
    return parse_pagecounts(spark.read.text(path), mode=mode)
