"""Ordered CSV report (K1) and its reader.

The report is globally ordered (range-partitioned sort; part files follow
key order), has a header, and quotes every field that needs it, so text with
commas, quotes or newlines survives a read back with ``multiLine``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_OPTS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
         "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
         "nullValue": "\\N"}           # null -> \N, so an empty string stays an empty string


def write_report(df: DataFrame, path: str, order: list | None = None) -> str:
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").options(**_OPTS).option("emptyValue", '""').csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.options(**_OPTS).option("emptyValue", "").schema(schema).csv(path)
