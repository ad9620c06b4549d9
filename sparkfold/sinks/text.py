"""Plain text sinks (K1, K3, K7 building blocks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.session import scratch_path


def write_lines(df: DataFrame, path: str, line: Column | str = "value",
                compression: str | None = None, mode: str = "overwrite") -> str:
    """Write one text line per row; every task writes its own part file."""
    col = F.col(line) if isinstance(line, str) else line
    writer = df.select(col.alias("value")).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path


def render_lines(spark: SparkSession, df: DataFrame, name: str, line: Column | str = "value",
                 compression: str | None = None) -> str:
    """Write lines to a fresh folder under the shared checkpoint root."""
    return write_lines(df, scratch_path(spark, name), line, compression)


def write_sorted_lines(df: DataFrame, path: str, order: list, line: Column | str) -> str:
    """Globally sorted text (K7): range-partitioned sort, part files in key order."""
    col = F.col(line) if isinstance(line, str) else line
    df.orderBy(*order).select(col.alias("value")).write.mode("overwrite").text(path)
    return path
