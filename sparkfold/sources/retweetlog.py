"""Headered CSV retweet log (S2, S3) and its writer (K1/K2 layout).

Columns of the log, in order: Seconds, Language, Language-code,
TotalRetweetsInThatLang, IDOfTweet, MaxRetweetCount, MinRetweetCount,
RetweetCount, Text.  The reader takes every column as a string (no schema
inference pass) and casts by position; Seconds and the total are skipped.
Text is written quoted (RFC-4180 style), so commas, quotes and newlines in
text survive the round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header of the retweet log.
LOG_COLUMNS = ["Seconds", "Language", "Language-code", "TotalRetweetsInThatLang", "IDOfTweet",
               "MaxRetweetCount", "MinRetweetCount", "RetweetCount", "Text"]

_CSV_OPTS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _string_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in LOG_COLUMNS])


def _raw_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**_CSV_OPTS).schema(_string_schema()).csv(path)


def rejected_log_rows(spark: SparkSession, path: str) -> DataFrame:
    """S3: the rows that the permissive reader leaves out, all columns as text."""
    bad = [F.col(c).try_cast("bigint").isNull() for c in ("IDOfTweet", "MaxRetweetCount", "MinRetweetCount")]
    return _raw_log(spark, path).where(bad[0] | bad[1] | bad[2])


def read_retweet_log(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """Retweet-log CSV -> typed rows; ``permissive`` sets malformed rows aside
    (``rejected_log_rows``), ``failfast`` raises."""
    raw = _raw_log(spark, path)
    typed = raw.select(
        F.col("Language").alias("language"),
        F.col("`Language-code`").alias("language_code"),
        F.col("IDOfTweet").try_cast("bigint").alias("id"),
        F.col("MaxRetweetCount").try_cast("bigint").alias("max_count"),
        F.col("MinRetweetCount").try_cast("bigint").alias("min_count"),
        F.col("RetweetCount").try_cast("bigint").alias("count"),
        F.col("Text").alias("text"),
    )
    bad = F.col("id").isNull() | F.col("max_count").isNull() | F.col("min_count").isNull()
    if mode == "failfast":
        return typed.withColumn("id", F.when(bad, F.raise_error(F.lit("malformed log row")))
                                .otherwise(F.col("id")))
    return typed.where(~bad)


def write_retweet_log(df: DataFrame, path: str) -> str:
    """``df`` must carry the nine log columns under their header names."""
    df.select(*[F.col(f"`{c}`").cast("string") for c in LOG_COLUMNS]) \
      .write.mode("overwrite").options(**_CSV_OPTS).csv(path)
    return path
