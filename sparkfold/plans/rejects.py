"""What the permissive readers set aside (S3, S4, S11), per format.

Binding: documents are page-count lines, without a view count if they are
short; events are log rows, with an unreadable id for one event type; the
variant file holds contigs without a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.plans.genomics import _VARIANTS_SQL, vcf_lines
from sparkfold.plans.registry import query, table
from sparkfold.session import scratch_path
from sparkfold.sinks.text import write_lines
from sparkfold.sources.genomics import read_vcf
from sparkfold.sources.pagecounts import parse_pagecounts, rejected_pagecounts
from sparkfold.sources.retweetlog import LOG_COLUMNS, read_retweet_log, rejected_log_rows, write_retweet_log

SHORT = 500


def _counts(name: str, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    rows = accepted.select(F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(
        rejected.select(F.lit(0).alias("a"), F.lit(1).alias("r")))
    return rows.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("accepted"), F.coalesce(F.sum("r"), F.lit(0)).alias("rejected")) \
        .select(F.lit(name).alias("format"), "accepted", "rejected")


@query("reject_counts", oracle=_VARIANTS_SQL + f"""
SELECT 'pagecounts' AS format, count(*) FILTER (n_chars >= {SHORT}) AS accepted, count(*) FILTER (n_chars < {SHORT}) AS rejected FROM documents
UNION ALL SELECT 'retweet_log', count(*) FILTER (event_type <> 'signup'), count(*) FILTER (event_type = 'signup') FROM events
UNION ALL SELECT 'vcf', count(*) FILTER (chrom NOT IN ('chrM', 'chrUn_gl000220')), count(*) FILTER (chrom IN ('chrM', 'chrUn_gl000220')) FROM v
""")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each reader accepts and sets aside."""
    d = table(spark, sf_dir, "documents")
    lines = d.select(F.concat_ws(" ", F.lit("en.m"), F.col("doc_id").cast("string"),
                                 F.when(F.col("n_chars") >= SHORT, F.col("n_chars").cast("string"))).alias("value"))
    pages = _counts("pagecounts", parse_pagecounts(lines), rejected_pagecounts(lines))
    e = table(spark, sf_dir, "events")
    values = {"Language": "event_type", "Language-code": "event_type", "MaxRetweetCount": "event_id", "MinRetweetCount": "event_id",
              "RetweetCount": "event_id", "Text": "props"}
    columns = [(F.when(F.col("event_type") == "signup", F.lit("n/a")).otherwise(F.col("user_id").cast("string")) if c == "IDOfTweet"
                else F.col(values[c]).cast("string") if c in values else F.lit("0")).alias(c) for c in LOG_COLUMNS]
    log = write_retweet_log(e.select(*columns), scratch_path(spark, "reject-log"))
    tweets = _counts("retweet_log", read_retweet_log(spark, log), rejected_log_rows(spark, log))
    calls = write_lines(vcf_lines(spark, sf_dir), scratch_path(spark, "reject-vcf"))
    variants = _counts("vcf", *read_vcf(spark, calls))
    return pages.unionByName(tweets).unionByName(variants)
