"""Queries over page-view and retweet style logs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkfold.functions.langid import fit_and_identify
from sparkfold.functions.langnames import with_language_name
from sparkfold.functions.text import clean_social_text, strip_newlines
from sparkfold.operators.spread import id_spread, spread_report
from sparkfold.operators.topgroup import top_per_group, top_per_group_window
from sparkfold.plans.registry import query, table
from sparkfold.session import scratch_path
from sparkfold.sinks.text import render_lines
from sparkfold.sources.pagecounts import parse_pagecounts, read_pagecounts
from sparkfold.sources.retweetlog import read_retweet_log, write_retweet_log


def pagecount_lines(spark: SparkSession, sf_dir: str):
    """documents -> ``<lang>.<source> <title> <n_chars> <doc_id>`` lines.

    A document is titled by its id; one whose length is divisible by 10 is the
    front page of its language and bears its code."""
    d = table(spark, sf_dir, "documents")
    title = F.when(F.col("n_chars") % 10 == 0, F.col("lang")).otherwise(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))
    return d.select(F.concat_ws(" ", F.concat_ws(".", "lang", "source"), title,
                                F.col("n_chars").cast("string"),
                                F.col("doc_id").cast("string")).alias("value"))


_PAGEVIEWS_ORACLE = r"""
WITH pv AS (
  SELECT split_part(lang || '.' || source, '.', 1) AS language_code,
         CASE WHEN n_chars % 10 = 0 THEN lang ELSE 'doc_' || doc_id END AS page_title,
         n_chars AS view_count
  FROM documents),
f AS (SELECT * FROM pv WHERE language_code <> page_title),
r AS (SELECT *, row_number() OVER (PARTITION BY language_code
                                   ORDER BY view_count DESC, page_title DESC) AS rn,
             sum(view_count) OVER (PARTITION BY language_code) AS tot
      FROM f)
SELECT language_code,
       CASE language_code WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French'
            WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' ELSE language_code END AS language,
       CAST(tot AS BIGINT) AS total_views, page_title AS top_page, view_count AS top_views
FROM r WHERE rn = 1
"""


@query("pageviews_top", oracle=_PAGEVIEWS_ORACLE)
def pageviews_top(spark: SparkSession, sf_dir: str):
    """Text scan -> parse -> total + arg-max per language."""
    path = render_lines(spark, pagecount_lines(spark, sf_dir), "pagecounts")
    pv = read_pagecounts(spark, path)
    top = top_per_group(pv, "language_code", "page_title", "view_count",
                        total_col="total_views", top_item_col="top_page", top_value_col="top_views")
    return with_language_name(top, "language_code").orderBy(F.desc("total_views"))


@query("pageviews_top_window", oracle=_PAGEVIEWS_ORACLE)
def pageviews_top_window(spark: SparkSession, sf_dir: str):
    """The same report through the ranking-window formulation."""
    pv = parse_pagecounts(pagecount_lines(spark, sf_dir))
    top = top_per_group_window(pv, "language_code", "page_title", "view_count",
                               total_col="total_views", top_item_col="top_page", top_value_col="top_views")
    return with_language_name(top, "language_code").orderBy(F.desc("total_views"))


def retweet_rows(spark: SparkSession, sf_dir: str):
    """events as a retweet log: user = tweet id, event type = language code,
    props = text, truncated value = retweet count (max = min = count)."""
    e = table(spark, sf_dir, "events")
    rc = F.col("value").cast("bigint")
    return e.select(F.col("event_type").alias("language_code"), F.col("user_id").alias("id"),
                    rc.alias("max_count"), rc.alias("min_count"), rc.alias("count"),
                    F.col("props").alias("text"), F.col("ts"))


_RETWEET_COUNTS_ORACLE = """
SELECT user_id AS id, max(trunc(value)::BIGINT) AS max_count, min(trunc(value)::BIGINT) AS min_count,
       max(trunc(value)::BIGINT) - min(trunc(value)::BIGINT) + 1 AS retweet_count
FROM events GROUP BY user_id
"""


@query("retweet_counts", oracle=_RETWEET_COUNTS_ORACLE)
def retweet_counts(spark: SparkSession, sf_dir: str):
    """Per-id max/min and spread."""
    return id_spread(retweet_rows(spark, sf_dir), "id", "max_count", "min_count")


_RETWEET_REPORT_ORACLE = """
WITH e AS (SELECT event_type AS language_code, user_id AS id, trunc(value)::BIGINT AS rc, props AS text
           FROM events),
per_id AS (SELECT id, max(rc) - min(rc) + 1 AS retweet_count FROM e GROUP BY id),
d AS (SELECT DISTINCT e.language_code, e.id, e.text, p.retweet_count FROM e JOIN per_id p USING (id)),
t AS (SELECT *, sum(retweet_count) OVER (PARTITION BY language_code) AS total FROM d)
SELECT language_code AS language, language_code, total::BIGINT AS total_retweets_in_lang,
       id, retweet_count, text
FROM t WHERE retweet_count > 1
"""


def _retweet_report(rows):
    rep = spread_report(rows, "id", "language_code", "max_count", "min_count", ["text"],
                        min_count=2, total_col="total_retweets_in_lang")
    return with_language_name(rep, "language_code").select(
        "language", "language_code", "total_retweets_in_lang", "id", "retweet_count", "text")


@query("retweet_report", oracle=_RETWEET_REPORT_ORACLE)
def retweet_report(spark: SparkSession, sf_dir: str):
    """Spread per id, distinct rows, group totals."""
    return _retweet_report(retweet_rows(spark, sf_dir))


@query("retweet_report_csv", oracle=_RETWEET_REPORT_ORACLE)
def retweet_report_csv(spark: SparkSession, sf_dir: str):
    """Write the log as headered CSV, read it back by position."""
    rows = retweet_rows(spark, sf_dir)
    log = with_language_name(rows, "language_code", "Language").select(
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("Seconds"),
        "Language", F.col("language_code").alias("Language-code"),
        F.lit(0).alias("TotalRetweetsInThatLang"), F.col("id").alias("IDOfTweet"),
        F.col("max_count").alias("MaxRetweetCount"), F.col("min_count").alias("MinRetweetCount"),
        F.col("count").alias("RetweetCount"), F.col("text").alias("Text"))
    path = write_retweet_log(log, scratch_path(spark, "retweet-log"))
    return _retweet_report(read_retweet_log(spark, path, mode="failfast"))


_LANGUAGE_NAMES_ORACLE = """
SELECT code AS language_code,
       CASE code WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German'
                 WHEN 'es' THEN 'Spanish' ELSE code END AS language
FROM (SELECT lang AS code FROM documents UNION SELECT event_type FROM events)
"""


@query("language_names", oracle=_LANGUAGE_NAMES_ORACLE)
def language_names(spark: SparkSession, sf_dir: str):
    """Code -> English name, unknown code -> itself."""
    codes = (table(spark, sf_dir, "documents").select(F.col("lang").alias("language_code"))
             .union(table(spark, sf_dir, "events").select(F.col("event_type").alias("language_code")))
             .distinct())
    return with_language_name(codes, "language_code")


_CLEAN_TEXT_ORACLE = r"""
SELECT doc_id,
       regexp_replace(
         regexp_replace(
           regexp_replace(regexp_replace(text, 'RT', ''), '@\p{L}+', '', 'g'),
           'https?://\S+\s?', '', 'g'),
         '\r|\n', ' ', 'g') AS clean_text
FROM documents
"""


@query("clean_text", oracle=_CLEAN_TEXT_ORACLE)
def clean_text(spark: SparkSession, sf_dir: str):
    """First RT, letter handles and URLs removed; newlines -> blanks."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", strip_newlines(clean_social_text(F.col("text"))).alias("clean_text"))


_LANGID_ORACLE = r"""
WITH c AS (SELECT doc_id, lang, regexp_replace(regexp_replace(regexp_replace(text, 'RT', ''), '@\p{L}+', '', 'g'),
                                                'https?://\S+\s?', '', 'g') AS text FROM documents),
d AS (SELECT doc_id, lang, text, ' ' || regexp_replace(text, '[\t\n\r ]+', ' ', 'g') || ' ' AS t FROM c),
g AS (SELECT doc_id, lang, substr(t, i::INT, 3) AS tri FROM d, range(1, length(t) - 1) r(i) WHERE length(t) >= 3),
pc AS (SELECT lang, tri, count(*) AS c FROM g GROUP BY lang, tri),
pt AS (SELECT lang, sum(c) AS n FROM pc GROUP BY lang),
pf AS (SELECT lang, tri, c / n AS f FROM pc JOIN pt USING (lang)),
nr AS (SELECT lang, sum(f * f) AS norm FROM pf GROUP BY lang),
fb AS (SELECT lang, norm FROM nr ORDER BY norm, lang LIMIT 1),
dc AS (SELECT doc_id, tri, count(*) AS c FROM g GROUP BY doc_id, tri),
dn AS (SELECT doc_id, sum(c) AS n FROM dc GROUP BY doc_id),
dt AS (SELECT dc.doc_id, pf.lang, sum(dc.c / dn.n * pf.f) AS dot
       FROM dc JOIN dn USING (doc_id) JOIN pf USING (tri) GROUP BY dc.doc_id, pf.lang),
sc AS (SELECT doc_id, lang, round(norm - 2 * dot, 9) AS s FROM dt JOIN nr USING (lang)
       UNION ALL SELECT doc_id, fb.lang, round(fb.norm, 9) FROM d, fb),
best AS (SELECT doc_id, arg_min(lang, (s, lang)) AS l FROM sc GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN l = 'lt' AND regexp_matches(text, '\p{Hiragana}') THEN 'ja'
            WHEN l = 'lt' AND regexp_matches(text, '\p{Hangul}') THEN 'ko' ELSE l END AS predicted
FROM d JOIN best USING (doc_id)
"""


@query("language_id", oracle=_LANGID_ORACLE)
def language_id(spark: SparkSession, sf_dir: str):
    """Trigram profiles fitted on the labelled documents, then every
    document scored against every language profile it shares trigrams with."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return fit_and_identify(d)
