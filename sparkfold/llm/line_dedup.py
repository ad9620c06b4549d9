"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate, however often one site
repeats it.  Per line hash (128 bits), HyperLogLog sketches of the sites are
merged by aggregation.  A sketch far from the threshold decides; lines within
``3`` standard errors of it get exact distinct counts.  Of a boilerplate line
the first occurrence (smallest document id, then position) stays, all others
are removed, so that the original of a group of copies keeps its text.

Thresholds: ``min_sites`` sites; for lines of at least ``long_words`` words, which
do not repeat by chance, ``long_min_sites``.  Lines are compared without
leading and trailing white space; lines without a character other than white
space are never removed.  With ``whole_share``, documents that would lose that
share of their characters or more are copies rather than pages with boilerplate:
they keep all lines, for a later stage that compares documents.

Scale: sketches are combined before the shuffle, so a line found in a third
of all documents is one row per task; line rows are 30 bytes wide; the text
moves once, for the join by document.

Cases.  Null text: stays null, no lines.  Null site: a site of its own.  A row
with a null id passes unchanged and is not counted.  Rows repeated with one id
are treated alike.  Further columns pass through; those named as the two
counts are replaced by them.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import free_name, settled

LG_K = 12                                   # sketch size 2^12: relative standard error 1.04 / 64
STD_ERROR = 1.04 / 2 ** (LG_K / 2)
KEY = ["h1", "h2"]


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(doc, pos, site, h1, h2, long) for every line with content."""
    return (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("doc"), F.coalesce(F.col(site_col).cast("string"), F.lit("\0")).alias("site"),
                    F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "raw"))
            .select("doc", "site", "pos", _trimmed(F.col("raw")).alias("line")).where("line <> ''")
            .select("doc", "pos", "site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
                    _words(F.col("line")).alias("words")))


def boilerplate_lines(lines: DataFrame, min_sites: int, long_words: int, long_min_sites: int) -> DataFrame:
    """(h1, h2, first) of the lines whose site spread reaches the threshold; ``first``: where the line stays."""
    spread = settled(
        lines.groupBy(*KEY).agg(
            F.hll_sketch_agg("site", LG_K).alias("sketch"), F.max("words").alias("words"),
            F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n"))
        .select(*KEY, "first", "n", F.when(F.col("words") >= long_words, long_min_sites).otherwise(min_sites).alias("least"),
                F.hll_sketch_estimate("sketch").alias("estimate"))
        .where("n >= least"), "line-spread")
    margin = 3 * STD_ERROR * F.col("least")
    sure = spread.where(F.col("estimate") > F.col("least") + margin)
    near = spread.where(F.abs(F.col("estimate") - F.col("least")) <= margin)
    exact = (lines.select(*KEY, "site").join(near.select(*KEY), KEY, "left_semi").distinct()
             .groupBy(*KEY).agg(F.count("*").alias("sites")))
    return (sure.select(*KEY, "first")
            .unionByName(near.join(exact, KEY).where("sites >= least").select(*KEY, "first")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = 4, long_words: int = 8, long_min_sites: int = 2, whole_share: float | None = None,
                lines_col: str = "n_lines", removed_col: str = "n_removed") -> DataFrame:
    """``docs`` with the cleaned text, plus ``lines_col`` and ``removed_col``: the lines before, and those removed."""
    lines = settled(line_rows(docs, id_col, text_col, site_col), "lines")
    found = settled(boilerplate_lines(lines, min_sites, long_words, long_min_sites), "boilerplate")
    drop_doc, drop_pos = free_name(docs, "_drop_doc"), free_name(docs, "_drop_pos")
    drops = (lines.select("doc", "pos", *KEY).join(found, KEY)
             .where((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos")))
             .groupBy(F.col("doc").alias(drop_doc)).agg(F.collect_set("pos").alias(drop_pos)))
    joined = docs.join(drops, docs[id_col] == F.col(drop_doc), "left")
    pieces, gone = F.split(text_col, "\n", -1), F.col(drop_pos)
    left = F.sort_array(F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), gone))
    cleaned = F.when(gone.isNotNull(), F.array_join(F.transform(left, lambda i: F.get(pieces, i)), "\n"))
    if whole_share is not None:
        cleaned = F.when(F.length(text_col) - F.length(cleaned) < whole_share * F.length(text_col), cleaned)
    text = free_name(joined, "_cleaned")
    hit = F.col(text).isNotNull()
    return (joined.withColumn(text, cleaned)
            .withColumn(lines_col, F.when(F.col(text_col).isNull(), 0).otherwise(F.size(pieces)).cast("long"))
            .withColumn(removed_col, F.when(hit, F.size(drop_pos)).otherwise(0).cast("long"))
            .withColumn(text_col, F.when(hit, F.col(text)).otherwise(F.col(text_col))).drop(drop_doc, drop_pos, text))
