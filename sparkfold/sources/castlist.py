"""Blank-line separated cast lists in ISO-8859-1.

A record is the text between two ``\\n\\n`` separators; its first line is
``<name>\\t...<title>`` and the next lines ``\\t\\t\\t<title>``.  Hadoop's
line reader with a custom separator splits files at any byte offset and
still returns whole records, so the scan stays parallel; the Latin-1 bytes
are decoded after the scan.

Marker trimming (S6) keeps the text after the first line equal to
``----\\t\\t\\t------`` and before the next line of 77 dashes, per file.  It
works on records, not lines: records are numbered in file order (no sort),
the records holding the markers are found with a per-file aggregate and the
cut happens inside those two records only.

Title rule (first-parenthesis, as in the original format reader): take the
text after the last tab; drop titles starting with a double quote (TV); the
four characters after the *first* ``(`` must be digits >= ``min_year``; the
title is cut after those four characters and closed with ``)``.  With
``strict_year=True`` the last ``(dddd`` group decides instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.ordinals import with_file_ordinal
from sparkfold.session import stored

# preamble/epilogue markers of the cast-list format.
START_MARKER = "----\t\t\t------"
END_MARKER = "-" * 77
RECORD_SEP = "\n\n"


def clean_title(line: Column, min_year: int = 2011, strict_year: bool = False) -> Column:
    """Valid title of one cast-list line, or null."""
    # the last tab field, not quoted, up to "(dddd": at its first parenthesis, or (strict) at the last that fits
    before = r"[^\t]*" if strict_year else r"[^\t(]*"
    pattern = rf'(?:^|\t)(?!")({before}\(([0-9]{{4}}))[^\t]*$'
    year = F.regexp_extract(line, pattern, 2).try_cast("int")
    return F.when(year >= min_year, F.concat(F.regexp_extract(line, pattern, 1), F.lit(")")))


def parse_cast_records(records: DataFrame, text_col: str = "text", min_year: int = 2011,
                       strict_year: bool = False) -> DataFrame:
    """record text -> (name, movies array<string>); records without a valid title dropped."""
    # the lines' titles as in ``clean_title``, all found in one pass over the record; a title ends in its year
    before = r"[^\t\n]*" if strict_year else r"[^\t\n(]*"
    found = F.regexp_extract_all(F.col(text_col), F.lit(rf'(?md)(?:^|\t)(?!")({before}\([0-9]{{4}})[^\t\n]*$'), F.lit(1))
    valid = F.filter(found, lambda t: F.right(t, F.lit(4)).cast("int") >= min_year)
    movies = F.transform(valid, lambda t: F.concat(t, F.lit(")")))
    keep = [c for c in records.columns if c != text_col]
    return (
        records.select(*keep, F.substring_index(F.substring_index(F.col(text_col), "\n", 1), "\t", 1).alias("name"),
                       movies.alias("movies"))
        .where(F.size("movies") > 0)
    )


def scan_records(spark: SparkSession, path: str, charset: str = "ISO-8859-1") -> DataFrame:
    """Blank-line separated records with their file and record number, decoded from ``charset``."""
    raw = spark.read.option("lineSep", RECORD_SEP).text(path)
    # numbered and decoded once: whoever looks for markers and records reads the compressed copy, not the text again
    numbered = with_file_ordinal(raw, name="rec_no")
    return stored(numbered.select("file", "rec_no", F.decode(F.col("value").cast("binary"), charset).alias("text")), "cast-records")


def trim_markers(records: DataFrame, text_col: str = "text", start: str = START_MARKER,
                 end: str = END_MARKER) -> DataFrame:
    """Keep, per file, the text strictly between the first start-marker line
    and the first end-marker line after it (records ordered by ``rec_no``)."""
    s, e = _quote(start), _quote(end)
    after_start = F.regexp_extract(F.col(text_col), r"(?s)^(?:.*?\n)?" + s + r"(?:\n(.*))?$", 1)
    before_end = F.regexp_extract(F.col(text_col), r"(?s)^(?:(.*?)\n)?" + e + r"(?:\n.*)?$", 1)
    r = records.withColumn("_has_start", F.col(text_col).contains(start) & F.col(text_col).rlike("(?m)^" + s + "$"))
    # one row per file: where the body starts
    first_start = r.where("_has_start").groupBy("file").agg(F.min("rec_no").alias("_s"))
    r = r.join(first_start, "file").where(F.col("rec_no") >= F.col("_s"))
    r = r.withColumn(text_col, F.when(F.col("rec_no") == F.col("_s"), after_start).otherwise(F.col(text_col)))
    r = r.withColumn("_has_end", F.col(text_col).contains(end) & F.col(text_col).rlike("(?m)^" + e + "$"))
    first_end = r.where("_has_end").groupBy("file").agg(F.min("rec_no").alias("_e"))
    r = r.join(first_end, "file", "left").where(F.col("_e").isNull() | (F.col("rec_no") <= F.col("_e")))
    r = r.withColumn(text_col, F.when(F.col("rec_no") == F.col("_e"), before_end).otherwise(F.col(text_col)))
    return r.drop("_has_start", "_has_end", "_s", "_e")


def _quote(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r"\.^$|?*+()[]{}-" else ("\\t" if ch == "\t" else ch))
    return "".join(out)


def read_cast_list(spark: SparkSession, path: str, min_year: int = 2011, strict_year: bool = False,
                   trim: bool = True, charset: str = "ISO-8859-1") -> DataFrame:
    """path -> (file, rec_no, name, movies).  Trims preamble/epilogue first."""
    recs = scan_records(spark, path, charset)
    if trim:
        recs = trim_markers(recs)
    return parse_cast_records(recs, min_year=min_year, strict_year=strict_year)
