"""Record-oriented genomics text sources.

All parsers take a DataFrame of text lines (``value``), so they work on
``spark.read.text`` output or on lines built by Spark; the ``read_*``
helpers add the scan.  Parsing is built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.ordinals import with_dense_index, with_file_ordinal

SAM_COLUMNS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
_SAM_INT = {"flag", "pos", "mapq", "pnext", "tlen"}

# CIGAR operations that consume the reference.
REF_CONSUMING = "MDN=X"


def cigar_ref_length(cigar: Column) -> Column:
    """Reference bases covered by a CIGAR string (M, D, N, =, X)."""
    lens = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{REF_CONSUMING}]"), 1)
    return F.aggregate(lens, F.lit(0), lambda acc, x: acc + x.cast("int"))


def parse_sam(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """SAM text -> 11 typed columns + ``aln_end``; header lines (``@``) skipped."""
    f = F.split(F.col(value_col), "\t")
    cols = []
    for i, c in enumerate(SAM_COLUMNS):
        v = F.get(f, i)
        cols.append((v.try_cast("int") if c in _SAM_INT else v).alias(c))
    sam = lines.where(~F.col(value_col).startswith("@")).select(*cols)
    return sam.withColumn("aln_end", F.col("pos") + cigar_ref_length(F.col("cigar")) - 1)


def sam_regions(sam: DataFrame, seq_dict: DataFrame, min_idx: int = 1, max_idx: int = 24) -> DataFrame:
    """Mapped reads whose reference index is in [min_idx, max_idx];
    ``region`` = that index.  ``seq_dict`` = (idx, name, length): one row per
    reference sequence, joined without a hint (AQE broadcasts it at run time)."""
    d = seq_dict.select(F.col("name").alias("rname"), F.col("idx").alias("ref_idx"))
    return (sam.join(d, "rname", "left")
            .where(((F.col("flag").bitwiseAND(4)) == 0) & F.col("ref_idx").between(min_idx, max_idx))
            .withColumn("region", F.col("ref_idx")))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text files -> typed reads."""
    return parse_sam(spark.read.text(path))


# ---- VCF --------------------------------------------------------------------

def chrom_number(chrom: Column) -> Column:
    """``chrN`` -> N, chrX -> 23, chrY -> 24, anything else -> null."""
    raw = F.substr(chrom, F.lit(4))
    return (F.when(raw == "X", F.lit(23)).when(raw == "Y", F.lit(24)).otherwise(raw.try_cast("int")))


def parse_vcf(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Body lines (``chr*``) -> (chr_num, pos, ref, alt, line).
    Returns (accepted, rejected): lines whose chromosome has no number
    (chrM, unplaced contigs) go to ``rejected`` instead of failing the job."""
    body = lines.where(F.col(value_col).startswith("chr"))
    f = F.split(F.col(value_col), "\t")
    p = body.select(chrom_number(F.get(f, 0)).alias("chr_num"), F.get(f, 1).try_cast("int").alias("pos"),
                    F.get(f, 0).alias("chrom"), F.get(f, 3).alias("ref"), F.get(f, 4).alias("alt"),
                    F.col(value_col).alias("line"))
    ok = F.col("chr_num").isNotNull() & F.col("pos").isNotNull()
    return p.where(ok), p.where(~ok)


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """VCF text files -> (accepted, rejected) variant rows."""
    return parse_vcf(spark.read.text(path))


# ---- sequence dictionary ----------------------------------------------------

def _tag(line: Column, name: str) -> Column:
    """The value of a ``NAME:value`` field of a tab-separated header line, wherever it stands."""
    return F.regexp_extract(line, rf"\t{name}:([^\t]*)", 1)


def read_sequence_dict(spark: SparkSession, path: str) -> DataFrame:
    """The ``@SQ`` lines, by tag: ``SN`` name and ``LN`` length (unparsable
    length -> 0); ``idx`` = 0-based position in (file, line) order."""
    lines = with_file_ordinal(spark.read.text(path)).where(F.col("value").startswith("@SQ\t"))
    parsed = lines.select("file", "line_no", _tag(F.col("value"), "SN").alias("name"),
                          F.coalesce(_tag(F.col("value"), "LN").try_cast("bigint"), F.lit(0)).alias("length"))
    return with_dense_index(parsed, ["file", "line_no"], "idx").select(F.col("idx").cast("int"), "name", "length")


# ---- BED --------------------------------------------------------------------

def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated chrom, start (0-based), end (exclusive), optional name."""
    schema = "chrom string, start long, end long, name string"
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").csv(path)
