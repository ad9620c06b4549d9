"""FASTQ, pairing, chunk, report and external-program queries.

Bindings: ``documents`` become one FASTQ file set (letters of the whole text
mapped onto A/C/G/T, qualities derived from the bases so that quality lines
often start with ``@`` or ``+``); every ``conversations`` turn becomes a read
pair (mate 2 = reversed mate 1); ``customer`` rows become one text folder per
nation for the per-file program fan-out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.external import list_files, observed, pipe_files, pipe_partitions
from sparkfold.operators.pairing import interleave, write_chunks
from sparkfold.operators.placement import assign_groups, greedy_groups, key_counts, place_and_sort
from sparkfold.plans.genomics import _GREEDY_SQL, N_GROUPS, regions
from sparkfold.plans.registry import query, table
from sparkfold.session import scratch_path
from sparkfold.sinks.chunks import read_task_log, write_chunk_files
from sparkfold.sinks.report import read_report, write_report
from sparkfold.sources.fastq import fastq_text, read_fastq, with_record_ordinal

# Letter -> base mapping and base -> quality character.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = "ACGT" * 13
QUAL_OF_BASE = ("ACGT", "@+I#")


def bases(text):
    return F.regexp_replace(F.translate(text, LETTERS, BASES), "[^ACGT]", "")


def quals(seq):
    return F.translate(seq, *QUAL_OF_BASE)


_SEQ_SQL = f"regexp_replace(translate({{t}}, '{LETTERS}', '{BASES}'), '[^ACGT]', '', 'g')"


def _seq_sql(t: str) -> str:
    return _SEQ_SQL.format(t=t)


def _qual_sql(s: str) -> str:
    return f"translate({s}, '{QUAL_OF_BASE[0]}', '{QUAL_OF_BASE[1]}')"


def _write_fastq(df: DataFrame, path: str, order: list | None = None) -> str:
    """Records as FASTQ text; ``order`` only when file order matters (mates)."""
    out = df.orderBy(*order) if order else df
    out.select(fastq_text("name", "sequence", "plus", "quality").alias("value")).write.mode("overwrite").text(path)
    return path


@query("fastq_roundtrip", oracle=f"""
SELECT '@doc' || doc_id AS name, {_seq_sql('text')} AS sequence, '+' AS plus,
       {_qual_sql(_seq_sql('text'))} AS quality, true AS complete
FROM documents
""")
def fastq_roundtrip(spark: SparkSession, sf_dir: str):
    """Documents -> FASTQ files -> byte-range splits with resync -> records."""
    d = table(spark, sf_dir, "documents")
    seq = bases(F.col("text"))
    recs = d.select(F.concat(F.lit("@doc"), F.col("doc_id").cast("string")).alias("name"),
                    seq.alias("sequence"), F.lit("+").alias("plus"), quals(seq).alias("quality"))
    path = _write_fastq(recs, scratch_path(spark, "fastq-docs"))
    r = read_fastq(spark, path)
    return r.select("name", "sequence", "plus", "quality", "complete")


def _mates(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "conversations")
    seq = bases(F.col("text"))
    base = F.concat(F.lit("@c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    m1 = c.select("conv_id", "turn", F.concat(base, F.lit("/1")).alias("name"), seq.alias("sequence"),
                  F.lit("+").alias("plus"), quals(seq).alias("quality"))
    m2 = c.select("conv_id", "turn", F.concat(base, F.lit("/2")).alias("name"), F.reverse(seq).alias("sequence"),
                  F.lit("+").alias("plus"), quals(F.reverse(seq)).alias("quality"))
    root = scratch_path(spark, "fastq-pairs")
    p1 = _write_fastq(m1, f"{root}/fastq1", ["conv_id", "turn"])
    p2 = _write_fastq(m2, f"{root}/fastq2", ["conv_id", "turn"])
    a = with_record_ordinal(read_fastq(spark, p1))
    b = with_record_ordinal(read_fastq(spark, p2))
    return a, b


_PAIRS_SQL = f"""
WITH c AS (SELECT conv_id, turn, {_seq_sql('text')} AS s FROM conversations),
m AS (SELECT conv_id, turn,
             '@c' || conv_id || '_' || turn || '/1' || chr(10) || s || chr(10) || '+' || chr(10) || {_qual_sql('s')}
               AS r1,
             '@c' || conv_id || '_' || turn || '/2' || chr(10) || reverse(s) || chr(10) || '+' || chr(10)
               || {_qual_sql('reverse(s)')} AS r2
      FROM c)
"""


@query("paired_interleave", oracle=_PAIRS_SQL + """
SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS ordinal, r1 || chr(10) || r2 AS pair FROM m
""")
def paired_interleave(spark: SparkSession, sf_dir: str):
    """I-th record of file 1 with i-th record of file 2."""
    a, b = _mates(spark, sf_dir)
    return interleave(a, b)


@query("paired_chunks", oracle=_PAIRS_SQL + f"""
, c2 AS (SELECT conv_id, turn, {_seq_sql('text')} AS s FROM conversations)
SELECT '@c' || conv_id || '_' || turn || '/1' AS name, s AS sequence, '+' AS plus, {_qual_sql('s')} AS quality
FROM c2
UNION ALL
SELECT '@c' || conv_id || '_' || turn || '/2', reverse(s), '+', {_qual_sql('reverse(s)')} FROM c2
""")
def paired_chunks(spark: SparkSession, sf_dir: str):
    """Interleaved pairs -> gzip chunks (at least 4, about one per
    million pairs, so a chunk task stays bounded) -> read back as records."""
    a, b = _mates(spark, sf_dir)
    n_pairs = table(spark, sf_dir, "conversations").count()
    n_chunks = max(4, -(-n_pairs // 1_000_000))
    path = write_chunks(interleave(a, b), n_chunks, scratch_path(spark, "chunks"))
    back = read_fastq(spark, path)
    return back.select("name", "sequence", "plus", "quality")


@query("chunk_files", oracle=_PAIRS_SQL + f"""
, c2 AS (SELECT conv_id, turn, {_seq_sql('text')} AS s FROM conversations),
size AS (SELECT greatest(4, CAST(ceil(count(*) / 1000000.0) AS BIGINT)) AS n FROM conversations),
named AS (SELECT conv_id % n AS chunk, '@c' || conv_id || '_' || turn || '/1' AS name FROM c2, size)
SELECT CAST(chunk AS INT) AS "partition", 'chunk' || chunk || '.fq.gz' AS file, count(*) AS "rows", 2 * count(*) AS records,
  min(name) AS first_name, max(name) AS last_name FROM named GROUP BY chunk
""")
def chunk_files(spark: SparkSession, sf_dir: str):
    """Pairs by conversation into numbered chunk files, committed as a whole; the task log beside what is read back."""
    a, b = _mates(spark, sf_dir)
    n = max(4, -(-table(spark, sf_dir, "conversations").count() // 1_000_000))
    pairs = interleave(a, b).withColumn("chunk", (F.regexp_extract("pair", "^@c([0-9]+)_", 1).cast("long") % n).cast("int"))
    path = write_chunk_files(pairs, scratch_path(spark, "chunk-files"), "pair", "chunk", n)
    back = (read_fastq(spark, path).groupBy(F.regexp_extract("file", "([^/]*)$", 1).alias("file"))
            .agg(F.count("*").alias("records"), F.min(F.when(F.col("name").endswith("/1"), F.col("name"))).alias("first_name"),
                 F.max(F.when(F.col("name").endswith("/1"), F.col("name"))).alias("last_name")))
    return (read_task_log(spark, path).where("rows > 0").select("partition", "file", "rows").join(back, "file")
            .select("partition", "file", "rows", "records", "first_name", "last_name"))


@query("file_fanout", oracle="SELECT c_nationkey, count(*) AS n_lines FROM customer GROUP BY c_nationkey")
def file_fanout(spark: SparkSession, sf_dir: str):
    """One text folder per nation; ``wc -l`` runs once per file
    (one task per file); counts summed per nation."""
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "fanout")
    c.select("c_nationkey", F.concat_ws("|", "c_name", "c_mktsegment").alias("value")) \
     .write.partitionBy("c_nationkey").text(path)
    files, _obs = observed(list_files(spark, path, "*.txt"), "fanout-files", F.sum("length").alias("bytes"))
    out = pipe_files(files, ["wc", "-l"], keep=["c_nationkey"])
    n = F.split(F.trim(F.col("line")), r"\s+").getItem(0).cast("bigint")
    return out.groupBy("c_nationkey").agg(F.sum(n).alias("n_lines"))


@query("partition_pipe", oracle=_GREEDY_SQL.replace("WITH dict", "WITH RECURSIVE dict") + """
SELECT grp, sum(n)::BIGINT AS n_lines FROM g WHERE rn > 0 GROUP BY grp
""")
def partition_pipe(spark: SparkSession, sf_dir: str):
    """Reads placed by balanced group and coordinate (range
    placement: a heavy group spans several tasks), every contiguous run of a
    group streamed through one ``wc -l`` process, counts summed per group."""
    r = regions(spark, sf_dir)
    groups = greedy_groups(key_counts(r, "region"), "region", "n", N_GROUPS)
    placed = place_and_sort(assign_groups(r, groups, "region"), "grp", ["ref_idx", "pos", "qname"])
    out = pipe_partitions(placed.select("grp", F.col("qname").alias("line")), ["wc", "-l"], key_col="grp")
    return out.groupBy("grp").agg(F.sum(F.trim("line").cast("bigint")).alias("n_lines"))


@query("report_csv_roundtrip", oracle="SELECT doc_id, lang, source, text FROM documents")
def report_csv_roundtrip(spark: SparkSession, sf_dir: str):
    """K1: ordered, headered, quoted CSV report; text with commas, quotes and
    newlines survives the read back."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    path = write_report(d, scratch_path(spark, "report"), [F.desc("doc_id")])
    return read_report(spark, path, "doc_id bigint, lang string, source string, text string")
