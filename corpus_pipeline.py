"""Corpus pipeline: toxic documents go, boilerplate lines go, one document of each group of near copies
stays, documents that hold benchmark items go, and what is left is encoded.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.  The result
of each is written to the shared folder as Parquet and read again as the next one's docs.

Line dedup leaves documents whole that would lose half of their characters or more: they are copies, on which
the n-gram join decides by the whole text.

Cases.  Null or empty texts are kept by every filter (there is nothing to reject) and encode to no ids.
Rows with a null id pass the stages that decide by id.  Rows with one id and one text are one document from
the third stage on; rows with one id and different texts are different documents there.  Further columns, of
any name, pass through.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm.bpe_codec import encode_corpus
from sparkfold.llm.common import free_name, read_table, settled
from sparkfold.llm.decontaminate import drop_leaks
from sparkfold.llm.line_dedup import dedup_lines
from sparkfold.llm.ngram_join import link_documents
from sparkfold.llm.queries import byte_bpe_path, fold
from sparkfold.llm.toxicity import THRESHOLD, fit, score_texts
from sparkfold.operators.ordinals import with_dense_index
from sparkfold.session import ship_package

#: Share of its characters that makes a document a copy for line dedup.
WHOLE_SHARE = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold; trained on the labelled ones outside the held-out fold."""
    ship_package(spark)
    model = fit(docs, read_table(spark, sf_dir, "labels"), fold(4) != 2)
    score = free_name(docs, "_toxic")
    return score_texts(docs, model, score_col=score).where(F.col(score) < THRESHOLD).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines; copies keep theirs."""
    ship_package(spark)
    lines, removed = free_name(docs, "_lines"), free_name(docs, "_removed")
    clean = dedup_lines(docs, whole_share=WHOLE_SHARE, lines_col=lines, removed_col=removed)
    return clean.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def digest_of(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of the n-gram join."""
    ship_package(spark)
    key, stay = free_name(docs, "_key"), free_name(docs, "_stay")
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", digest_of("text").alias("digest")).distinct()
    if texts.groupBy("doc_id").count().where("count > 1").isEmpty():
        keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    else:                                           # an id with several texts: (id, text) pairs are numbered in order
        number = settled(with_dense_index(texts, ["doc_id", "digest"], key), "pipeline-texts").withColumnsRenamed({"doc_id": "_i", "digest": "_g"})
        keyed = docs.alias("d").join(number.alias("n"), (F.col("d.doc_id") == F.col("n._i")) & (digest_of("d.text") == F.col("n._g")), "left").select("d.*", f"n.{key}")
    kept = settled(link_documents(keyed, id_col=key).where("doc_id = component_id").select(F.col("doc_id").alias(stay)).distinct(), "pipeline-stay")
    found = keyed.join(kept, F.col(key) == F.col(stay)).dropDuplicates([key]).select(docs.columns)
    return found.unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark")).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) of every document, with their number and digests."""
    ship_package(spark)
    return encode_corpus(docs, byte_bpe_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", encoding),
]

#: SQL can express neither the network nor the tokenizer; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
