"""Content-addressed WARC archive.

Three parts under one root, all Parquet:

* ``payloads``: every distinct payload once, keyed by its SHA-256 and length;
* ``headers``: the exact header block of every record, with the key of its
  payload; never more than one row per record;
* records are rebuilt by joining the two (``restore``).

A payload is verified when it is read back: its bytes must give the digest and
the length it is filed under, before any record may use it.  Of records with
equal payloads of at least ``min_revisit`` bytes, the one with the largest id
is the response and the others are ``revisit`` records that refer to it;
smaller payloads are responses in every record (but are still stored once).

The query's columns are read from the rebuilt records' bytes (``record_facts``).

Scale: digests are grouped and joined for all records; writing the store moves
no payload (rows that do not own theirs are left out where they are read, by a
list that is sent while it is measured small); rebuilding moves each stored
payload once, to the headers with its key, a join that AQE splits when one
payload is very frequent.

Cases.  A null payload is an empty one.  A null or multi-line url: no, or an
escaped, target line.  Rows repeated with one id: each gives a record, all of
them responses if the id is the owner's.  Rows with a null id are archived
under the empty id and never own a payload that another row has.  Further
columns are ignored.  Empty input gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, settled
from sparkfold.session import scratch_path

CRLF = "\r\n"
HEADER_SCHEMA = "page_id long, header binary, payload_key string, payload_length long"
PAYLOAD_SCHEMA = "payload_key string, payload_length long, payload binary"


def _urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def header_block(record_type: Column, record_id: Column, url: Column, sha1: Column, length: Column,
                 refers_to: Column, date: str) -> Column:
    """The header of a record, up to and with its empty line.  A revisit's block is empty."""
    safe_url = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = record_type == "revisit"
    return F.encode(F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", record_type), _line("WARC-Record-ID", _urn(record_id)),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", safe_url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", _urn(refers_to)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(length).cast("string")), F.lit(CRLF)), "UTF-8")


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z") -> str:
    """Archive one record per row of ``pages`` under ``root``; returns ``root``."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"))
    keyed = rows.select("page_id", "url", F.sha2("payload", 256).alias("payload_key"), F.sha1("payload").alias("sha1"),
                        F.octet_length("payload").cast("long").alias("payload_length"))
    owners = keyed.groupBy("payload_key", "payload_length").agg(F.max("page_id").alias("owner"))
    revisit = (F.col("payload_length") >= min_revisit) & F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    (keyed.join(owners, ["payload_key", "payload_length"])
     .select("page_id", header_block(kind, F.col("page_id"), F.col("url"), F.col("sha1"), F.col("payload_length"),
                                     F.col("owner"), date).alias("header"), "payload_key", "payload_length")
     .write.parquet(f"{root}/headers"))
    # the bytes: one row per key.  Rows that do not own theirs are left out where the texts are read; only keys whose owner
    # is not one row (no id, or an id that stands there more than once) bring their texts together
    key = ["payload_key", "payload_length"]
    copies = keyed.groupBy(*key, "page_id").agg(F.count("*").alias("n"))
    many = copies.groupBy(*key).agg(F.max("page_id").alias("owner"), F.max_by("n", "page_id").alias("n"))
    odd = settled(many.where("owner IS NULL OR n > 1").select(F.col("payload_key").alias("_k")), "warc-odd-keys")
    spare = settled(copies.join(many.drop("n"), key).where(~F.col("page_id").eqNullSafe(F.col("owner")))
                    .select(F.col("payload_key").alias("_k"), F.col("page_id").alias("_p")), "warc-spare")
    stored = rows.select("page_id", F.sha2("payload", 256).alias("payload_key"), F.octet_length("payload").cast("long").alias("payload_length"), "payload")
    one = (stored.join(bounded_broadcast(spare), (F.col("payload_key") == F.col("_k")) & F.col("page_id").eqNullSafe(F.col("_p")), "left_anti")
           .join(bounded_broadcast(odd), F.col("payload_key") == F.col("_k"), "left_anti").select(*key, "payload"))
    rest = (stored.join(bounded_broadcast(odd), F.col("payload_key") == F.col("_k"), "left_semi")
            .groupBy(*key).agg(F.first("payload").alias("payload")).select(*key, "payload"))
    one.unionByName(rest).write.parquet(f"{root}/payloads")
    return root


def read_headers(spark: SparkSession, root: str) -> DataFrame:
    """Header fields parsed from the stored blocks, with the payload's key."""
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        value = F.regexp_extract(text, rf"\n{name}: ([^\r\n]*)\r", 1)
        return F.when(value != "", value)

    return (spark.read.schema(HEADER_SCHEMA).parquet(f"{root}/headers")
            .select("header", "payload_key", "payload_length",
                    F.regexp_extract(field("WARC-Record-ID"), "^<urn:page:(-?[0-9]*)>$", 1).try_cast("long").alias("page_id"),
                    field("WARC-Type").alias("record_type"), field("WARC-Target-URI").alias("url"),
                    F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("sha1"),
                    F.regexp_extract(field("WARC-Refers-To"), "^<urn:page:(-?[0-9]*)>$", 1).try_cast("long").alias("refers_to")))


def read_payloads(spark: SparkSession, root: str, with_bytes: bool = True) -> DataFrame:
    """Stored payloads, each checked against its key; a damaged one raises."""
    stored = spark.read.schema(PAYLOAD_SCHEMA).parquet(f"{root}/payloads")
    good = (F.sha2("payload", 256) == F.col("payload_key")) & (F.octet_length("payload") == F.col("payload_length"))
    checked = F.when(good, F.col("payload_key")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("payload_key"))).cast("string"))
    return stored.select(checked.alias("payload_key"), F.octet_length("payload").cast("long").alias("payload_length"),
                         F.sha1("payload").alias("payload_digest"), *(["payload"] if with_bytes else []))


def restore(spark: SparkSession, root: str) -> DataFrame:
    """page_id, record (the exact bytes of the WARC record) and payload (a revisit's is the one it refers to)."""
    rows = read_headers(spark, root).join(read_payloads(spark, root), ["payload_key", "payload_length"])
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return rows.select("page_id", F.concat("header", block, F.lit(CRLF + CRLF).cast("binary")).alias("record"), "payload")


def record_facts(records: DataFrame) -> DataFrame:
    """Fields of rebuilt records (page_id, record, payload), from their bytes alone; a record that contradicts itself raises.

    The header ends at the first empty line.  Content-Length must be that of the block, and the digest that of
    the block (response) or of the payload that a revisit refers to."""
    end = CRLF + CRLF
    head = F.decode(F.encode(F.substring_index(F.decode("record", "ISO-8859-1"), end, 1), "ISO-8859-1"), "UTF-8")
    rows = records.select("payload", F.octet_length("record").alias("size"), F.concat(F.lit("\n"), head, F.lit("\r")).alias("head"))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"\n{name}: ([^\r\n]*)\r", 1), F.lit(""))

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), "^<urn:page:(-?[0-9]*)>$", 1).try_cast("long")
    block = F.col("size") - F.octet_length("head") + 2 - 8                    # without the header, its empty line and the closing one
    kind, sha1, length = field("WARC-Type"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""), F.octet_length("payload").cast("long")
    good = ((block == field("Content-Length").cast("long")) & (sha1 == F.sha1("payload"))
            & (block == F.when(kind == "revisit", F.lit(0)).otherwise(length)))
    digest = F.when(good, sha1).otherwise(F.raise_error(F.concat(F.lit("record contradicts itself: "), F.col("head"))).cast("string"))
    return rows.select(page("WARC-Record-ID").alias("page_id"), length.alias("payload_bytes"), digest.alias("payload_digest"),
                       kind.alias("record_type"), page("WARC-Refers-To").alias("refers_to"), field("WARC-Target-URI").alias("url"))


def archive_pages(spark: SparkSession, pages: DataFrame, root: str | None = None, **options) -> DataFrame:
    """Write the archive, rebuild its records through joins, and read the fields of the rebuilt ones."""
    return record_facts(restore(spark, write_archive(pages, root or scratch_path(spark, "warc"), **options)))
