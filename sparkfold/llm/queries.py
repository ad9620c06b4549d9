"""Queries of this subpackage on the driver tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm.common import read_table
from sparkfold.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return wrap


# --- 1: URL filters ---------------------------------------------------------------------------------------------

#: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op1_url_filter", """
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')) r(rhost, rpath, rverdict)),
fits AS (SELECT DISTINCT p.host, p.path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
    max_by(rverdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules
    ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath) GROUP BY p.host, p.path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (host, path)
""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.url_filter import filter_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(read_table(spark, sf_dir, "pages"), rules)


# --- 3: line dedup ----------------------------------------------------------------------------------------------

@query("op3_line_dedup", r"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw,
    unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, source, pos, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, raw FROM l),
spread AS (SELECT line, count(DISTINCT coalesce(source, chr(1))) AS sites, min((doc_id, pos)) AS first,
    length(line) - length(replace(line, ' ', '')) + 1 AS words FROM k WHERE line <> '' GROUP BY line),
boiler AS (SELECT line, first FROM spread WHERE sites >= CASE WHEN words >= 8 THEN 2 ELSE 4 END),
flagged AS (SELECT k.*, b.line IS NOT NULL AND (k.doc_id, k.pos) <> b.first AS dropped FROM k LEFT JOIN boiler b USING (line)),
clean AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS text FROM flagged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(c.text) AS clean_sha256
FROM documents d LEFT JOIN clean c USING (doc_id)
""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.line_dedup import dedup_lines

    return (dedup_lines(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("clean_sha256")))


# --- 6: WARC ----------------------------------------------------------------------------------------------------

@query("op6_warc_archive", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
    max(page_id) OVER (PARTITION BY body) AS owner FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN owner END AS refers_to FROM f
""")
def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.warc_archive import archive_pages

    return (archive_pages(spark, read_table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


# --- 9: BPE -----------------------------------------------------------------------------------------------------

def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.bpe_codec import encode_corpus

    return (encode_corpus(read_table(spark, sf_dir, "documents"), byte_bpe_path())
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


# --- 7: language ID ---------------------------------------------------------------------------------------------

def fold(parts: int):
    """crc32 of doc_id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.language_id import fit, identify

    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, fold(3) != 1)
    return (identify(docs, model).withColumn("held_out", F.coalesce(fold(3) == 1, F.lit(False)))
            .select("doc_id", "held_out", "lang_pred", "score", "ambiguous"))


# --- 2: toxicity ------------------------------------------------------------------------------------------------

@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.toxicity import THRESHOLD, fit, score_texts

    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"), fold(4) != 2)
    return (score_texts(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


# --- 4: benchmark decontamination -------------------------------------------------------------------------------

@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.decontaminate import find_leaks

    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# --- 10: PII ----------------------------------------------------------------------------------------------------

@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.pii import KINDS, count_of, find_pii, span_strings

    found = span_strings(find_pii(read_table(spark, sf_dir, "documents")))
    return found.select("doc_id", *[count_of(k).alias(f"n_{k}") for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")


# --- 5: embedding near-duplicates -------------------------------------------------------------------------------

@query("op5_embedding_neardup", """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id
""")
def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.embedding_neardup import link_embeddings

    return link_embeddings(read_table(spark, sf_dir, "embeddings"))


# --- 8: n-gram Jaccard join -------------------------------------------------------------------------------------

@query("op8_ngram_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS t FROM w),
n AS (SELECT doc_id, len(t) AS n FROM s),
tok AS (SELECT doc_id, unnest(t) AS token FROM s),
links AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM tok x JOIN tok y USING (token)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, c.component_id FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = n.doc_id
""")
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.ngram_join import link_documents

    return link_documents(read_table(spark, sf_dir, "documents"))


# --- 11: conversation prefix trie -------------------------------------------------------------------------------

#: CRC-32 in SQL: a table of 256 entries from the polynomial, and one step a character of an ASCII string.
CRC_TABLE = """(SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS tab FROM range(256) r(i))"""


def sql_crc32(ascii_text: str, tab: str = "tab") -> str:
    codes = f"list_transform(string_split({ascii_text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), "
            f"lambda c, b: xor(c >> 8, {tab}[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT))")


@query("op11_prefix_trie", f"""
WITH crc AS {CRC_TABLE},
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(struct_pack(k := md5(length(r) || ':' || r || x), n := length(x)) ORDER BY turn NULLS FIRST, r, md5(x)) AS ts
  FROM t GROUP BY conv_id),
hs AS (SELECT conv_id, ts, {sql_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM o, crc),
re AS (SELECT c.conv_id, list_concat(coalesce(list_slice(b.ts, 1, c.h), []), list_slice(c.ts, c.h + 1, len(c.ts))) AS ts
  FROM hs c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 100),
m AS (SELECT conv_id, d, len(ts) = d AS ends, CASE WHEN d > 0 THEN ts[d].n ELSE 0 END AS chars,
    md5(array_to_string(list_transform(list_slice(ts, 1, d), lambda z: z.k), '')) AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(list_transform(list_slice(ts, 1, d - 1), lambda z: z.k), '')) END AS parent
  FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM re)),
n AS (SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM m GROUP BY node, d),
kids AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT a.node, a.d, count(*) FILTER (k.parent IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM n JOIN m a ON a.conv_id = n.conv_id AND a.d <= n.d LEFT JOIN kids k ON k.parent = n.node GROUP BY a.node, a.d)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN n p ON p.node = n.parent LEFT JOIN kids k ON k.parent = n.node JOIN below b ON b.node = n.node
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.prefix_trie import conversation_trie

    return conversation_trie(read_table(spark, sf_dir, "conversations"))


# --- 12: conversation structure repair --------------------------------------------------------------------------

@query("op12_turn_repair", rf"""
WITH RECURSIVE crc AS {CRC_TABLE},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x,
    {sql_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations, crc),
dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE r END AS r,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS again FROM src WHERE k <> 0),
o AS (SELECT conv_id, turn, r, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS p FROM dam),
f AS (SELECT *, left(r, 1) AS i, CASE WHEN NOT regexp_matches(x, '[^\x20\x09-\x0D]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, r, x ORDER BY p) > 1 THEN 'd'
      WHEN NOT regexp_matches(x, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM o),
moves AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(st, i, nxt)),
ins AS (SELECT * FROM (VALUES (0, 0, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 1, 0, ''), (1, 2, 5, 'I'), (1, 3, 10, 'II'),
    (2, 2, 0, ''), (2, 3, 5, 'I'), (3, 3, 0, ''), (3, 2, 5, 'I')) v(st, nxt, cost, letters)),
best AS (SELECT conv_id, CAST(0 AS BIGINT) AS p, ins.nxt AS st, ins.cost AS cost, ins.letters AS audit FROM (SELECT DISTINCT conv_id FROM f) c, ins WHERE ins.st = 0
  UNION ALL
  SELECT conv_id, p, st, m[1], m[2] FROM (SELECT a.conv_id, a.p, ins.nxt AS st, min(row(a.cost + ins.cost, a.audit || ins.letters)) AS m FROM (
      SELECT b.conv_id, f.p, b.st, b.cost + 2 AS cost, b.audit || 'D' AS audit FROM best b JOIN f ON f.conv_id = b.conv_id AND f.p = b.p + 1
      UNION ALL SELECT b.conv_id, f.p, v.nxt, b.cost + CASE WHEN fault = 't' THEN 5 ELSE 0 END, b.audit || 'K' FROM best b
        JOIN f ON f.conv_id = b.conv_id AND f.p = b.p + 1 JOIN moves v ON v.st = b.st AND v.i = f.i WHERE fault IN ('', 't')
      UNION ALL SELECT b.conv_id, f.p, v.nxt, b.cost + 1 + CASE WHEN fault = 't' THEN 5 ELSE 0 END, b.audit || 'R' FROM best b
        JOIN f ON f.conv_id = b.conv_id AND f.p = b.p + 1 JOIN moves v ON v.st = b.st AND v.i <> 's' WHERE fault IN ('', 't')) a
    JOIN ins ON ins.st = a.st GROUP BY a.conv_id, a.p, ins.nxt)),
ends AS (SELECT conv_id, max(p) AS p FROM f GROUP BY conv_id),
done AS (SELECT conv_id, min(row(cost, audit)) AS m FROM best JOIN ends USING (conv_id, p) WHERE st IN (0, 3) GROUP BY conv_id),
steps AS (SELECT conv_id, m[1] AS cost, m[2] AS audit, unnest(string_split(m[2], '')) AS e, unnest(range(1, len(m[2]) + 1)) AS k FROM done),
placed AS (SELECT conv_id, e, k, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER w AS p, sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER w AS j
  FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
kept AS (SELECT placed.*, f.r, f.x, max(CASE WHEN e = 'K' AND j = 1 AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY placed.conv_id) AS s
  FROM placed LEFT JOIN f ON f.conv_id = placed.conv_id AND f.p = placed.p AND placed.e <> 'I' WHERE e <> 'D'),
fixed AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN r WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN e = 'I' THEN '' ELSE x END, chr(10) ORDER BY k)) AS sha FROM kept GROUP BY conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal
  FROM (SELECT *, p > 1 AND lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i NOT IN ('su', 'ua', 'au') AS bad FROM f) GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(m[1], 0) AS BIGINT) AS cost, coalesce(m[2], '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN done USING (conv_id) LEFT JOIN fixed USING (conv_id)
""")
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.turn_repair import repair_damaged

    return repair_damaged(read_table(spark, sf_dir, "conversations"))


# --- 13: suffix-array dedup -------------------------------------------------------------------------------------

@query("op13_span_dedup", """
WITH s AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM s WHERE n >= 100)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, p) AS nth FROM w) WHERE nth > 1),
runs AS (SELECT doc_id, p, sum(CASE WHEN p <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM dup)),
cuts AS (SELECT doc_id, run, min(p) AS lo, max(p) + 100 AS hi FROM runs GROUP BY doc_id, run),
pieces AS (SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS after FROM cuts),
kept AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * after + 1, 2 * (lo - after)), '' ORDER BY lo) AS front, max(hi) AS last
  FROM pieces JOIN s USING (doc_id) GROUP BY doc_id)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM s LEFT JOIN kept USING (doc_id)
""")
def op13_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfold.llm.span_dedup import dedup_spans

    return dedup_spans(read_table(spark, sf_dir, "documents")).drop("removed")
