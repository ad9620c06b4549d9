"""Personal data: base patterns and information-theoretic sanitisation (native).

Base spans are e-mail addresses, IP addresses, card numbers (Luhn) and phone
numbers.  They are the protected entities.  Words can give them away too: if,
over the corpus, most documents that hold a word also hold the entity, the word
discloses the entity.  For every word of a document with the entity, wherever
it stands, counts over all documents estimate

    share = documents with the word and the entity, wherever they stand / documents with the word
    bits  = log2(share / (documents with the entity / all documents))

Words with a share of at least ``generalise`` that give at least ``least_bits``
and stand in documents with ``least_contexts`` different contexts of the entity
are flagged (a context is the words within ``reach`` characters of the entity;
copies of one passage count once).  Words have three letters at least.  Every occurrence of a flagged
word, in any document, becomes a span of kind ``term``.  Words inside base
spans are no words.  ``sanitise`` replaces
base spans by their kind, terms by ``[TERM]``, and removes terms whose share
reaches ``remove``.

The regular expressions hold no repeated groups: Java matches those by
recursion, and a long run of digits or labels would overflow an executor's
stack.  Separators inside a number, and dots inside a host name, are first
replaced by a mark of the same length, so that a character class repeats
instead.  Look-behinds that forbid a start inside a run of the same class keep
the search linear and change no match.

Scale: texts are read four times and shuffled only where lists of rows are not
measured to be small; what moves is a row for each word of a document with an
entity that can still be disclosed, and counts that are combined before the
shuffle: entities in too many documents for ``least_bits`` or with too few
contexts, and words in too many documents for ``generalise``, go first.

Cases.  Null text: empty.  Null or repeated ids: every row is judged by itself
(rows get their own number).  Empty tables give empty results.  Further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, settled

KINDS = ["email", "ip", "card", "phone"]
MARK, OTHER = "\ue001", "\ue002"            # a text's own marks are first turned into another character
LOCAL = rf"A-Za-z0-9._%+{MARK}-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9{MARK}-]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"[0-9][0-9{MARK}]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"\p{L}++"
FOUND = "array<struct<start:int,stop:int,found:string>>"


def matches(text: Column, pattern: str | Column) -> Column:
    """start, stop (code points, stop exclusive) and text of every match of ``pattern``."""
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))    # one gap more than matches
    step = F.aggregate(
        F.filter(zipped, lambda x: x["m"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.length(x["m"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["g"]).alias("start"),
                                                  (acc["at"] + x["g"] + F.length(x["m"])).alias("stop"),
                                                  x["m"].alias("found")))).alias("out")))
    return step["out"]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when((n - i) % 2 == 1, d * 2).otherwise(d)
        return acc + F.when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _is_ip(s: Column) -> Column:
    bare = F.transform(F.split(s, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(bare, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _is_card(s: Column) -> Column:
    d = _digits(s)
    return F.length(d).between(12, 19) & _luhn(F.substr(d, F.lit(1), F.lit(19)))


def _is_phone(s: Column) -> Column:
    return F.length(_digits(s)).between(9, 15)


def base_spans(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with ``base``: array of (start, kind number, stop, value), in order."""
    t = F.col("_t")
    plain = rows.withColumn("_t", F.translate(F.coalesce(F.col(text_col), F.lit("")), MARK, OTHER))
    dotted = F.regexp_replace(t, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK)
    chained = F.regexp_replace(t, r"(?<=[0-9])[\x20-](?=[0-9])", MARK)
    none = F.array().cast(FOUND)
    found = {
        "email": F.when(F.contains(t, F.lit("@")), matches(dotted, EMAIL)).otherwise(none),
        "ip": F.when(t.rlike(r"[0-9]\.[0-9]"), F.filter(matches(t, IP), lambda x: _is_ip(x["found"]))).otherwise(none),
        "card": F.when(t.rlike(r"[0-9](?:[ -]?[0-9]){11}"),
                       F.filter(matches(chained, CARD), lambda x: _is_card(x["found"]))).otherwise(none),
        "phone": F.when(F.contains(t, F.lit("+")), F.filter(matches(t, PHONE), lambda x: _is_phone(x["found"]))).otherwise(none),
    }
    return plain.withColumn("base", F.array_sort(F.concat(*[_typed(found[k], k) for k in KINDS]))).drop("_t")


def _typed(found: Column, kind: str) -> Column:
    def value(x: Column) -> Column:
        return F.lower(F.replace(x, F.lit(MARK), F.lit("."))) if kind == "email" else _digits(x)
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                 x["stop"].alias("stop"), value(x["found"]).alias("value")))


def count_of(kind: str) -> Column:
    """The number of base spans of a kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _context(text: Column, span: Column, reach: int) -> Column:
    """The whole words within ``reach`` characters of a span: what tells copies of one passage from different mentions."""
    lo = F.greatest(span["start"] - reach, F.lit(0))
    left = F.substr(text, lo + 1, span["start"] - lo)
    right = F.substr(text, span["stop"] + 1, F.lit(reach))
    before = F.filter(matches(left, WORD), lambda x: ((x["start"] > 0) | (lo == 0)) & (x["stop"] < F.length(left)))
    after = F.filter(matches(right, WORD), lambda x: (x["start"] > 0) & (x["stop"] < reach))
    return F.transform(F.concat(before, after), lambda x: F.lower(x["found"]))


def _row_words(rows: DataFrame) -> DataFrame:
    """(row, term): the distinct words of three letters and more of every row, outside of base spans."""
    cut = F.aggregate("base", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["stop"]).alias("at"),
        F.concat(acc["out"], F.substr("text", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.lit(" ")).alias("out")))
    outside = (rows.select("row", "text", F.when(F.size("base") > 0, cut).alias("cut"))
               .select("row", F.when(F.col("cut").isNull(), F.col("text"))
                       .otherwise(F.concat("cut.out", F.substr("text", F.col("cut.at") + 1, F.length("text")))).alias("text")))
    return (outside.select("row", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("term"))
            .where(F.length("term") >= 3))


def disclosing_terms(seen: DataFrame, rows: DataFrame, least_contexts: int, least_bits: float, generalise: float) -> tuple[DataFrame, DataFrame]:
    """(entity, term, share) of the words that give an entity away, and (row, term) of all rows with a word that could.

    ``seen``: row, entity, context; ``rows``: row, text, base.  Candidates are all words of the documents with an entity."""
    total = F.lit(rows.count())
    entities = (seen.groupBy("entity").agg(F.count_distinct("row").alias("with_entity"), F.count_distinct("context").alias("contexts"))
                .where(F.col("contexts") >= least_contexts).drop("contexts")
                # the share that is needed; above 1 no word can have it
                .withColumn("need", F.greatest(F.lit(generalise), F.lit(2.0 ** least_bits) * F.col("with_entity") / total))
                .where(F.col("need") < 1.000001))
    entities = settled(entities, "pii-entities")
    holders = settled(seen.join(bounded_broadcast(entities.select("entity")), "entity", "left_semi"), "pii-holders")
    of_holders = _row_words(rows.join(bounded_broadcast(holders.select("row").distinct()), "row", "left_semi"))
    both = (of_holders.join(holders, "row").groupBy("entity", "term")
            .agg(F.count_distinct("row").alias("both"), F.count_distinct("context").alias("contexts"))
            .where(F.col("contexts") >= least_contexts))
    pairs = settled(both.join(entities, "entity"), "pii-pairs")
    terms = settled(pairs.groupBy("term").agg(F.max(F.col("both") / F.col("need")).alias("most")), "pii-terms")
    # a word in more documents than both / need has too low a share for every entity
    with_term = (_row_words(rows).join(bounded_broadcast(terms), "term").groupBy("term", "most").agg(F.count("*").alias("with_term"))
                 .where(F.col("with_term") <= F.col("most") * 1.000001))
    rare = settled(with_term.select("term", "with_term"), "pii-rare-terms")
    share = F.col("both") / F.col("with_term")
    flagged = (pairs.join(rare, "term").where((share >= generalise) & (F.log2(share / (F.col("with_entity") / total)) >= least_bits))
               .select("entity", "term", share.alias("share")))
    flagged = settled(flagged, "pii-flagged-pairs")
    named = settled(flagged.select("term").distinct(), "pii-flagged-terms")
    return flagged, _row_words(rows).join(bounded_broadcast(named), "term", "left_semi")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 80, least_contexts: int = 2,
             least_bits: float = 4.0, generalise: float = 0.5) -> DataFrame:
    """``id_col``, text, base (start, kind, stop, value) and terms (start, stop, share) of every row of ``docs``."""
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows are numbered once; contexts are cut out where the text is at hand
    rows = settled(base_spans(texts).select(
        F.monotonically_increasing_id().alias("row"), id_col, "text", "base"), "pii-rows")
    spans = (rows.where(F.size("base") > 0).select("row", "text", F.explode("base").alias("span"))
             .select("row", F.concat_ws(":", "span.kind", "span.value").alias("entity"), _context(F.col("text"), F.col("span"), reach).alias("words")))
    seen = settled(spans.select("row", "entity", F.xxhash64("words").alias("context")).distinct(), "pii-seen")
    flagged, row_terms = disclosing_terms(seen, rows, least_contexts, least_bits, generalise)
    shares = settled(flagged.groupBy("term").agg(F.max("share").alias("share")), "pii-flagged")
    hits = (row_terms.join(bounded_broadcast(shares), "term").groupBy(F.col("row").alias("_row"))
            .agg(F.sort_array(F.collect_list(F.struct("term", "share"))).alias("_hits")))
    hits = bounded_broadcast(settled(hits, "pii-row-hits"))
    # the words are runs of letters, so they stand for themselves in a pattern
    found = rows.join(hits, F.col("row") == F.col("_row"), "left").withColumn("_shares", F.map_from_entries("_hits")).withColumn("_pattern", F.concat(
        F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("_hits.term", "|"), F.lit(r")(?!\p{L})")))
    free = F.filter(matches(F.col("text"), F.col("_pattern")), lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])))

    def share_of(x: Column) -> Column:
        return F.try_element_at(F.col("_shares"), F.lower(x["found"]))
    terms = F.filter(F.transform(free, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), share_of(x).alias("share"))),
                     lambda x: x["share"].isNotNull())
    return found.select(id_col, "text", "base", F.when(F.col("_hits").isNotNull(), terms).otherwise(
        F.array().cast("array<struct<start:int,stop:int,share:double>>")).alias("terms"))


def span_strings(found: DataFrame) -> DataFrame:
    """``found`` with base_spans and spans: ``kind:start:stop``, in order of start, then kind, comma-joined."""
    names = F.array(*map(F.lit, [*KINDS, "term"]))

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    more = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["stop"].alias("stop")))
    return found.withColumn("base_spans", text(base)).withColumn("spans", text(F.array_sort(F.concat(base, more))))


def sanitise(found: DataFrame, remove: float = 0.9) -> DataFrame:
    """``found`` with ``clean_text``: base spans replaced by their kind, terms generalised or removed; overlaps as one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.get(names, s["kind"]).alias("by")))
    more = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"),
                                                   F.when(s["share"] >= remove, "").otherwise("[TERM]").alias("by")))
    done = F.aggregate(
        F.array_sort(F.concat(base, more)), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out")))
        .otherwise(F.struct(s["stop"].alias("at"),
                            F.concat(acc["out"], F.substr("text", acc["at"] + 1, s["start"] - acc["at"]), s["by"]).alias("out"))))
    return (found.withColumn("_done", done)
            .withColumn("clean_text", F.concat("_done.out", F.substr("text", F.col("_done.at") + 1, F.length("text")))).drop("_done"))
