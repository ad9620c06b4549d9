"""Benchmark decontamination by template windows (native).

Texts are canonicalised: numbers, units after a number and, in one of two
forms, names (capitalised words inside a sentence) become typed placeholders,
all else is lower-cased and stripped of punctuation.  The form without names
does not depend on case, wrapping or punctuation.  A passage may match in
either form.  Windows of template words are hashed and joined;
where one matches, the item is laid along the document, and the windows of
``window`` words that are equal throughout cover the item's words.  For these
the *slots*, what stands in a document
and in the benchmark item where the template has a placeholder, are compared:
if every slot is equal the passage is ``verbatim``; if each value of the item
was replaced by one other value, it is ``reworded`` (the question with new
parameters; two values may become the same one).  A window with a slot that
contradicts most slots of its value counts as a chance hit, unless its words
are plainly equal; the other windows stay.

A document holds an item if windows covering at least ``coverage`` of the
item's words match along few alignments.

Scale: every ``STRIDE``-th word of a document starts a hashed window, every
word of an item does, so no full window is missed with a quarter of the rows.
The benchmark's hashes are broadcast if proven to be few, else both sides
shuffle by hash (a hit is only a hint; words decide).  Texts are looked at
again only for documents with a hit.

Cases.  Null or empty texts hold no window.  Items of fewer words than
``window`` are one window of their length.  Windows with fewer than
``literals`` other words than placeholders count only if their words are
plainly equal.  Repeated rows of documents or items give one result per pair of ids.
Rows with a null id take no part.  Further columns are ignored by
``find_leaks`` and pass through ``drop_leaks``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, free_name, settled

STRIDE = 4
#: set before names; what stands for a name, a number and a unit (a text's own such characters are taken for these)
MARK, NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002", "\ue003"
#: fixed list: units of measure and money, as they stand after a number
UNITS = ["mm", "cm", "m", "km", "inch", "inches", "feet", "ft", "yards", "miles", "mg", "g", "kg", "tons", "lb", "lbs", "ounces",
         "ml", "l", "liters", "litres", "gallons", "seconds", "minutes", "hours", "days", "weeks", "months", "years", "percent",
         "dollars", "euros", "pounds", "cents", "degrees", "km2", "m2", "mph", "kmh", "kb", "mb", "gb"]


def _steps(rows: DataFrame, keep: list[str], *steps: Callable[[Column], Column]) -> DataFrame:
    """``keep`` and t after every step; a step of its own each, as an expression that uses t twice would double what stands in it."""
    for step in steps:
        rows = rows.select(*keep, step(F.col("t")).alias("t"))
    return rows


#: text to lower-cased text in which names have a mark and decimals are kept together.  A name is a capitalised word that
#: neither starts the text nor follows a full stop, exclamation or question mark, whatever other white space and punctuation
#: stands before it.  In all patterns the look-arounds follow a character that most positions do not have.
MARKED = (
    lambda t: F.when(F.contains(t, F.lit(MARK)), F.replace(t, F.lit(MARK), F.lit(" "))).otherwise(t),
    lambda t: F.regexp_replace(t, r"\p{Lu}(?<![\p{L}\p{N}].)", f"{MARK}$0"),
    lambda t: F.when(F.contains(t, F.lit(MARK)), F.regexp_replace(t, rf"(\A|[.!?])([^\p{{L}}\p{{N}}{MARK}]*+){MARK}", "$1$2")).otherwise(t),
    lambda t: F.lower(F.when(t.rlike(r"[.,]\p{N}"), F.regexp_replace(t, r"[.,](?=\p{N})(?<=\p{N}[.,])", "d")).otherwise(t)),
)


def typed_text(marked: Column) -> Column:
    """The same text with one character for every number and unit; names keep their mark."""
    numbers = F.regexp_replace(marked, rf"\p{{N}}(?<![\p{{L}}\p{{N}}{MARK}].)[\p{{L}}\p{{N}}]*+", NUMBER)
    units = F.regexp_replace(numbers, rf"{NUMBER}([^\p{{L}}\p{{N}}{MARK}-{UNIT}]+){MARK}?(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])",
                             f"{NUMBER}$1{UNIT}")
    return F.when(marked.rlike(r"\p{N}"), units).otherwise(marked)


def _unmarked(text: Column) -> Column:
    return F.when(F.contains(text, F.lit(MARK)), F.replace(text, F.lit(MARK), F.lit(""))).otherwise(text)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, rf"[^\p{{L}}\p{{N}}{MARK}-{UNIT}]+"), "")


def _hashes(width: int, stride: int) -> Column:
    """(pos, hash) of the runs of ``width`` words, ``stride`` apart, in both forms; none if the text has fewer words.

    Of runs of numbers and units alone the plain words are hashed.  The form with names adds only runs that hold one
    and are not placeholders alone."""
    def run(words: str, i: Column) -> Column:
        return F.slice(words, i + 1, width)

    def hashed(at: Column, hash_at: Callable[[Column], Column]) -> Column:
        return F.transform(at, lambda i: F.struct(i.alias("pos"), hash_at(i).alias("hash")))

    def literal(words: str, i: Column) -> Column:
        return F.exists(run(words, i), lambda w: ~_is_slot(w))

    starts = F.sequence(F.lit(0), F.size("typed") - width, F.lit(stride))
    typed = F.when(F.array_contains("typed", NUMBER), hashed(starts, lambda i: F.when(
        literal("typed", i), F.xxhash64(run("typed", i))).otherwise(F.xxhash64(run("plain", i))))).otherwise(
        hashed(starts, lambda i: F.xxhash64(run("typed", i))))
    named = F.when(F.array_contains("words", NAME), F.filter(starts, lambda i: F.array_contains(run("words", i), NAME) & literal("words", i)))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return F.when(F.size("typed") >= width, F.concat(typed, F.coalesce(hashed(named, lambda i: F.xxhash64(run("words", i))), none)))


def _canonical(rows: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """``keep``, plain (the words), typed (numbers and units as placeholders) and words (names too); all have the same length."""
    marked = _steps(rows.select(*keep, F.col(text_col).alias("t")), list(keep), *MARKED)
    typed = marked.select(*keep, F.col("t").alias("marked"), typed_text(F.col("t")).alias("t"))
    named = F.when(F.contains("t", F.lit(MARK)), split_words(F.regexp_replace("t", rf"{MARK}[\p{{L}}\p{{N}}]++", NAME)))
    words = typed.select(*keep, split_words(_unmarked(F.col("marked"))).alias("plain"), split_words(_unmarked(F.col("t"))).alias("typed"),
                         named.alias("named"))
    return words.select(*keep, "plain", "typed", F.coalesce("named", "typed").alias("words"))


def _prepared(rows: DataFrame, id_col: str, text_col: str, new_id: str) -> DataFrame:
    own = rows.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias(new_id), F.col(text_col))
    return _canonical(own, text_col, new_id)


def _is_slot(word: Column) -> Column:
    return word.isin(NAME, NUMBER, UNIT)


def _is_value(word: Column) -> Column:
    return word.isin(NUMBER, UNIT)


def seeds(own: DataFrame, known: DataFrame, window: int) -> DataFrame:
    """(doc, item, shift): alignments of a document with an item on which a seed matches.

    A seed is ``window - STRIDE + 1`` words long and taken at every ``STRIDE``-th word of a document and at
    every word of an item, so any run of ``window`` equal words holds one.  An item shorter than ``window``
    is its own seed, looked for at every word."""
    lengths = sorted(r[0] for r in known.select("width").distinct().collect())       # at most ``window`` numbers
    hits = None
    for length in lengths:
        part = known.where(F.col("width") == length)
        width, stride = (window - STRIDE + 1, STRIDE) if length == window else (length, 1)
        bench = settled(part.select("item", F.explode(_hashes(width, 1)).alias("h"))
                        .select("item", F.col("h.pos").alias("item_pos"), F.col("h.hash").alias("hash")).distinct(), "bench-seeds")
        rows = (own.select("doc", F.explode(_hashes(width, stride)).alias("h"))
                .select("doc", F.col("h.pos").alias("pos"), F.col("h.hash").alias("hash")))
        found = rows.join(bounded_broadcast(bench), "hash").select("doc", "item", (F.col("pos") - F.col("item_pos")).alias("shift"))
        hits = found if hits is None else hits.unionByName(found)
    return settled(hits.distinct(), "bench-hits") if hits is not None else None


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = 8, literals: int = 4, coverage: float = 0.5) -> DataFrame:
    """doc_id, item_id, coverage (share of the item's words), kind (verbatim or reworded) and first_word of every leak."""
    known = settled(settled(_prepared(items, item_id, item_text, "item"), "bench-words").where(F.size("words") > 0).dropDuplicates(["item", "plain", "words"])
                    .select("*", F.least(F.size("words"), F.lit(window)).alias("width")), "bench")
    own = _prepared(docs, doc_id, doc_text, "doc")
    hits = seeds(own, known, window)
    if hits is None:                                       # no item at all
        hits = own.select("doc", F.lit(None).cast(known.schema["item"].dataType).alias("item"), F.lit(0).alias("shift")).where(F.lit(False))
    # the words of the few documents with a seed, laid along the item
    hit_docs = bounded_broadcast(settled(hits.select("doc").distinct(), "bench-hit-docs"))
    again = settled(own.join(hit_docs, "doc", "left_semi").select("doc", "plain", "words"), "bench-again").join(hits, "doc")
    lo, skip = F.greatest(F.col("shift"), F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    long = F.greatest(F.least(F.col("m") - skip, F.size("words") - lo), F.lit(0))
    laid = (again.join(known.select("item", F.col("plain").alias("item_plain"), F.col("words").alias("item_words"),
                                    F.size("words").alias("m"), "width"), "item")
            .where(long > 0)
            .select("doc", "item", "m", "width", skip.alias("skip"), lo.alias("first"), F.arrays_zip(
                F.slice("words", lo + 1, long).alias("w"), F.slice("plain", lo + 1, long).alias("p"),
                F.slice("item_words", skip + 1, long).alias("iw"), F.slice("item_plain", skip + 1, long).alias("ip")).alias("z")))
    # starts of full windows: all words plainly equal, or equal in one of the forms and enough of them literal
    starts = F.when(F.size("z") >= F.col("width"), F.sequence(F.lit(0), F.size("z") - F.col("width")))
    least = F.least(F.lit(literals), F.col("width"))

    def is_full(z: Column) -> Column:
        named = F.forall(z, lambda x: x["w"] == x["iw"]) & (F.size(F.filter(z, lambda x: ~_is_slot(x["w"]))) >= least)
        typed = (F.forall(z, lambda x: (x["p"] == x["ip"]) | ((x["w"] == x["iw"]) & _is_value(x["w"])))
                 & (F.size(F.filter(z, lambda x: (x["p"] == x["ip"]) & ~_is_value(x["w"]))) >= least))
        return named | typed | F.forall(z, lambda x: x["p"] == x["ip"])
    windows = F.transform(starts, lambda i: F.struct(i.alias("at"), F.slice("z", i + 1, F.col("width")).alias("z")))
    full = F.transform(F.filter(windows, lambda x: is_full(x["z"])), lambda x: x["at"])
    # settled, as filters on what follows would repeat these expressions
    runs = settled(laid.withColumn("full", full), "bench-runs").where(F.size("full") > 0)

    def words_of(starts: str) -> Column:
        return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + F.col("width") - 1))))

    def pair(x: Column) -> Column:
        return F.struct(F.concat(x["w"], x["ip"]).alias("a"), F.concat(x["w"], x["p"]).alias("b"))

    def is_pair(x: Column) -> Column:
        return (x["w"] == x["iw"]) & _is_slot(x["w"])

    # each of the item's values stands for the value that most of its slots have, its own if as many have that, else for none
    slots = F.transform(F.filter(F.transform(words_of("full"), lambda i: F.get("z", i)), is_pair), pair)
    runs = runs.withColumn("slots", slots)
    votes = F.transform(F.array_distinct("slots"), lambda e: F.struct(
        e["a"].alias("a"), e["b"].alias("b"), F.size(F.filter("slots", lambda x: x == e)).alias("n")))
    unclear = (F.size(F.array_distinct(F.transform("slots", lambda x: F.concat_ws(" ", x["a"], x["b"]))))
               > F.size(F.array_distinct(F.transform("slots", lambda x: x["a"]))))
    runs = runs.withColumn("votes", F.when(unclear, votes))
    against = F.transform(F.filter("votes", lambda v: F.exists("votes", lambda x: (x["a"] == v["a"]) & (x["b"] != v["b"]) & (
        (x["n"] > v["n"]) | ((x["n"] == v["n"]) & (v["a"] != v["b"]))))), lambda v: F.struct(v["a"].alias("a"), v["b"].alias("b")))
    runs = runs.withColumn("against", against)

    def stays(z: Column) -> Column:
        return F.forall(z, lambda x: x["p"] == x["ip"]) | ~F.exists(z, lambda x: is_pair(x) & F.exists("against", lambda y: y == pair(x)))
    runs = runs.withColumn("stay", F.when(F.col("against").isNull(), F.col("full")).otherwise(
        F.filter("full", lambda i: stays(F.slice("z", i + 1, F.col("width"))))))
    runs = runs.withColumn("covered", words_of("stay"))
    runs = settled(runs.select("doc", "item", "m", (F.col("first") + F.array_min("stay")).alias("first_word"),
                               F.transform("covered", lambda i: i + F.col("skip")).alias("covered"),
                               F.forall("covered", lambda i: F.get("z", i)["p"] == F.get("z", i)["ip"]).alias("same")), "bench-covered")
    return (runs.where(F.size("covered") > 0).groupBy("doc", "item")
            .agg((F.size(F.array_distinct(F.flatten(F.collect_list("covered")))) / F.max("m")).alias("coverage"),
                 F.min("same").alias("same"), F.min("first_word").alias("first_word"))
            .where(F.col("coverage") >= coverage)
            .select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "coverage",
                    F.when(F.col("same"), "verbatim").otherwise("reworded").alias("kind"), "first_word"))


def drop_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    leak = free_name(docs, "_leak")
    leaks = settled(find_leaks(docs, items, doc_id, **options).select(F.col("doc_id").alias(leak)).distinct(), "leaks")
    return docs.join(bounded_broadcast(leaks), docs[doc_id] == F.col(leak), "left_anti")
