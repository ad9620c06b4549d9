"""Language identification from character-trigram profiles.

Re-aimed from a single-machine library call to a Spark job in the manner of
n-gram text categorisation (Cavnar & Trenkle, 1994):

* ``fit_language_profiles``: cleaned text (F5), blank runs collapsed, padded
  with one blank; every trigram of the whole text is exploded and counted
  per language; relative frequency f_lang(t).
* ``identify_language``: document trigram frequencies f_doc(t); the squared
  distance sum_t (f_doc - f_lang)^2 equals
  sum f_doc^2 - 2 sum f_doc f_lang + sum f_lang^2, and the first term is the
  same for every language.  The second is the sum of f_lang over all places of
  the document, divided by their number: trigrams meet the profiles (one row
  per trigram, a column per language; broadcast when few) where they are
  found, and one partial sum per document and task is shuffled.  A
  language sharing no trigram with the document scores sum f_lang^2, so the
  smallest such norm is the only extra candidate.  Ties -> smaller code.
* F6: a wrong ``lt`` guess on text with Hiragana / Hangul becomes ja / ko.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.functions.text import clean_social_text, script_flags, script_override_flags
from sparkfold.operators.joins import small, spread
from sparkfold.session import checkpoint_root, stored

BLANKS = r"[\t\n\r ]+"
SCORE_DIGITS = 9
#: trigrams of the profiles that are sent to every task
FEW = 300_000


def normalise(text: Column) -> Column:
    """Cleaned text with blank runs collapsed, padded with one blank on each side."""
    return F.concat(F.lit(" "), F.regexp_replace(clean_social_text(text), BLANKS, " "), F.lit(" "))


# every overlapping trigram in one linear pass (a positional substring per
# trigram would rescan the UTF-8 text from its start each time)
OVERLAPPING_TRIGRAMS = r"(?s)(?=(.{3}))"


def trigrams(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per overlapping character trigram of the normalised whole text."""
    t = normalise(F.col(text))
    grams = F.regexp_extract_all(t, F.lit(OVERLAPPING_TRIGRAMS), 1)
    return df.select(*keep, F.explode(grams).alias("tri"))


def _profiles_from_counts(counts: DataFrame, lang: str) -> DataFrame:
    per_lang = counts.groupBy(lang, "tri").agg(F.sum("c").alias("c"))
    totals = per_lang.groupBy(lang).agg(F.sum("c").alias("n"))
    return per_lang.join(totals, lang).select(F.col(lang).alias("lang"), "tri",
                                              (F.col("c") / F.col("n")).alias("f"))


def fit_language_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """-> (lang, tri, f) with f = count / total trigrams of the language."""
    counts = trigrams(spread(docs), text, [lang]).groupBy(lang, "tri").agg(F.count(F.lit(1)).alias("c"))
    return _profiles_from_counts(counts, lang)


def identify_language(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text: str = "text",
                      out: str = "predicted") -> DataFrame:
    """Score documents against fitted profiles; best language per document."""
    # one row per language
    norms = profiles.groupBy("lang").agg(F.sum(F.col("f") * F.col("f")).alias("norm")).orderBy("norm", "lang").collect()
    if not norms:                               # no profile: no guess
        return docs.select(id_col, F.lit(None).cast("string").alias(out))
    fallback = norms[0]                         # the candidate for documents that share no trigram
    named = [r for r in norms if r["lang"] is not None]
    weights = profiles.groupBy("tri").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(F.when(F.col("lang") == r["lang"], F.col("f"))).alias(f"_w{i}")
                                                                                 for i, r in enumerate(named)])
    # a language without a trigram of the document has no sum
    sums = (trigrams(spread(docs), text, [id_col]).join(small(weights, FEW), "tri", "left")
            .groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f"_w{i}").alias(f"_dot{i}") for i in range(len(named))]))
    scored = [F.when(F.col(f"_dot{i}").isNotNull(), F.struct(F.round(F.lit(r["norm"]) - 2 * F.col(f"_dot{i}") / F.col("_n"), SCORE_DIGITS).alias("s"),
                                                             F.lit(r["lang"]).alias("l"))) for i, r in enumerate(named)]
    none = F.lit(None).cast("struct<s:double,l:string>")
    best = sums.select(id_col, F.array_min(F.array(*scored, none)).alias("b"))
    fb = F.struct(F.round(F.lit(fallback["norm"]), SCORE_DIGITS).alias("s"), F.lit(fallback["lang"]).alias("l"))
    # only the two script flags travel to the final join, never the text
    hira, hangul = script_flags(clean_social_text(F.col(text)))
    res = docs.select(id_col, hira.alias("_hira"), hangul.alias("_hangul")).join(best, id_col, "left")
    choice = F.when(F.col("b").isNull() | (fb < F.col("b")), fb).otherwise(F.col("b"))
    res = res.withColumn("_c", choice)
    return res.select(id_col, script_override_flags(F.col("_c.l"), F.col("_hira"), F.col("_hangul")).alias(out))


def fit_and_identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                     out: str = "predicted") -> DataFrame:
    """Profiles fitted on ``docs`` and applied to the same documents: one pass over the texts for the profiles, which are stored,
    and one for the scores; nothing per document and trigram is kept or shuffled."""
    checkpoint_root(docs.sparkSession)
    profiles = stored(fit_language_profiles(docs, text, lang), "language-profiles")
    return identify_language(docs, profiles, id_col, text, out)
