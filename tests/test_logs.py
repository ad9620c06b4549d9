"""Page counts, retweet roll-up, text functions and language names."""

import pytest
from pyspark.sql import functions as F

from sparkfold.functions.langnames import with_language_name
from sparkfold.functions.text import clean_social_text, script_override, strip_newlines
from sparkfold.operators.spread import spread_report
from sparkfold.operators.topgroup import top_per_group, top_per_group_window
from sparkfold.sources.pagecounts import parse_pagecounts, read_pagecounts


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_pagecount_parse_merges_subprojects_and_drops_title_equal_language(spark):
    pv = parse_pagecounts(lines(spark, "en.m Foo 5 x", "en Bar 7 y", "de de 9 z", "fr Baz 1"))
    got = sorted(tuple(r) for r in pv.collect())
    assert got == [("en", "Bar", 7), ("en", "Foo", 5), ("fr", "Baz", 1)]


def test_pagecount_permissive_drops_bad_rows_and_failfast_raises(spark):
    bad = lines(spark, "en Foo notanumber", "en", "en Ok 3")
    assert [tuple(r) for r in parse_pagecounts(bad).collect()] == [("en", "Ok", 3)]
    with pytest.raises(Exception):
        parse_pagecounts(bad, mode="failfast").collect()


def test_pagecount_file_reader(spark, tmp_path):
    p = tmp_path / "pc.txt"
    p.write_text("en A 3\nen.m B 4\n")
    assert read_pagecounts(spark, str(p)).count() == 2


def test_top_item_tie_goes_to_greatest_title_in_both_plans(spark):
    df = spark.createDataFrame([("en", "a", 5), ("en", "c", 5), ("en", "b", 1), ("fr", "x", 2)],
                               "k string, item string, v long")
    for fn in (top_per_group, top_per_group_window):
        got = {r["k"]: (r["total"], r["top_item"], r["top_value"]) for r in fn(df, "k", "item", "v").collect()}
        assert got == {"en": (11, "c", 5), "fr": (2, "x", 2)}


def test_spread_report_total_counts_count_one_rows_and_two_texts_twice(spark):
    rows = [("en", 1, 10, 10, "t1"), ("en", 1, 12, 12, "t1b"),   # id 1: spread 3, two texts
            ("en", 2, 5, 5, "u"),                                 # id 2: spread 1 (in total, not output)
            ("fr", 3, 1, 4, "v")]
    df = spark.createDataFrame(rows, "lang string, id long, lo long, hi long, text string")
    rep = spread_report(df, "id", "lang", "hi", "lo", ["text"], total_col="total")
    got = sorted((r["lang"], r["id"], r["retweet_count"], r["total"], r["text"]) for r in rep.collect())
    assert got == [("en", 1, 3, 7, "t1"), ("en", 1, 3, 7, "t1b"), ("fr", 3, 4, 4, "v")]


def test_clean_text_first_rt_only_handles_and_urls(spark):
    df = spark.createDataFrame([("ART RT @jos_1 hi http://x.y/z end\nnext",)], "t string")
    out = df.select(strip_newlines(clean_social_text(F.col("t"))).alias("c")).first()["c"]
    # first "RT" removed even inside a word; @letters removed, digits/underscore stay
    assert out == "A RT _1 hi end next"


def test_script_override_only_fixes_lt(spark):
    df = spark.createDataFrame([("lt", "ひらがな"), ("lt", "한국어"), ("en", "ひらがな"), ("lt", "abc")],
                               "l string, t string")
    got = [r[0] for r in df.select(script_override(F.col("l"), F.col("t"))).collect()]
    assert got == ["ja", "ko", "en", "lt"]


def test_language_names_unknown_code_returns_itself(spark):
    df = spark.createDataFrame([("en",), ("zz",), ("commons",), ("DE",)], "c string")
    got = [r["language"] for r in with_language_name(df, "c").collect()]
    assert got == ["English", "zz", "commons", "German"]


def test_language_scores_move_one_row_per_document(spark, monkeypatch):
    """Rows of one id count as one document, unknown trigrams count as places, null ids and unlabelled rows as before; with and without a broadcast."""
    from collections import Counter

    from sparkfold.functions import langid

    docs = [(1, "aaaa bbb", "x"), (1, "cccd", "y"), (2, "cccc cdd", "y"), (3, "zzzzz", None), (4, "aab", "x"), (None, "ccc", "y"), (5, None, "x"), (6, "bbb ccc", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")

    def grams(t):
        t = f" {t} " if t is not None else ""
        return [t[i:i + 3] for i in range(len(t) - 2)]
    counts = {v: Counter(g for _, t, x in docs if x == v for g in grams(t)) for v in "xy"}
    f = {v: {g: n / sum(c.values()) for g, n in c.items()} for v, c in counts.items()}
    norm = {v: sum(w * w for w in p.values()) for v, p in f.items()}
    want = set()
    for key in {d for d, _, _ in docs}:
        own = [g for d, t, _ in docs if d == key and key is not None for g in grams(t)]
        seen = [v for v in "xy" if any(g in f[v] for g in own)]
        some = [(round(norm[v] - 2 * sum(f[v].get(g, 0) for g in own) / len(own), 9), v) for v in seen]
        want.add((key, min([*some, min((round(norm[v], 9), v) for v in "xy")])[1]))
    for few in (langid.FEW, 0):
        monkeypatch.setattr(langid, "FEW", few)
        got = langid.fit_and_identify(df)
        assert {tuple(r) for r in got.collect()} == want
    monkeypatch.setattr(langid, "FEW", 300_000)
    plan = langid.fit_and_identify(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(_w0" in plan and "hashpartitioning(doc_id" in plan and plan.index("partial_sum(_w0") < plan.index("BroadcastHashJoin")
