"""Queries with SQL against DuckDB on the sf0.001 tables; the pipeline against its stages by brute force."""

import collections
import hashlib
import math
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from sparkfold.llm.queries import ORACLES, QUERIES, byte_bpe_path

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(res.fetchall(), cols)


def jaccard_components(texts, n=5):
    """doc -> smallest doc reached, over all pairs."""
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}, sets


def boilerplate_free(docs, min_sites=4, long_words=8, long_min_sites=2, whole_share=corpus_pipeline.WHOLE_SHARE):
    """doc -> cleaned text, from the definition; documents that would lose ``whole_share`` of it keep it."""
    sites, first = collections.defaultdict(set), {}
    for d, (text, site) in sorted(docs.items()):
        for k, line in enumerate(text.split("\n")):
            key = line.strip(" \t\r\x0b\x0c")
            if key:
                sites[key].add(site)
                first.setdefault(key, (d, k))
    out = {}
    for d, (text, _) in docs.items():
        keep = []
        for k, line in enumerate(text.split("\n")):
            key = line.strip(" \t\r\x0b\x0c")
            least = long_min_sites if key.count(" ") + 1 >= long_words else min_sites
            if not key or len(sites[key]) < least or first[key] == (d, k):
                keep.append(line)
        clean = "\n".join(keep)
        out[d] = clean if len(text) - len(clean) < whole_share * len(text) else text
    return out


def test_pipeline_against_brute_force(spark):
    """Stages 2 to 5 from their definitions, on what stage 1 keeps; stage 1 by the scores."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.toxicity(spark, docs, SF).cache()
    kept = {r.doc_id: (r.text, r.source) for r in first.collect()}
    assert first.columns == docs.columns
    score = {r.doc_id: r.score for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    assert set(kept) == {d for d, x in score.items() if x < 0.3}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    texts = boilerplate_free(kept)
    component, _ = jaccard_components(texts)
    texts = {d: t for d, t in texts.items() if component[d] == d}
    items = [re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def holds(text, item):
        return f" {' '.join(item[:-1])} " in f" {' '.join(re.findall(chr(92) + 'w+', text.lower()))} "
    texts = {d: t for d, t in texts.items() if not any(holds(t, i) for i in items)}
    assert set(got) == set(texts)
    tokenizer = Tokenizer.from_file(byte_bpe_path())
    for d, t in texts.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_pipeline_on_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        docs = out if name == "bpe" else out.select(docs.columns)
