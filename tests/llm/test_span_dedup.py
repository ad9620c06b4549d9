"""Span removal against all windows by brute force."""

import hashlib
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from sparkfold.llm import span_dedup as S

SCHEMA = "doc_id long, text string, digest string, spans int, lo int"


def brute(docs):
    """(doc_id, columns) of documents in their order; ``docs``: (order key, doc_id, bytes)."""
    seen, out = {}, []
    for key, doc_id, text in sorted(docs):
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - 99):
            if seen.setdefault(text[p:p + 100], (key, p)) != (key, p):
                gone[p:p + 100] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])) == 1)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(text), int(gone.sum()), len(edges), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [words(rng, n) for n in (20, 26, 40, 90)]
    texts = []
    for k in range(60):
        parts = [words(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(passages)[rng.randrange(0, 12):], words(rng, rng.randrange(0, 5))]
        texts.append(" ".join(parts))
    texts += [passages[3]] * 3 + ["", None, "x" * 99, "x" * 100, "y" * 350, "ab" * 300, "z" * 101 + "q", texts[0][:150], words(rng, 300) * 2]
    near = texts[5].split() or ["a"]
    for _ in range(6):
        copy = list(near)
        copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(copy) + " " + passages[2])
    return texts


def unpacked(batches):
    rows = pa.Table.from_batches(list(batches)).to_pandas()
    at = rows["at"].to_numpy()
    rows["kind"], rows["number"], rows["lo"] = at & 3, (at >> 2) & ((1 << 31) - 1), at >> 33
    return rows


def best_of(rows, *columns):
    """Whether a row is not the earliest among those with equal columns."""
    key = rows.doc_id * (1 << 32) + rows.lo
    return key > key.groupby([rows[c] for c in columns]).transform("min")


@pytest.mark.parametrize("seed,piece,compared", [(1, 1 << 18, 8 << 20), (2, 257, 1500), (3, 64, 1)])
def test_rounds_in_pieces_of_any_size(monkeypatch, seed, piece, compared):
    """The tasks' part of the rounds, with the aggregations between them done here."""
    monkeypatch.setattr(S, "PIECE", piece)
    monkeypatch.setattr(S, "COMPARED", compared)
    texts = corpus(seed)
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(np.zeros(len(texts), np.int64)),
                                       pa.array([t or "" for t in texts])], ["doc_id", "digest", "text"])
    rows = unpacked(S.anchor_rows(iter([docs])))
    rows["removed"] = (rows.kind == S.REMOVED) | best_of(rows, "b", "full")
    several = rows.groupby("b").kind.transform(lambda x: x.isin([S.FRONT, S.KNOWN]).any()) | (rows.groupby("b").full.transform("nunique") > 1)
    left = rows[~rows.removed & several]
    spans = [[(r.lo << 14) + ((r.number & 127) << 7) + (r.number >> 7) for r in left[left.doc_id == d].itertuples()] for d in range(len(texts))]
    with_spans = pa.RecordBatch.from_arrays([*docs.columns, pa.array(spans, pa.list_(pa.int64()))], ["doc_id", "digest", "text", "spans"])
    eights = unpacked(S.window_rows(iter([with_spans])))
    live = eights[eights.kind != S.REMOVED]
    windows = [(name, left, right, j, d, lo - j) for name, left, right, d, lo, mask
               in zip(live["name"], live.left, live.right, live.doc_id, live.lo, live.number) for j in range(8) if mask >> j & 1]
    windows = pd.DataFrame(windows, columns=["name", "left", "right", "j", "doc_id", "lo"])
    windows["key"] = S.side_key(windows.left.to_numpy().view(np.uint64), windows.right.to_numpy().view(np.uint64), windows.j.to_numpy())
    rows["size"] = np.where(rows.kind == S.REMOVED, rows.number, rows.number & 127)
    eights["size"], windows["size"] = eights.number, 0
    gone = [[] for _ in texts]
    for part in (rows[rows.removed], eights[eights.kind == S.REMOVED], windows[best_of(windows, "name", "key")]):
        for doc_id, lo, size in zip(part.doc_id, part.lo, part["size"]):
            gone[doc_id].append((int(lo) << 31) + int(size))
    lists = pa.RecordBatch.from_arrays([*docs.columns[:2], pa.array(gone, pa.list_(pa.int64()))], ["doc_id", "digest", "spans"])
    gone = pa.Table.from_batches(list(S.joined_spans(iter([lists]))))["spans"].to_pylist()
    last = pa.RecordBatch.from_arrays([docs.column(0), docs.column(2), pa.array(gone, pa.list_(pa.int64()))], ["doc_id", "text", "spans"])
    got = sorted((tuple(r.values())[:5] for b in S.cut_spans(iter([last])) for r in b.to_pylist()), key=repr)
    assert got == brute([(d, d, (t or "").encode()) for d, t in enumerate(texts)])


@pytest.mark.parametrize("seed", [4, 5])
def test_on_spark(spark, seed):
    texts = corpus(seed)
    rows = [(k, t, "x", 1, 2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(S.dedup_spans(docs)) == brute([(d, d, (t or "").encode()) for d, t in enumerate(texts)])


def test_null_and_repeated_ids(spark):
    rng = random.Random(9)
    p = words(rng, 60)
    rows = [(None, p), (3, p), (3, p), (4, p + " more"), (7, "own " + p), (7, p + " other"), (-2, p[:140])]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    digest = {r.text: r.d for r in docs.selectExpr("text", "xxhash64(text) AS d").collect()}
    unique = {(r[0] is not None, r[0] or 0, digest[r[1]]): r for r in rows}
    expected = {r: row for r, row in zip(sorted(unique), brute_rows(unique))}
    want = sorted((expected[(r[0] is not None, r[0] or 0, digest[r[1]])] for r in rows), key=repr)
    assert result(S.dedup_spans(docs)) == want


def brute_rows(unique):
    """Rows of ``brute`` in the order of their keys."""
    by_key = brute([(k, k, r[1].encode()) for k, r in unique.items()])
    return [(unique[row[0]][0], *row[1:]) for row in sorted(by_key)]


def test_removed_ranges_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a" * 250, "", 0, 0), (2, "b", "", 0, 0)], SCHEMA)
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in S.dedup_spans(docs).collect()}
    assert got == {1: [(1, 250)], 2: []}
    assert S.dedup_spans(spark.createDataFrame([], SCHEMA)).count() == 0
