"""Language identification with error-correcting output codes.

Every language gets a codeword; binary classifiers on hashed byte n-grams
predict the bits.  A text is decoded to the language whose codeword has the
smallest loss, the loss of every bit weighted by how well its classifier did
on the training texts of that language.  Texts whose two best languages lie
close together are flagged as ambiguous.

Features: counts of byte bigrams and trigrams of the lower-cased text, other
ASCII than letters as one blank, hashed into ``BUCKETS`` buckets; square roots,
scaled to unit length.  Training: a bounded sample of whole labelled texts
(``per_language`` each, about ``total`` in all, every language at least one), and
one short piece of each, by logistic regression in numpy on the driver, which
holds the features of the sample sparse and makes blocks of them dense.

Scale: scoring is one pass over the texts without a shuffle; the model has a
fixed size.  The sample is drawn by hash and thinned before it is ranked.

Cases.  A column named as a helper of this module does not matter.  Null text or text without a letter: ``und``, score 0.  No labelled row
at all: every text is ``und``.  One language only: it gets every text with a
letter.  Rows with a null language do not train.  Repeated rows: the same
result each.  Further columns pass through only through ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.llm.common import bounded_broadcast, settled
from sparkfold.llm.textbytes import LOWER, WORDLIKE, column_bytes, slices

BUCKETS = 1 << 13
_FOLD = np.where(WORDLIKE, LOWER, np.uint8(0x20)).astype(np.uint8)
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray             # (language, bit), -1 or 1
    weights: np.ndarray          # (BUCKETS, bit)
    bias: np.ndarray
    trust: np.ndarray            # (language, bit), sums to 1 for each language


# --- features ---------------------------------------------------------------------------------------------------

def features(buf: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """(row, BUCKETS) float32."""
    u = _FOLD[buf].astype(np.uint32)
    n = len(u)
    two = np.zeros(n, np.uint32)
    three = np.zeros(n, np.uint32)
    if n > 1:
        two[:-1] = ((u[:-1] << 8) | u[1:]) * np.uint32(2654435761) >> np.uint32(19)
    if n > 2:
        three[:-2] = ((u[:-2] << 16) | (u[1:-1] << 8) | u[2:]) * np.uint32(2246822519) >> np.uint32(19)
    out = np.zeros((len(borders) - 1, BUCKETS), np.float32)
    for row in range(len(borders) - 1):
        s, e = borders[row], borders[row + 1]
        if e - s > 1:
            out[row] = np.bincount(three[s:max(s, e - 2)], minlength=BUCKETS) + np.bincount(two[s:e - 1], minlength=BUCKETS)
    np.sqrt(out, out=out)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def has_letter(buf: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Whether each row holds a letter (of any script)."""
    ascii_letter = WORDLIKE[buf] & (buf < 0x80)
    total = np.concatenate([[0], np.cumsum(ascii_letter, dtype=np.int64)])
    found = total[borders[1:]] > total[borders[:-1]]
    for row in np.flatnonzero(~found):
        text = buf[borders[row]:borders[row + 1]].tobytes()
        found[row] = any(c.isalpha() for c in text.decode("utf-8", "replace"))
    return found


def _pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return column_bytes(pa.array(texts, pa.large_string()))


# --- training ---------------------------------------------------------------------------------------------------

def codewords(n: int, rng: np.random.Generator) -> np.ndarray:
    """A code of n words: every dichotomy for up to five, else the best of some random ones by least distance."""
    if n <= 5:
        halves = [[(k >> i) & 1 for i in range(n)] for k in range(1, 1 << (n - 1))]
        return np.array(halves, np.float32).T * 2 - 1 if halves else np.ones((n, 0), np.float32)
    bits, best, least = int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (n, bits)) * 2 - 1
        if (np.abs(code.sum(0)) == n).any():
            continue
        d = ((bits - code @ code.T) // 2 + np.eye(n, dtype=int) * bits).min()
        if d > least:
            best, least = code, d
    return (best if best is not None else rng.integers(0, 2, (n, bits)) * 2 - 1).astype(np.float32)


def train(texts: list[str], langs: list[str], seed: int = 11, rounds: int = 120) -> Model:
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    if not languages:
        return Model([], *(np.zeros((0, 0), np.float32) for _ in range(4)))
    code = codewords(len(languages), rng)
    # besides the whole texts, a short piece of each from a random place
    pieces = []
    for t in texts:
        words = t.split()
        k = int(rng.integers(2, 13))
        at = int(rng.integers(0, max(1, len(words) - k)))
        pieces.append(" ".join(words[at:at + k]))
    seen = [_sparse(t) for t in [*texts, *pieces]]
    number = {lang: i for i, lang in enumerate(languages)}
    label = np.array([number[y] for y in [*langs, *langs]], int)
    share = 1 / np.maximum(np.bincount(label, minlength=len(languages)), 1)[label].astype(np.float32)
    share /= max(share.sum(), 1e-9)
    w, b = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for k in range(1, rounds + 1):                                # Adam on all rows, a block of them at a time
        gw, gb = 1e-6 * w, np.zeros_like(b)
        for at in _blocks(len(seen)):
            x = _dense(seen[at])
            g = (1 / (1 + np.exp(-(x @ w + b))) - (code[label[at]] + 1) / 2) * share[at, None]
            gw += x.T @ g
            gb += g.sum(0)
        for value, grad, first, second in ((w, gw, m, v), (b, gb, mb, vb)):
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            value -= 0.5 * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-8)
    trust = np.zeros_like(code)
    for at in _blocks(len(seen)):
        np.add.at(trust, label[at], (_dense(seen[at]) @ w + b > 0) == (code[label[at]] > 0))
    trust /= np.maximum(np.bincount(label, minlength=len(languages)), 1)[:, None]
    return Model(languages, code, w, b, trust / np.maximum(trust.sum(1, keepdims=True), 1e-9))


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of a text's features."""
    row = features(*_pack([text]))[0]
    at = np.flatnonzero(row)
    return at.astype(np.uint16), row[at]


def _dense(seen: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(seen), BUCKETS), np.float32)
    for row, (at, value) in zip(out, seen):
        row[at] = value
    return out


def _blocks(n: int, rows: int = 512) -> Iterator[slice]:
    return (slice(k, min(n, k + rows)) for k in range(0, n, rows))


def training_rows(docs: DataFrame, usable: Column, per_language: int, id_col: str, text_col: str, lang_col: str,
                  total: int = 4000) -> DataFrame:
    """(text, lang): at most ``per_language`` rows of each language, those with the smallest hashes of their id; if there are
    many languages fewer of each, about ``total`` in all, but one at least."""
    rows = (docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    count = settled(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.xxhash64("id")).alias("first")), "language-counts")
    most = max(1, min(per_language, total // max(1, count.count())))
    rate = count.select("lang", "first", (F.lit(3.0 * most) / F.col("n")).alias("rate"))
    # the row with the smallest hash of its language stands in for a language that draws none
    thin = rows.join(bounded_broadcast(rate), "lang").where((draw < F.col("rate")) | (F.xxhash64("id") == F.col("first")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text"))
    return thin.withColumn("rank", rank).where(F.col("rank") <= most).select("text", "lang")


def fit(docs: DataFrame, usable: Column, per_language: int = 300, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", total: int = 4000) -> Model:
    """A model of at most ``per_language`` texts of each language among the ``usable`` rows, and about ``total`` in all."""
    rows = sorted(tuple(r) for r in training_rows(docs, usable, per_language, id_col, text_col, lang_col, total).collect())
    return train([r[0] for r in rows], [r[1] for r in rows])


# --- prediction -------------------------------------------------------------------------------------------------

def predict(model: Model, buf: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number or -1, score, ambiguous) for every row."""
    rows = len(borders) - 1
    best, score, unclear = np.full(rows, -1), np.zeros(rows), np.zeros(rows, bool)
    if not model.languages:
        return best, score, unclear
    margins = features(buf, borders) @ model.weights + model.bias
    loss = np.log1p(np.exp(np.clip(-margins[:, None, :] * model.code[None], -30, 30)))      # (row, language, bit)
    total = (loss * model.trust[None]).sum(2) * max(1, model.code.shape[1])
    p = np.exp(-(total - total.min(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    first = p.argmax(1)
    top = p[np.arange(rows), first]
    ok = has_letter(buf, borders)
    rest = p.copy()
    rest[np.arange(rows), first] = 0
    return np.where(ok, first, -1), np.where(ok, top, 0.0), ok & (top - rest.max(1) < 0.2)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score (0 to 1) and ambiguous of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)          # a fixed number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            buf, borders = column_bytes(batch.column(1))
            for a, b in _groups(borders):
                at = borders[a:b + 1]
                best, score, unclear = predict(own, buf[at[0]:at[-1]], at - at[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([own.languages[k] if k >= 0 else UNKNOWN for k in best], pa.string()),
                     pa.array(score, pa.float64()), pa.array(unclear)], [id_col, "lang_pred", "score", "ambiguous"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, ambiguous boolean")


def _groups(borders: np.ndarray, rows: int = 256) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded bytes and at most ``rows`` rows (a row of features is 32 KB)."""
    for a, b in slices(borders):
        for k in range(a, b, rows):
            yield k, min(b, k + rows)
