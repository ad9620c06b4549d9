"""Toxicity scores from a bidirectional gated recurrent network.

Input of the network, per word: the *word* itself (log-odds of its hash among
toxic and clean training documents) and its *characters* (greatest and mean
log-odds of its character n-grams, so that unseen words built on a known stem
are recognised).  A bidirectional GRU reads windows of ``WINDOW`` words, an
attention layer pools its states, a logistic unit gives the window's score.
All windows of a text are scored, each overlapping the next by
``WINDOW - STRIDE`` words; a text's score is that of its worst window.

Training (numpy, on the driver, by back-propagation through time and Adam) is
from document labels only: of a toxic document the window that looks worst so
far counts as toxic, of a clean one the worst and some others as clean.  The
sample is bounded: ``per_class`` documents of each class, whole texts.

Scale: scoring is one pass over the texts without a shuffle, with memory
bounded by slices of 4 MiB; the model has a fixed size.  The sample is drawn
by hash and thinned before it is ranked.

Cases.  Null or empty text, or text without a word: the score of an empty
window, which is that of no evidence (below the threshold).  No labelled row,
or labels of one class only: every text gets the prior share of toxic labels
(0 without labels).  Several label rows of one document: toxic if any says so.
Rows with a null id are scored but never train.  Repeated rows: the same score
each.  Further columns pass through only through ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.llm.textbytes import LOWER, WORDLIKE, column_bytes, mix, range_hashes, slices, words

WINDOW, STRIDE = 48, 36
HIDDEN = 8
WORD_BITS, GRAM_BITS = 18, 18
GRAMS = (3, 4, 5, 6)
INPUTS = 2 + 2 * len(GRAMS)
THRESHOLD = 0.3
FOLDS = 5
WORDS = 1 << 15                 # words whose n-grams are looked up together
BLOCK = 2048                    # windows that are scored together


@dataclass
class Model:
    word_odds: np.ndarray
    gram_odds: np.ndarray
    net: dict[str, np.ndarray]
    constant: float | None = None


# --- inputs -----------------------------------------------------------------------------------------------------

def _gram_places(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram size: (bucket of every n-gram of every word, first n-gram of each word).

    A word has a border mark on each side; shorter words give one n-gram."""
    length = end - start
    out = []
    for n in GRAMS:
        count = np.maximum(length + 2 - n + 1, 1)
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        owner = np.repeat(np.arange(len(start)), count)
        at = np.arange(len(owner)) - first[owner] - 1              # -1: the border mark
        h = np.full(len(owner), n, np.uint64)
        for k in range(n):
            p = at + k
            inside = (p >= 0) & (p < length[owner])
            b = np.where(inside, LOWER[buf[np.minimum(start[owner] + np.maximum(p, 0), max(len(buf) - 1, 0))]], 0)
            h = h * np.uint64(0x100000001B3) + b.astype(np.uint64) + np.uint64(1)
        out.append(((mix(h) >> np.uint64(64 - GRAM_BITS)).astype(np.int64), first))
    return out


def _distinct(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, its first place, number of each word)."""
    return np.unique(range_hashes(buf, start, end), return_index=True, return_inverse=True)


def _word_bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def word_inputs(model: Model, buf: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(word, INPUTS); the last row is that of no word."""
    x = np.zeros((len(h) + 1, INPUTS), np.float32)
    x[:-1, 0] = model.word_odds[_word_bucket(h)]
    x[:-1, 1] = np.minimum(end - start, 40) / 20.0
    for lo in range(0, len(h), WORDS):
        some = slice(lo, min(lo + WORDS, len(h)))
        for k, (bucket, first) in enumerate(_gram_places(buf, start[some], end[some])):
            odds = model.gram_odds[k][bucket]
            count = np.diff(np.append(first, len(odds)))
            x[some, 2 + 2 * k] = np.maximum.reduceat(odds, first)
            x[some, 3 + 2 * k] = np.add.reduceat(odds, first) / count
    return x


# --- network ----------------------------------------------------------------------------------------------------

def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _soft_grad(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.abs(x)) ** 2


def new_net(rng: np.random.Generator) -> dict[str, np.ndarray]:
    net = {}
    for d in ("f", "b"):
        net[f"w_{d}"] = rng.normal(0, 0.3, (INPUTS, 3 * HIDDEN))
        net[f"u_{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        net[f"c_{d}"] = np.concatenate([np.full(HIDDEN, 1.0), np.zeros(2 * HIDDEN)])
    net["a_w"] = rng.normal(0, 0.3, (2 * HIDDEN, HIDDEN))
    net["a_v"] = rng.normal(0, 0.3, HIDDEN)
    net["o_w"] = rng.normal(0, 0.3, 2 * HIDDEN)
    net["o_b"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in net.items()}


def _gru(net: dict, d: str, px: list[np.ndarray], keep: bool) -> tuple[list[np.ndarray], list[tuple]]:
    """States for every step.  ``px``: the inputs times w, per step, in reading order.

    Gates: z (keep the state), r (use it), n (the new content); softsign squashing."""
    h = np.zeros((len(px[0]), HIDDEN), np.float32)
    u_zr, u_n = net[f"u_{d}"][:, :2 * HIDDEN], net[f"u_{d}"][:, 2 * HIDDEN:]
    states, tape = [], []
    for p in px:
        a = p[:, :2 * HIDDEN] + h @ u_zr
        g = 0.5 + 0.5 * _soft(a)
        z, r = g[:, :HIDDEN], g[:, HIDDEN:]
        q = p[:, 2 * HIDDEN:] + (r * h) @ u_n
        n = _soft(q)
        new = n + z * (h - n)
        if keep:
            tape.append((h, a, z, r, q, n))
        h = new
        states.append(h)
    return states, tape


def project(net: dict, table: np.ndarray) -> dict[str, np.ndarray]:
    """What the inputs of every word add to the gates, per direction."""
    return {d: table @ net[f"w_{d}"] + net[f"c_{d}"] for d in ("f", "b")}


def forward(net: dict, table: np.ndarray, ids: np.ndarray, keep: bool = False, projected: dict | None = None):
    """Logit of every window.  ``table``: inputs of the distinct words, ``ids``: (window, step) rows of it, -1: none."""
    mask = ids >= 0
    steps = ids.shape[1]
    if projected is None:                               # only the words at hand
        used, ids = np.unique(ids, return_inverse=True)
        projected, ids = project(net, table[used]), ids.reshape(mask.shape)
    out = {}
    tapes = {}
    for d in ("f", "b"):
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        states, tape = _gru(net, d, [projected[d][ids[:, t]] for t in order], keep)
        out[d], tapes[d] = (states if d == "f" else states[::-1]), tape
    h = np.concatenate([np.stack(out["f"], 1), np.stack(out["b"], 1)], 2)          # (window, step, 2 HIDDEN)
    q = h @ net["a_w"]
    k = _soft(q)
    e = np.where(mask, k @ net["a_v"], -30.0)
    e -= e.max(1, keepdims=True)
    alpha = np.exp(e)
    alpha /= alpha.sum(1, keepdims=True)
    pooled = np.einsum("wt,wtd->wd", alpha, h)
    logit = pooled @ net["o_w"] + net["o_b"][0]
    return (logit, (mask, h, q, k, alpha, pooled, tapes)) if keep else logit


def backward(net: dict, table: np.ndarray, ids: np.ndarray, saved: tuple, d_logit: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of all weights."""
    mask, h, q, k, alpha, pooled, tapes = saved
    grad = {name: np.zeros_like(v) for name, v in net.items()}
    grad["o_w"] = pooled.T @ d_logit
    grad["o_b"] = np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * net["o_w"]
    dh = alpha[:, :, None] * d_pooled[:, None, :]
    d_alpha = np.einsum("wd,wtd->wt", d_pooled, h)
    de = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True)) * mask
    grad["a_v"] = np.einsum("wt,wtd->d", de, k)
    dq = de[:, :, None] * net["a_v"] * _soft_grad(q)
    grad["a_w"] = np.einsum("wtd,wte->de", h, dq)
    dh = dh + dq @ net["a_w"].T
    steps = ids.shape[1]
    for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        u_zr, u_n = net[f"u_{d}"][:, :2 * HIDDEN], net[f"u_{d}"][:, 2 * HIDDEN:]
        order = list(range(steps)) if d == "f" else list(range(steps - 1, -1, -1))
        carry = np.zeros((len(ids), HIDDEN), np.float32)
        for j in range(steps - 1, -1, -1):
            t = order[j]
            before, a, z, r, qn, n = tapes[d][j]
            g = dh[:, t, part] + carry
            dn = g * (1 - z) * _soft_grad(qn)
            dz = g * (before - n)
            d_rh = dn @ u_n.T
            da = np.concatenate([dz, d_rh * before], 1) * 0.5 * _soft_grad(a)
            carry = g * z + d_rh * r + da @ u_zr.T
            dp = np.concatenate([da, dn], 1)
            grad[f"w_{d}"] += table[ids[:, t]].T @ dp
            grad[f"c_{d}"] += dp.sum(0)
            grad[f"u_{d}"][:, :2 * HIDDEN] += before.T @ da
            grad[f"u_{d}"][:, 2 * HIDDEN:] += (r * before).T @ dn
    return grad


# --- windows ----------------------------------------------------------------------------------------------------

def window_ids(number: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, WINDOW) word numbers (-1: none) of all windows, and the row of each.  A row without words has one empty window."""
    count = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    n_windows = np.maximum(1, -(-(count - (WINDOW - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(rows), n_windows)
    k = np.arange(len(owner)) - np.concatenate([[0], np.cumsum(n_windows)[:-1]])[owner]
    at = k[:, None] * STRIDE + np.arange(WINDOW)[None, :]
    inside = at < count[owner][:, None]
    if not len(number):
        return np.full(at.shape, -1, np.int32), owner
    ids = number[np.minimum(first[owner][:, None] + at, len(number) - 1)]
    return np.where(inside, ids, -1).astype(np.int32), owner


def score_slice(model: Model, buf: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Score of every row."""
    rows = len(borders) - 1
    if model.constant is not None:
        return np.full(rows, model.constant)
    start, end, row = words(buf, borders, WORDLIKE)
    h, place, number = _distinct(buf, start, end) if len(start) else (np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int))
    table = word_inputs(model, buf, start[place], end[place], h)
    ids, owner = window_ids(number, row, rows)
    projected = project(model.net, table)
    logit = np.concatenate([forward(model.net, table, ids[k:k + BLOCK], projected=projected) for k in range(0, len(ids), BLOCK)]) \
        if len(ids) else np.zeros(0)
    worst = np.full(rows, -np.inf)
    np.maximum.at(worst, owner, logit)
    return 1 / (1 + np.exp(-np.clip(worst, -30, 30)))


# --- training ---------------------------------------------------------------------------------------------------

def _pairs(row: np.ndarray, bucket: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, bucket) pairs."""
    both = np.sort(row.astype(np.int64) * size + bucket)
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    return (both // size).astype(np.int32), (both % size).astype(np.int32)


def _parts(doc: np.ndarray, docs: int = 100) -> Iterator[slice]:
    """Slices of the sorted ``doc``, ``docs`` documents each."""
    borders = np.searchsorted(doc, np.arange(0, doc[-1] + 1 + docs, docs)) if len(doc) else []
    return (slice(a, b) for a, b in zip(borders, borders[1:]) if b > a)


def _odds(row: np.ndarray, bucket: np.ndarray, toxic: np.ndarray, docs: np.ndarray, size: int) -> np.ndarray:
    """Log-odds of a bucket's presence in one of the marked ``docs``, shrunk towards none; 0 for a bucket never seen."""
    pos = np.bincount(bucket[(docs & toxic)[row]], minlength=size)
    neg = np.bincount(bucket[(docs & ~toxic)[row]], minlength=size)
    n_pos, n_neg = max(1, int((toxic & docs).sum())), max(1, int((~toxic & docs).sum()))
    even, total = 2.0, n_pos + n_neg              # as if seen so often in either class, at the rate of each
    odds = np.log((pos + even * n_pos / total) / n_pos * n_neg / (neg + even * n_neg / total))
    return np.where(pos + neg > 0, odds, 0).astype(np.float32)


def train(texts: list[str], toxic: list[int], seed: int = 5, steps: int = 300, batch: int = 192) -> Model:
    label = np.array(toxic, bool)
    if not len(label) or label.all() or not label.any():
        return Model(np.zeros(0), np.zeros(0), {}, float(label.mean()) if len(label) else 0.0)
    rng = np.random.default_rng(seed)
    buf, borders = column_bytes(pa.array(texts, pa.large_string()))
    start, end, row = words(buf, borders, WORDLIKE)
    h, place, number = _distinct(buf, start, end)
    s, e = start[place], end[place]
    # n-grams belong to words: a document has those of the words it has
    doc, word = _pairs(row, number, len(h))
    kinds = [(_pairs(doc, _word_bucket(h)[word], 1 << WORD_BITS), 1 << WORD_BITS)]
    parts: list[list] = [[] for _ in GRAMS]
    for few in _parts(doc):                             # some documents at a time, to bound the memory
        used, local = np.unique(word[few], return_inverse=True)
        for k, (bucket, at) in enumerate(_gram_places(buf, s[used], e[used])):
            count = np.diff(np.append(at, len(bucket)))[local]
            flat = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[local], count)
            parts[k].append(_pairs(np.repeat(doc[few], count), bucket[flat], 1 << GRAM_BITS))
    kinds += [(tuple(np.concatenate(x) for x in zip(*part)), 1 << GRAM_BITS) for part in parts]
    del parts

    def odds_of(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds from the marked documents alone."""
        by_word, *by_gram = [_odds(of, bucket, label, docs, size) for (of, bucket), size in kinds]
        return by_word, np.stack(by_gram)

    # a training document must not see evidence that it supplied: inputs of each fold come from the other folds
    fold = rng.permutation(len(texts)) % FOLDS
    tables = [word_inputs(Model(*odds_of(fold != k), {}), buf, s, e, h) for k in range(FOLDS)]
    table = np.concatenate([*(t[:-1] for t in tables), tables[0][-1:]])
    model = Model(*odds_of(np.ones(len(texts), bool)), new_net(rng))
    ids, owner = window_ids(number, row, len(texts))
    ids = np.where(ids >= 0, ids + (fold[owner] * len(h))[:, None], -1).astype(np.int32)
    odds_sum = np.append(table[:-1, [0, *range(2, INPUTS, 2)]].sum(1), -9)
    evidence = odds_sum[ids].max(1)
    first, second = {k: np.zeros_like(v) for k, v in model.net.items()}, {k: np.zeros_like(v) for k, v in model.net.items()}
    step = 0
    while step < steps:
        looks = evidence if step < steps // 4 else np.concatenate(
            [forward(model.net, table, ids[k:k + BLOCK]) for k in range(0, len(ids), BLOCK)])
        order = np.lexsort((looks, owner))
        worst = order[np.append(np.flatnonzero(np.diff(owner[order])), len(order) - 1)]
        bad, good = worst[label[owner[worst]]], worst[~label[owner[worst]]]
        clean = np.flatnonzero(~label[owner])
        good = np.concatenate([good, rng.choice(clean, min(len(clean), len(good)), replace=False)])
        for _ in range(75):
            x = ids[np.concatenate([rng.choice(bad, batch // 3), rng.choice(good, batch - batch // 3)])]
            x = np.concatenate([x, np.full((2, WINDOW), -1, ids.dtype)])           # empty windows are clean
            y = (np.arange(len(x)) < batch // 3).astype(np.float32)
            logit, saved = forward(model.net, table, x, keep=True)
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            grad = backward(model.net, table, x, saved, ((p - y) / len(y)).astype(np.float32))
            step += 1
            rate = 0.03 * max(0.05, 1 - step / steps)
            for name, g in grad.items():                                            # Adam
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                model.net[name] = model.net[name] - (rate * (first[name] / (1 - 0.9 ** step))
                                                     / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic): at most ``per_class`` labelled documents of each class, those with the smallest hashes of their id."""
    marked = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    kept = marked.withColumnRenamed("_id", id_col).where(usable)
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = kept.groupBy("toxic").agg((F.lit(3.0 * per_class) / F.count("*")).alias("_rate"))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)))
    chosen = (kept.join(F.broadcast(rate), "toxic").where(draw < F.col("_rate")).withColumn("_rank", rank)
              .where(F.col("_rank") <= per_class).select(F.col(id_col).alias("_id"), "toxic"))       # 2 per_class rows
    texts = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
            .groupBy("_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))     # one row of a repeated id


def fit(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 1000, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """A model of the labelled documents for which ``usable`` (over ``id_col``) holds."""
    rows = sorted(tuple(r) for r in training_rows(docs, labels, usable, per_class, id_col, text_col).collect())
    return train([r[0] for r in rows], [r[1] for r in rows])


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of every row's whole text appended; the other columns are not touched.

    A column of ``docs`` named ``score_col`` is replaced."""
    docs = docs.drop(score_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)          # a fixed number of buckets
    at = docs.columns.index(text_col)
    schema = docs.withColumn(score_col, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            buf, borders = column_bytes(batch.column(at))
            scores = [score_slice(own, buf[borders[a]:borders[b]], borders[a:b + 1] - borders[a]) for a, b in slices(borders)]
            column = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, score_col])
    return docs.mapInArrow(run, schema)
