"""Near-duplicate embeddings by randomly rotated binary codes.

Every vector is scaled to length 1 and rotated at random; the signs are its
binary code, and ``factor``, the inner product of the code's unit vector with
the rotated vector, is stored with it.  For a pair, the code of one and the
rotated vector of the other give the unbiased estimate

    <code, rotated> / factor        with standard error sqrt((1 - factor^2) / (factor^2 (D - 1)))

A pair whose estimate plus ``SIGMAS`` standard errors stays below the threshold
is done with; all other pairs are recomputed from the vectors in double
precision, and only these can link.

Which pairs are compared: bits of the codes also name buckets, ``bits`` bits
for each of ``tables`` tables, and vectors meet that share a bucket in some
table.  The bits grow with the number of vectors, so buckets do not; the
tables follow so that a pair just at the threshold is missed with a chance of
at most ``miss`` (closer pairs far less).  A pair is counted in the first table
it shares only.

Scale: equal vectors are one representative with a multiplicity, so a group of
copies of any size is one row.  A bucket of more than ``TILE`` vectors is cut
into chunks whose pairs are separate pieces of work.  A piece gives one row for
each of its vectors (its links, its smallest linked vector), never a row per
pair.

Cases.  Vectors that are null, empty, zero, or hold null or non-finite
components, vectors of different length and vectors with a null label link with
nothing.  Rows repeated with one id are one vector (the smallest, if they
differ), and each gets that vector's result.  A null id: no links, no
component, not kept.  Empty tables give empty results.  Further columns are
ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import settled
from sparkfold.llm.components import connected
from sparkfold.llm.textbytes import run_starts, sorted_runs

TILE = 512
SIGMAS = 5.0


@functools.lru_cache(maxsize=16)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random rotation, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)         # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def buckets(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(vector, table): bucket numbers from the signs of as many rotations as it takes."""
    dim = x.shape[1]
    signs = np.concatenate([x @ rotation(dim, k + 1).T >= 0 for k in range(-(-bits * tables // dim))], 1)[:, :bits * tables]
    return signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def table_count(bits: int, threshold: float, miss: float) -> int:
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - meet))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def name_buckets(bits: int, tables: int):
    """Batches of (vec_id, dim, embedding) -> vec_id and its bucket in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                x = unit(_matrix(batch.column(2).take(pa.array(here)), int(dim)))
                b = buckets(x, bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[here], tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(here))),
                     pa.array(b.ravel())], ["vec_id", "t", "bucket"])
    return run


def linked_pairs(x: np.ndarray, left: np.ndarray, names: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of ``x`` that link and do not meet in an earlier table.

    ``left``: side of each row; rows of different sides are paired, or all rows if there is one side only."""
    dim = x.shape[1]
    turned = x @ rotation(dim, 0).T
    code = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(dim)
    factor = (code * turned).sum(1)
    error = np.sqrt(np.maximum(0.0, 1 - factor ** 2) / (factor ** 2 * max(1, dim - 1)))
    estimate = (code @ turned.T) / factor[:, None]
    open_ = estimate + SIGMAS * error[:, None] >= threshold
    if left.any() and not left.all():
        open_ &= left[:, None] & ~left[None, :]
    else:
        open_ &= np.triu(np.ones((len(x), len(x)), bool), 1)
    i, j = np.nonzero(open_)
    first = ~(names[i, :table] == names[j, :table]).any(1)
    i, j = i[first], j[first]
    good = np.concatenate([np.einsum("nd,nd->n", x[i[k:k + 65536]], x[j[k:k + 65536]]) >= threshold
                           for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
    return i[good], j[good]


def smallest_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every row the smallest row it reaches by the links (i, j)."""
    least = np.arange(n)
    while True:
        m = np.minimum(least[i], least[j])
        new = least.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def compare(bits: int, tables: int, threshold: float):
    """Sorted batches of (piece key, side, t, vec_id, copies, dim, embedding) -> vec_id, links, root."""
    keys = ["k1", "k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, keys, 1 << 14):
            starts = run_starts(group, keys)
            ids, copies, side = group["vec_id"].to_numpy(), group["copies"].to_numpy(), group["side"].to_numpy()
            t, dims = group["t"].to_numpy(), group["dim"].to_numpy()
            out_id, out_links, out_root = [], [], []
            for s, e in zip(starts, np.append(starts[1:], len(ids))):
                if e - s < 2:
                    continue
                x = unit(_matrix(group["embedding"].slice(s, e - s), int(dims[s])))
                order = np.argsort(ids[s:e], kind="stable")
                x, own, many, at = x[order], ids[s:e][order], copies[s:e][order], side[s:e][order]
                i, j = linked_pairs(x, at == 0, buckets(x, bits, tables), int(t[s]), threshold)
                if len(i):
                    links = np.bincount(i, many[j], e - s) + np.bincount(j, many[i], e - s)
                    hit = links > 0
                    out_id.append(own[hit]), out_links.append(links[hit].astype(np.int64))
                    out_root.append(own[smallest_reached(e - s, i, j)[hit]])
            if out_id:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (out_id, out_links, out_root)],
                                                 ["vec_id", "links", "root"])
    return run


def link_embeddings(vectors: DataFrame, threshold: float = 0.93, miss: float = 1e-4, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``."""
    whole = (vectors.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("embedding"),
                     F.col(label_col).cast("string").alias("label")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))
    valid = (whole.where(usable).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v"))
             .select("vec_id", "v.*", F.size("v.embedding").alias("dim"),
                     F.xxhash64("v.label", "v.embedding").alias("h1"), F.xxhash64(F.lit(3), "v.label", "v.embedding").alias("h2")))
    valid = settled(valid, "vectors")
    classes = settled(valid.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    reps = settled(valid.join(classes.select(F.col("rep").alias("vec_id"), "copies"), "vec_id"), "vector-reps")
    n = reps.count()
    bits = max(8, math.ceil(math.log2(max(n, 1) / 4096)))
    tables = table_count(bits, threshold, miss)
    group = ["label", "dim", "t", "bucket"]
    named = settled(reps.select("vec_id", "dim", "embedding").mapInArrow(name_buckets(bits, tables), "vec_id long, t int, bucket long")
                    .join(reps.select("vec_id", "label", "dim"), "vec_id"), "vector-buckets")
    size = named.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1").withColumn("chunks", F.ceil(F.col("n") / TILE).cast("int"))
    own = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    pieces = (named.join(size, group).withColumn("own", own)
              .select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
              .select("vec_id", "t", (F.col("own") > F.col("other")).cast("int").alias("side"),
                      *[F.xxhash64(F.lit(k), *group, F.least("own", "other"), F.greatest("own", "other")).alias(f"k{k}") for k in (1, 2)]))
    work = pieces.join(reps.select("vec_id", "copies", "dim", "embedding"), "vec_id")
    links = settled(work.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
                    .mapInArrow(compare(bits, tables, threshold), "vec_id long, links long, root long"), "vector-links")
    count = links.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    per_class = (classes.join(count, "rep", "left").join(component, F.col("rep") == F.col("node"), "left")
                 .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    found = valid.select(F.col("vec_id").alias("_id"), "h1", "h2").join(per_class, ["h1", "h2"]).drop("h1", "h2")
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    component_id = F.coalesce("component_id", "vec_id")
    return (ids.join(found, F.col("vec_id") == F.col("_id"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept")))
