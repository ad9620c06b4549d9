"""The different numbers that ranges cover, per name.

A task keeps its numbers as sorted arrays and sends them on in blocks of ``BLOCK`` numbers, two bytes each, so no row per range is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.operators.basewise import ragged

BLOCK = 1 << 13
#: numbers that a task holds
HELD = 4_000_000
_SHIFT = 1 << 39


def covered_numbers(ranges: DataFrame) -> DataFrame:
    """(name, first, last) -> (name, number): each number between some first and last (in either order) once; numbers within 2 ** 38 of 0."""
    given = ranges.where("first IS NOT NULL AND last IS NOT NULL").select("name", F.least("first", "last").cast("long").alias("first"), F.greatest("first", "last").cast("long").alias("last"))

    def sent(names: list, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        held, begin = np.unique(keys // BLOCK, return_index=True)
        members = (keys % BLOCK).astype("<u2")
        ends = np.append(begin[1:], len(keys))
        for a in range(0, len(held), 1000):
            some = slice(a, a + 1000)
            texts = [members[i:j].tobytes() for i, j in zip(begin[some].tolist(), ends[some].tolist())]
            block = held[some]
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in (block // (2 * _SHIFT // BLOCK)).tolist()], pa.string()),
                                              pa.array(block % (2 * _SHIFT // BLOCK) - _SHIFT // BLOCK), pa.array(texts, pa.binary())], ["name", "block", "members"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict = {}
        held, size = [], 0
        for batch in batches:
            codes = batch.column("name").dictionary_encode(null_encoding="encode")
            code = np.array([names.setdefault(n, len(names)) for n in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]
            first, last = batch.column("first").to_numpy(), batch.column("last").to_numpy()
            n = last - first + 1
            for a, z in _slices(n):
                # long ranges fill a slice by themselves
                for low in range(0, int(n[a:z].max()), HELD):
                    some = np.clip(n[a:z] - low, 0, HELD)
                    held.append(np.unique(np.repeat(code[a:z] * 2 * _SHIFT, some) + ragged(first[a:z] + low + _SHIFT, some)))
                    size += len(held[-1])
                    if size > HELD:
                        held = [np.unique(np.concatenate(held))]
                        size = len(held[0])
                        if size > HELD // 2:
                            yield from sent(list(names), held[0])
                            names, held, size = dict(names), [], 0
        if held:
            yield from sent(list(names), np.unique(np.concatenate(held)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None

        def done() -> pa.RecordBatch:
            number = np.flatnonzero(held) + key[1] * BLOCK
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()).take(pa.array(np.zeros(len(number), np.int32))), pa.array(number)], ["name", "number"])
        out: list[pa.RecordBatch] = []
        for batch in batches:
            for name, block, members in zip(batch.column("name").to_pylist(), batch.column("block").to_pylist(), batch.column("members").to_pylist()):
                if key != (name, block):
                    if key is not None:
                        out.append(done())
                    key, held = (name, block), np.zeros(BLOCK, bool)
                held[np.frombuffer(members, "<u2")] = True
                if len(out) >= 64:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                    out = []
        if key is not None:
            out.append(done())
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    blocks = given.mapInArrow(collect, "name string, block long, members binary")
    return blocks.repartition("name", "block").sortWithinPartitions("block", "name").mapInArrow(merge, "name string, number long")


def _slices(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of ranges with some ``HELD`` numbers, or one range."""
    total, a = np.cumsum(n), 0
    while a < len(n):
        done = int(total[a - 1]) if a else 0
        z = max(a + 1, int(np.searchsorted(total, done + HELD, side="right")))
        yield a, z
        a = z
