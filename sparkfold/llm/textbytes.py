"""Vectorised work on the UTF-8 bytes of a column of texts (numpy, inside tasks).

Texts stay in one flat byte buffer; words are (start, end) positions in it.
Batches are cut into slices of a bounded number of bytes (a longer single text
is a slice of its own), so memory does not depend on the batch.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
#: ``[\x20\x09-\x0D]``
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII letters and every byte of a longer character
WORDLIKE = np.zeros(256, bool)
WORDLIKE[0x41:0x5B] = WORDLIKE[0x61:0x7B] = WORDLIKE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_MULT = np.uint64(0x9E3779B97F4A7C15 | 3)           # 3 mod 4: powers stay far from 1
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_BYTE = np.random.default_rng(20240101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_BYTE = _BYTE[LOWER]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row borders) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), borders


def slices(borders: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (or one row)."""
    row, rows = 0, len(borders) - 1
    while row < rows:
        upto = int(np.searchsorted(borders, borders[row] + most, "right")) - 1
        upto = min(max(upto, row + 1), rows)
        yield row, upto
        row = upto


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse for the bytes of one slice."""
    out = []
    for base in (_MULT, _INV):
        steps = np.full(SLICE_BYTES + 1, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(buf: np.ndarray, borders: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of bytes that are ``inside``; a run never crosses rows."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    on = inside[buf]
    edge = np.zeros(n + 1, bool)
    edge[borders[(borders >= 0) & (borders <= n)]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, on[:-1]
    start = np.flatnonzero(on & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, on[1:]
    end = np.flatnonzero(on & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(borders, start, "right") - 1


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of every range (in order of start); with ``fold_case`` A-Z count as a-z."""
    out, byte = np.empty(len(start), np.uint64), _LOWER_BYTE if fold_case else _BYTE
    at = 0
    while at < len(start):                            # some MiB at a time: prefix sums take eight bytes for each byte
        upto = max(at + 1, int(np.searchsorted(end, start[at] + SLICE_BYTES, "right")))
        lo, hi = int(start[at]), int(end[upto - 1])
        if hi - lo > SLICE_BYTES:                     # one long range
            out[at] = _long_hash(buf[lo:hi], byte)
        else:
            s, e = start[at:upto] - lo, end[at:upto] - lo
            up, down = _powers()
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(byte[buf[lo:hi]] * up[:hi - lo], out=total[1:])
            out[at:upto] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = upto
    return out


def _long_hash(buf: np.ndarray, byte: np.ndarray) -> np.uint64:
    """The hash of one range that is longer than a slice, block by block."""
    up, total = _powers()[0], 0
    for k in range(0, len(buf), SLICE_BYTES):
        part = buf[k:k + SLICE_BYTES]
        total += int((byte[part] * up[:len(part)]).sum(dtype=np.uint64)) * pow(int(_MULT), k, 1 << 64)
    return mix(np.array([(total + len(buf)) & ((1 << 64) - 1)], np.uint64))[0]


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str], most_rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``keys``, from batches sorted by them; several short runs come together."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < most_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        first = run_starts(table, keys)[-1]
        if first > 0:
            yield table.slice(0, first)
            table = table.slice(first)
        held, rows = table.combine_chunks().to_batches(), table.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of every run of equal keys (integer columns without nulls)."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        x = table[k].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)
