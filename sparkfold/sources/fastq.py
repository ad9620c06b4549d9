"""FASTQ source (S7) as a Python Data Source: ``spark.read.format("fastq")``.

Every file is cut into byte ranges (``splitSize``; default ``auto`` = total
size / 16 clamped to 4..128 MB); each range is one input partition read by
an executor.  A reader that starts inside a file resyncs
on the first line that starts with ``@`` and whose second-next line starts
with ``+`` (a quality line may itself start with ``@``, but the line two
below it is a sequence line, never ``+``).  A record belongs to the range
holding its first byte, so every record is read exactly once.  Gzip files
are not splittable and are read whole by one task.

Output columns: file, split_start, rec_in_split, offset (byte offset of the
record), name, sequence, plus, quality, complete (False for a truncated last
record).  ``with_record_ordinal`` turns (split_start, rec_in_split) into a
0-based record number per file -- or across all files in file-name order --
from a per-split count table, without sorting records.

Files are opened through ``pyarrow.fs`` so any URI the cluster mounts works.
"""

from __future__ import annotations

import gzip

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = ("file string, split_start long, rec_in_split long, offset long, name string, "
          "sequence string, plus string, quality string, complete boolean")
_FIELDS = ["file", "split_start", "rec_in_split", "offset", "name", "sequence", "plus", "quality", "complete"]
_BATCH = 4096


def _filesystem(uri: str):
    if uri.startswith("file:"):
        uri = uri[5:]
        while uri.startswith("//"):
            uri = uri[1:]
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class _Split(InputPartition):
    def __init__(self, path: str, start: int, end: int, whole: bool):
        self.path, self.start, self.end, self.whole = path, start, end, whole


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path") or options.get("paths")
        size = options.get("splitSize", "auto")
        self.split_size = None if size == "auto" else int(size)

    def partitions(self):
        fsys, root = _filesystem(self.path)
        info = fsys.get_file_info(root)
        if info.type == pafs.FileType.Directory:
            infos = fsys.get_file_info(pafs.FileSelector(root, recursive=True))
        else:
            infos = [info]
        files = sorted((i for i in infos if i.type == pafs.FileType.File
                        and not i.base_name.startswith(("_", "."))), key=lambda i: i.path)
        split = self.split_size or _auto_split(sum(i.size for i in files))
        parts = []
        for i in files:
            if i.path.endswith(".gz"):
                parts.append(_Split(i.path, 0, i.size, True))
                continue
            for s in range(0, max(i.size, 1), split):
                parts.append(_Split(i.path, s, min(s + split, i.size), False))
        return parts

    def read(self, split: _Split):
        fsys, _ = _filesystem(split.path)
        if split.whole:
            with fsys.open_input_stream(split.path, compression=None) as raw:
                yield from _stream_records(split.path, gzip.GzipFile(fileobj=raw, mode="rb"))
            return
        with fsys.open_input_file(split.path) as f:
            yield from _split_records(split.path, f, split.start, split.end)


_BLOCK = 4 << 20


def _first_record(data: bytes, limit: int, final: bool) -> int | None:
    """Where the first record of a split starts in ``data`` (it begins with the byte before the split); None if more bytes must be
    read to tell, -1 if there is none before ``limit``."""
    unknown = -1 if final else None
    at = data.find(b"\n") + 1
    if not at:
        return unknown
    while at < limit:
        second = data.find(b"\n", at) + 1
        third = data.find(b"\n", second) + 1 if second else 0
        if not third or third == len(data):
            return unknown
        if data.startswith(b"@", at) and data.startswith(b"+", third):
            return at
        at = second
    return -1


def _split_records(path: str, stream, start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The records that start in [start, end) of a file, read block by block: each block is cut after its last complete
    record and the rest carried over, so memory is bounded by the block (or the longest record), not by the split."""
    base = max(start - 1, 0)
    stream.seek(base)
    data, rec0, searching = b"", 0, start > 0
    while base < end:
        chunk = stream.read(_BLOCK)
        final = not chunk
        data += chunk
        if searching:
            at = _first_record(data, end - base, final)
            if at == -1:
                return
            if at is None:
                continue
            base, data, searching = base + at, data[at:], False
        if not data:
            return
        cut = len(data) if final else _record_cut(data)
        block, data = data[:cut], data[cut:]
        n = 0
        for batch in _records(path, block, base, base, end, final=final, resync=False, split_start=start, rec_base=rec0) if block else ():
            n += batch.num_rows
            yield batch
        rec0, base = rec0 + n, base + cut
        if final:
            return


def _stream_records(path: str, stream) -> Iterator[pa.RecordBatch]:
    """A non-splittable (gzip) file, decompressed and parsed block by block:
    each block is cut after its last complete 4-line record and the rest is
    carried into the next block, so memory stays bounded by the block size."""
    carry, consumed, rec0 = b"", 0, 0
    while True:
        chunk = stream.read(_BLOCK)
        final = not chunk
        data = carry + chunk
        if not data:
            return
        cut = len(data) if final else _record_cut(data)
        block, carry = data[:cut], data[cut:]
        n = 0
        for batch in _records(path, block, consumed, consumed, consumed + len(block) + 1, final=final,
                              resync=False, split_start=0, rec_base=rec0):
            n += batch.num_rows
            yield batch
        rec0 += n
        consumed += len(block)
        if final:
            return


def _record_cut(data: bytes) -> int:
    """Byte position just after the last newline that closes a 4-line record."""
    n = data.count(b"\n")
    if n < 4:
        return 0
    pos = len(data)
    for _ in range(n % 4 + 1):
        pos = data.rfind(b"\n", 0, pos)
    return pos + 1


def _auto_split(total: int) -> int:
    """About 16 splits for small inputs, 128 MB splits for large ones."""
    return int(min(max(total // 16, 4 << 20), 128 << 20))


def _records(path: str, data: bytes, base: int, start: int, end: int, final: bool,
             resync: bool | None = None, split_start: int | None = None, rec_base: int = 0):
    """Parse records whose first byte lies in [start, end) of the file;
    ``data`` holds the file bytes from offset ``base``.  Lines are split and
    located in bulk (bytes.split, numpy offsets, Arrow casts); only the
    resync probe at the start of a split looks at single lines."""
    pos = 0 if base == start else data.find(b"\n", 0) + 1   # first line starting at >= start
    if base != start and pos == 0:
        return
    lines = data[pos:].split(b"\n")
    if lines and lines[-1] == b"" and data.endswith(b"\n"):
        lines.pop()                               # the final newline ends a line, it does not start one
    if not lines:
        return
    lens = np.fromiter((len(x) for x in lines), dtype=np.int64, count=len(lines))
    offs = base + pos + np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    k = 0
    if (start > 0) if resync is None else resync:   # '@' line whose second-next line starts with '+'
        while k < len(lines):
            if lines[k].startswith(b"@") and k + 2 < len(lines) and lines[k + 2].startswith(b"+"):
                break
            k += 1
    firsts = offs[k::4]
    n_rec = int(np.searchsorted(firsts, end, side="left"))   # records starting before `end`
    if n_rec == 0:
        return
    full = min(n_rec, (len(lines) - k) // 4)                  # records with all four lines present
    if full < n_rec and not final:
        n_rec = full
    for lo in range(0, n_rec, _BATCH):
        hi = min(lo + _BATCH, n_rec)
        yield _bulk_batch(path, start if split_start is None else split_start, lines, k, offs, lo, hi, full,
                          rec_base)


def _text(col: list) -> pa.Array:
    arr = pa.array(col, type=pa.binary()).cast(pa.string())
    return pc.utf8_rtrim(arr, characters="\r")


def _bulk_batch(path: str, start: int, lines: list, k: int, offs, lo: int, hi: int, full: int,
                rec_base: int = 0) -> pa.RecordBatch:
    n = hi - lo
    fields = []
    for f in range(4):
        col = lines[k + 4 * lo + f: k + 4 * hi + f: 4]
        col = col + [None] * (n - len(col))                    # lines missing from a truncated record
        fields.append(_text(col))
    complete = pa.array([lo + i < full for i in range(n)], type=pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n, type=pa.string()), pa.array([start] * n, type=pa.int64()),
         pa.array(np.arange(lo, hi, dtype=np.int64) + rec_base), pa.array(offs[k + 4 * lo: k + 4 * hi: 4][:n]),
         *fields, complete], names=_FIELDS)


class FastqDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options)


def register(spark: SparkSession) -> None:
    """Register the ``fastq`` data source with this session."""
    spark.dataSource.register(FastqDataSource)


def read_fastq(spark: SparkSession, path: str, split_size: int | None = None) -> DataFrame:
    """FASTQ files -> one row per record (see module docstring); ``split_size`` in bytes or auto."""
    register(spark)
    r = spark.read.format("fastq").option("path", path)
    if split_size:
        r = r.option("splitSize", str(split_size))
    return r.load()


def with_record_ordinal(reads: DataFrame, name: str = "ordinal", per_file: bool = False) -> DataFrame:
    """0-based record number in (file, offset) order from per-split counts."""
    counts = reads.groupBy("file", "split_start").agg(F.count(F.lit(1)).alias("_n"))
    if per_file:
        w = Window.partitionBy("file").orderBy("split_start")
    else:   # one row per split: a single-partition window over it is bounded
        w = Window.orderBy("file", "split_start")
    off = counts.select("file", "split_start",
                        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                        .alias("_off"))
    return (reads.join(off, ["file", "split_start"])
            .withColumn(name, F.col("_off") + F.col("rec_in_split")).drop("_off"))


def fastq_text(name, sequence, plus, quality):
    """One record as four lines (the writer adds the final newline)."""
    return F.concat_ws("\n", name, sequence, plus, quality)

