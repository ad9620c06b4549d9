"""Live source over growing log files (S8, ST1): ``spark.readStream.format("linelog")``, replayable and with admission control.

A folder holds UTF-8 logs that are appended to in name order: only the last file grows, and a new file's name sorts after the others (rotation by
date or number).  An offset is then one pair (file, byte), whatever the number of files: all files before ``file`` and its first ``byte``
bytes have been read.  Offsets always stand behind a line break, so a line still being written waits for its end; the unfinished last
line of a file that is no longer the last counts as a line.

``maxBytesPerTrigger`` bounds what a micro-batch admits (one line at least); ``splitBytes`` is the share of one task.  A batch is
planned from its two offsets alone: after a crash the same batch reads the same lines, and a restart goes on where the
checkpoint ends.  Rows: ``file``, ``at`` (byte offset of the line) and ``value``.  Files whose names begin with ``_`` or ``.`` are passed over.
Undecodable bytes become U+FFFD; an empty folder gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sparkfold.sources.fastq import _filesystem

SCHEMA = "file string, at long, value string"
_ARROW = pa.schema([("file", pa.string()), ("at", pa.int64()), ("value", pa.string())])
_BLOCK = 4 << 20


@dataclass
class LineRange(InputPartition):
    """Lines that begin in [low, high) of a file; ``border``: a line begins at ``low``."""
    file: str
    low: int
    high: int
    border: bool


def _line_end(stream: pa.NativeFile, at: int, size: int) -> int:
    """The first place behind a line break at or after ``at``; ``size`` if there is none."""
    while at < size:
        stream.seek(at)
        block = stream.read(min(_BLOCK, size - at))
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return size


def _last_line_end(stream: pa.NativeFile, low: int, high: int) -> int:
    """The last place behind a line break in (low, high]; ``low`` if there is none."""
    while high > low:
        start = max(low, high - _BLOCK)
        stream.seek(start)
        found = stream.read(high - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        high = start
    return low


class LineLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.admit = int(options.get("maxbytespertrigger", 1 << 40))
        self.split = int(options.get("splitbytes", 64 << 20))
        if self.admit <= 0 or self.split <= 0:
            raise ValueError("maxBytesPerTrigger and splitBytes must be positive")
        self.seen = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"file": "", "byte": 0}

    def _files(self, fsys: pafs.FileSystem, root: str) -> list[tuple[str, int]]:
        found = fsys.get_file_info(pafs.FileSelector(root))
        return sorted((i.base_name, i.size) for i in found if i.type == pafs.FileType.File and i.base_name[0] not in "_.")

    def latestOffset(self) -> dict:
        fsys, root = _filesystem(self.path)
        files, room, at = self._files(fsys, root), self.admit, dict(self.seen)
        for k, (name, size) in enumerate(files):
            if name < at["file"]:
                continue
            low = at["byte"] if name == at["file"] else 0
            last = k == len(files) - 1
            if low >= size:
                if low > size:
                    raise ValueError(f"{name} has shrunk from {low} bytes to {size}")
                at = {"file": name, "byte": size}
                continue
            with fsys.open_input_file(f"{root}/{name}") as stream:
                high = min(low + room, size)
                end = high if high == size and not last else _last_line_end(stream, low, high)
                if end == low and room == self.admit:           # one line longer than the limit
                    end = _line_end(stream, low, size)
                    stream.seek(max(end - 1, 0))
                    if last and end == size and stream.read(1) != b"\n":
                        end = low
            if end > low:
                at = {"file": name, "byte": end}
                room -= end - low
            if end < size or room <= 0:
                break
        self.seen = at
        return dict(at)

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        self.seen = dict(end)                   # also what a restarted query begins with
        if start == end:
            return []
        fsys, root = _filesystem(self.path)
        parts = []
        for name, size in self._files(fsys, root):
            if not start["file"] <= name <= end["file"]:
                continue
            low = start["byte"] if name == start["file"] else 0
            high = end["byte"] if name == end["file"] else size
            parts += [LineRange(name, b, min(b + self.split, high), b == low) for b in range(low, high, self.split)]
        return parts

    def read(self, part: LineRange) -> Iterator[pa.RecordBatch]:
        fsys, root = _filesystem(self.path)
        with fsys.open_input_file(f"{root}/{part.file}") as stream:
            size = stream.size()
            # a line begins at ``low`` if the byte before ends one
            at = part.low if part.border else _line_end(stream, part.low - 1, size)
            while at < part.high:
                want = min(at + _BLOCK, part.high)
                end = _line_end(stream, want - 1, size)          # the last line may reach past the range
                stream.seek(at)
                lines = stream.read(end - at).split(b"\n")
                if not lines[-1]:
                    lines.pop()
                starts, place = [], at
                for line in lines:
                    starts.append(place)
                    place += len(line) + 1
                yield pa.RecordBatch.from_arrays([pa.array([part.file] * len(lines)), pa.array(starts, pa.int64()),
                                                  pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())], schema=_ARROW)
                at = end

    def commit(self, end: dict) -> None:
        """Files are kept: nothing to release."""


class LineLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "linelog"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineLogReader:
        return LineLogReader({k.lower(): v for k, v in self.options.items()})


def stream_lines(spark: SparkSession, path: str, max_bytes: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """The lines of a folder of logs as a stream."""
    spark.dataSource.register(LineLogSource)
    reader = spark.readStream.format("linelog").option("path", path)
    for name, value in (("maxBytesPerTrigger", max_bytes), ("splitBytes", split_bytes)):
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()
