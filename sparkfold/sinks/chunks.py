"""Chunk sink (K3) with a task log (K10), as a Python Data Source: ``df.write.format("chunks")``.

Every task writes one gzip text file, ``chunk{partition}.fq.gz``, one line (or several, if the value holds line breaks) per row.
It writes under ``_attempts``, under a name of its own; only when all tasks have succeeded, ``commit`` gives the
files their names and writes the log beside the folder (``<path>-tasks/tasks.csv``): one row per task with partition, attempt, file, rows, bytes and times.  A retried or speculative
attempt leaves nothing behind, and a failed job removes all its files.  Tasks without rows write no file and have a row in the log.

Modes: ``overwrite`` replaces the chunks and the log; ``append`` refuses a folder that holds chunks.  Null values are empty lines.
Rows hold one string column.  Files are reached through ``pyarrow.fs``, as in the FASTQ source.
"""

from __future__ import annotations

import gzip
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from sparkfold.sources.fastq import _filesystem

LOG = "partition int, attempt int, file string, rows long, bytes long, started double, ended double"
ATTEMPTS, TASKS = "_attempts", "-tasks"


@dataclass
class Written(WriterCommitMessage):
    partition: int
    attempt: int
    temporary: str
    rows: int
    size: int
    started: float
    ended: float


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context, started = TaskContext.get(), time.time()
        partition, attempt = context.partitionId(), context.attemptNumber()
        fsys, root = _filesystem(self.path)
        name, rows, size = f"chunk{partition}.{attempt}.{uuid.uuid4().hex}", 0, 0
        batches = (b for b in iterator if b.num_rows)
        first = next(batches, None)
        if first is not None:
            fsys.create_dir(f"{root}/{ATTEMPTS}", recursive=True)
            with fsys.open_output_stream(f"{root}/{ATTEMPTS}/{name}", compression=None) as raw:
                with gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) as out:
                    for batch in chain([first], batches):
                        out.write("".join(f"{v or ''}\n" for v in batch.column(0).to_pylist()).encode())
                        rows += batch.num_rows
            size = fsys.get_file_info(f"{root}/{ATTEMPTS}/{name}").size
        return Written(partition, attempt, name if rows else "", rows, size, started, time.time())

    def commit(self, messages: list[Written | None]) -> None:
        fsys, root = _filesystem(self.path)
        fsys.create_dir(root, recursive=True)
        old = [i.path for i in fsys.get_file_info(pafs.FileSelector(root)) if i.base_name.startswith("chunk")]
        if old and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"{self.path} holds chunks already")
        for path in old:
            fsys.delete_file(path)
        lines = [",".join(c.split()[0] for c in LOG.split(", "))]
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            final = f"chunk{m.partition}.fq.gz" if m.temporary else ""
            if final:
                fsys.move(f"{root}/{ATTEMPTS}/{m.temporary}", f"{root}/{final}")
            lines.append(f"{m.partition},{m.attempt},{final},{m.rows},{m.size},{m.started},{m.ended}")
        fsys.create_dir(f"{root}{TASKS}", recursive=True)
        with fsys.open_output_stream(f"{root}{TASKS}/tasks.csv") as out:
            out.write(("\n".join(lines) + "\n").encode())
        self._clear(fsys, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_filesystem(self.path))

    @staticmethod
    def _clear(fsys: pafs.FileSystem, root: str) -> None:
        if fsys.get_file_info(f"{root}/{ATTEMPTS}").type == pafs.FileType.Directory:
            fsys.delete_dir(f"{root}/{ATTEMPTS}")


class ChunkDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "chunks"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options["path"], overwrite)


def write_chunk_files(df: DataFrame, path: str, line: str, chunk: str | None = None, n: int | None = None) -> str:
    """``line`` of every row into one file per partition; with ``chunk`` (0 .. n-1), rows go to the partition of that number."""
    df.sparkSession.dataSource.register(ChunkDataSource)
    if chunk is not None:
        df = df.repartitionById(n, F.col(chunk))
    df.select(F.col(line).cast("string").alias("value")).write.format("chunks").mode("overwrite").save(path)
    return path


def read_task_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of the job that wrote ``path``: one row per task."""
    return spark.read.schema(LOG).option("header", True).csv(f"{path.rstrip('/')}{TASKS}")
