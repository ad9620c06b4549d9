"""External programs over distributed work.

``pipe_files``: one task per file of a folder listing; the task runs the
program on the file path (the file is read by the program from the shared
file system, never shipped through Spark) and every stdout line becomes a
row.  ``pipe_partitions``: the rows of each partition (or of each run of
one key inside it) are streamed as text lines into one process (like
``RDD.pipe``), stdout lines come back as rows.  Output is streamed back in
bounded slices while the program runs; a non-zero exit status fails the
task with the command and the tail of its stderr.
"""

from __future__ import annotations

import queue
import subprocess
import threading
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.ordinals import with_dense_index
from sparkfold.session import local_path


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """(path, length[, partition columns]) of every file; contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(folder).drop("content", "modificationTime")


def pipe_files(files: DataFrame, argv: list[str], path_col: str = "path",
               keep: list[str] | None = None) -> DataFrame:
    """Run ``argv + [file]`` once per file, one file per task."""
    keep = keep or []
    numbered = with_dense_index(files.select(path_col, *keep), [path_col], "_fid")
    n = max(int(numbered.agg(F.max("_fid")).first()[0] or 0) + 1, 1)
    placed = numbered.repartitionById(n, F.col("_fid").cast("int"))
    schema = ", ".join([f"{path_col} string"] + [f"{k} {dict(files.dtypes)[k]}" for k in keep] + ["line string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, row in b.iterrows():
                proc = _Proc(argv + [local_path(row[path_col])])
                for lines in proc.drain():        # output streamed in bounded slices
                    out = pd.DataFrame({"line": lines})
                    for k in reversed([path_col, *keep]):
                        out.insert(0, k, row[k])
                    yield out

    return placed.mapInPandas(run, schema)


class _Proc:
    """One external process fed from the task.  A reader thread moves stdout
    into a queue in chunks, so output is handed on while input is still
    being written (memory bounded by what is in flight, no pipe deadlock)."""

    def __init__(self, argv: list[str]):
        self.argv = argv
        self.p = subprocess.Popen(argv, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE)
        self.q: queue.Queue = queue.Queue()
        self.err: list[bytes] = []
        self.rest = b""
        self.done = False               # the program has closed its output
        self.threads = [threading.Thread(target=self._pump, daemon=True),
                        threading.Thread(target=lambda: self.err.append(self.p.stderr.read()), daemon=True)]
        for t in self.threads:
            t.start()

    def _pump(self) -> None:
        for chunk in iter(lambda: self.p.stdout.read1(1 << 20), b""):
            self.q.put(chunk)
        self.q.put(None)

    def feed(self, lines) -> None:
        """Hand on input; a program that has stopped reading (``head``) is judged by its exit code alone."""
        if self.p.stdin.closed:
            return
        try:
            self.p.stdin.write(("\n".join(lines) + "\n").encode())
        except BrokenPipeError:
            self._close()

    def _close(self) -> None:
        try:
            self.p.stdin.close()
        except BrokenPipeError:
            pass

    def ready_lines(self, block: bool = False) -> list[str]:
        """Complete output lines available now (all of them when ``block``)."""
        parts = []
        while not self.done:
            try:
                item = self.q.get(block=block)
            except queue.Empty:
                break
            if item is None:
                self.done = True
                break
            parts.append(item)
        data = self.rest + b"".join(parts)
        if self.done:
            self.rest = b""
            return data.decode(errors="replace").splitlines()
        cut = data.rfind(b"\n") + 1
        self.rest = data[cut:]
        return data[:cut].decode(errors="replace").splitlines()

    def drain(self, batch_lines: int = 100_000) -> Iterator[list[str]]:
        """Close the input and hand out the output in bounded slices."""
        self._close()
        buf: list[str] = []
        while not self.done:
            item = self.q.get()
            if item is None:
                self.done = True
                break
            data = self.rest + item
            cut = data.rfind(b"\n") + 1
            self.rest = data[cut:]
            buf += data[:cut].decode(errors="replace").splitlines()
            if len(buf) >= batch_lines:
                yield buf
                buf = []
        if self.rest:
            buf += self.rest.decode(errors="replace").splitlines()
            self.rest = b""
        for t in self.threads:
            t.join()
        rc = self.p.wait()
        if rc != 0:
            msg = b"".join(self.err)[-2000:].decode(errors="replace")
            raise RuntimeError(f"{' '.join(self.argv)} exited {rc}: {msg}")
        if buf:
            yield buf


def pipe_partitions(df: DataFrame, argv: list[str], line_col: str = "line",
                    key_col: str | None = None) -> DataFrame:
    """Stream ``line_col`` values into external processes.

    Without ``key_col``: one process per partition (``RDD.pipe``).  With
    ``key_col``: one process per contiguous run of equal keys inside a
    partition, and the key is attached to the output lines.  Sorting by
    (key, ...) inside range partitions (``place_and_sort``) makes every run a
    whole slice of one key, so a hot key is spread over several tasks; with
    exact placement (``repartitionById``) a key is one run in one task.
    """
    cols = [line_col] + ([key_col] if key_col else [])
    key_type = dict(df.dtypes)[key_col] if key_col else None
    schema = "line string" + (f", {key_col} {key_type}" if key_col else "")

    def emit(lines: list[str], key) -> pd.DataFrame:
        res = pd.DataFrame({"line": lines})
        if key_col:
            res[key_col] = key
        return res

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        proc, key = None, None
        for b in batches:
            if b.empty:
                continue
            if not key_col:
                proc = proc or _Proc(argv)
                proc.feed(b[line_col].astype(str))
                early = proc.ready_lines()
                if early:
                    yield emit(early, None)
                continue
            ks = b[key_col].to_numpy()
            cut = [0, *(np.flatnonzero(ks[1:] != ks[:-1]) + 1).tolist(), len(ks)]
            for lo, hi in zip(cut[:-1], cut[1:]):
                k = ks[lo]
                if proc is not None and k != key:
                    for lines in proc.drain():
                        yield emit(lines, key)
                    proc = None
                if proc is None:
                    proc, key = _Proc(argv), k
                proc.feed(b[line_col].iloc[lo:hi].astype(str))
                early = proc.ready_lines()
                if early:
                    yield emit(early, key)
        if proc is not None:
            for lines in proc.drain():
                yield emit(lines, key)

    return df.select(*cols).mapInPandas(run, schema)


def observed(df: DataFrame, name: str, *metrics) -> tuple[DataFrame, "Observation"]:
    """Processing metrics beside the data (rows, plus any extra aggregate
    expressions), collected by Spark from every task without an extra job;
    read ``obs.get`` after the first action on the returned DataFrame."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics), obs
