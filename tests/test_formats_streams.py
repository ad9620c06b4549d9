"""FASTQ splits and resync, pairing, chunks, external programs, ordinals, streams."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from sparkfold.operators.external import list_files, pipe_files, pipe_partitions
from sparkfold.operators.ordinals import with_dense_index, with_file_ordinal
from sparkfold.operators.pairing import interleave, write_chunks
from sparkfold.sources.fastq import read_fastq, with_record_ordinal
from sparkfold.streaming.windows import dedup_stream, run_available_now, window_counts


def fastq_records(n, seed=0, tag="r"):
    rnd = random.Random(seed)
    recs = []
    for i in range(n):
        k = rnd.randint(0, 40)
        seq = "".join(rnd.choice("ACGT") for _ in range(k))
        # qualities deliberately start with '@' or '+' often
        qual = "".join(rnd.choice("@+I#") for _ in range(k))
        recs.append((f"@{tag}{i}", seq, "+", qual))
    return recs


def test_fastq_tiny_splits_resync_exactly_once(spark, tmp_path):
    recs = fastq_records(500)
    p = tmp_path / "a.fq"
    p.write_text("".join("\n".join(r) + "\n" for r in recs).rstrip("\n"))   # no final newline
    raw = read_fastq(spark, str(p), split_size=97)
    assert raw.rdd.getNumPartitions() > 50
    df = with_record_ordinal(raw)
    got = sorted((r["ordinal"], r["name"], r["sequence"], r["quality"]) for r in df.collect())
    assert got == [(i, *r[:2], r[3]) for i, r in enumerate(recs)]


def test_fastq_truncated_last_record_is_flagged(spark, tmp_path):
    p = tmp_path / "b.fq"
    p.write_text("@x\nAC\n+\nII\n@y\nAC\n")
    rows = {r["name"]: r["complete"] for r in read_fastq(spark, str(p)).collect()}
    assert rows == {"@x": True, "@y": False}


def test_interleave_pairs_by_ordinal_and_rejects_unequal_counts(spark, tmp_path):
    a, b = tmp_path / "1.fq", tmp_path / "2.fq"
    ra, rb = fastq_records(60, 1, "a"), fastq_records(60, 2, "b")
    a.write_text("".join("\n".join(r) + "\n" for r in ra))
    b.write_text("".join("\n".join(r) + "\n" for r in rb))
    A = with_record_ordinal(read_fastq(spark, str(a), split_size=200))
    B = with_record_ordinal(read_fastq(spark, str(b), split_size=333))
    pairs = {r["ordinal"]: r["pair"] for r in interleave(A, B).collect()}
    assert pairs[7] == "\n".join(ra[7]) + "\n" + "\n".join(rb[7])
    out = str(tmp_path / "chunks")
    write_chunks(interleave(A, B), 3, out)
    files = [f for f in os.listdir(out) if f.endswith(".gz")]
    assert 1 <= len(files) <= 3
    text = b"".join(gzip.open(os.path.join(out, f)).read() for f in files).decode()
    assert text.count("\n") == 60 * 8
    b.write_text("".join("\n".join(r) + "\n" for r in rb[:-1]))
    B2 = with_record_ordinal(read_fastq(spark, str(b)))
    with pytest.raises(Exception):
        interleave(A, B2).collect()


def test_pipe_files_one_task_per_file_and_pipe_partitions(spark, tmp_path):
    d = tmp_path / "files"
    d.mkdir()
    for i in range(5):
        (d / f"f{i}.txt").write_text("x\n" * (i + 1))
    out = pipe_files(list_files(spark, str(d), "*.txt"), ["wc", "-l"])
    counts = sorted(int(r["line"].split()[0]) for r in out.collect())
    assert counts == [1, 2, 3, 4, 5]
    df = spark.createDataFrame([(g, f"l{i}") for g in range(3) for i in range(g + 2)], "g int, line string")
    res = pipe_partitions(df.repartitionById(3, "g"), ["wc", "-l"], key_col="g")
    assert sorted((r["g"], int(r["line"])) for r in res.collect()) == [(0, 2), (1, 3), (2, 4)]
    with pytest.raises(Exception):
        pipe_partitions(df, ["false"]).collect()


def test_dense_index_and_file_ordinal(spark, tmp_path):
    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 2000).alias("k"))
    assert with_dense_index(df, ["k"], "i").where("i != k").count() == 0
    p = tmp_path / "lines.txt"
    p.write_text("".join(f"{i:05d}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        o = with_file_ordinal(spark.read.text(str(p)))
        assert o.where(F.format_string("%05d", "line_no") != F.col("value")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stream_windows_equal_batch_on_closed_windows(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{m:02d}:00", "a" if i % 2 else "b", float(i)) for i, m in
            enumerate([1, 5, 12, 14, 20, 33, 41, 47, 58, 59])]
    src = tmp_path / "ev"
    spark.createDataFrame(rows, "id long, ts string, k string, v double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    stream = spark.readStream.schema(schema).parquet(str(src))
    out = run_available_now(spark, window_counts(stream, "ts", "k", "v", "10 minutes", "5 minutes", "5 minutes"),
                            "t-win")
    got = sorted((str(r["window_start"]), r["k"], r["n"]) for r in out.collect())
    # watermark = 00:54, so windows ending after it stay open
    minute = {i: m for i, m in enumerate([1, 5, 12, 14, 20, 33, 41, 47, 58, 59])}
    want = {}
    for i, m in minute.items():
        for start in (m // 5 * 5, m // 5 * 5 - 5):
            if 0 <= start and start + 10 <= 54:
                want[(f"2024-01-01 00:{start:02d}:00", "a" if i % 2 else "b")] = want.get((f"2024-01-01 00:{start:02d}:00", "a" if i % 2 else "b"), 0) + 1
    assert [g for g in got if g[0] >= "2024-01-01 00:00:00"] == sorted((*k, n) for k, n in want.items())
    assert all(r[0] <= "2024-01-01 00:44:00" for r in got)
    dd = run_available_now(spark, dedup_stream(stream.unionByName(spark.readStream.schema(schema).parquet(str(src))),
                                               "ts", "id", "1 hour").select("id"), "t-dedup")
    assert sorted(r["id"] for r in dd.collect()) == list(range(10))


def test_fastq_splits_are_read_block_by_block(spark, tmp_path, monkeypatch):
    """Records of a split larger than a block, lines that look like headers, CRLF, a truncated end: the same records for all sizes."""
    from sparkfold.sources import fastq

    rng = random.Random(4)
    text = b""
    for i in range(60):
        n = rng.choice([0, 1, 7, 40, 900])
        seq = "".join(rng.choice("ACGT") for _ in range(n))
        qual = "".join(rng.choice("@+I#") for _ in range(n))
        text += f"@r{i}\n{seq}\n+{rng.choice(['', 'r'])}\n{qual}\n".encode().replace(b"\n", rng.choice([b"\n", b"\r\n"]))
    path = tmp_path / "x.fq"
    for end in (b"", b"@last\nACG\n", b"@last\nACG\n+\nIII"):
        path.write_bytes(text + end)

        def rows(size):
            reader = fastq.FastqReader({"path": str(path), "splitSize": str(size)})
            got = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
            for split in {r["split_start"] for r in got}:
                assert [r["rec_in_split"] for r in got if r["split_start"] == split] == list(range(sum(r["split_start"] == split for r in got)))
            return [tuple(r[c] for c in ("offset", "name", "sequence", "plus", "quality", "complete")) for r in got]
        want = rows(1 << 20)
        assert len(want) == 60 + bool(end) and [r[0] for r in want] == sorted({r[0] for r in want}) and want[0][1] == "@r0"
        assert all(r[5] for r in want) is (end != b"@last\nACG\n")
        for block in (16, 61, 300):
            monkeypatch.setattr(fastq, "_BLOCK", block)
            # a split that starts at a truncated record cannot tell it from a quality line
            assert all(rows(size) == want for size in ((1 << 20,) if not all(r[5] for r in want) else (1 << 20, 700, 333)))
        monkeypatch.setattr(fastq, "_BLOCK", 4 << 20)


def test_fastq_reader_holds_blocks_not_splits(tmp_path):
    import tracemalloc

    from sparkfold.sources import fastq

    path = tmp_path / "x.fq"
    path.write_bytes((b"@r\n" + b"A" * 500 + b"\n+\n" + b"I" * 500 + b"\n") * 40_000)          # 40 MB
    reader = fastq.FastqReader({"path": str(path), "splitSize": str(1 << 30)})
    tracemalloc.start()
    assert sum(b.num_rows for b in reader.read(reader.partitions()[0])) == 40_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
