"""The live log source over restarts and growth, the join of two streams, elapsed seconds."""

import datetime as dt
import random

import pytest

from sparkfold.sources.linelog import LineLogReader, stream_lines
from sparkfold.streaming.windows import interval_join, run_available_now, run_to_end


def drain(reader):
    """All batches of a reader from where it stands: lists of (file, at, value)."""
    start, out = dict(reader.seen), []
    while (end := reader.latestOffset()) != start:
        rows = [r for p in reader.partitions(start, end) for b in reader.read(p) for r in b.to_pylist()]
        out.append([(r["file"], r["at"], r["value"]) for r in rows])
        start = end
    return out


def lines_of(folder):
    want = []
    for p in sorted(folder.iterdir()):
        at = 0
        for line in p.read_bytes().split(b"\n"):
            if at < p.stat().st_size:
                want.append((p.name, at, line.decode("utf-8", "replace")))
            at += len(line) + 1
    return want


@pytest.mark.parametrize(("admit", "split"), [(1, 1), (7, 3), (64, 10), (1000, 1000), (50, 64)])
def test_offsets_reach_every_line_once(tmp_path, admit, split):
    rng = random.Random(admit)
    for k in range(4):
        text = "".join("x" * rng.randrange(12) + "é" * rng.randrange(3) + "\n" for _ in range(20))
        (tmp_path / f"log{k}").write_text(text[:-1] if k == 1 else text)
    (tmp_path / "log2").write_text("")
    options = {"path": str(tmp_path), "maxbytespertrigger": str(admit), "splitbytes": str(split)}
    batches = drain(LineLogReader(options))
    assert [r for b in batches for r in b] == lines_of(tmp_path)
    for b in batches:
        assert len(b) == 1 or sum(len(v.encode()) + 1 for _, _, v in b) <= admit + 1
    # a new reader told the last offset (as after a restart) goes on behind it, and waits for the end of a line
    again, last = LineLogReader(options), {"file": "log3", "byte": (tmp_path / "log3").stat().st_size}
    assert again.partitions(last, last) == []
    with open(tmp_path / "log3", "a") as f:
        f.write("new")
    assert again.latestOffset() == last
    with open(tmp_path / "log3", "a") as f:
        f.write(" line\nhalf")
    assert [[r[2] for r in b] for b in drain(again)] == [["new line"]]
    (tmp_path / "log4").write_text("next\n")
    assert [r[2] for b in drain(again) for r in b] == ["half", "next"]


def test_live_source_restarts_without_loss_or_repeats(spark, tmp_path):
    log, out, checkpoint = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    log.mkdir()
    (log / "a").write_text("".join(f"a{i}\n" for i in range(50)))
    (log / "_hidden").write_text("no\n")

    def run():
        stream = stream_lines(spark, str(log), max_bytes=60, split_bytes=25).select("value")
        return sorted(r["value"] for r in run_to_end(spark, stream, out, checkpoint).collect())
    want = [f"a{i}" for i in range(50)]
    assert run() == sorted(want)
    with open(log / "a", "a") as f:
        f.write("more\nunfinished")
    assert run() == sorted([*want, "more"])
    (log / "b").write_text("last\n")
    assert run() == sorted([*want, "more", "unfinished", "last"])
    with pytest.raises(ValueError):
        LineLogReader({"path": str(log), "maxbytespertrigger": "0"})


def test_join_of_two_streams(spark, tmp_path):
    rng, t0 = random.Random(2), dt.datetime(2024, 1, 1)

    def rows(n, name):
        return [(rng.choice([1, 1, 1, 2, None]), f"{name}{i}", t0 + dt.timedelta(seconds=rng.randrange(4000)) if i else None) for i in range(n)]
    a, b = rows(60, "a"), rows(60, "b")
    b += [(1, "border", a[5][2] + dt.timedelta(seconds=300)), (1, "same", a[5][2])]
    a[5] = (1, *a[5][1:])
    frames = []
    for name, data in (("l", a), ("r", b)):
        path = str(tmp_path / name)
        spark.createDataFrame(data, f"k int, {name}_id string, {name}_ts timestamp_ntz").write.parquet(path)
        frames.append(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path))
    got = run_available_now(spark, interval_join(*frames, "k", "l_ts", "r_ts", 300, "1 hour"), "pairs")
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] is not None and x[0] == y[0] and x[2] and y[2]
                  and dt.timedelta() <= y[2] - x[2] <= dt.timedelta(seconds=300))
    assert sorted((r["l_id"], r["r_id"]) for r in got.collect()) == want and len(want) > 50
    with pytest.raises(ValueError):
        interval_join(frames[0], frames[0], "k", "l_ts", "l_ts", 300, "1 hour")
