"""Reports of sliding windows: state per window only, late events, kept events."""

import json
import os

from sparkfold.streaming.windows import windowed_spread, write_report_batch


def run_files(spark, tmp_path, files):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for k, rows in enumerate(files):                    # a file is a micro-batch
        path = src / f"{k}.json"
        path.write_text("\n".join(json.dumps({"ts": t and f"2024-01-01T{t}:00", "id": i, "lang": lang, "text": text, "count": c})
                                  for t, i, lang, text, c in rows))
        os.utime(path, (1_700_000_000 + 10 * k,) * 2)
    stream = (spark.readStream.schema("ts timestamp_ntz, id long, lang string, text string, count long")
              .option("maxFilesPerTrigger", 1).json(str(src)))
    agg = windowed_spread(stream, "ts", "id", "lang", "count", "text", 3600, 1800, "10 minutes")
    q = (agg.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).outputMode("append").trigger(availableNow=True)
         .foreachBatch(write_report_batch(str(out), "id", "lang", "text", 3600, 1800)).start())
    q.awaitTermination()
    rows = sorted((str(r["window_start"])[11:16], r["id"], r["min_count"], r["max_count"], r["n"], r["retweet_count"],
                   r["total_retweets_in_lang"], r["batch"]) for r in spark.read.parquet(str(out)).collect())
    return rows, [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress], sorted(p.name for p in (out / "_events").iterdir())


def test_state_is_one_row_per_window(spark, tmp_path):
    """The state held a row for each event and window."""
    day = [(f"{h:02d}:{m:02d}", 100 * h + m, "en", f"t{h}{m}", 1) for h in range(4) for m in range(60)]
    rows, state, _ = run_files(spark, tmp_path, [day])
    assert max(state) <= 9                              # windows that start from 23:30 of the day before to 03:30
    assert len(rows) == 60 * 6 and {r[0] for r in rows} == {"00:00", "00:30", "01:00", "01:30", "02:00", "02:30"}
    assert {r[6] for r in rows} == {60}


def test_late_events_count_in_open_windows(spark, tmp_path):
    files = [[("00:10", 1, "en", "x", 5), ("00:40", 1, "en", "x", 9), ("02:00", 2, "en", "x", 1)],
             [("00:50", 1, "en", "x", 20), ("03:30", 2, "en", "x", 4)],             # 00:50: its windows close in this batch
             [("01:40", 3, "en", "x", 1), ("00:55", 1, "en", "x", 99), ("03:31", 2, "en", "x", 4)]]        # 00:55: closed
    rows, _, kept = run_files(spark, tmp_path, files)
    assert rows == [("00:30", 1, 9, 20, 2, 12, 24, 1), ("01:00", 3, 1, 1, 1, 1, 1, 2), ("01:30", 2, 1, 1, 1, 1, 2, 2),
                    ("01:30", 3, 1, 1, 1, 1, 2, 2), ("02:00", 2, 1, 1, 1, 1, 1, 2)]
    assert "_at=0" not in kept and "_at=2" in kept      # events whose windows have all closed are not kept


def test_null_times_ids_and_groups(spark, tmp_path):
    """A null id has no spread, a null group no total (but its counts are part of the id's spread)."""
    files = [[("01:00", 1, "en", "x", 5), ("01:05", 1, None, "x", 9), ("01:10", None, "en", "x", 70), (None, 1, "en", "x", 50),
              ("01:15", 1, "en", None, 6), ("04:00", 2, "en", "x", 1)]]
    rows, _, _ = run_files(spark, tmp_path, files)
    assert rows == [("01:00", 1, 5, 5, 1, 5, 10, 1), ("01:00", 1, 6, 6, 1, 5, 10, 1)]
