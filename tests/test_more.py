"""Differential twins, size checks, empty inputs, report round trip, stream -> batch."""

import random

import pytest
from pyspark.sql import functions as F

from sparkfold.operators.external import observed
from sparkfold.operators.graph import hop_distances, incidence
from sparkfold.operators.intervals import auto_bin_size, intersect_intervals, merge_intervals
from sparkfold.operators.joins import small
from sparkfold.operators.placement import greedy_groups
from sparkfold.operators.spread import spread_report
from sparkfold.operators.topgroup import top_per_group, top_per_group_window
from sparkfold.sinks.report import read_report, write_report
from sparkfold.sources.retweetlog import read_retweet_log, write_retweet_log


def test_top_per_group_twins_agree_on_random_data(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice("abcde"), f"t{rnd.randint(0, 30)}", rnd.randint(0, 9)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, item string, v long")
    a = sorted(tuple(r) for r in top_per_group(df, "k", "item", "v").collect())
    b = sorted(tuple(r) for r in top_per_group_window(df, "k", "item", "v").collect())
    assert a == b


def test_report_round_trip_keeps_commas_quotes_newlines_and_blanks(spark, tmp_path):
    rows = [(1, 'a, "quoted"\nsecond line'), (2, "  padded  "), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    path = write_report(df, str(tmp_path / "rep"), ["id"])
    back = sorted(tuple(r) for r in read_report(spark, path, "id long, text string").collect())
    assert back == sorted(rows, key=lambda r: r[0])


def test_retweet_log_round_trip_and_failfast(spark, tmp_path):
    cols = ["Seconds", "Language", "Language-code", "TotalRetweetsInThatLang", "IDOfTweet",
            "MaxRetweetCount", "MinRetweetCount", "RetweetCount", "Text"]
    rows = [(1, "English", "en", 0, 7, 5, 2, 5, "hi, there"), (2, "English", "en", 0, 8, 1, 1, 1, 'say "x"')]
    df = spark.createDataFrame(rows, cols)
    path = write_retweet_log(df, str(tmp_path / "log"))
    back = read_retweet_log(spark, path)
    rep = spread_report(back, "id", "language_code", "max_count", "min_count", ["text"], total_col="total")
    assert [(r["id"], r["retweet_count"], r["total"], r["text"]) for r in rep.collect()] == [(7, 4, 5, "hi, there")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text(",".join(cols) + "\n1,E,en,0,notanid,1,1,1,t\n")
    with pytest.raises(Exception):
        read_retweet_log(spark, str(tmp_path / "bad"), mode="failfast").collect()
    assert read_retweet_log(spark, str(tmp_path / "bad")).count() == 0


def test_size_checks(spark):
    big = spark.range(0, 100)
    assert small(big, max_rows=10) is big          # over the bound: no broadcast hint
    assert small(big, max_rows=1000) is not big


def test_greedy_groups_many_keys(spark):
    """Any number of keys, and the rule itself: heaviest first onto the least loaded group."""
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 50)) for i in range(100_000)]
    got = {r.k: r.grp for r in greedy_groups(spark.createDataFrame(rows, "k int, n long"), "k", "n", 7).collect()}
    loads = [0] * 7
    for k, n in sorted(rows, key=lambda x: (-x[1], x[0])):
        g = loads.index(min(loads))
        assert got[k] == g
        loads[g] += n


def test_stream_of_a_directory_table(spark, tmp_path):
    from sparkfold.streaming.windows import read_stream_table, run_available_now, start_live, window_counts
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    whole = run_available_now(spark, read_stream_table(spark, str(tmp_path), "events"), "dir-stream")
    assert whole.count() == events.count()
    events.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    empty = run_available_now(spark, read_stream_table(spark, str(tmp_path), "none"), "empty-stream")
    assert empty.count() == 0 and empty.columns == events.columns
    counts = window_counts(read_stream_table(spark, str(tmp_path), "events"), "ts", "event_type", "value", "1 hour", "30 minutes", "1 hour")
    q = start_live(counts, str(tmp_path / "live"), str(tmp_path / "live-checkpoint"), every="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "live")).count() > 0


def test_names_and_script_override(spark):
    from sparkfold.functions.langid import identify_language
    from sparkfold.functions.langnames import with_language_name
    rows = [("ceb", "Cebuano"), ("iw", "Hebrew"), ("sh", "Serbo-Croatian"), ("EN", "English"), ("ZZ", "zz"), (None, None)]
    got = with_language_name(spark.createDataFrame(rows, "code string, want string"), "code").collect()
    assert all(r.language == r.want for r in got)
    docs = spark.createDataFrame([(1, "@ひらがな labas"), (2, "labas ひらがな"), (3, "labas 한국"), (4, "")], "doc_id long, text string")
    profiles = spark.createDataFrame([("lt", "lab", 0.5), ("lt", "aba", 0.5)], "lang string, tri string, f double")
    assert {r.doc_id: r.predicted for r in identify_language(docs, profiles).collect()} == {1: "lt", 2: "ja", 3: "ko", 4: "lt"}
    assert {r.predicted for r in identify_language(docs, profiles.limit(0)).collect()} == {None}


def test_dictionary_by_tag_and_clips(spark, tmp_path):
    from sparkfold.operators.reads import clip_lengths
    from sparkfold.sources.genomics import read_sequence_dict
    (tmp_path / "d.dict").write_text("@HD\tVN:1.0\n@SQ\tAS:hg19\tLN:500\tSN:chr1\n@PG\tID:bwa\n@SQ\tSN:chr2\tLN:x\n")
    assert [tuple(r) for r in read_sequence_dict(spark, str(tmp_path)).orderBy("idx").collect()] == [(0, "chr1", 500), (1, "chr2", 0)]
    rows = [("5H2S10M", 7, 0), ("10M2S3H", 0, 5), ("10M", 0, 0), ("3S4M1S", 3, 1), ("2H8M", 2, 0), ("*", 0, 0)]
    lead, trail = clip_lengths(F.col("c"))
    got = spark.createDataFrame(rows, "c string, a int, b int").select("a", "b", lead.alias("x"), trail.alias("y")).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in got)


def test_islands_keep_their_own_spelling(spark):
    from sparkfold.operators.intervals import merge_intervals
    rows = [("chr1", 1, 10), ("CHR1", 5, 20), ("CHR1", 1000, 1010), ("Chr1", 1005, 1020)]
    got = merge_intervals(spark.createDataFrame(rows, "chrom string, start long, end long"), case_insensitive=True).orderBy("start").collect()
    assert [(r.chrom, r.start, r.end) for r in got] == [("chr1", 1, 20), ("CHR1", 1000, 1020)]


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "chrom string, start long, end long")
    assert merge_intervals(e).count() == 0
    assert intersect_intervals(e, e, bin_size=10).count() == 0
    m = incidence(spark.createDataFrame([(1, 10), (1, 11)], "g long, v long"), "g", "v")
    src = spark.createDataFrame([(99, 99)], "landmark long, vertex long")   # not a vertex
    assert hop_distances(m, src).count() == 0
    assert greedy_groups(spark.createDataFrame([], "k int, n long"), "k", "n", 3).count() == 0


def test_auto_bin_size_and_observed_metrics(spark):
    a = spark.createDataFrame([("c", 0, 100), ("c", 50, 150)], "chrom string, start long, end long")
    assert auto_bin_size(a, a) == 100
    df, obs = observed(spark.range(0, 42), "t", F.sum("id").alias("s"))
    df.collect()
    assert obs.get["rows"] == 42 and obs.get["s"] == sum(range(42))


def test_stream_report_feeds_batch_report(spark, tmp_path):
    """Chained use: the per-window stream output, written as the CSV log, is
    the input of the batch roll-up; totals stay consistent."""
    from sparkfold.streaming.windows import finish_windows

    batch = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 01:00:00", 1, "en", "a", 3, 6, 2),
         ("2024-01-01 00:00:00", "2024-01-01 01:00:00", 2, "en", "b", 1, 1, 1)],
        "window_start string, window_end string, id long, language_code string, text string, "
        "min_count long, max_count long, n long")
    out = finish_windows(batch, "id", "language_code")
    got = {r["id"]: (r["retweet_count"], r["total_retweets_in_lang"]) for r in out.collect()}
    assert got == {1: (4, 9), 2: (1, 9)}      # total = 4 x 2 rows + 1 x 1 row
    log = out.select(F.lit(0).alias("Seconds"), F.col("language_code").alias("Language"),
                     F.col("language_code").alias("Language-code"),
                     F.col("total_retweets_in_lang").alias("TotalRetweetsInThatLang"),
                     F.col("id").alias("IDOfTweet"), F.col("max_count").alias("MaxRetweetCount"),
                     F.col("min_count").alias("MinRetweetCount"), F.col("retweet_count").alias("RetweetCount"),
                     F.col("text").alias("Text"))
    path = write_retweet_log(log, str(tmp_path / "chain"))
    rep = spread_report(read_retweet_log(spark, path), "id", "language_code", "max_count", "min_count", ["text"],
                        total_col="total")
    assert [(r["id"], r["retweet_count"], r["total"]) for r in rep.collect()] == [(1, 4, 5)]


def test_quality_encoding_first_read_mode(spark):
    from sparkfold.operators.reads import quality_encoding

    df = spark.createDataFrame([("g", 1, "III"), ("g", 2, "hhh")], "g string, o int, qual string")
    assert quality_encoding(df, "g").first()["encoding"] == "ILLUMINA"          # group max
    assert quality_encoding(df, "g", first_only_by="o").first()["encoding"] == "SANGER"   # first read only


def test_write_regions_sorted_per_group(spark, tmp_path):
    from sparkfold.operators.placement import write_regions

    rnd = random.Random(2)
    rows = [(rnd.randint(0, 2), rnd.randint(1, 24), rnd.randint(1, 10_000)) for _ in range(500)]
    df = spark.createDataFrame(rows, "grp int, chr int, pos int")
    path = write_regions(df, str(tmp_path / "regions"), "grp", ["chr", "pos"])
    back = spark.read.parquet(path)
    assert back.count() == 500
    for g in range(3):
        files = sorted((tmp_path / "regions" / f"grp={g}").glob("*.parquet"))
        seq = [tuple(r) for f in files for r in spark.read.parquet(str(f)).collect()]
        assert seq == sorted(seq)               # part files in order, rows sorted inside


def test_region_filter_drops_chrM_unmapped_and_unplaced(spark):
    from sparkfold.sources.genomics import sam_regions

    d = spark.createDataFrame([(0, "chrM", 16571), (1, "chr1", 1000), (24, "chrY", 500), (25, "chrUn", 50)],
                              "idx int, name string, length bigint")
    reads = spark.createDataFrame([("a", 0, "chrM"), ("b", 0, "chr1"), ("c", 4, "chr1"), ("d", 0, "chrY"),
                                   ("e", 0, "chrUn"), ("f", 0, "chrZ")], "qname string, flag int, rname string")
    got = sorted((r["qname"], r["region"]) for r in sam_regions(reads, d).collect())
    assert got == [("b", 1), ("d", 24)]


def test_clean_alignments_clip_and_unmapped_mapq(spark):
    from sparkfold.operators.reads import clean_alignments

    d = spark.createDataFrame([(1, "chr1", 100)], "idx int, name string, length bigint")
    reads = spark.createDataFrame([("a", 0, "chr1", 150, 30), ("b", 4, "chr1", 50, 30), ("c", 0, "chr1", 60, 30)],
                                  "qname string, flag int, rname string, aln_end int, mapq int")
    got = {r["qname"]: (r["clean_end"], r["clean_mapq"], r["changed"]) for r in clean_alignments(reads, d).collect()}
    assert got == {"a": (100, 30, True), "b": (50, 0, True), "c": (60, 30, False)}


def test_trim_markers_start_and_end_in_one_record(spark, tmp_path):
    from sparkfold.sources.castlist import END_MARKER, START_MARKER, read_cast_list

    p = tmp_path / "tight.list"
    p.write_bytes(("junk\n" + START_MARKER + "\nA, B\t\tFilm (2015)\n" + END_MARKER + "\nC, D\t\tLate (2016)\n")
                  .encode("latin-1"))
    got = [(r["name"], r["movies"]) for r in read_cast_list(spark, str(p)).collect()]
    assert got == [("A, B", ["Film (2015)"])]


def test_program_that_stops_reading(spark):
    from sparkfold.operators.external import pipe_partitions
    df = spark.range(0, 200_000, numPartitions=2).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    assert pipe_partitions(df, ["head", "-n", "1"]).count() == 2
    with pytest.raises(Exception, match="exited 3"):
        pipe_partitions(df, ["sh", "-c", "exit 3"]).count()
