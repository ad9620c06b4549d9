"""Pileups, calls, recalibration, CIGAR clips, template duplicates and the chunk sink on small cases."""

import collections
import glob
import gzip
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from sparkfold.operators.pileup import (BASES, aligned_bases, call_variants, clip_past_end, covariates, pileup, recalibrate, with_reference)
from sparkfold.operators.reads import duplicate_metrics, library_size, mark_template_duplicates, templates
from sparkfold.sinks.chunks import read_task_log, write_chunk_files

READS = "qname string, flag int, rname string, pos int, aln_end int, cigar string, seq string, qual string"


def walk(cigar, pos):
    """(position, read offset) of every base on the reference."""
    out, read, n = [], 0, ""
    for c in cigar or "":
        if c.isdigit():
            n += c
            continue
        k, n = int(n or 0), ""
        if c in "M=X":
            out += [(pos + i, read + i) for i in range(k)]
        read += k if c in "MIS=X" else 0
        pos += k if c in "MDN=X" else 0
    return out


def reads_of(spark, rows):
    return spark.createDataFrame(rows, READS)


CIGARS = ["5M", "2S3M1I2M2D3M1S", "3M4N2M", "2H4M", "*", None, "", "1I2M", "4=1X"]


def test_bases_on_the_reference(spark):
    rows = [(f"r{i}", 0, "c", 10 * i, 0, c, "ACGTNACGTACGTA", "ABCDEFGHIJKLMN") for i, c in enumerate(CIGARS)]
    rows += [("short", 0, "c", 5, 0, "5M", "ACGTA", "AB"), ("none", 0, "c", None, 0, "5M", "ACGTA", "ABCDE"), ("null", 0, "c", 3, 0, "2M", None, None)]
    got = sorted((r.qname, r.pos, r.base, r.q, r.at, r.before) for r in aligned_bases(reads_of(spark, rows), "qname").collect())
    want = []
    for name, _, _, pos, _, cigar, seq, qual in rows:
        for p, i in walk(cigar, pos) if pos is not None and seq else []:
            if i < len(qual) and i < len(seq) and seq[i] in BASES:
                want.append((name, p, seq[i], ord(qual[i]) - 33, i, seq[i - 1] if i else ""))
    assert got == sorted(want)


def test_calls_against_direct_likelihoods(spark):
    rng = random.Random(3)
    rows = []
    for k in range(400):
        start = rng.randrange(1, 60)
        seq = "".join("T" if p == 30 else rng.choice("AG") if p == 40 else rng.choice("ACGT") if rng.random() < 0.02 else "A" for p in range(start, start + 12))
        rows.append((f"r{k}", 0, "c", start, 0, "12M", seq, "".join(chr(33 + rng.randrange(2, 41)) for _ in range(12))))
    rows.append(("n", 0, "other", 5, 0, "2M", "CC", "II"))                                   # no reference there
    reference = spark.createDataFrame([("c", 0, "a" * 50), ("c", 1, "A" * 20 + "N" * 30)], "name string, number long, bases string")
    calls = {r.pos: r for r in call_variants(with_reference(pileup(aligned_bases(reads_of(spark, rows))), reference, 50)).collect()}
    seen = collections.defaultdict(list)
    for _, _, rname, pos, _, cigar, seq, qual in rows:
        for p, i in walk(cigar, pos) if rname == "c" else []:
            seen[p].append((seq[i], min(10 ** (-(ord(qual[i]) - 33) / 10), 0.75)))
    for p, bases in seen.items():
        n = collections.Counter(b for b, _ in bases)
        others = sorted((b for b in n if b != "A"), key=lambda b: (-n[b], b))
        if p > 70 or not others:
            assert p not in calls
            continue
        like = [sum(math.log10(sum((1 - e if b == x else e / 3) / 2 for x in g)) for b, e in bases) for g in ("AA", "A" + others[0], others[0] * 2)]
        best = max(like)
        pl = [round(10 * (best - x), 3) for x in like]
        if like.index(best) and pl[0] >= 31:
            r = calls[p]
            assert (r.ref, r.alt, r.gt, r.dp, r.ad_ref, r.ad_alt) == ("A", others[0], ["0/0", "0/1", "1/1"][like.index(best)], len(bases), n["A"], n[others[0]])
            assert all(abs(a - b) <= 0.51 for a, b in zip(r.pl, pl)) and r.qual == r.pl[0]
        elif pl[0] < 29 or not like.index(best):
            assert p not in calls
    assert calls[30].gt == "1/1" and calls[40].gt == "0/1"


def test_recalibration(spark):
    rows = [("a", 0, "c", 1, 4, "4M", "ACGT", "IIII"), ("b", 16, "c", 1, 4, "4M", "ACTT", "IIII"), ("c", 0, "c", 1, 4, "4M", "ACGT", "II"),
            ("d", 0, "c", None, None, "4M", "GGGG", "5555"), ("e", None, "c", 1, 4, "4M", None, None)]
    reads = reads_of(spark, rows)
    named = reads.withColumn("is_reverse", F.coalesce(F.col("flag"), F.lit(0)).bitwiseAND(16) != 0).withColumn("length", F.length("qual"))
    reference = spark.createDataFrame([("c", 0, "ACGT" * 5)], "name string, number long, bases string")
    bases = with_reference(aligned_bases(named, "is_reverse", "length"), reference, 20)
    known = spark.createDataFrame([("c", 2), ("c", 2)], "rname string, pos int")
    table = covariates(bases, known)
    got = {(r.q, r.cycle, r.context): (r.n, r.wrong, r.empirical) for r in table.collect()}
    assert got == {(40, 1, "A"): (2, 0, 6), (40, 3, "CG"): (1, 0, 5), (40, 4, "GT"): (1, 0, 5), (40, 4, "A"): (1, 0, 5), (40, 2, "CT"): (1, 1, 2),
                   (40, 1, "TT"): (1, 0, 5)}
    new = {r.qname: r.new_qual for r in recalibrate(reads, table).collect()}
    assert new == {"a": "'I&&", "b": "&I#&", "c": "'I", "d": "5555", "e": None}
    with pytest.raises(ValueError):
        recalibrate(reads, table, max_rows=2)


def test_clip_past_end(spark):
    cases = {"5M": (98, "3M2S", 100), "2S6M1S": (97, "2S4M3S", 100), "3M2I4M2H": (98, "3M6S2H", 100), "3M2D3M": (97, "3M1D3S", 100),
             "4M1S": (101, "5S", 100), "4M": (97, "4M", 100), "10M": (1, "10M", 10)}
    rows = [(c, 0, "c", pos, pos + sum(1 for _ in walk(c.replace("D", "M"), 0)) - 1, c, "", "") for c, (pos, *_) in cases.items()]
    rows += [("x", 0, "unknown", 98, 102, "5M", "", ""), ("*", 4, "c", 200, 199, "*", "", "")]
    lengths = spark.createDataFrame([("c", 100), ("z", 0)], "name string, length long")
    got = {r.qname: (r.clean_cigar, r.clean_end) for r in clip_past_end(reads_of(spark, rows), lengths).collect()}
    want = {c: (new, end) for c, (_, new, end) in cases.items()} | {"x": ("5M", 102)}
    assert {k: v for k, v in got.items() if k != "*"} == want


def test_template_duplicates(spark):
    def read(name, flag, pos, q="I", lib="L", rname="c"):
        return (name, flag, rname, pos, pos + 3, "4M", "ACGT", q * 4, lib)
    rows = [read("p1", 0, 10), read("p1", 16, 50), read("p2", 16, 50, "5"), read("p2", 0, 10), read("p3", 0, 10), read("p3", 16, 50), read("p4", 0, 10, lib="M"),
            read("p4", 16, 50, lib="M"), read("f1", 0, 10), read("f2", 0, 70, "5"), read("f2", 4, 0), read("f3", 0, 70), read("u", 4, 0), read("s", 0x100, 10),
            read("t", 0, 10), read("t", 0, 10), read("t", 0, 10)]
    marked = mark_template_duplicates(templates(spark.createDataFrame(rows, READS + ", library string")))
    got = {r.name: (r.kind, r.is_dup) for r in marked.collect()}
    assert got == {"p1": ("pair", False), "p2": ("pair", True), "p3": ("pair", True), "p4": ("pair", False), "f1": ("fragment", True),
                   "f2": ("fragment", True), "f3": ("fragment", False), "u": ("unmapped", False), "t": ("other", False)}
    m = {r.library: r.asDict() for r in duplicate_metrics(marked).collect()}
    assert (m["L"]["pairs_examined"], m["L"]["pair_duplicates"], m["L"]["unpaired_examined"], m["L"]["unpaired_duplicates"], m["L"]["unmapped_reads"]) == (3, 2, 3, 2, 2)
    assert m["M"]["library_size"] is None and m["L"]["duplicate_share"] == 6 / 9
    x = spark.range(1).select(library_size(F.lit(1000), F.lit(800)).alias("x")).first().x
    assert abs(800 / x - (1 - math.exp(-1000 / x))) < 1e-3
    assert duplicate_metrics(mark_template_duplicates(templates(spark.createDataFrame([], READS + ", library string")))).count() == 0


def test_chunk_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(100).selectExpr("concat('line ', id) AS value", "CAST(id % 5 AS INT) AS chunk").where("chunk <> 3")
    for _ in range(2):                                                   # the second run replaces the first
        write_chunk_files(rows, path, "value", "chunk", 5)
    assert sorted(os.listdir(path)) == [f"chunk{k}.fq.gz" for k in (0, 1, 2, 4)]
    log = {r.partition: r for r in read_task_log(spark, path).collect()}
    assert [log[k].rows for k in range(5)] == [20, 20, 20, 0, 20] and all(r.started <= r.ended for r in log.values())
    for k in (0, 1, 2, 4):
        with gzip.open(f"{path}/chunk{k}.fq.gz", "rt") as f:
            assert sorted(f.read().split("\n")[:-1]) == sorted(f"line {i}" for i in range(100) if i % 5 == k)
        assert log[k].bytes == os.path.getsize(f"{path}/chunk{k}.fq.gz")
    bad = rows.selectExpr("if(value = 'line 92', raise_error('broken'), value) AS value", "chunk")
    with pytest.raises(Exception, match="broken"):
        write_chunk_files(bad, str(tmp_path / "failed"), "value", "chunk", 5)
    assert glob.glob(f"{tmp_path}/failed/**", recursive=True) in ([], [f"{tmp_path}/failed/"])
    with pytest.raises(Exception, match="holds chunks"):
        rows.select("value").write.format("chunks").mode("append").save(path)
    assert len(glob.glob(f"{path}/chunk*")) == 4


def test_pileup_and_covariates_by_chunk_equal_those_by_base(spark, monkeypatch):
    from sparkfold.operators import pileup as module
    from sparkfold.operators.pileup import pileup_on_reference, read_covariates

    rng = random.Random(5)
    rows = []
    for i in range(300):
        seq = "".join(rng.choice("ACGTN") for _ in range(14))
        rows.append((f"r{i}", rng.choice([0, 16]), rng.choice("cd"), rng.choice([None, rng.randrange(1, 60)]), 0, rng.choice([*CIGARS, "14M", "M", "9999M"]), seq,
                     "".join(chr(33 + rng.randrange(0, 41)) for _ in range(rng.choice([14, 9])))))
    rows.append(("null", 0, "c", 3, 0, "2M", None, None))
    reads = reads_of(spark, rows).withColumn("is_reverse", F.col("flag").bitwiseAND(16) != 0).withColumn("length", F.length("qual"))
    reference = spark.createDataFrame([(c, k, "".join(rng.choice("acGTN") for _ in range(10))) for c in "cd" for k in range(7)], "name string, number long, bases string")
    known = spark.createDataFrame([("c", 7), ("c", 7), ("d", 20), ("d", 21), (None, 3), ("c", None)], "rname string, pos int")
    bases = aligned_bases(reads, "is_reverse", "length")
    columns = ["rname", "pos", "ref", "n", "right", "wrong", "half"]
    want = sorted(map(str, with_reference(pileup(bases), reference, 10).select(columns).collect()))
    assert sorted(map(str, pileup_on_reference(reads, reference, 10).select(columns).collect())) == want
    monkeypatch.setattr(module, "HOT", 5)                       # most chunks are frequent ones
    assert sorted(map(str, pileup_on_reference(reads, reference, 10).select(columns).collect())) == want
    table = covariates(with_reference(bases, reference, 10), known)
    assert sorted(map(tuple, read_covariates(reads, reference, known, 10).collect())) == sorted(map(tuple, table.collect()))


def test_recalibration_moves_no_row_per_base(spark):
    """Every exchange of the plan lies below the explode of bases, or above the sums."""
    from sparkfold.operators.pileup import read_covariates

    reads = reads_of(spark, [("a", 0, "c", 1, 4, "4M", "ACGT", "IIII")]).withColumn("is_reverse", F.lit(False)).withColumn("length", F.length("qual"))
    reference = spark.createDataFrame([("c", 0, "ACGT" * 5)], "name string, number long, bases string")
    plan = read_covariates(reads, reference, spark.createDataFrame([("c", 2)], "rname string, pos int"), 20)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate explode(sequence(0")]
    assert above.count("Exchange") == 1 and above.index("Exchange") < above.index("partial_count")
