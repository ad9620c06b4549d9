"""Bases in numpy, chunk by chunk, against the sums stated by expressions; covered numbers and lookups of new qualities."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkfold.operators import basewise
from sparkfold.operators import pileup as module
from sparkfold.operators.basewise import DEPTHS, SITES, chunk_runs, covariate_counts, cut_pieces, depth_counts, on_chunks, site_sums, varying_sites
from sparkfold.operators.covered import covered_numbers
from sparkfold.operators.pileup import BASES, aligned_bases, call_variants, covariates, pileup, pileup_on_reference, read_covariates, recalibrate, with_reference

READS = "qname string, flag int, rname string, pos int, aln_end int, cigar string, seq string, qual string"
COLUMNS = ["rname", "pos", "ref", "n", "right", "wrong", "half"]


@pytest.fixture(scope="module")
def case(spark):
    """Reads over many chunks of 10, letters of other scripts, two texts of one chunk, keys that are null."""
    rng = random.Random(11)
    rows = []
    for i in range(250):
        n = rng.choice([3, 14, 60])
        cigar = rng.choice([f"{n}M", f"2S{n - 2}M", f"1M1I{n - 2}M", f"1M35N{n - 1}M", f"2M1D{n - 2}M", "999M", "*"])
        seq = "".join(rng.choice("ACGTACGTACGTNaéß\U0001f40b" if i % 9 == 0 else "ACGTN") for _ in range(n))
        rows.append((f"r{i}", rng.choice([0, 16, None]), rng.choice(["c", "d", None]), rng.choice([None, -7, rng.randrange(1, 90)]), 0, cigar, seq,
                     "".join(chr(33 + rng.randrange(0, 41)) for _ in range(rng.choice([n, n, n - 2])))))
    rows += [("none", 0, "c", 3, 0, None, "AC", "II"), ("bare", 0, "c", 3, 0, "2M", None, None), ("other", 0, "gone", 3, 0, "2M", "AC", "II")]
    reads = (spark.createDataFrame(rows, READS).withColumn("is_reverse", F.coalesce(F.col("flag"), F.lit(0)).bitwiseAND(16) != 0).withColumn("length", F.length("qual")))
    texts = [(c, k, "".join(rng.choice("acGTNé") for _ in range(7 if k % 4 == 1 else 10))) for c in "cd" for k in range(16)]
    texts += [(None, 0, "A" * 10), ("c", None, "A" * 10), ("d", 3, "".join("A" if b not in "aA" else "C" for b in dict((t[:2], t[2]) for t in texts)["d", 3]))]
    reference = spark.createDataFrame(texts, "name string, number long, bases string")
    known = spark.createDataFrame([("c", 7), ("c", 7), ("d", 20), ("d", 21), ("e", 4), (None, 3), ("c", None)], "rname string, pos int")
    return reads, reference, known


def text(df, columns=COLUMNS):
    return sorted(map(str, df.select(columns).collect()))


def wanted(reads, reference):
    return with_reference(pileup(aligned_bases(reads)), reference, 10).where("ref <> ''")


def test_pileup_of_odd_reads(spark, case, monkeypatch):
    reads, reference, _ = case
    want = text(wanted(reads, reference))
    assert len(want) > 100 and text(pileup_on_reference(reads, reference, 10).where("ref <> ''")) == want
    monkeypatch.setattr(module, "HOT", 4)
    assert text(pileup_on_reference(reads, reference, 10).where("ref <> ''")) == want


def test_pileup_makes_no_row_per_base(spark, case):
    """Bases are neither exploded nor joined with the reference row by row."""
    reads, reference, _ = case
    plan = pileup_on_reference(reads, reference, 10)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "explode" not in plan and "Join" not in plan


def test_sites_that_can_vary(spark, case, monkeypatch):
    reads, reference, _ = case
    want = text(call_variants(wanted(reads, reference), 5), ["rname", "pos", "ref", "alt", "gt", "pl", "dp", "ad_ref", "ad_alt", "qual"])
    for hot in (100, 4):
        monkeypatch.setattr(module, "HOT", hot)
        few = pileup_on_reference(reads, reference, 10, varying_sites, SITES)
        assert few.count() < pileup_on_reference(reads, reference, 10).count()
        assert text(call_variants(few, 5), ["rname", "pos", "ref", "alt", "gt", "pl", "dp", "ad_ref", "ad_alt", "qual"]) == want and want


def test_depths_are_counted_where_sites_are(spark, case, monkeypatch):
    reads, reference, _ = case
    same = F.coalesce(F.get("n", F.instr(F.lit(BASES), F.col("ref")) - 1), F.lit(0))
    depth = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    full = reference.withColumn("bases", F.rpad("bases", 10, "N"))
    want = text(with_reference(pileup(aligned_bases(reads)), full, 10).select("rname", depth.alias("depth"), (depth - same).alias("other")).groupBy("rname", "depth")
                .agg(F.count("*").alias("positions"), F.sum("other").alias("mismatches")), ["rname", "depth", "positions", "mismatches"])
    for hot in (100, 4):
        monkeypatch.setattr(module, "HOT", hot)
        counts = pileup_on_reference(reads, full, 10, depth_counts, DEPTHS, ("n",))
        assert "explode" not in counts._jdf.queryExecution().executedPlan().toString() or hot == 4
        got = counts.groupBy("rname", "depth").agg(F.sum("positions").alias("positions"), F.sum("mismatches").alias("mismatches"))
        assert text(got, ["rname", "depth", "positions", "mismatches"]) == want


def test_sums_do_not_depend_on_slices(spark, case, monkeypatch):
    reads, reference, _ = case
    stream = on_chunks(cut_pieces(reads, 10).withColumn("part", F.lit(0)), reference.withColumn("part", F.lit(0)), 1).toArrow()
    values = {"n": np.ones(94), "right": np.arange(94.0)}

    def sums(limit, rows):
        monkeypatch.setattr(basewise, "LIMIT", limit)
        out = []
        for batch in chunk_runs(iter(stream.combine_chunks().to_batches(rows))):
            s = site_sums(batch, 10, values)
            if s is not None:
                out += zip(s.rname.to_pylist(), s.pos.tolist(), s.ref.tolist(), s.sums["n"].tolist(), s.sums["right"].tolist())
        return sorted(map(str, out))
    whole = sums(1_000_000, 10_000)
    assert len(whole) > 100 and sums(40, 7) == whole and sums(1, 1) == whole


def test_covariates_of_odd_reads(spark, case, monkeypatch):
    reads, reference, known = case
    bases = with_reference(aligned_bases(reads, "is_reverse", "length"), reference, 10)
    want = sorted(map(str, covariates(bases, known).collect()))
    for hot in (100, 4):
        monkeypatch.setattr(module, "HOT", hot)
        assert sorted(map(str, read_covariates(reads, reference, known, 10).collect())) == want and len(want) > 100


def test_covariates_are_counted_before_they_reach_spark(spark):
    """400 equal bases are one row of the stage that counts them."""
    reads = spark.createDataFrame([(f"r{i}", 0, "c", 1, 1, "1M", "A", "I") for i in range(400)], READS).withColumn("origin", F.lit(1)).withColumn("step", F.lit(1))
    reference = spark.createDataFrame([("c", 0, "ACGT")], "name string, number long, bases string").withColumn("part", F.lit(0))
    pieces = cut_pieces(reads, 4, "origin", "step").withColumn("part", F.lit(0))
    rows = covariate_counts(on_chunks(pieces, reference, 3, None, "origin", "step"), 4).collect()
    assert [tuple(r) for r in rows] == [(40, 1, "A", 399, 0)]


@pytest.mark.parametrize("dense", [1 << 26, 0])
def test_new_qualities_by_lookup(spark, monkeypatch, dense):
    monkeypatch.setattr(module, "DENSE", dense)
    rng = random.Random(2)
    rows = [(f"r{i}", rng.choice([0, 16, None]), "c", 1, 1, "*", rng.choice([None, "".join(rng.choice("ACGTNé") for _ in range(rng.randrange(0, 9)))]),
             rng.choice([None, "".join(rng.choice("IIIJ5é~" if i % 5 == 0 else "IIIJ5") for _ in range(rng.randrange(0, 9)))])) for i in range(300)]
    table = [(q, c, b + a, rng.randrange(-3, 120)) for q in (40, 41, 20) for c in range(1, 8) for b in ["", *"ACGTNé"] for a in "ACGT" if rng.random() < 0.6]
    new = {t[:3]: chr(33 + max(0, min(93, t[3]))) for t in table}
    want = {}
    for name, flag, *_, seq, qual in rows:
        n = len(qual or "")
        want[name] = qual if qual is None or seq is None else "".join(
            new.get((ord(c) - 33, n - i if (flag or 0) & 16 else i + 1, seq[max(0, i - 1):i + 1]), c) for i, c in enumerate(qual))
    got = recalibrate(spark.createDataFrame(rows, READS), spark.createDataFrame(table, "q int, cycle int, context string, empirical int"))
    assert {r.qname: r.new_qual for r in got.collect()} == want
    empty = recalibrate(spark.createDataFrame(rows, READS), spark.createDataFrame([], "q int, cycle int, context string, empirical int"))
    assert {r.qname: r.new_qual for r in empty.collect()} == {r[0]: r[-1] for r in rows}


def test_new_qualities_are_looked_up_as_arrays(spark):
    """No dictionary of covariates is sent: the table is an array."""
    lookup = module._Lookup(np.array([40]), np.array([2]), ["AC"], np.array([50], np.uint8))
    assert lookup.of(np.array([40, 40, 41]), np.array([2, 1, 2]), np.array([65] * 3), np.array([67] * 3)).tolist() == [50, 0, 0]


def test_covered_numbers(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None, "ü"]), (a := rng.randrange(-20_000, 20_000)), a + rng.randrange(-3, 5)) for _ in range(500)]
    rows += [("a", 0, 30_000), ("a", None, 3), ("b", 3, None), ("b", -(1 << 33), -(1 << 33))]
    got = [tuple(r) for r in covered_numbers(spark.createDataFrame(rows, "name string, first long, last long").repartition(3)).collect()]
    want = {(name, k) for name, a, z in rows if a is not None and z is not None for k in range(min(a, z), max(a, z) + 1)}
    assert len(got) == len(set(got)) and set(got) == want


def test_slices_of_ranges(monkeypatch):
    from sparkfold.operators import covered

    monkeypatch.setattr(covered, "HELD", 10)
    assert list(covered._slices(np.array([4, 6, 1, 30, 2, 2]))) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_batches_without_rows():
    empty = pa.RecordBatch.from_pylist([], pa.schema([("seq", pa.string()), ("qual", pa.string())]))
    assert list(chunk_runs(iter([empty]))) == []
