"""Interval merge / intersect, placement, read operators, genomics sources."""

import random

from pyspark.sql import functions as F

from sparkfold.operators.intervals import bed_lines, intersect_intervals, merge_intervals
from sparkfold.operators.placement import greedy_groups, place_and_sort, rank_in_group
from sparkfold.operators.reads import concordance, decode_quals, fix_quality, mark_duplicates, quality_encoding
from sparkfold.sources.genomics import parse_sam, parse_vcf, read_sequence_dict


def brute_merge(rows, thr, pad=0):
    out = []
    for c in sorted({r[0] for r in rows}):
        cur = None
        for _, s, e in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2])):
            s -= pad
            if cur and s <= cur[2] + thr:
                cur[2] = max(cur[2], e)
                cur[3] += 1
            else:
                if cur:
                    out.append(tuple(cur))
                cur = [c, s, e, 1]
        out.append(tuple(cur))
    return sorted(out)


def test_merge_gap_rule_and_last_range_kept(spark):
    rows = [("chr1", 1, 10), ("chr1", 61, 70),      # gap 51: start 61 <= 10 + 51 -> merge
            ("chr1", 122, 130),                     # 122 > 70 + 51 -> new range (gap 52)
            ("chr1", 123, 125),                     # contained
            ("chr2", 5, 6)]                         # chromosome change, single read still emitted
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    got = sorted(tuple(r) for r in merge_intervals(df).collect())
    assert got == [("chr1", 1, 70, 2), ("chr1", 122, 130, 2), ("chr2", 5, 6, 1)]
    strict = sorted(tuple(r) for r in merge_intervals(df, gap=51, inclusive=False).collect())
    assert strict[0] == ("chr1", 1, 10, 1)


def test_merge_matches_brute_force_over_many_partitions(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(3000):
        s = rnd.randint(1, 40000)
        rows.append((rnd.choice(["chr1", "chr2", "chr3"]), s, s + rnd.randint(0, 300)))
    rows += [("chr1", 5, 90000)]                    # one long range spanning partitions
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    for thr, incl, pad in ((51, True, 0), (0, False, 100)):
        got = sorted(tuple(r) for r in merge_intervals(df, gap=thr, inclusive=incl, pad=pad,
                                                       num_partitions=13).collect())
        assert got == brute_merge(rows, thr if incl else thr - 1, pad)


def test_bed_conversion_and_compat(spark):
    df = spark.createDataFrame([("chr1", 11, 20)], "chrom string, start long, end long")
    assert bed_lines(df).first()[0] == "chr1\t10\t20"
    assert bed_lines(df, compat=True).first()[0] == "chr1\t10\t19"


def test_binned_intersect_equals_theta_join(spark):
    rnd = random.Random(5)
    a = [("c1", s, s + rnd.randint(1, 3000), f"a{i}") for i, s in enumerate(rnd.sample(range(50000), 300))]
    b = [("c1", s, s + rnd.randint(1, 200)) for s in rnd.sample(range(50000), 400)]
    A = spark.createDataFrame(a, "chrom string, start long, end long, name string")
    B = spark.createDataFrame(b, "chrom string, start long, end long")
    got = sorted(tuple(r) for r in intersect_intervals(A, B, bin_size=500).collect())
    want = sorted((c, max(s, s2), min(e, e2), n) for c, s, e, n in a for _, s2, e2 in b if s < e2 and s2 < e)
    assert got == want


def test_greedy_ties_and_balance(spark):
    c = spark.createDataFrame([(1, 50), (2, 40), (3, 30), (4, 30), (5, 10)], "k int, n long")
    assert [r["grp"] for r in greedy_groups(c, "k", "n", 2).orderBy("k").collect()] == [0, 1, 1, 0, 1]
    rnd = random.Random(1)
    w = [(i, rnd.randint(1, 1000)) for i in range(24)]
    g = greedy_groups(spark.createDataFrame(w, "k int, n long"), "k", "n", 4).collect()
    loads = [sum(r["n"] for r in g if r["grp"] == j) for j in range(4)]
    assert max(loads) <= sum(loads) / 4 + max(x for _, x in w)


def test_rank_in_group_and_exact_placement(spark):
    df = spark.createDataFrame([(g, p) for g in range(3) for p in range(50, 0, -1)], "grp int, pos int")
    r = rank_in_group(df, "grp", ["pos"]).collect()
    assert all(row["rank"] == row["pos"] for row in r)
    placed = place_and_sort(df, "grp", ["pos"], exact=True, n=3)
    parts = placed.select("grp", F.spark_partition_id().alias("p")).distinct().collect()
    assert all(row["grp"] == row["p"] for row in parts)


def test_quality_decode_fix_and_encoding(spark):
    df = spark.createDataFrame([("g1", "hh@"), ("g1", "I#"), ("g2", "!!")], "g string, qual string")
    enc = {r["g"]: (r["max_qual"], r["encoding"]) for r in quality_encoding(df, "g").collect()}
    assert enc == {"g1": (71, "ILLUMINA"), "g2": (0, "SANGER")}
    fixed, bad = fix_quality(F.col("qual"))
    got = df.select(fixed.alias("f"), bad.alias("b")).collect()
    assert (got[0]["f"], got[0]["b"]) == ("II!", False)
    assert got[2]["b"] is True
    assert df.select(decode_quals(F.col("qual"))).first()[0] == [71, 71, 31]


def test_mark_duplicates_keeps_best_per_five_prime_position(spark):
    rows = [("a", 0, "chr1", 100, "10M", 109, "IIIII"),
            ("b", 0, "chr1", 102, "2S8M", 109, "IIIIJ"),    # same 5' (100) after clip, higher qsum
            ("c", 16, "chr1", 91, "10M", 100, "IIIII"),     # reverse strand: 5' = end
            ("d", 4, "chr1", 100, "10M", 109, "JJJJJ")]     # unmapped: never a duplicate
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, cigar string, aln_end int, qual string")
    got = {r["qname"]: r["is_dup"] for r in mark_duplicates(df).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}


def test_concordance_counts(spark):
    a = spark.createDataFrame([("c1", 1, "A", "C"), ("c1", 2, "A", "G"), ("c1", 2, "A", "G")], "c string, p int, r string, x string")
    b = spark.createDataFrame([("c1", 2, "A", "G"), ("c1", 3, "T", "G")], "c string, p int, r string, x string")
    assert tuple(concordance(a, b, ["c", "p", "r", "x"]).first()) == (2, 1, 1, 1)


def test_sam_and_vcf_parsers(spark):
    sam = spark.createDataFrame([("@HD\tVN:1.0",), ("r1\t0\tchr1\t100\t60\t3S10M2D5M\t=\t0\t0\tACGT\tIIII",)], "value string")
    r = parse_sam(sam).first()
    assert (r["pos"], r["aln_end"]) == (100, 116)
    vcf = spark.createDataFrame([("##x",), ("chrX\t5\t.\tA\tC",), ("chrM\t1\t.\tA\tC",), ("chr10\t1\t.\tG\tT",)], "value string")
    ok, rej = parse_vcf(vcf)
    assert sorted((r["chr_num"], r["pos"]) for r in ok.collect()) == [(10, 1), (23, 5)]
    assert [r["chrom"] for r in rej.collect()] == ["chrM"]


def test_sequence_dict_skips_header_and_bad_length(spark, tmp_path):
    p = tmp_path / "x.dict"
    p.write_text("@HD\tVN:1.0\n@SQ\tSN:chrM\tLN:16571\tUR:x\n@SQ\tSN:chr1\tLN:abc\n")
    assert [tuple(r) for r in read_sequence_dict(spark, str(p)).orderBy("idx").collect()] == \
        [(0, "chrM", 16571), (1, "chr1", 0)]


def test_intersection_of_long_and_short_intervals(spark):
    rng = random.Random(8)

    def rows(n, name):
        out = []
        for i in range(n):
            s = rng.randrange(5000)
            out.append((rng.choice("xy"), s, s + rng.choice([-1, 0, 1, 1, 3, 4, 5, 16, 17, 64, 700, 50_000_000]), f"{name}{i}"))
        return out + [(None, 1, 5, "n"), ("x", None, 5, "n"), ("x", 0, 1 << 40, f"{name}w")]
    a, b = rows(150, "a"), rows(120, "b")
    schema = "chrom string, start long, end long, name string"
    A, B = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema).drop("name")
    want = sorted((c, max(s, t), min(e, f), n) for c, s, e, n in a for d, t, f, _ in b
                  if c and c == d and s is not None and t is not None and s < e and t < f and s < f and t < e)
    for unit in (None, 7):
        assert sorted(tuple(r) for r in intersect_intervals(A, B, bin_size=unit).collect()) == want
    assert intersect_intervals(A.where("false"), B).count() == 0
