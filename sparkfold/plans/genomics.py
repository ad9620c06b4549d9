"""Alignment / interval / variant queries.

Binding: every ``lineitem`` row is one read (name = order, line, part,
supplier and price in cents: unique per row).  reference index = ``l_suppkey
% 26`` over the dictionary below (0 = chrM, 1..22, 23 = chrX, 24 = chrY,
25 = an unplaced contig); position = ``l_partkey * 75 + l_linenumber``;
read length = quantity; reverse strand = odd line number; unmapped when the
discount is 0; quality offset 64 (ILLUMINA) on every fifth reference.
SAM text is built from those rows and parsed back by the SAM source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.intervals import (bed_lines, intersect_intervals, island_extent, merge_intervals,
                                           region_strings)
from sparkfold.operators.joins import small
from sparkfold.operators.placement import assign_groups, greedy_groups, key_counts, rank_in_group, write_regions
from sparkfold.operators.reads import (clean_alignments, concordance, fix_quality, mark_duplicates,
                                       quality_encoding, with_read_groups)
from sparkfold.plans.registry import query, table
from sparkfold.session import scratch_path
from sparkfold.sinks.text import write_lines, write_sorted_lines
from sparkfold.sources.genomics import read_bed, read_sam, read_sequence_dict, read_vcf, sam_regions

# Reference sequences in dictionary order with their lengths (hg19).
REFERENCE_SEQUENCES = [
    ("chrM", 16571), ("chr1", 249250621), ("chr2", 243199373), ("chr3", 198022430),
    ("chr4", 191154276), ("chr5", 180915260), ("chr6", 171115067), ("chr7", 159138663),
    ("chr8", 146364022), ("chr9", 141213431), ("chr10", 135534747), ("chr11", 135006516),
    ("chr12", 133851895), ("chr13", 115169878), ("chr14", 107349540), ("chr15", 102531392),
    ("chr16", 90354753), ("chr17", 81195210), ("chr18", 78077248), ("chr19", 59128983),
    ("chr20", 63025520), ("chr21", 48129895), ("chr22", 51304566), ("chrX", 155270560),
    ("chrY", 59373566), ("chrUn_gl000220", 161802),
]
N_REF = len(REFERENCE_SEQUENCES)
N_GROUPS = 4
READ_GROUP = {"rgid": "GROUP1", "rglb": "LIB1", "rgpl": "ILLUMINA", "rgpu": "UNIT1", "rgsm": "SAMPLE1"}


def seq_dict_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, ln) for i, (n, ln) in enumerate(REFERENCE_SEQUENCES)],
                                 "idx int, name string, length bigint")


def _ref_name(idx):
    return F.element_at(F.array(*[F.lit(n) for n, _ in REFERENCE_SEQUENCES]), idx + 1)


def typed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as typed alignment records (the SAM columns + aln_end)."""
    li = table(spark, sf_dir, "lineitem")
    ci = (F.col("l_suppkey") % N_REF).cast("int")
    ln = F.col("l_quantity").cast("int")
    clipped = ((F.col("l_linenumber") % 3) == 0) & (ln > 4)
    cigar = F.when(clipped, F.concat(F.lit("2S"), (ln - 4).cast("string"), F.lit("M2S"))) \
             .otherwise(F.concat(ln.cast("string"), F.lit("M")))
    ref_len = F.when(clipped, ln - 4).otherwise(ln)
    flag = ((F.col("l_linenumber") % 2) * 16 + F.when(F.col("l_discount") == 0, 4).otherwise(0)).cast("int")
    # base i (1..len) gets quality (partkey + suppkey + 7 i) mod 41 at offset 64 on every
    # fifth reference, else 33; 7 * 6 = 1 (mod 41), so the string is a substring of the
    # cycle j -> 7 j mod 41 starting at 6 (partkey + suppkey) + 1 (plain codegen, no lambda)
    cyc = {o: "".join(chr(o + (7 * j) % 41) for j in range(41)) * 3 for o in (33, 64)}
    c = (F.col("l_partkey") + F.col("l_suppkey")) % 41
    qual = F.substring(F.when(ci % 5 == 0, F.lit(cyc[64])).otherwise(F.lit(cyc[33])),
                       ((c * 6 + 1) % 41 + 1).cast("int"), ln)
    seq = F.substring(F.repeat(F.lit("ACGT"), 13), (F.col("l_partkey") % 4 + 1).cast("int"), ln)
    qname = F.concat_ws("_", F.concat(F.lit("r"), F.col("l_orderkey").cast("string")),
                        F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                        F.col("l_suppkey").cast("string"),
                        (F.col("l_extendedprice") * 100).cast("bigint").cast("string"))
    pos = (F.col("l_partkey") * 75 + F.col("l_linenumber")).cast("int")
    return li.select(qname.alias("qname"), flag.alias("flag"), _ref_name(ci).alias("rname"), pos.alias("pos"),
                     ((F.col("l_tax") * 1000).cast("int") % 61).alias("mapq"), cigar.alias("cigar"),
                     F.lit("=").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"),
                     seq.alias("seq"), qual.alias("qual"), (pos + ref_len - 1).alias("aln_end"))


def sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header + one tab-separated SAM line per read."""
    r = typed_reads(spark, sf_dir)
    body = r.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in
                                          ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext",
                                           "tlen", "seq", "qual")]).alias("value"))
    header = spark.createDataFrame([("@HD\tVN:1.0\tSO:unsorted",)] +
                                   [(f"@SQ\tSN:{n}\tLN:{ln_}",) for n, ln_ in REFERENCE_SEQUENCES], "value string")
    return header.unionByName(body)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sam_regions(typed_reads(spark, sf_dir), small(seq_dict_df(spark)))


_DICT_VALUES = ", ".join(f"({i}, '{n}', {ln})" for i, (n, ln) in enumerate(REFERENCE_SEQUENCES))
READS_SQL = f"""
WITH dict(idx, name, length) AS (VALUES {_DICT_VALUES}),
li AS (SELECT *, (l_suppkey % {N_REF})::INT AS ci, trunc(l_quantity)::INT AS len FROM lineitem),
reads AS (
  SELECT 'r' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey
           || '_' || trunc(l_extendedprice * 100)::BIGINT AS qname,
         ((l_linenumber % 2) * 16 + CASE WHEN l_discount = 0 THEN 4 ELSE 0 END)::INT AS flag,
         d.name AS rname, d.idx AS ref_idx, d.length,
         (l_partkey * 75 + l_linenumber)::INT AS pos,
         (trunc(l_tax * 1000)::INT % 61)::INT AS mapq,
         CASE WHEN l_linenumber % 3 = 0 AND len > 4 THEN '2S' || (len - 4) || 'M2S' ELSE len || 'M' END AS cigar,
         (l_partkey * 75 + l_linenumber)::INT
           + CASE WHEN l_linenumber % 3 = 0 AND len > 4 THEN len - 4 ELSE len END - 1 AS aln_end,
         array_to_string(list_transform(range(1, len + 1), lambda i: chr((CASE WHEN ci % 5 = 0 THEN 64 ELSE 33 END
             + (l_partkey + l_suppkey + i * 7) % 41)::INT)), '') AS qual
  FROM li JOIN dict d ON d.idx = li.ci),
regions AS (SELECT *, ref_idx AS region FROM reads WHERE flag & 4 = 0 AND ref_idx BETWEEN 1 AND 24)
"""


@query("sam_regions", oracle=READS_SQL + """
SELECT qname, flag, rname, pos, mapq, cigar, aln_end, region FROM regions
""")
def sam_regions_query(spark: SparkSession, sf_dir: str):
    """Reads written as SAM text, scanned and parsed back ->
    (region, read) for mapped reads on references 1..24."""
    path = write_lines(sam_lines(spark, sf_dir), scratch_path(spark, "sam"))
    r = sam_regions(read_sam(spark, path), small(seq_dict_df(spark)))
    return r.select("qname", "flag", "rname", "pos", "mapq", "cigar", "aln_end", "region")


@query("region_counts", oracle=READS_SQL + "SELECT region, count(*) AS n FROM regions GROUP BY region")
def region_counts(spark: SparkSession, sf_dir: str):
    """Reads per region, heaviest first."""
    return key_counts(regions(spark, sf_dir), "region")


_GREEDY_SQL = READS_SQL + f"""
, c AS (SELECT region, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, region) AS rn
        FROM regions GROUP BY region),
g AS (
  SELECT 0 AS rn, NULL::INT AS region, 0::BIGINT AS n, NULL::INT AS grp,
         0::BIGINT AS l0, 0::BIGINT AS l1, 0::BIGINT AS l2, 0::BIGINT AS l3
  UNION ALL
  SELECT c.rn, c.region, c.n, s.grp,
         l0 + CASE WHEN s.grp = 0 THEN c.n ELSE 0 END, l1 + CASE WHEN s.grp = 1 THEN c.n ELSE 0 END,
         l2 + CASE WHEN s.grp = 2 THEN c.n ELSE 0 END, l3 + CASE WHEN s.grp = 3 THEN c.n ELSE 0 END
  FROM g JOIN c ON c.rn = g.rn + 1,
  LATERAL (SELECT CASE WHEN l0 <= l1 AND l0 <= l2 AND l0 <= l3 THEN 0
                       WHEN l1 <= l2 AND l1 <= l3 THEN 1
                       WHEN l2 <= l3 THEN 2 ELSE 3 END AS grp) s)
"""


@query("balanced_groups", oracle=_GREEDY_SQL.replace("WITH dict", "WITH RECURSIVE dict") + """
SELECT region, n, grp FROM g WHERE rn > 0
""")
def balanced_groups(spark: SparkSession, sf_dir: str):
    """Greedy assignment of regions to 4 balanced groups."""
    return greedy_groups(key_counts(regions(spark, sf_dir), "region"), "region", "n", N_GROUPS)


@query("region_sorted", oracle=_GREEDY_SQL.replace("WITH dict", "WITH RECURSIVE dict") + """
SELECT g.grp, row_number() OVER (PARTITION BY g.grp ORDER BY r.ref_idx, r.pos, r.qname) AS rank,
       r.region, r.pos, r.qname
FROM regions r JOIN g ON g.region = r.region AND g.rn > 0
""")
def region_sorted(spark: SparkSession, sf_dir: str):
    """Reads placed by balanced group and ordered by
    (reference index, position) inside each group."""
    r = regions(spark, sf_dir)
    groups = greedy_groups(key_counts(r, "region"), "region", "n", N_GROUPS)
    placed = assign_groups(r, groups, "region")
    return rank_in_group(placed, "grp", ["ref_idx", "pos", "qname"]).select("grp", "rank", "region", "pos", "qname")


@query("region_files", oracle=_GREEDY_SQL.replace("WITH dict", "WITH RECURSIVE dict") + """
SELECT g.grp, r.region, count(*) AS n, min(r.pos) AS first_pos, max(r.pos) AS last_pos, 0::BIGINT AS out_of_order
FROM regions r JOIN g ON g.region = r.region AND g.rn > 0 GROUP BY g.grp, r.region
""")
def region_files(spark: SparkSession, sf_dir: str):
    """Reads written as sorted files, a folder per group, and read back in file order:
    rows of every region, and how many of them stand before a smaller key of their file."""
    r = regions(spark, sf_dir)
    groups = greedy_groups(key_counts(r, "region"), "region", "n", N_GROUPS)
    placed = assign_groups(r, groups, "region").select("grp", "region", "ref_idx", "pos", "qname")
    path = write_regions(placed, scratch_path(spark, "regions"), "grp", ["ref_idx", "pos", "qname"])
    back = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    key, before = F.struct("ref_idx", "pos", "qname"), F.struct("_i", "_p", "_q")
    earlier = back.select("file", (F.col("row") + 1).alias("row"), F.col("ref_idx").alias("_i"), F.col("pos").alias("_p"), F.col("qname").alias("_q"))
    checked = back.join(earlier, ["file", "row"], "left")
    return (checked.groupBy(F.col("grp").cast("int").alias("grp"), "region")
            .agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"),
                 F.sum((F.col("_i").isNotNull() & (before > key)).cast("long")).alias("out_of_order")))


_ISLANDS_SQL = READS_SQL + """
, f AS (SELECT rname, ref_idx, pos AS s, aln_end AS e,
               CASE WHEN pos <= max(aln_end) OVER (PARTITION BY ref_idx ORDER BY pos, aln_end
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 51
                    THEN 0 ELSE 1 END AS nw
        FROM regions),
gi AS (SELECT *, sum(nw) OVER (PARTITION BY ref_idx ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM f),
islands AS (SELECT rname AS chrom, min(s) AS start, max(e) AS "end", count(*) AS n
            FROM gi GROUP BY rname, isl)
"""


def merged_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = regions(spark, sf_dir).select(F.col("rname").alias("chrom"), F.col("pos").alias("start"),
                                      F.col("aln_end").alias("end"))
    return merge_intervals(r, gap=51, inclusive=True)


@query("interval_merge", oracle=_ISLANDS_SQL + "SELECT chrom, start, \"end\", n FROM islands")
def interval_merge(spark: SparkSession, sf_dir: str):
    """Reads merged into ranges while start <= current end + 51."""
    return merged_islands(spark, sf_dir).select("chrom", F.col("start").cast("int"), F.col("end").cast("int"), "n")


@query("interval_merge_padded", oracle=READS_SQL + """
, f AS (SELECT lower(rname) AS k, rname, pos - 100 AS s, aln_end AS e,
               CASE WHEN pos - 100 < max(aln_end) OVER (PARTITION BY lower(rname) ORDER BY pos, aln_end
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    THEN 0 ELSE 1 END AS nw
        FROM regions),
gi AS (SELECT *, sum(nw) OVER (PARTITION BY k ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM f)
SELECT min(rname) AS chrom, greatest(min(s), 1) AS start, max(e) AS "end", count(*) AS n FROM gi GROUP BY k, isl
""")
def interval_merge_padded(spark: SparkSession, sf_dir: str):
    """Padded variant -- start - 100 < current end (strict), start
    clamped to 1, chromosome names compared case-insensitively."""
    r = regions(spark, sf_dir).select(F.col("rname").alias("chrom"), F.col("pos").alias("start"),
                                      F.col("aln_end").alias("end"))
    m = merge_intervals(r, gap=0, inclusive=False, pad=100, clamp_start=1, case_insensitive=True)
    return m.select("chrom", F.col("start").cast("int"), F.col("end").cast("int"), "n")


@query("interval_extent", oracle=_ISLANDS_SQL + """
SELECT chrom, count(*) AS n_ranges, min(start) AS first_start, arg_max("end", start) AS last_end,
       count(*) || 'regions_' || chrom || '-' || min(start) AS label
FROM islands GROUP BY chrom
""")
def interval_extent(spark: SparkSession, sf_dir: str):
    """First start / last end and label of the merged ranges per chromosome."""
    m = merged_islands(spark, sf_dir).select("chrom", F.col("start").cast("int"), F.col("end").cast("int"))
    return island_extent(m)


@query("intervals_bed", oracle=_ISLANDS_SQL + """
SELECT chrom || chr(9) || (start - 1) || chr(9) || "end" AS value FROM islands
""")
def intervals_bed(spark: SparkSession, sf_dir: str):
    """Merged ranges as BED lines (0-based start, exclusive end)."""
    return bed_lines(merged_islands(spark, sf_dir))


@query("intervals_region_str", oracle=_ISLANDS_SQL + """
SELECT chrom || ':' || start || '-' || "end" AS value FROM islands
""")
def intervals_region_str(spark: SparkSession, sf_dir: str):
    """K5: merged ranges as ``chrom:start-end``."""
    return region_strings(merged_islands(spark, sf_dir))


@query("interval_intersect", oracle=_ISLANDS_SQL + f"""
, t AS (SELECT d.name AS chrom, greatest(p_partkey * 75 - 30, 0) AS start,
               greatest(p_partkey * 75 - 30, 0) + p_size * 2 AS "end", 't' || p_partkey AS name
        FROM part JOIN dict d ON d.idx = p_partkey % {N_REF}),
b AS (SELECT chrom, start - 1 AS s, "end" AS e FROM islands)
SELECT t.chrom, greatest(t.start, b.s) AS start, least(t."end", b.e) AS "end", t.name
FROM t JOIN b ON t.chrom = b.chrom AND t.start < b.e AND b.s < t."end"
""")
def interval_intersect(spark: SparkSession, sf_dir: str):
    """Target intervals (BED file from ``part``) cut to the merged
    read ranges they overlap, via a binned equi-join."""
    p = table(spark, sf_dir, "part")
    st = F.greatest(F.col("p_partkey") * 75 - 30, F.lit(0))
    bed = p.select(F.concat_ws("\t", _ref_name((F.col("p_partkey") % N_REF).cast("int")), st.cast("string"),
                               (st + F.col("p_size") * 2).cast("string"),
                               F.concat(F.lit("t"), F.col("p_partkey").cast("string"))).alias("value"))
    path = write_lines(bed, scratch_path(spark, "targets-bed"))
    targets = read_bed(spark, path)
    isl = merged_islands(spark, sf_dir)
    b = isl.select("chrom", (F.col("start") - 1).alias("start"), "end")
    return intersect_intervals(targets, b)


_VARIANTS_SQL = f"""
WITH dict(idx, name, length) AS (VALUES {_DICT_VALUES}),
v AS (SELECT d.name AS chrom, l_partkey * 75 + l_linenumber % 3 AS pos,
             substr('ACGT', (l_linenumber % 4)::INT + 1, 1) AS ref,
             substr('ACGT', (trunc(l_quantity)::INT % 4) + 1, 1) AS alt, l_returnflag
      FROM lineitem JOIN dict d ON d.idx = l_suppkey % {N_REF})
"""


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(_ref_name((F.col("l_suppkey") % N_REF).cast("int")).alias("chrom"),
                     (F.col("l_partkey") * 75 + F.col("l_linenumber") % 3).alias("pos"),
                     F.substring(F.lit("ACGT"), (F.col("l_linenumber") % 4 + 1).cast("int"), 1).alias("ref"),
                     F.substring(F.lit("ACGT"), (F.col("l_quantity").cast("int") % 4 + 1), 1).alias("alt"),
                     "l_returnflag", "l_quantity", "l_orderkey")


@query("variant_concordance", oracle=_VARIANTS_SQL + """
, a AS (SELECT DISTINCT chrom, pos, ref, alt FROM v WHERE l_returnflag IN ('A', 'N')),
b AS (SELECT DISTINCT chrom, pos, ref, alt FROM v WHERE l_returnflag IN ('R', 'N'))
SELECT (SELECT count(*) FROM a) AS total,
       (SELECT count(*) FROM a SEMI JOIN b USING (chrom, pos, ref, alt)) AS matches,
       (SELECT count(*) FROM a ANTI JOIN b USING (chrom, pos, ref, alt)) AS diff,
       (SELECT count(*) FROM b ANTI JOIN a USING (chrom, pos, ref, alt)) AS extra
""")
def variant_concordance(spark: SparkSession, sf_dir: str):
    """Call set A (flags A, N) vs call set B (flags R, N) on (chrom, pos, ref, alt)."""
    v = variants(spark, sf_dir)
    keys = ["chrom", "pos", "ref", "alt"]
    return concordance(v.where(F.col("l_returnflag").isin("A", "N")),
                       v.where(F.col("l_returnflag").isin("R", "N")), keys)


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = variants(spark, sf_dir)
    body = v.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt",
                                F.col("l_quantity").cast("string"), F.lit("PASS"),
                                F.concat(F.lit("OK="), F.col("l_orderkey").cast("string"))).alias("value"))
    head = spark.createDataFrame([("##fileformat=VCFv4.1",), ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",)],
                                 "value string")
    return head.unionByName(body)


@query("vcf_sorted", oracle=_VARIANTS_SQL.replace(
    "l_returnflag\n      FROM", "l_returnflag, l_quantity, l_orderkey\n      FROM") + """
SELECT CASE WHEN chrom = 'chrX' THEN 23 WHEN chrom = 'chrY' THEN 24 ELSE TRY_CAST(substr(chrom, 4) AS INT) END
         AS chr_num, pos::INT AS pos,
       chrom || chr(9) || pos || chr(9) || '.' || chr(9) || ref || chr(9) || alt || chr(9) || l_quantity
         || chr(9) || 'PASS' || chr(9) || 'OK=' || l_orderkey AS line
FROM v WHERE chrom NOT IN ('chrM', 'chrUn_gl000220')
""")
def vcf_sorted(spark: SparkSession, sf_dir: str):
    """VCF file -> numbered chromosomes (chrM and unplaced
    contigs go to the reject side) -> globally sorted text written by range
    partitions -> read back."""
    root = scratch_path(spark, "vcf")
    src = write_lines(vcf_lines(spark, sf_dir), f"{root}/calls")
    ok, _rejected = read_vcf(spark, src)
    out = write_sorted_lines(ok, f"{root}/sorted", ["chr_num", "pos", "line"], "line")
    back, _ = read_vcf(spark, out)
    return back.select("chr_num", "pos", "line")


@query("seq_dict", oracle="""
SELECT (row_number() OVER (ORDER BY s_suppkey) - 1)::INT AS idx, s_name AS name,
       CASE WHEN s_acctbal < 0 THEN 0 ELSE trunc(s_acctbal * 1000)::BIGINT END AS length
FROM supplier
""")
def seq_dict(spark: SparkSession, sf_dir: str):
    """Dictionary files (header + @SQ lines, suppliers in key ranges) ->
    (idx, name, length); unparsable LN -> 0."""
    s = table(spark, sf_dir, "supplier")
    stats = s.agg(F.count(F.lit(1)).alias("n"), F.max("s_suppkey").alias("mx")).first()
    n_files = max(2, -(-int(stats["n"]) // 1_000_000))    # grows with the table, order-preserving
    top = int(stats["mx"] or 0) + 1
    ln = F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise((F.col("s_acctbal") * 1000).cast("bigint").cast("string"))
    body = s.select((F.col("s_suppkey") * n_files / top).cast("int").alias("chunk"), F.lit(1).alias("sec"),
                    F.col("s_suppkey").alias("k"),
                    F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "s_name"), F.concat(F.lit("LN:"), ln),
                                F.lit("UR:file:reference.fasta"),
                                F.concat(F.lit("M5:"), F.md5(F.col("s_name")))).alias("value"))
    head = spark.createDataFrame([(c, 0, 0, "@HD\tVN:1.0\tSO:unsorted") for c in range(n_files)],
                                 "chunk int, sec int, k bigint, value string")
    path = scratch_path(spark, "seqdict")
    (body.unionByName(head).repartitionById(n_files, "chunk").sortWithinPartitions("sec", "k")
     .select("value").write.text(path))
    return read_sequence_dict(spark, path)


@query("quality_encoding", oracle=READS_SQL + """
SELECT region, max(list_max(list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)) - 33)))
         AS max_qual,
       CASE WHEN max(list_max(list_transform(range(1, length(qual) + 1),
                 lambda i: ascii(substr(qual, i, 1)) - 33))) > 60 THEN 'ILLUMINA' ELSE 'SANGER' END AS encoding
FROM regions GROUP BY region
""")
def quality_encoding_query(spark: SparkSession, sf_dir: str):
    """Per region group, max base quality and the encoding guess."""
    return quality_encoding(regions(spark, sf_dir), "region")


@query("quality_fix", oracle=READS_SQL + """
, enc AS (SELECT region, max(list_max(list_transform(range(1, length(qual) + 1),
                 lambda i: ascii(substr(qual, i, 1)) - 33))) > 60 AS ill FROM regions GROUP BY region)
SELECT qname, r.region,
       CASE WHEN ill THEN array_to_string(list_transform(range(1, length(qual) + 1),
                 lambda i: chr(ascii(substr(qual, i, 1)) - 31)), '') ELSE qual END AS qual,
       ill AND list_min(list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)) - 33)) < 31
         AS invalid
FROM regions r JOIN enc USING (region)
""")
def quality_fix(spark: SparkSession, sf_dir: str):
    """reads of ILLUMINA-encoded groups get every quality lowered by 31;
    ``invalid`` marks reads where that would go below zero."""
    r = regions(spark, sf_dir)
    enc = quality_encoding(r, "region").select("region", (F.col("encoding") == "ILLUMINA").alias("ill"))
    fixed, bad = fix_quality(F.col("qual"))
    # two steps: a same-select alias "qual" would be picked up by the flag's lambda
    flagged = r.join(enc, "region").withColumn("invalid", F.col("ill") & bad)
    return flagged.select("qname", "region", F.when(F.col("ill"), fixed).otherwise(F.col("qual")).alias("qual"),
                          "invalid")


@query("read_groups", oracle=READS_SQL + """
SELECT qname, 'GROUP1' AS rgid, 'LIB1' AS rglb, 'ILLUMINA' AS rgpl, 'UNIT1' AS rgpu, 'SAMPLE1' AS rgsm FROM regions
""")
def read_groups(spark: SparkSession, sf_dir: str):
    """Constant read-group tags on every read."""
    return with_read_groups(regions(spark, sf_dir).select("qname"), READ_GROUP)


@query("mark_duplicates", oracle=READS_SQL + """
, r AS (SELECT *, flag & 16 <> 0 AS is_reverse, flag & 4 = 0 AS mapped,
               CASE WHEN flag & 16 <> 0 THEN aln_end + coalesce(TRY_CAST(regexp_extract(cigar, '(\\d+)S$', 1) AS INT), 0)
                    ELSE pos - coalesce(TRY_CAST(regexp_extract(cigar, '^(\\d+)S', 1) AS INT), 0) END AS pos5,
               list_sum(list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)) - 33)) AS qsum
        FROM reads),
k AS (SELECT *, row_number() OVER (PARTITION BY rname, pos5, is_reverse ORDER BY qsum DESC, qname) AS rk
      FROM r WHERE mapped)
SELECT r.qname, r.rname, r.pos5, r.is_reverse, r.mapped AND coalesce(k.rk, 1) > 1 AS is_dup
FROM r LEFT JOIN k ON k.qname = r.qname
""")
def mark_duplicates_query(spark: SparkSession, sf_dir: str):
    """Duplicate flag per read from (reference, 5' position, strand)."""
    d = mark_duplicates(typed_reads(spark, sf_dir))
    return d.select("qname", "rname", "pos5", "is_reverse", "is_dup")


@query("clean_alignments", oracle=READS_SQL + """
SELECT qname, aln_end,
       (CASE WHEN length > 0 AND aln_end > length THEN length ELSE aln_end END)::INT AS clean_end,
       CASE WHEN flag & 4 <> 0 THEN 0 ELSE mapq END AS clean_mapq,
       (CASE WHEN length > 0 AND aln_end > length THEN length ELSE aln_end END) <> aln_end
         OR (CASE WHEN flag & 4 <> 0 THEN 0 ELSE mapq END) <> mapq AS changed
FROM reads
""")
def clean_alignments_query(spark: SparkSession, sf_dir: str):
    """Ends clipped to the sequence length, MAPQ 0 when unmapped."""
    c = clean_alignments(typed_reads(spark, sf_dir), small(seq_dict_df(spark)))
    return c.select("qname", "aln_end", "clean_end", "clean_mapq", "changed")
