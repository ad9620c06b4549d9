"""Pileup, variant call, recalibration and duplicate metrics queries.

Binding: every ``lineitem`` row is one read, as in ``plans/genomics`` (name, reference, position, strand, qualities
at offset 33).  Every fifth line of 20 bases and more has an insertion and a deletion, every third a soft clip.  Bases come from a reference
by rule; in it, positions divisible by 40 differ in reads of even orders, positions divisible by 200 in all reads,
and a read base is wrong where (7 offset + order) mod 53 is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.basewise import DEPTHS, SITES, depth_counts, varying_sites
from sparkfold.operators.covered import covered_numbers
from sparkfold.operators.joins import small, spread
from sparkfold.operators.pileup import BASES, call_variants, clip_past_end, pileup_on_reference, read_covariates, recalibrate, vcf_body
from sparkfold.operators.reads import duplicate_metrics, mark_template_duplicates, templates
from sparkfold.plans.genomics import READS_SQL, seq_dict_df, typed_reads
from sparkfold.plans.registry import query
from sparkfold.session import checkpoint_root, scratch_path, stored
from sparkfold.sinks.text import write_sorted_lines
from sparkfold.sources.genomics import chrom_number, read_vcf

CHUNK = 1000


def _order(qname: Column) -> Column:
    return F.substring(F.substring_index(qname, "_", 1), 2, 30).cast("long")


#: the reference and its variants repeat after this many positions
PERIOD = 231 * 200


def _rule(p: int) -> int:
    """Number of the reference base at a position."""
    return (p % 7 + p % 3 + p % 11) % 4


def _cycle(of) -> Column:
    """The letters of all positions of a period; ``of`` gives the number of a base."""
    cycle = "".join(BASES[of(p) % 4] for p in range(PERIOD)).encode()
    return F.lit(cycle + cycle[:CHUNK])


def _stretch(cycle: Column, pos: Column, n: Column | int) -> Column:
    """``n`` letters of a cycle from a position on."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.substring(cycle, F.pmod(pos, F.lit(PERIOD)).cast("int") + 1, n).cast("string")


def sequenced_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped reads with bases from the reference, its variants and errors, built once."""
    checkpoint_root(spark)
    r = spread(typed_reads(spark, sf_dir).where(F.col("flag").bitwiseAND(4) == 0))
    n, pos, order = F.length("qual"), F.col("pos"), _order(F.col("qname"))
    line = F.split("qname", "_")[1].cast("int")
    soft = F.col("cigar").contains("S")
    indel = (line % 5 == 0) & (n >= 20)
    cigar = F.when(indel & ~soft, F.concat(F.lit("8M1I"), (n - 13).cast("string"), F.lit("M1D4M"))).otherwise(F.col("cigar"))

    cycles = [_cycle(lambda p, every=every: _rule(p) + (p % every == 0)) for every in (40, 200)]
    r = r.select("*", n.alias("_n"), order.alias("_order"), F.when(order % 2 == 0, cycles[0]).otherwise(cycles[1]).alias("_cycle"),
                 soft.alias("_soft"), indel.alias("_indel"), F.pmod(order * -38, F.lit(53)).cast("int").alias("_wrong"))     # 7 * 38 = 1 (mod 53): the one offset with an error
    n, soft, indel, wrong = (F.col(c) for c in ("_n", "_soft", "_indel", "_wrong"))

    def bases(at: Column, count: Column | int) -> Column:
        return _stretch(F.col("_cycle"), at, count)
    seq = (F.when(soft, bases(pos - 2, n))
           .when(indel, F.concat(bases(pos, 8), F.lit("G"), bases(pos + 8, n - 13), bases(pos + n - 4, 4))).otherwise(bases(pos, n)))
    r = r.withColumn("_seq", seq)
    seq = F.col("_seq")
    hit = (wrong < n) & ~(indel & ~soft & (wrong == 8))
    seq = F.when(hit, F.overlay(seq, F.translate(F.substring(seq, wrong + 1, F.lit(1)), "ACGT", "GTAC"), wrong + 1, F.lit(1))).otherwise(seq)
    shown = F.translate("qual", "".join(chr(c) for c in range(74, 105)), "".join(chr(c) for c in range(43, 74)))
    return stored(r.select("qname", "flag", "rname", "pos", "aln_end", cigar.alias("cigar"), seq.alias("seq"), shown.alias("qual")), "sequenced-reads")


def reference_chunks(reads: DataFrame) -> DataFrame:
    """(name, number, bases) of the chunks of the reference that reads reach."""
    found = covered_numbers(reads.select(F.col("rname").alias("name"), F.floor((F.col("pos") - 1) / CHUNK).alias("first"), F.floor(F.col("aln_end") / CHUNK).alias("last")))
    return found.select("name", "number", _stretch(_cycle(_rule), F.col("number") * CHUNK + 1, CHUNK).alias("bases"))


_SEQUENCED_SQL = READS_SQL + """
, r0 AS (SELECT qname, rname, flag, pos, length(qual) AS n, cigar LIKE '%S%' AS soft,
    CAST(split_part(substr(qname, 2), '_', 1) AS BIGINT) AS ord, CAST(split_part(qname, '_', 2) AS INT) % 5 = 0 AND length(qual) >= 20 AS indel,
    list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)) - 33) AS qs FROM reads WHERE flag & 4 = 0),
b0 AS (SELECT qname, rname, flag, n, ord, soft, indel, CAST(i AS INT) AS idx, CASE WHEN qs[i + 1] >= 41 THEN qs[i + 1] - 31 ELSE qs[i + 1] END AS q,
    CAST(pos + i + CASE WHEN soft THEN -2 WHEN indel AND i >= 9 AND i < n - 4 THEN -1 ELSE 0 END AS INT) AS p,
    soft AND (i < 2 OR i >= n - 2) AS clipped, indel AND NOT soft AND i = 8 AS extra
  FROM (SELECT *, unnest(range(n)) AS i FROM r0)),
b1 AS (SELECT *, (p % 7 + p % 3 + p % 11) % 4 AS rule, CASE WHEN extra THEN 2 ELSE
    ((p % 7 + p % 3 + p % 11) % 4 + CASE WHEN p % 200 = 0 OR (p % 40 = 0 AND ord % 2 = 0) THEN 1 ELSE 0 END
      + CASE WHEN (idx * 7 + ord) % 53 = 0 THEN 2 ELSE 0 END) % 4 END AS number FROM b0),
bases AS (SELECT *, substr('ACGT', CAST(number AS INT) + 1, 1) AS base, substr('ACGT', CAST(rule AS INT) + 1, 1) AS ref FROM b1),
aligned AS (SELECT qname, rname, flag, n, idx, q, base, p AS pos, ref FROM bases WHERE NOT clipped AND NOT extra)
"""

_CALLS_SQL = _SEQUENCED_SQL + """
, e AS (SELECT *, least(pow(10, -q / 10.0), 0.75) AS err FROM aligned),
l AS (SELECT rname, pos, ref, base, count(*) AS n, sum(CAST(round(log10(1 - err) * 1000000) AS BIGINT)) AS good,
    sum(CAST(round(log10(err / 3) * 1000000) AS BIGINT)) AS wrong, sum(CAST(round(log10((1 - err + err / 3) / 2) * 1000000) AS BIGINT)) AS half
  FROM e GROUP BY ALL),
s AS (SELECT rname, pos, ref, sum(n) AS dp, sum(wrong) AS off, coalesce(sum(n) FILTER (base = ref), 0) AS ad_ref,
    coalesce(sum(good) FILTER (base = ref), 0) AS good_r, coalesce(sum(wrong) FILTER (base = ref), 0) AS wrong_r,
    coalesce(sum(half) FILTER (base = ref), 0) AS half_r FROM l GROUP BY ALL),
a AS (SELECT * FROM l WHERE base <> ref QUALIFY row_number() OVER (PARTITION BY rname, pos ORDER BY n DESC, base) = 1),
g AS (SELECT s.*, a.base AS alt, a.n AS ad_alt, good_r + off - wrong_r AS rr, half_r + a.half + off - wrong_r - a.wrong AS ra, a.good + off - a.wrong AS aa
  FROM s JOIN a USING (rname, pos)),
c AS (SELECT *, greatest(rr, ra, aa) AS top FROM g),
p AS (SELECT *, CAST((top - rr + 50000) // 100000 AS INT) AS p0, CAST((top - ra + 50000) // 100000 AS INT) AS p1, CAST((top - aa + 50000) // 100000 AS INT) AS p2,
    CASE WHEN top = rr THEN '0/0' WHEN top = ra THEN '0/1' ELSE '1/1' END AS gt FROM c),
calls AS (SELECT * FROM p WHERE gt <> '0/0' AND p0 >= 30)
"""


@query("variant_calls", oracle=_CALLS_SQL + """
SELECT CASE WHEN rname = 'chrX' THEN 23 WHEN rname = 'chrY' THEN 24 ELSE TRY_CAST(substr(rname, 4) AS INT) END AS chr_num, CAST(pos AS INT) AS pos, ref, alt,
  p0 AS qual, CAST(dp AS BIGINT) AS dp, gt || ':' || ad_ref || ',' || ad_alt || ':' || p0 || ',' || p1 || ',' || p2 AS sample
FROM calls WHERE rname NOT IN ('chrM', 'chrUn_gl000220')
""")
def variant_calls(spark: SparkSession, sf_dir: str):
    """CIGAR walk, pileup, genotype likelihoods; written as sorted VCF text and read back."""
    reads = sequenced_reads(spark, sf_dir)
    # stored: the sort reads its input twice
    calls = stored(call_variants(pileup_on_reference(reads, reference_chunks(reads), CHUNK, varying_sites, SITES)), "variant-calls")
    lines = calls.withColumn("line", vcf_body(calls)).withColumn("chr_num", chrom_number(F.col("rname")))
    ok, _ = read_vcf(spark, write_sorted_lines(lines, scratch_path(spark, "calls"), ["chr_num", "pos", "line"], "line"))
    field = F.split("line", "\t")
    return ok.select("chr_num", "pos", "ref", "alt", field[5].cast("int").alias("qual"), F.substring_index(field[7], "=", -1).cast("long").alias("dp"),
                     field[9].alias("sample"))


@query("pileup_depth", oracle=_SEQUENCED_SQL + """
SELECT rname, depth, count(*) AS positions, CAST(sum(other) AS BIGINT) AS mismatches FROM (
  SELECT rname, pos, count(*) AS depth, count(*) FILTER (base <> ref) AS other FROM aligned GROUP BY rname, pos) GROUP BY rname, depth
""")
def pileup_depth(spark: SparkSession, sf_dir: str):
    """Positions and mismatching bases by depth."""
    reads = sequenced_reads(spark, sf_dir)
    counts = pileup_on_reference(reads, reference_chunks(reads), CHUNK, depth_counts, DEPTHS, ("n",))
    return counts.groupBy("rname", "depth").agg(F.sum("positions").alias("positions"), F.sum("mismatches").alias("mismatches"))


_KNOWN = 40

_COVARIATES_SQL = _SEQUENCED_SQL + f"""
, seen AS (SELECT a.qname, a.idx, a.q, a.base, a.ref, CASE WHEN a.flag & 16 <> 0 THEN a.n - a.idx ELSE a.idx + 1 END AS cycle,
    coalesce(lag(b.base) OVER (PARTITION BY b.qname ORDER BY b.idx), '') || b.base AS context, a.pos
  FROM bases b LEFT JOIN aligned a ON a.qname = b.qname AND a.idx = b.idx),
counted AS (SELECT q, cycle, context, count(*) AS n, count(*) FILTER (base <> ref) AS wrong FROM seen WHERE q IS NOT NULL AND pos % {_KNOWN} <> 0 GROUP BY ALL)
"""


def known_sites(reads: DataFrame) -> DataFrame:
    """(rname, pos): the places of the reference that are known to vary, where reads reach them."""
    first = F.ceil(F.col("pos") / _KNOWN)
    last = F.floor((F.col("aln_end") + 2) / _KNOWN)
    found = covered_numbers(reads.where(first <= last).select(F.col("rname").alias("name"), first.alias("first"), last.alias("last")))
    return found.select(F.col("name").alias("rname"), (F.col("number") * _KNOWN).cast("int").alias("pos"))


def recalibration_table(reads: DataFrame) -> DataFrame:
    named = reads.withColumn("is_reverse", F.col("flag").bitwiseAND(16) != 0).withColumn("length", F.length("qual"))
    return read_covariates(named, reference_chunks(reads), known_sites(reads), CHUNK)


@query("recalibration_table", oracle=_COVARIATES_SQL + """
SELECT q, CAST(cycle AS INT) AS cycle, context, n, wrong, CAST(round(-10 * log10((wrong + 1) / (n + 2))) AS INT) AS empirical FROM counted
""")
def recalibration_table_query(spark: SparkSession, sf_dir: str):
    """Mismatches outside known sites by quality, cycle and base pair, with empirical qualities."""
    return recalibration_table(sequenced_reads(spark, sf_dir))


@query("recalibrated_reads", oracle=_COVARIATES_SQL + """
, applied AS (SELECT x.qname, x.idx, x.q, c.n, c.wrong FROM (
    SELECT qname, idx, q, CASE WHEN flag & 16 <> 0 THEN n - idx ELSE idx + 1 END AS cycle, coalesce(lag(base) OVER (PARTITION BY qname ORDER BY idx), '') || base AS context
    FROM bases) x LEFT JOIN counted c ON c.q = x.q AND c.cycle = x.cycle AND c.context = x.context)
SELECT qname, string_agg(chr(CAST(33 + CASE WHEN n IS NULL THEN q ELSE greatest(0, least(93, round(-10 * log10((wrong + 1) / (n + 2))))) END AS INT)), '' ORDER BY idx) AS new_qual
FROM applied GROUP BY qname
""")
def recalibrated_reads(spark: SparkSession, sf_dir: str):
    """The second pass; reported qualities replaced by empirical ones."""
    reads = sequenced_reads(spark, sf_dir)
    return recalibrate(reads, recalibration_table(reads)).select("qname", "new_qual")


@query("clean_cigars", oracle=READS_SQL + """
, c AS (SELECT *, length - pos + 1 AS room, CASE WHEN cigar LIKE '%S%' THEN 2 ELSE 0 END AS edge, aln_end - pos + 1 AS m,
    length > 0 AND aln_end > length AS over FROM reads)
SELECT qname, CASE WHEN NOT over THEN cigar ELSE
    CASE WHEN edge > 0 THEN '2S' ELSE '' END || CASE WHEN room > 0 THEN room || 'M' ELSE '' END || (m - greatest(room, 0) + edge) || 'S' END AS clean_cigar,
  CAST(CASE WHEN over THEN pos + greatest(room, 0) - 1 ELSE aln_end END AS INT) AS clean_end
FROM c
""")
def clean_cigars(spark: SparkSession, sf_dir: str):
    """What reaches past the end of a sequence is soft-clipped in the CIGAR; the end follows from it."""
    return clip_past_end(typed_reads(spark, sf_dir), small(seq_dict_df(spark))).select("qname", "clean_cigar", "clean_end")


# --- mates and duplicate metrics --------------------------------------------------------------------------------

def paired_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads in narrow libraries: two lines of an order are mates; three references, twenty places."""
    r = typed_reads(spark, sf_dir)
    part = F.split("qname", "_")
    line, key = part[1].cast("int"), part[2].cast("long")
    order, move = _order(F.col("qname")), ((key % 20 - key) * 75).cast("int")
    return r.select(F.concat(F.lit("LIB"), (order % 3).cast("string")).alias("library"),
                    F.concat_ws("/", order.cast("string"), F.floor((line + 1) / 2).cast("string")).alias("qname"), "flag",
                    F.concat(F.lit("chr"), (part[3].cast("long") % 3 + 1).cast("string")).alias("rname"),
                    (F.col("pos") + move).alias("pos"), (F.col("aln_end") + move).alias("aln_end"), "cigar", "qual")


_PAIRS_SQL = READS_SQL + r"""
, p0 AS (SELECT 'LIB' || CAST(split_part(substr(qname, 2), '_', 1) AS BIGINT) % 3 AS library,
    split_part(substr(qname, 2), '_', 1) || '/' || (CAST(split_part(qname, '_', 2) AS INT) + 1) // 2 AS name, flag, cigar,
    'chr' || (CAST(split_part(qname, '_', 4) AS BIGINT) % 3 + 1) AS rname, flag & 16 <> 0 AS rev,
    list_sum(list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)) - 33)) AS qsum,
    (CAST(split_part(qname, '_', 3) AS BIGINT) % 20 - CAST(split_part(qname, '_', 3) AS BIGINT)) * 75 AS move, pos, aln_end FROM reads),
p1 AS (SELECT *, CASE WHEN rev THEN aln_end + move + coalesce(TRY_CAST(regexp_extract(cigar, '(\d+)S$', 1) AS INT), 0)
    ELSE pos + move - coalesce(TRY_CAST(regexp_extract(cigar, '^(\d+)S', 1) AS INT), 0) END AS pos5 FROM p0),
t AS (SELECT library, name, count(*) AS reads, count(*) FILTER (flag & 4 = 0) AS mapped, min((rname, pos5, rev)) FILTER (flag & 4 = 0) AS lo,
    max((rname, pos5, rev)) FILTER (flag & 4 = 0) AS hi, sum(qsum) FILTER (flag & 4 = 0) AS score FROM p1 GROUP BY library, name),
k AS (SELECT *, CASE mapped WHEN 2 THEN 'pair' WHEN 1 THEN 'fragment' WHEN 0 THEN 'unmapped' ELSE 'other' END AS kind FROM t),
taken AS (SELECT DISTINCT library, unnest([lo, hi]) AS e FROM k WHERE kind = 'pair'),
marked AS (SELECT library, name, reads, mapped, kind, kind IN ('pair', 'fragment') AND
      (row_number() OVER (PARTITION BY library, kind, lo, hi ORDER BY score DESC, name) > 1
       OR (kind = 'fragment' AND EXISTS (SELECT 1 FROM taken WHERE taken.library = k.library AND taken.e = k.lo))) AS is_dup FROM k)
"""


@query("mark_pair_duplicates", oracle=_PAIRS_SQL + "SELECT library, name, kind, is_dup FROM marked")
def mark_pair_duplicates(spark: SparkSession, sf_dir: str):
    """Duplicates among pairs by both 5' ends, and among fragments."""
    return mark_template_duplicates(templates(paired_reads(spark, sf_dir))).select("library", "name", "kind", "is_dup")


@query("duplicate_metrics", oracle=_PAIRS_SQL + """
, m AS (SELECT library, count(*) FILTER (kind = 'fragment') AS unpaired_examined, count(*) FILTER (kind = 'pair') AS pairs_examined,
    CAST(sum(reads - mapped) AS BIGINT) AS unmapped_reads, count(*) FILTER (kind = 'fragment' AND is_dup) AS unpaired_duplicates,
    count(*) FILTER (kind = 'pair' AND is_dup) AS pair_duplicates FROM marked GROUP BY library),
u AS (SELECT *, CAST(pairs_examined AS DOUBLE) AS n, CAST(pairs_examined - pair_duplicates AS DOUBLE) AS c FROM m)
SELECT library, unpaired_examined, pairs_examined, unmapped_reads, unpaired_duplicates, pair_duplicates,
  (unpaired_duplicates + 2 * pair_duplicates) / (unpaired_examined + 2 * pairs_examined) AS duplicate_share,
  CASE WHEN n > c AND c > 0 THEN CAST(round(c * pow(2.0, list_reduce(list_concat([[0.0, 64.0]], list_transform(range(60), lambda i: [0.0, 0.0])),
    lambda s, x: CASE WHEN c / (c * pow(2.0, (s[1] + s[2]) / 2)) - 1 + exp(-n / (c * pow(2.0, (s[1] + s[2]) / 2))) > 0
      THEN [(s[1] + s[2]) / 2, s[2]] ELSE [s[1], (s[1] + s[2]) / 2] END)[1])) AS BIGINT) END AS library_size
FROM u
""")
def duplicate_metrics_query(spark: SparkSession, sf_dir: str):
    """One metrics row per library, with the estimated number of distinct templates."""
    return duplicate_metrics(mark_template_duplicates(templates(paired_reads(spark, sf_dir))))
