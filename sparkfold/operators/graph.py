"""Co-occurrence graph operators.

Vertices that share a group (actors sharing a movie) are adjacent.  The
projected vertex-vertex edge list holds every pair inside a group, which is
quadratic in the group size, so it is never materialised here.  Everything
runs on the bipartite incidence table ``(group, vertex)``:

* degree-style numbers come from group sizes joined back to memberships;
* hop distances come from a breadth-first search that alternates
  vertex -> group -> vertex.  One hop of the projected graph is two joins;
  a group is expanded at most twice, so total work is linear in the
  incidence table.  The frontier of every hop is written with
  ``checkpoint()`` to the shared checkpoint folder, which cuts the lineage
  and survives executor loss.

Several landmarks run in the same search (a ``landmark`` column rides along).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkfold.operators.ordinals import with_dense_index
from sparkfold.session import checkpoint_root


def incidence(df: DataFrame, group: str, vertex: str) -> DataFrame:
    """Distinct (group, vertex) memberships; duplicates do not change distances."""
    return df.select(F.col(group).alias("group"), F.col(vertex).alias("vertex")).distinct()


def group_sizes(members: DataFrame) -> DataFrame:
    """Per group: cast size and number of ordered co-occurrence pairs."""
    return (members.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
            .withColumn("ordered_pairs", F.col("size") * (F.col("size") - 1)))


def cooccurrence_degrees(members: DataFrame) -> DataFrame:
    """Per vertex: groups joined and co-appearances with multiplicity
    (sum over its groups of size - 1), i.e. its multi-edge out-degree."""
    sizes = group_sizes(members).select("group", "size")
    return (members.join(sizes, "group")
            .groupBy("vertex")
            .agg(F.count(F.lit(1)).alias("n_groups"),
                 F.sum(F.col("size") - 1).alias("co_appearances")))


def hop_distances(members: DataFrame, sources: DataFrame, max_hops: int | None = None) -> DataFrame:
    """BFS from ``sources`` (columns ``landmark``, ``vertex``) over the
    co-occurrence graph of ``members`` (``group``, ``vertex``).

    Returns (landmark, vertex, dist); unreachable vertices are absent.

    One hop = frontier -> its groups -> their members, minus vertices already
    reached.  Members of one group are adjacent, so their distances differ by
    at most one: a group is expanded at most twice, and no visited-group set
    is needed.  Each hop's new vertices are checkpointed (a plan leaf in the
    shared checkpoint folder), so every hop plans as two joins and one
    anti-join against the union of earlier leaves: one job per hop (its row
    count is observed by that same job), and nothing to recompute after a
    lost executor.
    """
    spark = members.sparkSession
    checkpoint_root(spark)
    m = members.select("group", "vertex").checkpoint(eager=True)
    frontier = (sources.select("landmark", "vertex").join(m.select("vertex").distinct(), "vertex", "left_semi")
                .distinct().withColumn("dist", F.lit(0)).checkpoint(eager=True))
    reached: list[DataFrame] = [frontier]
    hop = 0
    while max_hops is None or hop < max_hops:
        groups = frontier.join(m, "vertex").select("landmark", "group").distinct()
        size = Observation(f"bfs-hop-{hop + 1}")      # row count gathered by the checkpoint job itself
        nxt = (groups.join(m, "group").select("landmark", "vertex").distinct()
               .join(_union_all(reached).select("landmark", "vertex"), ["landmark", "vertex"], "left_anti")
               .withColumn("dist", F.lit(hop + 1))
               .observe(size, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True))
        if size.get["rows"] == 0:
            break
        hop += 1
        reached.append(nxt)
        frontier = nxt
    return _union_all(reached)


def _union_all(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def exact_round(num, den, digits: int):
    """round(num / den, digits) half-up, exactly: integer arithmetic on
    decimals, then one division by a power of ten (the same double in every
    engine, so reports compare bit-for-bit)."""
    scale = 10 ** digits
    n = (num.cast("decimal(38,0)") * scale * 2 + den)
    q = F.floor(n / (den.cast("decimal(38,0)") * 2)).cast("bigint")
    return F.when(den > 0, q / F.lit(float(scale)))


def _flag_totals(vertices: DataFrame, flag: str) -> tuple[int, int]:
    # one aggregate row: two scalars, no data through the driver
    row = vertices.agg(F.count_if(F.col(flag)).alias("m"), F.count_if(~F.col(flag)).alias("f")).first()
    return int(row["m"]), int(row["f"])


def separation_histogram(dist: DataFrame, vertices: DataFrame, flag: str = "is_male",
                         lo: int = 1, hi: int = 6) -> DataFrame:
    """Per distance lo..hi: count and percentage (of that flag's own total,
    not of the distance's total) per flag.  Empty distances give zeros."""
    spark = dist.sparkSession
    tm, tf = _flag_totals(vertices, flag)
    counts = (dist.where(F.col("dist").between(lo, hi))
              .groupBy("dist").agg(F.count_if(F.col(flag)).alias("male_count"),
                                   F.count_if(~F.col(flag)).alias("female_count")))
    domain = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("dist"))
    h = domain.join(counts, "dist", "left").na.fill(0, ["male_count", "female_count"])
    h = h.select("dist", "male_count", exact_round(F.col("male_count") * 100, F.lit(tm), 2).alias("male_pct"),
                 "female_count", exact_round(F.col("female_count") * 100, F.lit(tf), 2).alias("female_pct"))
    # the printed form (values are already exactly rounded, so any printf agrees)
    return h.withColumns({"male_share": F.format_string("%1.2f%%", "male_pct"),
                          "female_share": F.format_string("%1.2f%%", "female_pct")})


def separation_totals(dist: DataFrame, vertices: DataFrame, flag: str = "is_male",
                      lo: int = 1, hi: int = 6) -> DataFrame:
    """Vertices at distance lo..hi: all / per flag, with 7-digit ratios."""
    tm, tf = _flag_totals(vertices, flag)
    t = dist.where(F.col("dist").between(lo, hi)).agg(
        F.count(F.lit(1)).alias("in_range"), F.count_if(F.col(flag)).alias("male_in_range"),
        F.count_if(~F.col(flag)).alias("female_in_range"))
    t = t.select("in_range", exact_round(F.col("in_range"), F.lit(tm + tf), 7).alias("ratio"),
                 "male_in_range", exact_round(F.col("male_in_range"), F.lit(tm), 7).alias("male_ratio"),
                 "female_in_range", exact_round(F.col("female_in_range"), F.lit(tf), 7).alias("female_ratio"))
    return t.withColumn("ratio_text", F.format_string("%1.7f", "ratio"))


def separation_listing(dist: DataFrame, at: int = 6, flag: str = "is_male", name: str = "name") -> DataFrame:
    """Numbered name list (1..n per flag, by name) of vertices at distance ``at``.
    Ranks come from a distributed dense index, not a one-partition window."""
    sel = dist.where(F.col("dist") == at).select(flag, name, "vertex")
    idx = with_dense_index(sel, [F.desc(flag), name, "vertex"], "_i")
    first = idx.groupBy(flag).agg(F.min("_i").alias("_f"))     # <= 2 rows
    return (idx.join(F.broadcast(first), flag)
            .select(flag, (F.col("_i") - F.col("_f") + 1).alias("rank"), name))
