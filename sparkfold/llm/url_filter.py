"""URL filter: allow and block rules on hosts and path prefixes (native).

Every host becomes a canonical key: its labels reversed, each followed by a
dot (``blog.a.net`` -> ``net.a.blog.``).  A rule's host and all its subdomains
are then exactly the keys in ``[key, key with '/' for the last '.')``, because
``/`` follows ``.`` and no host holds a ``/``.  Such intervals nest or are
disjoint, so between two neighbouring interval borders the *stack* of active
rules is fixed.  The join is one sorted sweep: borders (which carry the stack
valid from there on) and the distinct hosts are put in key order, and every
host takes over the last border before it.  The order is range partitioned;
a partition starts with the stack left by those before it.  Urls then take
their host's stack by an equi-join and keep the longest rule whose path is a
prefix of theirs.

Scale: hosts are pre-aggregated (a host with a third of the urls is one row of
the sweep); the urls are shuffled once, by host, in a join whose large
partitions AQE splits.

Cases.  A url that is null or has no ``://`` has an empty host and path and no
rule.  Repeated rows give repeated results.  Equal rules count once; if a rule
is both allowed and blocked, block wins.  Rules with a null host or path are
ignored (a null verdict never wins).  Columns other than the two named ones
pass through only if asked for in ``keep``.  Empty inputs give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.llm.common import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STACK = "array<struct<length:int,block:boolean,rule:string,path:string,verdict:string>>"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _borders(rules: DataFrame) -> DataFrame:
    """(key, stack): the rules active from ``key`` on, up to the next border."""
    own = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
           .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
           .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))      # "block" > "allow"
           .select(host_key(F.col("host")).alias("key"), F.struct(
               F.length(F.concat("host", "path")).alias("length"), (F.col("verdict") == "block").alias("block"),
               F.concat("host", "path").alias("rule"), "path", "verdict").alias("r")))
    by_host = own.groupBy("key").agg(F.collect_list("r").alias("rs"))
    # a host's ancestors are the keys cut after each of its labels
    labels = F.split(F.expr("substr(key, 1, length(key) - 1)"), r"\.", -1)
    cuts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    up = by_host.select("key", F.explode(cuts).alias("up"))
    chain = (up.join(by_host.select(F.col("key").alias("up"), "rs"), "up")
             .groupBy("key").agg(F.flatten(F.collect_list("rs")).alias("opened"),
                                 F.flatten(F.collect_list(F.when(F.col("up") != F.col("key"), F.col("rs")))).alias("closed")))
    start = chain.select("key", F.col("opened").cast(STACK).alias("stack"))
    end = chain.select(F.expr("concat(substr(key, 1, length(key) - 1), '/')").alias("key"),
                       F.col("closed").cast(STACK).alias("stack"))
    return start.unionByName(end)


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, stack) for the distinct ``hosts`` that at least one rule's interval holds."""
    marks = _borders(rules).select("key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "stack")
    points = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host",
                          F.lit(None).cast(STACK).alias("stack"))
    ranged = settled(marks.unionByName(points).repartitionByRange("key", "kind")
                     .withColumn("part", F.spark_partition_id()), "url-sweep")
    # what a partition inherits: the last border of the partitions before it (a row per partition)
    last = ranged.groupBy("part").agg(F.max_by(F.col("stack"), F.when(F.col("kind") == 0, F.col("key"))).alias("left"))
    carry = last.select("part", F.last("left", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("inherited"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.withColumn("seen", F.last("stack", ignorenulls=True).over(sweep))
            .where("kind = 1").join(carry, "part")
            .select("host", F.coalesce("seen", "inherited").alias("stack"))
            .where(F.size("stack") > 0))


def filter_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                keep: tuple[str, ...] = (), default: str = "allow") -> DataFrame:
    """``id_col``, host, path, rule (null if none fits) and verdict of every row of ``urls``.

    ``rules``: host, path, verdict (``allow`` or ``block``).  The longest
    fitting rule wins; among equally long ones, block.
    """
    parts = urls.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"), *keep)
    stacks = active_rules(parts.select("host").distinct(), rules)
    fits = F.array_max(F.filter("stack", lambda r: F.col("path").startswith(r["path"])))
    return (parts.join(stacks, "host", "left").withColumn("best", fits)
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict"), *keep))
