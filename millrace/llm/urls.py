"""URL rules as a sort-merge range join, in DataFrame functions only.

A host's key is its labels in reverse order, each followed by a dot, so a rule's host covers one interval of sorted keys:
those its key begins. Intervals either nest or are apart. One sorted sweep over rules and hosts carries the stack of
nested rules that were open at the latest rule; those still open at a host are the ones that its key begins with. Paths
are prefixes too, so the same sweep over host key and path finds the longest rule of each open host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))).otherwise(F.lit(""))


def open_prefixes(points: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct ``key`` of ``points`` the array ``open`` of the ``key`` values of ``rules`` that it begins with.

    The array is sorted from the shortest; keys with an empty one are left out. Rules and points are range partitioned by
    key, and the stack that is open where a partition begins comes from a table of one row per partition.
    """
    starts = rules.select("key").filter("key <> ''").distinct()
    nested = starts.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        F.col("key").alias("inner"), F.expr("substring(key, 1, n)").alias("key"))
    stacks = nested.join(starts, "key").groupBy("inner").agg(F.array_sort(F.collect_list("key")).alias("stack"))  # one rule's own prefixes
    events = stacks.select(F.col("inner").alias("key"), F.lit(0).alias("kind"), "stack").unionByName(
        points.select("key").distinct().select("key", F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("stack")))
    dealt = stored(events.repartitionByRange("key", "kind").withColumn("part", F.spark_partition_id()), "sweep")
    ends = dealt.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    carried = ends.select("part", F.last("stack", True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dealt.withColumn("stack", F.last("stack", True).over(sweep)).filter("kind = 1").join(carried, "part")
    still = F.filter(F.coalesce("stack", "carried"), lambda x: F.startswith(F.col("key"), x))
    return swept.select("key", still.alias("open")).filter("size(open) > 0")


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
               default: str = "allow") -> DataFrame:
    """``id_column, host, path, rule, verdict`` of every row.

    ``rules`` has ``rule`` (host, and from its first ``/`` the start of the path) and ``verdict``. A rule fits its host and
    all subdomains where the url's path begins with the rule's. The longest host wins, then the longest path; of equal
    rules the last verdict in alphabetical order, so ``block``. Without a rule ``rule`` is null and the verdict ``default``.

    A null url and one without ``://`` has an empty host and path and meets no rule. Rules that are null or have no host
    fit nothing. Repeated rows are kept, each judged; null ids too. An empty table gives an empty result, and without
    rules every verdict is ``default``. Other columns are ignored.
    """
    slash = F.instr("rule", "/")
    named = rules.select("rule", "verdict", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("host"),
                         F.when(slash > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit("")).alias("prefix"))
    named = named.filter("host <> '' AND verdict IS NOT NULL").withColumn("at", host_key(F.col("host")))
    named = named.groupBy("at", "prefix").agg(F.max(F.struct("verdict", "rule")).alias("rule")).withColumn("key", F.concat("at", "prefix"))

    urls = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    urls = urls.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    sites = urls.filter("host <> ''").select("host", "path").distinct()
    sites = sites.withColumn("site", host_key(F.col("host")))
    hosts = open_prefixes(sites.select(F.col("site").alias("key")), named.select(F.col("at").alias("key")))
    tried = sites.join(hosts.withColumnRenamed("key", "site"), "site").select(
        "host", "path", F.explode("open").alias("at")).withColumn("key", F.concat("at", "path"))
    found = open_prefixes(tried, named).select("key", F.element_at("open", -1).alias("fits"))
    best = tried.join(found, "key").groupBy("host", "path").agg(
        F.max(F.struct(F.length("at").alias("a"), F.length("fits").alias("b"), "fits")).alias("best"))
    judged = best.select("host", "path", F.col("best.fits").alias("key")).join(named.select("key", F.col("rule").alias("r")), "key")
    judged = judged.select("host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))
    return urls.join(judged, ["host", "path"], "left").select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
