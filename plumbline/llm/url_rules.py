"""URL filtering by rules on host and path, as a sort-merge range join (built-in functions only).

A host's labels in reverse order, each followed by a dot, are its canonical key: a rule's host and all
its subdomains are the keys that start with the rule's key, one interval of the sorted keys. Intervals of
prefixes are nested or apart. So rule hosts and URL hosts are sorted together and swept once; each rule
host brings the stack of rule hosts that enclose it. A URL takes the stack of the last rule host before
it and drops what has ended (keys it does not start with). A second sweep does the same with the paths
of each rule host that is still on the stack. Equal (host, path) pairs are judged once.

A sweep is a window over (group, salt): the points of a hot group are dealt over as many salts as there are
shuffle partitions, and the few rules are repeated for each. A stack is as deep as a host has labels or a
path has enclosing rule paths; it does not grow with the URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, UPPER
from plumbline.operators.skew import spread_join


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#`; then up to `?`, `#`. Else both empty."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, whole.substr(at + 3, F.length(whole))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """`www.example.net` -> `net.example.www.`"""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _sweep(points: DataFrame, starts: DataFrame, salts: int) -> DataFrame:
    """`points` (grp, place, ...) with `stack`: that of the last of `starts` (grp, place, stack) before it."""
    own = [c for c in points.columns if c not in ("grp", "place")]
    dealt = points.withColumn("salt", F.pmod(F.xxhash64("place", *own), F.lit(salts)).cast("int"))
    repeated = starts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    events = dealt.withColumn("kind", F.lit(1)).unionByName(
        repeated.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    before = (
        Window.partitionBy("grp", "salt").orderBy("place", "kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    swept = events.withColumn("stack", F.last("stack", ignorenulls=True).over(before))
    return swept.where("kind = 1").drop("kind", "salt")


def _stacks(rules: DataFrame, grp: list[str], item: str, prefixes: Column) -> DataFrame:
    """(grp, item, stack): for each distinct item of the rules, those among its `prefixes` that are items too."""
    items = rules.select(*grp, item).distinct()
    tried = items.withColumn("outer", F.explode(prefixes))
    known = items.select(*(F.col(g).alias(f"__{g}") for g in grp), F.col(item).alias("__item"))
    same = (F.col("outer") == F.col("__item")) & F.lit(True)
    for g in grp:
        same = same & (F.col(g) == F.col(f"__{g}"))
    return tried.join(known, same).groupBy(*grp, item).agg(F.sort_array(F.collect_set("outer")).alias("stack"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int | None = None
) -> DataFrame:
    """`pages` with host, path, rule (`host/path` text or null) and verdict; other columns stay as they are.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the URL's path starts
    with its path; the longest (host and path together, then host) wins, and of equal rules `block` does.
    Rules with a null in any column or an empty host are ignored. A null URL and one without `://` have
    empty host and path and get `default`. Columns of `pages` named like the four results are replaced.
    """
    spark = pages.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*kept, host.alias("host"), path.alias("path"))
    clean = (
        rules.where("host is not null and path is not null and verdict is not null and host <> ''")
        .groupBy(F.translate("host", UPPER, LOWER).alias("rhost"), F.col("path").alias("rpath"))
        .agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
        .withColumn("rkey", host_key(F.col("rhost")))
    )
    first = F.substring_index(F.col("place"), ".", 1)

    # Sweep 1: which rule hosts enclose the host. Prefixes of a key end at its dots.
    labels = F.split("rkey", "\\.")
    key_prefixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )
    hosts = _stacks(clean, [], "rkey", key_prefixes).withColumnRenamed("rkey", "place")
    points = rows.where("host <> ''").select("host", "path").distinct()
    points = points.withColumn("place", host_key(F.col("host")))
    swept = _sweep(points.withColumn("grp", first), hosts.withColumn("grp", first), salts)
    inside = swept.select(
        "host", "path", F.explode(F.filter("stack", lambda k: F.startswith(F.col("place"), k))).alias("grp")
    )

    # Sweep 2: which paths of that rule host the path starts with; the innermost is the longest.
    path_prefixes = F.transform(
        F.sequence(F.lit(0), F.length("rpath")), lambda n: F.substring(F.col("rpath"), F.lit(1), n)
    )
    paths = _stacks(clean, ["rkey"], "rpath", path_prefixes).select(
        F.col("rkey").alias("grp"), F.col("rpath").alias("place"), "stack"
    )
    swept = _sweep(inside.withColumn("place", F.col("path")), paths, salts)
    fitting = F.filter("stack", lambda p: F.startswith(F.col("path"), p))
    found = (
        swept.select("host", "path", F.col("grp").alias("rkey"), F.try_element_at(fitting, F.lit(-1)).alias("rpath"))
        .where("rpath is not null")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rkey") + F.length("rpath"), F.length("rkey"), "rkey", "rpath")).alias("best"))
        .select("host", "path", "best.rkey", "best.rpath")
        .join(clean, ["rkey", "rpath"])
        .select("host", "path", F.concat("rhost", "rpath").alias("rule"), "verdict")
    )
    judged = spread_join(rows, found, ["host", "path"], "left")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
