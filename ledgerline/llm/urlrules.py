"""URL filter rules as nested intervals, joined by a sorted sweep.

A rule (host, path) covers the urls of its host and all subdomains whose path begins
with the rule's.  Keys are canonical: host labels reversed, then the path, so every
rule is an interval of keys, and the intervals of one host are nested or disjoint.
A url is looked up under its host and each parent host (at most as many as the
longest rule host has labels).

The sweep sorts rules and lookups of a host by path and carries, at each rule, the
stack of rules open there (those whose interval holds it).  A lookup reads the last
rule before it; the innermost entry of that rule's stack that still holds the lookup
is the longest fitting rule.  Hosts with many lookups are cut into salted sweeps,
each with its own copy of that host's rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import written

#: Lookups of one host that one sweep takes.
SWEEP_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(host, path, verdict, stack): each rule with the rules of the same host whose path
    begins its own, outermost first, itself last.

    A rule looks up its prefixes of the lengths that its host's rules have, so the stacks
    come from equi-joins however many rules a host has."""
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("path")).alias("lengths"))
    long_enough = F.filter("lengths", lambda n: n <= F.length("path"))
    outer = rules.join(lengths, "host").select("host", "path", "verdict", F.explode(long_enough).alias("n")).select(
        "host", "path", "verdict", F.substring("path", F.lit(1), F.col("n")).alias("outer_path"))
    held = outer.join(rules.select("host", F.col("path").alias("outer_path"), F.col("verdict").alias("outer_verdict")),
                      ["host", "outer_path"])
    entry = F.struct(F.length("outer_path").alias("n"), F.col("outer_path").alias("path"), F.col("outer_verdict").alias("verdict"))
    return held.groupBy("host", "path", "verdict").agg(F.sort_array(F.collect_list(entry)).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
          sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``; rules(host, path, verdict).

    The longest rule (host and path together; then the longer host) that fits decides; ``rule``
    is its host and path, null if none fits and ``default`` holds.

    * Null urls and urls without :// have empty host and path and fit no rule.
    * Of rules that repeat a host and path, a block wins over other verdicts, then the smallest;
      rules with a null part are ignored, rule hosts are lower-cased.
    * Equal urls are judged once; repeated rows each get the result; empty rules leave every
      page to ``default``, empty pages give an empty result.  Only the id and url are read.
    """
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").where(
        "host is not null and path is not null and verdict is not null and host <> ''")
    rules = rules.groupBy("host", "path").agg(F.min_by("verdict", F.struct(F.col("verdict") != "block", "verdict")).alias("verdict"))
    stacks = written(rule_stacks(rules).withColumn("host", reversed_host(F.col("host"))), "rules")
    depth = stacks.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 0

    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = rows.where("host <> ''").select("host", "path").distinct()
    labels = F.split(reversed_host(F.col("host")), r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(depth, 1)))),
                          lambda n: F.array_join(F.slice(labels, 1, n), "."))
    lookups = urls.select("host", "path", F.explode(parents).alias("key"))
    # only lookups of hosts that have rules, with the number of sweeps that each such host takes
    hot = lookups.join(stacks.select(F.col("host").alias("key")).distinct(), "key")
    sweeps = written(hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / sweep_rows).cast("int").alias("sweeps")), "sweeps")
    none = "cast(null as array<struct<n:int,path:string,verdict:string>>)"
    asked = hot.join(sweeps, "key").select(
        "key", F.pmod(F.xxhash64("host", "path"), F.col("sweeps")).cast("int").alias("salt"), "path",
        F.lit(1).alias("kind"), "host", F.expr(none).alias("stack"))
    begins = stacks.join(sweeps, F.col("host") == F.col("key")).select(
        "key", F.explode(F.sequence(F.lit(0), F.col("sweeps") - 1)).alias("salt"), "path", F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("host"), "stack")
    sweep = W.partitionBy("key", "salt").orderBy("path", "kind").rowsBetween(W.unboundedPreceding, 0)
    swept = begins.union(asked).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    best = F.try_element_at(F.filter("stack", lambda r: F.col("path").startswith(r["path"])), F.lit(-1))
    fits = swept.select("host", "path", "key", best.alias("rule")).where("rule is not null")
    fits = fits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("key") + F.col("rule")["n"]).alias("n"), F.length("key").alias("host_n"), "key", "rule")).alias("fit"))
    judged = fits.select("host", "path", F.concat(reversed_host(F.col("fit")["key"]), F.col("fit")["rule"]["path"]).alias("rule"),
                         F.col("fit")["rule"]["verdict"].alias("verdict"))
    return rows.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
