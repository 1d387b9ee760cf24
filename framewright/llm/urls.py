"""URL rules and a tree of path templates per host.

The tree is grown level by level from the root: at each node a path segment stays literal if
at least so many pages have it, however many others the node has; every other segment becomes ``*``. Then branches are
merged from the deepest literal up: a template whose labelled pages do not differ from those of
its siblings taken together (two-proportion test), or that has too few of them, takes ``*`` for
its last literal. What is left is judged by the part of labelled pages that are bad, smoothed by
the rate of the host, which is smoothed by the rate of all pages.

All levels are joins and aggregates that combine before they shuffle; a host of a third of all
pages is joined through Spark's splitting of skewed joins.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.session import stage


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both empty for null or without ``://``."""
    whole = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.regexp_extract(whole, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule (``host/path``) that fits; null if none does. ``rules``: rule to verdict."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, start = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith("/" + start), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def grow(pages: DataFrame, *, least: int, depth: int) -> DataFrame:
    """``host, path, template, pages`` for every different path; a path deeper than ``depth`` has
    its rest as one segment, which is judged like any other."""
    parts = F.split(F.substring("path", 2, 1 << 30), "/", depth)
    rows = pages.groupBy("host", "path").agg(F.count("*").alias("pages")).withColumn("parts", parts).withColumn("template", F.lit(""))
    rows = stage(rows.withColumn("template", F.when(F.col("path") == "", "").otherwise("/")), "paths")
    levels = rows.agg(F.max(F.when(F.col("path") != "", F.size("parts")))).first()[0] or 0
    for level in range(levels):
        segment = F.get("parts", F.lit(level))
        inner = rows.where(segment.isNotNull() & (F.col("path") != "")).withColumn("segment", segment)
        counts = inner.groupBy("host", "template", "segment").agg(F.sum("pages").alias("n"))
        literal = counts.where(F.col("n") >= least)
        rows = rows.withColumn("segment", F.when(F.col("path") != "", segment))
        rows = rows.join(literal.select("host", "template", "segment", F.lit(True).alias("stays")), ["host", "template", "segment"], "left")
        own = F.when(F.col("stays"), F.col("segment")).otherwise("*")
        glue = F.lit("" if level == 0 else "/")
        rows = rows.withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", glue, own)))
        rows = stage(rows.drop("segment", "stays"), "level")
    return rows.select("host", "path", "template", "pages")


def merge(found: DataFrame, labelled: DataFrame, *, least: int, z: float) -> DataFrame:
    """``host, template, final``: the template each one is merged into."""
    counts = labelled.groupBy("host", "template").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    state = found.select("host", "template").distinct().join(counts, ["host", "template"], "left").na.fill(0, ["n", "bad"])
    state = stage(state.withColumn("final", F.col("template")), "templates")
    literal = r"^(.*/)[^*/][^/]*((?:/\*?)*)$"
    rounds = state.agg(F.max(F.size(F.split("template", "/")))).first()[0] or 0
    for _ in range(rounds - 1):
        now = state.groupBy("host", "final").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        now = now.withColumn("parent", F.regexp_replace("final", literal, "$1*$2"))
        # with those that are there already, from an earlier round or from the start
        above = now.groupBy("host", "parent").agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"))
        rate = F.col("all_bad") / F.col("all_n")
        rest_n, rest_bad = F.col("all_n") - F.col("n"), F.col("all_bad") - F.col("bad")
        spread = F.sqrt(rate * (1 - rate) * (1 / F.col("n") + 1 / rest_n))
        far = F.abs(F.col("bad") / F.col("n") - rest_bad / rest_n) > z * spread
        apart = (F.col("n") >= least) & (rest_n >= least) & far
        moved = now.join(above, ["host", "parent"]).where(~F.coalesce(apart, F.lit(False)) & (F.col("parent") != F.col("final")))
        moved = moved.select("host", "final", F.col("parent").alias("to"))
        state = state.join(moved, ["host", "final"], "left").withColumn("final", F.coalesce("to", "final")).drop("to")
        state = stage(state.select("host", "template", "final", "n", "bad"), "merged")
    return state.select("host", "template", "final")


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Mapping[str, str],
    *,
    least: int = 10,
    depth: int = 8,
    z: float = 1.96,
    strength: float = 10.0,
    limit: float = 0.5,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key, host, path, rule, verdict, template, purity`` for every page.

    ``labels`` has key and bad (0 or 1); several labels of a key count once, as their largest. A
    template is blocked if its smoothed part of bad pages is above ``limit``; without any label
    nothing is. Pages without host form a host of their own; null and repeated keys are kept
    (a null key has no label); other columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(url))
    rows = stage(pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path")), "pages")
    paths = grow(rows, least=least, depth=depth)
    bad = labels.select(F.col(key).alias("key"), F.col("bad").cast("long").alias("bad")).where("key is not null and bad is not null")
    bad = bad.groupBy("key").agg(F.max("bad").alias("bad"))
    placed = rows.join(paths.drop("pages"), ["host", "path"])
    labelled = stage(placed.join(bad, "key").select("host", "template", "bad"), "labelled")
    finals = merge(paths, labelled, least=least, z=z)
    counted = labelled.join(finals, ["host", "template"]).groupBy("host", "final").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = labelled.groupBy("host").agg(F.count("*").alias("host_n"), F.sum("bad").alias("host_bad"))
    base = labelled.agg(F.coalesce(F.avg("bad"), F.lit(0.0))).first()[0]
    of_host = (F.coalesce("host_bad", F.lit(0)) + strength * F.lit(base)) / (F.coalesce("host_n", F.lit(0)) + strength)
    purity = (F.coalesce("bad", F.lit(0)) + strength * of_host) / (F.coalesce("n", F.lit(0)) + strength)
    templates = finals.join(counted, ["host", "final"], "left").join(hosts, "host", "left")
    templates = stage(templates.select("host", "template", "final", purity.alias("purity")), "purity")
    judged = paths.join(templates, ["host", "template"]).select("host", "path", "final", "purity")
    rule = rule_for(F.col("host"), F.col("path"), rules)
    fixed = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[F.col("rule")] if rules else F.lit(None).cast("string")
    out = rows.join(judged, ["host", "path"]).withColumn("rule", rule)
    verdict = F.coalesce(fixed, F.when(F.col("purity") > limit, "block").otherwise("allow"))
    return out.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), F.col("final").alias("template"), "purity")
