"""Merkle trees over the rows of a table, one for each group and one over the groups.

A level of a tree is a string of digests of 64 hex digits, so that the parents of a level are
the digests of its substrings of 128 digits, and what flanks a node is a substring too. A group
is cut into aligned blocks of ``2 ** BITS`` rows; a block is one row that carries the string of
its leaves and works out its levels up to one digest. The digests of a group's blocks are the
leaves of the next round, until each group has one, its subroot; the subroots, in the order of
their groups, are the leaves of one more tree, whose last digest is the root. A path is put
together on the way back, from the last round to the first. No group is gathered: a block has
``2 ** BITS`` rows, and a round has that many times fewer rows than the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.lines import let
from framewright.llm.ordering import numbered
from framewright.session import stage

BITS = 8
DIGITS = 64


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(*fields: Column) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its text; null is ``-``."""
    written = (F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields)
    return digest(F.concat(*written))


def _parents(level: Column) -> Column:
    """The next level: digests of every two nodes, the last one alone if their number is odd."""
    last = F.ceil(F.length(level) / (2 * DIGITS)).cast("int") - 1
    each = F.transform(F.sequence(F.lit(0), last), lambda i: digest(F.substring(level, i * (2 * DIGITS) + 1, F.lit(2 * DIGITS))))
    return F.concat_ws("", each).cast("binary")


def _levels(leaves: Column, height: Column) -> Column:
    """The strings of all levels, the leaves first."""
    steps = F.slice(F.array(*map(F.lit, range(BITS))), F.lit(1), height)
    return F.aggregate(steps, F.array(leaves), lambda found, _: F.array_append(found, _parents(F.element_at(found, -1))))


def _flanks(levels: Column, position: Column, height: Column) -> Column:
    """What stands to the left and right of a node's ancestors within their pairs, from below."""

    def flank(level, k):
        place = F.call_function("shiftright", F.pmod(position, F.lit(2**BITS)).cast("int"), k)
        other = F.substring(level, place.bitwiseXOR(F.lit(1)) * DIGITS + 1, F.lit(DIGITS)).cast("string")
        right = place.bitwiseAND(F.lit(1)) == 1
        return F.struct(F.when(right, other).otherwise("").alias("left"), F.when(right, "").otherwise(other).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), height), flank)


def _height(total: Column) -> Column:
    """Levels of pairs within a block of a group with so many nodes."""
    return F.when(total > 1, F.least(F.length(F.bin(total - 1)), F.lit(BITS))).otherwise(0)


def _blocks(nodes: DataFrame, *also: str) -> DataFrame:
    """One row per aligned block: its nodes in order, the number of the group's nodes, its digest."""
    rows = F.array_sort(F.collect_list(F.struct("position", "node", *also)))
    block = F.floor(F.col("position") / 2**BITS).alias("block")
    found = nodes.groupBy("name", block).agg(rows.alias("rows"), F.any_value("total").alias("total"))
    top = F.element_at(_levels(_joined(F.col("rows")), _height(F.col("total"))), -1).cast("string")
    return stage(found.withColumn("top", top), "blocks")


def _joined(rows: Column) -> Column:
    return F.concat_ws("", rows["node"]).cast("binary")


def _climb(nodes: DataFrame, *also: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and ``name, node``: the last digest of each group."""
    rounds = [_blocks(nodes, *also)]
    while not rounds[-1].where(F.col("total") > 2**BITS).isEmpty():
        above = F.ceil(F.col("total") / 2**BITS).alias("total")
        rounds.append(_blocks(rounds[-1].select("name", F.col("block").alias("position"), F.col("top").alias("node"), above)))
    return rounds, rounds[-1].select("name", F.col("top").alias("node"))


def _with_path(own: list[str]) -> Callable[[Column], Column]:
    """The nodes of a block with their paths, of its levels."""

    def rows(levels):
        path = lambda r: F.concat(_flanks(levels, r["position"], _height(F.col("total"))), F.col("path"))
        return F.transform("rows", lambda r: F.struct(*[r[n].alias(n) for n in own], path(r).alias("path")))

    return rows


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first round with their whole paths. ``above`` has name, path and other
    columns for the last digest of each group."""
    keep = [c for c in above.columns if c not in ("name", "path")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        own = blocks.schema["rows"].dataType.elementType.names
        found = let(_levels(_joined(F.col("rows")), _height(F.col("total"))), _with_path(own))
        nodes = blocks.join(above, ["name", "block"]).select("name", *keep, F.explode(found).alias("x")).select("name", *keep, "x.*")
        above = nodes.select("name", *keep, F.col("position").alias("block"), "path")
    return nodes


def manifest(docs: DataFrame, *, fields: list[str], key: str = "doc_id", group: str = "lang", also: dict[str, Column] | None = None) -> DataFrame:
    """``key, group, position, leaf, path, subroot, root`` of every row, and the columns ``also``.

    The leaf is a digest of the ``fields``. A group's leaves ascend by key, null first, then by
    leaf; every two consecutive nodes, or a last one alone, give their parent. Subroots ascend by
    the group's bytes, null first. ``path`` lists from leaf to root what stands to the left and
    right in the pair; both are empty for a node alone. Repeated rows and keys are leaves of
    their own; a null group is a group; no rows give no rows; other columns are ignored.
    """
    also = also or {}
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(name.alias("name"), F.col(key).alias("key"), leaf(*map(F.col, fields)).alias("node"), F.struct(F.lit(0), *[c.alias(n) for n, c in also.items()]).alias("also"))
    rounds, tops = _climb(numbered(rows, "name", [F.col("key").asc_nulls_first(), F.col("node")]), "key", "also")
    named = tops.select(F.lit("").alias("name"), F.col("name").alias("group"), "node")
    upper, root = _climb(numbered(named, "name", [F.col("group")]), "group")
    root = root.select("name", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("node").alias("root"))
    subroots = _descend(upper, root).select(F.col("group").alias("name"), "path", F.col("node").alias("subroot"), "root")
    found = _descend(rounds, stage(subroots, "subroots"))
    label = F.when(F.col("name") != "", F.substring("name", 2, 2**31 - 1)).alias(group)
    return found.select(F.col("key").alias(key), label, "position", F.col("node").alias("leaf"), "path", "subroot", "root", *[F.col("also")[n].alias(n) for n in also])


def siblings(path: Column) -> Column:
    """The digests that prove a leaf, from below, left to right."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def folded(value: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, value, lambda h, s: digest(F.concat(s["left"], h, s["right"])))
