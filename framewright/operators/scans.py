"""Ordered scans over groups of any size: running totals, previous values, numbering.

A window over a group puts the whole group into one task. Groups above
``rows_per_chunk`` are therefore cut into ordered chunks first: each chunk is
scanned by an ordinary window, one small row per chunk is carried forward to the
chunks after it, and both meet in an equi-join on (group, chunk). Groups below the
limit form a single chunk, and when no group is above it the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.session import stage

ROWS_PER_CHUNK = 1_000_000
# Sampled rows per chunk. They only choose where chunks begin; every row is kept.
SAMPLES_PER_CHUNK = 64

# Starts that a group's own row holds at most; only longer groups have cells.
WHOLE_STARTS = 64

CHUNK = "_chunk"


@dataclass(frozen=True)
class Chunks:
    """Where the chunks of large groups begin.

    ``groups`` has one row per large group, None when no group is large. With up to
    ``WHOLE_STARTS`` starts the row holds them all, and one equi-join finds the chunk by halving.
    A group of more has about the square root of n cells of as many chunk starts each, however
    the positions are spread; its row knows where the cells begin, and a second equi-join with
    ``cells`` finds the chunk. ``cells`` is None when no group has so many.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    groups: DataFrame | None = None
    cells: DataFrame | None = None

    @property
    def split(self) -> bool:
        return self.groups is not None

    @property
    def partition(self) -> list[str]:
        return [*self.keys, CHUNK]


def _position(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in order])


def plan_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    counted: DataFrame | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> Chunks:
    """Find the groups above ``rows_per_chunk`` and cut them at sampled positions.

    ``order`` must be unique within a group. Runs one counting job; large groups cost
    one more pass over their keys. Chunks so short that every row is a sample are counted
    and cut in the same pass. The bounds hold about one entry per ``rows_per_chunk`` rows
    and are staged, so they never pass through the driver. ``counted`` is a table with the
    same groups that is cheaper to count than ``df``.
    """
    keys, order = tuple(keys), tuple(order)
    every = max(1, rows_per_chunk // SAMPLES_PER_CHUNK)
    in_order = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`") for c in order])
    placed = df.select(*keys, *[F.col(f"`{c}`") for c in order if c not in keys])
    if every == 1:
        for key in keys:
            placed = placed.where(F.col(key).isNotNull())
        whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        placed = placed.withColumn("_rows", F.count(F.lit(1)).over(whole))
    else:
        sizes = (df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        large = sizes.where(F.col("_rows") > rows_per_chunk)
        if large.isEmpty():
            return Chunks(keys, order)
        sampled = placed.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order]), F.lit(every)) == 0)
        placed = sampled.join(large, list(keys))

    ranked = placed.withColumn("_rank", F.row_number().over(in_order))
    ranked = ranked.where((F.col("_rows") > rows_per_chunk) & (F.col("_rank") % max(1, rows_per_chunk // every) == 0))
    begins = stage(ranked.select(*keys, _position(order).alias("_at")), "chunk-begins")
    if every == 1 and begins.isEmpty():
        return Chunks(keys, order)

    # equal numbers of starts in each cell, whatever the type or the spread of the positions
    group = Window.partitionBy(*keys)
    starts = F.count(F.lit(1)).over(group)
    step = F.when(starts <= WHOLE_STARTS, starts).otherwise(F.ceil(F.sqrt(starts))).cast("int")
    numbered = begins.select(
        *keys,
        "_at",
        (F.row_number().over(group.orderBy("_at")) - 1).alias("_place"),
        step.alias("_step"),
        (starts <= WHOLE_STARTS).alias("_alone"),
    )
    numbered = numbered.withColumn("_cell", F.call_function("div", F.col("_place"), F.col("_step")).cast("int"))
    held = numbered.groupBy(*keys, "_alone", "_cell")
    held = stage(held.agg(F.array_sort(F.collect_list("_at")).alias("_begins"), F.min("_place").alias("_base")), "chunk-cells")
    alone = held.where("_alone").select(*keys, F.col("_begins").alias("_starts"))
    cells = held.where(~F.col("_alone")).drop("_alone")
    if cells.isEmpty():
        return Chunks(keys, order, stage(alone, "chunk-groups"))
    edges = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.get("_begins", F.lit(0)))).alias("_edges"))
    groups = edges.unionByName(alone, allowMissingColumns=True)
    return Chunks(keys, order, stage(groups, "chunk-groups"), stage(cells, "chunk-cells"))


def _begun(begins: Column, at: Column) -> Column:
    """How many of the sorted positions are not after ``at``, by halving."""
    steps = F.ceil(F.log2(F.size(begins) + F.lit(1))).cast("int")
    start = F.struct(F.lit(0).alias("low"), F.size(begins).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.shiftright(low + high, 1)
        after = F.get(begins, middle) <= at
        halved = F.struct(
            F.when(after, middle + F.lit(1)).otherwise(low).alias("low"),
            F.when(after, high).otherwise(middle).alias("high"),
        )
        return F.when(low < high, halved).otherwise(span)

    return F.aggregate(F.sequence(F.lit(0), steps), start, halve, lambda span: span["low"])


def _find_chunk(df: DataFrame, chunks: Chunks, how: str) -> DataFrame:
    # No broadcast hints: both tables are written and of known size. Spark broadcasts
    # them below its threshold; above it the cells spread a large group by themselves.
    at = _position(chunks.order)
    found = df.join(chunks.groups, list(chunks.keys), how)
    number = F.when(F.col("_starts").isNotNull(), _begun(F.col("_starts"), at))
    if chunks.cells is None:
        return found.withColumn(CHUNK, F.coalesce(number, F.lit(0))).drop("_starts")
    cell = F.when(F.col("_edges").isNotNull(), F.greatest(_begun(F.col("_edges"), at) - 1, F.lit(0)))
    # The number that needs no cell is worked out first, so that no list of starts is moved.
    found = found.withColumn("_cell", cell.cast("int")).withColumn(CHUNK, number).drop("_edges", "_starts")
    found = found.join(chunks.cells, [*chunks.keys, "_cell"], "left")
    inside = F.when(F.col("_begins").isNotNull(), F.col("_base") + _begun(F.col("_begins"), at))
    found = found.withColumn(CHUNK, F.coalesce(CHUNK, inside, F.lit(0)))
    return found.drop("_cell", "_begins", "_base")


def chunk_numbers(chunks: Chunks) -> DataFrame:
    """One row per chunk of the groups that were cut, also where no row lies in it."""
    keys = list(chunks.keys)
    alone = chunks.groups.where(F.col("_starts").isNotNull())
    alone = alone.select(*keys, F.explode(F.sequence(F.lit(0), F.size("_starts"))).alias(CHUNK))
    if chunks.cells is None:
        return alone
    first = F.when(F.col("_base") == 0, 0).otherwise(F.col("_base") + 1)
    inside = F.sequence(first, F.col("_base") + F.size("_begins"))
    return alone.unionByName(chunks.cells.select(*keys, F.explode(inside).alias(CHUNK)))


def with_chunk(df: DataFrame, chunks: Chunks) -> DataFrame:
    """Add the chunk number of every row; 0 for groups that were not cut."""
    return _find_chunk(df, chunks, "left") if chunks.split else df.withColumn(CHUNK, F.lit(0))


def only_split_groups(df: DataFrame, chunks: Chunks) -> DataFrame:
    """Rows of the groups that were cut, with their chunk number."""
    return _find_chunk(df, chunks, "inner")


def spread(df: DataFrame, chunks: Chunks) -> DataFrame:
    """``with_chunk`` and, when groups were cut, a shuffle on (group, chunk).

    The shuffle is stated because a frame that is already hashed on the group alone
    would satisfy the windows and keep a large group in one task.
    """
    marked = with_chunk(df, chunks)
    return marked.repartition(*[F.col(f"`{c}`") for c in chunks.partition]) if chunks.split else marked


def join_carry(df: DataFrame, carry: DataFrame, chunks: Chunks) -> DataFrame:
    """Attach the per-chunk carry; both sides are hashed on (group, chunk)."""
    return df.join(carry, chunks.partition, "left")


def _order(chunks: Chunks) -> list[Column]:
    return [F.col(f"`{c}`") for c in chunks.order]


def running_totals(
    df: DataFrame, values: Mapping[str, Column], chunks: Chunks, *, inclusive: bool = True
) -> DataFrame:
    """Sum of each value over the rows of a group up to the current one, or before it."""
    parts = {name: f"_value{i}" for i, name in enumerate(values)}
    df = df.select("*", *[value.alias(parts[name]) for name, value in values.items()])
    rows = spread(df, chunks)
    until_now = Window.partitionBy(*chunks.partition).orderBy(*_order(chunks)).rowsBetween(Window.unboundedPreceding, 0)
    totals = []
    for name, part in parts.items():
        total = F.sum(part).over(until_now)
        totals.append((total if inclusive else total - F.col(part)).alias(name))
    rows = rows.select("*", *totals)
    if chunks.split:
        sums = only_split_groups(df, chunks).groupBy(*chunks.partition)
        sums = sums.agg(*[F.sum(part).alias(part) for part in parts.values()])
        before = Window.partitionBy(*chunks.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = sums.select(*chunks.partition, *[F.sum(part).over(before).alias(f"_before{part}") for part in parts.values()])
        rows = join_carry(rows, carry, chunks)
        for name, part in parts.items():
            rows = rows.withColumn(name, F.col(name) + F.coalesce(F.col(f"_before{part}"), F.lit(0)))
        rows = rows.drop(*[f"_before{part}" for part in parts.values()])
    return rows.drop(*parts.values(), CHUNK)


def running_total(df: DataFrame, value: Column, name: str, chunks: Chunks, *, inclusive: bool = True) -> DataFrame:
    return running_totals(df, {name: value}, chunks, inclusive=inclusive)


def number_rows(df: DataFrame, name: str, chunks: Chunks) -> DataFrame:
    """Dense row number from 0 within a group."""
    return running_total(df, F.lit(1).cast("long"), name, chunks, inclusive=False)


def totals_before(
    df: DataFrame, order: Sequence[str], values: Mapping[str, Column], *, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Sum of each value over all rows of a table before the current one.

    For tables of one row per segment, episode or task; they too are cut when large.
    """
    whole = df.withColumn("_all", F.lit(0))
    chunks = plan_chunks(whole, ["_all"], order, rows_per_chunk=rows_per_chunk)
    return running_totals(whole, values, chunks, inclusive=False).drop("_all")


def number_all(df: DataFrame, order: Sequence[str], name: str, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Dense row number from 0 over a whole table."""
    return totals_before(df, order, {name: F.lit(1).cast("long")}, rows_per_chunk=rows_per_chunk)


def previous_value(df: DataFrame, value: str, name: str, chunks: Chunks) -> DataFrame:
    """Value of the row before; null at the first row of a group."""
    rows = spread(df, chunks)
    within = Window.partitionBy(*chunks.partition).orderBy(*_order(chunks))
    rows = rows.withColumn(name, F.lag(value).over(within))
    if chunks.split:
        rows = rows.withColumn("_first", F.row_number().over(within) == 1)
        last = F.max_by(F.col(value), _position(chunks.order)).alias("_last")
        lasts = only_split_groups(df, chunks).groupBy(*chunks.partition).agg(last)
        earlier = Window.partitionBy(*chunks.keys).orderBy(CHUNK)
        carry = lasts.select(*chunks.partition, F.lag("_last").over(earlier).alias("_before"))
        rows = join_carry(rows, carry, chunks)
        rows = rows.withColumn(name, F.when(F.col("_first"), F.col("_before")).otherwise(F.col(name)))
        rows = rows.drop("_first", "_before")
    return rows.drop(CHUNK)
