"""Latest-at alignment: every column at the rows of a reference column, and frames at target times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import times
from framewright.operators.scans import (
    CHUNK,
    ROWS_PER_CHUNK,
    Chunks,
    chunk_numbers,
    join_carry,
    only_split_groups,
    plan_chunks,
    spread,
)
from framewright.session import stage

SEGMENT, ORDINAL, TIME = "segment_id", "ordinal", "time_ns"
POSITION = (TIME, ORDINAL)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _position() -> Column:
    return F.struct(_q(TIME), _q(ORDINAL))


def index_reader(recording: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a time and at least one of ``columns``, only those columns.

    Rows that hold none of the columns cannot change the result, so they are left
    out before anything is shuffled.
    """
    wanted = list(dict.fromkeys(columns))
    some = F.lit(False)
    for name in wanted:
        some = some | _q(name).isNotNull()
    kept = recording.select(SEGMENT, ORDINAL, TIME, *[_q(c) for c in wanted])
    return kept.where(_q(TIME).isNotNull() & some)


def plan_segments(recording: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> Chunks:
    """Chunks of the segments in time order.

    Counts all rows with a time, also those that hold no wanted value, so that only
    three narrow columns are read.
    """
    keyed = recording.select(SEGMENT, TIME, ORDINAL).where(_q(TIME).isNotNull())
    return plan_chunks(keyed, [SEGMENT], POSITION, rows_per_chunk=rows_per_chunk)


def latest_at(
    recording: DataFrame,
    columns: Sequence[str],
    reference: str,
    *,
    clamp: bool = True,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """One row per row where ``reference`` has a value; every other column as of that row's time.

    The value is the last one stored at or before the time, so of several at the same
    time the one with the highest ordinal, even when it stands after the row. Rows
    before a column's first value take that first value unless ``clamp`` is False. The
    reference column keeps its own values. Adds ``frame_index`` and keeps the chunk
    number for later joins.
    """
    filled = [c for c in dict.fromkeys(columns) if c != reference]
    rows = index_reader(recording, [reference, *filled])
    chunks = plan_segments(recording, rows_per_chunk=rows_per_chunk)
    carry = _carry(rows, reference, filled, chunks) if chunks.split else None

    # Everything below needs one exchange and one sort by (segment, chunk, time, ordinal).
    in_order = Window.partitionBy(*chunks.partition).orderBy(TIME, ORDINAL)
    until_now = in_order.rowsBetween(Window.unboundedPreceding, 0)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same_time = Window.partitionBy(*chunks.partition, TIME).orderBy(ORDINAL)
    same_time = same_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    seen = [F.last(_q(c), ignorenulls=True).over(until_now).alias(f"_seen{i}") for i, c in enumerate(filled)]
    first = [F.first(_q(c), ignorenulls=True).over(whole).alias(f"_first{i}") for i, c in enumerate(filled)]
    counted = (F.sum(_q(reference).isNotNull().cast("long")).over(until_now) - 1).alias("frame_index")
    kept = [*chunks.partition, ORDINAL, TIME, _q(reference)]
    scanned = spread(rows, chunks).select(*kept, counted, *seen, *(first if clamp else []))
    latest = [F.last(f"_seen{i}").over(same_time).alias(f"_seen{i}") for i in range(len(filled))]
    heads = [f"_first{i}" for i in range(len(filled))] if clamp else []
    aligned = scanned.select(*kept, "frame_index", *heads, *latest).where(_q(reference).isNotNull())

    if carry is None:
        values = [
            F.coalesce(F.col(f"_seen{i}"), F.col(f"_first{i}")) if clamp else F.col(f"_seen{i}")
            for i in range(len(filled))
        ]
        index = F.col("frame_index")
    else:
        aligned = join_carry(aligned, carry, chunks)
        values = [_with_carry(i, clamp) for i in range(len(filled))]
        index = F.col("frame_index") + F.coalesce(F.col("_frames_before"), F.lit(0))
    named = {c: v.alias(c) for c, v in zip(filled, values, strict=True)}
    named[reference] = _q(reference)
    return aligned.select(
        SEGMENT, CHUNK, ORDINAL, TIME, index.alias("frame_index"), *[named[c] for c in dict.fromkeys([reference, *columns])]
    )


def _with_carry(i: int, clamp: bool) -> Column:
    # A tie that runs on into later chunks is decided there.
    tie = F.when(_q(TIME) == F.col("_max_time"), F.col(f"_tie{i}"))
    value = F.coalesce(tie, F.col(f"_seen{i}"), F.col(f"_before{i}"))
    if not clamp:
        return value
    return F.coalesce(value, F.col(f"_segment_first{i}"), F.col(f"_first{i}"))


def _carry(rows: DataFrame, reference: str, filled: Sequence[str], chunks: Chunks) -> DataFrame:
    """What each chunk of a large segment needs to know of the chunks around it."""
    aggregates = [
        F.max(TIME).alias("_max_time"),
        F.sum(_q(reference).isNotNull().cast("long")).alias("_frames"),
    ]
    for i, c in enumerate(filled):
        present = _q(c).isNotNull()
        back = F.struct(_q(TIME), (-_q(ORDINAL)).alias("_back"))
        aggregates += [
            F.max_by(_q(c), F.when(present, _position())).alias(f"_last{i}"),
            F.min_by(_q(c), F.when(present, _position())).alias(f"_first{i}"),
            # The earliest time with a value, and the last value stored at that time.
            F.min(F.when(present, _q(TIME))).alias(f"_head_time{i}"),
            F.min_by(_q(c), F.when(present, back)).alias(f"_head{i}"),
        ]
    summary = only_split_groups(rows, chunks).groupBy(*chunks.partition).agg(*aggregates)
    # One row per chunk; written once because it is read once per column below.
    summary = stage(summary, "chunk-summary")

    by_chunk = Window.partitionBy(SEGMENT).orderBy(CHUNK)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = summary.select(
        SEGMENT,
        CHUNK,
        "_max_time",
        F.sum("_frames").over(before).alias("_frames_before"),
        *[F.last(f"_last{i}", ignorenulls=True).over(before).alias(f"_before{i}") for i in range(len(filled))],
        *[F.first(f"_first{i}", ignorenulls=True).over(whole).alias(f"_segment_first{i}") for i in range(len(filled))],
    )
    for i in range(len(filled)):
        ties = summary.where(F.col(f"_head_time{i}").isNotNull())
        ties = ties.groupBy(SEGMENT, F.col(f"_head_time{i}").alias("_max_time")).agg(
            F.max(CHUNK).alias(f"_tie_chunk{i}"), F.max_by(f"_head{i}", CHUNK).alias(f"_tie{i}")
        )
        carry = carry.join(ties, [SEGMENT, "_max_time"], "left")
        later = F.col(f"_tie_chunk{i}") > F.col(CHUNK)
        carry = carry.withColumn(f"_tie{i}", F.when(later, F.col(f"_tie{i}"))).drop(f"_tie_chunk{i}")
    return carry


def latest_at_frames(
    targets: DataFrame,
    frames: DataFrame,
    keys: Sequence[str],
    *,
    clamp: bool = True,
    counted: DataFrame | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """For every target row the ordinal and time of the latest frame at or before its time.

    Both sides carry ``keys``, ``time_ns`` and ``ordinal`` (unique within a key). Targets
    before the first frame take the first one unless ``clamp`` is False; a key without
    frames gives null. ``counted`` holds the keys of all rows of both sides, if there is
    a cheaper way to them than through the two sides.
    """
    others = [c for c in targets.columns if c not in (*keys, TIME, ORDINAL)]
    hit = F.struct(_q(ORDINAL).alias("ordinal"), _q(TIME).alias("time_ns"))
    shown = frames.select(*keys, TIME, F.lit(0).alias("_side"), ORDINAL, hit.alias("_hit"))
    asked = targets.select(*keys, TIME, F.lit(1).alias("_side"), ORDINAL, *[_q(c) for c in others])
    both = shown.unionByName(asked, allowMissingColumns=True).where(_q(TIME).isNotNull())

    # Frames sort before targets of the same time, so no tie can reach past a row.
    chunks = plan_chunks(both, keys, [TIME, "_side", ORDINAL], counted=counted, rows_per_chunk=rows_per_chunk)
    order = Window.partitionBy(*chunks.partition).orderBy(TIME, "_side", ORDINAL)
    until_now = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = spread(both, chunks)
    rows = rows.withColumn("_seen", F.last("_hit", ignorenulls=True).over(until_now))
    if clamp:
        rows = rows.withColumn("_head", F.first("_hit", ignorenulls=True).over(whole))
    rows = rows.where(F.col("_side") == 1)
    found = F.coalesce(F.col("_seen"), F.col("_head")) if clamp else F.col("_seen")
    if chunks.split:
        at = F.when(F.col("_hit").isNotNull(), F.struct(TIME, "_side", ORDINAL))
        # Only frames are looked up again; chunks without any have a row of their own.
        held = only_split_groups(both.where(F.col("_side") == 0), chunks)
        ends = held.unionByName(chunk_numbers(chunks), allowMissingColumns=True).groupBy(*chunks.partition)
        ends = ends.agg(F.max_by("_hit", at).alias("_last"), F.min_by("_hit", at).alias("_first"))
        by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
        before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
        every = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carry = ends.select(
            *chunks.partition,
            F.last("_last", ignorenulls=True).over(before).alias("_before"),
            F.first("_first", ignorenulls=True).over(every).alias("_group_first"),
        )
        rows = join_carry(rows, carry, chunks)
        found = F.coalesce(F.col("_seen"), F.col("_before"))
        if clamp:
            found = F.coalesce(found, F.col("_group_first"), F.col("_head"))
    return rows.select(
        *keys,
        TIME,
        ORDINAL,
        *[_q(c) for c in others],
        found["ordinal"].alias("frame_ordinal"),
        found["time_ns"].alias("frame_time_ns"),
    )


def rebase(df: DataFrame, keys: Sequence[str], *, by_stored_order: bool = False) -> DataFrame:
    """Times minus the start of their group: its minimum, or the time of its first stored row."""
    start = F.min_by(TIME, ORDINAL) if by_stored_order else F.min(TIME)
    starts = df.where(_q(TIME).isNotNull()).groupBy(*keys).agg(start.alias("_start"))
    return df.join(starts, list(keys)).withColumn(TIME, _q(TIME) - F.col("_start")).drop("_start")


GRID_BLOCK = 65_536


def _grid_points(ranges: DataFrame, keys: Sequence[str], start: str, points: Column) -> DataFrame:
    """Numbers 0, 1, ... below ``points`` for every row, beside its ``start``.

    Long grids are made in blocks that are spread over the cluster before they are
    filled, so no row ever holds a whole grid.
    """
    sized = ranges.select(*keys, start, points.alias("_points"))
    last_block = F.call_function("div", F.col("_points") - F.lit(1), F.lit(GRID_BLOCK))
    blocks = sized.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    blocks = blocks.repartition(*keys, "_block")
    begin = F.col("_block") * F.lit(GRID_BLOCK)
    end = F.least(begin + F.lit(GRID_BLOCK), F.col("_points")) - F.lit(1)
    return blocks.withColumn("grid_index", F.explode(F.sequence(begin, end))).drop("_block", "_points")


def time_grid(ranges: DataFrame, fps: int, *, keys: Sequence[str] = (SEGMENT,)) -> DataFrame:
    """Half-open nanosecond grid from ``min_ns`` to ``max_ns`` of every row at ``fps``."""
    points = times.grid_size_ns(F.col("min_ns"), F.col("max_ns"), fps)
    step = F.lit(times.grid_step_ns(fps)).cast("long")
    numbered = _grid_points(ranges, keys, "min_ns", points)
    return numbered.select(*keys, "grid_index", (F.col("min_ns") + F.col("grid_index") * step).alias(TIME))


def time_grid_seconds(ranges: DataFrame, fps: int, *, keys: Sequence[str] = (SEGMENT,)) -> DataFrame:
    """The same grid from ``min_s`` to ``max_s`` in float seconds."""
    points = times.grid_size_seconds(F.col("min_s"), F.col("max_s"), fps)
    numbered = _grid_points(ranges, keys, "min_s", points)
    at = F.col("min_s") + F.col("grid_index") / F.lit(float(fps))
    return numbered.select(*keys, "grid_index", at.alias("time_s"))


GRID_MARK = "_grid"


def resample_fps(recording: DataFrame, columns: Sequence[str], fps: int, **options: object) -> DataFrame:
    """Every column at an even grid per segment, by latest-at."""
    wanted = list(dict.fromkeys(columns))
    rows = index_reader(recording, wanted)
    ranges = rows.groupBy(SEGMENT).agg(F.min(TIME).alias("min_ns"), F.max(TIME).alias("max_ns"))
    grid = time_grid(ranges, fps)
    # Grid rows take ordinals after all stored ones; only their uniqueness matters.
    grid = grid.select(
        SEGMENT, (F.lit(1 << 62) + F.col("grid_index")).alias(ORDINAL), TIME, F.col("grid_index").alias(GRID_MARK)
    )
    both = rows.unionByName(grid, allowMissingColumns=True)
    aligned = latest_at(both, [GRID_MARK, *wanted], GRID_MARK, **options)
    return aligned.drop(GRID_MARK, ORDINAL)
