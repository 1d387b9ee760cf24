"""From aligned rows to numbered frames, episodes, tasks and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.config import ConversionConfig
from framewright.functions import times, vectors
from framewright.operators.align import ORDINAL, SEGMENT, TIME, latest_at
from framewright.operators.scans import (
    CHUNK,
    ROWS_PER_CHUNK,
    number_all,
    number_rows,
    plan_chunks,
    totals_before,
)

ACTION, STATE, TASK = "action", "observation.state", "task"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def prepare(recording: DataFrame, config: ConversionConfig) -> DataFrame:
    """Segment, ordinal, the index as nanoseconds and the configured columns, nothing else."""
    time_ns = times.normalize_times(recording, config.index_column).alias(TIME)
    return recording.select(SEGMENT, ORDINAL, time_ns, *[_q(c) for c in config.scalar_columns])


def feature_vector(rows: DataFrame, columns: Sequence[str]) -> Column:
    parts = [vectors.float32_vector(_q(c), rows.schema[c].dataType) for c in columns]
    return vectors.concat_vectors(parts)


def build_episodes(recording: DataFrame, config: ConversionConfig, *, action_dim: int = -1, state_dim: int = -1) -> DataFrame:
    """Dense rows of all segments: action, state, task, numbered within their segment.

    ``error`` says why a row cannot be written; a segment with such a row is set aside
    as a whole by the caller.
    """
    rows = prepare(recording, config)
    aligned = latest_at(
        rows,
        config.scalar_columns,
        config.reference_column,
        clamp=config.clamp,
        rows_per_chunk=config.rows_per_chunk,
    )
    default = F.lit(config.task_default)
    task = vectors.task_text(_q(config.task), rows.schema[config.task].dataType, config.task_default) if config.task else default
    dense = aligned.select(
        SEGMENT,
        CHUNK,
        ORDINAL,
        TIME,
        "frame_index",
        feature_vector(rows, config.action_columns).alias(ACTION),
        feature_vector(rows, config.state_columns).alias(STATE),
        task.alias(TASK),
    )
    # All actions are checked before any state.
    action = vectors.vector_error(_q(ACTION), action_dim, "action")
    state = vectors.vector_error(_q(STATE), state_dim, "state")
    error = F.when(action.isNotNull(), F.struct(F.lit(0).alias("rank"), action.alias("reason"))).when(
        state.isNotNull(), F.struct(F.lit(1).alias("rank"), state.alias("reason"))
    )
    return dense.withColumn("error", error)


def segment_errors(frames: DataFrame, profile: DataFrame, config: ConversionConfig) -> DataFrame:
    """Segments to set aside, with the first reason."""
    needed = [c for c in dict.fromkeys([*config.action_columns, *config.state_columns])]
    wanted = F.array(*[F.lit(c) for c in needed])
    lacking = F.filter(wanted, lambda c: F.array_contains(F.col("empty_columns"), c))
    without = profile.where((F.col("length") > 0) & (F.size(lacking) > 0)).select(
        SEGMENT,
        F.struct(F.lit(-1).alias("rank"), F.lit(0).cast("long").alias("frame_index")).alias("at"),
        F.concat(F.lit("column '"), F.get(lacking, F.lit(0)), F.lit("' has no values in this segment")).alias("reason"),
    )
    faulty = frames.where(F.col("error").isNotNull()).select(
        SEGMENT,
        F.struct(F.col("error.rank").alias("rank"), F.col("frame_index")).alias("at"),
        F.col("error.reason").alias("reason"),
    )
    return without.unionByName(faulty).groupBy(SEGMENT).agg(F.min_by("reason", "at").alias("reason"))


def segment_status(profile: DataFrame, errors: DataFrame) -> DataFrame:
    """Every segment with what becomes of it: converted, empty, skipped or failed.

    A segment is skipped when its ``size_bytes`` is known to be 0.
    """
    known = F.col("size_bytes") if "size_bytes" in profile.columns else F.lit(None).cast("long")
    status = (
        F.when(known == 0, "skipped")
        .when(F.col("reason").isNotNull(), "failed")
        .when(F.col("length") == 0, "empty")
        .otherwise("converted")
    )
    return profile.join(errors, [SEGMENT], "left").withColumn("status", status)


def number_episodes(status: DataFrame, order: Sequence[str], *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Episode numbers and frame offsets of the segments that are written.

    Works on the segment table; frames are never sorted as a whole.
    """
    written = status.where(F.col("status") == "converted")
    before = {"episode_index": F.lit(1).cast("long"), "dataset_from_index": F.col("length")}
    numbered = totals_before(written, order, before, rows_per_chunk=rows_per_chunk)
    return numbered.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col("length"))


def episode_task_rows(frames: DataFrame) -> DataFrame:
    """Distinct tasks of each segment (and chunk) with the frame that names them first."""
    return frames.groupBy(SEGMENT, CHUNK, TASK).agg(F.min("frame_index").alias("first_frame"))


def episode_tasks(task_rows: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Tasks of each segment with their place in the order in which they appear.

    One row per task: a segment may name a new task at every frame, so the list of a
    segment is never gathered into one value.
    """
    distinct = task_rows.groupBy(SEGMENT, TASK).agg(F.min("first_frame").alias("first_frame"))
    chunks = plan_chunks(distinct, [SEGMENT], ["first_frame"], rows_per_chunk=rows_per_chunk)
    return number_rows(distinct, "position", chunks).select(SEGMENT, "position", "first_frame", TASK)


def number_tasks(task_rows: DataFrame, episodes: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Dense number of every distinct task, by its first frame in the dataset."""
    placed = task_rows.join(episodes.select(SEGMENT, "dataset_from_index"), [SEGMENT])
    first = placed.groupBy(TASK).agg(F.min(F.col("dataset_from_index") + F.col("first_frame")).alias("first_index"))
    return number_all(first, ["first_index"], "task_index", rows_per_chunk=rows_per_chunk)


def number_frames(
    frames: DataFrame, task_rows: DataFrame, episodes: DataFrame, tasks: DataFrame, config: ConversionConfig
) -> DataFrame:
    """Attach all numbers to the frames with one join.

    Episode and task numbers meet in a table with one row per (segment, chunk, task).
    Its keys never cover more frames than a chunk holds, so neither a long segment nor
    a task that most frames share gathers in one task.
    """
    labels = task_rows.select(SEGMENT, CHUNK, TASK)
    labels = labels.join(episodes.select(SEGMENT, "episode_index", "dataset_from_index", "start_ns"), [SEGMENT])
    labels = labels.join(tasks.select(TASK, "task_index"), [TASK])
    rows = frames.join(labels, [SEGMENT, CHUNK, TASK])
    elapsed = times.elapsed_seconds(F.col(TIME), F.col("start_ns"))
    timestamp = elapsed if config.timestamps == "elapsed" else times.nominal_seconds(F.col("frame_index"), config.fps)
    return rows.select(
        (F.col("dataset_from_index") + F.col("frame_index")).alias("index"),
        "episode_index",
        "frame_index",
        "task_index",
        timestamp.alias("timestamp"),
        TIME,
        _q(ACTION),
        _q(STATE),
        TASK,
    )


VECTOR_FEATURES = (ACTION, STATE)
SCALAR_FEATURES = ("timestamp", "frame_index", "episode_index", "index", "task_index")


def episode_stats(
    frames: DataFrame,
    *,
    keys: Sequence[str] = ("episode_index",),
    vector_features: Sequence[str] = VECTOR_FEATURES,
    scalar_features: Sequence[str] = SCALAR_FEATURES,
) -> DataFrame:
    """min, max, mean, population deviation and count per episode, feature and position.

    Every feature becomes (feature, position, value) rows that are combined before the
    shuffle, so what moves is one row per episode, feature and position of each task.
    """

    def entry(name: str, pos: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("feature"), pos.alias("pos"), value.cast("double").alias("value"))

    def positions(name: str) -> Column:
        return F.transform(_q(name), lambda x, i: entry(name, i, x))

    entries = [positions(c) for c in vector_features]
    scalars = [entry(c, F.lit(0), _q(c)) for c in scalar_features]
    all_entries = F.concat(*entries, F.array(*scalars)) if scalars else F.concat(*entries)
    long = frames.select(*keys, F.explode(all_entries).alias("_e")).select(*keys, "_e.*")
    return long.groupBy(*keys, "feature", "pos").agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.count("value").alias("count"),
    )


def pack_stats(stats: DataFrame, keys: Sequence[str] = ("episode_index",)) -> DataFrame:
    """Statistics as one array per episode and feature, in position order."""
    fields = ("min", "max", "mean", "std", "count")
    ordered = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    packed = stats.groupBy(*keys, "feature").agg(ordered.alias("_s"))

    def values(name: str) -> Column:
        return F.transform("_s", lambda s: s[name]).alias(name)

    return packed.select(*keys, "feature", *[values(f) for f in fields])


def dataset_stats(stats: DataFrame) -> DataFrame:
    """Totals over all episodes, merged from the episode statistics without reading frames again."""
    weight = F.col("count").cast("double")
    means = stats.groupBy("feature", "pos").agg((F.sum(F.col("mean") * weight) / F.sum(weight)).alias("_mean"))
    spread = weight * (F.col("std") * F.col("std") + (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean")))
    return stats.join(means, ["feature", "pos"]).groupBy("feature", "pos").agg(
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.first("_mean").alias("mean"),
        F.sqrt(F.sum(spread) / F.sum(weight)).alias("std"),
        F.sum("count").alias("count"),
    )


def conversion_summary(status: DataFrame) -> DataFrame:
    """Episodes, frames and segments left out, as one row."""

    def how_many(kind: str) -> Column:
        return F.count(F.when(F.col("status") == kind, F.lit(1)))

    frames = F.coalesce(F.sum(F.when(F.col("status") == "converted", F.col("length"))), F.lit(0))
    return status.agg(
        how_many("converted").alias("episodes"),
        frames.cast("long").alias("frames"),
        how_many("empty").alias("empty"),
        (how_many("skipped") + how_many("failed")).alias("skipped"),
    )
