"""Sample rates of cameras and whether their packets can be copied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.operators.align import ORDINAL, TIME
from framewright.operators.scans import CHUNK, ROWS_PER_CHUNK, Chunks, plan_chunks, previous_value, with_chunk
from framewright.session import stage


def sample_interval(
    samples: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (ORDINAL,),
    *,
    chunks: Chunks | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Time since the sample before, in stored order unless another order is given."""
    chunks = chunks or plan_chunks(samples, keys, order, rows_per_chunk=rows_per_chunk)
    stepped = previous_value(samples, TIME, "_previous", chunks)
    return stepped.withColumn("interval_ns", F.col(TIME) - F.col("_previous")).drop("_previous")


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    *,
    small_groups: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Exact median per group; equal values are counted before anything is shuffled.

    The counted values of a large group are cut into chunks like any ordered scan, so
    no task needs all distinct values of a group. ``small_groups`` says that no group
    has more than ``rows_per_chunk`` rows, which saves looking again.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    chunks = Chunks(tuple(keys), (value,))
    if not small_groups:
        counted = stage(counted, "counted")
        chunks = plan_chunks(counted, keys, [value], rows_per_chunk=rows_per_chunk)

    group = Window.partitionBy(*keys)
    low = F.call_function("div", F.col("_total") + F.lit(1), F.lit(2))
    high = F.call_function("div", F.col("_total") + F.lit(2), F.lit(2))
    if chunks.split:
        # One row per chunk tells which one or two chunks the middle lies in; only those are scanned.
        marked = with_chunk(counted, chunks)
        sums = marked.groupBy(*chunks.partition).agg(F.sum("_n").alias("_sum"))
        earlier = group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        placed = sums.select(
            *chunks.partition,
            "_sum",
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_sum").over(group).alias("_total"),
        )
        placed = placed.where((F.col("_before") < high) & (F.col("_before") + F.col("_sum") >= low)).drop("_sum")
        rows = marked.join(placed, chunks.partition)
    else:
        rows = counted.withColumn(CHUNK, F.lit(0)).withColumn("_before", F.lit(0))
        rows = rows.withColumn("_total", F.sum("_n").over(group))
    until_now = Window.partitionBy(*chunks.partition).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum("_n").over(until_now)
    ranked = rows.withColumn("_upto", upto)
    first = F.col("_upto") - F.col("_n")
    middle = ranked.where((F.col("_upto") >= low) & (first < low) | (F.col("_upto") >= high) & (first < high))
    # One or two rows per group are left.
    return middle.groupBy(*keys).agg(((F.min(value) + F.max(value)) / F.lit(2.0)).alias(name))


def source_fps(
    samples: DataFrame, keys: Sequence[str], order: Sequence[str] = (ORDINAL,), *, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Rate per group from the median interval; 0.0 for fewer than two samples or a zero median."""
    columns = dict.fromkeys([*keys, ORDINAL, TIME])
    samples = samples.select(*columns)
    chunks = plan_chunks(samples, keys, order, rows_per_chunk=rows_per_chunk)
    steps = sample_interval(samples, keys, order, chunks=chunks)
    medians = exact_median(
        steps, keys, "interval_ns", "median_ns", small_groups=not chunks.split, rows_per_chunk=rows_per_chunk
    )
    counts = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"))
    rate = F.when(F.col("median_ns") != 0, F.lit(1e9) / F.col("median_ns"))
    return counts.join(medians, list(keys), "left").withColumn("source_fps", F.coalesce(rate, F.lit(0.0)))


def copy_decision(rate: Column, samples: Column, fps: int, tolerance: float = 0.05) -> Column:
    """Whether a source rate is near enough to the target to copy packets."""
    near = F.abs(rate - F.lit(float(fps))) / F.lit(float(fps)) <= F.lit(tolerance)
    return (samples >= 2) & (rate != 0) & near


def episode_video_plan(rates: DataFrame, resolved: DataFrame, fps: int, *, segment: str = "segment_id") -> DataFrame:
    """Per episode and camera: copy packets, encode again or store images.

    ``resolved`` holds one row per camera of the configuration. ``copy_all`` marks
    episodes in which no frame has to be decoded at all.
    """
    everyone = Window.partitionBy(F.lit(0))
    cameras = resolved.select(
        "camera_key", "can_copy", "output_format", "feature_dtype", F.count(F.lit(1)).over(everyone).alias("_cameras")
    )
    rows = rates.join(cameras, ["camera_key"])
    rows = rows.withColumn("copies", F.col("can_copy") & copy_decision(F.col("source_fps"), F.col("samples"), fps))
    mode = F.when(F.col("copies"), "copy").when(F.col("feature_dtype") == "image", "image").otherwise("encode")
    # An episode must hold every camera of the configuration to be copied as a whole.
    episode = Window.partitionBy(segment)
    held = F.count(F.lit(1)).over(episode)
    whole = F.bool_and("copies").over(episode) & (held == F.col("_cameras"))
    return rows.select(
        segment, "camera_key", "samples", "source_fps", "output_format", mode.alias("mode"), whole.alias("copy_all")
    )
