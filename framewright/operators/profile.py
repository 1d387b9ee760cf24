"""What a recording holds: dimensions, ranges, features and faults per segment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.config import ConversionConfig
from framewright.functions import vectors
from framewright.operators.align import ORDINAL, SEGMENT, TIME
from framewright.operators.rates import source_fps
from framewright.operators.scans import ROWS_PER_CHUNK, plan_chunks, previous_value


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _position() -> Column:
    return F.struct(_q(TIME), _q(ORDINAL))


def dim_of(df: DataFrame, column: str) -> Column:
    """Flattened length of a value; null for null."""
    kind = df.schema[column].dataType
    return F.when(_q(column).isNotNull(), F.size(vectors.flatten_all(_q(column), kind)))


def first_non_null(df: DataFrame, column: str, keys: Sequence[str] = (SEGMENT,), order: Sequence[str] = (TIME, ORDINAL)) -> DataFrame:
    """First value of a column per group, in the given order; rows without a place in it do not count."""
    at = F.struct(*[_q(c) for c in order])
    placed = reduce(and_, [_q(c).isNotNull() for c in (column, *order)])
    return df.groupBy(*keys).agg(F.min_by(_q(column), F.when(placed, at)).alias(column))


def column_dim(recording: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per segment and column the flattened length of the first value with a time, and whether it can be a feature.

    Only lengths are aggregated, never the values.
    """
    measured = []
    for c in columns:
        kind = recording.schema[c].dataType
        flat = vectors.flatten_all(_q(c), kind)
        holes = F.exists(flat, lambda x: x.isNull())
        good = F.lit(vectors.castable_to_float32(kind))
        first = F.min_by(
            F.struct(F.size(flat).alias("dim"), (good & ~holes).alias("castable")),
            F.when(_q(c).isNotNull() & _q(TIME).isNotNull(), _position()),
        )
        measured.append(F.struct(F.lit(c).alias("column"), first.alias("first")))
    listed = recording.groupBy(SEGMENT).agg(F.array(*measured).alias("_all"))
    rows = listed.select(SEGMENT, F.explode("_all").alias("_one"))
    first = F.col("_one.first")
    return rows.select(
        SEGMENT,
        F.col("_one.column").alias("column"),
        F.when(first["castable"], first["dim"]).alias("dim"),
        F.when(first.isNull(), F.lit("no values"))
        .when(~first["castable"], F.lit("cannot be cast to float32"))
        .alias("error"),
    )


def dim_profile(recording: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per segment and column: smallest and largest dimension and the number of values."""
    dims = F.array(*[F.struct(F.lit(c).alias("column"), dim_of(recording, c).alias("dim")) for c in columns])
    long = recording.select(SEGMENT, F.explode(F.filter(dims, lambda d: d["dim"].isNotNull())).alias("_d"))
    return long.groupBy(SEGMENT, F.col("_d.column").alias("column")).agg(
        F.min("_d.dim").alias("min_dim"), F.max("_d.dim").alias("max_dim"), F.count(F.lit(1)).alias("values")
    )


def segment_profile(recording: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """One row per segment: output rows, time of the first and the columns without any value."""
    present = _q(reference).isNotNull() & _q(TIME).isNotNull()
    empty = [
        F.when(F.count(F.when(_q(TIME).isNotNull(), _q(c))) == 0, F.lit(c)) for c in columns
    ]
    return recording.groupBy(SEGMENT).agg(
        F.count(F.when(present, F.lit(1))).alias("length"),
        F.min(F.when(present, _q(TIME))).alias("start_ns"),
        F.max(F.when(present, _q(TIME))).alias("end_ns"),
        F.count(F.when(_q(TIME).isNull(), F.lit(1))).alias("rows_without_time"),
        F.array_compact(F.array(*empty)).alias("empty_columns"),
    )


def vector_feature(dims: DataFrame, columns: Sequence[str], names: Sequence[str] | None, feature: str) -> DataFrame:
    """One feature per segment from the dimensions of its columns, which are summed."""
    wanted = dims.where(F.col("column").isin(*columns))
    summed = wanted.groupBy(SEGMENT).agg(
        F.sum("dim").cast("long").alias("dim"),
        (F.count("dim") == len(set(columns))).alias("complete"),
    )
    fits = F.lit(True) if names is None else F.col("dim") == len(names)
    return summed.select(
        SEGMENT,
        F.lit(feature).alias("feature"),
        F.lit("float32").alias("dtype"),
        F.when(F.col("complete"), F.array(F.col("dim"))).alias("shape"),
        (F.lit(None).cast("array<string>") if names is None else F.array(*[F.lit(n) for n in names])).alias("names"),
        F.when(~F.col("complete"), F.lit(f"could not infer {feature} dimension"))
        .when(~fits, F.lit(f"{feature} names do not match the dimension"))
        .alias("error"),
    )


def infer_features(recording: DataFrame, config: ConversionConfig) -> DataFrame:
    """The action and state features each segment would give."""
    columns = list(dict.fromkeys([*config.action_columns, *config.state_columns]))
    dims = column_dim(recording, columns)
    action = vector_feature(dims, config.action_columns, config.action_names, "action")
    state = vector_feature(dims, config.state_columns, config.state_names, "observation.state")
    return action.unionByName(state)


def heads(log: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of every column of every segment by time, with their ``place`` from 0.

    ``log`` is in long form. Spark keeps that many rows of a column per task before it shuffles.
    """
    column = Window.partitionBy(SEGMENT, "entity_path", "component", "field").orderBy(TIME, ORDINAL)
    ranked = log.withColumn("_rank", F.row_number().over(column)).where(F.col("_rank") <= most)
    return ranked.withColumn("place", (F.col("_rank") - 1).cast("long")).drop("_rank")


def index_range(recording: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Range, row count and suggested rate of the timeline of every segment."""
    rows = recording.select(SEGMENT, ORDINAL, TIME).where(_q(TIME).isNotNull())
    ranges = rows.groupBy(SEGMENT).agg(
        F.min(TIME).alias("min_ns"), F.max(TIME).alias("max_ns"), F.count(F.lit(1)).alias("rows")
    )
    rates = source_fps(rows, [SEGMENT], [TIME, ORDINAL], rows_per_chunk=rows_per_chunk)
    return ranges.join(rates.select(SEGMENT, "source_fps"), [SEGMENT], "left").withColumn(
        "suggested_fps", F.greatest(F.round("source_fps"), F.lit(1.0)).cast("long")
    )


def is_sorted(recording: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Whether the stored order of a segment is already its time order."""
    rows = recording.select(SEGMENT, ORDINAL, TIME).where(_q(TIME).isNotNull())
    chunks = plan_chunks(rows, [SEGMENT], [ORDINAL], rows_per_chunk=rows_per_chunk)
    stepped = previous_value(rows, TIME, "_previous", chunks)
    back = F.coalesce(_q(TIME) < F.col("_previous"), F.lit(False))
    return stepped.groupBy(SEGMENT).agg((~F.bool_or(back)).alias("sorted"))
