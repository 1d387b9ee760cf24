"""The driver's tables as recordings, in Spark and as the same text in SQL, and the query register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright import ConversionConfig, configure
from framewright.functions import times
from framewright.operators.align import ORDINAL, SEGMENT, TIME

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{table}.parquet")


def q(name: str) -> Column:
    return F.col(f"`{name}`")


A = "/robot/action:Scalars:scalars"
S = "/robot/state:Scalars:scalars"
G = "/robot/gripper:Scalars:scalars"
T = "/task:TextDocument:text"

CONFIG = ConversionConfig(fps=10, index_column="time_ns", action=A, state=[S, G], task=T, task_default="idle")


def k_of(props: Column) -> Column:
    return F.regexp_extract(props, "([0-9]+)", 1).cast("double")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """events with a segment, an ordinal and nanosecond times."""
    df = load(spark, sf, "events")
    return df.select(
        F.col("user_id").cast("string").alias(SEGMENT),
        F.col("event_id").alias(ORDINAL),
        times.normalize_times(df, "ts").alias(TIME),
        "event_type",
        "value",
        "props",
        k_of(F.col("props")).alias("k"),
    )


def recording(spark: SparkSession, sf: str, *, day: bool = False, faults: bool = False) -> DataFrame:
    """Wide sparse recording: one column per kind of event.

    ``day`` cuts the times to days, which makes many rows share a time. ``faults`` gives
    some state vectors a second value.
    """
    df = events(spark, sf)
    if day:
        df = df.withColumn(TIME, F.col(TIME) - F.pmod(F.col(TIME), F.lit(86_400_000_000_000)))
    kind, value, k = F.col("event_type"), F.col("value"), F.col("k")
    state = F.array(value)
    if faults:
        state = F.when(k >= 99, F.array(value, k)).otherwise(state)
    nested = "array<array<float>>"
    return df.select(
        SEGMENT,
        ORDINAL,
        TIME,
        F.when(kind == "click", F.array(F.array(value, k))).cast(nested).alias(A),
        F.when(kind == "view", state).cast("array<float>").alias(S),
        F.when(kind == "purchase", F.array(F.array(value, k))).cast(nested).alias(G),
        F.when(kind == "signup", F.array(F.concat(F.lit("goal "), k.cast("int").cast("string")))).alias(T),
    )


def centi(vector: Column) -> Column:
    """A vector as text in hundredths, which compares exactly."""

    def one(x: Column) -> Column:
        return F.when(F.isnan(x), F.lit("NaN")).otherwise(F.round(F.nanvl(x, F.lit(0.0)).cast("double") * 100).cast("long").cast("string"))

    return F.array_join(F.transform(vector, one), ",")


def centi_sql(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: cast(cast(round(x*100) as bigint) as varchar)), ',')"


EV = """ev as (select cast(user_id as varchar) segment_id, event_id ordinal, epoch_us(ts)*1000 time_ns, event_type, value, props,
 cast(regexp_extract(props, '[0-9]+') as double) k from events)"""


def rec_sql(*, day: bool = False, faults: bool = False) -> str:
    at = "time_ns - time_ns % 86400000000000" if day else "time_ns"
    state = "case when k >= 99 then [value, k] else [value] end" if faults else "[value]"
    return f"""{EV}, rec as (select segment_id, ordinal, {at} time_ns,
 case when event_type='click' then [value, k] end a, case when event_type='view' then {state} end s,
 case when event_type='purchase' then [value, k] end g,
 case when event_type='signup' then 'goal ' || cast(cast(k as int) as varchar) end t from ev)"""


def latest_sql(column: str, *, clamp: bool = True) -> str:
    over = "partition by segment_id order by time_ns range between unbounded preceding and current row"
    key = "{'t': time_ns, 'o': ordinal}"
    latest = f"arg_max({column}, {key}) filter ({column} is not null) over ({over})"
    if not clamp:
        return latest
    return f"coalesce({latest}, arg_min({column}, {key}) filter ({column} is not null) over (partition by segment_id))"


def frames_sql(*, day: bool = False, faults: bool = False, clamp: bool = True, tail: str = "") -> str:
    """WITH clause that ends in ``fr``: aligned and numbered rows of all segments."""
    filled = ", ".join(f"{latest_sql(c, clamp=clamp)} {c}" for c in "sgt")
    return f"""with {rec_sql(day=day, faults=faults)},
al as (select * from (select segment_id, ordinal, time_ns, a, {filled} from rec) where a is not null),
fr as (select *, row_number() over (partition by segment_id order by time_ns, ordinal) - 1 frame_index,
 coalesce(t, 'idle') task, list_concat(s, g) state from al){tail}"""


# Frames of a dataset: faulty segments left out, numbered over the whole dataset.
DATASET_TAIL = """,
bad as (select segment_id from fr group by segment_id having bool_or(len(a) <> 2) or bool_or(state is null) or bool_or(len(state) <> 3)),
ok as (select * from fr where segment_id not in (select segment_id from bad)),
lens as (select segment_id, count(*) n, min(time_ns) start_ns from ok group by segment_id),
epi as (select segment_id, n, start_ns, row_number() over (order by segment_id) - 1 episode_index,
 coalesce(sum(n) over (order by segment_id rows between unbounded preceding and 1 preceding), 0) from_index from lens),
tk as (select task, row_number() over (order by min(from_index + frame_index)) - 1 task_index
 from ok join epi using (segment_id) group by task),
ds as (select cast(from_index + frame_index as bigint) idx, episode_index, frame_index, task_index, time_ns, start_ns, a, state, task, segment_id
 from ok join epi using (segment_id) join tk using (task))"""
