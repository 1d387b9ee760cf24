"""Dimensions, faults, numbering, statistics and the whole conversion."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import A, CONFIG, EV, G, S, q, query
from framewright.functions import times, vectors
from framewright.operators import episodes as ep
from framewright.operators import profile, rates
from framewright.operators.align import ORDINAL, SEGMENT, TIME
from framewright.operators.scans import CHUNK
from framewright.plans import convert
from framewright.session import scratch_path, stage
from framewright.sources import sinks

FRAME_COLUMNS = f"segment_id, ordinal, time_ns, frame_index, {t.centi_sql('a')} action, {t.centi_sql('state')} state, task"


def frames(spark: SparkSession, sf: str, *, faults: bool = False, **changes: object) -> DataFrame:
    config = dataclasses.replace(CONFIG, **changes)
    return ep.build_episodes(t.recording(spark, sf, faults=faults), config, action_dim=2, state_dim=3)


def shown(dense: DataFrame) -> DataFrame:
    return dense.select(
        SEGMENT, ORDINAL, TIME, "frame_index", t.centi(q("action")).alias("action"), t.centi(q("observation.state")).alias("state"), "task"
    )


@query(f"{t.frames_sql()} select {FRAME_COLUMNS} from fr")
def build_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return shown(frames(spark, sf))


@query(f"{t.frames_sql()} select {FRAME_COLUMNS} from fr")
def build_episodes_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows when every segment is cut into chunks."""
    return shown(frames(spark, sf, rows_per_chunk=24))


def milli(column: str) -> Column:
    return F.round(F.col(column).cast("double") * 1000).cast("long")


VEC = "vec as (select cast(label as varchar) segment_id, vec_id ordinal, embedding from embeddings)"


def vectors_recording(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings as a recording on a sequence timeline: one segment per label, vectors of 64."""
    return t.load(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias(SEGMENT),
        F.col("vec_id").alias(ORDINAL),
        F.col("vec_id").alias(TIME),
        F.col("embedding").alias("v"),
    )


@query(
    f"""with {t.rec_sql(faults=True)}, x as (select segment_id, ordinal, time_ns, a, case when s is not null then case when s[1] > 30 then
 list_transform(s, lambda x: null::double) else s end end s from rec),
 f as (select segment_id, arg_min(a, {{'t': time_ns,'o': ordinal}}) filter (a is not null) a,
 arg_min(s, {{'t': time_ns,'o': ordinal}}) filter (s is not null) s from x group by segment_id)
 select segment_id, 'action' col, cast(len(a) as int) dim, null error from f union all
 select segment_id, 'state', case when s[1] is not null then cast(len(s) as int) end,
 case when s[1] is null then 'cannot be cast to float32' end from f"""
)
def column_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension of the first value; a hole in it is a fault."""
    rows = t.recording(spark, sf, faults=True)
    holed = F.when(F.get(q(S), F.lit(0)) > 30, F.transform(q(S), lambda _: F.lit(None).cast("float"))).otherwise(q(S))
    dims = profile.column_dim(rows.withColumn(S, holed), [A, S])
    short = F.when(F.col("column") == A, "action").otherwise("state")
    return dims.select(SEGMENT, short.alias("col"), "dim", "error")


@query(
    f"""with {t.rec_sql(faults=True)}, l as (select segment_id, 'action' col, len(a) d from rec where a is not null union all
 select segment_id, 'state', len(s) from rec where s is not null union all select segment_id, 'gripper', len(g) from rec where g is not null)
 select segment_id, col, cast(min(d) as int) min_dim, cast(max(d) as int) max_dim, count(*) "values" from l group by segment_id, col"""
)
def dim_profile(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.dim_profile(t.recording(spark, sf, faults=True), [A, S, G])
    short = F.when(F.col("column") == A, "action").when(F.col("column") == S, "state").otherwise("gripper")
    return found.select(SEGMENT, short.alias("col"), "min_dim", "max_dim", "values")


@query(
    f"""with {t.rec_sql()}, p as (select segment_id, count(a) n, min(time_ns) filter (a is not null) lo, max(time_ns) filter (a is not null) hi,
 count(*) filter (s[1] > 80) r from rec group by segment_id)
 select segment_id, n length, lo start_ns, hi end_ns, case when r = 0 then 'rare' else '' end empty_columns from p"""
)
def segment_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.recording(spark, sf).withColumn("rare", F.when(F.get(q(S), F.lit(0)) > 80, q(S)))
    found = profile.segment_profile(rows, [A, "rare"], A)
    return found.select(SEGMENT, "length", "start_ns", "end_ns", F.array_join("empty_columns", ",").alias("empty_columns"))


FIRST_DIMS = f"""with {t.rec_sql(faults=True)}, f as (select segment_id, arg_min(a, {{'t': time_ns,'o': ordinal}}) filter (a is not null) a,
 arg_min(s, {{'t': time_ns,'o': ordinal}}) filter (s is not null) s,
 arg_min(g, {{'t': time_ns,'o': ordinal}}) filter (g is not null) g from rec group by segment_id)"""


@query(
    f"""{FIRST_DIMS} select segment_id, 'observation.state' feature, 'float32' dtype, cast(len(s)+len(g) as bigint) dim,
 case when len(s)+len(g) <> 3 then 'observation.state names do not match the dimension' end error from f"""
)
def vector_feature(spark: SparkSession, sf: str) -> DataFrame:
    dims = profile.column_dim(t.recording(spark, sf, faults=True), [S, G])
    feature = profile.vector_feature(dims, [S, G], ["x", "y", "z"], "observation.state")
    return feature.select(SEGMENT, "feature", "dtype", F.get("shape", F.lit(0)).alias("dim"), "error")


@query(
    f"""{FIRST_DIMS} select segment_id, 'action' feature, 'float32' dtype, cast(len(a) as bigint) dim, cast(null as varchar) error from f union all
 select segment_id, 'observation.state', 'float32', cast(len(s)+len(g) as bigint), cast(null as varchar) from f"""
)
def infer_features(spark: SparkSession, sf: str) -> DataFrame:
    feature = profile.infer_features(t.recording(spark, sf, faults=True), CONFIG)
    return feature.select(SEGMENT, "feature", "dtype", F.get("shape", F.lit(0)).alias("dim"), "error")


@query("select cast(label as varchar) segment_id, vec_id ordinal, cast(round(sum(x)*1000) as bigint) total, count(*) dims from (select label, vec_id, unnest(embedding) x from embeddings) group by 1, 2")
def float32_vector(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors_recording(spark, sf)
    vector = vectors.float32_vector(F.col("v"), rows.schema["v"].dataType)
    total = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select(SEGMENT, ORDINAL, F.round(total * 1000).cast("long").alias("total"), F.size(vector).cast("long").alias("dims"))


@query(f"with {EV} select segment_id, ordinal, {t.centi_sql('[value, k, k, value]')} joined from ev")
def concat_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of different depth and type in one vector, in the given order."""
    rows = t.events(spark, sf).select(
        SEGMENT, ORDINAL, F.array(F.array("value", "k")).alias("nested"), F.col("k").cast("int").alias("single"), F.array("value").alias("flat")
    )
    return rows.select(SEGMENT, ORDINAL, t.centi(ep.feature_vector(rows, ["nested", "single", "flat"])).alias("joined"))


@query(
    f"""{t.frames_sql(faults=True)} select segment_id, frame_index, 'state has dim 4 but expected 3' reason from fr where len(state) <> 3"""
)
def vector_dim_check(spark: SparkSession, sf: str) -> DataFrame:
    bad = frames(spark, sf, faults=True).where("error is not null")
    return bad.select(SEGMENT, "frame_index", "error.reason")


def _status(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.recording(spark, sf, faults=True)
    held = profile.segment_profile(rows, CONFIG.scalar_columns, CONFIG.reference_column)
    return ep.segment_status(held, ep.segment_errors(frames(spark, sf, faults=True), held, CONFIG))


FAULTY = t.frames_sql(faults=True, tail=t.DATASET_TAIL)


@query(
    f"""{FAULTY} select segment_id, count(*) length, case when bool_or(len(state) <> 3) then 'failed' else 'converted' end status,
 case when bool_or(len(state) <> 3) then 'state has dim 4 but expected 3' end reason from fr group by segment_id"""
)
def quarantine_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf).select(SEGMENT, "length", "status", "reason")


@query(
    f"""{FAULTY} select (select count(*) from epi) episodes, (select count(*) from ok) frames, cast(0 as bigint) empty,
 (select count(*) from bad) skipped"""
)
def conversion_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ep.conversion_summary(_status(spark, sf))


@query(
    f"{FAULTY} select segment_id, episode_index, n length, cast(from_index as bigint) dataset_from_index, cast(from_index + n as bigint) dataset_to_index from epi"
)
def episode_index(spark: SparkSession, sf: str) -> DataFrame:
    numbered = ep.number_episodes(_status(spark, sf), [SEGMENT])
    return numbered.select(SEGMENT, "episode_index", "length", "dataset_from_index", "dataset_to_index")


@query(f"{t.frames_sql(day=True)} select segment_id, ordinal, frame_index from fr")
def frame_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.recording(spark, sf, day=True)
    return ep.build_episodes(rows, CONFIG).select(SEGMENT, ORDINAL, "frame_index")


@query(
    f"""{t.frames_sql()} select segment_id, frame_index, cast(round((time_ns - min(time_ns) over (partition by segment_id)) / 1e9) as bigint) elapsed_s,
 frame_index * 100 nominal_ms from fr"""
)
def elapsed_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """Time since the first row, and the evenly spaced time; whole seconds and milliseconds, since single precision holds no more."""
    dense = frames(spark, sf)
    starts = dense.groupBy(SEGMENT).agg(F.min(TIME).alias("start_ns"))
    rows = dense.join(starts, [SEGMENT])
    elapsed = (F.col(TIME) - F.col("start_ns")) / F.lit(1e9)
    single = times.elapsed_seconds(F.col(TIME), F.col("start_ns"))
    near = F.abs(single.cast("double") - elapsed) <= F.abs(elapsed) * 1e-6
    nominal = times.nominal_seconds(F.col("frame_index"), CONFIG.fps)
    return rows.select(
        SEGMENT,
        "frame_index",
        F.when(near, F.round(elapsed)).cast("long").alias("elapsed_s"),
        F.round(nominal.cast("double") * 1000).cast("long").alias("nominal_ms"),
    )


@query(f"with {t.rec_sql()} select segment_id, (row_number() over (partition by segment_id order by time_ns, ordinal) - 1) frame_index, (row_number() over (partition by segment_id order by time_ns, ordinal) - 1) * 100 nominal_ms from rec where a is not null")
def nominal_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    dense = frames(spark, sf)
    nominal = times.nominal_seconds(F.col("frame_index"), CONFIG.fps)
    return dense.select(SEGMENT, "frame_index", F.round(nominal.cast("double") * 1000).cast("long").alias("nominal_ms"))


@query(f"with {EV} select segment_id, ordinal, time_ns - lag(time_ns) over (partition by segment_id order by ordinal) interval_ns from ev")
def sample_interval(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.events(spark, sf).select(SEGMENT, ORDINAL, TIME)
    return rates.sample_interval(rows, [SEGMENT]).select(SEGMENT, ORDINAL, "interval_ns")


# Some rows of this recording are stored long after their time.
@query(
    f"""with {EV}, o as (select segment_id, time_ns, ordinal + case when k >= 99 then 1000000000 else 0 end ordinal from ev),
 s as (select segment_id, time_ns < lag(time_ns) over (partition by segment_id order by ordinal) back from o)
 select segment_id, not bool_or(coalesce(back, false)) sorted from s group by segment_id"""
)
def is_sorted_check(spark: SparkSession, sf: str) -> DataFrame:
    stored = F.col(ORDINAL) + F.when(F.col("k") >= 99, F.lit(1_000_000_000)).otherwise(0)
    return profile.is_sorted(t.events(spark, sf).withColumn(ORDINAL, stored))


@query(
    f"""with {EV}, i as (select segment_id, time_ns, time_ns - lag(time_ns) over (partition by segment_id order by time_ns, ordinal) d from ev)
 select segment_id, min(time_ns) min_ns, max(time_ns) max_ns, count(*) "rows", round(1e9/median(d)*1e6, 6) micro_fps,
 cast(greatest(round(1e9/median(d)), 1) as bigint) suggested_fps from i group by segment_id"""
)
def index_range(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.index_range(t.events(spark, sf))
    return found.select(SEGMENT, "min_ns", "max_ns", "rows", F.round(F.col("source_fps") * 1e6, 6).alias("micro_fps"), "suggested_fps")


TALK = "talk as (select cast(conv_id as varchar) segment_id, turn, role, text from conversations)"


def talks(spark: SparkSession, sf: str) -> DataFrame:
    return t.load(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias(SEGMENT), F.col("turn").alias("frame_index"), F.col("role").alias("task"), F.lit(0).alias(CHUNK), "text"
    )


@query(f"with {TALK}, f as (select segment_id, role, min(turn) t from talk group by 1, 2) select segment_id, row_number() over (partition by segment_id order by t) - 1 position, t first_frame, role task from f")
def episode_tasks(spark: SparkSession, sf: str) -> DataFrame:
    return ep.episode_tasks(ep.episode_task_rows(talks(spark, sf)))


TASKS = f"""with {TALK}, n as (select segment_id, count(*) n, row_number() over (order by segment_id) - 1 e from talk group by 1),
 o as (select segment_id, coalesce(sum(n) over (order by e rows between unbounded preceding and 1 preceding), 0) f from n)"""


def _talk_episodes(rows: DataFrame) -> DataFrame:
    lengths = rows.groupBy(SEGMENT).agg(F.count("*").alias("length")).withColumn("status", F.lit("converted"))
    return ep.number_episodes(lengths, [SEGMENT])


@query(
    f"""{TASKS}, f as (select text task, cast(min(f + turn) as bigint) first_index from talk join o using (segment_id) group by text)
 select task, first_index, row_number() over (order by first_index) - 1 task_index from f"""
)
def task_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of the conversations as a task: nearly as many tasks as rows."""
    rows = talks(spark, sf).withColumn("task", F.col("text"))
    return ep.number_tasks(ep.episode_task_rows(rows), _talk_episodes(rows))


@query(f"{TASKS} select segment_id, turn frame_index, cast(f + turn as bigint) idx from talk join o using (segment_id)")
def global_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = talks(spark, sf)
    placed = rows.join(_talk_episodes(rows), [SEGMENT])
    return placed.select(SEGMENT, "frame_index", (F.col("dataset_from_index") + F.col("frame_index")).alias("idx"))


@query(
    f"""with {TALK} select segment_id, turn frame_index, coalesce(case when role='system' then role || ' ' || cast(turn as varchar)
 when role='user' then text end, 'none') task from talk"""
)
def task_text(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of two texts, single texts as bytes, and missing ones."""
    rows = talks(spark, sf)
    two = F.when(F.col("task") == "system", F.array("task", F.col("frame_index").cast("string")))
    one = F.when(F.col("task") == "user", F.array(F.encode("text", "UTF-8")))
    rows = rows.select(SEGMENT, "frame_index", two.alias("two"), one.alias("one"))
    joined = vectors.task_text(F.col("two"), rows.schema["two"].dataType, "")
    decoded = vectors.task_text(F.col("one"), rows.schema["one"].dataType, "none")
    return rows.select(SEGMENT, "frame_index", F.coalesce(F.nullif(joined, F.lit("")), decoded).alias("task"))


@query(f"with {TALK} select segment_id, turn frame_index, case when role <> 'system' then text end single, len(case when role='system' then [role, text] else [text] end) parts from talk")
def unwrap_singleton(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("task") == "system", F.array("task", "text")).otherwise(F.array("text"))
    return talks(spark, sf).select(SEGMENT, "frame_index", vectors.unwrap_singleton(value).alias("single"), F.size(value).cast("long").alias("parts"))


def stats_row(stats: DataFrame, *keys: str) -> DataFrame:
    return stats.select(
        *keys, "feature", "pos", *[F.round(c, 5).alias(c) for c in ("min", "max", "mean", "std")], "count"
    )


ROUNDED = 'round(min(x), 5) "min", round(max(x), 5) "max", round(avg(x), 5) mean, round(stddev_pop(x), 5) std, count(*) "count"'
VECTOR_ENTRIES = f"""with {VEC}, e as (select segment_id, cast(unnest(embedding) as double) x, generate_subscripts(embedding, 1) - 1 p from vec)"""


@query(f"{VECTOR_ENTRIES} select segment_id, 'v' feature, cast(p as int) pos, {ROUNDED} from e group by segment_id, p")
def episode_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = ep.episode_stats(vectors_recording(spark, sf), keys=[SEGMENT], vector_features=["v"], scalar_features=[])
    return stats_row(stats, SEGMENT)


@query(f"{VECTOR_ENTRIES} select 'v' feature, cast(p as int) pos, {ROUNDED} from e group by p")
def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = ep.episode_stats(vectors_recording(spark, sf), keys=[SEGMENT], vector_features=["v"], scalar_features=[])
    return stats_row(ep.dataset_stats(stats))


DATASET = FAULTY


def converted(spark: SparkSession, sf: str, **changes: object) -> convert.Dataset:
    return convert.convert_dataset(t.recording(spark, sf, faults=True), dataclasses.replace(CONFIG, **changes))


def numbered(dataset_frames: DataFrame) -> DataFrame:
    return dataset_frames.select(
        F.col("index").alias("idx"),
        "episode_index",
        "frame_index",
        "task_index",
        TIME,
        t.centi(q("action")).alias("action"),
        t.centi(q("observation.state")).alias("state"),
        "task",
    )


NUMBERED = f"select idx, episode_index, frame_index, task_index, time_ns, {t.centi_sql('a')} action, {t.centi_sql('state')} state, task from ds"


@query(f"{DATASET} {NUMBERED}")
def convert_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(converted(spark, sf).frames)


@query(f"{DATASET} {NUMBERED}")
def convert_dataset_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """All numbering and alignment through chunks, the segment table included."""
    return numbered(converted(spark, sf, rows_per_chunk=40).frames)


@query(f"{DATASET} {NUMBERED}")
def finalize_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Numbering of rows that are already aligned, with known features."""
    dense = stage(frames(spark, sf, faults=True), "aligned")
    held = profile.segment_profile(t.recording(spark, sf, faults=True), CONFIG.scalar_columns, CONFIG.reference_column)
    features = {"action": {"dtype": "float32", "shape": [2]}, "observation.state": {"dtype": "float32", "shape": [3]}}
    return numbered(convert.finalize_dataset(dense, stage(held, "segments"), CONFIG, features).frames)


@query(f"{DATASET} {NUMBERED}")
def write_frames(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "frames")
    sinks.write_frames(converted(spark, sf).frames, path)
    return numbered(spark.read.parquet(f"{path}/data"))


@query(
    f"""{DATASET} select episode_index, segment_id, n length, cast(from_index as bigint) dataset_from_index, cast(from_index + n as bigint) dataset_to_index from epi"""
)
def write_episodes(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "episodes")
    columns = ["episode_index", SEGMENT, "length", "dataset_from_index", "dataset_to_index"]
    sinks.write_episodes(converted(spark, sf).episodes.select(*columns), path)
    return spark.read.parquet(f"{path}/meta/episodes")


@query(
    f"""{DATASET} select 10 fps, (select count(*) from epi) total_episodes, (select count(*) from ok) total_frames,
 2 action_dim, 3 state_dim"""
)
def write_info(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "info")
    done = converted(spark, sf)
    sinks.write_info(sinks.dataset_info(done.episodes, done.features, CONFIG.fps, done.encoder), path)
    info = spark.read.text(f"{path}/meta/info")
    schema = "fps int, total_episodes long, total_frames long, features map<string, struct<dtype: string, shape: array<int>>>"
    row = info.select(F.from_json("value", schema).alias("i"))
    features = F.col("i.features")
    return row.select(
        "i.fps",
        "i.total_episodes",
        "i.total_frames",
        F.get(features["action"]["shape"], F.lit(0)).alias("action_dim"),
        F.get(features["observation.state"]["shape"], F.lit(0)).alias("state_dim"),
    )
