"""Reading, filtering and aligning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import A, CONFIG, EV, G, S, T, q, query
from framewright.functions import names, times
from framewright.operators import align, profile
from framewright.operators.align import ORDINAL, SEGMENT, TIME
from framewright.operators.scans import number_rows, plan_chunks
from framewright.session import scratch_path
from framewright.sources import recordings as rec

ALL = [A, S, G, T]


def shown(aligned: DataFrame) -> DataFrame:
    """Aligned rows in comparable form."""
    return aligned.select(
        SEGMENT,
        ORDINAL,
        TIME,
        "frame_index",
        t.centi(F.flatten(q(A))).alias("action"),
        t.centi(q(S)).alias("state"),
        t.centi(F.flatten(q(G))).alias("gripper"),
        F.get(q(T), F.lit(0)).alias("task"),
    )


SHOWN = f"""select segment_id, ordinal, time_ns, frame_index, {t.centi_sql('a')} action, {t.centi_sql('s')} state,
 {t.centi_sql('g')} gripper, t as task from fr"""


@query(f"{t.frames_sql()} {SHOWN}")
def latest_at_clamped(spark: SparkSession, sf: str) -> DataFrame:
    return shown(align.latest_at(t.recording(spark, sf), ALL, A))


@query(f"{t.frames_sql(clamp=False)} {SHOWN}")
def latest_at_strict(spark: SparkSession, sf: str) -> DataFrame:
    return shown(align.latest_at(t.recording(spark, sf), ALL, A, clamp=False))


@query(f"{t.frames_sql(day=True)} {SHOWN}")
def latest_at(spark: SparkSession, sf: str) -> DataFrame:
    """Times cut to days, so that ties decide most values."""
    return shown(align.latest_at(t.recording(spark, sf, day=True), ALL, A))


@query(f"{t.frames_sql()} {SHOWN}")
def latest_at_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """Every segment cut into chunks, as a long one would be."""
    return shown(align.latest_at(t.recording(spark, sf), ALL, A, rows_per_chunk=16))


@query(f"{t.frames_sql(day=True, clamp=False)} {SHOWN}")
def latest_at_ties_chunked(spark: SparkSession, sf: str) -> DataFrame:
    return shown(align.latest_at(t.recording(spark, sf, day=True), ALL, A, clamp=False, rows_per_chunk=4))


@query("select user_id segment_id, event_id, epoch_ns(ts) ts, event_type, value, props from events")
def read_recordings(spark: SparkSession, sf: str) -> DataFrame:
    rows = rec.read_recordings(spark, f"{sf}/events.parquet", segment="user_id")
    ts = times.normalize_times(rows, "ts").alias("ts")
    return rows.select(F.col("user_id").alias("segment_id"), "event_id", ts, "event_type", "value", "props")


@query("select event_type, user_id, event_id, epoch_ns(ts) ts, value, props from events")
def read_recordings_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Stored by segment, and the segment is in the folders' names only."""
    path = scratch_path(spark, "by-segment")
    spark.read.parquet(f"{sf}/events.parquet").write.partitionBy("event_type").parquet(path)
    rows = rec.read_recordings(spark, path, segment="event_type")
    return rows.select("event_type", "user_id", "event_id", times.normalize_times(rows, "ts").alias("ts"), "value", "props")


@query(
    """select case when event_id % 2 = 0 then 'even' else 'odd' end folder, event_id,
 case when event_id % 2 = 0 then value end as value, case when event_id % 2 = 1 then props end as props from events"""
)
def read_recordings_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Two folders whose files have different columns."""
    path = scratch_path(spark, "mixed")
    events = spark.read.parquet(f"{sf}/events.parquet")
    even = F.col("event_id") % 2 == 0
    events.where(even).select("event_id", "value").write.parquet(f"{path}/even")
    events.where(~even).select("event_id", "props").write.parquet(f"{path}/odd")
    rows = rec.read_recordings(spark, path)
    return rows.select(F.substring_index(SEGMENT, "/", 1).alias("folder"), "event_id", "value", "props")


@query(
    """select ['a','b','c','d'][event_id % 4 + 1] folder, event_id, user_id, case when event_id % 4 = 3 then props end props,
 round((case when event_id % 4 = 1 then value else cast(cast(value as float) as double) end) * 100) centi from events"""
)
def read_recordings_types(spark: SparkSession, sf: str) -> DataFrame:
    """Four folders whose files store one column with different types, also inside of lists."""
    path = scratch_path(spark, "types")
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("user_id", F.col("user_id").cast("long"))
    kinds = {"a": ("float", "int"), "b": ("double", "long"), "c": ("float", "long"), "d": ("float", "int")}
    for rest, (folder, (number, whole)) in enumerate(kinds.items()):
        part = events.where(F.col("event_id") % 4 == rest)
        stored = part.select("event_id", F.array(F.col("value").cast(number)).alias("v"), F.col("user_id").cast(whole), *(["props"] if folder == "d" else []))
        stored.write.parquet(f"{path}/{folder}")
    rows = rec.read_recordings(spark, path)
    centi = F.round(F.get("v", F.lit(0)) * 100).alias("centi")
    return rows.select(F.substring_index(SEGMENT, "/", 1).alias("folder"), "event_id", centi, "user_id", "props")


@query(f"with {EV} select segment_id, ordinal, time_ns, event_type from ev")
def read_catalog(spark: SparkSession, sf: str) -> DataFrame:
    t.events(spark, sf).createOrReplaceTempView("recording_events")
    return rec.read_catalog(spark, "recording_events").select(SEGMENT, ORDINAL, TIME, "event_type")


@query(
    f"""with {t.rec_sql()} select segment_id, ordinal, time_ns, {t.centi_sql('a')} action, {t.centi_sql('s')} state
 from rec where a is not null or s is not null"""
)
def index_reader(spark: SparkSession, sf: str) -> DataFrame:
    rows = align.index_reader(t.recording(spark, sf), [A, S])
    return rows.select(SEGMENT, ORDINAL, TIME, t.centi(F.flatten(q(A))).alias("action"), t.centi(q(S)).alias("state"))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """Long form: one row per logged value."""
    rows = t.events(spark, sf)
    kind, k, value = F.col("event_type"), F.col("k"), F.col("value")
    entity = (
        F.when(kind == "click", "/robot/action")
        .when(kind == "view", F.concat(F.lit("/robot/joint_"), F.floor(k / 25).cast("string")))
        .when(kind == "purchase", F.concat(F.lit("/transforms/t"), k.cast("int").cast("string")))
        .when(kind == "signup", "/instruction")
        .when(k < 50, F.concat(F.lit("/camera/cam_"), F.floor(k / 10).cast("string")))
        .otherwise("/mesh")
    )
    component = (
        F.when(kind.isin("click", "view"), "Scalars")
        .when(kind == "purchase", "Transform3D")
        .when(kind == "signup", "TextDocument")
        .when(k < 50, "VideoStream")
        .otherwise("Asset3D")
    )
    field = (
        F.when(kind.isin("click", "view"), "scalars")
        .when(kind == "purchase", "translation")
        .when(kind == "signup", "text")
        .when(k < 50, "sample")
        .otherwise("blob")
    )
    numeric = (
        F.when(kind == "click", F.array(value, k))
        .when(kind == "view", F.array(value))
        .when((kind == "purchase") & (value > 40), F.array(value, k, value, k))
        .when(kind == "purchase", F.array(value, k, value))
        .when((kind == "error") & (k >= 50), F.array(value))
    )
    text = F.when((kind == "signup") | (kind == "error") & (k < 50), F.col("props"))
    return rows.select(
        SEGMENT,
        ORDINAL,
        TIME,
        entity.alias("entity_path"),
        component.alias("component"),
        field.alias("field"),
        numeric.cast("array<float>").alias("value"),
        text.alias("text"),
    )


LOG = f"""{EV}, lg as (select segment_id, ordinal, time_ns,
 case event_type when 'click' then '/robot/action' when 'view' then '/robot/joint_' || cast(cast(floor(k/25) as bigint) as varchar)
  when 'purchase' then '/transforms/t' || cast(cast(k as int) as varchar) when 'signup' then '/instruction'
  else case when k < 50 then '/camera/cam_' || cast(cast(floor(k/10) as bigint) as varchar) else '/mesh' end end entity_path,
 case when event_type in ('click','view') then 'Scalars' when event_type='purchase' then 'Transform3D'
  when event_type='signup' then 'TextDocument' when k < 50 then 'VideoStream' else 'Asset3D' end component,
 case when event_type in ('click','view') then 'scalars' when event_type='purchase' then 'translation'
  when event_type='signup' then 'text' when k < 50 then 'sample' else 'blob' end field,
 case when event_type='click' then [value,k] when event_type='view' then [value]
  when event_type='purchase' and value > 40 then [value,k,value,k] when event_type='purchase' then [value,k,value]
  when event_type='error' and k >= 50 then [value] end val,
 case when event_type='signup' or (event_type='error' and k < 50) then props end txt from ev)"""


# Every column that the log can have, by the rules of `log`.
NUMERIC = [A, "/mesh:Asset3D:blob"] + [f"/robot/joint_{n}:Scalars:scalars" for n in range(4)] + [f"/transforms/t{n}:Transform3D:translation" for n in range(100)]
TEXTS = ["/instruction:TextDocument:text"] + [f"/camera/cam_{n}:VideoStream:sample" for n in range(5)]


@query(
    f"""with {LOG} select segment_id, ordinal, time_ns, entity_path || ':' || component || ':' || field as name,
 {t.centi_sql('val')} numbers, txt as text from lg"""
)
def pivot_log(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the log side by side; each row shows the columns that it fills."""
    wide = rec.pivot_log(log(spark, sf), NUMERIC, text=TEXTS)
    none = F.lit(None)
    cells = [F.struct(F.lit(c).alias("name"), q(c).alias("numbers"), none.cast("array<string>").alias("text")) for c in NUMERIC]
    cells += [F.struct(F.lit(c).alias("name"), none.cast(wide.schema[NUMERIC[0]].dataType).alias("numbers"), q(c).alias("text")) for c in TEXTS]
    filled = F.filter(F.array(*cells), lambda cell: cell["numbers"].isNotNull() | cell["text"].isNotNull())
    rows = wide.select(SEGMENT, ORDINAL, TIME, F.explode_outer(filled).alias("c"))
    return rows.select(SEGMENT, ORDINAL, TIME, "c.name", t.centi(F.col("c.numbers")).alias("numbers"), F.get("c.text", F.lit(0)).alias("text"))


@query(
    f"""with {t.rec_sql(day=True)} select segment_id, time_ns, max(ordinal) ordinal,
 {t.centi_sql('arg_max(s, ordinal) filter (s is not null)')} state,
 {t.centi_sql('arg_max(a, ordinal) filter (a is not null)')} action from rec group by segment_id, time_ns"""
)
def merge_instants(spark: SparkSession, sf: str) -> DataFrame:
    merged = rec.merge_instants(t.recording(spark, sf, day=True), [A, S])
    return merged.select(SEGMENT, TIME, ORDINAL, t.centi(q(S)).alias("state"), t.centi(F.flatten(q(A))).alias("action"))


LONG_SQL = "long as (" + " union all ".join(
    f"select segment_id, ordinal, time_ns, '{name.split(':')[0]}' entity_path, {t.centi_sql(c)} v from rec where {c} is not null" for c, name in (("a", A), ("s", S), ("g", G))
) + ")"


def long_log(spark: SparkSession, sf: str) -> DataFrame:
    """All vector columns of the recording in long form."""
    return rec.unpivot_recording(t.recording(spark, sf), [A, S, G])


@query(f"with {t.rec_sql()}, {LONG_SQL} select segment_id, ordinal, time_ns, entity_path, 'Scalars' component, 'scalars' field, v from long")
def unpivot_recording(spark: SparkSession, sf: str) -> DataFrame:
    long = long_log(spark, sf)
    return long.select(SEGMENT, ORDINAL, TIME, "entity_path", "component", "field", t.centi(F.col("value")).alias("v"))


@query(
    """with s as (select distinct cast(user_id as varchar) segment_id from events)
 select segment_id, row_number() over (order by segment_id) - 1 seg_pos from s"""
)
def segment_listing(spark: SparkSession, sf: str) -> DataFrame:
    return rec.segment_listing(t.recording(spark, sf))


@query(
    """with s as (select distinct cast(user_id as varchar) segment_id from events)
 select * from (select segment_id, row_number() over (order by segment_id) - 1 seg_pos from s) where seg_pos < 20"""
)
def limit_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rec.segment_listing(t.recording(spark, sf), max_segments=20)


def sized(spark: SparkSession, sf: str) -> DataFrame:
    """A size per logged row; unknown for some, and 0 in all where no purchase is above 60."""
    rows = t.events(spark, sf)
    big = (F.col("event_type") == "purchase") & (F.col("value") > 60)
    size = F.when(big, F.octet_length("props")).when(F.col("event_type") != "view", 0)
    return rows.select(SEGMENT, size.cast("long").alias("size_bytes"))


SIZES = f"""{EV}, sizes as (select segment_id, cast(coalesce(sum(case when event_type='purchase' and value > 60
 then octet_length(encode(props)) when event_type <> 'view' then 0 end), 0) as bigint) size_bytes from ev group by segment_id)"""


@query(f"with {SIZES} select * from sizes")
def segment_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return rec.segment_sizes(sized(spark, sf))


def stored(spark: SparkSession, sf: str) -> str:
    """The events stored in one folder per kind, as a recording with nanoseconds."""
    path = scratch_path(spark, "stored")
    rows = t.events(spark, sf).select(ORDINAL, TIME, "value", F.col("event_type").alias(SEGMENT))
    rows.write.partitionBy(SEGMENT).parquet(path)
    return path


@query("select event_type segment_id, count(*) \"rows\", true sized from events group by 1")
def stored_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes from the file listing; they are whole when their sum is that of the listed files."""
    path = stored(spark, sf)
    sizes = rec.stored_sizes(rec.read_recordings(spark, path))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    listed = files.groupBy(F.regexp_extract("path", "segment_id=([^/]*)", 1).alias(SEGMENT)).agg(F.sum("length").alias("listed"))
    return sizes.join(listed, [SEGMENT], "left").select(SEGMENT, "rows", (F.col("size_bytes") == F.col("listed")).alias("sized"))


@query(f"with {EV} select event_type segment_id, min(time_ns) min_ns, max(time_ns) max_ns, count(*) \"rows\" from ev group by 1")
def stored_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return rec.stored_ranges(spark, stored(spark, sf), TIME)


@query(f"with {SIZES} select cast(sum(size_bytes) as bigint) total_bytes from sizes")
def segment_bytes_total(spark: SparkSession, sf: str) -> DataFrame:
    return rec.segment_sizes(sized(spark, sf)).agg(F.sum("size_bytes").alias("total_bytes"))


@query(f"with {SIZES} select segment_id, ordinal from ev where segment_id not in (select segment_id from sizes where size_bytes=0)")
def skip_empty_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = rec.skip_empty_segments(t.recording(spark, sf), rec.segment_sizes(sized(spark, sf)))
    return rows.select(SEGMENT, ORDINAL)


@query("select count(distinct user_id) num_segments from events")
def count_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rec.count_segments(t.recording(spark, sf))


@query(f"with {SIZES} select segment_id, ordinal, time_ns from ev where segment_id in (select segment_id from sizes where size_bytes > 0)")
def filter_segments(spark: SparkSession, sf: str) -> DataFrame:
    chosen = rec.segment_sizes(sized(spark, sf)).where("size_bytes > 0")
    return rec.filter_segments(t.recording(spark, sf), chosen).select(SEGMENT, ORDINAL, TIME)


@query(f"with {LOG} select segment_id, ordinal, entity_path from lg where entity_path in ('/robot/action','/instruction')")
def filter_contents(spark: SparkSession, sf: str) -> DataFrame:
    return rec.filter_contents(log(spark, sf), ["/robot/action", "/instruction"]).select(SEGMENT, ORDINAL, "entity_path")


@query(
    f"""with {LOG}, n as (select entity_path, count(*) logged from lg group by entity_path)
 select path, place, is_reference, coalesce(logged, 0) logged from (values ('/robot/action', 0, true), ('/robot/state', 1, false),
 ('/robot/gripper', 2, false), ('/task', 3, false)) p(path, place, is_reference) left join n on entity_path = path"""
)
def filter_list(spark: SparkSession, sf: str) -> DataFrame:
    """The entity paths a configuration asks for, with the rows logged under each."""
    paths, reference = CONFIG.filter_list()
    wanted = spark.createDataFrame([(p, i, p == reference) for i, p in enumerate(paths)], "path string, place int, is_reference boolean")
    logged = log(spark, sf).groupBy(F.col("entity_path").alias("path")).agg(F.count("*").alias("logged"))
    return wanted.join(logged, ["path"], "left").withColumn("logged", F.coalesce("logged", F.lit(0)))


@query(f"with {t.rec_sql()} select segment_id, ordinal, time_ns, a is not null has_action, s is not null has_state, t is not null has_task from rec")
def project_scalars(spark: SparkSession, sf: str) -> DataFrame:
    rows = rec.project_scalars(t.recording(spark, sf), [SEGMENT, ORDINAL, TIME, A, S, A, T, S])
    present = [q(c).isNotNull().alias(n) for c, n in ((A, "has_action"), (S, "has_state"), (T, "has_task"))]
    return rows.select(SEGMENT, ORDINAL, TIME, *present)


@query(
    f"""with {t.rec_sql()} select 'action' role, 0 place, count(a) logged from rec union all
 select 'state', 0, count(s) from rec union all select 'state', 1, count(g) from rec"""
)
def normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    """One column or several: the roles of a configuration, with the values logged for each column."""
    rows = t.recording(spark, sf)
    roles = [("action", i, c) for i, c in enumerate(CONFIG.action_columns)] + [("state", i, c) for i, c in enumerate(CONFIG.state_columns)]
    counts = rows.agg(
        F.array(*[F.struct(F.lit(r).alias("role"), F.lit(i).alias("place"), F.count(q(c)).alias("logged")) for r, i, c in roles]).alias("x")
    )
    return counts.select(F.explode("x").alias("x")).select("x.*")


@query(f"with {t.rec_sql()} select segment_id, ordinal, time_ns from rec where a is not null")
def reference_rows(spark: SparkSession, sf: str) -> DataFrame:
    return align.latest_at(t.recording(spark, sf), [A], A).select(SEGMENT, ORDINAL, TIME)


@query(
    f"""with {t.rec_sql()} select segment_id, {t.centi_sql("arg_min(s, {'t': time_ns, 'o': ordinal}) filter (s is not null)")} state
 from rec group by segment_id"""
)
def first_non_null(spark: SparkSession, sf: str) -> DataFrame:
    return profile.first_non_null(t.recording(spark, sf), S).select(SEGMENT, t.centi(q(S)).alias("state"))


@query(
    f"""with {t.rec_sql()}, {LONG_SQL}, o as (select *, row_number() over (partition by segment_id, entity_path order by time_ns, ordinal) - 1 place from long)
 select segment_id, entity_path, place, v from o where place < 3"""
)
def head_per_column(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of every vector column of every segment."""
    found = profile.heads(long_log(spark, sf), 3)
    return found.select(SEGMENT, "entity_path", "place", t.centi(F.col("value")).alias("v"))


@query(f"with {t.rec_sql(day=True)} select segment_id, ordinal, row_number() over (partition by segment_id order by time_ns, ordinal) - 1 place from rec")
def stable_time_sort(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.recording(spark, sf, day=True).select(SEGMENT, ORDINAL, TIME)
    chunks = plan_chunks(rows, [SEGMENT], [TIME, ORDINAL])
    return number_rows(rows, "place", chunks).select(SEGMENT, ORDINAL, "place")


@query(
    f"""with {EV} select segment_id, ordinal, time_ns, 'events' source, value, null turn from ev union all
 select 'c' || cast(conv_id as varchar), turn, turn, 'conversations', null, turn from conversations"""
)
def union_recordings(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources with different columns as one recording."""
    left = t.events(spark, sf).select(SEGMENT, ORDINAL, TIME, F.lit("events").alias("source"), "value")
    talks = t.load(spark, sf, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias(SEGMENT),
        F.col("turn").alias(ORDINAL),
        F.col("turn").alias(TIME),
        F.lit("conversations").alias("source"),
        "turn",
    )
    return rec.union_recordings([left, talks])


FRAMES_SQL = """with f as (select o_custkey k, epoch_us(o_orderdate)*1000 time_ns, max(o_orderkey) o from orders group by 1, 2),
 h as (select k, min(time_ns) first_ns, arg_min(lo, time_ns) first_o from
  (select o_custkey k, epoch_us(o_orderdate)*1000 time_ns, min(o_orderkey) lo from orders group by 1, 2) group by k),
 x as (select o_custkey k, epoch_us(l_shipdate)*1000 time_ns, l_orderkey*8+l_linenumber ordinal from lineitem join orders on l_orderkey=o_orderkey)
 select x.k custkey, x.ordinal, x.time_ns, coalesce(f.o, h.first_o) frame_ordinal, coalesce(f.time_ns, h.first_ns) frame_time_ns
 from x asof left join f on x.k=f.k and x.time_ns >= f.time_ns left join h on x.k=h.k"""


def _shipments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders, items = t.load(spark, sf, "orders"), t.load(spark, sf, "lineitem")
    shown_ = orders.select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias(ORDINAL), times.normalize_times(orders, "o_orderdate").alias(TIME)
    )
    shipped = items.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    asked = shipped.select(
        F.col("o_custkey").alias("custkey"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias(ORDINAL),
        times.normalize_times(items, "l_shipdate").alias(TIME),
    )
    return asked, shown_


@query(FRAMES_SQL)
def latest_at_frames(spark: SparkSession, sf: str) -> DataFrame:
    """For every shipment the latest order of its customer at or before that time."""
    asked, shown_ = _shipments(spark, sf)
    return align.latest_at_frames(asked, shown_, ["custkey"])


@query(FRAMES_SQL)
def latest_at_frames_chunked(spark: SparkSession, sf: str) -> DataFrame:
    asked, shown_ = _shipments(spark, sf)
    return align.latest_at_frames(asked, shown_, ["custkey"], rows_per_chunk=20)


def day_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """The recording with one day of time shrunk to a second."""
    return t.recording(spark, sf).withColumn(TIME, F.call_function("div", F.col(TIME), F.lit(86_400)))


@query(
    f"""with {t.rec_sql()}, r as (select segment_id, min(time_ns // 86400) lo, max(time_ns // 86400) hi from rec group by segment_id),
 grid as (select segment_id, unnest(range(lo, greatest(hi, lo + 1), 100000000)) time_ns from r)
 select segment_id, row_number() over (partition by segment_id order by time_ns) - 1 grid_index, time_ns from grid"""
)
def time_grid(spark: SparkSession, sf: str) -> DataFrame:
    rows = day_seconds(spark, sf)
    ranges = rows.groupBy(SEGMENT).agg(F.min(TIME).alias("min_ns"), F.max(TIME).alias("max_ns"))
    return align.time_grid(ranges, 10)


@query(
    """with r as (select cast(user_id as varchar) segment_id, min(value) lo, max(value) hi from events group by 1),
 g as (select segment_id, lo, unnest(range(0, cast(greatest(ceil((hi - lo) * 4.0), 1) as bigint))) i from r)
 select segment_id, i grid_index, round(lo + i / 4.0, 6) time_s from g"""
)
def time_grid_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """The values of every segment taken as seconds."""
    ranges = t.events(spark, sf).groupBy(SEGMENT).agg(F.min("value").alias("min_s"), F.max("value").alias("max_s"))
    return align.time_grid_seconds(ranges, 4).select(SEGMENT, "grid_index", F.round("time_s", 6).alias("time_s"))


RESAMPLED = f"""with {t.rec_sql()}, dv as (select segment_id, ordinal, time_ns // 86400 time_ns, s, g from rec where s is not null or g is not null),
 r as (select segment_id, min(time_ns) lo, max(time_ns) hi from dv group by segment_id),
 grid as (select segment_id, unnest(range(lo, greatest(hi, lo + 1), 500000000)) time_ns from r),
 bs as (select segment_id, time_ns, arg_max(s, ordinal) s from dv where s is not null group by segment_id, time_ns),
 bg as (select segment_id, time_ns, arg_max(g, ordinal) g from dv where g is not null group by segment_id, time_ns),
 fs as (select segment_id, arg_min(s, {{'t': time_ns, 'o': ordinal}}) s from dv where s is not null group by segment_id),
 fg as (select segment_id, arg_min(g, {{'t': time_ns, 'o': ordinal}}) g from dv where g is not null group by segment_id),
 w as (select grid.segment_id, grid.time_ns, coalesce(bs.s, fs.s) s from grid asof left join bs
  on grid.segment_id = bs.segment_id and grid.time_ns >= bs.time_ns left join fs on fs.segment_id = grid.segment_id)
 select w.segment_id, w.time_ns, row_number() over (partition by w.segment_id order by w.time_ns) - 1 frame_index,
 {t.centi_sql('w.s')} state, {t.centi_sql('coalesce(bg.g, fg.g)')} gripper from w asof left join bg
 on w.segment_id = bg.segment_id and w.time_ns >= bg.time_ns left join fg on fg.segment_id = w.segment_id"""


def _resampled(spark: SparkSession, sf: str, **options: object) -> DataFrame:
    rows = align.resample_fps(day_seconds(spark, sf), [S, G], 2, **options)
    return rows.select(
        SEGMENT, TIME, "frame_index", t.centi(q(S)).alias("state"), t.centi(F.flatten(q(G))).alias("gripper")
    )


@query(RESAMPLED)
def resample_fps(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf)


@query(RESAMPLED)
def resample_fps_chunked(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf, rows_per_chunk=24)


@query(f"with {EV} select segment_id, ordinal, time_ns - min(time_ns) over (partition by segment_id) time_ns from ev")
def rebase_times(spark: SparkSession, sf: str) -> DataFrame:
    return align.rebase(t.events(spark, sf).select(SEGMENT, ORDINAL, TIME), [SEGMENT])


@query(
    """select event_id, epoch_us(ts)*1000 from_timestamp, cast(trunc(value * 1e9) as bigint) from_seconds, user_id from_sequence,
 (epoch_us(ts) - epoch_us(timestamp '2024-01-01'))*1000 from_duration from events"""
)
def normalize_times(spark: SparkSession, sf: str) -> DataFrame:
    """The same operator on a time stamp, float seconds, a sequence and a duration."""
    df = t.load(spark, sf, "events").withColumn("since", F.col("ts") - F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return df.select(
        "event_id",
        times.normalize_times(df, "ts").alias("from_timestamp"),
        times.normalize_times(df, "value").alias("from_seconds"),
        times.normalize_times(df, "user_id").alias("from_sequence"),
        times.normalize_times(df, "since").alias("from_duration"),
    )


URL = r"'^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)([^?#]*)'"


@query(
    rf"""with u as (select page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://[^/?#]+', 1) scheme,
 regexp_extract(url, {URL}, 1) host, list_filter(string_split(regexp_extract(url, {URL}, 2), '/'), lambda p: p <> '') parts from
 (select page_id, url from pages union all select -1-page_id, regexp_replace(regexp_replace(url, '/(fr|en|de|es)/', '/entry/'), '^https', 'data') from pages
  union all select -1000000000-page_id, regexp_replace(url, '/(fr|en|de|es)/', '/') from pages
  union all select -2000000000-page_id, regexp_replace(url, '^https?://', '') from pages))
 select page_id, case when scheme <> '' and ((len(parts) >= 2 and parts[-2] = 'entry') or len(parts)=1) then lower(scheme) || '://' || host end catalog_url,
 case when scheme <> '' and ((len(parts) >= 2 and parts[-2] = 'entry') or len(parts)=1) then parts[-1] end entry_id,
 case when scheme = '' then 'invalid dataset url' when (len(parts) >= 2 and parts[-2] = 'entry') or len(parts)=1 then null else 'no entry id' end error from u"""
)
def split_dataset_url(spark: SparkSession, sf: str) -> DataFrame:
    pages = t.load(spark, sf, "pages").select("page_id", "url")
    lang = r"/(fr|en|de|es)/"
    entry = F.regexp_replace(F.regexp_replace("url", lang, "/entry/"), "^https", "data")
    named = pages.select((-1 - F.col("page_id")).alias("page_id"), entry.alias("url"))
    bare = pages.select((-1000000000 - F.col("page_id")).alias("page_id"), F.regexp_replace("url", lang, "/").alias("url"))
    loose = pages.select((-2000000000 - F.col("page_id")).alias("page_id"), F.regexp_replace("url", "^https?://", "").alias("url"))
    split = names.split_dataset_url(F.col("url"))
    return pages.unionByName(named).unionByName(bare).unionByName(loose).select("page_id", split.alias("u")).select("page_id", "u.*")


@query("select count(*) frames, true refused from events where event_type='click'")
def refuse_existing_output(spark: SparkSession, sf: str) -> DataFrame:
    """Writing a second time to the same place is refused and leaves the first result whole."""
    from framewright.operators import episodes as ep
    from framewright.plans.convert import refuse_existing
    from framewright.sources import sinks

    path = scratch_path(spark, "refuse")
    frames = ep.build_episodes(t.recording(spark, sf), CONFIG)
    frames = frames.select(F.col(SEGMENT).alias("episode_index"), "frame_index", "task")
    refuse_existing(spark, path)
    sinks.write_table(frames, path, "data")
    refused = False
    try:
        refuse_existing(spark, path)
    except ValueError as error:
        refused = path in str(error)
    return spark.read.parquet(f"{path}/data").agg(F.count("*").alias("frames")).withColumn("refused", F.lit(refused))
