"""Names, addresses and schema inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.align import LOG, log
from checks.tables import A, G, S, T, query
from framewright.functions import names
from framewright.operators import inspect, profile
from framewright.operators.align import ORDINAL, SEGMENT, TIME


@query(f"with {LOG} select segment_id, ordinal, split_part(entity_path || ':' || component || ':' || field, ':', 1) path from lg")
def entity_path(spark: SparkSession, sf: str) -> DataFrame:
    rows = log(spark, sf)
    name = F.concat_ws(":", "entity_path", "component", "field")
    return rows.select(SEGMENT, ORDINAL, names.entity_path(name).alias("path"))


@query("select page_id, split_part(url, ':', 1) entity_path, split_part(url, ':', 2) component, split_part(url, ':', 3) field from pages")
def parse_column_spec(spark: SparkSession, sf: str) -> DataFrame:
    pages = t.load(spark, sf, "pages")
    return pages.select("page_id", names.column_parts(F.col("url")).alias("p")).select("page_id", "p.*")


SPEC = "event_type || ':/camera/' || cast(user_id as varchar) || case when event_type='view' then ':video_time' when event_type='error' then props else '' end"


@query(
    f"""with s as (select event_id, {SPEC} spec from events), p as (select event_id, string_split(spec, ':') x from s)
 select event_id, case when len(x) in (2,3) then x[1] end "key", case when len(x) in (2,3) then x[2] end path,
 case when len(x) = 3 then x[3] end "index", case when len(x) not in (2,3) then 'expected key:path or key:path:index' end error from p"""
)
def parse_video_spec(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.load(spark, sf, "events")
    own = F.when(F.col("event_type") == "view", ":video_time").when(F.col("event_type") == "error", F.col("props")).otherwise("")
    spec = F.concat(F.col("event_type"), F.lit(":/camera/"), F.col("user_id").cast("string"), own)
    return rows.select("event_id", names.parse_video_spec(spec).alias("s")).select("event_id", "s.*")


@query(
    r"""with p as (select doc_id, list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') n from documents)
 select doc_id, case when len(n) > 0 then len(n) end items, n[1] first_item, n[-1] last_item,
 md5(case when len(n) > 0 then array_to_string(n, '|') end) digest from p"""
)
def parse_name_list(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts as comma lists."""
    rows = t.load(spark, sf, "documents").select("doc_id", names.parse_name_list(F.col("text")).alias("n"))
    return rows.select(
        "doc_id",
        F.when(F.col("n").isNotNull(), F.size("n").cast("long")).alias("items"),
        F.get("n", F.lit(0)).alias("first_item"),
        F.try_element_at("n", F.lit(-1)).alias("last_item"),
        F.md5(F.array_join("n", "|")).alias("digest"),
    )


@query("select page_id, coalesce(nullif(string_split(rtrim(url, '/'), '/')[-1], ''), 'cam') \"key\", 'observation.images.' || coalesce(nullif(string_split(rtrim(url, '/'), '/')[-1], ''), 'cam') feature from pages")
def video_key_guess(spark: SparkSession, sf: str) -> DataFrame:
    key = names.video_key_guess(F.col("url"))
    return t.load(spark, sf, "pages").select("page_id", key.alias("key"), names.camera_feature_key(key).alias("feature"))


@query("select event_id, 'observation.images.' || event_type feature from events")
def camera_feature_key(spark: SparkSession, sf: str) -> DataFrame:
    return t.load(spark, sf, "events").select("event_id", names.camera_feature_key(F.col("event_type")).alias("feature"))


@query(
    """select event_id, '/cam/' || event_type || case event_type when 'view' then ':VideoStream:sample' when 'error' then ':EncodedImage:blob'
 else ':Image:buffer' end sample_column from events"""
)
def sample_column(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "video").when(F.col("event_type") == "error", "encoded_image").otherwise("raw_image")
    column = names.sample_column(kind, F.concat(F.lit("/cam/"), F.col("event_type")))
    return t.load(spark, sf, "events").select("event_id", column.alias("sample_column"))


# One dataset per day of the log. Every dataset also has timelines and bookkeeping columns.
CONTROL = ("sys.", "sys_")
DAY = "'day ' || cast(time_ns // 86400000000000 as varchar)"
COLUMNS = f"""{LOG}, named as (select {DAY} dataset, entity_path || ':' || component || ':' || field as name, len(val) size, txt is not null has_text from lg),
 cols as (select dataset, name, case when max(size) is not null then 'float' when bool_or(has_text) then 'string' else 'null' end leaf,
  case when min(size) = max(size) then min(size) end dim, null::varchar type_name, false temporal from named group by dataset, name
  union all select dataset, n, l, null, y, p from (select distinct dataset from named),
  (values ('log_time','time','timestamp[ns]',true), ('log_tick','integer','bigint',false), ('sys.row','integer','bigint',false),
   ('property:RecordingInfo:start_time','time','timestamp[ns]',true)) v(n,l,y,p)),
 cl as (select *, split_part(name, ':', 1) entity_path, split_part(name, ':', 2) component,
  case when name like 'property:%' then 'ignored' when not contains(name, ':') then case when name like 'sys.%' then 'ignored' else 'timeline' end
  when name like '%:VideoStream:sample' then 'video' when leaf='string' then case when split_part(name, ':', 2) in ('Text','TextDocument') then 'task' else 'ignored' end
  when leaf in ('float','integer') and split_part(name, ':', 2) not in ('Asset3D','CoordinateFrame','RecordingInfo') then 'signal' else 'ignored' end kind from cols),
 rk as (select *, row_number() over (partition by dataset, kind order by
  case when kind='signal' then (dim is null)::int when kind='timeline' then (not temporal)::int else 0 end,
  case when kind='signal' then coalesce(dim, 0) else 0 end, case when kind='video' then entity_path else name end) as "rank" from cl where kind <> 'ignored')"""


def day_log(spark: SparkSession, sf: str) -> DataFrame:
    day = F.call_function("div", F.col(TIME), F.lit(86_400_000_000_000))
    return log(spark, sf).withColumn("dataset", F.concat(F.lit("day "), day.cast("string")))


def columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of every day: those of the log, and the timelines and bookkeeping each dataset has."""
    found = inspect.log_columns(day_log(spark, sf), ["dataset"])
    fixed = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(leaf).alias("leaf"), F.lit(kind).alias("type_name"), F.lit(p).alias("temporal"))
            for n, leaf, kind, p in (
                ("log_time", "time", "timestamp[ns]", True),
                ("log_tick", "integer", "bigint", False),
                ("sys.row", "integer", "bigint", False),
                ("property:RecordingInfo:start_time", "time", "timestamp[ns]", True),
            )
        ]
    )
    more = found.select("dataset").distinct().select("dataset", F.explode(fixed).alias("c")).select("dataset", "c.*")
    return found.unionByName(more, allowMissingColumns=True)


def ranked(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.candidates(inspect.classify(columns(spark, sf), control_prefixes=CONTROL))


@query(f"with {COLUMNS} select dataset, name, leaf, dim, kind, entity_path, component from cl")
def classify_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = inspect.classify(columns(spark, sf), control_prefixes=CONTROL)
    return rows.select("dataset", "name", "leaf", "dim", "kind", "entity_path", "component")


@query(f"with {COLUMNS} select dataset, name, leaf, dim from cols where type_name is null")
def unwrap_list_type(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf type and fixed length of every logged column."""
    return inspect.log_columns(day_log(spark, sf), ["dataset"]).select("dataset", "name", "leaf", "dim")


@query(f"with {COLUMNS} select dataset, name, name like 'sys.%' control from cols")
def is_control_column(spark: SparkSession, sf: str) -> DataFrame:
    return columns(spark, sf).select("dataset", "name", names.starts_with_any(F.col("name"), CONTROL).alias("control"))


@query(f'with {COLUMNS} select dataset, name, kind, cast("rank" as int) "rank" from rk')
def candidate_order(spark: SparkSession, sf: str) -> DataFrame:
    return ranked(spark, sf).select("dataset", "name", "kind", "rank")


@query(f"""with {COLUMNS}, s as (select *, count(*) over (partition by dataset) n from rk where kind='signal')
 select dataset, cast("rank" as int) "rank", name, component, dim, greatest(n - 30, 0) hidden from s where "rank" <= 30""")
def top_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.top_candidates(ranked(spark, sf))


@query(f"with {COLUMNS} select dataset, arg_min(name, \"rank\") filter (kind='timeline') as \"index\" from rk group by dataset")
def guess_index(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.guess_index(ranked(spark, sf))


@query(
    f"""with {COLUMNS}, s as (select dataset, name, "rank" r, contains(lower(name), 'action') ha, contains(lower(name), 'state') or contains(lower(name), 'observation')
  or contains(lower(name), 'joint') or contains(lower(name), 'position') hs from rk where kind='signal'),
 h as (select dataset, min(r) filter (ha) a from s group by dataset),
 h2 as (select s.dataset, any_value(a) a, min(r) filter (hs and (a is null or r <> a)) st from s join h using (dataset) group by s.dataset),
 free as (select s.dataset, list(name order by r) names from s join h2 using (dataset) where (a is null or r <> a) and (st is null or r <> st) group by s.dataset)
 select h2.dataset, coalesce(max(name) filter (r = a), case when max(a) is null then any_value(names)[1] end) action,
 coalesce(max(name) filter (r = st), case when max(st) is null then any_value(names)[case when max(a) is null then 2 else 1 end] end) state
 from h2 join s using (dataset) left join free using (dataset) group by h2.dataset"""
)
def guess_action_state(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.guess_action_state(ranked(spark, sf))


@query(f"with {COLUMNS} select dataset, entity_path, split_part(entity_path, '/', -1) camera_key from rk where kind='video'")
def video_streams(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.video_streams(ranked(spark, sf))


SEGMENTS = f"seg as (select {DAY} dataset, count(distinct segment_id) num_segments from lg group by 1)"


def segment_counts(spark: SparkSession, sf: str) -> DataFrame:
    return day_log(spark, sf).groupBy("dataset").agg(F.count_distinct(SEGMENT).alias("num_segments"))


@query(
    f"""with {COLUMNS}, {SEGMENTS} select dataset, num_segments, count(*) filter (kind='signal') signals, count(*) filter (kind='timeline') timelines,
 count(*) filter (kind='task') tasks, count(*) filter (kind='video') videos from rk join seg using (dataset) group by dataset, num_segments"""
)
def inspect_dataset(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {"signal": "signals", "timeline": "timelines", "task": "tasks", "video": "videos"}
    counted = ranked(spark, sf).groupBy("dataset").agg(
        *[F.count(F.when(F.col("kind") == k, F.lit(1))).alias(n) for k, n in kinds.items()]
    )
    return counted.join(segment_counts(spark, sf), ["dataset"])


@query(
    f"""with {COLUMNS}, {SEGMENTS}, n as (select *, count(*) over (partition by dataset, kind) n from rk),
 b as (select dataset, kind section, cast("rank" as int) "rank", case when kind = 'video' then entity_path else name end as name,
  case when kind <> 'video' and contains(name, ':') then component end component, dim,
  case when kind <> 'video' then coalesce(type_name, 'list<' || leaf || '>') end type_name, temporal,
  case when kind = 'signal' then greatest(n - 30, 0) else 0 end hidden from n where kind <> 'signal' or "rank" <= 30
  union all select dataset, s, null, null, null, null, null, null, 0 from (select distinct dataset from rk) d, (values ('signal'), ('timeline'), ('task'), ('video')) v(s)
  where not exists (select 1 from rk r where r.dataset = d.dataset and r.kind = s))
 select b.*, num_segments from b join seg using (dataset)"""
)
def inspection_report(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.inspection_report(ranked(spark, sf), segment_counts(spark, sf))


@query(
    f"""with {t.rec_sql()}, v as ({' union all '.join(f"select '{c}' as name, count({v}) n, '{kind}' kind, 'float' leaf, {dim} dim, {rank} r from rec" for c, v, kind, dim, rank in ((S, 's', 'signal', 1, 1), (A, 'a', 'signal', 2, 2), (G, 'g', 'signal', 2, 3)))}
  union all select '{T}', count(t), 'task', 'string', null, 1 from rec union all select 'time_ns', count(*), 'timeline', 'time', null, 1 from rec
  union all select 'ordinal', count(*), 'timeline', 'integer', null, 2 from rec)
 select name, kind, leaf, cast(dim as bigint) dim, cast(r as int) "rank", n "values" from v"""
)
def inspect_recording(spark: SparkSession, sf: str) -> DataFrame:
    """A wide recording inspected by its schema, with lengths and counts of values from its rows."""
    rows = t.recording(spark, sf)
    lengths = profile.dim_profile(rows, [A, S, G]).groupBy("column").agg(F.min("min_dim").alias("low"), F.max("max_dim").alias("high"))
    dims = {r["column"]: r["low"] for r in lengths.collect() if r["low"] == r["high"]}
    found = inspect.inspect_dataset(rows, timelines={TIME: "timestamp[ns]"}, dims=dims)
    counted = rows.agg(*[F.count(t.q(c)).alias(c) for c in rows.columns])
    long = counted.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in rows.columns]), F.array(*[t.q(c) for c in rows.columns]))).alias("name", "values"))
    return found.select("name", "kind", "leaf", "dim", "rank").join(long, ["name"])


@query(
    f"""with {COLUMNS}, k as (select dataset, split_part(name, ':', 1) path, bool_or(name like '%:VideoStream:sample') v, bool_or(name like '%:EncodedImage:blob') e from cols group by 1, 2),
 sp as (select distinct dataset, entity_path path from cl where contains(name, ':') and name not like 'property:%')
 select sp.dataset, sp.path, split_part(sp.path, '/', -1) camera_key, case when v then 'video' when e then 'encoded_image' end kind,
 case when not v and not e then 'no supported frames at this path' end error from sp join k using (dataset, path)"""
)
def detect_camera_kind(spark: SparkSession, sf: str) -> DataFrame:
    """Every entity of every dataset asked for as a camera."""
    from framewright.operators import cameras

    cols = columns(spark, sf)
    logged = cols.where(F.contains("name", F.lit(":")) & ~F.startswith("name", F.lit("property:")))
    path = names.entity_path(F.col("name"))
    specs = logged.select("dataset", path.alias("path"), names.video_key_guess(path).alias("camera_key")).distinct()
    return cameras.camera_kinds(specs, cols, ["dataset"]).select("dataset", "path", "camera_key", "kind", "error")
