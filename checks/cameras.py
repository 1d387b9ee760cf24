"""Cameras: codecs, sizes, formats, frames and packets."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import A, CONFIG, EV, query
from framewright import VideoSpec
from framewright.functions import images, rules
from framewright.operators import align, cameras, rates
from framewright.operators.align import ORDINAL, SEGMENT, TIME
from framewright.plans import convert

KEYS = [SEGMENT, "camera_key"]


def _bytes(text: str) -> Column:
    return F.unhex(F.lit(text))


def _number(value: Column) -> Column:
    """Four bytes, most significant first."""
    return F.unhex(F.lpad(F.hex(value.cast("long")), 8, "0"))


def camera_table(spark: SparkSession, sf: str) -> DataFrame:
    """Camera rows with bytes made from the events.

    ``front`` (view) holds video packets, ``wrist`` (error) PNG or JPEG headers with a size
    taken from the row, ``depth`` (purchase) raw buffers cut from a digest of the row.
    """
    rows = t.events(spark, sf)
    kind, k, props = F.col("event_type"), F.col("k"), F.encode("props", "UTF-8")
    unit = F.when(k < 10, _bytes("0000000140010C")).when(k < 20, _bytes("12000A0B")).when(k < 25, _bytes("FFFF"))
    packet = F.concat(unit.otherwise(_bytes("0000000167420000")), props)
    width, height = k + 16, F.floor(F.col("value")) + 1
    png = F.concat(_bytes("89504E470D0A1A0A0000000D49484452"), _number(width), _number(height), _bytes("0802000000"), props)
    size = F.concat(F.unhex(F.lpad(F.hex(height.cast("long")), 4, "0")), F.unhex(F.lpad(F.hex(width.cast("long")), 4, "0")))
    jpeg = F.concat(_bytes("FFD8FFE000104A46494600010100000100010000FFC0001108"), size, _bytes("03011100021101031101"), props)
    still = F.when(k < 50, png).when(k < 95, jpeg).otherwise(props)
    digest = F.unhex(F.md5(F.concat_ws("-", "props", F.col(ORDINAL).cast("string"))))
    depth = F.when(k < 30, digest).when(k < 60, F.substring(digest, 1, 12)).when(k < 95, F.substring(digest, 1, 4)).otherwise(F.substring(digest, 1, 7))
    sample = F.when(kind == "view", packet).when(kind == "error", still).when(kind == "purchase", depth)
    key = F.when(kind == "view", "front").when(kind == "error", "wrist").when(kind == "purchase", "depth")
    fmt = F.struct(F.lit(2).alias("width"), F.lit(2).alias("height"))
    shape = F.when(F.col("camera_key") == "depth", fmt)
    made = rows.select(SEGMENT, key.alias("camera_key"), ORDINAL, TIME, sample.alias("sample"), "k", "value", "props")
    return made.where(F.col("camera_key").isNotNull()).withColumn("format", shape)


CAM = f"""{EV}, cam as (select segment_id, case event_type when 'view' then 'front' when 'error' then 'wrist' else 'depth' end camera_key,
 ordinal, time_ns, k, value, props from ev where event_type in ('view','error','purchase'))"""
PROBED = "case when k < 10 then 'hevc' when k < 20 then 'av1' else 'h264' end"
STILL = "case when k < 50 then 'png' when k < 95 then 'jpeg' else 'unknown' end"


@query(f"with {CAM} select segment_id, ordinal, {STILL} codec from cam where camera_key='wrist'")
def image_codec(spark: SparkSession, sf: str) -> DataFrame:
    rows = camera_table(spark, sf).where("camera_key = 'wrist'")
    return rows.select(SEGMENT, ORDINAL, images.image_codec(F.col("sample")).alias("codec"))


@query(
    f"""with {CAM} select segment_id, ordinal, case when k < 95 then cast(floor(value) as int) + 1 end height, case when k < 95 then cast(k as int) + 16 end width
 from cam where camera_key='wrist'"""
)
def image_size(spark: SparkSession, sf: str) -> DataFrame:
    rows = camera_table(spark, sf).where("camera_key = 'wrist'")
    return rows.select(SEGMENT, ORDINAL, images.image_size(F.col("sample")).alias("s")).select(SEGMENT, ORDINAL, "s.*")


@query(f"with {CAM} select segment_id, ordinal, {PROBED} codec from cam where camera_key='front'")
def video_codec_probe(spark: SparkSession, sf: str) -> DataFrame:
    rows = camera_table(spark, sf).where("camera_key = 'front'")
    return rows.select(SEGMENT, ORDINAL, images.video_codec_probe(F.col("sample")).alias("codec"))


def _golomb(value: Column) -> Column:
    bits = F.bin(value + 1)
    return F.concat(F.repeat(F.lit("0"), F.length(bits) - 1), bits)


def h264_packet(across: Column, down: Column) -> Column:
    """A packet that opens with a baseline parameter set, for so many blocks of 16 pixels."""
    one = [F.lit("1"), F.lit("1"), F.lit("011"), F.lit("010"), F.lit("0")]
    bits = F.concat(*one, _golomb(across.cast("long") - 1), _golomb(down.cast("long") - 1), F.lit("11001"))
    size = (F.ceil(F.length(bits) / 8) * 8).cast("int")
    body = F.lpad(F.conv(F.rpad(bits, size, F.lit("0")), 2, 16), F.call_function("div", size, F.lit(4)).cast("int"), F.lit("0"))
    return F.concat(_bytes("000000016742001E"), F.unhex(body), _bytes("0000000165"), F.encode("props", "UTF-8"))


def sized_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """The camera table with parameter sets in all packets and PNG headers in all images."""
    key, k, value = F.col("camera_key"), F.col("k"), F.col("value")
    packet = h264_packet(k + 1, F.floor(value) + 1)
    png = F.concat(_bytes("89504E470D0A1A0A0000000D49484452"), _number(k + 16), _number(F.floor(value) + 1), _bytes("0802000000"))
    sample = F.when(key == "front", packet).when(key == "wrist", png).otherwise(F.col("sample"))
    return camera_table(spark, sf).withColumn("sample", sample)


def wide_recording(spark: SparkSession, sf: str) -> DataFrame:
    """The recording with three cameras as columns."""
    key = F.col("camera_key")
    held = sized_cameras(spark, sf).select(
        SEGMENT,
        ORDINAL,
        F.when(key == "front", F.col("sample")).alias("/cam/front:VideoStream:sample"),
        F.when(key == "wrist", F.array("sample")).alias("/cam/wrist:EncodedImage:blob"),
        F.when(key == "depth", F.col("sample")).alias("/cam/depth:Image:buffer"),
        F.col("format").alias("/cam/depth:Image:format"),
    )
    return t.recording(spark, sf).join(held, [SEGMENT, ORDINAL], "left")


@query(f"with {CAM} select segment_id, ordinal, 'h264' codec, 16 * (cast(floor(value) as int) + 1) height, 16 * (cast(k as int) + 1) width from cam where camera_key='front'")
def stream_size(spark: SparkSession, sf: str) -> DataFrame:
    """Size of every packet that carries a parameter set."""
    from framewright.functions import video

    rows = sized_cameras(spark, sf).where("camera_key = 'front'").withColumn("codec", images.video_codec_probe(F.col("sample")))
    return rows.select(SEGMENT, ORDINAL, "codec", video.stream_size(F.col("sample"), F.col("codec")).alias("s")).select(SEGMENT, ORDINAL, "codec", "s.*")


@query(
    f"""with {CAM}, f as (select segment_id, camera_key, arg_min(k, ordinal) k, arg_min(floor(value), ordinal) v from cam group by 1, 2)
 select segment_id, 'observation.images.' || camera_key feature, case camera_key when 'wrist' then 'image' else 'video' end dtype,
 case camera_key when 'front' then 16 * (cast(v as bigint) + 1) when 'wrist' then cast(v as bigint) + 1 else 2 end height,
 case camera_key when 'front' then 16 * (cast(k as bigint) + 1) when 'wrist' then cast(k as bigint) + 16 else 2 end width, 3 channels from f"""
)
def camera_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature of every camera of every segment, from its own first sample."""
    rows = sized_cameras(spark, sf)
    key = F.col("camera_key")
    kinds = rows.select(*KEYS).distinct().withColumn("path", F.concat(F.lit("/cam/"), key))
    kinds = kinds.withColumn("kind", F.when(key == "front", "video").when(key == "wrist", "encoded_image").otherwise("raw_image"))
    samples = cameras.first_samples(rows)
    found = cameras.camera_features(cameras.resolve_cameras(kinds, samples, None, KEYS), samples, KEYS)
    shape = F.col("shape")
    return found.select(SEGMENT, "feature", "dtype", shape[0].alias("height"), shape[1].alias("width"), shape[2].alias("channels"))


@query(f"with {CAM} select segment_id, camera_key, ordinal, time_ns from cam")
def camera_index(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of three cameras of a wide recording, found in one pass."""
    from framewright.sources import recordings as rec

    found = rec.camera_index(wide_recording(spark, sf), [(f"/cam/{c}", c, TIME) for c in ALL])
    return found.where("size_bytes > 0").select(*KEYS, ORDINAL, TIME)


@query(
    f"""with {CAM} select segment_id, ordinal, cast(case when k < 30 then 4 when k < 60 then 3 else 1 end as int) channels,
 case when k < 30 then 'RGBA' when k < 60 then 'RGB' else 'L' end color_model,
 case when k >= 95 then 'buffer size does not match the format' end error from cam where camera_key='depth'"""
)
def raw_channels(spark: SparkSession, sf: str) -> DataFrame:
    rows = camera_table(spark, sf).where("camera_key = 'depth'")
    found = images.raw_channels(F.col("sample"), F.col("format.width"), F.col("format.height"))
    return rows.select(SEGMENT, ORDINAL, found.alias("r")).select(SEGMENT, ORDINAL, "r.*")


@query(
    f"""with {CAM}, d as (select segment_id, ordinal, k, upper(md5(props || '-' || cast(ordinal as varchar))) h from cam where camera_key='depth'),
 p as (select *, list_transform(range(4), lambda i: case when k < 30 then h[cast(i*8+1 as int):cast(i*8+6 as int)]
  when k < 60 then h[cast(i*6+1 as int):cast(i*6+6 as int)] else repeat(h[cast(i*2+1 as int):cast(i*2+2 as int)], 3) end) px from d)
 select segment_id, ordinal, cast(case when k < 30 then 4 when k < 60 then 3 else 1 end as int) channels,
 case when k < 95 then array_to_string(px, '') end rgb, case when k >= 95 then 'buffer size does not match the format' end error from p"""
)
def raw_to_rgb(spark: SparkSession, sf: str) -> DataFrame:
    rows = cameras.decode_raw(camera_table(spark, sf).where("camera_key = 'depth'"))
    return rows.select(SEGMENT, ORDINAL, "channels", F.hex("image.data").alias("rgb"), "error")


@query(
    f"""with {CAM} select segment_id, camera_key, ordinal, true same, case when camera_key = 'front' then
 upper(md5(unhex(case when k < 10 then '0000000140010C' when k < 20 then '12000A0B' when k < 25 then 'FFFF' else '0000000167420000' end || hex(encode(props))))) end digest from cam"""
)
def blob_to_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every camera that arrive as a list of lists of numbers."""
    rows = camera_table(spark, sf)
    digits = F.hex("sample")
    places = F.sequence(F.lit(0), F.octet_length("sample") - 1)
    numbers = F.transform(places, lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    nested = rows.select(*KEYS, ORDINAL, "sample", F.array(numbers).alias("blob"))
    back = images.blob_to_bytes(F.col("blob"), nested.schema["blob"].dataType)
    made = nested.select(*KEYS, ORDINAL, "sample", back.alias("back"))
    digest = F.when(F.col("camera_key") == "front", F.upper(F.md5("back")))
    return made.select(*KEYS, ORDINAL, (F.col("sample") == F.col("back")).alias("same"), digest.alias("digest"))


FORMATS = f"""with {CAM}, r as (select segment_id, ordinal, case camera_key when 'front' then 'video' when 'wrist' then 'encoded_image' else 'raw_image' end kind,
 case camera_key when 'front' then {PROBED} when 'wrist' then {STILL} end codec,
 case when value > 20 then case cast(k as int) % 7 when 0 then 'PNG' when 1 then 'h264' when 2 then 'HEVC' when 3 then 'av1' when 4 then 'jpg' when 5 then 'gif' end end req from cam),
 v as (select *, case when lower(req) in ('png','h264','hevc','av1') then lower(req) end fmt from r),
 o as (select *, coalesce(fmt, case when kind='video' then codec when kind='encoded_image' and codec='png' then 'png' end, 'h264') out from v)"""


def asked(spark: SparkSession, sf: str) -> DataFrame:
    """Every camera row with a kind, a codec and a requested format."""
    rows = camera_table(spark, sf)
    key = F.col("camera_key")
    kind = F.when(key == "front", "video").when(key == "wrist", "encoded_image").otherwise("raw_image")
    codec = F.when(key == "front", images.video_codec_probe(F.col("sample"))).when(key == "wrist", images.image_codec(F.col("sample")))
    listed = F.array(*[F.lit(x) for x in ("PNG", "h264", "HEVC", "av1", "jpg", "gif")])
    requested = F.when(F.col("value") > 20, F.get(listed, F.pmod(F.col("k").cast("int"), F.lit(7))))
    rows = rows.select(SEGMENT, ORDINAL, kind.alias("kind"), codec.alias("codec"), requested.alias("req"))
    rows = rows.withColumn("v", rules.validate_output_format(F.col("req")))
    return rows.withColumn("out", rules.resolve_output_format(F.col("kind"), F.col("codec"), F.col("v.format")))


@query(
    f"""{FORMATS} select segment_id, ordinal, fmt as format, case when req is null or fmt is not null then null when req='jpg' then 'jpeg frames cannot be stored'
 else 'unknown output format' end error from o"""
)
def validate_output_format(spark: SparkSession, sf: str) -> DataFrame:
    return asked(spark, sf).select(SEGMENT, ORDINAL, "v.format", "v.error")


@query(f"{FORMATS} select segment_id, ordinal, kind, codec, out from o")
def resolve_output_format(spark: SparkSession, sf: str) -> DataFrame:
    return asked(spark, sf).select(SEGMENT, ORDINAL, "kind", "codec", "out")


@query(f"{FORMATS} select segment_id, ordinal, case when out='png' then 'image' else 'video' end dtype from o")
def feature_dtype(spark: SparkSession, sf: str) -> DataFrame:
    return asked(spark, sf).select(SEGMENT, ORDINAL, rules.feature_dtype(F.col("out")).alias("dtype"))


@query(f"{FORMATS} select segment_id, ordinal, kind='video' and out <> 'png' and codec = out copies from o")
def can_remux(spark: SparkSession, sf: str) -> DataFrame:
    return asked(spark, sf).select(SEGMENT, ORDINAL, rules.can_copy(F.col("kind"), F.col("codec"), F.col("out")).alias("copies"))


@query(f"{FORMATS} select segment_id, ordinal, case fmt when 'hevc' then 'hevc' when 'av1' then 'libsvtav1' else 'h264' end encoder from o")
def dataset_vcodec(spark: SparkSession, sf: str) -> DataFrame:
    return asked(spark, sf).select(SEGMENT, ORDINAL, rules.dataset_encoder(F.col("v.format")).alias("encoder"))


@query(f"with {CAM} select segment_id, camera_key, ordinal from cam where k >= 25")
def non_null_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every camera that hold a frame, read from a wide recording."""
    from framewright.sources import recordings as rec

    rows = camera_table(spark, sf).withColumn("sample", F.when(F.col("k") >= 25, F.col("sample")))
    suffix = {"front": ":VideoStream:sample", "wrist": ":EncodedImage:blob", "depth": ":Image:buffer"}
    wide = rows.select(
        SEGMENT, ORDINAL, TIME, *[F.when(F.col("camera_key") == c, F.array("sample")).alias(f"/cam/{c}{s}") for c, s in suffix.items()]
    )
    parts = [rec.camera_reader(wide, f"/cam/{c}", c, TIME) for c in suffix]
    return rec.union_recordings(parts).select(SEGMENT, "camera_key", ORDINAL)


@query(
    f"""with {CAM} select segment_id, camera_key, ordinal, time_ns - time_ns % 1000000000 time_ns from cam where camera_key='wrist'"""
)
def camera_reader(spark: SparkSession, sf: str) -> DataFrame:
    """One camera on its own timeline, kept in whole seconds."""
    from framewright.sources import recordings as rec

    rows = camera_table(spark, sf).withColumn("video_time", F.floor(F.col(TIME) / 1_000_000_000).cast("double"))
    wide = rows.select(
        SEGMENT, ORDINAL, TIME, "video_time", F.when(F.col("camera_key") == "wrist", F.col("sample")).alias("/cam/wrist:EncodedImage:blob")
    )
    return rec.camera_reader(wide, "/cam/wrist", "wrist", "video_time").select(SEGMENT, "camera_key", ORDINAL, TIME)


@query(
    f"""with {CAM}, f as (select segment_id, camera_key, arg_min(k, ordinal) k from cam group by 1, 2),
 c as (select *, case camera_key when 'front' then 'video' when 'wrist' then 'encoded_image' else 'raw_image' end kind,
 case camera_key when 'front' then {PROBED} when 'wrist' then {STILL} end codec from f),
 o as (select *, case when kind='video' then codec when codec='png' then 'png' else 'h264' end out from c)
 select segment_id, camera_key, kind, codec source_codec, out output_format, 'observation.images.' || camera_key feature_key,
 case when out='png' then 'image' else 'video' end feature_dtype, kind='video' can_copy from o"""
)
def resolve_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """Every camera of every segment resolved from its own first sample."""
    rows = camera_table(spark, sf)
    kinds = rows.select(*KEYS).distinct()
    key = F.col("camera_key")
    kinds = kinds.withColumn("path", F.concat(F.lit("/cam/"), key)).withColumn(
        "kind", F.when(key == "front", "video").when(key == "wrist", "encoded_image").otherwise("raw_image")
    )
    resolved = cameras.resolve_cameras(kinds, cameras.first_samples(rows), None, KEYS)
    return resolved.select(*KEYS, "kind", "source_codec", "output_format", "feature_key", "feature_dtype", "can_copy")


INTERVALS = "i as (select segment_id, camera_key, time_ns - lag(time_ns) over (partition by segment_id, camera_key order by ordinal) d from cam)"
RATES = f"{INTERVALS}, rt as (select segment_id, camera_key, count(*) samples, median(d) m from i group by 1, 2)"


@query(f"with {CAM}, {RATES} select segment_id, camera_key, samples, round(coalesce(1e9/nullif(m, 0), 0)*1e6, 6) micro_fps from rt")
def source_fps(spark: SparkSession, sf: str) -> DataFrame:
    found = rates.source_fps(camera_table(spark, sf), KEYS)
    return found.select(*KEYS, "samples", F.round(F.col("source_fps") * 1e6, 6).alias("micro_fps"))


@query(f"with {CAM}, {RATES} select segment_id, camera_key, samples, round(coalesce(1e9/nullif(m, 0), 0)*1e6, 6) micro_fps from rt")
def source_fps_chunked(spark: SparkSession, sf: str) -> DataFrame:
    found = rates.source_fps(camera_table(spark, sf), KEYS, rows_per_chunk=5)
    return found.select(*KEYS, "samples", F.round(F.col("source_fps") * 1e6, 6).alias("micro_fps"))


# Cameras of the events give a frame every few hours; times are shrunk so that rates near 10 occur.
SHRINK = 1_300_000
FAST = f"""{CAM}, fast as (select segment_id, camera_key, ordinal, time_ns // {SHRINK} time_ns from cam),
 i as (select segment_id, camera_key, time_ns - lag(time_ns) over (partition by segment_id, camera_key order by ordinal) d from fast),
 rt as (select segment_id, camera_key, count(*) samples, median(d) m from i group by 1, 2),
 dc as (select *, samples >= 2 and m <> 0 and abs(1e9/m - 10)/10 <= 0.05 as near from rt)"""


def fast_cameras(spark: SparkSession, sf: str) -> DataFrame:
    return camera_table(spark, sf).withColumn(TIME, F.call_function("div", F.col(TIME), F.lit(SHRINK)))


@query(f"with {FAST} select segment_id, camera_key, near from dc")
def remux_decision(spark: SparkSession, sf: str) -> DataFrame:
    found = rates.source_fps(fast_cameras(spark, sf), KEYS)
    return found.select(*KEYS, rates.copy_decision(F.col("source_fps"), F.col("samples"), 10).alias("near"))


@query(
    f"""with {FAST}, p as (select segment_id, camera_key, samples, near and camera_key in ('front','wrist') copies from dc),
 w as (select segment_id, bool_and(copies) and count(*) = 3 copy_all from p group by segment_id)
 select segment_id, camera_key, samples, case when copies then 'copy' when camera_key='depth' then 'image' else 'encode' end mode, copy_all from p join w using (segment_id)"""
)
def episode_video_plan(spark: SparkSession, sf: str) -> DataFrame:
    resolved = spark.createDataFrame(
        [("front", True, "h264", "video"), ("wrist", True, "h264", "video"), ("depth", False, "png", "image")],
        "camera_key string, can_copy boolean, output_format string, feature_dtype string",
    )
    plan = rates.episode_video_plan(rates.source_fps(fast_cameras(spark, sf), KEYS), resolved, 10)
    return plan.select(*KEYS, "samples", "mode", "copy_all")


@query(
    f"""with {CAM} select segment_id, camera_key, ordinal, row_number() over (partition by segment_id, camera_key order by ordinal) - 1 packet_index,
 time_ns - first_value(time_ns) over (partition by segment_id, camera_key order by ordinal) pts_ns from cam"""
)
def packet_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return cameras.packet_manifest(camera_table(spark, sf)).select(*KEYS, ORDINAL, "packet_index", "pts_ns")


@query(
    f"""with {FAST}, st as (select segment_id, camera_key, arg_min(time_ns, ordinal) f from fast group by 1, 2)
 select segment_id, camera_key, ordinal, time_ns - f pts_ns, octet_length(encode(props)) + case when k < 10 then 7 when k < 20 then 4 when k < 25 then 2 else 8 end bytes
 from fast join dc using (segment_id, camera_key) join st using (segment_id, camera_key) join (select segment_id, camera_key, ordinal, k, props from cam) using (segment_id, camera_key, ordinal)
 where near and camera_key = 'front'"""
)
def copied_packets(spark: SparkSession, sf: str) -> DataFrame:
    """Packets of the video cameras whose rate is near the target."""
    rows = fast_cameras(spark, sf)
    found = rates.source_fps(rows, KEYS).where("camera_key = 'front'")
    near = found.where(rates.copy_decision(F.col("source_fps"), F.col("samples"), 10)).select(*KEYS)
    packets = cameras.copied_packets(rows, near)
    return packets.select(*KEYS, ORDINAL, "pts_ns", F.octet_length("sample").cast("long").alias("bytes"))


TARGETS = f"""{CAM}, tg as (select segment_id, ordinal, time_ns, row_number() over (partition by segment_id order by time_ns, ordinal) - 1 frame_index
 from ev where event_type='click')"""


def asof_sql(targets: str, frames: str) -> str:
    """Latest frame of every camera for every target, clamped at the head."""
    return f"""fl as (select segment_id, camera_key, time_ns, max(ordinal) o from {frames} group by 1, 2, 3),
 hd as (select segment_id, camera_key, arg_min(ordinal, {{'t': time_ns, 'o': ordinal}}) o from {frames} group by 1, 2),
 tc as (select x.*, c.camera_key from {targets} x, (values ('front'),('wrist'),('depth')) c(camera_key)),
 al as (select tc.segment_id, tc.camera_key, tc.frame_index, coalesce(fl.o, hd.o) frame_ordinal from tc asof left join fl
 on tc.segment_id=fl.segment_id and tc.camera_key=fl.camera_key and tc.time_ns >= fl.time_ns
 left join hd on tc.segment_id=hd.segment_id and tc.camera_key=hd.camera_key)"""


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return align.latest_at(t.recording(spark, sf), [A], A)


ALL = ["front", "wrist", "depth"]


@query(f"with {TARGETS}, {asof_sql('tg', 'cam')} select * from al")
def camera_align(spark: SparkSession, sf: str) -> DataFrame:
    rows = cameras.camera_align(targets(spark, sf), camera_table(spark, sf), ALL)
    return rows.select(*KEYS, "frame_index", "frame_ordinal")


@query(f"with {TARGETS}, {asof_sql('tg', 'cam')} select * from al")
def camera_align_chunked(spark: SparkSession, sf: str) -> DataFrame:
    rows = cameras.camera_align(targets(spark, sf), camera_table(spark, sf), ALL, rows_per_chunk=30)
    return rows.select(*KEYS, "frame_index", "frame_ordinal")


# The cameras' own clock runs in an unsorted order: their times are mirrored within the day.
OWN = """own as (select segment_id, camera_key, ordinal, time_ns - time_ns % 86400000000000 + (86400000000000 - time_ns % 86400000000000) time_ns from cam),
 ob as (select segment_id, camera_key, min(time_ns) lo, arg_min(time_ns, ordinal) f from own group by 1, 2),
 mv as (select segment_id, camera_key, ordinal, time_ns - case when camera_key='front' then f else lo end time_ns from own join ob using (segment_id, camera_key)),
 te as (select segment_id, ordinal, frame_index, time_ns - min(time_ns) over (partition by segment_id) time_ns from tg)"""


@query(f"with {TARGETS}, {OWN}, {asof_sql('te', 'mv')} select * from al")
def camera_align_elapsed(spark: SparkSession, sf: str) -> DataFrame:
    """All cameras on a timeline of their own; the video starts at its first stored packet, images at the earliest."""
    day = F.lit(86_400_000_000_000)
    within = F.pmod(F.col(TIME), day)
    own = camera_table(spark, sf).withColumn(TIME, F.col(TIME) - within + (day - within))
    rows = cameras.camera_align(targets(spark, sf), own, ALL, elapsed=ALL, video=["front"])
    return rows.select(*KEYS, "frame_index", "frame_ordinal")


MIXED = """mx as (select segment_id, camera_key, ordinal, time_ns from mv where camera_key='front' union all select segment_id, camera_key, ordinal, time_ns from cam where camera_key <> 'front')"""


@query(
    f"""with {TARGETS}, {OWN}, {MIXED}, fl as (select segment_id, camera_key, time_ns, max(ordinal) o from mx group by 1, 2, 3),
 hd as (select segment_id, camera_key, arg_min(ordinal, {{'t': time_ns, 'o': ordinal}}) o from mx group by 1, 2),
 tc as (select segment_id, 'front' camera_key, frame_index, time_ns from te union all select segment_id, c, frame_index, time_ns from tg, (values ('wrist'),('depth')) v(c))
 select tc.segment_id, tc.camera_key, tc.frame_index, coalesce(fl.o, hd.o) frame_ordinal from tc asof left join fl
 on tc.segment_id=fl.segment_id and tc.camera_key=fl.camera_key and tc.time_ns >= fl.time_ns
 left join hd on tc.segment_id=hd.segment_id and tc.camera_key=hd.camera_key"""
)
def camera_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """One camera names its own timeline, the others take that of the configuration."""
    specs = [VideoSpec("front", "/cam/front", index="video_time"), VideoSpec("wrist", "/cam/wrist"), VideoSpec("depth", "/cam/depth")]
    config = dataclasses.replace(CONFIG, videos=specs)
    elapsed = [v.key for v in specs if config.camera_timeline(v) != config.index_column]
    day = F.lit(86_400_000_000_000)
    within = F.pmod(F.col(TIME), day)
    mirrored = F.col(TIME) - within + (day - within)
    own = camera_table(spark, sf)
    own = own.withColumn(TIME, F.when(F.col("camera_key").isin(elapsed), mirrored).otherwise(F.col(TIME)))
    rows = cameras.camera_align(targets(spark, sf), own, ALL, elapsed=elapsed, video=["front"])
    return rows.select(*KEYS, "frame_index", "frame_ordinal")


@query(f"with {TARGETS}, {asof_sql('tg', 'cam')} select distinct segment_id, camera_key, frame_ordinal ordinal from al")
def frame_pick(spark: SparkSession, sf: str) -> DataFrame:
    rows = camera_table(spark, sf)
    picked = cameras.frame_pick(cameras.camera_align(targets(spark, sf), rows, ALL), rows)
    return picked.select(*KEYS, ORDINAL)


@query(
    f"""with {TARGETS}, r as (select segment_id, camera_key, count(*) n from cam group by 1, 2),
 {asof_sql('tg', 'cam')}, e as (select segment_id, row_number() over (order by segment_id) - 1 episode_index from (select distinct segment_id from tg))
 select episode_index, camera_key, frame_index, frame_ordinal from al join e using (segment_id)"""
)
def convert_with_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """A conversion of a wide recording with three cameras: the frame of every camera for every row."""
    config = dataclasses.replace(CONFIG, videos=[VideoSpec(k, f"/cam/{k}") for k in ALL])
    done = convert.convert_dataset(wide_recording(spark, sf), config)
    return done.camera_frames.select("episode_index", "camera_key", "frame_index", "frame_ordinal")
