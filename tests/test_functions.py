from __future__ import annotations

import math
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.config import ConversionConfig, VideoSpec
from framewright.functions import images, names, rules, times, vectors
from framewright.operators import align, profile


def one(df, column):
    return df.select(column.alias("x")).collect()[0].x


def test_split_dataset_url(spark):
    cases = {
        "data://hostname:443/entry/18B40C6F": ("data://hostname:443", "18B40C6F"),
        "data+http://localhost:9876/abc123": ("data+http://localhost:9876", "abc123"),
        "data://host:443/entry/xyz/": ("data://host:443", "xyz"),
        "data://host:443/a/b": None,
        "not-a-url": None,
        "data://host:443": None,
        "data:///entry/x": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", names.split_dataset_url(F.col("u")).alias("r"))
    for row in df.collect():
        expected = cases[row.u]
        assert (row.r.error is None) == (expected is not None), row.u
        assert (row.r.catalog_url, row.r.entry_id) == (expected or (None, None))


def test_names(spark):
    df = spark.createDataFrame([("/robot/action:Scalars:scalars", "/cam/front/", " a, b ,,c "), (None, "/", " , ")], "c string, p string, l string")
    rows = df.select(
        names.entity_path(F.col("c")).alias("e"),
        names.column_parts(F.col("c")).alias("parts"),
        names.video_key_guess(F.col("p")).alias("k"),
        names.parse_name_list(F.col("l")).alias("n"),
    ).collect()
    assert rows[0].e == "/robot/action" and tuple(rows[0].parts) == ("/robot/action", "Scalars", "scalars")
    assert (rows[0].k, rows[0].n) == ("front", ["a", "b", "c"])
    assert (rows[1].e, rows[1].k, rows[1].n) == (None, "cam", None)


def test_video_spec(spark):
    df = spark.createDataFrame([("front:/cam",), ("w:/cam:t",), ("bad",), ("a:b:c:d",)], "s string")
    rows = [tuple(r.v) for r in df.select(names.parse_video_spec(F.col("s")).alias("v")).collect()]
    assert rows[0] == ("front", "/cam", None, None) and rows[1] == ("w", "/cam", "t", None)
    assert rows[2][:3] == rows[3][:3] == (None, None, None) and rows[2][3] and rows[3][3]


def test_config():
    config = ConversionConfig(
        fps=10,
        index_column="t",
        action="/robot/action:Scalars:scalars",
        state=["/robot/state:Scalars:scalars", "/robot/action:Scalars:other"],
        task="/task:Text:text",
        videos=[VideoSpec("front", "/cam"), VideoSpec("w", "/w", index="vt")],
    )
    assert config.filter_list() == (["/robot/action", "/robot/state", "/task"], "/robot/action")
    assert config.action_columns == ["/robot/action:Scalars:scalars"]
    assert [config.camera_timeline(v) for v in config.videos] == ["t", "vt"]
    with pytest.raises(ValueError):
        ConversionConfig(fps=10, index_column="t", action="a", state="b", output_format="jpg")


def test_float32_vector(spark):
    df = spark.createDataFrame(
        [(5, [[1.0, 2.0, 3.0]], [1, None, 3], None)], "i int, m array<array<float>>, v array<int>, n array<int>"
    )
    row = df.select(*[vectors.float32_vector(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]).collect()[0]
    assert row.i == [5.0] and row.m == [1.0, 2.0, 3.0] and row.n is None
    assert row.v[0] == 1.0 and math.isnan(row.v[1])
    v = vectors.float32_vector(F.col("v"), df.schema["v"].dataType)
    n = vectors.float32_vector(F.col("n"), df.schema["n"].dataType)
    assert one(df, vectors.vector_error(v, 2, "action")) == "action has dim 3 but expected 2"
    assert one(df, vectors.vector_error(v, -1, "action")) is None
    assert "missing" in one(df, vectors.vector_error(n, 2, "action"))
    assert not vectors.castable_to_float32(T.ArrayType(T.StringType()))


def test_unwrap_and_task(spark):
    df = spark.createDataFrame([(["x"], b"caf\xc3\xa9"), (["x", "y"], b"\xff"), ([], None), (None, None)], "t array<string>, b binary")
    rows = df.select(
        vectors.unwrap_singleton(F.col("t")).alias("u"),
        vectors.task_text(F.col("t"), df.schema["t"].dataType, "none").alias("t"),
        vectors.task_text(F.col("b"), df.schema["b"].dataType, "none").alias("b"),
    ).collect()
    assert [r.u for r in rows] == ["x", None, None, None]
    assert [r.t for r in rows] == ["x", "x y", "none", "none"]
    assert [r.b for r in rows] == ["café", "none", "none", "none"]


def test_normalize_times(spark):
    df = spark.sql(
        "select timestamp_ntz'1970-01-02 00:00:01.000002' n, timestamp'1970-01-01 00:00:01Z' z,"
        " interval '1 02:03:04.5' day to second d, 2.5D f, 7L i"
    )
    row = df.select(*[times.normalize_times(df, c).alias(c) for c in df.columns]).collect()[0]
    assert row.n == 86_401_000_002_000 and row.z == 1_000_000_000
    assert row.d == (93_784 * 10 + 5) * 100_000_000 and row.f == 2_500_000_000 and row.i == 7
    with pytest.raises(ValueError):
        times.normalize_times(df, "z", strict_ns=True)


def test_wall_clock_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' n")
        assert one(df, times.normalize_times(df, "n")) == 1_710_037_800_000_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_grids(spark):
    df = spark.sql("select 'a' k, 0D min_s, 1D max_s union all select 'b', 1D, 1D")
    got = [(r.k, r.time_s) for r in align.time_grid_seconds(df, 4, keys=["k"]).orderBy("k", "grid_index").collect()]
    assert got == [("a", 0.0), ("a", 0.25), ("a", 0.5), ("a", 0.75), ("b", 1.0)]
    far = spark.sql("select 0L a, 9000000000000000001L b")
    assert one(far, times.grid_size_ns(F.col("a"), F.col("b"), 1_000_000_000)) == 9000000000000000001


@pytest.mark.parametrize(
    ("kind", "codec", "requested", "expected"),
    [
        ("video", "h264", "av1", "av1"),
        ("raw_image", None, "png", "png"),
        ("video", "h264", None, "h264"),
        ("video", "hevc", None, "hevc"),
        ("video", "av1", None, "av1"),
        ("video", "mpeg4", None, "h264"),
        ("encoded_image", "png", None, "png"),
        ("encoded_image", "jpeg", None, "h264"),
        ("raw_image", None, None, "h264"),
    ],
)
def test_output_format(spark, kind, codec, requested, expected):
    df = spark.createDataFrame([(kind, codec, requested)], "k string, c string, r string")
    fmt = rules.resolve_output_format(F.col("k"), F.col("c"), F.col("r"))
    assert one(df, fmt) == expected
    assert one(df, rules.feature_dtype(fmt)) == ("image" if expected == "png" else "video")
    assert one(df, rules.can_copy(F.col("k"), F.col("c"), fmt)) == (kind == "video" and codec == expected)


def test_requested_format(spark):
    df = spark.createDataFrame([("PNG",), ("jpg",), ("gif",), (None,)], "r string")
    rows = df.select(rules.validate_output_format(F.col("r")).alias("v")).collect()
    assert [r.v.format for r in rows] == ["png", None, None, None]
    assert [r.v.error is None for r in rows] == [True, False, False, True]


def png(width, height):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", width, height) + b"\x08\x02\0\0\0"


def jpeg(width, height):
    return b"\xff\xd8\xff\xe0\x00\x10JFIF\0" + b"\0" * 9 + b"\xff\xc0" + struct.pack(">HBHH", 17, 8, height, width) + b"\x03" + b"\0" * 9


def test_image_headers(spark):
    df = spark.createDataFrame([(png(24, 16),), (jpeg(640, 480),), (b"junk",), (None,)], "b binary")
    rows = df.select(images.image_codec(F.col("b")).alias("c"), images.image_size(F.col("b")).alias("s")).collect()
    assert [r.c for r in rows] == ["png", "jpeg", "unknown", None]
    assert [tuple(r.s) for r in rows] == [(16, 24), (480, 640), (None, None), (None, None)]


def test_raw_images(spark):
    rgb, grey, bgr = bytes(range(60)), bytes(range(20)), bytes([1, 2, 3] * 4)
    rows = [(rgb, 5, 4, "RGB"), (grey, 5, 4, "L"), (bgr, 2, 2, "BGR"), (b"abc", 5, 4, "RGB"), (bytes(range(16)), 2, 2, "RGBA")]
    df = spark.createDataFrame(rows, "b binary, w int, h int, m string")
    got = df.select(
        images.raw_to_rgb("b", "w", "h", "m").alias("x"), images.raw_channels(F.col("b"), F.col("w"), F.col("h")).alias("r")
    ).collect()
    assert bytes(got[0].x) == rgb
    assert bytes(got[1].x) == bytes(v for v in range(20) for _ in range(3))
    assert bytes(got[2].x) == bytes([3, 2, 1] * 4)
    assert got[3].x is None and got[3].r.error
    assert bytes(got[4].x) == bytes([0, 1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 14])
    assert [r.r.channels for r in got] == [3, 1, 3, 0, 4]


def test_codec_probe(spark):
    samples = {
        b"\0\0\0\1\x67\x42\x00\x1e": "h264",
        b"\0\0\1\x65\x88": "h264",
        b"\0\0\0\1\x09\xf0": "h264",
        b"\0\0\0\1\x40\x01\x0c": "hevc",
        b"\0\0\1\x42\x01": "hevc",
        b"\x12\x00\x0a\x0b": "av1",
        b"": "declared",
        b"????": "declared",
    }
    df = spark.createDataFrame([(k,) for k in samples], "b binary")
    got = {bytes(r.b): r.c for r in df.select("b", images.video_codec_probe(F.col("b"), F.lit("declared")).alias("c")).collect()}
    assert got == samples


def test_blob_to_bytes(spark):
    df = spark.createDataFrame([([b"ab"], [[97, 98]], [97, 98], b"ab")], "a array<binary>, n array<array<int>>, f array<int>, b binary")
    row = df.select(*[images.blob_to_bytes(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]).collect()[0]
    assert [bytes(v) for v in row] == [b"ab"] * 4


def test_position_is_kept_by_the_reader(spark):
    df = spark.createDataFrame([("s", 0, None, 1), ("s", 1, 4, None), ("s", 2, 5, 1)], "segment_id string, ordinal long, time_ns long, a int")
    assert [r.ordinal for r in align.index_reader(df, ["a"]).collect()] == [2]


def test_units_of_higher_layers_and_sequence_headers(spark):
    cases = {
        b"\0\0\0\1\x26\x01": "hevc",
        b"\0\0\1\x28\x01": "hevc",
        b"\0\0\1\x02\x03": "hevc",
        b"\0\0\1\x28\xee": "h264",
        b"\0\0\1\x06\x05": "h264",
        b"\0\0\1\x06\x01": "h264",
        b"\0\0\1\x65\x88": "h264",
        b"\x0a\x0b\0\0": "av1",
        b"": "h264",
    }
    df = spark.createDataFrame([(bytearray(b),) for b in cases], "b binary")
    got = {bytes(r.b): r.c for r in df.select("b", images.video_codec_probe(F.col("b")).alias("c")).collect()}
    assert got == cases


def test_values_beyond_range_are_null(spark):
    header = bytearray(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\x0dIHDR" + b"\xff\xff\xff\xff" + b"\0\0\0\x10")
    row = spark.createDataFrame([(header,)], "b binary").select(images.png_size(F.col("b")).alias("s")).first()
    assert (row.s.height, row.s.width) == (16, None)
    for kind in ("timestamp", "timestamp_ntz"):
        far = spark.sql(f"select cast('9999-01-01 00:00:00' as {kind}) as t union all select cast('1970-01-01 00:00:01' as {kind})")
        assert {r.n for r in far.select(times.normalize_times(far, "t").alias("n")).collect()} == {None, 1_000_000_000}


def test_rows_without_a_time_decide_no_dimension(spark):
    rows = spark.createDataFrame([("s", 0, None, [1.0, 2.0, 3.0]), ("s", 1, 5, [1.0, 2.0])], "segment_id string, ordinal long, time_ns long, a array<double>")
    assert [r.dim for r in profile.column_dim(rows, ["a"]).collect()] == [2]
    assert [r.a for r in profile.first_non_null(rows, "a").collect()] == [[1.0, 2.0]]
