from __future__ import annotations

import json
import struct

import pytest
from pyspark.sql import functions as F

from framewright import ConversionConfig, VideoSpec, convert_catalog, convert_dataset, convert_directory, write_dataset
from framewright.session import stage
from framewright.sources import recordings as rec
from framewright.sources import sinks

SCHEMA = "segment_id string, ordinal long, time_ns long, a array<float>, s array<float>, task array<string>"
CONFIG = ConversionConfig(fps=10, index_column="time_ns", action="a", state="s", task="task", task_default="idle")

ROWS = [
    # a first segment that is fine
    ("a-good", 0, 0, [1.0], [5.0], ["lift"]),
    ("a-good", 1, 100_000_000, [2.0], None, None),
    ("a-good", 2, 200_000_000, [3.0], [6.0], ["drop"]),
    ("b-no-state", 0, 0, [9.0], None, None),
    ("c-no-action", 0, 0, None, [1.0], None),
    ("d-wrong-dim", 0, 0, [9.0, 9.0], [1.0], None),
    ("d-wrong-dim", 1, 1, [9.0], [1.0], None),
    ("e-hole", 0, 0, [9.0], [None], None),
    ("f-hidden-fault", 0, 0, None, [1.0, 2.0], None),
    ("f-hidden-fault", 1, 1, None, [1.0], None),
    ("f-hidden-fault", 2, 2, [4.0], None, ["drop"]),
    ("g-empty", 0, 0, [4.0], [4.0], None),
]


@pytest.fixture(scope="module")
def recording(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("limit", [2, 1000])
def test_faulty_segments_are_set_aside(spark, recording, limit):
    sizes = spark.createDataFrame([("a-good", 10), ("g-empty", 0)], "segment_id string, size_bytes long")
    config = ConversionConfig(**{**CONFIG.__dict__, "rows_per_chunk": limit})
    done = convert_dataset(recording, config, sizes=sizes)
    status = {r.segment_id: (r.status, r.reason) for r in done.status.collect()}
    assert {k: v[0] for k, v in status.items()} == {
        "a-good": "converted",
        "b-no-state": "failed",
        "c-no-action": "empty",
        "d-wrong-dim": "failed",
        "e-hole": "converted",
        "f-hidden-fault": "converted",
        "g-empty": "skipped",
    }
    assert "no values" in status["b-no-state"][1]
    assert status["d-wrong-dim"][1] == "action has dim 2 but expected 1"
    summary = done.summary().collect()[0]
    assert (summary.episodes, summary.frames, summary.empty, summary.skipped) == (3, 5, 1, 3)

    frames = done.frames.orderBy("index").collect()
    assert [r["index"] for r in frames] == [0, 1, 2, 3, 4]
    assert [r.episode_index for r in frames] == [0, 0, 0, 1, 2]
    assert [r.frame_index for r in frames] == [0, 1, 2, 0, 0]
    assert [r.task for r in frames] == ["lift", "lift", "drop", "idle", "drop"]
    assert [r.task_index for r in frames] == [0, 0, 1, 2, 1]
    assert [round(r.timestamp, 6) for r in frames] == [0.0, 0.1, 0.2, 0.0, 0.0]
    tasks = done.episode_tasks().orderBy("episode_index", "position").collect()
    assert [(r.episode_index, r.position, r.task) for r in tasks] == [(0, 0, "lift"), (0, 1, "drop"), (1, 0, "idle"), (2, 0, "drop")]


def test_selection_of_segments(recording):
    done = convert_dataset(recording, CONFIG, segments=["g-empty", "a-good", "zz"], max_segments=2)
    assert [r.segment_id for r in done.episodes.orderBy("episode_index").collect()] == ["g-empty", "a-good"]
    order = [r.segment_id for r in done.status.orderBy("seg_pos").collect()]
    assert order == ["g-empty", "a-good"]


def test_a_faulty_first_segment_raises(recording):
    with pytest.raises(ValueError, match="state"):
        convert_dataset(recording, CONFIG, segments=["b-no-state"])
    with pytest.raises(ValueError):
        convert_dataset(recording.limit(0), CONFIG)


def test_several_columns_in_one_vector(spark):
    rows = [("x", i, i, [[1.0, 2.0, 3.0]], [[4.0, 5.0, 6.0, 7.0]]) for i in range(3)]
    df = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long, p array<array<double>>, r array<array<double>>")
    config = ConversionConfig(fps=10, index_column="time_ns", action=["p", "r"], state="r", action_names=list("abcdefg"))
    done = convert_dataset(df, config)
    assert done.features["action"]["shape"] == [7] and done.features["observation.state"]["shape"] == [4]
    assert done.frames.collect()[0].action == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(ValueError, match="names"):
        convert_dataset(df, ConversionConfig(fps=10, index_column="time_ns", action="p", state="r", action_names=["a"]))


def test_written_dataset(spark, recording, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    recording.write.parquet(source)
    convert_directory(spark, source, out, CONFIG)
    data = spark.read.parquet(f"{out}/data").orderBy("index").collect()
    assert [r.action for r in data] == [1.0, 2.0, 3.0, 9.0, 4.0, 4.0]
    assert spark.read.parquet(f"{out}/meta/episodes").count() == 4
    info = json.loads(spark.read.text(f"{out}/meta/info").collect()[0].value)
    assert info["fps"] == 10 and info["total_frames"] == 6 and info["total_episodes"] == 4
    assert info["features"]["action"]["shape"] == [1]
    stats = spark.read.parquet(f"{out}/meta/episode_stats").where("episode_index = 0 and feature = 'action'").collect()[0]
    assert (stats.min, stats.max, stats.mean, stats["count"]) == ([1.0], [3.0], [2.0], [3])
    with pytest.raises(ValueError, match="exists"):
        convert_directory(spark, source, out, CONFIG)
    spark.read.parquet(source).createOrReplaceTempView("some_recording")
    convert_catalog(spark, "some_recording", str(tmp_path / "again"), CONFIG)
    assert spark.read.parquet(str(tmp_path / "again/data")).count() == 6


def test_a_partial_output_is_refused(spark, recording, tmp_path):
    source, out = str(tmp_path / "in"), tmp_path / "out"
    recording.write.parquet(source)
    out.mkdir()
    with pytest.raises(ValueError, match="exists"):
        convert_directory(spark, source, str(out), CONFIG)


def test_missing_directory_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        rec.read_recordings(spark, str(tmp_path / "nowhere"))


def test_files_as_segments(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "r"))
    names = {r.segment_id for r in rec.read_recordings(spark, str(tmp_path / "r")).collect()}
    assert len(names) == 1 and next(iter(names)).startswith("part-")


def test_recordings_of_different_columns(spark, tmp_path):
    root = tmp_path / "a folder"
    for folder, column in (("run1", "/a:S:s"), ("run 2+%", "/b:S:s")):
        (root / folder).mkdir(parents=True)
        spark.range(2).withColumnRenamed("id", column).toPandas().to_parquet(root / folder / "rec.parquet")
    got = rec.read_recordings(spark, str(root))
    rows = {(r.segment_id, r["/a:S:s"], r["/b:S:s"]) for r in got.collect()}
    assert rows == {("run1/rec", 0, None), ("run1/rec", 1, None), ("run 2+%/rec", None, 0), ("run 2+%/rec", None, 1)}
    one = rec.read_recordings(spark, f"file://{root}/run1/rec.parquet")
    assert {r.segment_id for r in one.collect()} == {"rec"}


def test_recordings_stored_by_segment(spark, tmp_path):
    path = str(tmp_path / "by")
    rows = spark.createDataFrame([("007", 1), ("8", 2)], "segment_id string, v long")
    rows.write.partitionBy("segment_id").parquet(path)
    got = rec.read_recordings(spark, path)
    assert {(r.segment_id, r.v) for r in got.collect()} == {("007", 1), ("8", 2)}
    some = got.where("segment_id = '007'")
    plan = some._jdf.queryExecution().toString()
    assert some.count() == 1 and "PartitionFilters: [isnotnull(segment_id" in plan


def png(i):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 24, 16) + bytes([8, 2, 0, 0, 0, i])


def jpeg(i):
    return b"\xff\xd8\xff\xc0" + struct.pack(">HBHH", 17, 8, 16, 24) + b"\x03" + b"\0" * 9 + bytes([i])


@pytest.fixture(scope="module")
def images(spark):
    rows = [
        ("x", i, i, [float(i), float(i + 1)], [-float(i)], [jpeg(i)], [png(i)], [bytes([30 * i]) * (16 * 24 * 3)], (24, 16))
        for i in range(6)
    ]
    schema = (
        "segment_id string, ordinal long, frame long, `/action:Scalars:scalars` array<float>, `/state:Scalars:scalars` array<float>,"
        " `/cam/jpeg:EncodedImage:blob` array<binary>, `/cam/png:EncodedImage:blob` array<binary>, `/cam/raw:Image:buffer` array<binary>,"
        " `/cam/raw:Image:format` struct<width:int,height:int>"
    )
    return spark.createDataFrame(rows, schema)


def image_config(**changes):
    base = {
        "fps": 10,
        "index_column": "frame",
        "action": "/action:Scalars:scalars",
        "state": "/state:Scalars:scalars",
        "videos": [VideoSpec(k, f"/cam/{k}") for k in ("jpeg", "png", "raw")],
    }
    return ConversionConfig(**{**base, **changes})


def test_image_cameras(images):
    kept = convert_dataset(images, image_config())
    dtypes = {k: v["dtype"] for k, v in kept.features.items() if "images" in k}
    assert dtypes == {"observation.images.jpeg": "video", "observation.images.png": "image", "observation.images.raw": "video"}
    forced = convert_dataset(images, image_config(output_format="png"))
    for key in ("jpeg", "png", "raw"):
        feature = forced.features[f"observation.images.{key}"]
        assert (feature["dtype"], feature["shape"]) == ("image", [16, 24, 3])
    picked = forced.camera_frames.collect()
    assert len(picked) == 18 and all(r.frame_ordinal == r.frame_index for r in picked)
    assert {(r.camera_key, r["mode"]) for r in forced.camera_plan.collect()} == {("jpeg", "image"), ("png", "image"), ("raw", "image")}


def test_an_entity_without_frames_raises(images):
    with pytest.raises(ValueError, match="no supported frames"):
        convert_dataset(images, image_config(videos=[VideoSpec("none", "/cam/none")]))


def video_tables(spark, second_camera=False):
    step = 100_000_000
    packet = b"\0\0\0\1\x67\x42\0\x1e"
    rows, frames = [], []
    for segment, base in (("one", 0), ("two", 100)):
        for i in range(6):
            rows.append((segment, i, i * step, [float(base + i), float(base + i + 1)], [-float(i)], None, None))
            frames.append((segment, "front", i, i * step, packet + bytes([i]), (32, 32)))
            if second_camera:
                frames.append((segment, "raw", 100 + i, i * step, bytes(12), (2, 2)))
    schema = (
        "segment_id string, ordinal long, frame long, `/a:Scalars:scalars` array<float>, `/s:Scalars:scalars` array<float>,"
        " `/cam:VideoStream:sample` binary, `/raw:Image:buffer` binary"
    )
    cameras = "segment_id string, camera_key string, ordinal long, time_ns long, sample binary, format struct<width:int,height:int>"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(frames, cameras)


@pytest.mark.parametrize("mixed", [False, True])
def test_video_episodes(spark, mixed, tmp_path):
    recording, frames = video_tables(spark, mixed)
    videos = [VideoSpec("front", "/cam")] + ([VideoSpec("raw", "/raw")] if mixed else [])
    config = ConversionConfig(fps=10, index_column="frame", action="/a:Scalars:scalars", state="/s:Scalars:scalars", videos=videos)
    done = convert_dataset(recording, config, cameras=frames)
    assert done.episodes.count() == 2 and done.frames.count() == 12
    plan = {(r.segment_id, r.camera_key): (r["mode"], r.copy_all) for r in done.camera_plan.collect()}
    assert plan[("one", "front")] == ("copy", not mixed)
    packets = done.packets.where("segment_id = 'two'").orderBy("packet_index").collect()
    assert [(r.packet_index, r.pts_ns, r.camera_key) for r in packets] == [(i, i * 100_000_000, "front") for i in range(6)]
    assert done.camera_frames.count() == (24 if mixed else 0)
    out = str(tmp_path / "out")
    write_dataset(done, out)
    written = spark.read.parquet(f"{out}/videos/packets")
    assert written.count() == 12 and written.where(F.octet_length("sample") == 9).count() == 12
    assert spark.read.parquet(f"{out}/images/frames").count() == (12 if mixed else 0)


def test_a_segment_without_frames_fails(spark):
    recording, frames = video_tables(spark)
    config = ConversionConfig(
        fps=10, index_column="frame", action="/a:Scalars:scalars", state="/s:Scalars:scalars", videos=[VideoSpec("front", "/cam")]
    )
    done = convert_dataset(recording, config, cameras=frames.where("segment_id = 'one'"))
    status = {r.segment_id: r.reason for r in done.status.collect()}
    assert status == {"one": None, "two": "no samples for camera 'front'"}


def test_files_of_different_types(spark, tmp_path):
    """Whole and float columns, lists and structs take the least type that holds them; folders name the segment."""
    root = str(tmp_path / "odd 1")
    first = ["cast(id as int) id", "cast(id as float) v", "array(cast(id as int)) l", "named_struct('x', cast(id as int), 'y', 1) s", "'only here' w"]
    second = ["id", "id / 3 v", "array(id * 5000000000) l", "named_struct('y', 2, 'x', id * 5000000000) s"]
    spark.range(3).selectExpr(*first).write.parquet(f"{root}/segment_id=007")
    spark.range(3).selectExpr(*second).write.parquet(f"{root}/segment_id=a [b]")
    got = rec.read_recordings(spark, root)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "id": "bigint", "v": "double", "l": "array<bigint>", "s": "struct<x:bigint,y:int>", "w": "string", "segment_id": "string",
    }
    rows = {(r.segment_id, r.id): (r.v, r.l, r.s.x, r.s.y, r.w) for r in got.collect()}
    assert rows == {("007", i): (float(i), [i], i, 1, "only here") for i in range(3)} | {
        ("a [b]", i): (i / 3, [i * 5_000_000_000], i * 5_000_000_000, 2, None) for i in range(3)
    }
    spark.range(3).selectExpr("'text' v").write.parquet(f"{root}/segment_id=b")
    with pytest.raises(ValueError, match="'v'"):
        rec.read_recordings(spark, root)


def test_files_by_address(spark, tmp_path):
    frames = spark.range(0, 1000, 1, 7).selectExpr("999 - id as index", "array(id) one")
    sinks.write_frames(frames, str(tmp_path / "d"), squeeze=["one"], rows_per_file=300)
    read = spark.read.parquet(str(tmp_path / "d" / "data"))
    files = read.groupBy(F.input_file_name().alias("f")).agg(F.min("index").alias("a"), F.count("*").alias("n"), F.max("index").alias("z"))
    assert sorted((r.a, r.n, r.z) for r in files.collect()) == [(0, 300, 299), (300, 300, 599), (600, 300, 899), (900, 100, 999)]
    assert read.schema["one"].dataType.simpleString() == "bigint"
    sinks.write_episodes(spark.createDataFrame([], "episode_index long"), str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e" / "meta" / "episodes")).count() == 0


def test_sizes_and_ranges_from_files(spark, tmp_path, monkeypatch):
    """A file of several segments is shared by rows; ranges come from footers; null times and odd layouts."""
    both = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", 9)], "segment_id string, time_ns long").coalesce(1)
    both.write.parquet(str(tmp_path / "one"))
    size = sum(f.stat().st_size for f in (tmp_path / "one").glob("*.parquet"))
    got = rec.stored_sizes(rec.read_recordings(spark, str(tmp_path / "one")))
    assert {r.segment_id: (r.rows, r.size_bytes) for r in got.collect()} == {"a": (3, size * 3 // 4), "b": (1, size // 4)}
    by_file = rec.stored_sizes(rec.read_recordings(spark, str(tmp_path / "one"), segment="file"), segment="file").collect()
    assert [(r.rows, r.size_bytes) for r in by_file] == [(4, size)]

    both.where("time_ns is not null").write.partitionBy("segment_id").parquet(str(tmp_path / "full"))
    plans = []
    monkeypatch.setattr(rec, "stage", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or stage(df, label))
    ranges = rec.stored_ranges(spark, str(tmp_path / "full"), "time_ns")
    assert sorted(tuple(r) for r in ranges.collect()) == [("a", 1, 2, 2), ("b", 9, 9, 1)]
    assert len(plans) == 1 and "PushedAggregation: [MIN(time_ns), MAX(time_ns), COUNT(time_ns)]" in plans[0]

    both.unionByName(spark.createDataFrame([("007", None)], both.schema)).write.partitionBy("segment_id").parquet(str(tmp_path / "many"))
    ranges = rec.stored_ranges(spark, str(tmp_path / "many"), "time_ns")
    assert sorted((r.segment_id, r.min_ns, r.max_ns, r.rows) for r in ranges.collect()) == [("007", None, None, 0), ("a", 1, 2, 2), ("b", 9, 9, 1)]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    with pytest.raises(ValueError, match="folders"):
        rec.stored_ranges(spark, str(tmp_path / "one"), "time_ns", segment="run")
