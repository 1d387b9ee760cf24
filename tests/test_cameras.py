"""Sizes of videos, the camera index, and frames chosen by bitmaps."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from framewright import ConversionConfig, VideoSpec, convert_directory
from framewright.functions import video
from framewright.operators import cameras, rates
from framewright.plans.convert import convert_dataset
from framewright.session import stage
from framewright.sources import recordings as rec


class Writer:
    def __init__(self):
        self.bits = ""

    def put(self, value, count):
        self.bits += format(value, f"0{count}b") if count else ""
        return self

    def golomb(self, *values):
        for v in values:
            code = format(v + 1, "b")
            self.bits += "0" * (len(code) - 1) + code
        return self

    def bytes(self):
        bits = self.bits + "1"
        return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def guarded(data):
    """With the bytes that keep start codes from occurring inside."""
    out, zeros = bytearray(), 0
    for b in data:
        if zeros == 2 and b <= 3:
            out.append(3)
            zeros = 0
        out.append(b)
        zeros = zeros + 1 if b == 0 else 0
    return bytes(out)


def h264(width, height, *, profile=66, chroma=1, whole=1, order=2):
    x, y = {0: (1, 1), 1: (2, 2), 2: (2, 1), 3: (1, 1)}[chroma]
    across, down = -(-width // 16), -(-height // (16 * (2 - whole)))
    w = Writer().put(profile, 8).put(0, 8).put(30, 8).golomb(0)
    if profile == 100:
        w.golomb(chroma)
        w.put(0, 1 if chroma == 3 else 0).golomb(0, 0).put(0, 1).put(1, 1)
        for i in range(12 if chroma == 3 else 8):
            w.put(i % 2, 1)
            if i % 2:
                w.golomb(*[0] * (16 if i < 6 else 64))
    w.golomb(0, order)
    if order == 0:
        w.golomb(4)
    elif order == 1:
        w.put(0, 1).golomb(3, 4, 2, 1, 2)
    w.golomb(1).put(0, 1).golomb(across - 1, down - 1).put(whole, 1).put(0, 0 if whole else 1).put(1, 1)
    right, bottom = (across * 16 - width) // x, (down * 16 * (2 - whole) - height) // (y * (2 - whole))
    w.put(1, 1).golomb(0, right, 0, bottom).put(0, 1)
    return b"\0\0\0\1\x09\xf0\0\0\1\x67" + guarded(w.bytes()) + b"\0\0\1\x65rest"


def hevc(width, height, *, layers=0):
    w = Writer().put(0, 4).put(layers, 3).put(1, 1).put(0, 88).put(93, 8)
    for i in range(layers):
        w.put(i % 2, 1).put(1, 1)
    w.put(0, 2 * (8 - layers) if layers else 0)
    for i in range(layers):
        w.put(0, 88 * (i % 2) + 8)
    across, down = -(-width // 8) * 8, -(-height // 8) * 8
    w.golomb(0, 1, across, down).put(1, 1).golomb(0, (across - width) // 2, 0, (down - height) // 2).golomb(0, 0)
    return b"\0\0\0\1\x40\1\x0c\0\0\1\x42\1" + guarded(w.bytes()) + b"\0\0\1\x26\1rest"


def av1(width, height, *, reduced=0):
    w = Writer().put(0, 3).put(reduced, 1).put(reduced, 1)
    if reduced:
        w.put(4, 5)
    else:
        w.put(1, 1).put(1, 32).put(30, 32).put(1, 1).golomb(0).put(1, 1).put(9, 5).put(1, 32).put(9, 5).put(9, 5)
        w.put(1, 1).put(1, 5)
        for level in (4, 9):
            w.put(0, 12).put(level, 5).put(0, 1 if level > 7 else 0).put(1, 1).put(0, 21).put(1, 1).put(3, 4)
    body = w.put(15, 4).put(15, 4).put(width - 1, 16).put(height - 1, 16).bytes()
    return b"\x12\0" + bytes([0x0A, len(body)]) + body


@pytest.mark.parametrize("seed", range(40))
def test_size_of_streams(seed):
    rng = random.Random(seed)
    width, height = 2 * rng.randint(1, 2000), 4 * rng.randint(1, 1000)
    assert video.size_of(h264(width, height, order=seed % 3), "h264") == (height, width)
    assert video.size_of(h264(width, height, whole=0), "h264") == (height, width)
    assert video.size_of(h264(width, height, profile=100, chroma=seed % 4), "h264") == (height, width)
    assert video.size_of(hevc(width, height, layers=seed % 7), "hevc") == (height, width)
    assert video.size_of(av1(width, height, reduced=seed % 2), "av1") == (height, width)


def test_packets_without_a_size():
    whole = h264(640, 480)
    for data in (None, b"", b"\0\0\1", b"\0\0\1\x67", b"\0\0\1\x65 slice", whole[:14], b"\x12", b"\x0a\xff"):
        for codec in ("h264", "hevc", "av1", "unknown", None):
            assert video.size_of(data, codec) == (None, None) or data == whole[:14]


def wide(spark, first=None):
    packet = h264(320, 240)
    rows = [
        (s, i, i, [float(i), 1.0], [-float(i)], [first if i == 0 and first else packet + bytes([i])] if i % 2 == 0 else None)
        for s in ("one", "two")
        for i in range(12)
    ]
    schema = (
        "segment_id string, ordinal long, frame long, `/a:Scalars:scalars` array<float>, `/s:Scalars:scalars` array<float>,"
        " `/cam:VideoStream:sample` array<binary>"
    )
    return spark.createDataFrame(rows, schema)


def config(**changes):
    spec = VideoSpec("front", "/cam", **changes)
    return ConversionConfig(fps=10, index_column="frame", action="/a:Scalars:scalars", state="/s:Scalars:scalars", videos=[spec])


def test_directory_with_a_video_column(spark, tmp_path):
    """A recording with packets in a column, from files to files."""
    wide(spark).write.parquet(f"{tmp_path}/in")
    done = convert_directory(spark, f"{tmp_path}/in", f"{tmp_path}/out", config())
    feature = done.features["observation.images.front"]
    assert (feature["dtype"], feature["shape"]) == ("video", [240, 320, 3])
    assert {r.codec for r in spark.read.parquet(f"{tmp_path}/out/meta/cameras").selectExpr("output_format codec").collect()} == {"h264"}
    frames = spark.read.parquet(f"{tmp_path}/out/images/frames")
    assert frames.count() == 12 and frames.where("sample is null").isEmpty()


def test_declared_size(spark):
    """Packets that do not tell their size need a declared one."""
    odd = b"\0\0\0\1\x65slice"
    with pytest.raises(ValueError, match="frame size"):
        convert_dataset(wide(spark, odd), config())
    done = convert_dataset(wide(spark, odd), config(size=(64, 48)))
    assert done.features["observation.images.front"]["shape"] == [48, 64, 3]


def test_index_reads_no_bytes_again(spark, tmp_path):
    """Rates, order, alignment and faults ask the index; no plan of theirs reads a sample."""
    table = rec.camera_reader(wide(spark), "/cam", "front", "frame")
    table.write.parquet(f"{tmp_path}/cameras")
    held = spark.read.parquet(f"{tmp_path}/cameras")
    index = stage(cameras.camera_index(held), "camera-index")
    direct = rec.camera_index(wide(spark), [("/cam", "front", "frame")])
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, direct.select(*index.columns).collect()))
    targets = spark.createDataFrame([("one", i, i, i) for i in range(12)], "segment_id string, ordinal long, time_ns long, frame_index long")
    aligned = cameras.camera_align(targets, index, ["front"])
    for plan in (cameras.packet_manifest(index), rates.source_fps(index, ["segment_id", "camera_key"]), aligned):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema" in text and "sample:" not in text and "cameras" not in text.replace("camera_key", "")
    same = [(r.frame_index, r.frame_ordinal) for r in cameras.camera_align(targets, held, ["front"]).collect()]
    assert sorted(same) == sorted((r.frame_index, r.frame_ordinal) for r in aligned.collect()) == [(i, i - i % 2) for i in range(12)]


@pytest.mark.parametrize("most_bytes", [64 << 20, 200])
def test_frames_by_bitmap(spark, tmp_path, most_bytes):
    """Used frames over several bitmaps, in one pass and in several; nothing is shuffled with bytes."""
    rng = random.Random(6)
    rows = [(s, c, o, b"x" * 20) for s in ("a", "b", None) for c in ("front", "wrist") for o in rng.sample(range(-40_000, 140_000), 300)]
    spark.createDataFrame(rows, "segment_id string, camera_key string, ordinal long, sample binary").repartition(3).write.parquet(f"{tmp_path}/cameras")
    held = spark.read.parquet(f"{tmp_path}/cameras")
    used = [(s, c, o) for s, c, o, _ in rows if s and rng.random() < 0.4]
    asked = [*used, *used[:50], ("a", "front", None), ("c", "front", 5)]
    aligned = spark.createDataFrame(asked, "segment_id string, camera_key string, frame_ordinal long")
    picked = cameras.frame_pick(aligned, held, most_bytes=most_bytes)
    assert sorted((r.segment_id, r.camera_key, r.ordinal) for r in picked.collect()) == sorted(used)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert cameras.frame_pick(aligned.where("false"), held).count() == 0
    assert picked.columns == held.columns
