from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from framewright.operators import align

SCHEMA = "segment_id string, ordinal long, time_ns long, a array<float>, s array<float>, task array<string>"

CASES = {
    "between": ([(0, 0, None, [1.0], None), (1, 5, [9.0], None, None), (2, 8, None, [2.0], None), (3, 9, [8.0], None, None)],
                [(9.0, 1.0, None), (8.0, 2.0, None)]),
    "head clamp": ([(0, 0, [9.0], None, None), (1, 5, None, [1.0], None)], [(9.0, 1.0, None)]),
    "tie, later row wins": ([(0, 10, [9.0], [1.0], None), (1, 10, None, [2.0], None)], [(9.0, 2.0, None)]),
    "two reference rows": ([(0, 10, [8.0], [1.0], None), (1, 10, [9.0], None, None)], [(8.0, 1.0, None), (9.0, 1.0, None)]),
    "unsorted": ([(0, 9, [9.0], None, None), (1, 3, None, [1.0], None)], [(9.0, 1.0, None)]),
    "no state": ([(0, 0, [9.0], None, None)], [(9.0, None, None)]),
    "no action": ([(0, 0, None, [1.0], None)], []),
    "task": ([(0, 0, [9.0], [1.0], ["x"]), (1, 5, [8.0], None, None)], [(9.0, 1.0, "x"), (8.0, 1.0, "x")]),
}


@pytest.mark.parametrize("limit", [1, 2, 1000])
def test_cases(spark, limit):
    rows = [(name, *row) for name, (given, _) in CASES.items() for row in given]
    df = spark.createDataFrame(rows, SCHEMA)
    got = align.latest_at(df, ["a", "s", "task"], "a", rows_per_chunk=limit).orderBy("segment_id", "frame_index").collect()
    for name, (_, expected) in CASES.items():
        mine = [r for r in got if r.segment_id == name]
        assert [r.frame_index for r in mine] == list(range(len(expected)))
        assert [(r.a[0], r.s and r.s[0], r.task and r.task[0]) for r in mine] == expected, name


def brute(rows, clamp):
    """Stable sort and binary search, per segment and column."""
    out = []
    for segment in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == segment), key=lambda r: (r[2], r[1]))
        index = 0
        for r in mine:
            if r[3] is None:
                continue
            values = []
            for c in (4, 5):
                held = [m for m in mine if m[c] is not None]
                at = bisect.bisect_right([m[2] for m in held], r[2]) - 1
                if at < 0 and clamp:
                    at = 0
                values.append(held[at][c] if held and at >= 0 else None)
            out.append((segment, index, r[1], r[3], *values))
            index += 1
    return out


@pytest.mark.parametrize("clamp", [True, False])
@pytest.mark.parametrize("limit", [1, 7, 40, 10_000])
def test_against_binary_search(spark, limit, clamp):
    """Unsorted rows with many, some and hardly any ties."""
    rng = random.Random(limit)
    rows = []
    for span in (3, 60, 100_000):
        for segment, size in (("hot", 260), ("b", 40), ("c", 1), ("d", 30)):
            for ordinal in range(size):
                values = [rng.randrange(1000) if rng.random() < p else None for p in (0.3, 0.05, 0.2)]
                rows.append((f"{segment}-{span}", ordinal, rng.randrange(span), *values))
    df = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long, a long, s long, t long")
    got = align.latest_at(df, ["a", "s", "t"], "a", clamp=clamp, rows_per_chunk=limit)
    got = [tuple(r) for r in got.select("segment_id", "frame_index", "ordinal", "a", "s", "t").collect()]
    assert sorted(got, key=str) == sorted(brute(rows, clamp), key=str)


def test_one_instant_holds_most_rows(spark):
    rows = [("x", i, 5, i if i % 3 == 0 else None, i if i % 11 == 0 else None, None) for i in range(300)]
    rows.append(("x", 300, 9, 1, None, None))
    df = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long, a long, s long, t long")
    got = align.latest_at(df, ["a", "s", "t"], "a", rows_per_chunk=16)
    got = [tuple(r) for r in got.select("segment_id", "frame_index", "ordinal", "a", "s", "t").collect()]
    assert sorted(got) == sorted(brute(rows, True))


FRAME_CASES = [
    ([0, 100, 200, 300], [0, 100, 150, 200, 299, 300, 999], [0, 1, 1, 2, 2, 3, 3]),
    ([500, 600], [0, 100, 499], [0, 0, 0]),
    ([300, 0, 200, 100], [0, 150, 350], [1, 3, 0]),
    ([0, 1], [], []),
    ([], [4], [None]),
    ([7, 7, 7], [6, 7, 8], [0, 2, 2]),
]


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_latest_at_frames(spark, limit):
    schema = "k long, ordinal long, time_ns long"
    frames = spark.createDataFrame([(k, i, t) for k, (f, _, _) in enumerate(FRAME_CASES) for i, t in enumerate(f)], schema)
    targets = spark.createDataFrame([(k, i, t) for k, (_, q, _) in enumerate(FRAME_CASES) for i, t in enumerate(q)], schema)
    got = align.latest_at_frames(targets, frames, ["k"], rows_per_chunk=limit).collect()
    for k, (_, _, expected) in enumerate(FRAME_CASES):
        mine = sorted((r.ordinal, r.frame_ordinal) for r in got if r.k == k)
        assert [f for _, f in mine] == expected


def shots(seed):
    """Targets and frames of groups of very different sizes: long runs without a frame, no frames, null keys and times."""
    rng = random.Random(seed)
    shown, asked = [], []
    for k, n, m in (("hot", 300, 12), ("even", 90, 90), ("few", 5, 60), ("none", 70, 0), (None, 30, 30), ("one", 1, 1)):
        asked += [(k, i, rng.randrange(200)) for i in range(n)] + [(k, n, None)]
        shown += [(k, i, rng.randrange(50, 250)) for i in range(m)]
    return asked, shown


def brute_frames(asked, shown, clamp):
    out = []
    for k, i, time in asked:
        held = sorted((t, o) for kk, o, t in shown if kk == k)
        if time is None:
            continue
        at = bisect.bisect_right([t for t, _ in held], time) - 1
        found = held[max(at, 0)] if held and (at >= 0 or clamp) else (None, None)
        out.append((k, time, i, found[1], found[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("clamp", [True, False])
@pytest.mark.parametrize("limit", [1, 4, 20, 1000])
def test_frames_against_binary_search(spark, limit, clamp):
    asked, shown = shots(limit)
    schema = "k string, ordinal long, time_ns long"
    targets, frames = spark.createDataFrame(asked, schema).repartition(3), spark.createDataFrame(shown, schema).repartition(3)
    got = align.latest_at_frames(targets, frames, ["k"], clamp=clamp, rows_per_chunk=limit)
    assert sorted(map(tuple, got.collect()), key=str) == brute_frames(asked, shown, clamp)


def test_chunked_frames_move_rows_twice(spark, tmp_path):
    """Without broadcasts: targets are read once and moved to their group's starts and to their chunk, and nowhere else."""
    asked, shown = shots(5)
    for name, rows in (("targets", asked), ("frames", shown)):
        spark.createDataFrame(rows, "k string, ordinal long, time_ns long").write.parquet(f"{tmp_path}/{name}")
    targets, frames = spark.read.parquet(f"{tmp_path}/targets"), spark.read.parquet(f"{tmp_path}/frames")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "1000"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = align.latest_at_frames(targets, frames, ["k"], rows_per_chunk=20)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got.collect()), key=str) == brute_frames(asked, shown, True)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plan.count(f"{tmp_path}/targets") == 1 and plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange hashpartitioning") == 8


def test_time_grid(spark):
    ranges = spark.createDataFrame([("a", 0, 1_000_000_000), ("b", 5, 5), ("c", 0, 100_000_000_000_000)], "segment_id string, min_ns long, max_ns long")
    got = {r.segment_id: r for r in align.time_grid(ranges, 2).groupBy("segment_id").agg(
        F.count("*").alias("n"), F.min("time_ns").alias("lo"), F.max("time_ns").alias("hi"), F.count_distinct("grid_index").alias("d")).collect()}
    assert (got["a"].n, got["a"].lo, got["a"].hi) == (2, 0, 500_000_000)
    assert (got["b"].n, got["b"].lo) == (1, 5)
    assert (got["c"].n, got["c"].d, got["c"].hi) == (200_000, 200_000, 99_999_500_000_000)


@pytest.mark.parametrize("limit", [5, 1000])
def test_resample(spark, limit):
    rows = [("x", 0, 0, [1.0]), ("x", 1, 1_400_000_000, [2.0]), ("x", 2, 2_000_000_000, [3.0])]
    df = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long, v array<float>")
    got = align.resample_fps(df, ["v"], 2, rows_per_chunk=limit).orderBy("time_ns").collect()
    assert [(r.time_ns, r.v[0]) for r in got] == [(0, 1.0), (500_000_000, 1.0), (1_000_000_000, 1.0), (1_500_000_000, 2.0)]


def test_rebase_by_stored_order(spark):
    df = spark.createDataFrame([("x", 0, 50), ("x", 1, 20), ("x", 2, 90)], "k string, ordinal long, time_ns long")
    first = [r.time_ns for r in align.rebase(df, ["k"], by_stored_order=True).orderBy("ordinal").collect()]
    least = [r.time_ns for r in align.rebase(df, ["k"]).orderBy("ordinal").collect()]
    assert (first, least) == ([0, -30, 40], [30, 0, 70])
