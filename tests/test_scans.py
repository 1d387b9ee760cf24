from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from framewright.operators import profile, rates, scans

LIMITS = [1, 5, 1000]


def table(spark, seed=1):
    rng = random.Random(seed)
    rows = [(k, i, rng.randrange(50)) for k, n in (("hot", 90), ("b", 12), ("c", 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, ordinal long, time_ns long").repartition(5)


@pytest.mark.parametrize("limit", LIMITS)
def test_running_total_numbering_and_previous(spark, limit):
    rows, df = table(spark)
    chunks = scans.plan_chunks(df, ["k"], ["ordinal"], rows_per_chunk=limit)
    assert chunks.split == (limit < 90)
    df = scans.running_total(df, F.col("time_ns"), "total", chunks)
    df = scans.number_rows(df, "n", chunks)
    df = scans.previous_value(df, "time_ns", "before", chunks)
    got = {(r.k, r.ordinal): (r.total, r.n, r.before) for r in df.collect()}
    assert len(got) == len(rows)
    total, before = {}, {}
    for k, i, v in rows:
        total[k] = total.get(k, 0) + v
        assert got[(k, i)] == (total[k], i, before.get(k))
        before[k] = v


@pytest.mark.parametrize("limit", LIMITS)
def test_number_all(spark, limit):
    rows, df = table(spark)
    one = df.where("k = 'hot'")
    got = scans.number_all(one, ["ordinal"], "n", rows_per_chunk=limit).collect()
    assert sorted((r.ordinal, r.n) for r in got) == [(i, i) for i in range(90)]
    before = scans.totals_before(one, ["ordinal"], {"t": F.col("time_ns")}, rows_per_chunk=limit).orderBy("ordinal").collect()
    running = 0
    for r in before:
        assert r.t == running
        running += r.time_ns


def test_chunks_are_bounded(spark):
    df = spark.range(20_000).select(F.lit("x").alias("k"), F.col("id").alias("ordinal"))
    chunks = scans.plan_chunks(df, ["k"], ["ordinal"], rows_per_chunk=500)
    sizes = [r["count"] for r in scans.with_chunk(df, chunks).groupBy(scans.CHUNK).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 1500 and len(sizes) > 20


@pytest.mark.parametrize("limit", LIMITS)
def test_exact_median(spark, limit):
    rows, df = table(spark, 4)
    got = {r.k: r.m for r in rates.exact_median(df, ["k"], "time_ns", "m", rows_per_chunk=limit).collect()}
    for k in ("hot", "b", "c"):
        assert got[k] == statistics.median(v for kk, _, v in rows if kk == k)


@pytest.mark.parametrize("limit", LIMITS)
def test_source_fps(spark, limit):
    second = 1_000_000_000
    rows = [("even", i, i * second // 10) for i in range(12)] + [("one", 0, 5)]
    rows += [("still", i, 7) for i in range(4)] + [("edge", i, i * 95_238_096) for i in range(6)]
    df = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long")
    got = rates.source_fps(df, ["segment_id"], rows_per_chunk=limit)
    got = got.withColumn("ok", rates.copy_decision(F.col("source_fps"), F.col("samples"), 10))
    got = {r.segment_id: (round(r.source_fps, 3), r.ok) for r in got.collect()}
    assert got == {"even": (10.0, True), "one": (0.0, False), "still": (0.0, False), "edge": (10.5, True)}


@pytest.mark.parametrize("limit", LIMITS)
def test_is_sorted(spark, limit):
    rows = [("up", i, i // 3) for i in range(20)] + [("down", i, i if i != 11 else 3) for i in range(20)]
    df = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long")
    got = {r.segment_id: r.sorted for r in profile.is_sorted(df, rows_per_chunk=limit).collect()}
    assert got == {"up": True, "down": False}


@pytest.mark.parametrize("kind", ["long", "double", "string"])
def test_even_cells(spark, kind):
    """A clock that jumps, and text, leave about as many chunk starts in every cell."""
    at = F.when(F.col("id") < 2000, F.col("id")).otherwise(F.col("id") + 10**15).cast("string")
    at = F.lpad(at, 20, "0") if kind == "string" else at.cast(kind)
    df = spark.range(2001).select(F.lit("hot").alias("k"), at.alias("at"), "id")
    chunks = scans.plan_chunks(df, ["k"], ["at"], rows_per_chunk=20)
    starts = [len(r._begins) for r in chunks.cells.collect()]
    assert sum(starts) > 20 and max(starts) <= 1 + sum(starts) ** 0.5 and len(starts) <= 1 + sum(starts) ** 0.5
    sizes = [r["count"] for r in scans.with_chunk(df, chunks).groupBy("k", scans.CHUNK).count().collect()]
    assert len(sizes) == sum(starts) + 1 and max(sizes) < 200
    got = scans.number_rows(df, "n", chunks).collect()
    assert all(r.n == r.id for r in got) and len(got) == 2001


@pytest.mark.parametrize("limit", [1, 3, 10])
def test_few_starts_need_no_cells(spark, limit):
    """Groups of few chunks find them by their own row; every chunk is listed, and rows are cut the same either way."""
    rows = [(k, i) for k, n in (("hot", 200), ("b", 25), ("c", 1), (None, 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, at long").repartition(3)
    chunks = scans.plan_chunks(df, ["k"], ["at"], rows_per_chunk=limit)
    assert (chunks.cells is None) == (200 // limit <= scans.WHOLE_STARTS)
    got = {(r.k, r["at"]): r[scans.CHUNK] for r in scans.with_chunk(df, chunks).collect()}
    assert got == {(k, i): (i + 1) // limit if k in ("hot", "b") else 0 for k, i in rows}
    numbers = sorted((r.k, r[scans.CHUNK]) for r in scans.chunk_numbers(chunks).collect())
    assert numbers == [(k, i) for k, n in (("b", 25), ("hot", 200)) for i in range(n // limit + 1)]


def test_groups_of_just_the_limit(spark):
    rows = [(k, i) for k, n in (("a", 20), ("b", 19), (None, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, at long")
    assert not scans.plan_chunks(df, ["k"], ["at"], rows_per_chunk=20).split
    assert scans.plan_chunks(df, ["k"], ["at"], rows_per_chunk=19).split


def test_heads(spark):
    """The first rows of each column; Spark limits each group before it shuffles."""
    rows = [(s, o, 100 - o // 2, e, "Scalars", "scalars", float(o)) for s in ("a", "b") for e in ("/x", "/y") for o in range(20)]
    log = spark.createDataFrame(rows, "segment_id string, ordinal long, time_ns long, entity_path string, component string, field string, value double")
    heads = profile.heads(log, 3)
    assert heads._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    got = sorted((r.segment_id, r.entity_path, r.place, r.ordinal) for r in heads.collect())
    assert got == sorted((s, e, p, o) for s in "ab" for e in ("/x", "/y") for p, o in ((0, 18), (1, 19), (2, 16)))
