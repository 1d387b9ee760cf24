"""Rendezvous hashing of record keys over weighted shards, in column functions only.

Every shard draws a number from (key, shard) and the smallest ``-ln(u) / weight`` wins. A key's
draws do not depend on the other shards, so one more shard takes rows only into itself, and a
shard that goes gives its rows to the others by their weights.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.session import stage


def draw(key: Column, shard: int) -> Column:
    """A number over 0 and below 1 from 52 bits of a digest of key and shard."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(shard))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key; equal costs go to the smaller shard. A null key is a key too."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("shards need positive weights")
    costs = [F.struct((-F.ln(draw(key, s)) / F.lit(float(w))).alias("cost"), F.lit(s).alias("shard")) for s, w in sorted(weights.items())]
    return F.array_min(F.array(*costs))["shard"]


def number_within(rows: DataFrame, group: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Rows with their gapless place within a group, from 0, along ``order``.

    Rows are dealt out by range of (group, order, a counter), so a group of any size is spread
    over many tasks; a sorted task numbers its own rows and a table with one row per group and
    task gives what comes before. Rows equal in ``order`` are numbered in any order.
    """
    mine = "number_within_counter"
    dealt = rows.withColumn(mine, F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    dealt = dealt.repartitionByRange(group, *order, mine).sortWithinPartitions(group, *order).drop(mine)
    dealt = stage(dealt.withColumn("number_within_row", F.monotonically_increasing_id()), "slots")
    part = F.shiftright("number_within_row", 33)
    runs = dealt.groupBy(F.col(group).alias("run_group"), part.alias("run_part")).agg(F.min("number_within_row").alias("run_first"), F.count("*").alias("run_rows"))
    before = F.sum("run_rows").over(Window.partitionBy("run_group").orderBy("run_part")) - F.col("run_rows")
    runs = runs.withColumn("run_before", before).drop("run_rows")
    joined = dealt.join(runs, F.col(group).eqNullSafe(F.col("run_group")) & (part == F.col("run_part")))
    place = F.col("run_before") + F.col("number_within_row") - F.col("run_first")
    return joined.withColumn(slot, place).drop("number_within_row", "run_group", "run_part", "run_first", "run_before")


def assign(docs: DataFrame, weights: Mapping[int, float], *, grown: Mapping[int, float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, shard, slot`` and, with ``grown``, ``grown_shard``.

    size: UTF-8 bytes of the text and 1; a null text has no bytes. Rows of one key, null
    included, share a shard. Slots follow the digest of key and winning shard, so they do not
    follow the key. Other columns are ignored; an empty table gives no rows.
    """
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        (rendezvous(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("null")), F.col("shard").cast("string")).cast("binary"))
    placed = number_within(rows.withColumn("digest", digest), "shard", ["digest", "text_crc32", "size"])
    return placed.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")
