"""Places of rows in an order within groups of any size, without gathering a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.session import stage


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """All rows, with ``position`` (from 0 in the group) and ``total`` (rows of the group).

    Rows are dealt out by ranges of (group, order, place in the input), so that neither a large
    group nor many rows of one key end up in one task; rows that are equal in the order are
    numbered as they come. What is put together per group is one count for each range that it
    lies in. ``group`` may not be null.
    """
    place = "place in the input"
    dealt = rows.withColumn(place, F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col(place)]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(place)
    dealt = stage(dealt.withColumns({"range": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "ordered")
    runs = dealt.groupBy(group, "range").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    before = F.sum("n").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(group, "range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total"))
    found = dealt.join(stage(runs, "ranges"), [group, "range"])
    return found.withColumn("position", F.col("row") + F.col("shift")).drop("range", "row", "shift")
