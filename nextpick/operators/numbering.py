"""Exact running totals, positions and seeded ranks without one huge sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nextpick.sources.stage import stage

ONE_TASK_ROWS = 100_000


def running_total(frame: DataFrame, order: Sequence[str], value: Column, name: str,
                  group: Sequence[str] = ()) -> DataFrame:
    """Running total of `value` along `order`, restarting per `group`.

    A frame of at most ONE_TASK_ROWS rows (counted; stage it first if it is costly) takes
    one window. A larger one is range-partitioned and staged, and each range adds the totals of
    the ranges before it, a table of at most one row per range and group. (`group`, `order`)
    must be unique.
    """
    group, order = list(group), list(order)
    if frame.count() <= ONE_TASK_ROWS:
        whole = (Window.partitionBy(*group).orderBy(*order)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return frame.withColumn(name, F.sum(value).over(whole))
    ranged = stage(frame.withColumn("_value", value)
                   .repartitionByRange(*group, *order)
                   .withColumn("_range", F.spark_partition_id()), "ranged")
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy(*group, "_range").agg(F.sum("_value").alias("_total"))
              .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
              .drop("_total"))
    inside = (Window.partitionBy(*group, "_range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.join(F.broadcast(before), [*group, "_range"])
            .withColumn(name, F.col("_before") + F.sum("_value").over(inside))
            .drop("_value", "_range", "_before"))


def number_rows(frame: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """Dense position 1..n along `order`, restarting per `group`."""
    return running_total(frame, order, F.lit(1).cast("bigint"), name, group)


def mark_lowest(rows: DataFrame, quotas: DataFrame, group: str, hash_column: str, tie: str,
                name: str, digits: int = 4) -> DataFrame:
    """Flag, per `group`, the `quota` rows with the lowest hash (ties by `tie`).

    Hash prefixes are counted and cumulated to find the prefix in which the quota ends.
    Rows below it are taken whole and rows above it are not; only the rows inside it are ranked,
    about one in 16**digits of a group. `quotas` holds (`group`, ``quota``); the number of
    groups is that of the category codes, so their cut-off points are broadcast.
    """
    rows = rows.withColumn("_prefix", F.substring(hash_column, 1, digits))
    histogram = rows.groupBy(group, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    through = F.sum("_rows").over(Window.partitionBy(group).orderBy("_prefix"))
    ends = (histogram.withColumn("_earlier", through - F.col("_rows"))
            .join(quotas, group)
            .filter(F.col("_earlier") < F.col("quota"))
            .groupBy(group)
            .agg(F.max("_prefix").alias("_end"),
                 F.max_by(F.col("quota") - F.col("_earlier"), "_prefix").alias("_need")))
    placed = rows.join(F.broadcast(ends), group, "left")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(hash_column, tie))
    below = placed.filter(F.col("_prefix") < F.col("_end")).withColumn(name, F.lit(True))
    inside = placed.filter(F.col("_prefix") == F.col("_end")).withColumn(name, rank <= F.col("_need"))
    above = (placed.filter(F.col("_end").isNull() | (F.col("_prefix") > F.col("_end")))
             .withColumn(name, F.lit(False)))
    return below.unionByName(inside).unionByName(above).drop("_prefix", "_end", "_need")
