"""Positions in a total order, numbered over the whole cluster.

A window without a partition brings all rows to one task. Here rows are sorted into ranges of the order, each task numbers
its own range, and the sizes of the ranges before it (one small row for each task) are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..kept import keep

#: monotonically_increasing_id() holds the task in the bits above these, and the row's place in its task in these.
PLACE_BITS = 33


def ranged(spark: SparkSession, df: DataFrame, *order: Column, name: str = "ranges") -> DataFrame:
    """Rows of ``df`` sorted into ranges and kept, with ``_range`` (rising with the order) and ``_place`` (from 0 within it).

    Kept, since a range's rows must not change between the two uses. Rows equal in ``order`` are in one range.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return keep(spark, placed, name).select(*df.columns, F.shiftright("_id", PLACE_BITS).alias("_range"), F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1).alias("_place"))


def starts(ranges: DataFrame) -> DataFrame:
    """For each range, the number of rows in the ranges before it: one row for each task that sorted, so it may be broadcast."""
    counted = ranges.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"), "count")


def numbered(spark: SparkSession, df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with the position of each row in ``order``, from 1; ties get different positions, in no stated order.

    An empty table gives none. Null values come where ``order`` puts them.
    """
    ranges = ranged(spark, df, *order)
    return ranges.join(F.broadcast(starts(ranges)), "_range").select(*df.columns, (F.col("_before") + F.col("_place") + 1).alias(name))


def between(spark: SparkSession, df: DataFrame, first: int, last: int, *order: Column) -> DataFrame:
    """Rows at the positions ``first`` to ``last`` of ``order``, from 1. Only ranges that hold some of them are read on, so the
    end of a table costs what its start does."""
    ranges = ranged(spark, df, *order)
    held = starts(ranges).where((F.col("_before") < last) & (F.col("_before") + F.col("count") >= first))
    position = F.col("_before") + F.col("_place") + 1
    return ranges.join(F.broadcast(held), "_range").where(position.between(first, last)).select(*df.columns)


def dense_ranks(spark: SparkSession, df: DataFrame, key: str, value: str, name: str = "rank") -> DataFrame:
    """Distinct (key, value) pairs of ``df`` with the value's dense rank among its key's, from 1; null values come first.

    No task holds all values of a key: a key that spans several ranges gets the number of its pairs in the ranges before.
    """
    ranges = ranged(spark, df.select(key, value).distinct(), F.col(key), F.col(value))
    held = ranges.groupBy("_range", key).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # a key goes on from one range into the next only at its end, so few keys have rows in more ranges than one
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("_range", F.col(key).alias("_key"), "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    found = ranges.join(offsets, (ranges["_range"] == offsets["_range"]) & ranges[key].eqNullSafe(offsets["_key"]))
    return found.select(ranges[key], ranges[value], (F.col("_place") - F.col("_first") + F.col("_before") + 1).alias(name))
