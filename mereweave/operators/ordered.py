"""Running totals and ranks over a whole table without one task that sorts it all.

Rows are dealt by ranges of the order, numbered inside their range, and shifted by the totals of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kg import durable


def running_total(df: DataFrame, value: Column, name: str, *order: Column | str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows up to this one. ``order`` must be total."""
    parts = durable(df.withColumn(name, value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy("_part").agg(F.sum(name).alias("_total"))
    before = totals.select("_part", (F.sum("_total").over(Window.orderBy("_part")) - F.col("_total")).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return parts.join(before, "_part").withColumn(name, F.sum(name).over(inside) + F.col("_before")).drop("_part", "_before")


def rank(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Adds ``name``: the row's number, from one, in a total order."""
    return running_total(df, F.lit(1).cast("long"), name, *order)
