"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join (no neighbour list is collected), is written to the
shared folder, and halves the distances in the graph; a few steps do whatever the input's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut


def components(edges: DataFrame, cut: Cut, a="a", b="b") -> DataFrame:
    """(node, component) for every node of ``edges``: the smallest node reachable. Null ends are ignored; loops and repeats do no harm."""
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"`{a}` is not null and `{b}` is not null").where("a <> b").distinct()
    e = cut.keep(e)
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hooked.union(low).distinct()
        new = cut.keep(small)
        cut.drop(e)
        e, old, mark = new, mark, _mark(new)
        if mark == old:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())


def _mark(e: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal when a step changes nothing."""
    return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
