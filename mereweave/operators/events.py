"""Operators on an append-only log of NEW / UPDATE / FORGET events.

Orders are total (a sequence column), times are parameters, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_total


def mark_consecutive_duplicates(log: DataFrame, key: Column, hash_: Column, seq: str = "seq", bypass: Column | None = None) -> DataFrame:
    """Adds ``duplicate``: the key's last hash is the same. A, B, A all pass; rows that bypass neither match nor count;
    a null hash is never a duplicate."""
    bypass = F.lit(False) if bypass is None else bypass
    last = F.lag(hash_).over(Window.partitionBy(key, bypass).orderBy(seq))
    return log.withColumn("duplicate", F.coalesce(last == hash_, F.lit(False)) & ~bypass)


def label_changes(log: DataFrame, key: str, hash_: str, seq: str = "seq") -> DataFrame:
    """NEW at first sight, UPDATE when the hash changed; unchanged rows are dropped."""
    last = F.lag(hash_).over(Window.partitionBy(key).orderBy(seq))
    labelled = log.withColumn("change", F.when(last.isNull(), "NEW").when(last != F.col(hash_), "UPDATE"))
    return labelled.where("change is not null")


def current_state(log: DataFrame, key: str = "rid", seq: str = "seq", kind: str = "event_type", hash_: str = "hash") -> DataFrame:
    """The fold of the log: a key's last event decides, FORGET removes it, NEW and UPDATE without content are ignored.
    A grouped maximum, so that it is combined before the shuffle and no key is sorted."""
    counted = log.where((F.col(kind) == "FORGET") | F.col(hash_).isNotNull())
    last = counted.groupBy(key).agg(F.max_by(F.struct(kind, hash_), seq).alias("last"), F.max(seq).alias("last_seq"), F.count("*").alias("events"))
    return last.where(F.col(f"last.{kind}") != "FORGET").select(key, F.col(f"last.{hash_}").alias("hash"), "last_seq", "events")


def latest_per_key(log: DataFrame, key: str, seq: str, *columns: str) -> DataFrame:
    return log.groupBy(key).agg(F.max_by(F.struct(*columns), seq).alias("last"), F.max(seq).alias(seq)).select(key, "last.*", seq)


def deliveries(log: DataFrame, edges: DataFrame, limit: int, delivered: DataFrame | None = None, seq: str = "seq") -> DataFrame:
    """(node, seq, rid): for each node the oldest ``limit`` events of the kinds that it takes and has not got.

    ``edges``: node, kind (null takes all). The kinds filter comes before the limit.
    """
    some = edges.where("kind is not null")
    every = edges.where("kind is null").select("node")
    wanted = log.join(some, "kind").select("node", seq, "rid").union(log.crossJoin(F.broadcast(every)).select("node", seq, "rid"))
    if delivered is not None:
        wanted = wanted.join(delivered, ["node", seq], "left_anti")
    first = Window.partitionBy("node").orderBy(seq)
    return wanted.withColumn("n", F.row_number().over(first)).where(F.col("n") <= limit).drop("n")


def confirmed(queue: DataFrame) -> DataFrame:
    """Queue rows that may go: delivered somewhere, and every delivery is confirmed."""
    return queue.where((F.size("delivered") > 0) & (F.size(F.array_except("delivered", "confirmed")) == 0))


def prune(items: DataFrame, as_of: Column, max_age: Column, max_bytes: int, age: str, size: str, key: str, protected: Column) -> DataFrame:
    """Retention: adds ``pruned_by`` (age, size or null). Old unprotected items go first; of the others the oldest
    unprotected ones go until the total fits. Protected items count towards the total and stay."""
    aged = items.withColumn("pruned_by", F.when(~protected & (F.col(age) < as_of - max_age), "age"))
    left = F.when(F.col("pruned_by").isNull(), F.col(size)).otherwise(0)
    total = aged.agg(F.sum(left).alias("total"))
    own = F.when(protected, 0).otherwise(left)
    out = running_total(aged, own, "freed", age, key).withColumn("freed", F.col("freed") - own).join(F.broadcast(total))
    by_size = F.col("pruned_by").isNull() & ~protected & (F.col("total") - F.col("freed") > max_bytes)
    return out.withColumn("pruned_by", F.when(by_size, "size").otherwise(F.col("pruned_by"))).drop("freed", "total")


def sensor_status(last_seen: Column, as_of: Column) -> Column:
    """active under ten minutes since the last event, idle under thirty, else offline."""
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(last_seen.cast("timestamp"))
    return F.when(age < 600, "active").when(age < 1800, "idle").otherwise("offline")


def merge_memories(rows: DataFrame, key: str, seq: str, hash_: str, private: str, source: str) -> DataFrame:
    """The upsert folded over a batch: a row counts only if its hash differs from the one before it; privacy is
    sticky, the access source is the first one, the content the last."""
    changed = label_changes(rows, key, hash_, seq)
    return changed.groupBy(key).agg(F.max_by(hash_, seq).alias("hash"), F.max(private).alias("is_private"), F.min_by(source, seq).alias("access_source"), F.count("*").alias("writes"), F.when(F.count("*") > 1, "UPDATE").otherwise("NEW").alias("event_type"))
