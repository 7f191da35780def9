"""Streaming queries over the event log; their batch forms carry the SQL oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.kg import shared_dir
from ..sources.writers import read_snapshot, write_snapshot
from ..sources.writers import write_through as write_through_sink
from ..streaming import events as st
from .registry import query
from .views import Views


def shared_base(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one."""
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _landed(v: Views) -> tuple[DataFrame, str]:
    """The log landed as files in the shared folder, and a checkpoint beside it."""
    base = shared_base(v.spark)
    v.log.select("seq", F.col("ts").cast("timestamp").alias("ts"), "event_type", "rid", "hash").repartitionByRange(4, "seq").write.parquet(f"{base}/log")
    return st.read_log(v.spark, f"{base}/log", 10), base


@query("stm_01_ingest_phases", "select kind, count(*) as n from (select case when event_type = 'FORGET' then 'stop' else 'pass' end as kind from log) t group by 1", "log")
def phases(v: Views) -> DataFrame:
    """Handlers as chained transforms with a status column; a stopped row goes no further."""
    identified = v.log.withColumn("status", F.when(F.col("rid").isNull(), "stop").otherwise("pass"))
    checked = identified.withColumn("status", F.when(F.col("event_type") == "FORGET", "stop").otherwise(F.col("status")))
    return checked.groupBy(F.col("status").alias("kind")).agg(F.count("*").alias("n"))


@query("stm_02_stream_dedup", "select seq, rid, coalesce(lag(hash) over (partition by rid order by seq) = hash, false) as duplicate from log", "log")
def stream_dedup(v: Views) -> DataFrame:
    stream, base = _landed(v)
    name = f"dedup_{uuid.uuid4().hex}"
    st.run_available(st.mark_duplicates(stream), name, f"{base}/checkpoint", sink=lambda df, n: df.write.mode("overwrite").parquet(f"{base}/out/batch={n}"))
    return v.spark.read.parquet(f"{base}/out").select("seq", "rid", "duplicate")


@query("stm_06_stream_state", "select rid, hash, seq as last_seq from (select *, row_number() over (partition by rid order by seq desc) as n from log) t where n = 1 and event_type <> 'FORGET'", "log")
def stream_state(v: Views) -> DataFrame:
    stream, base = _landed(v)
    st.run_available(st.fold_state(stream), "state", f"{base}/checkpoint", "update", sink=lambda df, n: df.write.mode("overwrite").parquet(f"{base}/out/batch={n}"))
    last = v.spark.read.parquet(f"{base}/out").groupBy("rid").agg(F.max_by(F.struct("hash", "live"), "last_seq").alias("x"), F.max("last_seq").alias("last_seq"))
    return last.where("x.live").select("rid", "x.hash", "last_seq")


@query("snk_04_write_through", "select rid, hash, event_type, seq from log qualify row_number() over (partition by rid order by seq desc) = 1", "log")
def write_through(v: Views) -> DataFrame:
    """The log taken in batches, each written through to the table of current rows as a numbered commit; the last commit is read."""
    base = shared_base(v.spark)
    for k in range(2):
        v.log.where(f"seq % 2 = {k}").select("seq", F.col("ts").cast("timestamp").alias("ts"), "event_type", "rid", "hash").coalesce(2).write.mode("append").parquet(f"{base}/log")
    stream = st.read_log(v.spark, f"{base}/log", 2).select("rid", "hash", "event_type", "seq")
    st.run_available(stream, "", f"{base}/checkpoint", sink=write_through_sink(f"{base}/state", "rid", "seq"))
    return read_snapshot(v.spark, f"{base}/state").select("rid", "hash", "event_type", "seq")


@query("snk_03_snapshot", "select rid, count(*) as events, max(seq) as last_seq from log where seq % 3 <> 0 group by 1", "log")
def snapshot(v: Views) -> DataFrame:
    """A queue's table replaced twice as a whole; the reader gets the largest commit."""
    base = shared_base(v.spark)
    for keep in ("seq % 3 = 0", "seq % 3 <> 0"):
        write_snapshot(v.log.where(keep).groupBy("rid").agg(F.count("*").alias("events"), F.max("seq").alias("last_seq")), f"{base}/queue")
    return read_snapshot(v.spark, f"{base}/queue")
