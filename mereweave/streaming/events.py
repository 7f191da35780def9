"""The event operators on streams. State is kept per key; micro-batches are ordered by sequence before it changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LOG_SCHEMA = "seq long, ts timestamp, event_type string, rid string, hash string"


def read_log(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def mark_duplicates(log: DataFrame) -> DataFrame:
    """(seq, rid, duplicate): as the batch form, with the last hash of each rid as state. Null hashes are never duplicates."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(frames)).sort_values("seq")
        out = []
        for seq, h in zip(rows["seq"], rows["hash"], strict=True):
            out.append((seq, key[0], h is not None and h == last))
            last = h
        state.update((last,))
        yield pd.DataFrame(out, columns=["seq", "rid", "duplicate"])

    return log.groupBy("rid").applyInPandasWithState(step, "seq long, rid string, duplicate boolean", "last string", "append", GroupStateTimeout.NoTimeout)


def fold_state(log: DataFrame) -> DataFrame:
    """(rid, hash, last_seq, live): the current state of each key, updated as events arrive."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        h, seq, live = state.get if state.exists else (None, -1, False)
        for s, kind, x in pd.concat(list(frames)).sort_values("seq")[["seq", "event_type", "hash"]].itertuples(index=False):
            if s > seq and (kind == "FORGET" or x is not None):
                h, seq, live = x, int(s), kind != "FORGET"
        state.update((h, seq, live))
        yield pd.DataFrame([(key[0], h, seq, live)], columns=["rid", "hash", "last_seq", "live"])

    return log.groupBy("rid").applyInPandasWithState(step, "rid string, hash string, last_seq long, live boolean", "hash string, last_seq long, live boolean", "update", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "append", sink: Callable[[DataFrame, int], Any] | None = None):
    """Processes what is there, in memory or through ``sink`` (an idempotent function of batch and number), and stops."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = (w.foreachBatch(sink) if sink else w.format("memory").queryName(name)).start()
    q.awaitTermination()
    return q
