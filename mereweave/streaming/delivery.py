"""Delivery queues on streams: which subscriber gets which event, confirmations, and expiry by timers.

Every queue is a key with its own state: a map of the events that it holds, and a map of (event, subscriber) marks: got, confirmed.
Actions of a queue are taken in the order of their time and number:

* ``event`` puts an event into the queue and sets a timer.
* ``poll`` gives a subscriber the oldest events that it has not got, ``most`` at most (null: all). Types are tested before anything is
  marked: an event of another type stays unmarked and goes to whoever takes it later. A type is a prefix of a rid up to a colon.
* ``confirm`` marks events (``events``) as confirmed by a subscriber, whether it got them or not. Then events that are delivered to
  someone, and confirmed by all who got them, leave the queue.
* An event that is older than the timeout leaves: by its timer when the watermark (or the clock) passes, or by the first later action.

Nulls and edges: an action without a queue or number is ignored, so are polls and confirmations without a subscriber and events without a
rid; confirming what is not in the queue does nothing; a number that the queue holds already is not queued twice; no types (null or an
empty array) means all types.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

ACTIONS = "queue string, seq long, at timestamp, action string, node string, rid string, types array<string>, most int, events array<long>"
_OUTCOME = Row("queue", "outcome", "event", "node", "action")
OUTCOMES = "queue string, outcome string, event long, node string, action long"


def takes(rid: str, types: list[str] | None) -> bool:
    """Whether a rid is of one of the types."""
    return not types or any(rid.startswith(f"{t}:") for t in types)


class _Queue(StatefulProcessor):
    """One queue's state and rules. ``clock``: events are as old as their arrival here, not as their own time."""

    def __init__(self, timeout_ms: int, clock: bool):
        self.timeout_ms, self.clock = timeout_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        number = StructType([StructField("seq", LongType())])
        self.held = handle.getMapState("held", number, StructType([StructField("rid", StringType()), StructField("at", LongType())]))
        mark = StructType([StructField("seq", LongType()), StructField("node", StringType())])
        self.marks = handle.getMapState("marks", mark, StructType([StructField("got", BooleanType()), StructField("confirmed", BooleanType())]))

    def close(self) -> None:
        pass

    def _load(self) -> tuple[dict, dict]:
        held = {k[0]: (v[0], v[1]) for k, v in self.held.iterator()}
        marks: dict[int, dict[str, tuple[bool, bool]]] = {s: {} for s in held}
        for k, v in self.marks.iterator():
            marks[k[0]][k[1]] = (v[0], v[1])
        return held, marks

    def _mark(self, marks: dict, seq: int, node: str, got: bool | None = None, confirmed: bool | None = None) -> None:
        before = marks[seq].get(node, (False, False))
        marks[seq][node] = (before[0] if got is None else got, before[1] if confirmed is None else confirmed)
        self.marks.updateValue((seq, node), marks[seq][node])

    def _remove(self, held: dict, marks: dict, seq: int) -> None:
        at = held.pop(seq)[1]
        self.held.removeKey((seq,))
        for node in marks.pop(seq):
            self.marks.removeKey((seq, node))
        if not any(other == at for _, other in held.values()):
            self.handle.deleteTimer(at + self.timeout_ms + 1)

    def _expire(self, held: dict, marks: dict, now: int) -> list[int]:
        old = sorted(s for s, (_, at) in held.items() if now - at > self.timeout_ms)
        for s in old:
            self._remove(held, marks, s)
        return old

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        queue = key[0]
        out = []
        held, marks = self._load()
        for r in sorted(rows, key=lambda r: (r.millis, r.seq)):
            now = timerValues.getCurrentProcessingTimeInMs() if self.clock else r.millis
            out += [(queue, "expired", s, None, None) for s in self._expire(held, marks, now)]
            if r.action == "event" and r.rid is not None and r.seq not in held:
                held[r.seq], marks[r.seq] = (r.rid, now), {}
                self.held.updateValue((r.seq,), (r.rid, now))
                self.handle.registerTimer(now + self.timeout_ms + 1)
            elif r.action == "poll" and r.node is not None:
                fit = [s for s in sorted(held, key=lambda s: (held[s][1], s)) if not marks[s].get(r.node, (False,))[0] and takes(held[s][0], r.types)]
                for s in fit[: len(fit) if r.most is None else r.most]:
                    self._mark(marks, s, r.node, got=True)
                    out.append((queue, "delivered", s, r.node, r.seq))
            elif r.action == "confirm" and r.node is not None:
                for s in r.events or ():
                    if s in held:
                        self._mark(marks, s, r.node, confirmed=True)
                for s in [s for s, m in sorted(marks.items()) if any(g for g, _ in m.values()) and all(c for g, c in m.values() if g)]:
                    self._remove(held, marks, s)
                    out.append((queue, "removed", s, None, r.seq))
        yield from (_OUTCOME(*x) for x in out)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, marks = self._load()
        now = timerValues.getCurrentProcessingTimeInMs() if self.clock else timerValues.getCurrentWatermarkInMs()
        yield from (_OUTCOME(key[0], "expired", s, None, None) for s in self._expire(held, marks, now))


def deliver(actions: DataFrame, timeout_seconds: int = 3600, clock: bool = False, lateness: str = "10 seconds") -> DataFrame:
    """``OUTCOMES`` of a stream of ``ACTIONS``: events delivered (by which poll), removed (by which confirmation) and expired.

    With ``clock`` events age by the time of processing; else by their own, and timers fire with the watermark, ``lateness`` behind the
    latest action. By the clock a stream never rests: run it with a processing-time trigger, not with ``availableNow``. Actions that come in a later batch and are not after the watermark are late and ignored.
    """
    rows = actions.where("queue is not null and seq is not null and at is not null").withColumn("millis", F.unix_millis("at"))
    if not clock:
        rows = rows.withWatermark("at", lateness)
    mode = "ProcessingTime" if clock else "EventTime"
    return rows.groupBy("queue").transformWithState(_Queue(timeout_seconds * 1000, clock), OUTCOMES, "append", mode)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_state_store(spark: SparkSession) -> None:
    """Maps and timers need the store on local disks that keeps its changes in the checkpoint. It counts for streams started from now on."""
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """While it lasts, streams start with that store; then with the one before."""
    before = spark.conf.get(_PROVIDER)
    use_state_store(spark)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)
