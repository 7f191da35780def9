"""Delivery queues with state against a plain version, over restarts; and the rules one by one."""

import os
import random
import time
from datetime import datetime, timedelta, timezone

import pytest

from mereweave.streaming import delivery as d
from mereweave.streaming.events import run_available

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def act(queue, seq, minutes, action, node=None, rid=None, types=None, most=None, events=None):
    return (queue, seq, START + timedelta(minutes=minutes), action, node, rid, types, most, events)


def run(spark, tmp_path, batches, timeout=3600):
    """Each list of actions arrives as a file, and the query is restarted for each."""
    d.use_state_store(spark)
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, d.ACTIONS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(d.ACTIONS).parquet(f"{tmp_path}/in")
        run_available(d.deliver(stream, timeout), "", f"{tmp_path}/checkpoint", sink=lambda df, n, k=k: df.write.mode("overwrite").parquet(f"{tmp_path}/out/run={k}/batch={n}"))
    return sorted((tuple(r)[:5] for r in spark.read.schema(d.OUTCOMES).parquet(f"{tmp_path}/out").collect()), key=repr)


def plain(rows, timeout=3600):
    out, queues = [], {}
    rows = sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[2], r[1]))
    for queue, seq, at, action, node, rid, types, most, events in rows:
        held = queues.setdefault(queue, [])
        for e in [e for e in held if (at - e["at"]).total_seconds() > timeout]:
            held.remove(e)
            out.append((queue, "expired", e["seq"], None, None))
        if action == "event" and rid is not None and all(e["seq"] != seq for e in held):
            held.append({"seq": seq, "rid": rid, "at": at, "got": set(), "confirmed": set()})
        elif action == "poll" and node is not None:
            fit = [e for e in held if node not in e["got"] and (not types or any(e["rid"].startswith(t + ":") for t in types))]
            for e in fit if most is None else fit[:most]:
                e["got"].add(node)
                out.append((queue, "delivered", e["seq"], node, seq))
        elif action == "confirm" and node is not None:
            for e in held:
                if e["seq"] in (events or []):
                    e["confirmed"].add(node)
            for e in [e for e in held if e["got"] and e["got"] <= e["confirmed"]]:
                held.remove(e)
                out.append((queue, "removed", e["seq"], None, seq))
    last = max((r[2] for r in rows), default=None)
    return sorted(out + [(q, "expired", e["seq"], None, None) for q, held in queues.items() for e in held if (last - e["at"]).total_seconds() - 10 > timeout], key=repr)


def test_an_event_of_another_type_is_not_marked(spark, tmp_path):
    rows = [act("q", 1, 0, "event", rid="orn:a:x"), act("q", 2, 1, "event", rid="orn:ab:x"), act("q", 3, 2, "poll", "n", types=["orn:a"]), act("q", 4, 3, "poll", "n", types=["orn:a"]), act("q", 5, 4, "poll", "n")]
    assert run(spark, tmp_path, [rows]) == [("q", "delivered", 1, "n", 3), ("q", "delivered", 2, "n", 5)]


def test_events_leave_when_all_who_got_them_confirm(spark, tmp_path):
    first = [act("q", 1, 0, "event", rid="orn:a:x"), act("q", 2, 1, "confirm", "n1", events=[1, 99])]  # confirmed before anyone has it: it stays
    second = [act("q", 3, 2, "poll", "n1"), act("q", 4, 3, "poll", "n2"), act("q", 5, 4, "confirm", "n1", events=[1])]
    third = [act("q", 6, 5, "confirm", "n2", events=[1]), act("q", 7, 6, "poll", "n3")]
    assert run(spark, tmp_path, [first, second, third]) == [("q", "delivered", 1, "n1", 3), ("q", "delivered", 1, "n2", 4), ("q", "removed", 1, None, 6)]


def test_a_timer_expires_events_of_a_silent_queue(spark, tmp_path):
    first = [act("silent", 1, 0, "event", rid="orn:a:x"), act("silent", 2, 50, "event", rid="orn:a:y")]
    assert run(spark, tmp_path, [first, [act("other", 3, 70, "event", rid="orn:a:z")]]) == [("silent", "expired", 1, None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_actions_over_restarts(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows, minutes = [], 0
    for seq in range(260):
        minutes += 1 if seq in (100, 180) else rng.randint(0, 4)  # what is not after the watermark would be late
        queue, node = rng.choice(["a", "b", "c"]), rng.choice(["n1", "n2", None])
        kind = rng.choice(["event", "event", "poll", "confirm"])
        rows.append(act(queue, seq, minutes, kind, node, rng.choice(["orn:u:1", "orn:v:1", None]), rng.choice([None, [], ["orn:u"]]), rng.choice([None, 1, 2]), rng.sample(range(max(1, seq)), min(seq, 12)) if seq else None))
    rows += [act(None, 900, minutes, "event", rid="orn:u:1"), act("a", None, minutes, "event", rid="orn:u:1")]
    assert run(spark, tmp_path, [rows[:100], rows[100:180], rows[180:]]) == plain(rows)


def test_the_clock_ages_events_too(spark, tmp_path):
    """By the clock a queued event is new however old its own time is, and leaves by a timer without any further action."""
    d.use_state_store(spark)
    rows = [act("q", 1, 0, "event", rid="orn:a:x"), act("q", 2, 9000, "poll", "n")]
    spark.createDataFrame(rows, d.ACTIONS).write.parquet(f"{tmp_path}/in")
    stream = d.deliver(spark.readStream.schema(d.ACTIONS).parquet(f"{tmp_path}/in"), 2, clock=True)
    q = stream.writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(processingTime="1 second").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")).start()
    found = []
    try:
        for _ in range(90):
            time.sleep(1)
            if os.path.isdir(f"{tmp_path}/out"):
                found = sorted(tuple(r)[:5] for r in spark.read.schema(d.OUTCOMES).parquet(f"{tmp_path}/out").collect())
            if len(found) == 2:
                break
    finally:
        q.stop()
    assert found == [("q", "delivered", 1, "n", 2), ("q", "expired", 1, None, None)]
