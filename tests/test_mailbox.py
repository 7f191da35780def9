"""The mailbox source: the contiguous mark, attempts, restarts, ranges and awkward stores."""

import json
import random

from mereweave.sources.mailbox import MailboxSource, MailboxStream, poll

START = {"validity": "1", "uid": 0, "failing": None, "tries": 0, "gone": []}


def land(spark, where, rows):
    spark.createDataFrame(rows, "folder string, uid long, raw binary").write.mode("append").parquet(where)


def test_the_mark_stops_at_the_first_failure_and_gives_up_after_the_attempts():
    listed = [(1, True), (2, False), (3, True)]
    one = poll(listed, START, 3, 100)
    assert (one["uid"], one["failing"], one["tries"], one["gone"]) == (1, 2, 1, [])
    two = poll(listed[1:], one, 3, 100)
    assert (two["uid"], two["failing"], two["tries"]) == (1, 2, 2)
    three = poll(listed[1:], two, 3, 100)
    assert (three["uid"], three["failing"], three["tries"], three["gone"]) == (3, None, 0, [2])
    assert poll([(2, True), (3, True)], two, 3, 100)["uid"] == 3  # it came in time
    assert poll([(2, True), (3, False)], two, 3, 100)["tries"] == 1  # another one fails now
    assert poll(listed, START, 1, 2)["uid"] == 2
    assert poll([], two, 3, 100)["uid"] == 1


def rows(df):
    return sorted((r.folder, r.uid, r.size, bytes(r.raw)) for r in df.collect())


def test_batches_read_after_a_uid(spark, tmp_path):
    where = f"file://{tmp_path}/mail"
    land(spark, where, [("a", 1, b"one"), ("a", 2, None), ("a", 2, b"two"), ("a", 2, b"two"), ("a", 3, None), ("a", 4, b"x" * 60), ("b", 9, b""), (None, 5, b"no"), ("a", None, b"no")])
    spark.dataSource.register(MailboxSource)
    read = lambda **o: rows(spark.read.format("mailbox").options(path=where, **o).load())
    assert read(folders="a,b,none", max_bytes="50", per_task="1") == [("a", 1, 3, b"one"), ("a", 2, 3, b"two"), ("b", 9, 0, b"")]
    assert read(folders="a", since_uid="1") == [("a", 2, 3, b"two"), ("a", 4, 60, b"x" * 60)]
    assert read(folders="") == []


def test_restarts_read_nothing_twice_and_lose_nothing(spark, tmp_path):
    where, out = f"file://{tmp_path}/mail", f"file://{tmp_path}/out"
    spark.dataSource.register(MailboxSource)

    def run(k, **more):
        stream = spark.readStream.format("mailbox").options(path=where, folders="a,b", state=f"file://{tmp_path}/state", attempts="3", per_task="2", **more).load()
        q = stream.writeStream.option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}")).start()
        q.awaitTermination()
        return [r[:2] for r in rows(spark.read.schema("folder string, uid long, size long, raw binary").parquet(out))]

    land(spark, where, [("a", k, b"m" if k != 4 else None) for k in range(1, 8)] + [("b", 1, b"m")])
    first = [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    assert run(0) == first
    land(spark, where, [("b", 2, b"m"), ("b", 3, None)])
    assert run(1) == [*first, ("b", 2)]  # 4 failed twice
    land(spark, where, [("b", 3, b"m")])  # in time
    third = run(2)  # 4 is given up
    assert third == [("a", 1), ("a", 2), ("a", 3), ("a", 5), ("a", 6), ("a", 7), ("b", 1), ("b", 2), ("b", 3)]
    land(spark, where, [("a", 4, b"late")])
    assert run(3) == third
    assert json.loads((tmp_path / "state" / "mark.json").read_text())["a"]["uid"] == 7


def test_another_validity_starts_the_folder_anew(tmp_path):
    stream = MailboxStream({"path": "file:///nowhere", "folders": "a", "uidvalidity": "2", "state": f"file://{tmp_path}/state"})
    stream.own.store.listed = lambda folder, after: [(u, True) for u in range(after + 1, 4)]
    stream.at = {"a": START | {"uid": 3}}
    end = stream.latestOffset()
    assert end["a"]["uid"] == 3 and end["a"]["validity"] == "2"
    assert [(p.after, p.upto) for p in stream.partitions({"a": START | {"uid": 3}}, end)] == [(0, 3)]


def test_lost_messages_do_not_cost_a_poll_each():
    listed, at, polls = [(u, u % 5 != 0) for u in range(1, 101)], START, 0
    while at["uid"] < 100:
        at = json.loads(json.dumps(poll([x for x in listed if x[0] > at["uid"]], at, 2, 40)))
        polls += 1
    assert polls <= 6  # of 20 lost ones
    late = poll([(2, False), (3, False)], START, 2, 100)
    assert poll([(2, True), (3, False), (4, True)], late, 2, 100) | {"behind": {}} == START | {"uid": 4, "gone": [3], "behind": {}}


def test_a_landed_store_reads_no_more_than_it_is_asked_for(spark, tmp_path):
    from mereweave.sources.mailbox import Store, land

    text = lambda u: random.Random(u).randbytes(9000)
    where = f"file://{tmp_path}/mail"
    for part in ([("a", u, None if u == 7 else text(u)) for u in range(1, 3001)] + [("b", 1, b"")], [("a", 7, b"late"), ("a", 3001, None)]):
        land(spark.createDataFrame(part, "folder string, uid long, raw binary"), where)
    store = Store(where)
    assert list(store.listed("a", 0)) == [(u, u != 3001) for u in range(1, 3002)]
    assert 0 < len(store._groups("a", 2990, 2999)) < len(store._groups("a", 0, None))
    assert dict(store.fetch("a", 5, 8)) == {6: text(6), 7: b"late", 8: text(8)}
