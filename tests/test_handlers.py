"""Handler chains, adapters, sites and id types on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from mereweave.functions import text as t
from mereweave.operators import content as c
from mereweave.operators import handlers as h


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_a_stopped_event_keeps_the_stopping_handlers_changes_and_no_later_ones(spark):
    p = h.Pipeline()

    @p.handler("final")
    def last(col):
        return {"x": col("x") + 100}

    @p.handler("rid", event_types=("NEW",))
    def first(col):
        return {"x": col("x") + 1, "seen": F.lit(True)}

    @p.handler("bundle", namespaces=("web.page",))
    def odd(col):
        return {"x": col("x") * 10, h.STOP: col("x") % 2 == 1}

    log = spark.createDataFrame([(1, "NEW", "orn:web.page:a", 2), (2, "NEW", "orn:web.page:b", 1), (3, "FORGET", None, 5), (4, None, "orn:other:c", None)], "seq long, event_type string, rid string, x int")
    assert rows(p.process(log), "seq", "x", "seen", "stopped_by") == [(1, 30, True, "odd"), (2, 120, True, None), (3, 105, None, None), (4, None, None, None)]
    with pytest.raises(ValueError):
        p.handler("nowhere")


def test_an_unfiltered_empty_pipeline_changes_nothing(spark):
    df = spark.createDataFrame([("a", "NEW")], "rid string, event_type string")
    assert rows(h.Pipeline().process(df), "rid", "stopped_by") == [("a", None)]


def test_sites_dispatch_by_domain_and_fall_back(spark):
    url = ["https://f.example/t/1", "https://f.example/c/x", "https://f.example/about", "https://g.example/weekly-meetup", "https://g.example/x", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(url)], "id int, url string")
    kind = h.by_site([h.Forum("f.example")], df.url, lambda s: s.content_type(df.url), h.Site("g.example"))
    assert [r[1] for r in sorted(tuple(r) for r in df.select("id", kind).collect())] == ["forum_topic", "forum_category", "forum_page", "meeting", "page", "page"]
    html = spark.createDataFrame([('<a href="/t/1?page=2#x">a</a><a class="x" href="/u/ann">b</a><a href="/c/b">c</a><a href="#top">d</a>',), (None,)], "html string")
    got = sorted((r[0] is None, sorted(r[0] or [])) for r in html.select(h.Forum("f.example").links(html.html)).collect())
    assert got == [(False, ["https://f.example/c/b", "https://f.example/t/1"]), (True, [])]


def test_id_types(spark):
    types = h.IdTypes()
    df = spark.createDataFrame([("orn:web.page:a/1",), ("orn:unknown:x",), (None,)], "rid string")
    assert [r[0] for r in df.select(types.kind(df.rid)).collect()] == ["web page", None, None]
    assert spark.range(1).select(types.create("nothing", F.lit("a")), types.create("web.page", F.lit("a"), F.lit(None))).first()[:] == (None, None)


def test_style_scores(spark):
    texts = ["PLAIN SHOUTING HERE NOW", "fine. announced", "It might be!!! possibly lol", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string")
    got = {r.id: r.s for r in df.select("id", t.styled(df.text).alias("s")).collect()}
    assert got[0].content == "Plain Shouting Here NOW" and got[0].score == 0.9
    assert (got[1].content, got[1].score) == ("fine. announced", 0.8)
    assert (got[2].content, got[2].score) == ("It is! lol", 0.3)


def test_threads_are_filled_numbered_and_tagged(spark):
    posts = spark.createDataFrame([("a", 1, "one"), *[("b", k, f"p{k}") for k in range(7)]], "thread string, place int, body string")
    got = rows(c.compose_thread(posts, ("f1", "f2", "f3"), "#t"), "thread", "position", "post")
    assert got[:3] == [("a", 1, "1/3 one"), ("a", 2, "2/3 f1"), ("a", 3, "3/3 f2 #t")] and [x[2] for x in got[3:]] == ["1/5 p0", "2/5 p1", "3/5 p2", "4/5 p3", "5/5 p4 #t"]


def test_sliding_count_is_open_at_the_start(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:59:59"), (3, "2024-01-01 01:00:00"), (4, "2024-01-01 01:59:59.5")], "id int, at string").withColumn("ts", F.to_timestamp_ntz("at"))
    assert rows(c.sliding_count(df, "ts", 3600), "id", "n") == [(1, 1), (2, 2), (3, 2), (4, 2)]


def test_note_blocks_of_many_kinds(spark):
    rich = '[{"plain_text":"a"},{"plain_text":"b"}]'
    blocks = [
        f'{{"type":"quote","quote":{{"rich_text":{rich}}}}}', '{"type":"code","code":{"rich_text":[]}}', '{"type":"table"}', '{"type":"video","video":{"type":"external","external":{"url":"http://v"},"caption":[{"plain_text":"c"}]}}',
        '{"type":"bookmark","bookmark":{"url":"http://b"}}', '{"type":"audio","audio":{"type":"file"}}', '{"type":"image"}', None, "no json",
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "id int, block string")
    assert [r[1] for r in sorted((r.id, r.x) for r in df.select("id", c.block_text(df.block).alias("x")).collect())] == ["ab", None, "[Table]", "[Video: http://v] - c", "[Link: http://b]", "[Audio Recording]", None, None, None]
