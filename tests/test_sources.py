"""Readers and writers on small files, awkward ones among them."""

import hashlib
import json
from email.message import EmailMessage

import pytest
from mereweave.operators import content as c
from mereweave.operators import kg
from mereweave.sources import readers, writers


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def mail(text="Body", **headers):
    m = EmailMessage()
    for k, v in headers.items():
        m[k.replace("_", "-")] = v
    m.set_content(text)
    return m


def test_mail_with_an_unknown_charset_and_no_headers(spark, tmp_path):
    good = mail(From="Ann <ann@x.org>", To="b@y.org, c@z.org", Subject="Hi", Message_ID="<1@x>", References="<0@x> <9@x>", Date="not a date")
    (tmp_path / "1").write_bytes(good.as_bytes())
    (tmp_path / "2").write_bytes(b"Subject: odd\nContent-Type: text/plain; charset=klingon\n\nqapla' \xff\n")
    (tmp_path / "3").write_bytes(b"\n")
    got = {r.path.rsplit("/", 1)[1]: r for r in readers.read_maildir(spark, str(tmp_path)).collect()}
    assert (got["1"].to_addresses, got["1"].thread_id, got["1"].date_sent) == (["b@y.org", "c@z.org"], "<0@x>", None)
    assert got["2"].body.startswith("qapla'") and got["3"].subject is None


def test_attachments(spark, tmp_path):
    m = mail(Message_ID="<1@x>")
    m.add_attachment(b"abc", maintype="application", subtype="pdf", filename="a.pdf")
    m.add_attachment("text", filename="b.txt")
    (tmp_path / "1").write_bytes(m.as_bytes())
    (tmp_path / "2").write_bytes(mail().as_bytes())
    got = rows(readers.read_attachments(spark, str(tmp_path)), "message_id", "place", "name", "content_type", "size", "sha256")
    assert got[0] == ("<1@x>", 0, "a.pdf", "application/pdf", 3, hashlib.sha256(b"abc").hexdigest()) and got[1][:4] == ("<1@x>", 1, "b.txt", "text/plain")


def test_mbox(spark, tmp_path):
    (tmp_path / "all.mbox").write_text("From a@x Mon\nFrom: Ann <ann@x.org>\nSubject: One\n\nFirst\n\nFrom b@x Tue\nFrom: Bo <bo@x.org>\nSubject: Two\n\nSecond\n")
    assert rows(readers.read_mbox(spark, str(tmp_path)), "subject", "from_name") == [("One", "Ann"), ("Two", "Bo")]


def test_transcripts_entities_and_feeds(spark, tmp_path):
    for name in ("t", "e", "f"):
        (tmp_path / name).mkdir()
    (tmp_path / "t/a.jsonl").write_text('{"type":"user","timestamp":"1","message":{"content":"hi"}}\nno json\n{"type":"system"}\n')
    (tmp_path / "e/a.jsonl").write_text('{"entity_type":"Person","value":"Ann","confidence":0.9,"properties":{"role":"x"}}\n{broken\n')
    (tmp_path / "f/a.xml").write_text("<rss><item><title>A</title><link>http://a</link><pubDate>Mon, 02 Jan 2023 10:00:00 +0000</pubDate></item><item><title>B</title></item></rss>")
    assert rows(readers.read_transcripts(spark, str(tmp_path / "t")), "type", "message.content") == [("user", "hi")]
    assert [r.properties["role"] for r in readers.read_entities(spark, str(tmp_path / "e")).collect()] == ["x"]
    feed = readers.read_feed(spark, str(tmp_path / "f"))
    assert sorted((r.title, r.published) for r in feed.collect()) == [("A", "Mon, 02 Jan 2023 10:00:00 +0000"), ("B", None)]


def test_repository_and_new_only(spark, tmp_path):
    for name in ("README", "guide.md", "code.py", "notes.txt"):
        (tmp_path / name).write_text(name)
    found = readers.read_repository(spark, str(tmp_path))
    assert sorted(r.content for r in found.collect()) == ["README", "guide.md", "notes.txt"]
    done = found.where("content = 'README'").select("path")
    assert sorted(r.content for r in readers.new_only(found, done, "path").collect()) == ["guide.md", "notes.txt"]


def test_documents_and_pages(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "p").mkdir()
    for name, x in (("a.json", {"id": "1", "content": "x"}), ("twitter_b.json", {"id": "2"}), ("c.txt", {"id": "3"})):
        (tmp_path / "d" / name).write_text(json.dumps(x, indent=1))
    got = readers.read_documents(spark, str(tmp_path / "d"), "id string, content string", ("twitter",))
    assert rows(got, "id", "content") == [("1", "x")]
    (tmp_path / "p/1.json").write_text('{"classes":[{"id":"C1"},{"id":"C2"}],"pagination":{"next_key":"k"}}')
    (tmp_path / "p/2.json").write_text('{"classes":[{"id":"C3"}]}')
    (tmp_path / "p/3.json").write_text("no json")
    assert rows(readers.read_pages(spark, str(tmp_path / "p"), "classes", "id string"), "item.id") == [("C1",), ("C2",), ("C3",)]


def test_snapshots_replace_each_other_as_a_whole(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    writers.write_snapshot(spark.range(3), path)
    writers.write_snapshot(spark.range(5, 7), path)
    assert rows(writers.read_snapshot(spark, path), "id") == [(5,), (6,)]


def test_entity_lines_metrics_append_and_triples(spark, tmp_path):
    e = spark.createDataFrame([("Person", "Ann", 0.9), ("Project", "P001", 0.95)], "entity_type string, value string, confidence double")
    writers.write_entities(e, f"{tmp_path}/e")
    back = readers.read_entities(spark, f"{tmp_path}/e/*").union(readers.read_entities(spark, f"{tmp_path}/e/*").limit(0))
    assert rows(back, "value") == [("Ann",), ("P001",)]
    writers.write_metrics(spark.range(1), f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").count() == 1
    writers.append(spark.range(2), f"{tmp_path}/a")
    writers.append(spark.range(2), f"{tmp_path}/a")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 4
    kg.write_turtle(spark.createDataFrame([("<a>", "rdf:type", "kg:B")], "s string, p string, o string"), f"{tmp_path}/ttl")
    assert spark.read.text(f"{tmp_path}/ttl").first()[0] == "<a> rdf:type kg:B ."


def test_calendar_chunks_and_flags(spark):
    events = spark.createDataFrame([("u", 1, "Sum", "d" * 10, "CANCELLED"), ("v", None, None, None, None)], "uid string, sequence int, summary string, description string, status string")
    chunks, flags = writers.calendar_rows(events, 6)
    assert rows(chunks, "uid", "index", "chunk") == [("u", 0, "Sum\ndd"), ("u", 1, "dddddd"), ("u", 2, "dd")]
    assert {r.uid: (r.cancelled, r.split) for r in flags.collect()} == {"u": (True, True), "v": (None, False)}


def test_content_edges(spark):
    raw = [None, "{}", '{"message":"a"}', '{"message":{"content":["x",{"type":"text","text":"y"},{"type":"image"}]}}', '{"message":{"content":""}}', '{"content":"z"}', "no json"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "id int, raw string")
    assert [r[1] for r in sorted(tuple(r) for r in df.select("id", c.message_text(df.raw)).collect())] == ["", "", "a", "x\ny", "", "z", ""]
    marks = spark.createDataFrame([("a", 3), ("a", 4), ("a", 6), ("b", 1), ("b", 1)], "k string, n long")
    assert rows(c.contiguous_mark(marks, "k", "n"), "k", "first", "mark") == [("a", 3, 4), ("b", 1, 1)]


def test_walk_stops_or_raises(spark):
    import pytest

    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "parent int, child int")
    roots = spark.createDataFrame([("r", 0)], "root string, child int")
    assert kg.walk(roots, edges, 9).count() == 7 and kg.walk(roots, edges, 3).count() == 4
    with pytest.raises(RuntimeError):
        kg.walk(roots, edges, 3, strict=True).count()


def test_entities_validate_and_keep_context(spark):
    d = spark.createDataFrame([(1, "Class c01 and C01, then C001 of Acme Labs. Proposal #42 by Ann Lee. C01"), (2, None)], "id int, text string")
    got = {(r.kind, r.key): (r.value, r.hits) for r in kg.pattern_entities(d, "id", "text").collect()}
    assert got["CreditClass", "C01"] == ("C01", 2) and ("CreditClass", "C001") in got and got["Organization", "ACME LABS"] == ("Acme Labs", 1)
    assert got["Proposal", "PROPOSAL #42"] == ("Proposal #42", 1) and ("Person", "ANN LEE") in got


def test_commits_are_numbered_and_whole(spark, tmp_path):
    path = f"file://{tmp_path}/numbered"
    with pytest.raises(FileNotFoundError):
        writers.read_snapshot(spark, path)
    assert [writers.write_snapshot(spark.range(n), path) for n in (3, 4)] == [0, 1]
    (tmp_path / "numbered" / "v-torn").mkdir()  # a writer that died before its commit
    (tmp_path / "numbered" / "commits" / ".v-torn").write_text("v-torn")
    assert writers.read_snapshot(spark, path).count() == 4 and writers.read_snapshot(spark, path, 0).count() == 3
    assert writers.write_snapshot(spark.range(9), path, 1) == 1  # committed before: not again
    assert writers.read_snapshot(spark, path).count() == 4
    assert writers.write_snapshot(spark.range(9), path, 7) == 7 and writers.commits(spark, path) == [0, 1, 7]


def test_write_through_keeps_the_last_row_of_each_key_and_repeats_no_batch(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    sink = writers.write_through(path, "rid", "seq")
    frame = lambda *r: spark.createDataFrame(list(r), "rid string, hash string, seq long")
    sink(frame(("a", "1", 1), ("b", "1", 2)), 0)
    sink(frame(("a", "2", 5), ("a", "x", 3), ("c", None, 4)), 1)
    sink(frame(("a", "again", 9)), 1)
    sink(frame(("b", "old", 0)), 2)
    assert rows(writers.read_snapshot(spark, path), "rid", "hash", "seq") == [("a", "2", 5), ("b", "1", 2), ("c", None, 4)]


def test_pages_are_followed_to_the_first_gap(spark):
    from mereweave.operators.content import follow_pages

    rows_ = [("a", "", "2"), ("a", "2", "3"), ("a", "3", None), ("b", "", "2"), ("b", "3", "4"), ("b", "4", ""), ("c", "9", "8"), ("d", "", ""), ("d", None, "x"), ("e", "", "x"), ("a", "3", None)]
    reached, gaps = follow_pages(spark.createDataFrame(rows_, "chain string, k string, n string"), "chain", "k", "n")
    assert sorted((r.chain, r.k) for r in reached.collect()) == [("a", ""), ("a", "2"), ("a", "3"), ("a", "3"), ("b", ""), ("d", ""), ("e", "")]
    assert sorted(map(tuple, gaps.collect())) == [("b", "2"), ("e", "x")]


def test_files_of_several_lines_are_one_row(spark, tmp_path):
    (tmp_path / "readme.md").write_text("one\ntwo\n")
    assert [r.content for r in readers.read_repository(spark, f"file://{tmp_path}").collect()] == ["one\ntwo\n"]


def test_mail_is_landed_a_file_each_in_few_folders_and_read_in_few_tasks(spark):
    from mereweave.plans import landed
    from mereweave.plans.views import Views

    path = landed._maildir(Views(spark, "/root/testdata/sf0.01"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(path).select("path").collect()
    assert len(files) == 100
    assert len({f.path.rsplit("/", 1)[0] for f in files}) <= 64
    many = landed._maildir(Views(spark, "/root/testdata/sf0.1"))
    assert readers.read_maildir(spark, many, "*.txt").rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert readers.read_maildir(spark, many, "*.txt").select("message_id").distinct().count() == 1000


def test_a_read_message_holds_no_parse_trees():
    m = mail(Message_ID="<a@x.example>", Subject="On time", From="A <a@x.example>", To="b@x.example", Date="Mon, 01 Jan 2024 10:00:00 +0100")
    got = readers._message("p", m.as_bytes())
    assert got[1:6] == ("<a@x.example>", "<a@x.example>", "a@x.example", "A", ["b@x.example"]) and got[6] == "On time"
    assert all(type(x) in (str, list, int) for x in got)
    assert [len(f) for f in readers._rows((got for _ in range(2500)), readers._MAIL)] == [1000, 1000, 500]
