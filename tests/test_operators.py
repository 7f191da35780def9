"""Hand-computed cases of the operators that SQL does not express, and of their quirks."""

import random
import time
from datetime import datetime, timezone
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from mereweave.functions import text as t
from mereweave.operators import documents as doc
from mereweave.operators import events as ev
from mereweave.operators import kg
from mereweave.sources import readers, writers


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_a_b_a_all_pass(spark):
    log = spark.createDataFrame([(1, "u", "a"), (2, "u", "b"), (3, "u", "a"), (4, "u", "a"), (5, "u", None), (6, "u", None)], "seq long, key string, hash string")
    out = ev.mark_consecutive_duplicates(log, F.col("key"), F.col("hash"))
    assert rows(out, "seq", "duplicate") == [(1, False), (2, False), (3, False), (4, True), (5, False), (6, False)]


def test_bypass_rows_neither_match_nor_count(spark):
    log = spark.createDataFrame([(1, "podcast:1", "a"), (2, "podcast:1", "a")], "seq long, key string, hash string")
    out = ev.mark_consecutive_duplicates(log, F.col("key"), F.col("hash"), bypass=F.contains("key", F.lit("podcast")))
    assert rows(out, "seq", "duplicate") == [(1, False), (2, False)]


def test_fold_ignores_updates_without_content_and_forgets(spark):
    log = spark.createDataFrame([(1, "NEW", "a", "h1"), (2, "UPDATE", "a", None), (3, "NEW", "b", "h2"), (4, "FORGET", "b", None)], "seq long, event_type string, rid string, hash string")
    assert rows(ev.current_state(log), "rid", "hash", "last_seq") == [("a", "h1", 1)]


def test_deliveries_filter_before_the_limit(spark):
    log = spark.createDataFrame([(i, "x" if i % 2 else "y", f"r{i}") for i in range(10)], "seq long, kind string, rid string")
    edges = spark.createDataFrame([("n", "x"), ("all", None)], "node string, kind string")
    assert rows(ev.deliveries(log, edges, 2), "node", "seq") == [("all", 0), ("all", 1), ("n", 1), ("n", 3)]


def test_prune_keeps_protected_rows(spark):
    items = spark.createDataFrame([(1, 50, "p"), (2, 50, "x"), (3, 50, "x"), (4, 50, "x")], "age int, size int, k string").withColumn("key", F.col("age"))
    out = ev.prune(items, F.lit(0), F.lit(0), 120, "age", "size", "key", F.col("k") == "p")
    assert rows(out.where("pruned_by = 'size'"), "age") == [(2,), (3,)]


@pytest.mark.parametrize(("rid", "ns"), [("orn:web.page:d/h", "web.page"), ("https://x.y", None), ("ledger.unknown:id", "ledger.unknown")])
def test_namespace(spark, rid, ns):
    assert spark.range(1).select(t.namespace(F.lit(rid))).first()[0] == ns


def test_rid_split(spark):
    r = spark.range(1).select(t.rid_context(F.lit("https://example.com:8080/path")), t.rid_reference(F.lit("https://example.com:8080/path"))).first()
    assert tuple(r) == ("https", "//example.com:8080/path")


def test_slug(spark):
    assert spark.range(1).select(t.slug(F.lit("Jane Doe"))).first()[0] == "jane-doe"


def test_secrets_of_all_eight_patterns(spark, tmp_path):
    from mereweave import plans

    k = "Ab1" * 9
    cases = [
        (f"API_TOKEN='a b' x_KEY=1 éAB=2 A=1 DB_URL=\"q r\" Xsk-{k}", "[REDACTED_ENV] x_KEY=1 éAB=2 A=1 [REDACTED_ENV] Xsk-" + k),
        (f"sk-{k} ghp_{'a' * 20} ghp_{'a' * 19} ghu_{k} github_pat_{k}_1", f"[REDACTED_KEY] [REDACTED_KEY] ghp_{'a' * 19} [REDACTED_KEY] [REDACTED_KEY]"),
        (f"Bearer  {k}.x-y_z, Bearer short", "Bearer [REDACTED], Bearer short"),
        ("a\n-----BEGIN RSA PRIVATE KEY-----\nMII\nxx\n-----END RSA PRIVATE KEY-----\nb", "a\n[REDACTED_PRIVATE_KEY]\nb"),
        ("see redis://h:1/0 and mysql://u:p@h/db.", "see [REDACTED_CONN_STRING] and [REDACTED_CONN_STRING]"),
        ("go https://u:p@h/x now http://plain.org/", "go [REDACTED_URL_CREDS] now http://plain.org/"),
        (f"b {'z' * 50}== {'z' * 49}", f"b [REDACTED_BASE64] {'z' * 49}"),
        ("open /a/.env.local, my_secrets\u00a0x.pem é.key.k ok", "open [REDACTED_PATH] [REDACTED_PATH]\u00a0[REDACTED_PATH] [REDACTED_PATH] ok"),
        ("nothing here password=hunter2", "nothing here password=hunter2"),
        (None, None),
    ]
    spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(rows(plans.load().QUERIES["str_14_redact_secrets"](spark, str(tmp_path)), "doc_id", "clean"))
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_nearest_vectors_answer_every_hundredth_row(spark):
    import duckdb

    from mereweave import plans

    sf = "/root/testdata/sf0.001"
    sql = f"""with e as (select vec_id, embedding::double[] as v from '{sf}/embeddings.parquet')
        select q.vec_id, e.vec_id, round(list_cosine_similarity(q.v, e.v), 6) from e q, e where q.vec_id % 100 = 0 and e.vec_id <> q.vec_id
        qualify row_number() over (partition by q.vec_id order by list_cosine_similarity(q.v, e.v) desc, e.vec_id) <= 10"""
    got = rows(plans.load().QUERIES["top_08_nearest_vectors"](spark, sf), "query_id", "vec_id", "similarity")
    want = sorted(duckdb.sql(sql).fetchall())
    assert [x[:2] for x in got] == [x[:2] for x in want] and len({x[0] for x in got}) == 5
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1.1e-6)


def test_nearest_vectors_break_ties_by_id_and_skip_the_query(spark, tmp_path):
    from mereweave import plans

    e = [(i, [1.0, 0.0]) for i in range(12, 0, -1)] + [(100, [2.0, 0.0]), (101, None), (102, [0.0, 0.0]), (200, [0.0, 1.0]), (300, None)]
    spark.createDataFrame(e, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = rows(plans.load().QUERIES["top_08_nearest_vectors"](spark, str(tmp_path)), "query_id", "vec_id", "similarity")
    assert [x for x in got if x[0] == 100] == [(100, i, 1.0) for i in range(1, 11)]
    assert [x[1] for x in got if x[0] == 200] == [*range(1, 11)] and {x[2] for x in got if x[0] == 300} == {None}


def test_similar_names_equals_all_pairs(spark):
    names = ["alpha corp", "alpha corps", "alpha", "beta ltd", "beta ltd.", "gamma"]
    df = spark.createDataFrame([(i, "b", n) for i, n in enumerate(names)], "id int, block string, name string")
    want = sorted((i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if SequenceMatcher(None, names[i], names[j]).ratio() >= 0.85)
    assert rows(kg.similar_names(df, "block", "id", "name", 0.85), "a", "b") == want


def test_components_of_a_chain_and_a_loop(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(30, 31), (31, 32), (32, 30), (40, 40)], "a long, b long")
    out = dict(rows(kg.components(e), "node", "component"))
    assert all(out[i] == 1 for i in range(1, 21)) and all(out[i] == 30 for i in (30, 31, 32)) and 40 not in out


def test_components_of_all_orders(spark):
    import pyarrow.parquet as pq

    from mereweave import plans

    sf = "/root/testdata/sf0.001"
    lines = pq.read_table(f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_suppkey"]).to_pylist()
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for r in lines:
        up[root(("s", r["l_suppkey"]))] = root(("o", r["l_orderkey"]))
    orders: dict = {}
    for o in {r["l_orderkey"] for r in lines}:
        orders.setdefault(root(("o", o)), []).append(o)
    want = {o: min(group) for group in orders.values() if len(group) > 1 for o in group}
    assert dict(rows(plans.load().QUERIES["grf_01_components"](spark, sf), "node", "component")) == want and len(want) > 1000


def test_tasks_of_components_stay_small(spark, monkeypatch):
    """The parts of a shuffle grow with the rows and what a task reads is bounded, only while it lasts."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, seen, whole, small = [spark.conf.get(n) for n in names], [], kg.durable, kg.small_tasks
    monkeypatch.setattr(kg, "durable", lambda df: (seen.append([spark.conf.get(n) for n in names]), whole(df))[1])
    monkeypatch.setattr(kg, "small_tasks", lambda s, n: small(s, n, per=10))
    out = kg.components(spark.range(300).selectExpr("id + 1 as a", "id as b"))
    assert all(x == ["60", "8m", "8m"] for x in seen[1:]) and len(seen) > 2
    assert [spark.conf.get(n) for n in names] == before
    assert out.where("component = 0").count() == out.count() == 301


def test_version_fold_is_in_arrival_order(spark):
    r = spark.createDataFrame([("u", 2, "20240101", 1), ("u", 1, "20240201", 2), ("u", None, "20240301", 3), ("u", 0, "20240215", 4)], "uid string, sequence int, stamp string, arrival long")
    assert rows(kg.version_winner(r), "uid", "arrival") == [("u", 3)]


def test_contradictions(spark):
    s = spark.createDataFrame([(1, 1, "the blue class", "it is valid"), (2, 2, "the blue class", "it is not valid"), (3, 1, "the blue class", "it is not valid")], "id int, extraction int, subject string, text string")
    assert rows(kg.contradictions(s), "a", "b") == [(1, 2)]


def test_contradictions_equal_all_pairs(spark):
    said = [(1, 1, "red class", "red class is valid"), (2, 2, "red class", "red class is not valid"), (3, 3, "the red class of 2020", "red class is not valid"), (4, 4, None, "red class seems valid not now"), (5, 5, "other", "blue red class seems valid now"), (6, 6, "x", "it cannot go"), (7, 7, "X", "it can go"), (8, 8, "is the a", "is the a of"), (9, 9, "on is the", "is the a not of"), (10, 10, "y", "red class seems valid now"), (11, 10, "y", "red class seems not valid now"), (12, None, " ", "we don't go"), (13, None, "z", "we do go"), (14, 11, "z", None), (15, 12, "the", "we do go")]
    stop = set("the a an and or but in on at to for of is are was were".split())
    plain = lambda x: set(x.lower().replace("not ", "").replace("n't ", " ").split())
    negated = lambda x: "not " in x.lower() or "n't " in x.lower()

    def meet(p, q):
        a, b = (p[2] or "").lower().strip(), (q[2] or "").lower().strip()
        alike = bool(p[2] and q[2]) and (a in b or b in a) or len((set(p[3].lower().split()) & set(q[3].lower().split())) - stop) >= 3
        union = plain(p[3]) | plain(q[3])
        return p[1] != q[1] and alike and len(plain(p[3]) & plain(q[3])) / len(union) > 0.8 and negated(p[3]) != negated(q[3])

    texts = [p for p in said if p[3]]
    want = sorted((p[0], q[0]) for i, p in enumerate(texts) for q in texts[i + 1 :] if meet(p, q))
    assert {(1, 2), (1, 3), (4, 10), (12, 15)} <= set(want)
    assert rows(kg.contradictions(spark.createDataFrame(said, "id int, extraction int, subject string, text string")), "a", "b") == want


def test_contradictions_are_sought_in_all_documents(spark, tmp_path):
    from mereweave import plans

    docs = [(1, "Intro here. Red class is valid."), (2, "Red class is not valid! More."), (3, "Nothing.")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(plans.load().QUERIES["join_10_contradictions"](spark, str(tmp_path)), "a", "b") == [("1/1", "2/0")]


def test_token_windows_end_on_long_texts(spark):
    df = spark.createDataFrame([(n, " ".join(["w"] * n)) for n in (0, 1, 500, 501, 950, 1000)], "id int, text string")
    got = rows(doc.token_windows(df, "id", "text", 500, 50), "id", "start_token", "end_token")
    assert got == [(1, 0, 1), (500, 0, 500), (501, 0, 500), (501, 450, 501), (950, 0, 500), (950, 450, 950), (1000, 0, 500), (1000, 450, 950), (1000, 900, 1000)]


def test_sentence_spans_keep_the_tail():
    tokens = ["w"] * 600
    tokens[479] = "end."
    spans = doc.sentence_spans(tokens, 500, 50, 100)
    assert spans[0] == (0, 480) and spans[-1][1] == 600


def test_page_text_drops_repeated_blocks():
    html = "<html><head><title>T</title><script>x</script></head><body><nav>menu</nav><p>Hello &amp; more</p><p>Hello</p><footer>f</footer></body></html>"
    assert doc.page_text(html) == "T\nHello & more"
    assert doc.page_text(None) == ""


def test_calendar_gap_and_default_zone():
    assert doc.calendar_utc("20240310T023000") == datetime(2024, 3, 10, 10, 30, tzinfo=timezone.utc)
    assert doc.calendar_utc("20240101") == datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert doc.duration("P1DT2H30M").total_seconds() == 95400


def test_calendar_and_mail_files(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/a.ics").write_text("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:1\r\nSEQUENCE:2\r\nDTSTART:20240101T100000Z\r\nDURATION:PT1H\r\nSUMMARY:Long\r\n er\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:no uid\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    assert rows(readers.read_calendars(spark, str(tmp_path / "c")), "uid", "sequence", "summary", "ends") == [("1", 2, "Longer", "2024-01-01T11:00:00+00:00")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m/1").write_text("From: Ann <ann@x.org>\nTo: bob@y.org\nSubject: Hi\nMessage-ID: <1@x>\nDate: Mon, 02 Jan 2023 10:00:00 +0000\n\nBody\n")
    r = readers.read_maildir(spark, str(tmp_path / "m")).first()
    assert (r.from_address, r.from_name, r.subject, r.body.strip(), r.date_sent) == ("ann@x.org", "Ann", "Hi", "Body", "2023-01-02T10:00:00+00:00")


def test_replace_children_touches_only_its_keys(spark, tmp_path):
    path = str(tmp_path / "chunks")
    writers.replace_children(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, x string"), path, "k")
    writers.replace_children(spark.createDataFrame([(1, "z")], "k int, x string"), path, "k")
    assert rows(spark.read.parquet(path), "k", "x") == [(1, "z"), (2, "c")]


def test_whitelist_matches_whole_words(spark):
    d = spark.createDataFrame([(1, "The Blue Class is here"), (2, "bluest class"), (3, None)], "id int, text string")
    n = spark.createDataFrame([("blue class", "x"), ("blue", "y")], "name string, kind string")
    assert rows(kg.whitelist_hits(d, "id", "text", n), "id", "name") == [(1, "blue"), (1, "blue class")]


def test_running_total_and_rank(spark):
    from mereweave.operators import ordered

    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1009).alias("k"), F.col("id").alias("v")).repartition(7)
    data = sorted((r.k, r.v) for r in df.collect())
    want, total = [], 0
    for i, (k, v) in enumerate(data, 1):
        total += v
        want.append((k, total, i))
    assert rows(ordered.rank(ordered.running_total(df, F.col("v"), "total", "k", "v"), "n", "k", "v"), "k", "total", "n") == want


def test_sentence_windows_in_columns_match_the_walk(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "one", "A. " * 700, " ".join(rng.choice(["w", "end.", 'x"', 'y?")', "z!"]) for _ in range(3000)), "w " * 1400, "a b\x1cc d. e"]
    texts += [" ".join(rng.choice(["w", "w", "w", "v."]) for _ in range(n)) for n in (99, 100, 101, 499, 500, 501, 540, 599, 600, 949, 951)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for size, overlap, least in ((500, 50, 100), (10, 3, 4), (7, 0, 6), (5, 5, 2)):
        got = {}
        for r in doc.sentence_windows(df, "id", "text", size, overlap, least).collect():
            got.setdefault(r.id, {})[r["index"]] = (r.start_token, r.end_token)
            assert r.chunk == " ".join((texts[r.id] or "").split()[r.start_token : r.end_token])
        for i, text in enumerate(texts):
            want = doc.sentence_spans((text or "").split(), size, overlap, least)
            assert [got.get(i, {})[k] for k in range(len(got.get(i, {})))] == want


def test_contained_blocks_go_as_in_all_pairs():
    rng = random.Random(5)
    for _ in range(60):
        blocks = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 40))]
        kept = []
        for b in blocks:
            if not any(b in k for k in kept):
                kept.append(b)
        assert doc.without_contained(blocks) == kept
    began = time.time()
    assert len(doc.without_contained([f"block {i} of a long page, with words in it" for i in range(10_000)])) == 10_000
    assert time.time() - began < 5


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"message":"{braces}"}', "{braces}"), ('{"message":"[1]"}', "[1]"), ('{"message":{"content":"[not a list"}}', "[not a list"), ('{"message":{"content":"{no object"}}', "{no object"), ('{"message":{"content":["a",{"type":"text","text":"{b"},{"type":"image","text":"c"},{"type":"text"},7]}}', "a\n{b\n"),
        ('{"content":"{plain"}', "{plain"), ('{"message":{"content":[]}}', ""), ('{"message":{}}', ""), ("{broken", ""), (None, ""), ('{"message":null,"content":"c"}', "c"), ('{"message":{"content":null}}', ""),
    ],
)
def test_message_texts_by_the_kind_of_their_json(spark, raw, want):
    from mereweave.operators.content import message_text

    assert spark.createDataFrame([(raw,)], "r string").select(message_text(F.col("r"))).first()[0] == want


def test_nearest_vectors_of_mixed_lengths(spark):
    """Only vectors of one length are near; what else stands in a block changes nothing."""
    from mereweave.operators.vectors import nearest

    rows_ = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.0, 0.0]), (3, [0.9, 0.1, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [0.0, 1.0]), (7, [])]
    df = spark.createDataFrame(rows_, "id long, v array<double>").coalesce(1)
    got = {(r.query_id, r.vec_id): r.s for r in nearest(df.where("id in (0, 2)"), df, "id", "v", 3).collect()}
    assert [k for k, s in sorted(got.items()) if s is not None] == [(0, 1), (0, 6), (2, 3)]
    assert abs(got[0, 1] - 1 / 1.01**0.5) < 1e-12 and got[0, 6] == 0.0


def test_secrets_are_redacted_as_by_the_patterns_alone(spark):
    from pyspark.sql import functions as F

    from mereweave.functions import text as t

    run = "aB3/" * 13
    texts = [
        None, "", "plain", "API_KEY=abc x", "A_B='p q' c", "sk-" + "a" * 20, "ghp_" + "b" * 25 + " github_pat_" + "c" * 22, "Bearer " + "t" * 30, "-----BEGIN RSA PRIVATE KEY-----\nx\n-----END RSA PRIVATE KEY-----",
        "redis://h:1/x", "see https://u:p@h/x and http://a.b/c", run, run + "==" + run, "=" + run + "+", "ab" * 24, "x " + run[:50] + "=" + run[:49], "conf/.env secrets.yml a.pem b.key", "KEY=sk-" + "z" * 30 + " .key",
    ]
    plain = [(p if "50,}" not in p else p.replace("(?<![A-Za-z0-9+/])", ""), mark) for p, mark in t.SECRETS]
    want = F.col("text")
    for pattern, mark in plain:
        want = F.regexp_replace(want, pattern, mark)
    rows = spark.createDataFrame([(x,) for x in texts], "text string").select(t.redact_secrets(F.col("text")).alias("got"), want.alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert sum(r.got != x for r, x in zip(rows, texts, strict=True)) >= 12
