"""The toxicity classifier: parts against plain versions, gradients against differences, held-out accuracy, awkward rows."""

import re

import numpy as np
import pyarrow as pa
import pytest

from mereweave.llm import queries, toxicity

NOISE = ["stone", "river", "walks", "lantern", "über", "maison", "pequeño", "grün", "table", "window", "seven", "cloud"]


def small_model(seed=1, bits=10, dim=5, filters=3):
    rng = np.random.default_rng(seed)
    conv = [rng.standard_normal((k, dim, filters)).astype(np.float32) for k in (1, 2, 3)]
    return toxicity.Model(rng.standard_normal((1 << bits, dim)).astype(np.float32), conv, rng.standard_normal(9).astype(np.float32), rng.standard_normal(9).astype(np.float32), 0.1, bits, threshold=np.zeros(1))


def test_pooling_matches_a_plain_version():
    texts = [None, "", "...", "One", "one ONE two", "a " * 700 + "end", "x" * 900, "Ünïcode, çela va-t-il?", "same same same", "two words"]
    model = small_model()
    w = toxicity.Words(pa.array(texts), model.bits)
    v, count = toxicity.vectors(w.features(0, len(w.hashes)), model.table, len(w.hashes))
    spans = [bytes(w.data[a:b]).decode() for a, b in zip(w.starts, w.ends, strict=True)]
    for word, n in zip(spans, count, strict=True):
        size = len(word.encode()) + 2
        assert n == 1 + sum(max(0, size - g + 1) for g in (3, 4, 5, 6))
    for block in (7, 100_000):
        got = toxicity.pooled(model, w, step=3, block=block)
        for row, text in enumerate(texts):
            own = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
            x = [v[spans.index(t)] for t in own] + [np.zeros(5, np.float32)] * 2
            want = []
            for k, f in enumerate(model.filters):
                values = [sum(x[i + j] @ f[j] for j in range(k + 1)) for i in range(len(own))]
                want += list(np.max(values, axis=0)) if values else [-np.inf] * 3
            assert np.allclose(got[row], np.maximum(np.array(want) + model.bias, 0), atol=1e-4)


def test_gradients_match_differences():
    texts = pa.array(["one two three four", "five two six", "seven", "one six eight nine ten"])
    label = np.array([1.0, 0.0, 1.0, 0.0], np.float32)
    model, rows = small_model(3), np.arange(4)
    w = toxicity.Words(texts, model.bits)
    flat = toxicity._by_word([w.features(0, len(w.hashes))], len(w.hashes))

    class Seen:
        def __init__(self):
            self.grad = self.rows = None

        def step(self, grad, rows=None):
            self.grad, self.rows = grad, rows

    class Keep:
        def random(self, n):
            return np.ones(n)

    table, conv, bias, out, base = Seen(), [Seen(), Seen(), Seen()], Seen(), Seen(), Seen()
    toxicity._batch(Keep(), model, w, flat, rows, label, np.array([0.1]), table, conv, bias, out, base)

    def loss():
        z = toxicity.pooled_rows(model, w, flat, rows).astype(float) @ model.out + 0.1
        return np.mean(np.logaddexp(0, np.where(label == 1, -z, z)))

    def check(array, at, grad):
        before, eps = array[at], 1e-2
        array[at] = before + eps
        high = loss()
        array[at] = before - eps
        low = loss()
        array[at] = before
        assert abs((high - low) / (2 * eps) - grad) < 5e-3

    for k in range(3):
        for at in [(0, 1, 2), (k, 4, 0)]:
            check(model.filters[k], at, conv[k].grad[at])
    check(model.bias, 4, bias.grad[4])
    check(model.out, 2, out.grad[2])
    for i in (0, len(table.rows) // 2, len(table.rows) - 1):
        check(model.table, (table.rows[i], 1), table.grad[i, 1])


def made(n, seed=0):
    """Texts of two languages; label 1 holds inflected forms of a stem of its language."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        own = [f"{lang}{x}" for x in rng.choice(NOISE, 30)]
        bad = int(i % 5 == 0)
        if bad:
            stem = {"aa": "zorkel", "bb": "quabb"}[lang]
            own[rng.integers(0, 30)] = stem + rng.choice(["", "en", "ung", "ly", "s", "er", "ment"])
        rows.append((i, " ".join(own), lang, bad))
    return rows


def test_learns_stems_in_both_languages_and_scores_awkward_rows(spark):
    rows = made(700)
    docs = spark.createDataFrame([(i, t, "clash", lang, "x") for i, t, lang, _ in rows] + [(None, None, "c", None, "x"), (9001, "", "c", "aa", "x"), (9002, "?!", "c", None, "x"), (3, rows[3][1], "c", "aa", "x"), (9003, "Zorkelhaft " * 50_000, "c", None, "x")], "doc_id long, text string, score string, lang string, predicted string")
    labels = spark.createDataFrame([(i, bad, "x") for i, _, _, bad in rows if i % 7] + [(None, 1, "x"), (77_777, 1, "x"), (9001, None, "x"), (9002, 7, "x"), (1, 0, "y"), (1, 0, "y")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 705
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    held = [r for r in rows if r[0] % 7 == 0]
    assert sum(by[i] == bad for i, _, _, bad in held) >= 0.97 * len(held)
    assert by[9003] == 1
    assert by[9001] == by[9002] == by[None] == 0
    again = toxicity.score(docs, toxicity.fit(docs, labels))
    assert sorted((r.doc_id or -1, r.score) for r in again.collect()) == sorted((r.doc_id or -1, r.score) for r in got)


def test_all_labelled_rows_are_learned_whatever_bounds_the_start(spark, monkeypatch):
    rows = made(1400)
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows] + [(5000, "one of its own", "cc")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, bad) for i, _, _, bad in rows if i % 7] + [(5000, 0)], "doc_id long, toxic int")
    learned, whole = [], toxicity._round
    monkeypatch.setattr(toxicity, "_round", lambda *args: (out := whole(*args), learned.append(out[2]))[0])
    model = toxicity.fit(docs, labels, per_class=20, shard_rows=500)
    assert model.langs == ["aa", "bb", "cc"]
    hashes = docs.join(labels, "doc_id").selectExpr("xxhash64(text) as h").distinct().where("h % 4 <> 0")
    assert learned == [hashes.count()] * 2
    by = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    held = [r for r in rows if r[0] % 7 == 0]
    assert sum(by[i] == bad for i, _, _, bad in held) >= 0.95 * len(held)


def test_texts_without_a_label_do_not_travel(spark):
    docs = spark.range(-20_000, 60_000).selectExpr("id as doc_id", "'t' as text").union(spark.sql("select null, 'none'"))
    for every, most_log in ((10, 27), (10, 15), (100_000, 27)):
        own = spark.range(-20_000, 60_000, every).selectExpr("id as doc_id", "1 as label")
        n = own.count()
        got = toxicity._likely(docs, own, "doc_id", n, most_log)
        assert got.columns == docs.columns and got.join(own, "doc_id").count() == n
        assert got.count() <= n + (0.08 if most_log == 27 else 0.25) * 80_000
    assert toxicity._likely(docs, own.limit(0), "doc_id", 0).count() == 0
    assert toxicity._likely(docs, own.selectExpr("cast(doc_id as int) as doc_id"), "doc_id", 1).count() == docs.count()
    names = docs.selectExpr("cast(doc_id as string) as doc_id", "text")
    assert toxicity._likely(names, spark.createDataFrame([("7",), ("x",)], "doc_id string"), "doc_id", 2).where("doc_id = '7'").count() == 1


def test_threshold_of_bins_is_that_of_single_logits():
    rng = np.random.default_rng(4)
    z = rng.standard_normal(500)
    y = (z + rng.standard_normal(500) > 1).astype(int)
    at, of = np.unique(np.floor(z * 100_000), return_inverse=True)
    assert toxicity._best_cut(z[np.argsort(of)], z[np.argsort(of)], y[np.argsort(of)], 1 - y[np.argsort(of)]) == toxicity.best_threshold(z, y)


@pytest.mark.parametrize("label", [None, 0, 1])
def test_without_both_labels(spark, label):
    docs = spark.createDataFrame([(1, "some text", "en"), (2, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, label)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert [r.score for r in toxicity.score(docs, model).collect()] == [float(label or 0)] * 2
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_threshold_is_that_of_the_best_f1():
    z, y = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([1, 1, 0, 1, 0])
    assert toxicity.best_threshold(z, y) == -0.5
    assert toxicity.best_threshold(np.array([3.0, 2.0, 1.0]), np.array([1, 0, 0])) == 2.5


def test_query_at_the_smallest_scale(spark):
    got = queries.op11_toxicity(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert got.count() == 200
