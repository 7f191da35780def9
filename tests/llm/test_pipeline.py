"""The pipeline's stages against brute force: columns, decisions and their effect."""

import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
from tests_llm_brute import near_groups, repeated_words

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(900_001, "!!! 123", None, "srcX", 7), (900_002, None, None, None, None)], source.schema)
    docs, seen = source.union(extra), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = None if k == 3 else rows_of(docs)
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append((before, docs))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == source.columns
    # language ID: what has a letter stays
    before, after = seen[0]
    assert sorted(rows_of(after)) == sorted((i, t) for i, t in before if t and any(c.isalpha() for c in t))
    truth = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    assert np.mean([truth[r.doc_id] in (None, r.lang) for r in after.collect()]) > 0.9
    # MinHash: the smallest id of each brute-force group
    before, after = seen[1]
    groups = near_groups(before, 5, 80, 100)
    assert sorted(i for i, _ in rows_of(after)) == sorted(i for i, low in groups.items() if i == low)
    # substrings: the words outside repeated windows
    before, after = seen[2]
    want = repeated_words(before, 35)
    assert {i: t for i, t in rows_of(after)} == {i: want.get(i, t) for i, t in before}
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.doc_id in want) and want
    # packing: every token once, sequences gapless and full
    from tokenizers import Tokenizer

    tok, rows = Tokenizer.from_file(P.path("word_bpe_49k.json")), seen[3][1].collect()
    lengths = Counter()
    for r in rows:
        lengths[r.doc_id] += r.length
    assert lengths == Counter({i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows_of(seen[2][1])})
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and parts[-1][0] + parts[-1][1] <= 4096
    assert len(by_sequence) <= -(-sum(lengths.values()) // 4096) + 1


def awkward(spark):
    one, two = " ".join(f"alpha{i}" for i in range(60)), " ".join(f"beta{i}" for i in range(60))
    rows = [(1, one), (1, two), (2, one), (2, "other words here"), (None, two), (None, "null id text"), (3, "same row"), (3, "same row"), (4, ""), (5, None), (6, "?!")]
    made = [(i, t, None, "s", len(t or ""), "clash", 1, "x") for i, t in rows]
    return spark.createDataFrame(made, SCHEMA + ", lang_pred string, row int, kept string").withColumnRenamed("row", "key")


def test_stages_on_null_and_repeated_ids_and_clashing_columns(spark):
    docs = awkward(spark)
    same = lambda df: sorted((i is not None, i or 0, t or "") for i, t in rows_of(df))
    texts = {t for _, t in rows_of(STAGE["language ID"](spark, docs, SF))}
    assert texts <= {None}  # no label to learn from: no text has a language
    near = same(STAGE["MinHash near-dedup"](spark, docs.withColumn("row", docs.key), SF))
    one, two = " ".join(f"alpha{i}" for i in range(60)), " ".join(f"beta{i}" for i in range(60))
    assert near == sorted([(True, 1, one), (True, 2, "other words here"), (False, 0, two), (False, 0, "null id text"), (True, 3, "same row"), (True, 4, ""), (True, 5, ""), (True, 6, "?!")])
    less = same(STAGE["substring dedup"](spark, docs, SF))
    assert less == sorted([(True, 1, ""), (True, 1, ""), (True, 2, ""), (True, 2, "other words here"), (False, 0, ""), (False, 0, "null id text"), (True, 3, "same row"), (True, 3, "same row"), (True, 4, ""), (True, 5, ""), (True, 6, "?!")])
    assert STAGE["best-fit packing"](spark, docs, SF).count() == 11
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
