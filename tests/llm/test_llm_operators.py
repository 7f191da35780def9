"""The training-data operators against brute force, exact round trips and held-out accuracy, with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest

from mereweave.llm import bpe, flac, html_text, langid, minhash, packing, queries, quotes, substrings, token_files, vectors
from mereweave.llm.common import Cut
from mereweave.llm.word_tokens import UnitEncoder

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [None, "", " ", "a", "A,,", "two words", "x" * 3000, "İstanbul, STRASSE.", "<|endoftext|> x", "don't, we'll.", "tab\there\x1cq", "é ﬁ 日本語", "  lead and trail  ", "a\n \nb\n\n  c"]


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def documents(spark, texts):
    rows = [(i, t, "clash", "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, key string, n int")


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in table("documents")]


# --- 1 ---


def brute_vectors(ids, vectors_, threshold):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for v in vectors_]
    links = {i: set() for i in range(len(ids))}
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if ok[i] and ok[j] and len(vectors_[i]) == len(vectors_[j]):
                a, b = np.array(vectors_[i], np.float64), np.array(vectors_[j], np.float64)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = {}
    for i in range(len(ids)):
        seen, stack = {i}, [i]
        while stack:
            for j in links[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        out[ids[i]] = (len(links[i]), min(ids[k] for k in seen))
    return out


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 16))
    rows = [(base[i % 12] + 0.18 * rng.standard_normal(16)).astype(np.float32).tolist() for i in range(150)]
    rows += [rows[0], rows[0], None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 0.0, 0.0], [1.0, 0.01, 0.0]]
    df = spark.createDataFrame([(i, r, 0, "x") for i, r in enumerate(rows)], "vec_id long, embedding array<float>, n int, key string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, recall=0.9999).collect()}
    assert got == brute_vectors(list(range(len(rows))), rows, 0.95)
    for tile, small in ((7, 2), (50, 5), (1500, 10_000)):
        tiles = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, recall=0.9999, tile=tile, small=small).collect()}
        assert tiles == got


def test_vectors_recall_at_production_settings(spark):
    """Pairs planted at a cosine just over the threshold among unrelated vectors: links found, and none that is none."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal((2000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((2000, 64))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9502, 0.956, (2000, 1))
    rows = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()}
    assert all(got[i + 2000][1] in (i, i + 2000) and got[i][0] <= 1 for i in range(2000))
    assert sum(got[i + 2000][1] == i for i in range(2000)) / 2000 >= 0.99


def test_vectors_in_double_precision_with_odd_rows(spark):
    """Doubles beyond the range of floats, differences below their precision, null and repeated ids."""
    wide = [0.1, 0.2, 0.3, 0.4]
    rows = [(1, wide), (2, [x * 1e300 for x in wide]), (3, [x * 1e-300 for x in wide]), (4, [1e-50, 0.0, 0.0, 0.0]), (5, [1.0, 1e-9, 0.0, 0.0]), (None, wide), (7, [0.0, 0.0, 1.0, 0.0]), (7, [0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df, recall=0.999999).collect()))
    assert got == [(0, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 4, True), (5, 1, 4, False), (7, 1, 7, True), (7, 1, 7, True)]


def test_vectors_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- 2 ---


@pytest.fixture(scope="module")
def duck_bpe():
    return bpe.DuckBpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def test_bpe_matches_the_library_and_round_trips(duck_bpe, docs):
    import tiktoken

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=duck_bpe.ranks, special_tokens={})
    texts = [*AWKWARD, " \n\n", "a  b   c ", *[t for _, t in docs[:60]]]
    for text, (ids, decoded) in zip(texts, duck_bpe.encode(texts), strict=True):
        assert ids.decode() == ",".join(map(str, lib.encode_ordinary(text or "")))
        assert decoded == (text or "").encode()


def test_bpe_of_long_pieces(duck_bpe):
    """Pieces without a space, where one step contracts many pairs: as the library does, and in seconds."""
    import time

    import tiktoken

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=duck_bpe.ranks, special_tokens={})
    rng = np.random.default_rng(4)
    letters = lambda n, of: "".join(of[k] for k in rng.integers(0, len(of), n))
    texts = ["x" * 97, "a" * 5000, "ab" * 900, letters(3000, "abc"), letters(2000, "etaoinshrdlu"), letters(900, "日本語中文字漢水火木金土"), "é" * 333, "=" * 2000, letters(1500, "aA1=+/bB2")]
    texts += [letters(int(n), "theinganor") for n in rng.integers(90, 400, 60)]
    for text, (ids, decoded) in zip(texts, duck_bpe.encode(texts), strict=True):
        assert ids.decode() == ",".join(map(str, lib.encode_ordinary(text))) and decoded == text.encode()
    start, text = time.time(), letters(20_000, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
    assert duck_bpe.encode([text])[0][0].decode() == ",".join(map(str, lib.encode_ordinary(text)))
    assert time.time() - start < 60


def test_bpe_query_columns(spark):
    out = bpe.digests(documents(spark, AWKWARD), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert {r.doc_id: r.decoded_sha256 for r in out} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(AWKWARD)}
    lists = bpe.encode_decode(documents(spark, AWKWARD), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert {r.doc_id: hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in lists} == {r.doc_id: r.ids_sha256 for r in out}


# --- 3 ---


def brute_repeats(rows, window):
    split = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substrings_match_brute_force(spark, docs):
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    shared, twice = word(60), word(40)
    texts = [*AWKWARD, *[f"{word(rng.integers(0, 50))} {shared} {word(rng.integers(0, 50))}" for _ in range(20)], f"{twice} {word(3)} {twice}", word(34), shared, shared, "same " * 90, *[t for _, t in docs[:80]]]
    got = sorted(tuple(r) for r in substrings.digests(documents(spark, texts)).collect())
    assert got == brute_repeats(list(enumerate(texts)), 35)


@pytest.mark.parametrize("per_part", [200, 2])
def test_substrings_dealt_over_several_levels(spark, per_part):
    """About 10,000 words over 64 and 8,192 parts (one and two deals), with a passage in every document."""
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 50, n))
    shared = word(50)
    texts = [f"{word(rng.integers(0, 120))} {shared} {word(rng.integers(0, 90))}" for _ in range(60)] + [shared] * 5
    got = sorted(tuple(r) for r in substrings.digests(documents(spark, texts), per_part=per_part).collect())
    assert got == brute_repeats(list(enumerate(texts)), 35)


def _shared_passages(n=60):
    rng = np.random.default_rng(8)
    word = lambda k: " ".join(f"w{x}" for x in rng.integers(0, 50, k))
    shared = word(50)
    return [f"{word(rng.integers(0, 120))} {shared} {word(rng.integers(0, 90))}" for _ in range(n)] + [shared] * 5


def test_substring_codes_travel_once_over_many_parts(spark, monkeypatch):
    """8,192 parts: one deal, parts matched in shares; shuffled bytes grow with the input, not with a second deal."""
    monkeypatch.setattr(substrings, "_deal_again", None)
    texts = _shared_passages()
    got = sorted(tuple(r) for r in substrings.digests(documents(spark, texts), per_part=2).collect())
    assert got == brute_repeats(list(enumerate(texts)), 35)


def test_substrings_dealt_again_then_matched_in_shares(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FAN_LOG", 3)
    monkeypatch.setattr(substrings, "SHARE_LOG", 2)
    texts = _shared_passages()
    got = sorted(tuple(r) for r in substrings.digests(documents(spark, texts), per_part=20).collect())
    assert got == brute_repeats(list(enumerate(texts)), 35)


def test_substring_codes_read_back():
    rng = np.random.default_rng(1)
    for n, lead, bits in ((0, 3, 28), (1, 0, 28), (5, 7, 29), (1000, 7, 35), (3000, 0, 64), (70_000, 14, 50)):
        part = 5 % (1 << lead)
        low = rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(3)
        h = (low >> np.uint64(lead)) | (np.uint64(part) << np.uint64(64 - lead)) if lead else low
        h = np.sort(h & np.uint64((1 << 64) - (1 << (64 - bits - lead)) if bits + lead < 64 else (1 << 64) - 1))
        assert (substrings._read(*substrings._write(h, lead, min(bits, 64 - lead)), n, part, lead, min(bits, 64 - lead)) == h).all()


def test_substrings_take_ids_of_any_type(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([("a", text), ("b", text), (None, text)], "doc_id string, text string")
    assert [r.n_removed for r in substrings.digests(df).collect()] == [40] * 3


def test_substrings_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (None, text), (1, text + " more"), (1, "other")], "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.n_words, r.n_removed) for r in substrings.digests(df).collect()))
    assert got == [(False, 1, 0), (False, 41, 40), (True, 40, 40), (True, 40, 40)]
    assert substrings.digests(df.limit(0)).count() == 0


# --- 4 ---


def brute_near(rows, size, num, den):
    sets = {}
    for i, t in rows:
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


@pytest.mark.parametrize(("size", "num"), [(3, 85), (5, 80)])
def test_minhash_matches_brute_force(spark, docs, size, num):
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in rng.integers(0, 3000, 120)]
    near = []
    for _ in range(40):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 9)):
            w[k] = f"n{rng.integers(0, 10**6)}"
        near.append(" ".join(w))
    texts = [*AWKWARD, *near, near[3], near[3].upper(), *[t for _, t in docs[:100]]]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, texts), size=size, num=num, den=100).collect()}
    assert got == brute_near(list(enumerate(texts)), size, num, 100)


def test_residual_tiles_find_links_that_stars_miss(spark):
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in range(200)]
    texts = []
    for _ in range(30):
        w = list(base)
        for k in rng.integers(0, 200, 5):
            w[k] = f"n{rng.integers(0, 10**6)}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, texts), size=3, num=85, den=100, tile=4).collect()}
    assert got == {i: c for i, (_, c, _) in brute_near(list(enumerate(texts)), 3, 85, 100).items()}


def test_a_repeated_id_joins_the_classes_of_its_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    df = spark.createDataFrame([(3, one), (5, one), (5, two), (4, two), (7, two), (7, ""), (6, "")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(3, 46, 3, True), (4, 46, 3, False), (5, 46, 3, False), (5, 46, 3, False), (6, 0, 6, True), (7, 0, 3, False), (7, 46, 3, False)]


def test_minhash_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect() if r.doc_id is not None) == [(False, 1, True), (False, 2, True)]
    assert minhash.near_duplicates(df).count() == 3
    assert minhash.near_duplicates(df.limit(0)).count() == 0


# --- 5 and 6 ---


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_units_match_the_library(docs):
    texts = [*AWKWARD, *[t for _, t in docs[:80]]]
    small = UnitEncoder(P.path("word_bpe_49k.json"), generation=50)
    assert [np.frombuffer(x, "<u2").tolist() for x in small.encode(texts)] == library_ids(texts)
    assert [np.frombuffer(x, "<u2").tolist() for t in texts for x in small.encode([t])] == library_ids(texts)


def test_segment_gives_any_position():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0, np.uint32), rng.integers(0, 200, 1000), rng.integers(0, 50000, 5000), rng.integers(0, 2**32, 3000)):
        s = token_files.Segment(token_files.write_segment([1], np.array([0, len(ids)]), np.asarray(ids, np.uint32)))
        assert (s.get(np.arange(len(ids))) == ids).all()
        at = rng.integers(0, max(1, len(ids)), 7) if len(ids) else np.zeros(0, int)
        assert (s.get(at) == np.asarray(ids)[at]).all()


def test_token_files_round_trip(spark):
    df = documents(spark, AWKWARD)
    segments = Cut(spark).keep(token_files.encode_segments(df, P.path("word_bpe_49k.json"), 2, segment_ids=40))
    got = sorted(tuple(r) for r in token_files.read_documents(spark, segments).collect())
    at, want = 0, []
    for i, ids in enumerate(library_ids(AWKWARD)):
        ids = [*ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    empty = Cut(spark).keep(token_files.encode_segments(df.limit(0), P.path("word_bpe_49k.json"), 2))
    assert token_files.read_documents(spark, empty).count() == 0


@pytest.mark.parametrize("per_part", [10, 50_000])
def test_packing_is_whole_and_gapless(spark, docs, per_part):
    texts = [*AWKWARD, *[t for _, t in docs]]
    out = packing.pack(documents(spark, texts), P.path("word_bpe_49k.json"), 1, capacity=512, per_part=per_part).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, ids in enumerate(library_ids(texts)):
        ids, rows = [*ids, 1], sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.start for r in rows] == list(range(0, len(ids), 512)) and sum(r.length for r in rows) == len(ids)
        assert all(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in rows)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    least = packing.least_sequences(spark.createDataFrame([(r.length,) for r in out], "length long"), 512)
    assert least == packing.lower_bound(np.array([r.length for r in out]), 512) <= len(by_sequence)
    # Certified partitions are at their own bounds: each holds at most one open sequence more than the whole needs.
    assert len(by_sequence) <= least + -(-len(out) // per_part)


def test_packing_with_gaps_exchanges_documents(spark):
    """Texts of 20 to 400 ids over partitions of five pieces: the exchanges bring the count down to the bound's neighbourhood."""
    rng = np.random.default_rng(6)
    texts = ["a " * int(n) for n in rng.integers(20, 400, 120)]
    first = packing.pack(documents(spark, texts), P.path("word_bpe_49k.json"), 1, capacity=512, per_part=5, growth=1).select("sequence_id").distinct().count()
    rows = packing.pack(documents(spark, texts), P.path("word_bpe_49k.json"), 1, capacity=512, per_part=5).collect()
    least = packing.lower_bound(np.array([r.length for r in rows]), 512)
    assert least <= len({r.sequence_id for r in rows}) <= first


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(4)
    for _ in range(200):
        lengths = rng.integers(1, 101, rng.integers(1, 40))
        assert packing.lower_bound(lengths, 100) <= packing.best_fit(lengths, 100)[2]
    assert packing.lower_bound(np.array([51] * 7), 100) == 7


# --- 7 ---


def test_language_accuracy_on_held_out_rows(spark):
    out = queries.op7_language_id(spark, SF)
    truth = {r["doc_id"]: r["lang"] for r in table("documents")}
    rows = [r for r in out.collect() if r.held_out and truth[r.doc_id] is not None]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out.collect())


def test_language_of_awkward_texts(spark):
    train = spark.createDataFrame([("the and of", "en"), ("der und die", "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = langid.fit(train, P.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(documents(spark, [None, "", "123 !?", "the", "und", "x" * 5000]), model).collect()}
    assert [got[i] for i in range(5)] == ["und", "und", "und", "en", "de"] and got[5] in ("en", "de")
    none = langid.fit(train.limit(0), P.path("piece_bpe_32k.model"))
    assert langid.predict(documents(spark, ["the"]), none).first().lang_pred == "und"


def test_letters_are_those_of_unicode(spark):
    train = spark.createDataFrame([("the and of", "en"), ("der und die", "de")], "text string, lang string")
    model = langid.fit(train, P.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(documents(spark, ["½ ²", "Ⅷ _ 3", "½the²"]), model).collect()}
    assert got == {0: "und", 1: "und", 2: "en"}
    assert langid.units_of("ab½cd " + "é" * 100) == ["ab", "cd", "é" * 48, "é" * 48, "é" * 4]


def test_language_model_against_brute_force(spark):
    """Two rounds of expectation maximisation and the predictions, by recursion over all segmentations of plain dictionaries."""
    train = [("the other day, the weather", "en"), ("der andere Tag und das Wetter", "de"), ("el otro día " + "x" * 60, "es"), ("the other day, the weather", "en"), ("no", None), (None, "en"), ("!", "de")]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"), P.path("piece_bpe_32k.model"), rounds=2)
    import sentencepiece

    sp, ids = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), {}
    for i in range(3, sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if not sp.is_byte(i) and piece.removeprefix("▁").isalpha():
            ids.setdefault(piece.lower(), len(ids))
    size = len(ids) + 1

    def segmentations(u):
        if not u:
            yield []
        for n in range(1, len(u) + 1):
            piece = ids.get(u[:n], len(ids) if n == 1 else None)
            if piece is not None:
                for rest in segmentations(u[n:]):
                    yield [piece, *rest]

    def units(text):
        runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        return ["▁" + r[i : i + 48] for r in runs for i in range(0, len(r), 48)]

    def forward(u, p):
        best = [1.0] + [0.0] * len(u)
        for end in range(1, len(u) + 1):
            for start in range(end):
                piece = ids.get(u[start:end], len(ids) if end - start == 1 else None)
                if piece is not None:
                    best[end] += best[start] * p[piece]
        return best[-1]

    langs = ["de", "en", "es"]
    prob = {k: [1 / size] * size for k in langs}
    for _ in range(2):
        for k in langs:
            n = [0.01] * size
            for text in {t for t, lang in train if lang == k and t is not None}:
                for u in units(text):
                    if len(u) > 20:  # the run of one letter: too many segmentations to list; its pieces are counted below
                        continue
                    every = [(s, float(np.prod([prob[k][i] for i in s]))) for s in segmentations(u)]
                    for s, weight in every:
                        for i in s:
                            n[i] += weight / sum(w for _, w in every)
            prob[k] = [x / sum(n) for x in n]
    assert model.langs == langs and np.allclose(model.prob[:, :2], np.array([prob["de"], prob["en"]]).T, rtol=1e-6)
    texts = ["the weather", "das Wetter", "otro día", "WETTER, day!", None, "12", "othertag wetteredía"]
    for r in langid.predict(documents(spark, texts), model).collect():
        logs = [sum(np.log(max(forward(u, model.prob[:, c]), 1e-300)) for u in units(texts[r.doc_id])) for c in range(3)]
        if not units(texts[r.doc_id]):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == langs[int(np.argmax(logs))] and abs(r.score - 1 / np.exp(np.array(logs) - max(logs)).sum()) < 1e-9


def test_hot_text_leaves_a_language_its_training_rows(spark):
    rows = [("der und die", "de")] * 500 + [(f"das wort {i}", "de") for i in range(5)] + [("the of and", "en")]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), P.path("piece_bpe_32k.model"), per_language=10)
    assert {r.lang_pred for r in langid.predict(documents(spark, ["wort", "das"]), model).collect()} == {"de"}
    with pytest.raises(ValueError):
        langid.fit(spark.createDataFrame(rows, "text string, lang string"), P.path("piece_bpe_32k.model"), most_languages=1)


def test_forward_sums_all_segmentations():
    pieces = langid.pieces_of(P.path("piece_bpe_32k.model"))
    prob = np.random.default_rng(0).random((pieces.size, 2)) * 0.1

    def brute(lens, arcs, at):
        if at == lens:
            return np.ones(2)
        return sum((prob[p] * brute(lens, arcs, e) for s, e, p in arcs if s == at), np.zeros(2))

    for unit in ("a", "the", "ing", "qzx", "élan"):
        lens, arcs = pieces.lattice([unit])
        flat = [(int(s), int(e), int(p)) for us, ss, es, ps in arcs for s, e, p in zip(ss, es, ps, strict=True)]
        assert np.allclose(langid.unit_scores(pieces, prob, [unit])[0], np.log(brute(int(lens[0]), flat, 0)))


# --- 8 ---


def payloads():
    rng = np.random.default_rng(1)
    made = [rng.integers(0, 256, 64 * 40, dtype=np.uint8).tobytes(), bytes(1024), (np.sin(np.arange(6400) / 9) * 100 + 128).astype(np.uint8).tobytes(), bytes([0, 255]) * 64]
    return [flac.payload_of(t) for t in AWKWARD] + made


def plain(blocks):
    return b"".join((x + 128).astype(np.uint8).tobytes() for _, x in blocks)


def test_flac_round_trip_with_and_without_seek_table():
    data = payloads()
    media = flac.encode_streams(data)
    for p, (s, blocks) in zip(data, flac.decode_streams(media), strict=True):
        assert plain(blocks) == p and s.total == len(p)
        assert [first for first, _ in blocks] == list(range(0, len(p), flac.BLOCK))
    bare = [m[:4] + b"\x80" + m[5:42] + m[flac._Stream(m).first :] for m in media]
    assert [plain(b) for _, b in flac.decode_streams(bare)] == data


def test_flac_uses_predictors_and_detects_damage():
    tone = (np.sin(np.arange(8192) / 9) * 100 + 128).astype(np.uint8).tobytes()
    media = flac.encode_streams([tone])[0]
    assert len(media) < len(tone) * 0.6
    for at in (-1, -20, 30):  # frame checksum, residuals, MD5
        bad = bytearray(media)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            flac.decode_streams([bytes(bad)])


def test_media_columns(spark):
    df = documents(spark, AWKWARD)
    media = flac.store_text(df)
    for r in flac.media_digests(media).collect():
        p = flac.payload_of(AWKWARD[r.doc_id])
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    blocks = flac.pcm_blocks(media).where("doc_id = 6").orderBy("block").collect()
    assert b"".join(b.pcm for b in blocks) == bytes(x ^ 0x80 for x in flac.payload_of("x" * 3000)) and [b.sample_offset for b in blocks] == [0, 1024, 2048]


def test_media_query_against_plain_python(spark):
    texts = {r["doc_id"]: r["text"] for r in table("documents")}
    for r in queries.op8_media_columns(spark, SF).collect():
        raw = (texts[r.doc_id] or "").encode()
        p = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        x = [b - 128 for b in p]
        rms, zcr = (sum(v * v for v in x) / len(x)) ** 0.5, sum((a < 0) != (b < 0) for a, b in zip(x, x[1:])) / len(x)  # noqa: B905
        step = sum(abs(b - a) for a, b in zip(x, x[1:])) / len(x)  # noqa: B905
        assert r.feature == f"rms={rms:.4f};peak={max(map(abs, x))};zcr={zcr:.6f};step={step:.4f}"
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), None)
        media = flac.encode_streams([p])[0]
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())


def test_damaged_and_null_media_are_rows_of_their_own(spark):
    good = flac.encode_streams([flac.payload_of("x" * 3000)])[0]
    silent = flac.encode_streams([b""])[0]
    bad = good[:-20] + bytes([good[-20] ^ 4]) + good[-19:]
    df = spark.createDataFrame([(1, 1, good, 0), (2, 1, None, 0), (3, 1, bad, 0), (4, 1, b"no", 0), (5, 1, good[:60], 0), (6, 0, silent, 0), (1, 1, good, 0)], "doc_id long, n_bytes long, media binary, block int")
    got = sorted((r.doc_id, r.payload_bytes, r.error is None) for r in flac.media_digests(df).collect())
    assert [g[1:] for g in got] == [(3008, True), (3008, True), (None, True), (None, False), (None, False), (None, False), (0, True)]
    blocks = sorted((r.doc_id, r.block or 0, r.n_samples is None, r.error is None) for r in flac.pcm_blocks(df).collect())
    assert [b[2:] for b in blocks if b[0] in (2, 3, 4, 5, 6)] == [(True, True), (True, False), (True, False), (True, False), (False, True)]
    assert flac.media_digests(df.limit(0)).count() == 0


def test_seeking_decodes_the_range_alone():
    data = np.random.default_rng(3).integers(0, 256, 5000, dtype=np.uint8).tobytes()
    media = flac.encode_streams([data])[0]
    x = np.frombuffer(data, np.uint8).astype(np.int32) - 128
    for lo, hi in ((0, 10), (1000, 1100), (4936, 5000), (0, 5000), (7, 7)):
        assert (flac.read_range([media], [lo], [hi])[0] == x[lo:hi]).all()
    broken = bytearray(media)
    broken[flac._Stream(media).first + 20] ^= 1  # in the first frame, which a range at the end never reads
    assert (flac.read_range([bytes(broken)], [4936], [5000])[0] == x[4936:]).all()


# --- 9 ---


def test_quotes_link_to_originals(spark):
    rows = [
        (1, 0, "user", "First point.\n\nSecond point."),
        (1, 1, "assistant", "Something else."),
        (1, 2, "user", "Ann wrote:\n> Second   POINT.\nI agree."),
        (1, 3, "user", "> Ann wrote:\n> > Second point.\n> I agree.\nMe too."),
        (2, 0, "user", "> First point.\n>\n> Second point.\nFrom elsewhere"),
        (3, 0, "user", None), (3, 1, "user", ""), (None, 1, "user", "> x"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, hash string")
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(df).collect()}
    assert len(got) == 8
    assert got[1, 2].text == "I agree." and (got[1, 2].parent_conv, got[1, 2].parent_turn) == (1, 0)
    assert got[1, 3].text == "Me too." and got[1, 3].parent_turn == 2 and got[1, 3].quote_levels == 2 and got[1, 3].depth == 2
    assert (got[2, 0].parent_conv, got[2, 0].parent_turn) == (1, 0) and got[2, 0].text == "From elsewhere"
    assert got[1, 1].parent_turn == 0 and got[3, 1].parent_turn == 0 and got[3, 0].text == ""
    assert got[None, 1].parent_turn is None
    assert quotes.link_quotes(df.limit(0)).count() == 0


# --- 10 ---


def page(body, title="T"):
    return f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_pages_by_consensus(spark):
    good = "<nav><a href=/>Menu</a></nav><div class='post-12'><p>" + "Main text here. " * 9 + "<p>More &amp; <b>bo</b>ld<br>next</div><div class=sidebar>side</div><footer>foot</footer>"
    odd = "<div class='post-13'><p>Hi</div><div><p>" + "A long list of other things. " * 20 + "</div>"
    rows = [(i, f"http://www.h.org/{i}", page(good)) for i in range(5)] + [(9, "http://h.org/9", page(odd)), (10, None, page(good)), (11, "http://x.org", None), (12, "http://x.org", "just text &lt;"), (13, "http://x.org", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    want = ("Main text here. " * 9).strip() + " More & bold next"
    assert [got[i].text for i in (0, 4, 10)] == [want] * 3 and got[9].text == "Hi"
    assert got[11].text == "" and got[12].text == "just text <" and got[13].n_chars == 0
    assert html_text.extract(df.limit(0)).count() == 0


def test_pages_by_a_join_in_shares_give_the_same(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    one, two = ({r.page_id: r.text for r in html_text.extract(pages, broadcast_bytes=b).collect()} for b in (1 << 25, 0))
    assert one == two and len(one) == pages.count()


def test_votes_tie_and_repeat(spark):
    a, b = ("<div class='%s'><p>" % c + "Words enough to win. " * 9 + "</div><div class='z'><p>short</p></div>" for c in "ab")  # noqa: UP031
    rows = [(1, "http://h.org/1", page(a)), (2, "http://h.org/2", page(b)), (2, "http://h.org/2", page(b)), (3, "http://t.org/1", page(a)), (4, "http://t.org/2", page(b))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    won = {r.host: r.path for r in html_text.winning_paths(df.withColumn("host", html_text.host_of(df.url))).collect()}
    assert won == {"h.org": "/html/body/div.b", "t.org": "/html/body/div.a"}  # a repeated row votes again; of equals the smaller text
    assert sorted(r.page_id for r in html_text.extract(df).collect()) == [1, 2, 2, 3, 4]


def test_reading_is_linear_in_the_page():
    import time

    start = time.time()
    for source in ("<a " * 60_000, "<a " * 60_000 + ">", '<a "' * 30_000 + ">", "<div>" * 30_000 + "x", "</b>" * 30_000 + "<div>" * 3000 + "</i>" * 30_000, "<script " * 30_000, "<p>" * 30_000 + "y", "<li><b>" * 20_000, "<!-- " * 20_000):
        html_text.Page(source).text(None)
    assert time.time() - start < 20
    deep = html_text.Page("<div class=k>" * 3000 + "deep text" + "</div>" * 3000)
    assert deep.text(deep.path[deep.choice()]) == "deep text"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<form action=x><div><h1>Head</h1><p>All of the page is in a form.</p></div></form>", "Head All of the page is in a form."),
        ("<article><p>One.</p><form><label>Mail</label></form></article>", "One."),
        ('<article><p title="a < b > c">One <img alt="x>y"> two</p><p>3 < 4 and 5 > 4</p></article>', "One two 3 < 4 and 5 > 4"),
        ("<article><p>Kept.</p></article><p>cut <a href='x", "Kept. cut"),
        ("<article><p>A<b>B</b> &amp;lt; &#x41;</p></article>", "AB &lt; A"),
    ],
)
def test_tags_and_references(body, want):
    p = html_text.Page(page(body) if not body.endswith("'x") else body)
    assert p.text(None) == want


def test_article_without_furniture():
    body = "<header>Site</header><article><header><h1>Head</h1></header><p>One.</p><script>no()</script><aside>ad</aside><div class='comments'>c</div><form>f</form><p>Two.</p></article><div id='cookie-notice'>ok</div>"
    p = html_text.Page(page(body))
    assert p.path[p.choice()] == "/html/body/article" and p.text(None) == "Head One. Two."


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<div class='page has-sidebar'><article><p>One.</p><h2 id='related-work'>Related</h2><p id='notice-period'>Two.</p></article></div>", "One. Related Two."),
        ("<div class='layout no-banner'><p>One.</p></div>", "One."),
        ("<div class='content widget'><article><p>One.</p></article></div><div class='widget'><p>w</p></div>", "One."),
        ("<main><p>Intro.</p><article><p>" + "a" * 60 + "</p></article><section><ul><li>" + "b" * 40 + "</ul></section></main>", f"Intro. {'a' * 60} {'b' * 40}"),
        ("<h1>Head</h1><p>Lead.</p><div><p>" + "a" * 90 + "</p></div><div class='site-footer'><p>f</p></div><div class='cookie-notice'><p>c</p></div>", f"Head Lead. {'a' * 90}"),
        ("<article><p>Short.</p></article><div id='comments'><p>" + "c" * 90 + "</p></div>", "Short."),
    ],
)
def test_no_text_goes_by_a_word_in_a_class(body, want):
    p = html_text.Page(page(body))
    assert p.text(None) == want and p.text(p.path[p.choice()]) == want


def test_quotes_of_all_levels_and_parts_link(spark):
    rows = [
        (1, 0, "Para one.\n\nPara two,\nsecond line,\nthird line.\n\nPara three."),
        (1, 1, "Before the quote.\n> Para three.\nAfter the quote."),
        (1, 2, "Other."),
        (1, 3, ">> Para three."),
        (1, 4, "> Para one.\n>\n> Para two,\n> second line,\n> third line."),
        (1, 5, "> second line,\n> third line."),
        (1, 6, "> After the quote."),
        (1, 7, "> Before the quote.\n>> Other.\n> not there"),
        (1, 8, "> Said later."),
        (1, 9, "Said later."),
        (2, 0, "Said later."),
        (2, 1, "x"),
        (2, 2, "> Para three."),
        (3, 0, "> Said later."),
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(df).collect()}
    parents = {k: (got[k].parent_conv, got[k].parent_turn) for k in got}
    assert [parents[1, t] for t in (1, 3, 4, 5, 6, 7, 8)] == [(1, 0), (1, 0), (1, 0), (1, 0), (1, 1), (1, 1), (2, 0)]
    assert [(got[1, t].n_quotes, got[1, t].n_linked) for t in (3, 7)] == [(1, 1), (3, 2)]
    assert parents[2, 2] == (1, 0) and parents[3, 0] == (1, 9)
    assert [(got[k].thread_conv, got[k].thread_turn, got[k].depth) for k in ((2, 1), (2, 2), (1, 8), (3, 0))] == [(2, 0, 1), (1, 0, 1), (1, 0, 3), (1, 0, 5)]


def brute_links(rows):
    """Parents, links, threads and positions of (conv, turn, text) rows by loops; texts are parsed by the operator's parser."""
    parsed = {(c, t): quotes.parse(x) for c, t, x in rows}
    holds = {k: {h for p in (own, *parts) for _, h in quotes.fragments(p)} for k, (own, _, parts) in parsed.items()}
    parent, linked = {}, {}
    for c, t in parsed:
        found = {}
        for level, passage in parsed[c, t][1]:
            for part in (0, 1, 2):
                near = [k for k in holds for n, h in quotes.fragments(passage) if n == part and h in holds[k] and k[0] == c and k[1] < t]
                lone = [h for n, h in quotes.fragments(passage) if n == part and not any(h in holds[k] for k in holds if k[0] == c and k[1] < t)]
                far = [k for k in holds for h in lone if h in holds[k] and k[0] != c]
                if near or far:
                    found.setdefault(level, []).append((max((k[1] for k in near), default=None), min(far, default=None)))
                    break
        linked[c, t] = sum(map(len, found.values()))
        before = max((k for k in parsed if k[0] == c and k[1] < t), default=None)
        parent[c, t] = before
        if found:
            best = found[min(found)]
            turns = [n for n, _ in best if n is not None]
            parent[c, t] = (c, max(turns)) if turns else min(f for _, f in best if f is not None)
    thread, depth = {}, {}
    for k in sorted(parsed):
        up = parent[k]
        if up is not None and up[0] > k[0]:
            up = max((q for q in parsed if q[0] == k[0] and q[1] < k[1]), default=None)
        thread[k], depth[k] = (k, 0) if up is None else (thread[up], depth[up] + 1)
    position = {k: sum(thread[q] == thread[k] and q < k for q in parsed) for k in parsed}
    return {k: (parent[k], linked[k], thread[k], depth[k], position[k]) for k in parsed}


def test_planted_quotes_against_brute_force(spark):
    rng = np.random.default_rng(12)
    line = lambda: " ".join(f"w{x}" for x in rng.integers(0, 2000, 4))
    rows, said = [], ["Shared opening line."]
    for c in range(12):
        for t in range(int(rng.integers(1, 12))):
            body = []
            for _ in range(int(rng.integers(1, 4))):
                if rng.random() < 0.5:
                    level, what = int(rng.integers(1, 4)), said[rng.integers(0, len(said))]
                    body += [">" * level + " " + x for x in what.split("\n")]
                else:
                    own = [line() for _ in range(int(rng.integers(1, 4)))]
                    body += [*own, ""]
                    said += ["\n".join(own), own[0]]
            if rng.random() < 0.2:
                body.append("Shared opening line.")
            rows.append((c, t * int(rng.integers(1, 3)) + t, "\n".join(body)))
    rows = list({(c, t): (c, t, x) for c, t, x in rows}.values())
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): ((r.parent_conv, r.parent_turn) if r.parent_turn is not None else None, r.n_linked, (r.thread_conv, r.thread_turn), r.depth, r.position) for r in quotes.link_quotes(df).collect()}
    assert got == brute_links(rows)
    assert sum(v[1] for v in got.values()) > 20


def test_repeated_messages_share_their_place(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "user", "> One.\nTwo."), (1, 1, "user", "> One.\nTwo."), (None, 3, "user", "x"), (1, None, "user", "y")]
    got = sorted((r.conv_id or 0, r.turn or 0, r.text, r.parent_turn, r.position) for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert got == [(0, 3, "x", None, 0), (1, 0, "One.", None, 0), (1, 0, "y", None, 0), (1, 1, "Two.", 0, 1), (1, 1, "Two.", 0, 1)]


def test_threads_of_a_long_chain(spark):
    df = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(70)], "conv_id long, turn long, role string, text string")
    assert sorted((r.turn, r.thread_turn, r.depth) for r in quotes.link_quotes(df).collect()) == [(t, 0, t) for t in range(70)]
