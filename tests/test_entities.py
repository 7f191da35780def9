"""Dictionary and rule extraction against one regular expression a name, and the rules one by one."""

import re

import pytest

from mereweave.operators import entities as e

TEXTS = [
    "Ann Lee met ANN LEE and Annabel Lee.", "see [Blue Lake](/x)\n\nBlue Lake is far", "x" * 60 + " Blue Lake and Blue Lakes", "* [Ann Lee", "", None, "Größe Ünal-Fund ünal-fund.", "İAnn Lee İ", "C01 carbon, C012 and P001; VM0042. C1 VM00421 c01 C01 soil",
    "Long " * 3000 + "Blue Lake", "a+b (c) a+b", "Blue Lake Ann Lee" * 3,
]
NAMES = [("Ann Lee", "Person", "Ann Lee"), ("Blue Lake", "Organization", "Blue Lake"), ("Blue Lakes", "Organization", "Blue Lake"), ("Ünal-Fund", "Organization", "Ünal"), ("a+b", "Organization", "a+b"), ("Lee", "Person", "Lee"), ("", "Person", "x"), (None, "Person", "x")]


def brute(names):
    out = set()
    for i, text in enumerate(TEXTS):
        for name, kind, canonical in names:
            if not name or not text or not re.search(r"\b" + re.escape(name) + r"\b", text, re.IGNORECASE):
                continue
            first = next(re.finditer(re.escape(name), text, re.IGNORECASE))
            context = text[max(0, first.start() - 50) : first.end() + 50]
            if not any(m in context for m in e.MENU_MARKS):
                out.add((i, kind, canonical))
    return out


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, name string")
    return docs, spark.createDataFrame(NAMES, "name string, kind string, canonical string")


def test_whitelist_equals_a_regex_per_name(frames):
    docs, names = frames
    got = e.whitelist(docs, "doc_id", "text", names).collect()
    named = {(r.id, r.kind, r.value) for r in got if r.kind in ("Person", "Organization")}
    assert named == brute(NAMES)
    assert {(r.kind, r.value, r.credit_type) for r in got if r.id == 8 and r.kind not in ("Person", "Organization")} == {("CreditClass", "C01", "carbon"), ("CreditClass", "C012", "carbon"), ("Project", "P001", None), ("Methodology", "VM0042", None)}


def test_a_dictionary_of_other_sizes(frames, spark):
    docs, names = frames
    assert e.whitelist(docs, "doc_id", "text", names.limit(0)).where("kind in ('Person', 'Organization')").collect() == []
    with pytest.raises(ValueError, match="more than 3 names"):
        e.name_hits(docs, "doc_id", "text", names, most_names=3)
    many = names.union(spark.range(20_000).selectExpr("concat('nobody', id)", "'Person'", "'x'"))
    assert {(r.id, r.kind, r.value) for r in e.whitelist(docs, "doc_id", "text", many).collect() if r.kind in ("Person", "Organization")} == brute(NAMES)
    assert e.whitelist(docs.limit(0), "doc_id", "text", names).collect() == []


def test_semantic_rules(spark):
    docs = spark.createDataFrame([(1, "cORE oRG and github, GitHub. Written by Ann Reeder, by Style Guide. — Bob Stone. GitHub uses Ann Reeder. Core Org developed GitHub! nobody built GitHub"), (2, "github by a Pull Request; by Pull Request"), (3, None)], "id long, text string")
    names = spark.createDataFrame([("Core Org", "Organization", True), ("GitHub", "Organization", False), ("Ann Reeder", "Person", False)], "name string, kind string, core boolean")
    found = e.semantic_entities(docs, "id", "text", names)
    assert {(r.id, r.value, r.confidence) for r in found.collect()} == {(1, "Core Org", 0.95), (1, "GitHub", 0.9), (1, "Ann Reeder", 0.95), (1, "Bob Stone", 0.8)}
    assert {tuple(r) for r in e.relations(docs, "id", "text", found).collect()} == {(1, "GitHub", "Ann Reeder"), (1, "Core Org", "GitHub")}


def test_claims(spark):
    text = "You MUST  sign it. It may x. The following steps: one, two. Each node: one key. It should\nbe short"
    docs = spark.createDataFrame([(1, text), (2, None)], "id long, text string")
    want = set()
    for k, p in enumerate((r"(must|should|required|recommended|may)\s+([^.]+)", r"(The following[^:]+:)\s*([^.]+)", r"(Each [^:]+:)\s*([^.]+)")):
        want |= {(1, k, i, f"{a} {b}".strip()) for i, (a, b) in enumerate(re.findall(p, text, re.IGNORECASE)) if len(f"{a} {b}".strip()) > 10}
    assert {tuple(r) for r in e.claims(docs, "id", "text").collect()} == want and len(want) == 4


@pytest.mark.parametrize(
    ("kind", "value", "good"),
    [("Person", "Ann Reeder", True), ("Person", "Ann", False), ("Person", "ann reeder", False), ("Person", "Ann REEDER", False), ("Person", "A Reeder", False), ("Person", "Style Guide", False), ("Person", "Mia Cannon", False), ("Organization", "Blue Lake", True), ("Organization", "blue lake", False), ("Organization", "One Two Three Four Five", False), ("Organization", "Release Team", False), ("Organization", "x" * 51, False), ("CreditClass", "C01", True), ("Proposal", "Prop 12", False), ("Project", "P1", False)],
)
def test_good_pattern_hits(spark, kind, value, good):
    df = spark.createDataFrame([(kind, value)], "kind string, value string")
    assert df.select(e.good_pattern_hit(df.kind, df.value)).first()[0] is good


def test_hybrid_prefers_patterns(spark):
    docs = spark.createDataFrame([(1, "C01 by Bob Stone. core org")], "id long, text string")
    names = spark.createDataFrame([("Core Org", "Organization", True)], "name string, kind string, core boolean")
    got = {(r.kind, r.key, r.origin) for r in e.hybrid(docs, "id", "text", names).collect()}
    assert {("CreditClass", "C01", "pattern"), ("Organization", "CORE ORG", "semantic"), ("Person", "BOB STONE", "pattern")} <= got


def test_brief_hits_are_the_same_names_without_places_and_contexts(spark):
    from mereweave.operators import entities as e

    docs = spark.createDataFrame([(1, "Stonewall and stonewall, Lantern_x"), (2, None), (3, "lantern"), (1, "Lantern")], "id long, text string")
    names = spark.createDataFrame([("Stonewall", "Person"), ("Lantern", "Organization")], "name string, kind string")
    brief = e.name_hits(docs, "id", "text", names, brief=True)
    assert brief.columns == ["id", "name", "kind", "canonical", "same_case"]
    full = e.name_hits(docs, "id", "text", names).select(*brief.columns)
    assert sorted(map(tuple, brief.collect())) == sorted(map(tuple, full.collect())) and full.count() == 4


def test_merged_entities_keep_the_credit_type(spark):
    from mereweave.operators import entities as e

    docs = spark.createDataFrame([(1, "C01 carbon of Stonewall"), (2, "C01 of soil"), (3, "C01 alone")], "id long, text string")
    names = spark.createDataFrame([("Stonewall", "Person", True)], "name string, kind string, core boolean")
    rows = {(r.id, r.value): r.credit_type for r in e.semantic_entities(docs, "id", "text", names).collect()}
    assert rows == {(1, "C01"): "carbon", (2, "C01"): "soil", (3, "C01"): "unknown", (1, "Stonewall"): None}


HYBRID = [
    (1, "C01 by Bob Stone. core org, GITHUB and GitHub. Core Org"), (2, "Written by Ann Reeder. Ann Reeder, c07 VM0001 P001 and P002; P001. Github"), (3, None), (4, ""), (5, "author Style Guide, the Blue Lake Labs and proposal # 12"),
    (6, "github"), (7, "GitHub or Github by Core Org Foundation"), (8, "x" * 300_000 + " GitHub " + "y" * 300_000), (9, "by Mia Cannon. MIA CANNON"), (10, "straße STRASSE"), (None, "GitHub"),
]
HYBRID_NAMES = [("Core Org", "Organization", True), ("GitHub", "Organization", False), ("Github", "Organization", False), ("Ann Reeder", "Person", True), ("P001", "Project", True), ("Mia Cannon", "Person", False), ("Straße", "Organization", True), ("STRASSE", "Organization", False), ("Org", "Person", True), ("", "Person", True)]


@pytest.mark.parametrize("again", [[], [(2, "Github, C99 by Bob Stone"), (None, "github, GITHUB")], [(1, "GitHub")] * 3])
def test_hybrid_in_rows_equals_hybrid_by_id(spark, monkeypatch, again):
    docs = spark.createDataFrame(HYBRID + again, "id long, text string")
    names = spark.createDataFrame(HYBRID_NAMES, "name string, kind string, core boolean")
    want = {tuple(r) for r in e._hybrid_by_id(docs, names, (), 1000).collect()}
    for most in (100_000, 0):  # repeated ids apart, or all rows by id
        monkeypatch.setattr(e, "_MOST_AGAIN", most)
        got = e.hybrid(docs, "id", "text", names).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) > 15
        brief = e.hybrid(docs, "id", "text", names, brief=True)
        assert {tuple(r) for r in brief.collect()} == {(i, kind, key, origin) for i, kind, key, _, origin, _ in want}


def test_hybrid_shuffles_no_row_of_an_id_that_stands_once(spark):
    docs = spark.createDataFrame(HYBRID, "id long, text string")
    names = spark.createDataFrame(HYBRID_NAMES, "name string, kind string, core boolean")
    assert "Exchange" not in e.hybrid(docs, "id", "text", names)._jdf.queryExecution().toString()


def test_a_dictionary_takes_about_a_hundred_bytes_a_name(spark):
    import pickle

    names = spark.range(50_000).selectExpr("concat('Name', hex(xxhash64(id)), 'x') as name", "'Person' as kind", "true as core")
    sent = pickle.dumps(e._dictionary(names, 50_000))
    assert len(sent) < 200 * 50_000


def test_names_of_any_length_are_found_across_chunks(monkeypatch):
    import random

    from mereweave.operators import names as n

    random.seed(4)
    for chunk in (7, 64, 1 << 17):
        monkeypatch.setattr(n, "_CHUNK", chunk)
        for letters in ("abAB", "aA_ .", "abcdefXYZ ", "aßİΣσςÜü é\U0001f600") * 10:
            names = list({"".join(random.choices(letters, k=random.choice((1, 2, 5, 6, 7, 12, 40)))) for _ in range(40)})
            texts = [None, "", "x".join(names[:9]), *("".join(random.choices(letters, k=150)) for _ in range(3))]
            want = set()
            for row, text in enumerate(texts):
                low = n.lowered(text or "")
                word = lambda i, t=text: 0 <= i < len(t) and (t[i].isalnum() or t[i] == "_")
                for k, name in enumerate(names):
                    for m in re.finditer(f"(?={re.escape(n.lowered(name))})", low):
                        a, b = m.start(), m.start() + len(name)
                        want.add((row, k, a, text[a:b] == name, word(a - 1) != word(a) and word(b - 1) != word(b)))
            got = list(zip(*(x.tolist() for x in n.Names(names).find(texts, whole=True)), strict=True))
            assert set(got) == want and len(got) == len(want)


def test_quick_patterns_have_the_same_matches(spark):
    from pyspark.sql import functions as F

    from mereweave.operators import kg

    texts = ["C01 c012 xC01 C0123 éC01 _C01 C01C02 C1 C01é", "vm0001, VM0002 VM00021 xVM0003 VM0004VM0005", "P001 p0012 P00123 -P001 P001_ üP001", "prop 1 PROPOSAL#2 proposal\n#3 prop4 proposalprop 5", "by Ann Lee, baby Ann Lee; written by by Ann Lee author\u2003Bob Stone author by Xa Ya AUTHOR Za Za", ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    old = r"(?U)(?:by|author|written by)\s+([A-Z][a-z]+ [A-Z][a-z]+)"
    for slow, fast in [*((p, kg.quick(p)) for _, p, *_ in (*kg.ENTITY_RULES, *e.IDENTIFIERS)), (old, e.AUTHORS[0])]:
        group = F.lit(min(1, re.compile(slow.replace("(?U)", "")).groups))
        both = docs.select(*[F.regexp_extract_all("text", F.lit(p), group) for p in (slow, fast)]).collect()
        assert [r[0] for r in both] == [r[1] for r in both], slow
    for rules in ([(k, p) for k, p, valid in kg.ENTITY_RULES if valid], list(e.IDENTIFIERS)):  # codes in one pass as rule by rule
        found = docs.select(kg.codes(F.col("text"), rules).alias("codes"), *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in rules]).collect()
        for r in found:
            assert [(c.kind, c.value, c.place) for c in r.codes] == [(k, *x) for k, _ in rules for x in ((v, i) for i, v in enumerate(v for v in r[k] if v.isupper()))]
