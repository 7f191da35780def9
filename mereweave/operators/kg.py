"""Knowledge-graph operators: entity extraction, dedup, fuzzy resolution, contradictions, components, RDF."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from difflib import SequenceMatcher
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``. Only on a local master (tests) a temporary one serves where that is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        sc = spark.sparkContext
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
        where = getattr(sc, "_mereweave_shared", None)
        if where is None:
            import tempfile

            where = sc._mereweave_shared = "file://" + tempfile.mkdtemp(prefix="mereweave-")
    return where.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Cuts lineage: a table in the shared folder, read back. A checkpoint would keep its plan's estimate of bytes, in loops a product of
    products whose digits alone fill the driver; a table has its own size."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_tasks(spark: SparkSession, rows: int, per: int = 500_000, size: str = "8m") -> Iterator[None]:
    """While it lasts, scans read about ``size`` in a task and shuffles of ``rows`` rows have one part for each ``per`` of them at least, so
    that sorts and hash tables of a task stay as large as they are whatever the input's size. Only what runs inside is changed."""
    own = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.adaptive.advisoryPartitionSizeInBytes": size, "spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per)))}
    before = {name: spark.conf.get(name) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def merge_entities(rows: DataFrame, key: list[str], doc: str, confidence: str, richness: Column, seq: str) -> DataFrame:
    """Dedup-merge: occurrences, distinct documents, best confidence, and the fields of the richest row (earliest of equals)."""
    best = F.max_by(F.col(seq), F.struct(richness, -F.col(seq)))
    return rows.groupBy(*key).agg(F.count("*").alias("occurrences"), F.countDistinct(doc).alias("documents"), F.max(confidence).alias("confidence"), best.alias("base_seq"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))


#: Entity kinds of the ontology in the order they are sought, with their patterns and what a value must be (null: anything).
ENTITY_RULES = (
    ("CreditClass", r"(?i)\bC[0-9]{2,3}\b", r"^C[0-9]{2,3}$"),
    ("Project", r"(?i)\bP[0-9]{3,4}\b", r"^P[0-9]{3,4}$"),
    ("Methodology", r"(?i)\bVM[0-9]{4}\b", r"^VM[0-9]{4}$"),
    ("Organization", r"[A-Z][a-zA-Z]+(?: [A-Z][a-zA-Z]+)*(?: (?:Inc|LLC|Foundation|Network|DAO|Labs|PBC))", None),
    ("Person", r"(?:[A-Z][a-z]+ ){1,3}[A-Z][a-z]+", None),
    ("Proposal", r"(?i)(?:proposal|prop)[ \t\n\r#]+[0-9]+", None),
)
#: Relations that the ontology allows: subject, predicate, object, cardinality.
RELATIONS = (
    ("Person", "founded", "Organization", "many-to-many"),
    ("Organization", "employs", "Person", "one-to-many"),
    ("Project", "generates", "CreditClass", "many-to-one"),
    ("Project", "implements", "Methodology", "many-to-one"),
    ("Person", "proposed", "Proposal", "many-to-many"),
    ("Document", "references", "CreditClass", "many-to-many"),
)


def quick(pattern: str) -> str:
    """A pattern with the same matches whose first letters are sought before what costs more: a word boundary, one of two words."""
    return re.sub(r"\\b(\(?)([A-Z]+)", r"\1\2(?<=\\b\2)", pattern, count=1).replace("(?:proposal|prop)", "prop(?:osal)?")


def codes(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Array of (kind, value, place): codes in upper case that are whole words, by rule and place. All ``rules`` (kind, pattern), which begin
    with different letters under the same flag, are sought in one pass: whole words do not overlap."""
    flag, bodies = rules[0][1][:4], [quick(p)[4:-2].strip("()") for _, p in rules]
    first = "".join(b[0] for b in bodies)
    values = F.regexp_extract_all(text, F.lit(f"{flag}(?=[{first}{first.lower() if 'i' in flag else ''}])(?:{'|'.join(bodies)})\\b"), F.lit(0))

    def of(kind: str, body: str) -> Callable[[Column], Column]:
        own = "^" + re.sub(r"\(\?<=[^)]*\)", "", body) + "$"
        return lambda found: F.transform(F.filter(found, lambda x: x.rlike(own)), lambda x, i: F.struct(F.lit(kind).alias("kind"), x.alias("value"), i.alias("place")))

    each = [of(kind, body) for (kind, _), body in zip(rules, bodies, strict=True)]
    return F.get(F.transform(F.array(values), lambda found: F.concat(*[f(found) for f in each])), F.lit(0))  # found once though used for each rule


def pattern_hits(text: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Array of (kind, value, place): what ``ENTITY_RULES`` find, by rule and place."""

    def hits(kind: str, pattern: str) -> Column:
        values = F.regexp_extract_all(text, F.lit(quick(pattern)), F.lit(0))
        if ends := re.search(r"\(\?: \(\?:([A-Za-z|]+)\)\)$", pattern):  # most texts hold no such end of a name
            held = [F.contains(text, F.lit(f" {end}")) for end in ends[1].split("|")]
            values = F.when(reduce(or_, held), values).otherwise(F.array().cast("array<string>"))
        good = F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x != "")
        return F.transform(good, lambda x, i: F.struct(F.lit(kind).alias("kind"), x.alias("value"), i.alias("place")))

    rules = [r for r in ENTITY_RULES if kinds is None or r[0] in kinds]
    coded = [(kind, pattern) for kind, pattern, valid in rules if valid]
    return F.concat(*([codes(text, coded)] if coded else []), *[hits(kind, pattern) for kind, pattern, valid in rules if not valid])


def pattern_entities(docs: DataFrame, id_col: str, text_col: str, kinds: tuple[str, ...] | None = None, window: int = 100) -> DataFrame:
    """(id, kind, key, value, hits, confidence, context): entities by ``ENTITY_RULES``, one a kind and upper-case value of a document.

    All rules run in one scan; hits combine before the shuffle. ``value`` is the first hit's; ``context`` is the text around the first
    place where it stands. A null text gives none.
    """
    text = F.col(text_col)
    each = docs.select(F.col(id_col), text.alias("_text"), F.explode(pattern_hits(text, kinds)).alias("e"))
    at = F.instr(F.col("_text"), F.col("e.value"))
    around = F.substring(F.col("_text"), F.greatest(F.lit(1), at - window), F.length("e.value") + window + F.least(F.lit(window), at - 1))
    each = each.select(id_col, "e.*", F.upper("e.value").alias("key"), F.trim(F.regexp_replace(around, r"\s+", " ")).alias("context"))
    return each.groupBy(id_col, "kind", "key").agg(F.min_by("value", "place").alias("value"), F.count("*").alias("hits"), F.lit(0.95).alias("confidence"), F.min_by("context", "place").alias("context"))


def ratio_upper_bound(a: Column, b: Column) -> Column:
    """No matching of two strings can score above this: twice the shorter length over the sum."""
    return F.try_divide(2.0 * F.least(F.length(a), F.length(b)), F.length(a) + F.length(b))


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The matching-blocks ratio of normalised strings, the first one first (it is not symmetric)."""
    return pd.Series([SequenceMatcher(None, x.lower().strip(), y.lower().strip()).ratio() for x, y in zip(a, b, strict=True)])


def similar_names(names: DataFrame, block: str, id_col: str, name: str, least: float) -> DataFrame:
    """(a, b, score): pairs of one block with a ratio of ``least`` or more, smaller id first.

    The length bound is an equality-joined window (a name of n characters only meets names of at most
    n * (2 - least) / least), so that a block is not crossed whole.
    """
    n = names.select(F.col(block).alias("block"), F.col(id_col).alias("id"), F.lower(F.trim(name)).alias("name")).where("length(name) > 0")
    reach = (2 - least) / least
    left = n.select("block", F.col("id").alias("a"), F.col("name").alias("left"), F.explode(F.sequence(F.ceil(F.length("name") / reach).cast("int"), F.floor(F.length("name") * reach).cast("int"))).alias("size"))
    right = n.select("block", F.col("id").alias("b"), F.col("name").alias("right"), F.length("name").alias("size"))
    pairs = left.join(right, ["block", "size"]).where("a < b").where(ratio_upper_bound(F.col("left"), F.col("right")) >= least)
    letters = lambda c: F.split(c, "")
    shared = F.size(F.array_intersect(letters("left"), letters("right")))
    pairs = pairs.where(shared > 0)
    return pairs.withColumn("score", ratio(F.col("left"), F.col("right"))).where(F.col("score") >= least).select("a", "b", "score")


def _with_least(edges: DataFrame, low: DataFrame, many: int) -> DataFrame:
    """``edges`` with the ``m`` of their ``a`` from ``low`` (a, m, n). Nodes of over ``many`` edges are few and broadcast, so that no task gets
    all the edges of one node."""
    hot = F.broadcast(low.where(F.col("n") > many).select("a", F.col("m").alias("_hot")))
    tagged = edges.join(hot, "a", "left")
    rest = tagged.where("_hot is null").drop("_hot").join(low.where(F.col("n") <= many).drop("n"), "a")
    return rest.select("a", "b", "m").union(tagged.where("_hot is not null").select("a", "b", F.col("_hot").alias("m")))


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, many: int = 100_000) -> DataFrame:
    """(node, component): smallest node reachable, by large and small stars in turn; raises if it does not settle.

    A large star links a node's larger neighbours with the least of them all, a small star its smaller ones. Both keep what hangs
    together and shorten ways, so that the rounds grow with the logarithm of a way's length whatever the order of its nodes.
    """
    e = durable(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"`{a}` is not null and `{b}` is not null").where("a <> b"))
    with small_tasks(e.sparkSession, 2 * e.count()):
        mark = None
        for _ in range(most_rounds):
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("a", "m"))
            large = _with_least(both.where("b > a"), low, many).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            large = durable(large)
            low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
            hooked = _with_least(large, low, many).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            e = durable(hooked.union(low.select("a", F.col("m").alias("b"))).distinct())
            old, mark = mark, tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
            if mark == old:
                return durable(e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct()))
    raise RuntimeError("components did not settle")


def walk(roots: DataFrame, edges: DataFrame, most: int, strict: bool = False) -> DataFrame:
    """(root, child, level): everything reached from ``roots`` (root, child; level 0) over ``edges`` (parent, child), level by level.

    Each level is one join of the last one's rows, cut by a checkpoint, so neither a row limit nor the plan's length bounds it. After
    ``most`` levels it stops, or raises where rows are left and ``strict``.
    """
    step = edges.select(F.col("parent").alias("_from"), F.col("child").alias("_to"))
    level = durable(roots.select("root", "child", F.lit(0).alias("level")))
    seen = level
    for k in range(1, most + 1):
        level = durable(level.join(step, F.col("child") == F.col("_from")).select("root", F.col("_to").alias("child"), F.lit(k).alias("level")))
        if level.isEmpty():
            return seen
        seen = seen.union(level)
    if strict and not level.join(step, F.col("child") == F.col("_from"), "left_semi").isEmpty():
        raise RuntimeError(f"more than {most} levels, or a cycle")
    return seen


#: Words that do not count when texts are compared for a shared subject.
_STOPWORDS = tuple("the a an and or but in on at to for of is are was were".split())


def contradictions(statements: DataFrame, least_shared: int = 3) -> DataFrame:
    """Pairs of statements of different extractions with similar subjects and opposite negation.

    ``statements``: id (unique), extraction, subject, text. Subjects are similar if one equals or holds the other, or if the
    texts share ``least_shared`` words that are no stopwords. Either way the texts without negation must be alike by more
    than 0.8, so a prefix filter finds every pair: of n words, ordered by rarity, the n - floor(0.8 n) rarest of both texts
    have one in common. Only negated statements meet others.
    """
    words = lambda c: F.filter(F.array_distinct(F.split(c, r"(?U)\s+")), lambda w: w != "")
    low = F.lower("text")
    s = statements.select(
        "id", "extraction", F.when(F.length("subject") > 0, F.regexp_replace(F.lower("subject"), r"(?U)^\s+|\s+$", "")).alias("subject"),
        words(F.replace(F.replace(low, F.lit("not "), F.lit("")), F.lit("n't "), F.lit(" "))).alias("plain"),
        F.array_except(words(low), F.array(*map(F.lit, _STOPWORDS))).alias("content"), (F.contains(low, F.lit("not ")) | F.contains(low, F.lit("n't "))).alias("negated"),
    )
    each = s.select("id", "negated", F.size("plain").alias("n"), F.explode("plain").alias("word"))
    rarity = each.groupBy("word").agg(F.count("*").alias("held"))
    ordered = each.join(rarity, "word").groupBy("id", "negated", "n").agg(F.array_sort(F.collect_list(F.struct("held", "word"))).alias("all"))
    rare = ordered.select("id", "negated", "n", F.explode(F.expr("slice(all, 1, n - (4 * n) div 5)")).alias("r")).select("id", "negated", "n", "r.word")
    left = rare.where("negated").select(F.col("id").alias("x"), F.col("n").alias("nx"), "word")
    right = rare.where("not negated").select(F.col("id").alias("y"), F.col("n").alias("ny"), "word")
    pairs = left.join(right, "word").where("5 * least(nx, ny) > 4 * greatest(nx, ny)").select("x", "y").distinct()
    side = lambda i: s.select(F.col("id").alias(i), *(F.col(c).alias(f"{c}_{i}") for c in ("extraction", "subject", "plain", "content")))
    p = pairs.join(side("x"), "x").join(side("y"), "y")
    from ..functions.text import jaccard

    held = F.coalesce(F.contains("subject_x", F.col("subject_y")) | F.contains("subject_y", F.col("subject_x")), F.lit(False))
    shared = F.size(F.array_intersect("content_x", "content_y")) >= least_shared
    p = p.where(~F.col("extraction_x").eqNullSafe(F.col("extraction_y")) & (held | shared) & (jaccard(F.col("plain_x"), F.col("plain_y")) > 0.8))
    return p.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit("factual").alias("kind"), F.lit(0.9).alias("confidence"))


def triples(entities: DataFrame, statements: DataFrame, labels: DataFrame, base: str) -> DataFrame:
    """(s, p, o) rows: types and labels of entities, and statements whose ends are linked by label where one is known."""
    uri = lambda c: F.concat(F.lit(f"<{base}"), F.regexp_replace(c, r"[^A-Za-z0-9]+", "_"), F.lit(">"))
    literal = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, r'(["\\])', r"\\$1"), F.lit('"'))
    facts = F.explode(F.array(F.struct(F.lit("rdf:type").alias("p"), F.concat(F.lit("kg:"), "kind").alias("o")), F.struct(F.lit("rdfs:label").alias("p"), literal(F.col("name")).alias("o")))).alias("f")
    a = entities.select(uri(F.col("name")).alias("s"), facts).select("s", "f.p", "f.o")
    known = labels.select(F.lower("label").alias("key"), "uri").groupBy("key").agg(F.min("uri").alias("uri"))
    s = statements.withColumn("key", F.lower("object")).join(known, "key", "left")
    b = s.select(uri(F.col("subject")).alias("s"), F.concat(F.lit("kg:"), "predicate").alias("p"), F.coalesce("uri", literal(F.col("object"))).alias("o"))
    return a.union(b)


def write_turtle(t: DataFrame, path: str) -> None:
    """One triple a line, as text; every partition writes its own file."""
    t.select(F.concat_ws(" ", "s", "p", "o", F.lit("."))).write.mode("overwrite").text(path)


def version_winner(rows: DataFrame) -> DataFrame:
    """The calendar rule, folded in arrival order: a row replaces the held one if its SEQUENCE is not smaller, or where either
    has none, if its stamp is not older. The rule is not transitive, so a fold and not a maximum decides.
    ``rows``: uid, sequence, stamp, arrival."""
    item = F.struct("arrival", "sequence", "stamp")
    ordered = rows.groupBy("uid").agg(F.array_sort(F.collect_list(item)).alias("all"))

    def newer(held: Column, x: Column) -> Column:
        by_seq = x["sequence"] >= held["sequence"]
        return F.when(held["sequence"].isNotNull() & x["sequence"].isNotNull() & (x["sequence"] != held["sequence"]), by_seq).otherwise(F.coalesce(x["stamp"] >= held["stamp"], F.lit(True)))

    won = F.aggregate(F.slice("all", 2, F.size("all")), F.element_at("all", 1), lambda held, x: F.when(newer(held, x), x).otherwise(held))
    return ordered.select("uid", won.alias("w")).select("uid", "w.sequence", "w.stamp", "w.arrival")


def whitelist_hits(docs: DataFrame, id_col: str, text_col: str, names: DataFrame) -> DataFrame:
    """(id, name, kind): listed names that stand as whole words in a text.

    ``names`` (name, kind) is a curated list whose size is checked: it is only broadcast up to 5,000 rows; longer lists meet
    the texts' words by an equality join on the name's first word.
    """
    words = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(r"[\p{L}0-9]+"), F.lit(0))).alias("words"))
    n = names.select("name", "kind", F.lower(F.regexp_extract("name", r"^([\p{L}0-9]+)", 1)).alias("word"))
    if n.limit(5001).count() <= 5000:
        n = F.broadcast(n)
    hit = words.select("id", "text", F.explode("words").alias("word")).join(n, "word")
    whole = F.regexp_instr(F.lower("text"), F.concat(F.lit(r"(?<![\p{L}0-9])"), F.lower("name"), F.lit(r"(?![\p{L}0-9])"))) > 0
    return hit.where(whole).select("id", "name", "kind").distinct()

