"""Entity extraction by dictionaries and rules: whitelist, semantic rules with claims and relations, and their merge with pattern hits.

Names of any dictionary are sought in one pass over a text by hashes (``names``); everything after that is column functions, or in the merge
with pattern hits a map of each text. A dictionary is broadcast, so its size is checked: more than ``most_names`` names raise ``ValueError``.

Nulls and edges: a null text gives no rows; null or empty names are ignored; a name that comes twice is one name (its smallest kind and
canonical form); rows that repeat an id are one document for entities, each value once, and separate ones for claims and relations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import Names

#: Marks of menus, headings, tables and code around a name, and what identifiers look like.
MENU_MARKS = ("* [", "](#", "](/", "###", "##", "```", "| ", "Table of Contents", "Prerequisites", "See also", "Related", "Navigation", "Menu")
IDENTIFIERS = (("CreditClass", r"(?U)\b(C[0-9]{2,3})\b"), ("Project", r"(?U)\b(P[0-9]{3,4})\b"), ("Methodology", r"(?U)\b(VM[0-9]{4})\b"))
CREDIT_TYPES = ("carbon", "biodiversity", "soil")
#: What is no author though it stands where authors stand, and what no author's name holds.
NO_AUTHORS = (
    "author checklist", "pull request", "upgrade guide", "migration guide", "change log", "release process", "our pledge", "our standards", "blockchain basics", "wallet security", "initial setup", "credit class", "credit type",
    "example output", "quick start", "line interface",
)
NO_AUTHOR_PARTS = ("guide", "process", "checklist", "setup")
AUTHORS = (r"(?U)[yr](?<=by|author)\s+([A-Z][a-z]+ [A-Z][a-z]+)", r"(?U)—\s*([A-Z][a-z]+ [A-Z][a-z]+)")
CLAIMS = (r"(?iU)(must|should|required|recommended|may)\s+([^.]+)", r"(?iU)(The following[^:]+:)\s*([^.]+)", r"(?iU)(Each [^:]+:)\s*([^.]+)")
VERBS = ("developed|created|built|maintains", "uses|implements|follows")
#: What disqualifies a pattern hit.
BAD_PARTS = (
    "inc", "include", "including", "included", "must", "should", "will", "may", "can", "need", "required", "recommended", "following", "patch release", "author checklist", "pull request", "code of conduct", "our pledge", "our standards",
    "upgrade guide", "migration guide", "change log", "release process", "security", "readme", "license",
)
NO_PERSON_PARTS = ("guide", "list", "process", "module", "service")
NO_ORGANIZATION_PARTS = ("release", "guide", "process", "module")


def _dictionary(names: DataFrame, most_names: int) -> tuple[Names, pa.Table]:
    """The names to be sought and, in their order, name, kind, canonical, the name in upper case and a hash of it with the kind."""
    has = "canonical" in names.columns
    each = names.where("name is not null and name <> ''").groupBy("name").agg(F.min("kind").alias("kind"), F.min("canonical" if has else "name").cast("string").alias("canonical"))
    listed = each.withColumn("key", F.upper("name")).withColumn("hash", F.xxhash64("kind", "key")).limit(most_names + 1).toArrow().combine_chunks()
    if len(listed) > most_names:
        raise ValueError(f"more than {most_names} names")
    listed = listed.take(pc.sort_indices(listed["name"])).combine_chunks()
    return Names(listed["name"].to_pylist()), listed


def _small(batch: pa.RecordBatch, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most`` bytes of text, one row at least: a text can hold thousands of names, each with its context."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())).to_pylist()
    lo = 0
    while lo < batch.num_rows:
        done, hi = ends[lo - 1] if lo else 0, lo + 1
        while hi < batch.num_rows and ends[hi] - done <= most:
            hi += 1
        yield batch.slice(lo, hi - lo)
        lo = hi


def name_hits(docs: DataFrame, id_col: str, text_col: str, names: DataFrame, around: int = 50, most_names: int = 1_000_000, brief: bool = False) -> DataFrame:
    """(id, name, kind, canonical, places, whole, same_case, context): each name that stands in a text in whatever case.

    ``whole`` counts its places between word boundaries, ``same_case`` says whether one is written as the name is, and ``context`` is the
    text ``around`` the first place. ``brief`` leaves places, whole and context out, and what they cost. ``names``: name, kind, and canonical where a form stands for another name.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    finder, listed = _dictionary(names, most_names)
    sent = docs.sparkSession.sparkContext.broadcast((finder, [listed[c].combine_chunks() for c in ("name", "kind", "canonical")]))
    fields = {"id": docs.schema[id_col].dataType.simpleString(), "name": "string", "kind": "string", "canonical": "string", "places": "long", "whole": "long", "same_case": "boolean", "context": "string"}
    if brief:
        fields = {c: t for c, t in fields.items() if c not in ("places", "whole", "context")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, columns = sent.value
        for batch in (part for whole in batches for part in _small(whole)):
            texts = batch.column(1).to_pylist()
            row, name, start, same, whole = finder.find(texts, whole=not brief)
            by = np.lexsort((start, name, row))
            row, name, start, same, whole = (x[by] for x in (row, name, start, same, whole))
            first = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(name, prepend=-1))  # of each name in a text
            if not len(first):
                continue
            of = pa.array(name[first])
            every = {"id": batch.column(0).take(pa.array(row[first]))} | {c: x.take(of) for c, x in zip(("name", "kind", "canonical"), columns, strict=True)} | {"same_case": pa.array(np.logical_or.reduceat(same, first))}
            if not brief:
                sizes = np.array(pc.utf8_length(every["name"]))
                context = [texts[r][max(0, s - around) : s + n + around] for r, s, n in zip(row[first].tolist(), start[first].tolist(), sizes.tolist(), strict=True)]
                every |= {"places": pa.array(np.diff(first, append=len(row))), "whole": pa.array(np.add.reduceat(whole.astype(np.int64), first)), "context": pa.array(context, pa.string())}
            yield pa.RecordBatch.from_pydict({c: every[c] for c in fields})

    return own.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in fields.items()))


def any_part(text: Column, parts: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(text, p))


def _identifiers(text: Column, around: int) -> Column:
    """Array of (kind, value, place, credit_type): identifiers in the order of their places within each kind; the credit type by what
    stands around the value's first place."""

    def of(kind: str, pattern: str) -> Column:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        first = lambda x: F.regexp_instr(text, F.concat(F.lit(r"(?U)\b"), x, F.lit(r"\b")))
        once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  # a value is found once though it is used often
        context = lambda x: once(first(x), lambda at: F.lower(F.substring(text, F.greatest(F.lit(1), at - around), F.least(F.lit(around), at - 1) + F.length(x) + around)))
        named = F.lit("unknown")
        if kind != "CreditClass":
            return F.transform(values, lambda x, i: F.struct(F.lit(kind).alias("kind"), x.alias("value"), i.alias("place"), F.lit(None).cast("string").alias("credit_type")))

        def typed(x: Column) -> Column:
            def by(around_it: Column) -> Column:
                out = named
                for t in reversed(CREDIT_TYPES):
                    out = F.when(F.contains(around_it, F.lit(t)), t).otherwise(out)
                return out

            return once(context(x), by)

        return F.transform(values, lambda x, i: F.struct(F.lit(kind).alias("kind"), x.alias("value"), i.alias("place"), typed(x).alias("credit_type")))

    return F.concat(*[of(*rule) for rule in IDENTIFIERS])


def _with_identifiers(docs: DataFrame, id_col: str, text_col: str, around: int) -> DataFrame:
    each = docs.select(F.col(id_col).alias("id"), F.explode(_identifiers(F.col(text_col), around)).alias("e"))
    return each.groupBy("id", "e.kind", "e.value").agg(F.min_by("e.credit_type", "e.place").alias("credit_type"))


def whitelist(docs: DataFrame, id_col: str, text_col: str, names: DataFrame) -> DataFrame:
    """(id, kind, value, form, credit_type): listed names as whole words, unless the first place where a name stands is in a menu, a table, a
    heading or code, each canonical name once; and identifiers."""
    hits = name_hits(docs, id_col, text_col, names).where(F.col("whole") > 0).where(~any_part(F.col("context"), MENU_MARKS))
    named = hits.groupBy("id", "kind", F.lower("canonical").alias("low")).agg(F.min("canonical").alias("value"), F.min("name").alias("form"))
    ids = _with_identifiers(docs, id_col, text_col, 100)
    return named.select("id", "kind", "value", "form", F.lit(None).cast("string").alias("credit_type")).union(ids.select("id", "kind", "value", "value", "credit_type"))


def authors(text: Column) -> Column:
    """Names after ``by`` or a dash that are not known to be something else."""
    by, dash = (F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in AUTHORS)
    found = F.concat(by, F.when(F.contains(text, F.lit("—")), dash).otherwise(F.array().cast("array<string>")))  # a null text: the first is null
    return F.filter(found, lambda x: ~F.lower(x).isin(*NO_AUTHORS) & ~any_part(F.lower(x), NO_AUTHOR_PARTS))


def semantic_entities(docs: DataFrame, id_col: str, text_col: str, names: DataFrame) -> DataFrame:
    """(id, kind, value, confidence, credit_type): listed names, authors and identifiers, each value once.

    ``names``: name, kind, and ``core``: core names count in any case and 0.95, other organisations as written and 0.9, other people as
    written and 0.95.
    """
    order = F.array(*[F.lit(t) for t in sorted((*CREDIT_TYPES, "unknown"))])
    # the largest type by its number: a largest text would make Spark sort all rows
    best = F.max(F.nullif(F.array_position(order, F.col("credit_type")), F.lit(0))).alias("credit_type")
    every = _semantic_hits(docs, id_col, text_col, names).groupBy("id", "kind", "value").agg(F.max("confidence").alias("confidence"), best)
    return every.withColumn("credit_type", F.get(order, F.col("credit_type") - 1))


def _marked(names: DataFrame) -> DataFrame:
    """The dictionary of ``semantic_entities`` with its core names marked by their canonical form."""
    return names.select("name", "kind", F.when(F.col("core"), "core").alias("canonical"))


def _semantic_hits(docs: DataFrame, id_col: str, text_col: str, names: DataFrame, most_names: int = 1_000_000) -> DataFrame:
    """The rows of ``semantic_entities``, a value once for each rule that finds it."""
    hits = name_hits(docs, id_col, text_col, _marked(names), most_names=most_names, brief=True)
    core = F.coalesce(F.col("canonical") == "core", F.lit(False))
    listed = hits.where(core | F.col("same_case")).select("id", "kind", F.col("name").alias("value"), F.when(~core & (F.col("kind") == "Organization"), 0.9).otherwise(0.95).alias("confidence"), F.lit(None).cast("string").alias("credit_type"))
    by = docs.select(F.col(id_col).alias("id"), F.explode(authors(F.col(text_col))).alias("value")).select("id", F.lit("Person").alias("kind"), "value", F.lit(0.8).alias("confidence"), F.lit(None).cast("string").alias("credit_type"))
    ids = _with_identifiers(docs, id_col, text_col, 50).select("id", "kind", "value", F.lit(0.95).alias("confidence"), "credit_type")
    return listed.union(by).union(ids)


def claims(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, rule, place, statement): requirements and lists, of more than ten characters."""
    text = F.col(text_col)
    found = []
    for k, p in enumerate(CLAIMS):
        both = F.zip_with(F.regexp_extract_all(text, F.lit(p), F.lit(1)), F.regexp_extract_all(text, F.lit(p), F.lit(2)), lambda a, b: F.regexp_replace(F.concat(a, F.lit(" "), b), r"(?U)^\s+|\s+$", ""))
        found.append(_numbered(both, k))
    each = docs.select(F.col(id_col).alias("id"), F.explode(F.concat(*found)).alias("c"))
    return each.select("id", "c.rule", "c.place", "c.statement").where(F.length("statement") > 10)


def _numbered(values: Column, rule: int) -> Column:
    return F.transform(values, lambda s, i: F.struct(F.lit(rule).alias("rule"), i.alias("place"), s.alias("statement")))


def relations(docs: DataFrame, id_col: str, text_col: str, entities: DataFrame) -> DataFrame:
    """(id, source, target): what stands before and after a verb of making or using, where both ends are entities of the document.

    A run of words and spaces is split at its last verb; the ends are joined to the document's entities, so that only whole runs count.
    """
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(r"(?U)[\w\s]+"), F.lit(0))).alias("run"))
    trimmed = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    ends = []
    for verbs in VERBS:
        p = rf"(?iU)^([\w\s]+)\s+(?:{verbs})\s+([\w\s]+)$"
        part = lambda k, p=p: trimmed(F.regexp_extract("run", p, k))
        some = runs.where(F.col("run").rlike(rf"(?iU)\s(?:{verbs})\s"))  # most runs hold no verb, and this test is linear
        ends.append(some.where(F.col("run").rlike(p)).select("id", part(1).alias("source"), part(2).alias("target")))
    known = entities.select("id", F.col("value")).distinct()
    out = ends[0].union(ends[1])
    return out.join(known.withColumnRenamed("value", "source"), ["id", "source"], "left_semi").join(known.withColumnRenamed("value", "target"), ["id", "target"], "left_semi").select("id", "source", "target")


def good_pattern_hit(kind: Column, value: Column, known: tuple[str, ...] = ()) -> Column:
    """Whether a pattern hit is an entity: no fragment, no phrase of documents, a plausible name of its kind."""
    value, low = F.trim(value), F.lower(F.trim(value))
    words = F.split(value, r"(?U)\s+")
    person = (F.size(words) == 2) & F.forall(words, lambda w: w.rlike(r"^\p{Lu}\p{Ll}+$")) & ~any_part(low, NO_PERSON_PARTS)
    odd = (F.length(value) > 50) | F.endswith(low, F.lit(" inc")) | any_part(low, ("must", "should", "will", "can", "may")) | (low.rlike("^(the|a|an) ") & (F.length(value) > 30))
    plausible = value.rlike(r"^\p{Lu}") & (F.size(words) <= 4) & ~any_part(low, NO_ORGANIZATION_PARTS)
    organization = ~odd & ((low.isin(*known) if known else F.lit(False)) | plausible)
    base = (F.length(value) >= 3) & ~any_part(low, BAD_PARTS) & ~(kind.isin("Person", "Organization") & (low == value))
    return base & F.when(kind == "Person", person).when(kind == "Organization", organization).otherwise(kind.isin("CreditClass", "Project", "Methodology"))


def hybrid(docs: DataFrame, id_col: str, text_col: str, names: DataFrame, known: tuple[str, ...] = (), brief: bool = False, most_names: int = 1_000_000) -> DataFrame:
    """(id, kind, key, value, origin, confidence): good pattern hits before semantic entities, one a kind and upper-case value.

    A document whose id stands in one row is merged where its text is, and only rows that repeat an id are shuffled. ``brief`` leaves
    value and confidence out, and what they cost.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    again = own.groupBy("id").count().where("count > 1").select(F.col("id").alias("_again"))
    many = again.limit(_MOST_AGAIN + 1).count()
    out = ("id", "kind", "key", "origin") if brief else ("id", "kind", "key", "value", "origin", "confidence")
    if many > _MOST_AGAIN:
        return _hybrid_by_id(own, names, known, most_names).select(*out)
    if not many:
        return _hybrid_in_rows(own, names, known, out, most_names)
    same = own["id"].eqNullSafe(again["_again"])
    alone, rest = (own.join(F.broadcast(again), same, how) for how in ("left_anti", "left_semi"))
    return _hybrid_in_rows(alone, names, known, out, most_names).union(_hybrid_by_id(rest, names, known, most_names).select(*out))


#: Repeated ids that are broadcast; with more of them all rows are merged by id.
_MOST_AGAIN = 100_000


def _hybrid_by_id(docs: DataFrame, names: DataFrame, known: tuple[str, ...], most_names: int) -> DataFrame:
    """``hybrid`` of rows (id, text) that may repeat an id."""
    from .kg import pattern_entities

    hits = pattern_entities(docs, "id", "text").where(good_pattern_hit(F.col("kind"), F.col("value"), known))
    patterns = hits.select("id", "kind", "value", F.lit("pattern").alias("origin"), "confidence")
    semantic = _semantic_hits(docs, "id", "text", names, most_names).select("id", "kind", "value", F.lit("semantic").alias("origin"), "confidence")
    every = patterns.union(semantic)
    first = F.min(F.struct((F.col("origin") != "pattern").alias("rank"), F.col("value"), F.col("origin"), (-F.col("confidence")).alias("less"))).alias("f")  # of one value the best confidence
    return every.groupBy("id", "kind", F.upper("value").alias("key")).agg(first).select("id", "kind", "key", "f.value", "f.origin", (-F.col("f.less")).alias("confidence"))


def _rule_hits(text: Column, known: tuple[str, ...]) -> Column:
    """Array of (kind, key, value, rank, good, less, hash): pattern hits (rank 0) by place, authors and identifiers (rank 1). ``less``: the negative confidence."""
    from .kg import codes, pattern_hits

    def hit(kind: Column, value: Column, rank: int, good: Column, confidence: float) -> Column:
        key = F.upper(value)
        return F.struct(kind.alias("kind"), key.alias("key"), value.alias("value"), F.lit(rank).alias("rank"), good.alias("good"), F.lit(-confidence).alias("less"), F.xxhash64(kind, key).alias("hash"))

    patterns = F.transform(pattern_hits(text), lambda x: hit(x["kind"], x["value"], 0, F.coalesce(good_pattern_hit(x["kind"], x["value"], known), F.lit(False)), 0.95))
    by = F.transform(authors(text), lambda x: hit(F.lit("Person"), x, 1, F.lit(True), 0.8))
    ids = F.transform(codes(text, list(IDENTIFIERS)), lambda x: hit(x["kind"], x["value"], 1, F.lit(True), 0.95))
    return F.concat(patterns, by, ids)


def _best_of_rules(rules: pa.Array) -> dict[tuple, tuple]:
    """(row, kind, key) -> (rank, value, less, hash) of a batch's ``_rule_hits``: a good first pattern hit, else the least semantic one."""
    patterns: set[tuple] = set()
    best: dict[tuple, tuple] = {}
    flat = pc.list_flatten(rules).flatten()
    for row, kind, key, value, rank, good, less, h in zip(pc.list_parent_indices(rules).to_pylist(), *[c.to_pylist() for c in flat], strict=True):
        at, new = (row, kind, key), (rank, value, less, h)
        if rank == 0:
            if at in patterns:
                continue
            patterns.add(at)
        if good and (at not in best or new < best[at]):
            best[at] = new
    return best


def _hybrid_in_rows(docs: DataFrame, names: DataFrame, known: tuple[str, ...], out: tuple[str, ...], most_names: int) -> DataFrame:
    """``hybrid`` of rows (id, text) that repeat no id: nothing is shuffled."""
    finder, listed = _dictionary(_marked(names), most_names)
    # names that are one kind and upper-case value are one entity
    entity = pc.dictionary_encode(pc.binary_join_element_wise(listed["kind"].combine_chunks(), listed["key"].combine_chunks(), "\0")).indices.to_numpy().astype(np.int64)
    of_hash = np.argsort(listed["hash"].to_numpy(), kind="stable")
    sent = docs.sparkSession.sparkContext.broadcast((finder, listed.select(["name", "kind", "canonical", "key"]), entity, of_hash, listed["hash"].to_numpy()[of_hash]))
    types = {"id": docs.schema["id"].dataType.simpleString(), "confidence": "double"}
    fields = {c: types.get(c, "string") for c in out}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, listed, entity, of_hash, hashes = sent.value
        written, kinds, core, keys = (c.combine_chunks() for c in listed.columns)
        core = np.asarray(pc.fill_null(pc.equal(core, "core"), False))
        organization = np.asarray(pc.equal(kinds, "Organization"))
        n = max(1, len(entity))

        def listed_as(kind: str, key: str, h: int) -> int:
            """The entity of the dictionary with this kind and upper-case value, or -1."""
            at = int(np.searchsorted(hashes, h))
            while at < len(hashes) and hashes[at] == h:
                i = int(of_hash[at])
                if keys[i].as_py() == key and kinds[i].as_py() == kind:
                    return int(entity[i])
                at += 1
            return -1

        for batch in (part for whole in batches for part in _small(whole)):
            row, name, _, same, _ = finder.find(batch.column(1).to_pylist())
            counts = core[name] | same
            each = np.unique(row[counts] * n + name[counts])  # by row and value
            row, name = each // n, each % n
            codes, first = np.unique(row * n + entity[name], return_index=True)
            row, name = row[first], name[first]
            less = np.where(organization[name] & ~core[name], -0.9, -0.95)
            keep = np.ones(len(name), bool)
            best = _best_of_rules(batch.column(2))
            for (r, kind, key), (rank, value, others, h) in list(best.items()):
                e = listed_as(kind, key, h)
                at = int(np.searchsorted(codes, r * n + e))
                if e >= 0 and at < len(codes) and codes[at] == r * n + e:
                    if (rank, value, others) < (1, written[int(name[at])].as_py(), float(less[at])):
                        keep[at] = False
                    else:
                        del best[r, kind, key]
            row, of, less = row[keep], pa.array(name[keep]), less[keep]
            rules = [(*k, *v) for k, v in best.items()]
            text = lambda k: pa.array([x[k] for x in rules], pa.string())
            every = {"id": pa.concat_arrays([batch.column(0).take(pa.array(row)), batch.column(0).take(pa.array([x[0] for x in rules], pa.int64()))])}
            every |= {"kind": pa.concat_arrays([kinds.take(of), text(1)]), "key": pa.concat_arrays([keys.take(of), text(2)])}
            every |= {"origin": pa.concat_arrays([pa.repeat("semantic", len(of)), pa.array(["semantic" if x[3] else "pattern" for x in rules], pa.string())])}
            if "value" in fields:
                every |= {"value": pa.concat_arrays([written.take(of), text(4)]), "confidence": pa.array(-np.concatenate([less, np.array([x[5] for x in rules], float)]))}
            yield pa.RecordBatch.from_pydict({c: every[c] for c in fields})

    with_rules = docs.where("text is not null").select("id", "text", _rule_hits(F.col("text"), known).alias("rules"))
    return with_rules.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in fields.items()))
