"""Export of extractions as triples: what each was, its entities, its statements linked to entities, and where all of it came from.

A statement's ends are linked through an index of labels in which the last writer wins: the entity that was extracted last under a name.
The index is one grouped maximum, statements meet it by equality, and the triples are rows; nothing is held whole.

``extractions``: rid, memory_rid, kind, confidence, version, tokens, cost, created (text), source_url, entities (array of rid, type, name,
confidence) and statements (array of rid, subject, predicate, object, kind, confidence).

Nulls and edges: extractions of one time are ordered by rid; a null or blank name has a label but no place in the index; null ends of a
statement are empty texts; without source_url there is no triple of the source; null arrays are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kg import durable

#: Kinds of entities that have a class of their own, and predicates that have a name of their own.
CLASSES = ("Person", "Organization", "Project", "Place", "Asset", "Credit", "Methodology", "Event")
PREDICATES = {
    "is_available_at": "schema:url", "founded_by": "schema:founder", "founded": "schema:foundingDate", "works_for": "schema:worksFor", "member_of": "schema:memberOf", "part_of": "schema:isPartOf", "located_in": "schema:location",
}


def literal(text: Column) -> Column:
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r'([\\"])', r"\\$1")
    for mark, name in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        out = F.replace(out, F.lit(mark), F.lit(f"\\{name}"))
    return F.concat(F.lit('"'), out, F.lit('"'))


def typed(value: Column, kind: str) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit(f'"^^xsd:{kind}'))


def uri(rid: Column, base: str) -> Column:
    return F.concat(F.lit(f"<{base}"), F.replace(F.replace(rid, F.lit("orn:"), F.lit("")), F.lit(":"), F.lit("/")), F.lit(">"))


def normal(label: Column) -> Column:
    """A label in lower case with single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(label, F.lit(""))), r"(?U)\s+", " "))


def predicate(name: Column, prefix: str = "kg") -> Column:
    """Known predicates by name; others in camel case: spaces part words as ``_`` does, other marks but ``-`` go."""
    plain = F.regexp_replace(F.replace(F.coalesce(name, F.lit("")), F.lit(" "), F.lit("_")), "[^a-zA-Z0-9_-]", "")
    words = F.split(plain, "_")
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))
    camel = F.concat(F.lit(f"{prefix}:"), F.lower(F.element_at(words, 1)), F.array_join(F.transform(F.slice(words, F.lit(2), F.size(words)), capital), ""))
    out = F
    for known, own in PREDICATES.items():
        out = out.when(name == known, own)
    return out.otherwise(camel)


def _each(df: DataFrame, subject: Column, facts: list[tuple[str | Column, Column]]) -> DataFrame:
    """A triple for each fact whose object is not null."""
    pairs = [F.struct((F.lit(p) if isinstance(p, str) else p).alias("p"), o.alias("o")) for p, o in facts]
    return df.select(subject.alias("s"), F.explode(F.filter(F.array(*pairs), lambda f: f["o"].isNotNull())).alias("f")).select("s", "f.p", "f.o")


def label_index(entities: DataFrame) -> DataFrame:
    """(label, uri): each name as written and in normal form, of the entity that came last."""
    key = F.explode(F.array_distinct(F.array("name", normal(F.col("name"))))).alias("label")
    return entities.where(normal(F.col("name")) != "").select(key, "uri", "order").groupBy("label").agg(F.max_by("uri", "order").alias("uri"))


def export(extractions: DataFrame, base: str, prefix: str = "kg") -> DataFrame:
    """(s, p, o) of all extractions."""
    x = durable(extractions.select("*", uri(F.col("rid"), base).alias("x"), F.concat(F.lit("<"), F.col("source_url"), F.lit(">")).alias("source")))  # read by every branch below, found once
    k = lambda name: f"{prefix}:{name}"
    about = _each(x, F.col("x"), [
        ("rdf:type", F.lit(k("Extraction"))), ("rdf:type", F.lit("prov:Activity")), (k("extractionType"), literal(F.col("kind"))), (k("memory"), uri(F.col("memory_rid"), base)), (k("confidenceScore"), typed(F.col("confidence"), "float")),
        (k("ontologyVersion"), literal(F.col("version"))), ("prov:hadPrimarySource", F.col("source")), ("prov:wasGeneratedBy", F.lit(f"<{base}extractor/unified>")), ("prov:generatedAtTime", typed(F.col("created"), "dateTime")),
        (k("tokensConsumed"), typed(F.col("tokens"), "integer")), (k("cost"), typed(F.col("cost"), "float")),
    ])
    e = x.select("x", "source", "created", "rid", F.posexplode("entities").alias("place", "e")).select("x", "source", "e.name", F.col("e.type").alias("type"), F.col("e.confidence").alias("confidence"), uri(F.col("e.rid"), base).alias("uri"), F.struct("created", "rid", "place").alias("order"))
    kind = F.coalesce("type", F.lit("Entity"))
    entities = _each(e, F.col("uri"), [
        ("rdf:type", F.when(kind.isin(*CLASSES), F.concat(F.lit("schema:"), kind)).otherwise(k("Entity"))), ("rdfs:label", literal(F.col("name"))), (k("entityType"), literal(kind)), (k("confidence"), typed(F.coalesce("confidence", F.lit(0.0)), "float")),
        ("prov:wasGeneratedBy", F.col("x")), ("prov:hadPrimarySource", F.col("source")),
    ])
    index = label_index(e)
    s = x.select("x", "source", F.explode("statements").alias("t")).select("x", "source", "t.*").withColumn("uri", uri(F.col("rid"), base))
    for end in ("subject", "object"):
        exact = index.select(F.col("label").alias(end), F.col("uri").alias(f"{end}_exact"))
        like = index.select(F.col("label").alias(f"{end}_normal"), F.col("uri").alias(f"{end}_like"))
        s = s.join(exact, end, "left").withColumn(f"{end}_normal", normal(F.col(end))).join(like, f"{end}_normal", "left").withColumn(f"{end}_uri", F.coalesce(f"{end}_exact", f"{end}_like"))
    s = durable(s)
    linked = s.where("subject_uri is not null").select(F.col("subject_uri").alias("s"), predicate(F.col("predicate"), prefix).alias("p"), F.coalesce("object_uri", literal(F.col("object"))).alias("o"))
    text = lambda end: F.when(F.col(f"{end}_uri").isNull(), literal(F.col(end)))
    statements = _each(s, F.col("uri"), [
        ("rdf:type", F.lit(k("Statement"))), ("rdf:type", F.lit("prov:Entity")), (k("subjectEntity"), F.col("subject_uri")), (k("subjectText"), text("subject")), (k("objectEntity"), F.col("object_uri")), (k("objectText"), text("object")),
        (k("predicate"), literal(F.col("predicate"))), (k("statementType"), literal(F.coalesce("kind", F.lit("claim")))), (k("confidence"), typed(F.coalesce("confidence", F.lit(0.0)), "float")), ("prov:wasGeneratedBy", F.col("x")), ("prov:hadPrimarySource", F.col("source")),
    ])
    return about.union(entities).union(linked).union(statements)


def receipts(rows: DataFrame, base: str) -> DataFrame:
    """(s, p, o) of provenance receipts (output_rid, input_rid, kind): what each output was derived from, and by which step."""
    return _each(rows, uri(F.col("output_rid"), base), [("rdf:type", F.lit("prov:Entity")), ("prov:wasDerivedFrom", uri(F.col("input_rid"), base)), ("prov:wasGeneratedBy", F.concat(F.lit(f"<{base}step/"), "kind", F.lit(">")))])
