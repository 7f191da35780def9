"""Extractions and receipts of the driver's tables as triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import triples as t
from .registry import query
from .views import Views

_BASE = "https://example.org/kg#"
_KINDS = ("Person", "Organization", "Concept")
_PREDICATES = ("part_of", "grows near", "founded_by", "holds")

_URI = f"'<{_BASE}' || replace(replace({{}}, 'orn:', ''), ':', '/') || '>'"
_LIT = "'\"' || {} || '\"'"


def _sql() -> str:
    uri, lit = _URI.format, _LIT.format
    name = f"case hash_kind {' '.join(f'when {i} then {k!r}' for i, k in enumerate(_KINDS))} end"
    pred = f"case (i + doc_id) % 4 {' '.join(f'when {i} then {k!r}' for i, k in enumerate(_PREDICATES))} end"
    camel = "case predicate when 'part_of' then 'schema:isPartOf' when 'founded_by' then 'schema:founder' when 'grows near' then 'kg:growsNear' else 'kg:holds' end"
    return f"""with x as (select doc_id, extraction_rid as rid, memory_rid, extraction_type as kind, confidence, extractor_version as version, tokens, cost, lpad(day::varchar, 6, '0') || 'T' || lpad(hour::varchar, 2, '0') as created,
   case when doc_id % 3 <> 0 then 'https://example.org/d/' || doc_id end as url, list_sort(entities) as entities from extractions),
 p as (select *, unnest(range(1, len(entities) + 1)) as i from x), e0 as (select *, entities[i] as name, length(entities[i]) % 3 as hash_kind from p),
 e as (select *, {name} as type, 'orn:entity:' || lower(name) || ':' || doc_id as erid from e0),
 labels as (select label, arg_max({uri('erid')}, {{'c': created, 'r': rid, 'i': i}}) as uri from (select *, name as label from e union all select *, lower(name) from e) l group by label),
 s0 as (select *, 'orn:statement:' || doc_id || ':' || i as srid, entities[i] as subject, {pred} as predicate, case when i % 3 = 0 then upper(entities[i + 1]) when i % 3 = 1 then entities[i + 1] else 'no ' || entities[i + 1] end as object from p where i < len(entities)),
 s as (select s0.*, coalesce(a.uri, b.uri) as su, coalesce(c.uri, d.uri) as ou from s0 left join labels a on a.label = subject left join labels b on b.label = lower(subject) left join labels c on c.label = object left join labels d on d.label = lower(object))
select {uri('rid')} as s, unnest(['rdf:type', 'rdf:type', 'kg:extractionType', 'kg:memory', 'kg:confidenceScore', 'kg:ontologyVersion', 'prov:wasGeneratedBy', 'prov:generatedAtTime', 'kg:tokensConsumed', 'kg:cost']) as p,
  unnest(['kg:Extraction', 'prov:Activity', {lit('kind')}, {uri('memory_rid')}, '"' || confidence || '"^^xsd:float', {lit('version')}, '<{_BASE}extractor/unified>', '"' || created || '"^^xsd:dateTime', '"' || tokens || '"^^xsd:integer', '"' || cost || '"^^xsd:float']) as o from x
union all select {uri('rid')}, 'prov:hadPrimarySource', '<' || url || '>' from x where url is not null
union all select {uri('erid')}, unnest(['rdf:type', 'rdfs:label', 'kg:entityType', 'kg:confidence', 'prov:wasGeneratedBy']), unnest([case when type = 'Concept' then 'kg:Entity' else 'schema:' || type end, {lit('name')}, {lit('type')}, '"0.0"^^xsd:float', {uri('rid')}]) from e
union all select {uri('erid')}, 'prov:hadPrimarySource', '<' || url || '>' from e where url is not null
union all select su, {camel}, coalesce(ou, {lit('object')}) from s where su is not null
union all select {uri('srid')}, unnest(['rdf:type', 'rdf:type', 'kg:predicate', 'kg:statementType', 'kg:confidence', 'prov:wasGeneratedBy']), unnest(['kg:Statement', 'prov:Entity', {lit('predicate')}, '"claim"', '"0.0"^^xsd:float', {uri('rid')}]) from s
union all select {uri('srid')}, case when su is null then 'kg:subjectText' else 'kg:subjectEntity' end, coalesce(su, {lit('subject')}) from s union all select {uri('srid')}, case when ou is null then 'kg:objectText' else 'kg:objectEntity' end, coalesce(ou, {lit('object')}) from s
union all select {uri('srid')}, 'prov:hadPrimarySource', '<' || url || '>' from s where url is not null"""


@query("grf_02_linked_triples", _sql(), "extractions")
def linked_triples(v: Views) -> DataFrame:
    """Extractions, their entities, and statements between neighbouring entities, linked by label where one is known."""
    x = v.extractions.withColumn("names", F.array_sort("entities")).drop("entities")
    kind = lambda n: F.element_at(F.array(*map(F.lit, _KINDS)), (F.length(n) % 3 + 1).cast("int"))
    entities = F.transform("names", lambda n: F.struct(F.concat(F.lit("orn:entity:"), F.lower(n), F.lit(":"), "doc_id").alias("rid"), kind(n).alias("type"), n.alias("name"), F.lit(None).cast("double").alias("confidence")))
    places = F.slice(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("names"))), F.lit(1), F.greatest(F.lit(0), F.size("names") - 1))

    def statement(i):
        following = F.element_at("names", i + 1)
        object_ = F.when(i % 3 == 0, F.upper(following)).when(i % 3 == 1, following).otherwise(F.concat(F.lit("no "), following))
        predicate = F.element_at(F.array(*map(F.lit, _PREDICATES)), ((i + F.col("doc_id")) % 4 + 1).cast("int"))
        rid = F.concat(F.lit("orn:statement:"), "doc_id", F.lit(":"), i)
        return F.struct(rid.alias("rid"), F.element_at("names", i).alias("subject"), predicate.alias("predicate"), object_.alias("object"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("confidence"))

    created = F.concat(F.lpad(F.col("day").cast("string"), 6, "0"), F.lit("T"), F.lpad(F.col("hour").cast("string"), 2, "0"))
    url = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("https://example.org/d/"), "doc_id"))
    given = x.select(F.col("extraction_rid").alias("rid"), "memory_rid", F.col("extraction_type").alias("kind"), "confidence", F.col("extractor_version").alias("version"), "tokens", "cost", created.alias("created"), url.alias("source_url"), entities.alias("entities"), F.transform(places, statement).alias("statements"))
    return t.export(given, _BASE)


_R = _URI.format


@query("grf_02_receipt_triples", f"""
select {_R('output_rid')} as s, 'rdf:type' as p, 'prov:Entity' as o from receipts union all select {_R('output_rid')}, 'prov:wasGeneratedBy', '<{_BASE}step/' || kind || '>' from receipts
union all select {_R('output_rid')}, 'prov:wasDerivedFrom', {_R('input_rid')} from receipts where input_rid is not null""", "receipts")
def receipt_triples(v: Views) -> DataFrame:
    """The lineage of all receipts."""
    return t.receipts(v.receipts, _BASE)
