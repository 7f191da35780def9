"""Knowledge-graph queries: extraction, dedup, resolution, contradictions, lineage, export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import kg
from .documents import _sql_values, _values
from .registry import query
from .views import Views


@query("ext_01_pattern_entities", r"select doc_id, kind, value from (select doc_id, 'email' as kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) as value from documents union all select doc_id, 'phone', unnest(regexp_extract_all(text, '\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}')) from documents) t group by all")
def patterns(v: Views) -> DataFrame:
    d = v.table("documents")
    found = lambda kind, p: d.select("doc_id", F.lit(kind).alias("kind"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(p), F.lit(0)))).alias("value"))
    return found("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}").union(found("phone", r"\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}"))


_NAMES = [("thention", "person"), ("erheat", "organisation"), ("is the", "phrase"), ("ouvipa", "person")]


@query("ext_02_whitelist", f"select doc_id as id, name, kind from documents, (values {_sql_values(_NAMES)}) n(name, kind) where regexp_matches(lower(text), '(^|[^\\p{{L}}0-9])' || name || '($|[^\\p{{L}}0-9])')")
def whitelist(v: Views) -> DataFrame:
    return kg.whitelist_hits(v.table("documents"), "doc_id", "text", _values(v, _NAMES, "name string, kind string"))


@query("ext_03_rule_claims", "select doc_id, count(*) as claims from (select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ (is|are) [a-z]+')) as c from documents) t group by 1")
def claims(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+ (is|are) [a-z]+"), F.lit(0))).alias("c")).groupBy("doc_id").agg(F.count("*").alias("claims"))


@query("ext_04_hybrid_merge", "select doc_id, value, arg_min(origin, priority) as origin from (select doc_id, unnest(entities) as value, 'rule' as origin, 2 as priority from extractions union all select doc_id, unnest(entities), 'pattern', 1 from extractions where doc_id % 2 = 0) t group by 1, 2", "extractions")
def hybrid(v: Views) -> DataFrame:
    x = v.extractions.select("doc_id", F.explode("entities").alias("value"))
    both = x.select("*", F.lit("rule").alias("origin"), F.lit(2).alias("priority")).union(x.where("doc_id % 2 = 0").select("*", F.lit("pattern"), F.lit(1)))
    return both.groupBy("doc_id", "value").agg(F.min_by("origin", "priority").alias("origin"))


@query("ext_05_header_entities", "select role as name, max(case when turn = 0 then 1.0::double else 0.8::double end) as confidence, count(*) as n from turns group by 1", "turns")
def headers(v: Views) -> DataFrame:
    return v.turns.groupBy(F.col("role").alias("name")).agg(F.max(F.when(F.col("turn") == 0, 1.0).otherwise(0.8)).alias("confidence"), F.count("*").alias("n"))


@query("agg_25_dedup_merge", """
with e as (select doc_id, unnest(entities) as value, confidence from extractions), r as (select *, doc_id * 1000 + length(value) as seq, length(value) as rich from e)
select upper(value) as key, count(*) as occurrences, count(distinct doc_id) as documents, max(confidence) as confidence, arg_max(seq, {'a': rich, 'b': -seq}) as base_seq, min(seq) as first_seq, max(seq) as last_seq from r group by 1""", "extractions")
def dedup_merge(v: Views) -> DataFrame:
    e = v.extractions.select("doc_id", "confidence", F.explode("entities").alias("value"))
    r = e.select("*", F.upper("value").alias("key"), (F.col("doc_id") * 1000 + F.length("value")).alias("seq"))
    return kg.merge_entities(r, ["key"], "doc_id", "confidence", F.length("value"), "seq")


@query("agg_26_dedup_merge_v1", "select p_brand as brand, p_type as kind, arg_max(p_partkey, {'a': length(p_name), 'b': p_size, 'c': -p_partkey}) as base, count(*) as merged from part group by 1, 2")
def dedup_v1(v: Views) -> DataFrame:
    rank = F.struct(F.length("p_name"), F.col("p_size"), -F.col("p_partkey"))
    return v.table("part").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")).agg(F.max_by("p_partkey", rank).alias("base"), F.count("*").alias("merged"))


@query("agg_27_dedup_summary", "select coalesce(kind, 'all') as kind, count(*) as raw, count(distinct e) as uniq, count(*) - count(distinct e) as removed, round(100.0 * (count(*) - count(distinct e)) / count(*), 2) as rate from (select extraction_type as kind, unnest(entities) as e from extractions) t group by grouping sets ((kind), ())", "extractions")
def dedup_summary(v: Views) -> DataFrame:
    e = v.extractions.select(F.col("extraction_type").alias("kind"), F.explode("entities").alias("e"))
    out = e.rollup("kind").agg(F.count("*").alias("raw"), F.countDistinct("e").alias("uniq"))
    removed = F.col("raw") - F.col("uniq")
    return out.select(F.coalesce("kind", F.lit("all")).alias("kind"), "raw", "uniq", removed.alias("removed"), F.round(100.0 * removed / F.col("raw"), 2).alias("rate"))


@query("join_09_similar_names")
def similar(v: Views) -> DataFrame:
    names = v.table("part").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("id"))
    return kg.similar_names(names, "p_brand", "id", "p_name", 0.85).select("a", "b", F.round("score", 6).alias("score"))


@query("grf_01_components", """
with recursive e as (select distinct l_orderkey as o, 1000000000000 + l_suppkey as s from lineitem), edges as (select o as a, s as b from e union all select s, o from e),
 reach(node, component) using key (node) as (
  select a, a from edges group by a
  union select edges.b, min(reach.component) from reach join edges on reach.node = edges.a join recurring.reach as held on held.node = edges.b where reach.component < held.component group by edges.b)
select node, component from (select *, count(*) over (partition by component) as n from reach where node < 1000000000000) r where n > 1""")
def component_labels(v: Views) -> DataFrame:
    """Orders that share a supplier: each is linked with its supplier's first order, so no group is paired."""
    e = v.table("lineitem").select(F.col("l_orderkey").alias("b"), "l_suppkey")
    first = e.groupBy("l_suppkey").agg(F.min("b").alias("a"))
    with kg.small_tasks(v.spark, e.count()):
        return kg.components(e.join(first, "l_suppkey").select("a", "b"))


_BEATS = "case when f.sequence is not null and r.sequence is not null and f.sequence <> r.sequence then r.sequence > f.sequence else coalesce(r.stamp >= f.stamp, true) end"


@query("win_13_version_winner", f"""
with recursive r as (select rid as uid, case when seq % 3 <> 0 then cast(size_bytes % 5 as integer) end as sequence, strftime(ts, '%Y%m%d') as stamp, seq as arrival, row_number() over (partition by rid order by seq) as k from log),
 f(uid, k, sequence, stamp, arrival) as (select uid, k, sequence, stamp, arrival from r where k = 1
  union all select r.uid, r.k, case when {_BEATS} then r.sequence else f.sequence end, case when {_BEATS} then r.stamp else f.stamp end, case when {_BEATS} then r.arrival else f.arrival end from f join r on r.uid = f.uid and r.k = f.k + 1)
select uid, sequence, stamp, arrival from f qualify row_number() over (partition by uid order by k desc) = 1""", "log")
def versions(v: Views) -> DataFrame:
    rows = v.log.select(F.col("rid").alias("uid"), F.when(F.col("seq") % 3 != 0, (F.col("size_bytes") % 5).cast("int")).alias("sequence"), F.date_format("ts", "yyyyMMdd").alias("stamp"), F.col("seq").alias("arrival"))
    return kg.version_winner(rows)


_STOP_SQL = ", ".join(f"'{w}'" for w in "the a an and or but in on at to for of is are was were".split())


@query("join_10_contradictions", rf"""
with parts as (select doc_id, string_split_regex(text, '[.!?\n]+') as p from documents where doc_id is not null and text is not null),
 sentences as (select doc_id, unnest(generate_series(0, len(p) - 1)) as n, unnest(p) as text from parts),
 subjects as (select doc_id || '/' || n as id, doc_id, regexp_extract(text, '(?i)^\s*(\S.*?)\s+(?:is|are|was|were)\s+\S', 1) as subject, lower(trim(text)) as low from sentences),
 s as (select id, doc_id, regexp_replace(lower(subject), '^\s+|\s+$', '', 'g') as subject, contains(low, 'not ') or contains(low, 'n''t ') as negated,
   list_filter(list_distinct(string_split_regex(replace(replace(low, 'not ', ''), 'n''t ', ' '), '\s+')), lambda w: w <> '') as plain,
   list_filter(list_distinct(string_split_regex(low, '\s+')), lambda w: w <> '' and w not in ({_STOP_SQL})) as content from subjects where subject <> '')
select least(x.id, y.id) as a, greatest(x.id, y.id) as b, 'factual' as kind, 0.9::double as confidence from s x join s y on x.negated and not y.negated and x.doc_id <> y.doc_id
where 5 * least(len(x.plain), len(y.plain)) > 4 * greatest(len(x.plain), len(y.plain)) and len(list_intersect(x.plain, y.plain)) / len(list_distinct(list_concat(x.plain, y.plain))) > 0.8
 and (contains(x.subject, y.subject) or contains(y.subject, x.subject) or len(list_intersect(x.content, y.content)) >= 3)""")
def contradictory(v: Views) -> DataFrame:
    """Over every sentence of every document that says what something is; what stands before the verb is its subject."""
    sentence = v.table("documents").where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", r"[.!?\n]+")).alias("n", "text"))
    s = sentence.select("*", F.regexp_extract("text", r"(?i)^\s*(\S.*?)\s+(?:is|are|was|were)\s+\S", 1).alias("subject")).where("subject <> ''")
    return kg.contradictions(s.select(F.concat_ws("/", "doc_id", "n").alias("id"), F.col("doc_id").alias("extraction"), "subject", F.trim("text").alias("text")))


@query("rec_01_lineage", """
with recursive walk(start_rid, rid, input_rid, level) as (select output_rid, output_rid, input_rid, 1 from receipts where turn >= 3 union all select w.start_rid, r.output_rid, r.input_rid, w.level + 1 from walk w join receipts r on w.input_rid = r.output_rid where w.level < 10)
select start_rid, max(level) as levels, count(*) as steps from walk group by 1""", "receipts")
def lineage(v: Views) -> DataFrame:
    """Receipts walked backwards, ten levels at most."""
    edges = v.receipts.select(F.col("output_rid").alias("parent"), F.col("input_rid").alias("child"), "turn")
    steps = kg.walk(edges.where("turn >= 3").select(F.col("parent").alias("root"), "child"), edges.select("parent", "child"), 9)
    return steps.groupBy(F.col("root").alias("start_rid")).agg((F.max("level") + 1).alias("levels"), F.count("*").alias("steps"))


@query("grf_02_triples", """
with e as (select distinct n_name as name, 'Nation' as kind from nation union select distinct r_name, 'Region' from region),
 s as (select n_name as subject, 'partOf' as predicate, r_name as object from nation join region on n_regionkey = r_regionkey)
select '<http://example.org/' || regexp_replace(name, '[^A-Za-z0-9]+', '_', 'g') || '>' as s, 'rdf:type' as p, 'kg:' || kind as o from e
union all select '<http://example.org/' || regexp_replace(name, '[^A-Za-z0-9]+', '_', 'g') || '>', 'rdfs:label', '"' || name || '"' from e
union all select '<http://example.org/' || regexp_replace(subject, '[^A-Za-z0-9]+', '_', 'g') || '>', 'kg:' || predicate, '<http://example.org/' || regexp_replace(object, '[^A-Za-z0-9]+', '_', 'g') || '>' from s""")
def rdf(v: Views) -> DataFrame:
    nation, region = v.table("nation"), v.table("region")
    e = nation.select(F.col("n_name").alias("name"), F.lit("Nation").alias("kind")).union(region.select("r_name", F.lit("Region"))).distinct()
    s = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("subject"), F.lit("partOf").alias("predicate"), F.col("r_name").alias("object"))
    labels = e.select(F.col("name").alias("label"), F.concat(F.lit("<http://example.org/"), F.regexp_replace("name", "[^A-Za-z0-9]+", "_"), F.lit(">")).alias("uri"))
    return kg.triples(e, s, labels, "http://example.org/")


@query("grf_06_tree_walk", """
with recursive t(turn, conv_id, level) as (select turn, conv_id, 0 from conversations where turn = 0 union all select c.turn, c.conv_id, t.level + 1 from t join conversations c on c.conv_id = t.conv_id and c.turn = t.turn + 1 where t.level < 50 and c.role <> 'system')
select conv_id, max(level) as depth from t group by 1""")
def tree(v: Views) -> DataFrame:
    """Depth of each conversation from its first turn, a level a step; more than 50 levels are an error and not cut off."""
    c = v.table("conversations").select("conv_id", "turn", "role")
    edges = c.where("role <> 'system'").select(F.struct("conv_id", (F.col("turn") - 1).alias("turn")).alias("parent"), F.struct("conv_id", "turn").alias("child"))
    steps = kg.walk(c.where("turn = 0").select(F.col("conv_id").alias("root"), F.struct("conv_id", "turn").alias("child")), edges, 50, strict=True)
    return steps.groupBy(F.col("root").alias("conv_id")).agg(F.max("level").alias("depth"))
