"""Knowledge-graph metrics and provenance audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pct, sensor_by_prefix, sensor_by_substring
from .registry import query
from .views import Views

_PREFIX_SQL = "case when source_sensor like 'website%' then 'website' when source_sensor like 'discourse%' then 'discourse' when source_sensor like 'github-activity%' then 'github-activity' when source_sensor like 'github%' then 'github' when source_sensor like 'gitlab%' then 'gitlab' when source_sensor like 'notion%' then 'notion' when source_sensor like 'podcast%' then 'podcast' else 'other' end"


@query("agg_13_metrics_by_sensor_type", f"""
select {_PREFIX_SQL} as sensor, count(*) as memories, count(extraction_rid) as extractions, cast(coalesce(sum(len(entities)), 0) as bigint) as entities, cast(coalesce(sum(len(statements)), 0) as bigint) as statements,
 round(avg(confidence), 4) as avg_confidence, cast(coalesce(sum(tokens), 0) as bigint) as tokens, cast(coalesce(sum(cost), 0) as bigint) as cost, count(distinct lang) as langs, cast(max(n_chars) as bigint) as longest
from memories left join (select doc_id, extraction_rid, entities, statements, confidence, tokens, cost from extractions) x using (doc_id) group by 1""", "memories", "extractions")
def metrics_by_sensor(v: Views) -> DataFrame:
    return v.labelled.groupBy(sensor_by_prefix(F.col("source_sensor")).alias("sensor")).agg(
        F.count("*").alias("memories"), F.count("extraction_rid").alias("extractions"), F.coalesce(F.sum("ne"), F.lit(0)).alias("entities"), F.coalesce(F.sum("ns"), F.lit(0)).alias("statements"),
        F.round(F.avg("confidence"), 4).alias("avg_confidence"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("cost"), F.lit(0)).alias("cost"), F.countDistinct("lang").alias("langs"), F.max("n_chars").alias("longest"))


@query("agg_01_extraction_totals", "select count(*) as extractions, count(distinct memory_rid) as memories, round(avg(confidence), 4) as avg_confidence, cast(sum(len(entities)) as bigint) as entities, cast(sum(len(statements)) as bigint) as statements from extractions where day between 5 and 35", "extractions")
def extraction_totals(v: Views) -> DataFrame:
    return v.extractions.where("day between 5 and 35").agg(F.count("*").alias("extractions"), F.countDistinct("memory_rid").alias("memories"), F.round(F.avg("confidence"), 4).alias("avg_confidence"), F.sum(F.size("entities")).alias("entities"), F.sum(F.size("statements")).alias("statements"))


@query("agg_02_by_extraction_type", "select extraction_type, count(*) as n, round(avg(confidence), 4) as avg_confidence from extractions group by 1", "extractions")
def by_type(v: Views) -> DataFrame:
    return v.extractions.groupBy("extraction_type").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("avg_confidence"))


@query("agg_03_entity_type_distribution", "select length(e) as entity_type, count(*) as n, count(distinct e) as distinct_entities from (select unnest(entities) as e from extractions) t group by 1", "extractions")
def entity_types(v: Views) -> DataFrame:
    return v.extractions.select(F.explode("entities").alias("e")).groupBy(F.length("e").cast("long").alias("entity_type")).agg(F.count("*").alias("n"), F.countDistinct("e").alias("distinct_entities"))


@query("agg_04_top_entities", "select e as entity, count(*) as n from (select unnest(entities) as e from extractions) t group by 1 order by n desc, e limit 20", "extractions")
def top_entities(v: Views) -> DataFrame:
    return v.extractions.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(20)


@query("agg_05_resolution_stats", "select count(*) as receipts, count(distinct input_rid) as inputs, count(distinct output_rid) as outputs from receipts where kind = 'assistant'", "receipts")
def resolution_stats(v: Views) -> DataFrame:
    return v.receipts.where("kind = 'assistant'").agg(F.count("*").alias("receipts"), F.countDistinct("input_rid").alias("inputs"), F.countDistinct("output_rid").alias("outputs"))


@query("agg_06_cluster_sizes", "select size, count(*) as clusters from (select conv_id, count(*) as size from receipts group by 1) t group by 1", "receipts")
def cluster_sizes(v: Views) -> DataFrame:
    return v.receipts.groupBy("conv_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))


@query("agg_07_conditional_counts", "select count(*) as total, count(*) filter (toxic = 0) as resolved, count(*) filter (toxic = 1) as unresolved, count(*) filter (toxic is null) as unknown from documents left join labels using (doc_id)")
def conditional_counts(v: Views) -> DataFrame:
    d = v.table("documents").select("doc_id").join(v.table("labels"), "doc_id", "left")
    return d.agg(F.count("*").alias("total"), F.count_if(F.col("toxic") == 0).alias("resolved"), F.count_if(F.col("toxic") == 1).alias("unresolved"), F.count_if(F.col("toxic").isNull()).alias("unknown"))


@query("agg_08_contradictions_by_type", "select kind, count(*) as n, round(avg(entities_extracted), 4) as avg_confidence from receipts group by 1", "receipts")
def contradictions_by_type(v: Views) -> DataFrame:
    return v.receipts.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.avg("entities_extracted"), 4).alias("avg_confidence"))


@query("agg_09_cost_by_version", "select coalesce(extractor_version, 'all') as version, count(*) as n, cast(sum(tokens) as bigint) as tokens, cast(sum(cost) as bigint) as cost from extractions group by grouping sets ((extractor_version), ())", "extractions")
def cost_by_version(v: Views) -> DataFrame:
    return v.extractions.rollup("extractor_version").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost")).withColumn("version", F.coalesce("extractor_version", F.lit("all"))).drop("extractor_version")


@query("agg_10_provenance_completeness", "select (select count(*) from memories) as memories, count(distinct memory_rid) as extracted, round(100.0 * count(distinct memory_rid) / (select count(*) from memories), 2) as completeness from extractions", "memories", "extractions")
def provenance_completeness(v: Views) -> DataFrame:
    total = v.memories.agg(F.count("*").alias("memories"))
    done = v.extractions.agg(F.countDistinct("memory_rid").alias("extracted"))
    return total.join(done).select("memories", "extracted", pct(F.col("extracted"), F.col("memories")).alias("completeness"))


@query("agg_11_all_time_stats", "select count(*) as n, cast(min(day) as bigint) as first_day, cast(max(day) as bigint) as last_day, count(distinct day) as days, cast(sum(cost) as bigint) as cost from extractions", "extractions")
def all_time(v: Views) -> DataFrame:
    return v.extractions.agg(F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.countDistinct("day").alias("days"), F.sum("cost").alias("cost"))


@query("agg_12_overall_averages", "select round(avg(confidence), 4) as confidence, round(avg(len(entities)), 4) as entities, round(avg(len(statements)), 4) as statements, round(avg(tokens), 4) as tokens from extractions", "extractions")
def overall(v: Views) -> DataFrame:
    return v.extractions.agg(F.round(F.avg("confidence"), 4).alias("confidence"), F.round(F.avg(F.size("entities")), 4).alias("entities"), F.round(F.avg(F.size("statements")), 4).alias("statements"), F.round(F.avg("tokens"), 4).alias("tokens"))


@query("agg_14_by_day_last_30", "select day, count(*) as n, cast(sum(tokens) as bigint) as tokens from extractions group by 1 order by day desc limit 30", "extractions")
def by_day(v: Views) -> DataFrame:
    return v.extractions.groupBy("day").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).orderBy(F.desc("day")).limit(30)


@query("agg_15_by_hour", "select hour, count(*) as n from extractions where day >= (select max(day) from extractions) - 1 group by 1", "extractions")
def by_hour(v: Views) -> DataFrame:
    x = v.extractions.select("day", "hour")
    last = x.agg(F.max("day").alias("last"))
    return x.join(F.broadcast(last)).where("day >= last - 1").groupBy("hour").agg(F.count("*").alias("n"))


@query("agg_16_confidence_buckets", "select case when confidence >= 80 then 'high' when confidence >= 50 then 'medium' else 'low' end as bucket, count(*) as n, min(confidence) as lowest from extractions group by 1 order by lowest desc", "extractions")
def confidence_buckets(v: Views) -> DataFrame:
    bucket = F.when(F.col("confidence") >= 80, "high").when(F.col("confidence") >= 50, "medium").otherwise("low")
    return v.extractions.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("confidence").alias("lowest")).orderBy(F.desc("lowest"))


@query("agg_17_statement_types", "select coalesce(nullif(substr(s, 1, 1), ''), 'unknown') as kind, count(*) as n from (select unnest(statements) as s from extractions) t group by 1", "extractions")
def statement_types(v: Views) -> DataFrame:
    return v.extractions.select(F.explode("statements").alias("s")).groupBy(F.coalesce(F.nullif(F.substring("s", 1, 1), F.lit("")), F.lit("unknown")).alias("kind")).agg(F.count("*").alias("n"))


@query("agg_18_cost_ratios", "select extraction_type, min(cost) as least, max(cost) as most, round(avg(cost), 4) as mean, cast(sum(cost) as bigint) as total, round(sum(cost) / nullif(sum(tokens), 0), 6) as per_token from extractions group by 1", "extractions")
def cost_ratios(v: Views) -> DataFrame:
    return v.extractions.groupBy("extraction_type").agg(F.min("cost").alias("least"), F.max("cost").alias("most"), F.round(F.avg("cost"), 4).alias("mean"), F.sum("cost").alias("total"), F.round(F.try_divide(F.sum("cost"), F.sum("tokens")), 6).alias("per_token"))


@query("agg_19_projected_monthly_cost", "select round(count(*) / greatest(max(day) - min(day), 1) * avg(cost) * 30, 2) as projected from extractions", "extractions")
def projected(v: Views) -> DataFrame:
    days = F.greatest(F.max("day") - F.min("day"), F.lit(1))
    return v.extractions.agg(F.round(F.count("*") / days * F.avg("cost") * 30, 2).alias("projected"))


@query("agg_20_coverage", "select count(*) as n, round(100.0 * count(*) filter (length(text) > 500) / count(*), 2) as long_pct, round(100.0 * count(*) filter (rid like 'orn:%:%') / count(*), 2) as rid_pct, round(100.0 * count(*) filter (superseded) / count(*), 2) as superseded_pct from memories", "memories")
def coverage(v: Views) -> DataFrame:
    n = F.count("*")
    return v.memories.agg(n.alias("n"), pct(F.count_if(F.length("text") > 500), n).alias("long_pct"), pct(F.count_if(F.col("rid").like("orn:%:%")), n).alias("rid_pct"), pct(F.count_if("superseded"), n).alias("superseded_pct"))


@query("agg_21_offenders", "select source_sensor, doc_id, count(*) over (partition by source_sensor) as n from memories where superseded", "memories")
def offenders(v: Views) -> DataFrame:
    """Every superseded memory with the count of its sensor; the list stays rows, however many a sensor has."""
    bad = v.memories.where("superseded").select("source_sensor", "doc_id")
    return bad.join(bad.groupBy("source_sensor").agg(F.count("*").alias("n")), "source_sensor")


@query("agg_22_cross_sensor_efficiency", "select case when source_sensor like '%website%' then 'website' when source_sensor like '%discourse%' then 'discourse' when source_sensor like '%github%' then 'github' when source_sensor like '%gitlab%' then 'gitlab' when source_sensor like '%notion%' then 'notion' when source_sensor like '%podcast%' then 'podcast' else 'unknown' end as sensor, count(*) as n, round(avg(len(entities)), 4) as avg_entities, round(sum(len(entities)) * 1000.0 / nullif(sum(cost), 0), 4) as entities_per_1000 from extractions group by 1", "extractions")
def cross_sensor(v: Views) -> DataFrame:
    e = F.size("entities")
    return v.extractions.groupBy(sensor_by_substring(F.col("source_sensor")).alias("sensor")).agg(F.count("*").alias("n"), F.round(F.avg(e), 4).alias("avg_entities"), F.round(F.try_divide(F.sum(e) * 1000.0, F.sum("cost")), 4).alias("entities_per_1000"))


@query("agg_23_model_averages", "select extractor_version as model, count(*) as docs, round(avg(len(entities)), 4) as entities, round(avg(cost), 4) as cost, round(avg(confidence), 4) as confidence from extractions group by 1", "extractions")
def models(v: Views) -> DataFrame:
    return v.extractions.groupBy(F.col("extractor_version").alias("model")).agg(F.count("*").alias("docs"), F.round(F.avg(F.size("entities")), 4).alias("entities"), F.round(F.avg("cost"), 4).alias("cost"), F.round(F.avg("confidence"), 4).alias("confidence"))


@query("agg_24_precision_recall_f1", """
with pairs as (select a.doc_id, len(list_intersect(a.entities, b.entities)) as hit, len(a.entities) as found, len(b.entities) as wanted from extractions a join extractions b on b.doc_id = a.doc_id + 1),
 scores as (select case when found > 0 then hit / found else 0 end as p, case when wanted > 0 then hit / wanted else 0 end as r from pairs)
select count(*) as docs, round(avg(p), 6) as precision_, round(avg(r), 6) as recall_, round(avg(case when p + r > 0 then 2 * p * r / (p + r) else 0 end), 6) as f1 from scores""", "extractions")
def precision_recall(v: Views) -> DataFrame:
    a = v.extractions.select("doc_id", F.col("entities").alias("found"))
    b = v.extractions.select((F.col("doc_id") - 1).alias("doc_id"), F.col("entities").alias("wanted"))
    hit = F.size(F.array_intersect("found", "wanted"))
    s = a.join(b, "doc_id").select(F.coalesce(F.try_divide(hit, F.size("found")), F.lit(0.0)).alias("p"), F.coalesce(F.try_divide(hit, F.size("wanted")), F.lit(0.0)).alias("r"))
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    return s.agg(F.count("*").alias("docs"), F.round(F.avg("p"), 6).alias("precision_"), F.round(F.avg("r"), 6).alias("recall_"), F.round(F.avg(f1), 6).alias("f1"))


@query("agg_47_mean_confidence_and_price", "select extractor_version, round(avg(confidence), 4) as confidence, round(sum(tokens * case extractor_version when 'v0' then 3 when 'v1' then 10 else 1 end) / 1000000.0, 6) as price from extractions group by 1", "extractions")
def price_table(v: Views) -> DataFrame:
    prices = v.spark.createDataFrame([("v0", 3), ("v1", 10), ("v2", 1)], "extractor_version string, price_per_million long")
    return v.extractions.join(F.broadcast(prices), "extractor_version", "left").groupBy("extractor_version").agg(F.round(F.avg("confidence"), 4).alias("confidence"), F.round(F.sum(F.col("tokens") * F.coalesce("price_per_million", F.lit(1))) / 1000000.0, 6).alias("price"))


@query("agg_48_build_stats", "select lang, source_sensor, count(*) as docs, cast(sum(n_chars) as bigint) as chars from memories group by 1, 2", "memories")
def build_stats(v: Views) -> DataFrame:
    return v.memories.groupBy("lang", "source_sensor").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


# --- joins ---


@query("join_01_extraction_memory", "select x.extraction_rid, m.source_sensor, m.n_chars from extractions x join memories m on x.memory_rid = m.rid", "extractions", "memories")
def join_inner(v: Views) -> DataFrame:
    return v.extractions.select("extraction_rid", "memory_rid").join(v.memories.select("rid", "source_sensor", "n_chars"), F.col("memory_rid") == F.col("rid")).select("extraction_rid", "source_sensor", "n_chars")


@query("join_02_receipt_coverage", "select count(*) as steps, count(p.output_rid) as with_input from receipts r left join receipts p on r.input_rid = p.output_rid", "receipts")
def join_left(v: Views) -> DataFrame:
    p = v.receipts.select(F.col("output_rid").alias("input_rid"), F.lit(1).alias("there"))
    return v.receipts.join(p, "input_rid", "left").agg(F.count("*").alias("steps"), F.count("there").alias("with_input"))


@query("join_03_three_way", "select m.source_sensor, count(*) as memories, count(x.doc_id) as extracted, count(l.doc_id) as labelled from memories m left join extractions x on x.memory_rid = m.rid left join labels l on l.doc_id = m.doc_id group by 1", "memories", "extractions")
def join_three(v: Views) -> DataFrame:
    x = v.extractions.select(F.col("memory_rid").alias("rid"), F.lit(1).alias("x"))
    lab = v.table("labels").select("doc_id", F.lit(1).alias("l"))
    return v.memories.select("rid", "doc_id", "source_sensor").join(x, "rid", "left").join(lab, "doc_id", "left").groupBy("source_sensor").agg(F.count("*").alias("memories"), F.count("x").alias("extracted"), F.count("l").alias("labelled"))


@query("join_04_unextracted", "select m.rid, m.n_chars from memories m left join extractions x on x.memory_rid = m.rid where x.memory_rid is null and not m.superseded", "memories", "extractions")
def join_anti(v: Views) -> DataFrame:
    return v.memories.where("not superseded").join(v.extractions.select(F.col("memory_rid").alias("rid")), "rid", "left_anti").select("rid", "n_chars")


@query("join_05_orphans", "select l.doc_id from labels l where not exists (select 1 from memories m where m.doc_id = l.doc_id and m.is_chunk)", "memories")
def join_not_exists(v: Views) -> DataFrame:
    return v.table("labels").select("doc_id").join(v.memories.where("is_chunk").select("doc_id"), "doc_id", "left_anti")


@query("join_06_missing_either", "select d.doc_id from documents d where not exists (select 1 from embeddings e where e.vec_id = d.doc_id) or not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def join_missing_either(v: Views) -> DataFrame:
    e = v.table("embeddings").select(F.col("vec_id").alias("doc_id")).distinct().withColumn("e", F.lit(1))
    lab = v.table("labels").select("doc_id").distinct().withColumn("l", F.lit(1))
    return v.table("documents").select("doc_id").join(e, "doc_id", "left").join(lab, "doc_id", "left").where("e is null or l is null").select("doc_id")


@query("join_07_unnest_entities", "select extraction_rid, e as entity from extractions, unnest(entities) as t(e) where confidence >= 70", "extractions")
def join_unnest(v: Views) -> DataFrame:
    return v.extractions.where("confidence >= 70").select("extraction_rid", F.explode("entities").alias("entity"))


@query("join_08_prefix", "select x.doc_id, s.statement from extractions x, (select memory_rid || ':kg:extraction:v1:statement:' || i as statement from extractions, generate_series(1, 2) g(i)) s where s.statement like x.extraction_rid || ':%'", "extractions")
def join_prefix(v: Views) -> DataFrame:
    """Statements to extractions: the prefix is cut out of the statement id, so the join has an equality key."""
    s = v.extractions.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("i"), "memory_rid").select(F.concat("memory_rid", F.lit(":kg:extraction:v1:statement:"), "i").alias("statement"))
    s = s.withColumn("extraction_rid", F.regexp_extract("statement", "^(.*):statement:", 1))
    return v.extractions.select("doc_id", "extraction_rid").join(s, "extraction_rid").select("doc_id", "statement")


@query("join_11_dictionary_lookup", "select d.doc_id, coalesce(n1.n_name, n2.n_name) as uri from documents d left join nation n1 on n1.n_name = upper(d.source) left join nation n2 on n2.n_nationkey = d.doc_id % 40")
def join_dictionary(v: Views) -> DataFrame:
    names = v.table("nation")
    exact = (names.select(F.col("n_name").alias("exact"), F.col("n_name").alias("by_name")))
    number = (names.select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("by_key")))
    d = v.table("documents").select("doc_id", F.upper("source").alias("exact"), (F.col("doc_id") % 40).alias("nk"))
    return d.join(exact, "exact", "left").join(number, "nk", "left").select("doc_id", F.coalesce("by_name", "by_key").alias("uri"))


@query("join_12_approved_peers", "select distinct l.user_id, n.n_nationkey as peer from log l join nation n on n.n_nationkey = l.user_id % 40 where substr(l.hash, 1, 4) = substr(sha256('{\"k\": ' || n.n_nationkey || '}'), 1, 4)", "log")
def join_peers(v: Views) -> DataFrame:
    """Peers by an aliased hash: the short prefix is the join key, the residual predicate the rest."""
    peers = v.table("nation").select((F.col("n_nationkey")).cast("long").alias("peer"), F.substring(F.sha2(F.concat(F.lit('{"k": '), "n_nationkey", F.lit("}")), 256), 1, 4).alias("prefix"))
    log = v.log.select("user_id", F.substring("hash", 1, 4).alias("prefix"))
    return log.join(peers, "prefix").where("peer = user_id % 40").select("user_id", F.col("peer").cast("int").alias("peer")).distinct()


@query("join_13_new_or_changed", "select d.doc_id, case when l.doc_id is null then 'new' else 'changed' end as status from documents d left join labels l using (doc_id) where l.doc_id is null or d.n_chars > 2000")
def join_changed(v: Views) -> DataFrame:
    lab = v.table("labels").select("doc_id", F.lit(1).alias("l"))
    return v.table("documents").select("doc_id", "n_chars").join(lab, "doc_id", "left").where("l is null or n_chars > 2000").select("doc_id", F.when(F.col("l").isNull(), "new").otherwise("changed").alias("status"))


@query("join_14_state_gap", "select distinct conv_id from conversations c where not exists (select 1 from documents d where d.doc_id = c.conv_id * 10)")
def join_gap(v: Views) -> DataFrame:
    d = v.table("documents").select(F.col("doc_id").alias("k"))
    return v.table("conversations").select("conv_id").distinct().join(d, F.col("conv_id") * 10 == F.col("k"), "left_anti")


@query("join_15_known_ends", "select c_custkey, c_nationkey from customer where c_nationkey in (select s_nationkey from supplier) and c_custkey in (select o_custkey from orders)")
def join_known_ends(v: Views) -> DataFrame:
    c = v.table("customer").select("c_custkey", "c_nationkey")
    return c.join(v.table("supplier").select(F.col("s_nationkey").alias("c_nationkey")), "c_nationkey", "left_semi").join(v.table("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_nationkey")


@query("join_16_batch_class_supply", "select p_brand as class_id, n_name as origin, count(*) as lines, cast(sum(cast(round(l_quantity) as bigint)) as bigint) as supply from lineitem join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey group by 1, 2")
def join_batches(v: Views) -> DataFrame:
    part = v.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("class_id"))
    sup = v.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nat = v.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin"))
    return v.table("lineitem").select("l_partkey", "l_suppkey", "l_quantity").join(part, "l_partkey").join(sup, "l_suppkey").join(nat, "s_nationkey").groupBy("class_id", "origin").agg(F.count("*").alias("lines"), F.sum(F.round("l_quantity").cast("long")).alias("supply"))
