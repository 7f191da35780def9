"""Ledger, job, alert and draft reports; top-k and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import pct
from ..operators.ordered import rank
from .registry import query
from .views import Views


@query("agg_28_governance", "select count(*) as proposals, count(*) filter (state = 'completed') as passed, count(*) filter (state = 'failed') as rejected, round(100.0 * count(*) filter (state = 'completed') / nullif(count(*) filter (state in ('completed', 'failed')), 0), 2) as pass_rate from jobs", "jobs")
def governance(v: Views) -> DataFrame:
    passed, rejected = F.count_if(F.col("state") == "completed"), F.count_if(F.col("state") == "failed")
    return v.jobs.agg(F.count("*").alias("proposals"), passed.alias("passed"), rejected.alias("rejected"), pct(passed, passed + rejected).alias("pass_rate"))


@query("agg_29_ecocredits", "select coalesce(class_id, 'all') as class_id, cast(sum(amount) as bigint) as issued, cast(coalesce(sum(amount) filter (flag = 'N'), 0) as bigint) as tradable, cast(coalesce(sum(amount) filter (flag = 'R'), 0) as bigint) as retired, cast(coalesce(sum(amount) filter (flag = 'A'), 0) as bigint) as cancelled, round(100.0 * coalesce(sum(amount) filter (flag = 'R'), 0) / sum(amount), 2) as retirement_rate from batches group by grouping sets ((class_id), ())", "batches")
def ecocredits(v: Views) -> DataFrame:
    part = lambda f: F.coalesce(F.sum(F.when(F.col("flag") == f, F.col("amount"))), F.lit(0))
    out = v.batches.rollup("class_id").agg(F.sum("amount").alias("issued"), part("N").alias("tradable"), part("R").alias("retired"), part("A").alias("cancelled"))
    return out.withColumn("class_id", F.coalesce("class_id", F.lit("all"))).withColumn("retirement_rate", pct(F.col("retired"), F.col("issued")))


@query("agg_30_consensus", "select cast(sum(power) as bigint) as total_power, count(*) filter (power > 0) as active, count(*) as validators, round(100.0 * sum(power) filter (power > 0) / nullif(sum(abs(power)), 0), 2) as bonding_ratio from validators", "validators")
def consensus(v: Views) -> DataFrame:
    p = F.col("power")
    return v.validators.agg(F.sum(p).alias("total_power"), F.count_if(p > 0).alias("active"), F.count("*").alias("validators"), pct(F.sum(F.when(p > 0, p)), F.sum(F.abs(p))).alias("bonding_ratio"))


@query("agg_31_block_time", "select round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 / (max(event_id) - min(event_id)), 4) as seconds from (select ts, event_id from events where event_id > (select max(event_id) - 1000 from events)) t")
def block_time(v: Views) -> DataFrame:
    e = v.table("events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    top = e.agg(F.max("event_id").alias("top"))
    return e.join(F.broadcast(top)).where("event_id > top - 1000").agg(F.round((F.max("us") - F.min("us")) / 1000000.0 / (F.max("event_id") - F.min("event_id")), 4).alias("seconds"))


@query("agg_32_weighted_price", "select class_id, round(sum(amount * price) / nullif(sum(amount), 0), 2) as price from batches where flag = 'N' group by 1", "batches")
def weighted(v: Views) -> DataFrame:
    return v.batches.where("flag = 'N'").groupBy("class_id").agg(F.round(F.try_divide(F.sum(F.col("amount") * F.col("price")), F.sum("amount")), 2).alias("price"))


@query("agg_33_power_concentration", "select round(100.0 * sum(power) filter (n <= 10) / sum(power), 2) as top_10_pct from (select power, row_number() over (order by power desc, address) as n from validators where power > 0) t", "validators")
def concentration(v: Views) -> DataFrame:
    """The share of the ten strongest: a top-k and a total, so that no single partition sorts all rows."""
    p = v.validators.where("power > 0").select("address", "power")
    top = p.orderBy(F.desc("power"), "address").limit(10).agg(F.sum("power").alias("top"))
    return top.join(p.agg(F.sum("power").alias("total"))).select(pct(F.col("top"), F.col("total")).alias("top_10_pct"))


@query("agg_34_health_score", "select worker, greatest(0, 100 - 30 * least(failed, 2) - 10 * least(retrying, 3)) as score, case when greatest(0, 100 - 30 * least(failed, 2) - 10 * least(retrying, 3)) >= 80 then 'healthy' when greatest(0, 100 - 30 * least(failed, 2) - 10 * least(retrying, 3)) >= 50 then 'degraded' else 'unhealthy' end as band from (select worker, count(*) filter (state = 'failed') as failed, count(*) filter (state = 'retrying') as retrying from jobs group by 1) t", "jobs")
def health(v: Views) -> DataFrame:
    g = v.jobs.groupBy("worker").agg(F.count_if(F.col("state") == "failed").alias("failed"), F.count_if(F.col("state") == "retrying").alias("retrying"))
    score = F.greatest(F.lit(0), 100 - 30 * F.least("failed", F.lit(2)) - 10 * F.least("retrying", F.lit(3)))
    return g.select("worker", score.alias("score"), F.when(score >= 80, "healthy").when(score >= 50, "degraded").otherwise("unhealthy").alias("band"))


@query("agg_35_job_counts", "select state, count(*) as n, round(avg(seconds), 4) as avg_seconds, count(*) filter (scheduled_for >= '2000-01-01') as recent from jobs group by 1", "jobs")
def job_counts(v: Views) -> DataFrame:
    return v.jobs.groupBy("state").agg(F.count("*").alias("n"), F.round(F.avg("seconds"), 4).alias("avg_seconds"), F.count_if(F.col("scheduled_for") >= "2000-01-01").alias("recent"))


@query("agg_36_alerts_by_level", "select level, count(id) as n, count(id) filter (state = 'running') as active from (values (1), (2), (3), (4), (5), (6), (7)) l(level) left join jobs on priority = level group by 1", "jobs")
def alerts(v: Views) -> DataFrame:
    levels = v.spark.range(1, 8).select(F.col("id").cast("int").alias("level"))
    by = v.jobs.groupBy(F.col("priority").alias("level")).agg(F.count("*").alias("n"), F.count_if(F.col("state") == "running").alias("active"))
    return levels.join(by, "level", "left").na.fill(0, ["n", "active"])


@query("agg_37_health_rollup", "select case when recent > 2 then 'DEGRADED' when bad > 0 then 'UNHEALTHY' else 'HEALTHY' end as status, n from (select count(*) filter (state = 'failed' and scheduled_for >= '2001-06-01') as recent, count(*) filter (state = 'failed') as bad, count(*) as n from jobs) t", "jobs")
def rollup(v: Views) -> DataFrame:
    """Many recent failures set DEGRADED even where the state is worse; the rule is kept as it is."""
    bad = F.col("state") == "failed"
    g = v.jobs.agg(F.count_if(bad & (F.col("scheduled_for") >= "2001-06-01")).alias("recent"), F.count_if(bad).alias("bad"), F.count("*").alias("n"))
    return g.select(F.when(F.col("recent") > 2, "DEGRADED").when(F.col("bad") > 0, "UNHEALTHY").otherwise("HEALTHY").alias("status"), "n")


@query("agg_40_post_analysis", "select strftime(ts, '%m-%d') as day, count(*) as posts, cast(sum(size_bytes) as bigint) as engagement, round(avg(size_bytes), 4) as avg_engagement from log where kind in ('view', 'click') group by 1", "log")
def posts(v: Views) -> DataFrame:
    return v.log.where("kind in ('view', 'click')").groupBy(F.date_format("ts", "MM-dd").alias("day")).agg(F.count("*").alias("posts"), F.sum("size_bytes").alias("engagement"), F.round(F.avg("size_bytes"), 4).alias("avg_engagement"))


@query("agg_41_tool_usage", "select conv_id, role as tool, split_part('mcp__' || role || '__run', '__', 2) as server, count(*) as n from turns group by 1, 2", "turns")
def tools(v: Views) -> DataFrame:
    name = F.concat(F.lit("mcp__"), F.col("role"), F.lit("__run"))
    return v.turns.groupBy("conv_id", F.col("role").alias("tool"), F.split_part(name, F.lit("__"), F.lit(2)).alias("server")).agg(F.count("*").alias("n"))


@query("agg_42_scrape_cutoff", "select class_id, min(issued) as cutoff from batches where try_cast(issued as date) is not null group by 1", "batches")
def cutoff(v: Views) -> DataFrame:
    return v.batches.where(F.try_to_date("issued").isNotNull()).groupBy("class_id").agg(F.min("issued").alias("cutoff"))


@query("agg_43_style_score", "select conv_id, round(avg(score), 4) as score, avg(score) >= 0.8 as compliant from (select conv_id, greatest(0.0, 1.0 - 0.1 * (length(text) - length(replace(text, ',', ''))) / 5) as score from turns where text is not null) t group by 1", "turns")
def style(v: Views) -> DataFrame:
    """Each step is the double that the SQL's decimals become: commas in tenths, a fifth of them, and the mean in ten-thousandths before it is rounded."""
    commas = F.length("text") - F.length(F.replace("text", F.lit(","), F.lit("")))
    s = v.turns.where("text is not null").select("conv_id", F.greatest(F.lit(0.0), F.lit(1.0) - commas / F.lit(10.0) / F.lit(5.0)).alias("s"))
    return s.groupBy("conv_id").agg((F.round(F.avg("s") * 10_000) / 10_000).alias("score"), (F.avg("s") >= 0.8).alias("compliant"))


@query("agg_44_link_validation", "select count(*) as links, count(distinct url) as distinct_links, count(distinct url) filter (url like 'https:%') as valid from pages")
def links(v: Views) -> DataFrame:
    return v.table("pages").agg(F.count("*").alias("links"), F.countDistinct("url").alias("distinct_links"), F.countDistinct(F.when(F.startswith("url", F.lit("https:")), F.col("url"))).alias("valid"))


# --- top-k and sets ---


@query("top_01_latest_passed", "select id, state from jobs where state = 'completed' order by id desc limit 25", "jobs")
def latest_passed(v: Views) -> DataFrame:
    return v.jobs.where("state = 'completed'").select("id", "state").orderBy(F.desc("id")).limit(25)


@query("top_02_recent_issuances", "select batch, line, issued from batches order by issued desc, batch, line limit 20", "batches")
def issuances(v: Views) -> DataFrame:
    return v.batches.select("batch", "line", "issued").orderBy(F.desc("issued"), "batch", "line").limit(20)


@query("top_03_activity_feed", "select * from (select 'job' as kind, scheduled_for as happened, id from jobs union all select 'batch', issued, batch from batches where line = 1 union all select 'event', strftime(ts, '%Y-%m-%d'), seq from log) t order by happened desc, kind, id limit 20", "jobs", "batches", "log")
def feed(v: Views) -> DataFrame:
    jobs = v.jobs.select(F.lit("job").alias("kind"), F.col("scheduled_for").alias("happened"), "id")
    lots = v.batches.where("line = 1").select(F.lit("batch").alias("kind"), F.col("issued").alias("happened"), F.col("batch").alias("id"))
    log = v.log.select(F.lit("event").alias("kind"), F.date_format("ts", "yyyy-MM-dd").alias("happened"), F.col("seq").alias("id"))
    return jobs.unionByName(lots).unionByName(log).orderBy(F.desc("happened"), "kind", "id").limit(20)


@query("top_04_next_job", "select id from jobs where state in ('queued', 'retrying') and scheduled_for <= '2000-01-01' order by priority desc, scheduled_for, id limit 1", "jobs")
def next_job(v: Views) -> DataFrame:
    return v.jobs.where("state in ('queued', 'retrying') and scheduled_for <= '2000-01-01'").orderBy(F.desc("priority"), "scheduled_for", "id").select("id").limit(1)


@query("top_05_drafts_by_status", "select id, state, scheduled_for from jobs where state = 'running' order by scheduled_for desc, id limit 50", "jobs")
def drafts(v: Views) -> DataFrame:
    return v.jobs.where("state = 'running'").select("id", "state", "scheduled_for").orderBy(F.desc("scheduled_for"), "id").limit(50)


@query("top_06_last_n_retention", "select kind, seq from (select kind, seq, row_number() over (partition by kind order by seq desc) as n from log) t where n <= 100", "log")
def retention(v: Views) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("seq")))
    return v.log.select("kind", "seq").withColumn("n", n).where("n <= 100").select("kind", "seq")


@query("top_07_unresolved", "select doc_id, n_chars from documents join labels using (doc_id) where toxic = 1 order by n_chars desc, doc_id desc")
def unresolved(v: Views) -> DataFrame:
    bad = v.table("labels").where("toxic = 1").select("doc_id")
    return v.table("documents").select("doc_id", "n_chars").join(bad, "doc_id").orderBy(F.desc("n_chars"), F.desc("doc_id"))


@query("top_08_nearest_vectors", "select q.vec_id as query_id, e.vec_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) as similarity from embeddings q, embeddings e where q.vec_id % 100 = 0 and e.vec_id <> q.vec_id qualify row_number() over (partition by q.vec_id order by list_cosine_similarity(q.embedding::double[], e.embedding::double[]) desc, e.vec_id) <= 10")
def nearest(v: Views) -> DataFrame:
    """Every row whose id is divisible by 100, against all rows."""
    from ..operators.vectors import nearest as search

    e = v.table("embeddings").select("vec_id", "embedding")
    return search(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 10).select("query_id", "vec_id", F.round("s", 6).alias("similarity"))


@query("top_09_oldest_bundles", "select batch, line, coalesce(issued, '1970-01-01') as happened from batches order by happened, batch, line limit 100", "batches")
def oldest(v: Views) -> DataFrame:
    return v.batches.select("batch", "line", F.coalesce("issued", F.lit("1970-01-01")).alias("happened")).orderBy("happened", "batch", "line").limit(100)


@query("top_10_round_robin", "select page_id from pages where page_id >= 100 union all select page_id from pages where page_id < 100 and page_id % 2 = 0 limit 500")
def round_robin(v: Views) -> DataFrame:
    """The next pages of a rotating queue: those after the mark first, then those before it."""
    p = v.table("pages").select("page_id").where("page_id >= 100 or page_id % 2 = 0")
    return p.orderBy(F.when(F.col("page_id") >= 100, 0).otherwise(1), "page_id").limit(500)


@query("win_06_validator_rank", "select address, row_number() over (order by power desc, address) as rank from validators", "validators")
def validator_rank(v: Views) -> DataFrame:
    return rank(v.validators.select("address", "power"), "rank", F.desc("power"), "address").select("address", "rank")


@query("set_01_union_all_limited", "(select 'a' as branch, doc_id from documents where n_chars > 1000 order by n_chars desc, doc_id limit 5) union all (select 'b', conv_id from conversations where turn = 0 order by length(text) desc, conv_id limit 5)")
def union_limited(v: Views) -> DataFrame:
    a = v.table("documents").where("n_chars > 1000").orderBy(F.desc("n_chars"), "doc_id").limit(5).select(F.lit("a").alias("branch"), "doc_id")
    b = v.table("conversations").where("turn = 0").orderBy(F.desc(F.length("text")), "conv_id").limit(5).select(F.lit("b").alias("branch"), F.col("conv_id").alias("doc_id"))
    return a.unionByName(b)


@query("set_02_union_distinct", "select n_nationkey % 5 as k from nation union select r_regionkey from region")
def union_distinct(v: Views) -> DataFrame:
    return v.table("nation").select((F.col("n_nationkey") % 5).alias("k")).union(v.table("region").select("r_regionkey")).distinct()


@query("grf_03_relationship_validity", "select n_nationkey, n_regionkey in (0, 2, 4) as allowed from nation where n_regionkey in (select r_regionkey from region)")
def validity(v: Views) -> DataFrame:
    allowed = v.table("region").select("r_regionkey").withColumn("allowed", F.col("r_regionkey").isin(0, 2, 4))
    return v.table("nation").join(allowed, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "allowed")


@query("grf_04_entity_validation", "select doc_id, array_to_string(e, ',') as errors, len(e) = 0 as valid from (select doc_id, list_filter([case when n_chars < 100 then 'short' end, case when lang is null then 'language' end, case when source like 'src1%' then 'source' end], lambda x: x is not null) as e from documents) t")
def validation(v: Views) -> DataFrame:
    errors = F.array_compact(F.array(F.when(F.col("n_chars") < 100, "short"), F.when(F.col("lang").isNull(), "language"), F.when(F.startswith("source", F.lit("src1")), "source")))
    return v.table("documents").select("doc_id", F.array_join(errors, ",").alias("errors"), (F.size(errors) == 0).alias("valid"))


@query("grf_05_constraints", "select 'min_length' as rule, count(*) as violations from documents where n_chars < 50 union all select 'pattern', count(*) from customer where not regexp_matches(c_name, '^Customer#[0-9]{9}$') union all select 'range', count(*) from lineitem where l_discount > 0.09 or l_discount < 0")
def constraints(v: Views) -> DataFrame:
    a = v.table("documents").where("n_chars < 50").agg(F.lit("min_length").alias("rule"), F.count("*").alias("violations"))
    b = v.table("customer").where(~F.col("c_name").rlike("^Customer#[0-9]{9}$")).agg(F.lit("pattern").alias("rule"), F.count("*").alias("violations"))
    c = v.table("lineitem").where("l_discount > 0.09D or l_discount < 0").agg(F.lit("range").alias("rule"), F.count("*").alias("violations"))
    return a.unionByName(b).unionByName(c)
