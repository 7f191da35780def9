"""Event-log queries: identity, dedup, fold to current state, delivery, health, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import namespace, rid_context, sensor_base_name, sensor_by_prefix, sensor_by_substring
from ..operators import events as ev
from .registry import query
from .views import Views

_AS_OF = "2024-01-31"


@query("win_01_consecutive_duplicates", "select seq, coalesce(lag(hash) over (partition by rid order by seq) = hash, false) as duplicate from log", "log")
def consecutive(v: Views) -> DataFrame:
    return ev.mark_consecutive_duplicates(v.log, F.col("rid"), F.col("hash")).select("seq", "duplicate")


@query("win_02_new_or_update", "select seq, case when p is null then 'NEW' else 'UPDATE' end as change from (select *, lag(hash) over (partition by rid order by seq) as p from log) t where p is null or p <> hash", "log")
def changes(v: Views) -> DataFrame:
    return ev.label_changes(v.log, "rid", "hash").select("seq", "change")


@query("win_03_latest_bundle", "select rid, hash, seq from (select *, row_number() over (partition by rid order by seq desc) as n from log) t where n = 1", "log")
def latest(v: Views) -> DataFrame:
    return ev.latest_per_key(v.log, "rid", "seq", "hash")


@query("win_04_distinct_on", "select distinct on (user_id) user_id, seq, hash from log order by user_id, hash, seq", "log")
def distinct_on(v: Views) -> DataFrame:
    return v.log.groupBy("user_id").agg(F.min(F.struct("hash", "seq")).alias("m")).select("user_id", "m.seq", "m.hash")


@query("win_05_top_n_per_sensor", "select source_sensor, doc_id from (select *, row_number() over (partition by source_sensor order by n_chars desc, doc_id) as n from memories where not superseded) t where n <= case when source_sensor like 'website%' then 5 else 3 end", "memories")
def top_n(v: Views) -> DataFrame:
    m = v.memories.where("not superseded").select("source_sensor", "doc_id", "n_chars")
    n = F.row_number().over(Window.partitionBy("source_sensor").orderBy(F.desc("n_chars"), "doc_id"))
    most = m.withColumn("n", n).where("n <= 5")  # a constant bound, so that tasks keep five rows a sensor before the shuffle
    return most.where(F.col("n") <= F.when(F.startswith("source_sensor", F.lit("website")), 5).otherwise(3)).select("source_sensor", "doc_id")


@query("win_07_prune_by_size", """
with t as (select doc_id, n_chars, doc_id % 11 = 0 as protected from documents),
 u as (select *, sum(n_chars) over () as total, coalesce(sum(case when protected then 0 else n_chars end) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as freed from t)
select doc_id from u where not protected and total - freed > 1000000""")
def prune_size(v: Views) -> DataFrame:
    d = v.table("documents").select("doc_id", "n_chars")
    out = ev.prune(d, F.lit(0), F.lit(0), 1_000_000, "doc_id", "n_chars", "doc_id", F.col("doc_id") % 11 == 0)
    return out.where("pruned_by = 'size'").select("doc_id")


@query("win_08_prune_by_age", "select count(*) filter (doc_id < 300 and doc_id % 11 <> 0) as pruned, count(*) filter (doc_id < 300 and doc_id % 11 = 0) as protected from documents")
def prune_age(v: Views) -> DataFrame:
    old, protected = F.col("doc_id") < 300, F.col("doc_id") % 11 == 0
    return v.table("documents").agg(F.count_if(old & ~protected).alias("pruned"), F.count_if(old & protected).alias("protected"))


@query("win_09_prune_combined", """
with t as (select doc_id, n_chars, doc_id % 11 = 0 as protected from documents),
 a as (select *, case when not protected and doc_id < 100 then 'age' end as by_age from t),
 u as (select *, sum(case when by_age is null then n_chars else 0 end) over () as total, coalesce(sum(case when protected or by_age is not null then 0 else n_chars end) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as freed from a)
select doc_id, coalesce(by_age, 'size') as pruned_by from u where by_age is not null or (not protected and total - freed > 1000000)""")
def prune_both(v: Views) -> DataFrame:
    d = v.table("documents").select("doc_id", "n_chars")
    out = ev.prune(d, F.lit(1000), F.lit(900), 1_000_000, "doc_id", "n_chars", "doc_id", F.col("doc_id") % 11 == 0)
    return out.where("pruned_by is not null").select("doc_id", "pruned_by")


@query("win_10_turn_pairs", """
with t as (select *, lead(role) over w as next_role, lead(text) over w as next_text from turns window w as (partition by conv_id order by turn))
select conv_id, turn, row_number() over (partition by conv_id order by turn) - 1 as idx, length(text) as asked, length(next_text) as answered from t where role = 'user' and next_role = 'assistant'""", "turns")
def turn_pairs(v: Views) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = v.turns.withColumn("next_role", F.lead("role").over(w)).withColumn("next_len", F.lead(F.length("text")).over(w)).where("role = 'user' and next_role = 'assistant'")
    return t.select("conv_id", "turn", (F.row_number().over(w) - 1).cast("long").alias("idx"), F.length("text").cast("long").alias("asked"), F.col("next_len").cast("long").alias("answered"))


@query("win_11_first_assistant", "select conv_id, arg_min(length(text), turn) as first_length from turns where role = 'assistant' and text is not null group by 1", "turns")
def first_assistant(v: Views) -> DataFrame:
    return v.turns.where("role = 'assistant' and text is not null").groupBy("conv_id").agg(F.min_by(F.length("text").cast("long"), "turn").alias("first_length"))


@query("win_12_thread_positions", "select conv_id, turn, (row_number() over (partition by conv_id order by turn)) || '/' || count(*) over (partition by conv_id) as position from turns", "turns")
def positions(v: Views) -> DataFrame:
    all_ = Window.partitionBy("conv_id")
    return v.turns.select("conv_id", "turn", F.concat(F.row_number().over(all_.orderBy("turn")), F.lit("/"), F.count("*").over(all_)).alias("position"))


@query("win_14_canonical_entity", "select p_brand as brand, arg_max(p_partkey, {'a': p_size, 'b': -p_partkey}) as canonical from part group by 1")
def canonical(v: Views) -> DataFrame:
    return v.table("part").groupBy(F.col("p_brand").alias("brand")).agg(F.max_by("p_partkey", F.struct(F.col("p_size"), -F.col("p_partkey"))).alias("canonical"))


@query("win_15_high_water_mark", "select user_id, max(seq) as mark from (select *, count(*) filter (event_type = 'FORGET') over (partition by user_id order by seq) as failures from log) t where failures = 0 group by 1", "log")
def high_water(v: Views) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return v.log.withColumn("failures", F.count(F.when(F.col("event_type") == "FORGET", 1)).over(w)).where("failures = 0").groupBy("user_id").agg(F.max("seq").alias("mark"))


@query("flt_04_prefix_class", "select doc_id, case when source_sensor like 'website%' then 'website' when source_sensor like 'discourse%' then 'discourse' when source_sensor like 'github-activity%' then 'github-activity' when source_sensor like 'github%' then 'github' when source_sensor like 'gitlab%' then 'gitlab' when source_sensor like 'notion%' then 'notion' when source_sensor like 'podcast%' then 'podcast' else 'other' end as sensor from memories", "memories")
def prefix_class(v: Views) -> DataFrame:
    return v.memories.select("doc_id", sensor_by_prefix(F.col("source_sensor")).alias("sensor"))


@query("flt_05_substring_class", "select doc_id, case when source_sensor like '%website%' then 'website' when source_sensor like '%discourse%' then 'discourse' when source_sensor like '%github%' then 'github' when source_sensor like '%gitlab%' then 'gitlab' when source_sensor like '%notion%' then 'notion' when source_sensor like '%podcast%' then 'podcast' else 'unknown' end as sensor from memories", "memories")
def substring_class(v: Views) -> DataFrame:
    return v.memories.select("doc_id", sensor_by_substring(F.col("source_sensor")).alias("sensor"))


@query("flt_06_node_type", "select seq, case when contains(source_node, 'click') then 'discourse' when contains(source_node, 'view') then 'notion' when contains(source_node, 'error') then 'github' else 'website' end as node_type from log", "log")
def node_type(v: Views) -> DataFrame:
    n = F.col("source_node")
    return v.log.select("seq", F.when(F.contains(n, F.lit("click")), "discourse").when(F.contains(n, F.lit("view")), "notion").when(F.contains(n, F.lit("error")), "github").otherwise("website").alias("node_type"))


@query("flt_07_sensor_base", "select distinct source_node, coalesce(nullif(regexp_extract(source_node, '^(.*?-sensor)', 1), ''), split_part(source_node, '-', 1)) as base from log", "log")
def base_name(v: Views) -> DataFrame:
    return v.log.select("source_node").distinct().select("source_node", sensor_base_name(F.col("source_node")).alias("base"))


@query("flt_08_rid_types", "select seq from log where rid like 'orn:user.state:1%' or rid like 'orn:user.state:2%'", "log")
def rid_types(v: Views) -> DataFrame:
    types = F.array(F.lit("orn:user.state:1"), F.lit("orn:user.state:2"))
    return v.log.where((F.size(types) == 0) | F.exists(types, lambda t: F.startswith(F.col("rid"), t))).select("seq")


@query("flt_09_handler_filter", "select seq from log where event_type in ('NEW', 'UPDATE') and rid like 'orn:user.state:%' and user_id < 50", "log")
def handler(v: Views) -> DataFrame:
    return v.log.where(F.col("event_type").isin("NEW", "UPDATE") & (namespace(F.col("rid")) == "user.state") & (F.col("user_id") < 50)).select("seq")


@query("flt_11_day_range", "select count(*) as n, count(distinct user_id) as users from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'")
def day_range(v: Views) -> DataFrame:
    return v.table("events").where("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-11'").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("flt_12_is_distinct_from", "select id from jobs where state is distinct from 'completed' and (priority = 1 or retry_count = 3)", "jobs")
def is_distinct(v: Views) -> DataFrame:
    return v.jobs.where(~F.col("state").eqNullSafe("completed") & ((F.col("priority") == 1) | (F.col("retry_count") == 3))).select("id")


@query("flt_13_protected", "select rid, regexp_matches(rid, '^orn:user\\.state:(1|2)$') as protected from (select distinct rid from log) t", "log")
def protected(v: Views) -> DataFrame:
    return v.log.select("rid").distinct().select("rid", F.col("rid").rlike(r"^orn:user\.state:(1|2)$").alias("protected"))


@query("mrg_01_memory_upsert", """
with c as (select * from (select *, lag(hash) over (partition by rid order by seq) as p from log) t where p is null or p <> hash)
select rid, arg_max(hash, seq) as hash, bool_or(kind = 'purchase') as is_private, arg_min(kind, seq) as access_source, count(*) as writes, case when count(*) > 1 then 'UPDATE' else 'NEW' end as event_type from c group by 1""", "log")
def memory_upsert(v: Views) -> DataFrame:
    return ev.merge_memories(v.log.withColumn("private", F.col("kind") == "purchase"), "rid", "seq", "hash", "private", "kind")


@query("mrg_03_extraction_upsert", "select rid, arg_max(hash, seq) as entities, arg_min(kind, seq) as extraction_type from log group by 1", "log")
def extraction_upsert(v: Views) -> DataFrame:
    return v.log.groupBy("rid").agg(F.max_by("hash", "seq").alias("entities"), F.min_by("kind", "seq").alias("extraction_type"))


@query("mrg_04_insert_if_absent", "select rid, hash, kind from (select distinct rid, hash, kind from log where seq >= 5000) n where not exists (select 1 from log o where o.seq < 5000 and o.rid = n.rid and o.hash = n.hash and o.kind = n.kind)", "log")
def insert_if_absent(v: Views) -> DataFrame:
    key = ["rid", "hash", "kind"]
    return v.log.where("seq >= 5000").select(*key).distinct().join(v.log.where("seq < 5000").select(*key), key, "left_anti")


@query("mrg_05_pair_upsert", "select least(user_id, user_id % 10) as a, greatest(user_id, user_id % 10) as b, arg_max(hash, seq) as details, count(*) as seen from log group by 1, 2", "log")
def pair_upsert(v: Views) -> DataFrame:
    a, b = F.least("user_id", F.col("user_id") % 10).alias("a"), F.greatest("user_id", F.col("user_id") % 10).alias("b")
    return v.log.groupBy(a, b).agg(F.max_by("hash", "seq").alias("details"), F.count("*").alias("seen"))


@query("mrg_06_latest_wins", "select user_id, kind, arg_max(hash, seq) as hash from log group by 1, 2", "log")
def latest_wins(v: Views) -> DataFrame:
    return v.log.groupBy("user_id", "kind").agg(F.max_by("hash", "seq").alias("hash"))


@query("mrg_09_fold_to_state", "select rid, hash, seq as last_seq, events from (select *, row_number() over (partition by rid order by seq desc) as n, count(*) over (partition by rid) as events from log) t where n = 1 and event_type <> 'FORGET'", "log")
def fold(v: Views) -> DataFrame:
    return ev.current_state(v.log)


@query("mrg_10_outbox", "select rid, hash from (select rid, hash, first_value(hash) over (partition by rid order by seq) as acked, row_number() over (partition by rid order by seq desc) as n from log) t where n = 1 and hash <> acked", "log")
def outbox(v: Views) -> DataFrame:
    return v.log.groupBy("rid").agg(F.max_by("hash", "seq").alias("hash"), F.min_by("hash", "seq").alias("acked")).where("hash <> acked").select("rid", "hash")


@query("stm_03_deliveries", """
with edges(node, kind) as (values ('n1', 'click'), ('n1', 'view'), ('n2', 'error'), ('n3', null)),
 w as (select node, seq, rid from log join edges on edges.kind = log.kind or edges.kind is null where not (node = 'n3' and seq % 2 = 0))
select node, seq, rid from (select *, row_number() over (partition by node order by seq) as n from w) t where n <= 100""", "log")
def deliver(v: Views) -> DataFrame:
    edges = v.spark.createDataFrame([("n1", "click"), ("n1", "view"), ("n2", "error"), ("n3", None)], "node string, kind string")
    delivered = v.log.where("seq % 2 = 0").select(F.lit("n3").alias("node"), "seq")
    return ev.deliveries(v.log, edges, 100, delivered)


@query("stm_04_confirm_and_drop", "select user_id from (select user_id, list_distinct(list(kind) filter (seq % 2 = 0)) as d, list_distinct(list(kind)) as c from log where seq % 3 <> 0 or user_id % 2 = 0 group by 1) t where len(d) > 0 and len(list_intersect(d, c)) = len(d)", "log")
def confirm(v: Views) -> DataFrame:
    kept = v.log.where("seq % 3 <> 0 or user_id % 2 = 0")
    queue = kept.groupBy("user_id").agg(F.collect_set(F.when(F.col("seq") % 2 == 0, F.col("kind"))).alias("delivered"), F.collect_set("kind").alias("confirmed"))
    return ev.confirmed(queue).select("user_id")


@query("stm_05_expiry", "select count(*) filter (ts < timestamp '2024-01-30 23:00:00') as expired, count(*) filter (ts >= timestamp '2024-01-30 23:00:00') as live from log", "log")
def expiry(v: Views) -> DataFrame:
    old = F.col("ts") < F.expr("timestamp_ntz'2024-01-31' - interval 3600 seconds")
    return v.log.agg(F.count_if(old).alias("expired"), F.count_if(~old).alias("live"))


@query("stm_07_heartbeats", "select user_id, count(*) as beats, max(seq) as last_seq from log where kind = 'view' group by 1", "log")
def heartbeats(v: Views) -> DataFrame:
    return v.log.where("kind = 'view'").groupBy("user_id").agg(F.count("*").alias("beats"), F.max("seq").alias("last_seq"))


@query("stm_08_normalise_bundles", "select event_id as seq, coalesce(json_extract_string(props, '$.k'), '') as k, event_type = 'view' as bundled from events")
def bundles(v: Views) -> DataFrame:
    return v.table("events").select(F.col("event_id").alias("seq"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("k"), (F.col("event_type") == "view").alias("bundled"))


@query("stm_09_poll", "select user_id, list_aggregate(list_sort(list(seq)), 'min') as first_seq, count(*) as n from (select user_id, seq, row_number() over (partition by user_id order by seq) as i from log where user_id in (select n_nationkey from nation)) t where i <= 20 group by 1", "log")
def poll(v: Views) -> DataFrame:
    approved = v.table("nation").select(F.col("n_nationkey").cast("long").alias("user_id"))
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("seq"))
    return v.log.join(approved, "user_id", "left_semi").withColumn("i", i).where("i <= 20").groupBy("user_id").agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"))


@query("stm_10_failure_windows", "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as hour, count(*) as failures, count(*) > 4 as alert from log where event_type = 'FORGET' group by 1", "log")
def failures(v: Views) -> DataFrame:
    return v.log.where("event_type = 'FORGET'").groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("hour")).agg(F.count("*").alias("failures")).withColumn("alert", F.col("failures") > 4)


@query("stm_11_debounce", """
with g as (select *, case when date_diff('second', lag(ts) over (partition by user_id order by ts, seq), ts) < 7200 then 0 else 1 end as new from (select user_id, seq, date_trunc('second', ts) as ts from log) x),
 s as (select user_id, ts, sum(new) over (partition by user_id order by ts, seq) as session from g)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as started, count(*) as n from s group by user_id, session""", "log")
def debounce(v: Views) -> DataFrame:
    """A row less than two hours after the one before is in its session; at two hours a new one begins (session windows would merge them)."""
    order = Window.partitionBy("user_id").orderBy(F.asc_nulls_last("ts"), "seq")
    t = v.log.select("user_id", "seq", F.date_trunc("second", "ts").cast("timestamp").alias("ts"))
    new = F.when(F.unix_seconds("ts") - F.unix_seconds(F.lag("ts").over(order)) < 7200, 0).otherwise(1)
    s = t.withColumn("new", new).withColumn("session", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return s.groupBy("user_id", "session").agg(F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("started"), F.count("*").alias("n")).drop("session")


@query("stm_12_job_lifecycle", "select id, case when state = 'failed' and retry_count < 3 then 'retrying' else state end as next_state, case when state = 'failed' and retry_count < 3 then 5 * (retry_count + 1) end as delay_minutes from jobs", "jobs")
def lifecycle(v: Views) -> DataFrame:
    again = (F.col("state") == "failed") & (F.col("retry_count") < 3)
    return v.jobs.select("id", F.when(again, "retrying").otherwise(F.col("state")).alias("next_state"), F.when(again, 5 * (F.col("retry_count") + 1)).alias("delay_minutes"))


@query("agg_38_delivery_stats", "select count(*) as events, count(*) filter (n > 1) as repeated, cast(sum(n) as bigint) as total from (select rid, hash, count(*) as n from log group by 1, 2) t", "log")
def delivery_stats(v: Views) -> DataFrame:
    return v.log.groupBy("rid", "hash").agg(F.count("*").alias("n")).agg(F.count("*").alias("events"), F.count_if(F.col("n") > 1).alias("repeated"), F.sum("n").alias("total"))


@query("agg_39_sensor_registry", "select source_node, count(*) as events, arg_max(event_type, seq) as last_event, max(seq) as last_seq from log group by 1", "log")
def registry_stats(v: Views) -> DataFrame:
    return v.log.groupBy("source_node").agg(F.count("*").alias("events"), F.max_by("event_type", "seq").alias("last_event"), F.max("seq").alias("last_seq"))


@query("agg_45_state_by_source", "select coalesce(a.kind, b.kind) as kind, coalesce(a.n, 0) as processed, coalesce(b.n, 0) as pending from (select kind, count(*) as n from log where seq < 5000 group by 1) a full join (select kind, count(*) as n from log where seq >= 5000 and kind <> 'view' group by 1) b on a.kind = b.kind", "log")
def state_by_source(v: Views) -> DataFrame:
    a = v.log.where("seq < 5000").groupBy("kind").agg(F.count("*").alias("processed"))
    b = v.log.where("seq >= 5000 and kind <> 'view'").groupBy("kind").agg(F.count("*").alias("pending"))
    return a.join(b, "kind", "full").select("kind", F.coalesce("processed", F.lit(0)).alias("processed"), F.coalesce("pending", F.lit(0)).alias("pending"))


@query("agg_46_cache_metrics", "select count(*) as items, cast(sum(n_chars) as bigint) as bytes, count(*) filter (doc_id % 11 = 0) as protected, sum(n_chars) > 1000000 as alert from documents")
def cache_metrics(v: Views) -> DataFrame:
    return v.table("documents").agg(F.count("*").alias("items"), F.sum("n_chars").alias("bytes"), F.count_if(F.col("doc_id") % 11 == 0).alias("protected"), (F.sum("n_chars") > 1_000_000).alias("alert"))


@query("dat_06_sensor_status", f"select user_id, case when age < 600 then 'active' when age < 1800 then 'idle' else 'offline' end as status from (select user_id, epoch(timestamp '{_AS_OF}') - epoch(date_trunc('second', max(ts))) as age from log group by 1) t", "log")
def status(v: Views) -> DataFrame:
    last = v.log.groupBy("user_id").agg(F.max("ts").alias("last"))
    return last.select("user_id", ev.sensor_status(F.date_trunc("second", "last"), F.lit(_AS_OF).cast("timestamp")).alias("status"))


@query("dat_07_visible_sensors", f"select distinct user_id from log where ts >= timestamp '{_AS_OF}' - interval 3600 second", "log")
def visible(v: Views) -> DataFrame:
    return v.log.where(f"ts >= timestamp_ntz'{_AS_OF}' - interval 3600 seconds").select("user_id").distinct()


@query("dat_08_query_cadence", f"select kind, epoch(timestamp '{_AS_OF}') - epoch(date_trunc('second', max(ts))) >= 3600 as due from log group by 1", "log")
def cadence(v: Views) -> DataFrame:
    age = F.lit(_AS_OF).cast("timestamp").cast("long") - F.date_trunc("second", F.max("ts")).cast("timestamp").cast("long")
    return v.log.groupBy("kind").agg((age >= 3600).alias("due"))


@query("str_01_rid_parse", "select rid, 'orn:user.state' as context, cast(user_id as varchar) as reference from (select distinct rid, user_id from log) t", "log")
def rid_parse(v: Views) -> DataFrame:
    from ..functions.text import rid_reference

    return v.log.select("rid").distinct().select("rid", rid_context(F.col("rid")).alias("context"), F.substring_index(rid_reference(F.col("rid")), ":", -1).alias("reference"))


@query("str_02_namespace", "select url, case when url like 'http%' then null else url end as ns, 'web.page' as rid_ns from pages")
def rid_namespace(v: Views) -> DataFrame:
    p = v.table("pages").select("url", F.concat(F.lit("orn:web.page:"), "url").alias("rid"))
    return p.select("url", namespace(F.col("url")).alias("ns"), namespace(F.col("rid")).alias("rid_ns"))


@query("set_03_difference", "select user_id from (select distinct user_id from log where seq >= 9000) a where user_id not in (select user_id from log where seq < 300)", "log")
def difference(v: Views) -> DataFrame:
    return v.log.where("seq >= 9000").select("user_id").distinct().join(v.log.where("seq < 300").select("user_id"), "user_id", "left_anti")


@query("set_06_subset", "select user_id, len(list_intersect(d, c)) = len(d) as subset from (select user_id, list_distinct(list(kind) filter (seq < 5000)) as d, list_distinct(list(kind) filter (seq >= 5000)) as c from log group by 1) t where d is not null and c is not null", "log")
def subset(v: Views) -> DataFrame:
    g = v.log.groupBy("user_id").agg(F.collect_set(F.when(F.col("seq") < 5000, F.col("kind"))).alias("d"), F.collect_set(F.when(F.col("seq") >= 5000, F.col("kind"))).alias("c"))
    return g.where("size(d) > 0 and size(c) > 0").select("user_id", (F.size(F.array_except("d", "c")) == 0).alias("subset"))


@query("set_05_distinct", "select distinct conv_id from turns where role = 'user'", "turns")
def distinct_topics(v: Views) -> DataFrame:
    return v.turns.where("role = 'user'").select("conv_id").distinct()
