"""Queries on the content of sources: messages, note blocks, articles, episodes, ledgers, drafts, patterns of the ontology."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import content as c
from ..operators import events as ev
from ..operators import kg
from .documents import _SENTENCE_WALK
from .registry import query
from .views import Views


@query("str_34_message_text", "select conv_id, turn, case turn % 4 when 2 then text || chr(10) || 'tail' else text end as body from turns where turn % 4 < 3 union all select conv_id, turn, '' from turns where turn % 4 = 3", "turns")
def message_text(v: Views) -> DataFrame:
    """Session messages in their four shapes: a string, an object with a string, with blocks, and one without text."""
    k = F.col("turn") % 4
    block = F.to_json(F.struct(F.lit("text").alias("type"), "text"))
    blocks = F.concat(F.lit('{"message":{"content":['), block, F.lit(',{"type":"tool","text":"no"},"tail"]}}'))
    raw = F.when(k == 0, F.to_json(F.struct(F.col("text").alias("message")))).when(k == 1, F.to_json(F.struct(F.struct(F.col("text").alias("content")).alias("message")))).when(k == 2, blocks).otherwise('{"type":"user"}')
    return v.turns.select("conv_id", "turn", raw.alias("raw")).select("conv_id", "turn", c.message_text(F.col("raw")).alias("body"))


_BLOCK_SQL = """select conv_id, turn, text, case turn % 7 when 1 then 'paragraph' when 2 then 'code' when 3 then 'divider' when 4 then 'embed' when 5 then 'video' when 6 then 'unknown' else 'heading_2' end as kind,
  case when turn % 14 = 7 then 'Projects' else 'Part ' || turn end as heading from turns"""


@query("jsn_04_note_text", f"""
with b as ({_BLOCK_SQL}), s as (select *, max(case when kind = 'heading_2' then turn end) over (partition by conv_id order by turn) as section from b),
 w as (select *, case kind when 'heading_2' then heading when 'paragraph' then text when 'code' then case when text <> '' then '```py' || chr(10) || text || chr(10) || '```' end when 'divider' then '---' when 'embed' then '[Embed: https://x.example/' || turn || '] - cap' when 'video' then '[Video Recording]' end as line
  from s where not (section is not null and section % 14 = 7))
select conv_id, md5(string_agg(line, chr(10) || chr(10) order by turn)) as content from w where line <> '' group by 1""", "turns")
def note_text(v: Views) -> DataFrame:
    """Note pages as text: each block by its kind, sections under a skipped heading left out."""
    k, n = F.col("turn") % 7, F.col("turn")
    rich = lambda x: F.array(F.struct(x.alias("plain_text")))
    heading = F.when(n % 14 == 7, "Projects").otherwise(F.concat(F.lit("Part "), n))
    data = F.when(k == 0, F.to_json(F.struct(F.lit("heading_2").alias("type"), F.struct(rich(heading).alias("rich_text")).alias("heading_2"))))
    data = data.when(k == 1, F.to_json(F.struct(F.lit("paragraph").alias("type"), F.struct(rich(F.col("text")).alias("rich_text")).alias("paragraph"))))
    data = data.when(k == 2, F.to_json(F.struct(F.lit("code").alias("type"), F.struct(F.lit("py").alias("language"), rich(F.col("text")).alias("rich_text")).alias("code")))).when(k == 3, '{"type":"divider"}')
    data = data.when(k == 4, F.to_json(F.struct(F.lit("embed").alias("type"), F.struct(F.concat(F.lit("https://x.example/"), n).alias("url"), rich(F.lit("cap")).alias("caption")).alias("embed"))))
    data = data.when(k == 5, '{"type":"video","video":{"type":"file","file":{"url":"https://s3.example/x"}}}').otherwise('{"type":"unknown"}')
    blocks = v.turns.select(F.col("conv_id").alias("page"), n.alias("place"), data.alias("block"))
    return c.note_text(blocks, ("projects",)).select(F.col("page").alias("conv_id"), F.md5("content").alias("content"))


_ARTICLE_HEADS = (
    '<h1>Head</h1><meta name="author" content="Ann A"><time datetime="2024-02-03T00:00:00Z">x</time>',
    '<a data-testid="authorName" href="/a"> Bob B </a><p>On Jul 3, 2024 it was</p>',
    '<a rel="author" href="/c">Cy C</a>',
    '<span class="x-byline">Di D</span>',
    '<span>Written by</span><b>Ed E</b>',
)
_HEAD_SQL = "case page_id % 5 " + " ".join(f"when {i} then '{x}'" for i, x in enumerate(_ARTICLE_HEADS)) + " end"


@query("str_30_article", f"""
select page_id, case when page_id % 5 = 0 then 'Head' else trim(coalesce(nullif(regexp_extract(html, '(?s)<h1[^>]*>([^<]*)</h1>', 1), ''), regexp_extract(html, '(?s)<title>([^<]*)</title>', 1))) end as title,
 ['Ann A', 'Bob B', 'Cy C', 'Di D', 'Ed E'][page_id % 5 + 1] as author, case page_id % 5 when 0 then '2024-02-03T00:00:00Z' when 1 then '2024-07-03T00:00:00Z' else nullif(regexp_extract(html, '<time[^>]*datetime="([^"]*)"', 1), '') end as published from pages""")
def article(v: Views) -> DataFrame:
    """Title, author by the cascade of places where it may stand, and date; every page carries one of five fronts."""
    front = F.element_at(F.array(*map(F.lit, _ARTICLE_HEADS)), (F.col("page_id") % 5 + 1).cast("int"))
    return v.table("pages").select("page_id", c.article(F.concat(front, "html")).alias("a")).select("page_id", "a.*")


@query("str_36_media_documents", """
select doc_id, md5(case when doc_id % 2 = 0 then '# ' || source || chr(10) || chr(10) || '**Episode URL:** https://a.example/' || doc_id || chr(10) || '**Published:** 2024/01/02' || chr(10) || '**Duration:** ' || case when n_chars >= 1 then (n_chars * 100) // 60000 || ' minutes' else 'Unknown' end || chr(10) || chr(10) || '## Description' || chr(10) || coalesce(text, 'No description available')
  else coalesce(text, '') || case when doc_id % 3 = 0 then chr(10) || chr(10) || '=== TRANSCRIPT ===' || chr(10) || chr(10) || 'spoken' else '' end end) as body,
 case when doc_id % 2 = 1 then '2024-01-' || lpad(cast(1 + doc_id % 28 as varchar), 2, '0') || 'T00:00:00+00:00' end as stamp from documents""")
def media_documents(v: Views) -> DataFrame:
    """Episodes (even ids) and videos (odd ids) as documents."""
    i = F.col("doc_id")
    episode = c.episode_text(F.col("source"), F.concat(F.lit("https://a.example/"), i), F.lit("2024/01/02"), F.col("n_chars") * 100, F.col("text"))
    video = c.video_text(F.col("text"), F.when(i % 3 == 0, "spoken"))
    stamp = c.video_stamp(F.when(i % 2 == 1, F.concat(F.lit("202401"), F.lpad((1 + i % 28).cast("string"), 2, "0"))))
    return v.table("documents").select("doc_id", F.md5(F.when(i % 2 == 0, episode).otherwise(video)).alias("body"), stamp.alias("stamp"))


@query("prj_04_thread_posts", """
with n as (select conv_id, turn, text, row_number() over (partition by conv_id order by turn) as k, count(*) over (partition by conv_id) as total from turns),
 posts as (select conv_id, k, substr(text, 1, 200) as body, total from n where k <= 5
  union all select conv_id, total + j, ['Join us', 'Read more', 'Take part'][j], total from (select conv_id, max(total) as total from n group by 1) g, (values (1), (2), (3)) f(j) where total < 3 and total + j <= 3)
select conv_id, k as position, md5(k || '/' || greatest(3, least(5, total)) || ' ' || body || case when k = greatest(3, least(5, total)) then ' #knowledge' else '' end) as post from posts""", "turns")
def thread_posts(v: Views) -> DataFrame:
    """Threads of three to five posts: fillers where there are too few, numbers, and the tags on the last one."""
    return c.compose_thread(v.turns.select(F.col("conv_id").alias("thread"), F.col("turn").alias("place"), F.substring("text", 1, 200).alias("body")), ("Join us", "Read more", "Take part"), "#knowledge").select(F.col("thread").alias("conv_id"), "position", F.md5("post").alias("post"))


@query("prj_05_draft_pipeline", r"""
with first_n as (select conv_id from (select distinct conv_id from turns) c order by conv_id limit 5),
 posts as (select conv_id, turn, regexp_replace(text, '([!?])[!?]+', '\1', 'g') as calm, text, len(regexp_extract_all(text, 'https?://[^ ]+')) as links from turns where conv_id in (select conv_id from first_n))
select conv_id, count(*) as posts, cast(sum(links) as bigint) as links, greatest(0.0::double, round(1 - 0.1 * count(*) filter (calm <> text), 6)) as score, 'draft' as status from posts group by 1""", "turns")
def draft_pipeline(v: Views) -> DataFrame:
    """The first five threads composed, their links counted, the style enforced and scored, stored as drafts."""
    first = v.turns.select("conv_id").distinct().orderBy("conv_id").limit(5)
    posts = v.turns.join(first, "conv_id", "left_semi").select("conv_id", "text", F.regexp_replace("text", "([!?])[!?]+", "$1").alias("calm"), F.size(F.regexp_extract_all("text", F.lit("https?://[^ ]+"), F.lit(0))).alias("links"))
    changed = F.count_if(F.col("calm") != F.col("text"))
    return posts.groupBy("conv_id").agg(F.count("*").alias("posts"), F.sum("links").alias("links"), F.greatest(F.lit(0.0), F.round(1 - 0.1 * changed, 6)).alias("score"), F.lit("draft").alias("status"))


@query("agg_50_notable_events", """
select 'new_proposal' as kind, cast(id as varchar) as id from jobs where state = 'running' and cast(scheduled_for as date) > (select max(cast(scheduled_for as date)) from jobs) - 1
union all select 'large_issuance', batch || '-' || line from batches where flag = 'N' and price > 100000 * 100
union all select 'high_marketplace_activity', cast(n as varchar) from (select count(*) as n from batches where flag = 'R') o where n > 20""", "jobs", "batches")
def notable(v: Views) -> DataFrame:
    """Proposals of the last day, issuances over 100,000, and more than 20 sell orders."""
    newest = v.jobs.agg(F.max(F.to_date("scheduled_for")).alias("newest"))
    fresh = v.jobs.where("state = 'running'").select("id", F.to_date("scheduled_for").alias("day")).join(F.broadcast(newest), F.expr("day > newest - 1")).select(F.lit("new_proposal").alias("kind"), F.col("id").cast("string"))
    large = v.batches.where("flag = 'N' and price > 100000 * 100").select(F.lit("large_issuance").alias("kind"), F.concat("batch", F.lit("-"), "line").alias("id"))
    orders = v.batches.where("flag = 'R'").agg(F.count("*").alias("n")).where("n > 20").select(F.lit("high_marketplace_activity").alias("kind"), F.col("n").cast("string").alias("id"))
    return fresh.unionByName(large).unionByName(orders)


@query("agg_54_ledger_stats", """
select total_classes, issued, retired, case when issued > 0 then round(retired / issued, 6) else 0 end as retirement_rate, active, validators
from (select count(distinct class_id) as total_classes, cast(sum(amount) filter (flag <> 'R') as double) as issued, cast(coalesce(sum(amount) filter (flag = 'R'), 0) as double) as retired from batches) b,
 (select count(*) as active from jobs where state = 'running') j, (select count(*) as validators from validators) w""", "batches", "jobs", "validators")
def ledger_stats(v: Views) -> DataFrame:
    """The ledger's daily figures, one row: each part is an aggregate of one row, so their join is of single rows."""
    b = v.batches.agg(F.countDistinct("class_id").alias("total_classes"), F.sum(F.when(F.col("flag") != "R", F.col("amount"))).cast("double").alias("issued"), F.coalesce(F.sum(F.when(F.col("flag") == "R", F.col("amount"))), F.lit(0)).cast("double").alias("retired"))
    j = v.jobs.where("state = 'running'").agg(F.count("*").alias("active"))
    w = v.validators.agg(F.count("*").alias("validators"))
    rate = F.when(F.col("issued") > 0, F.round(F.col("retired") / F.col("issued"), 6)).otherwise(0.0)
    return b.join(F.broadcast(j)).join(F.broadcast(w)).select("total_classes", "issued", "retired", rate.alias("retirement_rate"), "active", "validators")


@query("stm_10_sliding_failures", "select seq, n as failures, n > 5 as alert from (select seq, count(*) over (order by ts range between interval '3599999999 microseconds' preceding and current row) as n from log where event_type = 'FORGET') t", "log")
def sliding_failures(v: Views) -> DataFrame:
    """Failures in the hour before each one. Every failure goes to its own hour and the next, so each hour is counted apart."""
    return c.sliding_count(v.log.where("event_type = 'FORGET'").select("seq", "ts"), "ts", 3600).select("seq", F.col("n").alias("failures"), (F.col("n") > 5).alias("alert"))


@query("stm_15_ping_status", """
with seen as (select kind || '-sensor' as sensor, max(ts) as last_seen, count(*) as events from log group by 1), ping as (select max(ts) as pinged from log)
select sensor, events, case when last_seen >= pinged - interval '10 minutes' then 'active' when last_seen > pinged - interval '30 minutes' then 'idle' else 'offline' end as status from seen, ping""", "log")
def ping_status(v: Views) -> DataFrame:
    """A ping to every kind of sensor at the log's end: who answered lately, by the last event of each."""
    seen = v.log.groupBy(t.sensor_base_name(F.col("source_node")).alias("sensor")).agg(F.max("ts").alias("last_seen"), F.count("*").alias("events"))
    at = v.log.agg(F.max("ts").alias("at"))
    age = F.expr("at - last_seen")
    status = F.when(age <= F.expr("interval '10' minute"), "active").when(age < F.expr("interval '30' minute"), "idle").otherwise("offline")
    return seen.join(F.broadcast(at)).select("sensor", "events", status.alias("status"))


@query("stm_16_poll_and_apply", """
with edges(node, kind) as (values ('a', 'view'), ('b', 'click'), ('c', 'error'), ('c', 'signup')), d as (select node, seq, rid, event_type, hash from log join edges using (kind) qualify row_number() over (partition by node order by seq) <= 50)
select node, rid, hash, seq as last_seq from (select *, row_number() over (partition by node, rid order by seq desc) as n from d) x where n = 1 and event_type <> 'FORGET'""", "log")
def poll_and_apply(v: Views) -> DataFrame:
    """What each node holds after one poll of at most 50 events: delivered by kind, oldest first, then folded."""
    edges = v.spark.createDataFrame([("a", "view"), ("b", "click"), ("c", "error"), ("c", "signup")], "node string, kind string")
    got = ev.deliveries(v.log, edges, 50).join(v.log.select("seq", "event_type", "hash"), "seq")
    return ev.current_state(got.withColumn("key", F.struct("node", "rid")), "key").select("key.node", "key.rid", "hash", "last_seq")


@query("src_03_contiguous_mark", "select user_id, min(event_id) as first, max(event_id) filter (run = 0) as mark from (select user_id, event_id, event_id - min(event_id) over (partition by user_id) - (row_number() over (partition by user_id order by event_id) - 1) as run from (select event_id % 97 as user_id, event_id // 97 as event_id from events where event_id % 89 <> 0) e) t group by 1")
def contiguous_mark(v: Views) -> DataFrame:
    """Per mailbox, the last message up to which all have come: later ones are polled again."""
    e = v.table("events").where("event_id % 89 <> 0").select((F.col("event_id") % 97).alias("user_id"), F.expr("event_id div 97").alias("event_id"))
    return c.contiguous_mark(e, "user_id", "event_id")


@query("src_20_ledger_pages", "select p_brand as class_id, count(*) as batches, cast(sum(p_size) as bigint) as amount from part group by 1")
def ledger_pages(v: Views) -> DataFrame:
    """Landed response pages (an array of entities and the key of the next page) unfolded to entities again."""
    pages = v.table("part").groupBy("p_brand", F.expr("p_partkey div 100").alias("page")).agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("p_partkey").alias("denom"), F.col("p_size").alias("amount"))).alias("batches"), F.max("p_partkey").cast("string").alias("next_key"))).alias("body"))
    found = c.unfold_pages(pages, "body", "batches", "denom long, amount long")
    return found.groupBy(F.col("p_brand").alias("class_id")).agg(F.count("*").alias("batches"), F.sum("item.amount").alias("amount"))


@query("ext_05_header_persons", """
with m as (select c_custkey as id, c_name as name, lower(c_mktsegment) || '.example' as domain from customer), e as (select id, name, 'Person' as kind, 0.95::double as confidence from m where length(name) > 2
 union all select id, upper(substr(domain, 1, 1)) || split_part(substr(domain, 2), '.', 1), 'Organization', 0.7::double from m union all select id, 'Post', 'Organization', 0.56::double from m)
select id, name, kind, max(confidence) as confidence from e group by 1, 2, 3""")
def header_entities(v: Views) -> DataFrame:
    """Sender, the sender's organisation by domain, and recipients' organisations at 0.8 of the trust; one row a name."""
    m = v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("from_name"), F.concat(F.lit("x@"), F.lower("c_mktsegment"), F.lit(".example")).alias("from_address"), F.array(F.concat(F.lit("y@"), F.lower("c_mktsegment"), F.lit(".example")), F.lit("z@mail.post.example"), F.lit("u@gmail.com")).alias("to_addresses"))
    return c.header_entities(m, ("gmail.com",))


_RULES_SQL = " union all ".join(f"select doc_id, {i} as rule, '{k}' as kind, unnest(regexp_extract_all(text, '{p}')) as value from documents" for i, (k, p, _) in enumerate(kg.ENTITY_RULES))


@query("ext_01_ontology_entities", f"""
with hits as ({_RULES_SQL.replace(chr(92) + chr(92), chr(92))}), good as (select * from (select *, trim(value) as v, row_number() over () as k from hits) h where v <> '' and case kind when 'CreditClass' then regexp_matches(v, '^C[0-9]{{2,3}}$') when 'Project' then regexp_matches(v, '^P[0-9]{{3,4}}$') when 'Methodology' then regexp_matches(v, '^VM[0-9]{{4}}$') else true end)
select doc_id, kind, upper(v) as key, count(*) as hits, 0.95::double as confidence from good group by 1, 2, 3""")
def ontology_entities(v: Views) -> DataFrame:
    """Entities by the ontology's patterns in priority order, validated, one a kind and upper-case value of each document."""
    return kg.pattern_entities(v.table("documents"), "doc_id", "text").select("doc_id", "kind", "key", "hits", "confidence")


@query("grf_08_ontology", "select * from (values " + ", ".join(f"('{s}', '{p}', '{o}', '{n}')" for s, p, o, n in kg.RELATIONS) + ") r(subject, predicate, object, cardinality)")
def ontology(v: Views) -> DataFrame:
    """The relations that the ontology allows."""
    return v.spark.createDataFrame(kg.RELATIONS, "subject string, predicate string, object string, cardinality string")


@query("ext_08_document_entities", f"""
with hits as ({_RULES_SQL.replace(chr(92) + chr(92), chr(92)).replace("regexp_extract_all(text,", "regexp_extract_all(source || chr(10) || chr(10) || text,")}), good as (select doc_id, kind, upper(trim(value)) as v from hits where trim(value) <> '' and kind in ('Organization', 'Proposal') group by 1, 2, 3)
select doc_id, 'pattern' as method, count(*) as entities_found from good group by 1""")
def document_entities(v: Views) -> DataFrame:
    """Whole documents, the title in front of the text, with the number of organisations and proposals found."""
    titled = v.table("documents").select("doc_id", F.concat("source", F.lit("\n\n"), "text").alias("text"))
    e = kg.pattern_entities(titled, "doc_id", "text", kinds=("Organization", "Proposal"))
    return e.groupBy("doc_id").agg(F.lit("pattern").alias("method"), F.count("*").alias("entities_found"))


@query("chk_05_mail_chunks", r"""
with m as (select doc_id, coalesce(source, '') as subject, 'Subject: ' || source || chr(10) || chr(10) || coalesce(text, '') as body from documents),
 w as (select doc_id, subject, list_filter(string_split(trim(regexp_replace(body, '\s+', ' ', 'g')), ' '), lambda x: x <> '') as tk from m),
 n as (select *, greatest(0, cast(ceil((len(tk) - 500) / 450) as bigint)) as last from w where len(tk) > 0)
select doc_id, cast(i as integer) as index, last + 1 as total_chunks, subject, md5(array_to_string(tk[i * 450 + 1 : i * 450 + 500], ' ')) as chunk from n, unnest(generate_series(0, last)) g(i)""")
def mail_chunks(v: Views) -> DataFrame:
    """Chunks of a mail with its subject in front, each with the header's columns."""
    m = v.table("documents").select("doc_id", F.col("source").alias("subject"), F.coalesce("text", F.lit("")).alias("body"), F.lit("a@x").alias("from_address"))
    return c.mail_chunks(m, "doc_id").select("doc_id", "index", "total_chunks", "subject", F.md5("chunk").alias("chunk"))


@query("chk_05_mail_sentences", f"""
with recursive {_SENTENCE_WALK.replace("{text}", "'Subject: ' || source || chr(10) || chr(10) || coalesce(text, '')")}
select doc_id, index, count(*) over (partition by doc_id) as total_chunks, source as subject, md5(array_to_string(t[start_token + 1 : end_token], ' ')) as chunk from windows join docs using (doc_id) join documents using (doc_id)""")
def mail_sentences(v: Views) -> DataFrame:
    """Chunks of a mail that end at sentence ends, its subject in front, each with the header's columns."""
    m = v.table("documents").select("doc_id", F.col("source").alias("subject"), F.coalesce("text", F.lit("")).alias("body"), F.lit("a@x").alias("from_address"))
    return c.mail_chunks(m, "doc_id", sentences=True).select("doc_id", "index", "total_chunks", "subject", F.md5("chunk").alias("chunk"))
