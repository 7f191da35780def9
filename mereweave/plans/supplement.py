"""Further queries: admission rules, per-source documents, roll-ups, drafts, hashes."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as t
from .documents import _REDACTED
from ..functions.canonical import canonical_json
from .registry import query
from .views import Views


@query("flt_18_entity_exclusion", "select distinct e as entity from extractions, unnest(entities) as u(e) where length(e) > 2 and not (e like 'Th%' or e like 'An%') and extraction_type = 'unified'", "extractions")
def exclusion(v: Views) -> DataFrame:
    e = v.extractions.where("extraction_type = 'unified'").select(F.explode("entities").alias("entity"))
    return e.where((F.length("entity") > 2) & ~(F.startswith("entity", F.lit("Th")) | F.startswith("entity", F.lit("An")))).distinct()


@query("flt_23_source_admission", "select 'forum' as kind, doc_id as id from documents where source in ('src1', 'src2') and length(text) >= 50 union all select 'note', doc_id from documents where source = 'src3' and length(trim(text)) >= 20 union all select 'web', page_id from pages where length(html) >= 100 and url is not null union all select 'social', seq from log where kind = 'click' and size_bytes >= 5000", "log")
def admission(v: Views) -> DataFrame:
    d = v.table("documents")
    forum = d.where("source in ('src1', 'src2') and length(text) >= 50").select(F.lit("forum").alias("kind"), F.col("doc_id").alias("id"))
    note = d.where("source = 'src3' and length(trim(text)) >= 20").select(F.lit("note").alias("kind"), F.col("doc_id").alias("id"))
    web = v.table("pages").where("length(html) >= 100 and url is not null").select(F.lit("web").alias("kind"), F.col("page_id").alias("id"))
    social = v.log.where("kind = 'click' and size_bytes >= 5000").select(F.lit("social").alias("kind"), F.col("seq").alias("id"))
    return forum.unionByName(note).unionByName(web).unionByName(social)


@query("flt_24_site_rules", "select page_id, case when contains(url, 'blog.') then contains(url, '/en/') when contains(url, '://m.') then not contains(url, '?') else true end as wanted from pages")
def site_rules(v: Views) -> DataFrame:
    u = F.col("url")
    return v.table("pages").select("page_id", F.when(F.contains(u, F.lit("blog.")), F.contains(u, F.lit("/en/"))).when(F.contains(u, F.lit("://m.")), ~F.contains(u, F.lit("?"))).otherwise(True).alias("wanted"))


@query("flt_25_attachment_admission", "select p_partkey from part where p_size <= 25 and p_type in ('ECONOMY', 'SMALL', 'STANDARD')")
def attachments(v: Views) -> DataFrame:
    return v.table("part").where((F.col("p_size") <= 25) & F.col("p_type").isin("ECONOMY", "SMALL", "STANDARD")).select("p_partkey")


@query("flt_26_source_url", """
select rid, coalesce(nullif(trim(source_url), ''), nullif(trim(url), ''), case when parent is not null then rid end) as found, coalesce(nullif(trim(source_url), ''), nullif(trim(url), ''), parent) is null as skipped
from (select 'orn:web.page:' || page_id as rid, case page_id % 5 when 0 then ' ' || url when 1 then '' end as source_url, case page_id % 5 when 1 then url when 2 then ' ' end as url, case page_id % 5 when 2 then 'p' end as parent from pages) s""")
def source_url(v: Views) -> DataFrame:
    k = F.col("page_id") % 5
    s = v.table("pages").select(F.concat(F.lit("orn:web.page:"), "page_id").alias("rid"), F.when(k == 0, F.concat(F.lit(" "), "url")).when(k == 1, "").alias("source_url"), F.when(k == 1, F.col("url")).when(k == 2, " ").alias("url"), F.when(k == 2, "p").alias("parent"))
    clean = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    found = F.coalesce(clean("source_url"), clean("url"), F.when(F.col("parent").isNotNull(), F.col("rid")))
    return s.select("rid", found.alias("found"), found.isNull().alias("skipped"))


@query("join_17_session_overlay", "select c.conv_id, coalesce(nullif(d.lang, ''), 'none') as summary, c.turns from (select conv_id, count(*) as turns from conversations group by 1) c left join documents d on d.doc_id = c.conv_id and d.n_chars > 500")
def overlay(v: Views) -> DataFrame:
    c = v.turns.groupBy("conv_id").agg(F.count("*").alias("turns"))
    d = v.table("documents").where("n_chars > 500").select(F.col("doc_id").alias("conv_id"), "lang")
    return c.join(d, "conv_id", "left").select("conv_id", F.coalesce(F.nullif("lang", F.lit("")), F.lit("none")).alias("summary"), "turns")


@query("set_04_jaccard", "select a.doc_id, round(len(list_intersect(a.entities, b.entities)) / nullif(len(list_distinct(list_concat(a.entities, b.entities))), 0), 6) as similarity from extractions a join extractions b on b.doc_id = a.doc_id + 1 where len(a.entities) + len(b.entities) > 0", "extractions")
def jaccard(v: Views) -> DataFrame:
    a = v.extractions.select("doc_id", "entities")
    b = a.select((F.col("doc_id") - 1).alias("doc_id"), F.col("entities").alias("other"))
    return a.join(b, "doc_id").where("size(entities) + size(other) > 0").select("doc_id", F.round(t.jaccard(F.col("entities"), F.col("other")), 6).alias("similarity"))


@query("jsn_01_nested_redaction", r"""
select doc_id, cast(doc_id as varchar) as id, md5(regexp_replace(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+', '[EMAIL]', 'g')) as block, regexp_replace(source, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+', '[EMAIL]', 'g') as source from documents""")
def nested(v: Views) -> DataFrame:
    """Redacts every string of a JSON value but ids; shapes are unknown, so it runs in Arrow batches. Whole texts, nested in lists and objects."""
    import re

    def clean(x, key=None):
        if isinstance(x, dict):
            return {k: clean(y, k) for k, y in x.items()}
        if isinstance(x, list):
            return [clean(y) for y in x]
        return re.sub(r"[\w.+-]+@[\w.-]+\.\w+", "[EMAIL]", x) if isinstance(x, str) and key != "id" else x

    @F.pandas_udf(StringType())
    def redact(values: pd.Series) -> pd.Series:
        return values.map(lambda s: None if s is None else json.dumps(clean(json.loads(s)), sort_keys=True))

    whole = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.array(F.struct("text")).alias("blocks"), F.struct("source").alias("from")))
    got = v.table("documents").select("doc_id", redact(whole).alias("j"))
    parsed = F.from_json("j", "id string, blocks array<struct<text: string>>, `from` struct<source: string>")
    return got.select("doc_id", parsed.alias("p")).select("doc_id", "p.id", F.md5(F.col("p.blocks")[0]["text"]).alias("block"), F.col("p.from.source").alias("source"))


@query("jsn_03_wire_to_internal", "select event_id, case when event_type = 'error' then 'FORGET' else 'UPDATE' end as kind, coalesce(json_extract_string(props, '$.hash'), json_extract_string(props, '$.k')) as hash from events")
def internal(v: Views) -> DataFrame:
    f = F.from_json("props", "hash string, k string")
    return v.table("events").select("event_id", F.when(F.col("event_type") == "error", "FORGET").otherwise("UPDATE").alias("kind"), F.coalesce(f["hash"], f["k"]).alias("hash"))


@query("mrg_02_calendar_gate", "select rid, arg_max(seq, {'a': size_bytes % 5, 'b': seq}) as winner from log group by 1", "log")
def gate(v: Views) -> DataFrame:
    """Where every row has a SEQUENCE the gate is a maximum: the largest, the latest of equals."""
    return v.log.groupBy("rid").agg(F.max_by("seq", F.struct(F.col("size_bytes") % 5, F.col("seq"))).alias("winner"))


@query("mrg_07_replace_children", "select conv_id, turn, length(text) as n from conversations where conv_id % 2 = 0 union all select conv_id, turn, 0 from conversations where conv_id % 2 = 1 and turn < 2")
def children(v: Views) -> DataFrame:
    old = v.turns.select("conv_id", "turn", F.length("text").cast("long").alias("n"))
    new = v.turns.where("conv_id % 2 = 1 and turn < 2").select("conv_id", "turn", F.lit(0).cast("long").alias("n"))
    return old.join(new.select("conv_id").distinct(), "conv_id", "left_anti").unionByName(new)


@query("mrg_08_nested_update", "select event_id, '{\"k\":' || json_extract_string(props, '$.k') || ',\"author\":\"u' || user_id || '\"}' as props from events")
def nested_update(v: Views) -> DataFrame:
    s = F.from_json("props", "k long").withField("author", F.concat(F.lit("u"), "user_id"))
    return v.table("events").select("event_id", F.to_json(s).alias("props"))


@query("mrg_11_content_hashes", "select event_id, sha256(props) as spaced, sha256(replace(props, ' ', '')) as canonical from events")
def hashes(v: Views) -> DataFrame:
    """Two hashes of one JSON value: sorted keys with spaces, and the canonical form without. Arbitrary JSON needs a parser,
    so it runs in Arrow batches."""

    @F.pandas_udf(StructType([StructField("spaced", StringType()), StructField("canonical", StringType())]))
    def both(values: pd.Series) -> pd.DataFrame:
        parsed = [None if s is None else json.loads(s) for s in values]
        sha = lambda p, **how: None if p is None else hashlib.sha256(json.dumps(p, sort_keys=True, **how).encode()).hexdigest()
        return pd.DataFrame({"spaced": [sha(p) for p in parsed], "canonical": [sha(p, separators=(",", ":"), ensure_ascii=False) for p in parsed]}, dtype=object)

    return v.table("events").select("event_id", both("props").alias("h")).select("event_id", "h.spaced", "h.canonical")


_NESTED_SQL = """regexp_replace(regexp_replace((case when event_id % 11 = 0 then '0' else value::varchar end), '\\.0$', ''), '^-0$', '0')"""


@query("mrg_11_canonical_values", f"""
with j as (select event_id, user_id, {_NESTED_SQL} as x, json_extract_string(props, '$.k') as k from events)
select event_id, sha256('{{"A":{{"list":[1000000,' || x || ',1e+21,1e-7,null],"user":' || user_id || '}},"€":"' || k || '","😀":true,"דּ":' || event_id || '}}') as canonical from j""")
def canonical_values(v: Views) -> DataFrame:
    """Hashes of nested values however they are written: spaces, key order, 1E6 and 1.0, keys outside the basic plane."""
    k = F.get_json_object("props", "$.k")
    x = F.when(F.col("event_id") % 11 == 0, "-0.0").otherwise(F.col("value").cast("string"))
    text = F.concat(F.lit('{ "דּ" :'), "event_id", F.lit(', "😀": true,"€" : "'), k, F.lit('", "A":{"user": '), F.col("user_id"), F.lit('.0, "list": [1E6, '), x, F.lit(", 1000000000000000000000, 0.1e-6, null]}}"))
    return v.table("events").select("event_id", text.alias("text")).select("event_id", F.sha2(canonical_json("text"), 256).alias("canonical"))


@query("mrg_12_latest_comment", "select user_id, arg_max(seq, {'a': size_bytes, 'b': seq}) as comment, case when count(distinct kind) = 5 then 'complete' else 'partial' end as coverage from log group by 1", "log")
def comments(v: Views) -> DataFrame:
    return v.log.groupBy("user_id").agg(F.max_by("seq", F.struct("size_bytes", "seq")).alias("comment"), F.when(F.countDistinct("kind") == 5, "complete").otherwise("partial").alias("coverage"))


@query("mrg_13_draft_status", "select id, state, case when state = 'completed' then scheduled_for end as published_at from jobs", "jobs")
def draft_status(v: Views) -> DataFrame:
    return v.jobs.select("id", "state", F.when(F.col("state") == "completed", F.col("scheduled_for")).alias("published_at"))


@query("mrg_14_job_state", "select worker, arg_max(state, id) as state, count(*) as updates from jobs group by 1", "jobs")
def job_state(v: Views) -> DataFrame:
    return v.jobs.groupBy("worker").agg(F.max_by("state", "id").alias("state"), F.count("*").alias("updates"))


@query("str_26_page_metadata", "select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, substr(regexp_extract(html, '<html lang=\"([^\"]*)\"', 1), 1, 2) as lang from pages")
def page_metadata(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.substring(F.regexp_extract("html", '<html lang="([^"]*)"', 1), 1, 2).alias("lang"))


_WITH_VIDEO = "case page_id % 3 when 0 then html || '<a href=\"/v/' || page_id || '.mp4\">x</a><iframe src=\"https://www.youtube.com/embed/' || page_id || '\"></iframe>' when 1 then html || '<video src=\"/b.webm\"></video>' else html end"


@query("str_27_video_urls", f"select page_id, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(html, 'href=\"([^\"]*[.]mp4)\"', 1), regexp_extract_all(html, '<(?:video|source|iframe)[^>]*src=\"([^\"]*)\"', 1)))), ' ') as urls from (select page_id, {_WITH_VIDEO} as html from pages) s")
def videos(v: Views) -> DataFrame:
    """Video addresses of every whole page; the tables hold none, so two of three pages get some at their end."""
    end = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<a href="/v/'), "page_id", F.lit('.mp4">x</a><iframe src="https://www.youtube.com/embed/'), "page_id", F.lit('"></iframe>'))).when(F.col("page_id") % 3 == 1, '<video src="/b.webm"></video>').otherwise("")
    a = F.regexp_extract_all("html", F.lit('href="([^"]*[.]mp4)"'), F.lit(1))
    b = F.regexp_extract_all("html", F.lit('<(?:video|source|iframe)[^>]*src="([^"]*)"'), F.lit(1))
    return v.table("pages").select("page_id", F.concat("html", end).alias("html")).select("page_id", F.array_join(F.array_sort(F.array_union(a, b)), " ").alias("urls"))


@query("str_31_mail_html", r"select page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?i)<(br|/p|/div|/li|/h1)>', chr(10), 'g'), '<[^>]+>', '', 'g')) as plain from pages")
def mail_html(v: Views) -> DataFrame:
    h = F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    h = F.regexp_replace(F.regexp_replace(h, r"(?i)<(br|/p|/div|/li|/h1)>", "\n"), "<[^>]+>", "")
    return v.table("pages").select("page_id", F.md5(h).alias("plain"))


@query("str_32_event_text", "select s_suppkey, concat_ws(chr(10), 'Event: ' || s_name, 'Where: ' || nullif(n_name, 'NATION_1'), 'Power: ' || cast(cast(round(s_acctbal) as bigint) as varchar)) as body from supplier join nation on n_nationkey = s_nationkey")
def event_text(v: Views) -> DataFrame:
    n = v.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    body = F.concat_ws("\n", F.concat(F.lit("Event: "), "s_name"), F.concat(F.lit("Where: "), F.nullif("n_name", F.lit("NATION_1"))), F.concat(F.lit("Power: "), F.round("s_acctbal").cast("long")))
    return v.table("supplier").join(n, "s_nationkey").select("s_suppkey", body.alias("body"))


def _thirds_sql(most: int) -> str:
    part, gap = most // 3, "chr(10) || chr(10)"
    return f"case when length(text) <= {most} then text else substr(text, 1, {part}) || {gap} || '[...middle...]' || {gap} || substr(text, length(text) // 2 - {part // 2} + 1, {part}) || {gap} || '[...end...]' || {gap} || right(text, {part}) end"


@query("str_33_thirds", f"select doc_id, md5({_REDACTED.replace('text', _thirds_sql(60000), 1)}) as cut from (select doc_id, repeat(text, 1 + doc_id % 40) as text from documents) d")
def thirds(v: Views) -> DataFrame:
    """First, middle and last third of texts over 60,000 characters (texts are repeated to reach them), then the secrets' redaction."""
    whole = v.table("documents").select("doc_id", F.repeat("text", (1 + F.col("doc_id") % 40).cast("int")).alias("text"))
    return whole.select("doc_id", F.md5(t.redact_secrets(t.thirds(F.col("text"), 60_000))).alias("cut"))


@query("str_35_ledger_items", "select batch, line, 'orn:ledger.' || case flag when 'N' then 'batch' when 'R' then 'retirement' else 'cancellation' end || ':' || batch || '-' || line as rid, case flag when 'N' then 1.0::double when 'R' then 0.95::double else 0.5::double end as confidence from batches", "batches")
def ledger_items(v: Views) -> DataFrame:
    f = F.col("flag")
    kind = F.when(f == "N", "batch").when(f == "R", "retirement").otherwise("cancellation")
    return v.batches.select("batch", "line", F.concat(F.lit("orn:ledger."), kind, F.lit(":"), "batch", F.lit("-"), "line").alias("rid"), F.when(f == "N", 1.0).when(f == "R", 0.95).otherwise(0.5).alias("confidence"))


@query("str_37_date_precedence", r"""
select doc_id, coalesce(nullif(regexp_extract(head, '(?m)^date:[ \t]*([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''), committed, modified) as dated,
 case when regexp_matches(head, '(?m)^date:[ \t]*[0-9]{4}-[0-9]{2}-[0-9]{2}') then 0.8::double when committed is not null then case when host = 'gitlab' then 0.85::double else 1.0::double end else 0.6::double end as confidence,
 'orn:file:' || host || '/' || regexp_replace(lower(path), '[^a-z0-9]+', '-', 'g') as rid
from (select d.doc_id, case when d.doc_id % 3 = 0 then '---' || chr(10) || 'title: x' || chr(10) || 'date: 2023-0' || (1 + d.doc_id % 9) || '-15' || chr(10) || '---' || chr(10) || coalesce(text, '') else coalesce(text, '') end as head,
  case when d.doc_id % 2 = 0 then 'gitlab' else 'github' end as host, strftime(o_orderdate, '%Y-%m-%d') as committed, '2020-01-01' as modified, source || '/Doc ' || d.doc_id || '.md' as path
  from documents d left join orders on o_orderkey = d.doc_id where n_chars <= 500000) f""")
def precedence(v: Views) -> DataFrame:
    """Repository files: the front matter's date (0.8), else the last commit's (1.0, on one host 0.85), else the file's (0.6)."""
    d, o = v.table("documents").where("n_chars <= 500000"), v.table("orders").select(F.col("o_orderkey").alias("doc_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("committed"))
    body = F.coalesce("text", F.lit(""))
    head = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("---\ntitle: x\ndate: 2023-0"), 1 + F.col("doc_id") % 9, F.lit("-15\n---\n"), body)).otherwise(body)
    f = d.join(o, "doc_id", "left").select("doc_id", head.alias("text"), F.when(F.col("doc_id") % 2 == 0, "gitlab").otherwise("github").alias("host"), "committed", F.lit("2020-01-01").alias("modified"), F.concat("source", F.lit("/Doc "), "doc_id", F.lit(".md")).alias("path"))
    front = F.nullif(F.regexp_extract("text", r"(?m)^date:[ \t]*([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit(""))
    found = lambda date, trust: F.when(date.isNotNull(), F.struct(date.alias("dated"), trust.alias("confidence")))
    best = F.coalesce(found(front, F.lit(0.8)), found(F.col("committed"), F.when(F.col("host") == "gitlab", 0.85).otherwise(1.0)), found(F.col("modified"), F.lit(0.6)))
    rid = F.concat(F.lit("orn:file:"), "host", F.lit("/"), F.regexp_replace(F.lower("path"), "[^a-z0-9]+", "-"))
    return f.select("doc_id", best.alias("b"), rid.alias("rid")).select("doc_id", "b.dated", "b.confidence", "rid")


@query("str_38_thread_ids", r"""
select conv_id, turn, substr(sha256(coalesce(nullif(regexp_extract(refs, '(<[^>]+>)', 1), ''), nullif(regexp_extract(reply, '(<[^>]+>)', 1), ''), own)), 1, 16) as thread
from (select conv_id, turn, '<m' || conv_id || '.' || turn || '@x>' as own, case when turn > 1 and conv_id % 2 = 0 then '<m' || conv_id || '.0@x> <m' || conv_id || '.' || (turn - 1) || '@x>' else '' end as refs,
  case when turn > 0 then '<m' || conv_id || '.' || (turn - 1) || '@x>' end as reply from conversations) m""")
def thread_ids(v: Views) -> DataFrame:
    """A mail's thread: the first of its References, else In-Reply-To, else its own Message-ID, hashed (headers made from the turns)."""
    name = lambda turn: F.concat(F.lit("<m"), "conv_id", F.lit("."), turn, F.lit("@x>"))
    m = v.table("conversations").select(
        "conv_id", "turn", name(F.col("turn")).alias("own"), F.when((F.col("turn") > 1) & (F.col("conv_id") % 2 == 0), F.concat(name(F.lit(0)), F.lit(" "), name(F.col("turn") - 1))).otherwise("").alias("refs"),
        F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("reply"),
    )
    return m.select("conv_id", "turn", t.thread_id(F.col("refs"), F.col("reply"), F.col("own")).alias("thread"))


@query("str_39_disposition", "select status, count(*) as n from (select case when superseded then 'already' when length(text) < 100 then 'skipped' when text is null then 'failed' else 'emitted' end as status from memories) t group by 1", "memories")
def disposition(v: Views) -> DataFrame:
    s = F.when(F.col("superseded"), "already").when(F.length("text") < 100, "skipped").when(F.col("text").isNull(), "failed").otherwise("emitted")
    return v.memories.groupBy(s.alias("status")).agg(F.count("*").alias("n"))


@query("ext_07_merge_entities", "select lower(e) as name, arg_min(origin, p) as origin from (select unnest(entities) as e, 'body' as origin, 2 as p from extractions union all select n_name, 'header', 1 from nation) t group by 1", "extractions")
def merge_entities(v: Views) -> DataFrame:
    body = v.extractions.select(F.explode("entities").alias("e"), F.lit("body").alias("origin"), F.lit(2).alias("p"))
    head = v.table("nation").select(F.col("n_name").alias("e"), F.lit("header").alias("origin"), F.lit(1).alias("p"))
    return body.unionByName(head).groupBy(F.lower("e").alias("name")).agg(F.min_by("origin", "p").alias("origin"))


@query("agg_49_topic_rollup", "select conv_id, max(turn) as last_turn, md5(string_agg(text, chr(10) order by turn)) as thread from turns where text is not null group by 1", "turns")
def topics(v: Views) -> DataFrame:
    g = v.turns.where("text is not null").groupBy("conv_id").agg(F.max("turn").alias("last_turn"), F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("posts"))
    return g.select("conv_id", "last_turn", F.md5(F.array_join(F.transform("posts", lambda p: p["text"]), "\n")).alias("thread"))


@query("agg_53_proposal_summary", "select worker, count(*) as votes, cast(sum(seconds) as bigint) as tally, array_to_string(list_sort(list(id))[1:10], ',') as first_votes from jobs group by 1", "jobs")
def proposals(v: Views) -> DataFrame:
    """Totals combine before the shuffle; the ten first come from a row-number limit, which partitions prune to ten a worker first."""
    totals = v.jobs.groupBy("worker").agg(F.count("*").alias("votes"), F.sum("seconds").alias("tally"))
    first = v.jobs.select("worker", "id").withColumn("n", F.row_number().over(Window.partitionBy("worker").orderBy("id"))).where("n <= 10")
    shown = first.groupBy("worker").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("first_votes"))
    return totals.join(shown, "worker")


@query("agg_55_scheduler_status", "select worker, count(*) filter (state = 'completed') as successes, count(*) filter (state = 'failed') as failures, count(*) as runs from (select *, row_number() over (partition by worker order by id desc) as n from jobs) t where n <= 10 group by 1", "jobs")
def scheduler(v: Views) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("worker").orderBy(F.desc("id")))
    j = v.jobs.withColumn("n", n).where("n <= 10")
    return j.groupBy("worker").agg(F.count_if(F.col("state") == "completed").alias("successes"), F.count_if(F.col("state") == "failed").alias("failures"), F.count("*").alias("runs"))


@query("agg_56_score_bands", "select case when confidence >= 90 then 'excellent' when confidence >= 70 then 'good' when confidence >= 50 then 'fair' else 'poor' end as band, count(*) as n from extractions group by 1", "extractions")
def bands(v: Views) -> DataFrame:
    c = F.col("confidence")
    return v.extractions.groupBy(F.when(c >= 90, "excellent").when(c >= 70, "good").when(c >= 50, "fair").otherwise("poor").alias("band")).agg(F.count("*").alias("n"))


@query("agg_57_run_counters", "select state, retry_count, count(*) as n from jobs group by 1, 2", "jobs")
def counters(v: Views) -> DataFrame:
    return v.jobs.groupBy("state", "retry_count").agg(F.count("*").alias("n"))


@query("prj_04_thread_composition", "select conv_id, n as position, n || '/' || total as label from (select conv_id, row_number() over (partition by conv_id order by turn) as n, least(5, count(*) over (partition by conv_id)) as total from turns) t where n <= 5", "turns")
def composition(v: Views) -> DataFrame:
    w = Window.partitionBy("conv_id")
    x = v.turns.select("conv_id", F.row_number().over(w.orderBy("turn")).cast("long").alias("position"), F.least(F.lit(5), F.count("*").over(w)).alias("total"))
    return x.where("position <= 5").select("conv_id", "position", F.concat("position", F.lit("/"), "total").alias("label"))


@query("prj_06_manifest", "select doc_id, '{\"rid\":\"' || rid || '\",\"size_bytes\":' || n_chars || case when lang is null then '' else ',\"lang\":\"' || lang || '\"' end || '}' as manifest from memories", "memories")
def manifest(v: Views) -> DataFrame:
    return v.memories.select("doc_id", F.to_json(F.struct("rid", F.col("n_chars").alias("size_bytes"), "lang")).alias("manifest"))


@query("stm_13_adapter_changes", "select seq, rid, case when before is null then 'NEW' else 'UPDATE' end as kind from (select seq, rid, hash, lag(hash) over (partition by rid order by seq) as before from log) t where before is null or before <> hash", "log")
def adapter(v: Views) -> DataFrame:
    """One change per event: NEW where the id is not cached, UPDATE where its hash differs from the cached one, nothing otherwise."""
    before = F.lag("hash").over(Window.partitionBy("rid").orderBy("seq"))
    x = v.log.select("seq", "rid", "hash").withColumn("before", before).where(F.col("before").isNull() | (F.col("before") != F.col("hash")))
    return x.select("seq", "rid", F.when(F.col("before").isNull(), "NEW").otherwise("UPDATE").alias("kind"))


@query("stm_14_retry_attempts", "select worker, max(retry_count) as attempts, arg_max(state, id) as last_state from jobs group by 1", "jobs")
def attempts(v: Views) -> DataFrame:
    return v.jobs.groupBy("worker").agg(F.max("retry_count").alias("attempts"), F.max_by("state", "id").alias("last_state"))


@query("stm_17_collection_loop", "select doc_id, 'orn:web.page:' || source || '/' || doc_id as rid, substr(sha256(text), 1, 16) as hash from documents where length(text) between 100 and 10000 and doc_id not in (select vec_id from embeddings)")
def collection(v: Views) -> DataFrame:
    cached = v.table("embeddings").select(F.col("vec_id").alias("doc_id"))
    d = v.table("documents").where("length(text) between 100 and 10000").join(cached, "doc_id", "left_anti")
    return d.select("doc_id", F.concat(F.lit("orn:web.page:"), "source", F.lit("/"), "doc_id").alias("rid"), F.substring(F.sha2("text", 256), 1, 16).alias("hash"))


@query("grf_07_edge_ids", "select n_nationkey, 'orn:net.edge:' || sha256(n_name || r_name || 'POLL') as edge from nation join region on r_regionkey = n_regionkey")
def edge_ids(v: Views) -> DataFrame:
    n = v.table("nation").join(v.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_nationkey", F.concat(F.lit("orn:net.edge:"), F.sha2(F.concat("n_name", "r_name", F.lit("POLL")), 256)).alias("edge"))


@query("dat_02_publication_date", "select page_id, coalesce(nullif(regexp_extract(html, 'published_time\" content=\"([0-9-]+)', 1), ''), '2024-01-31') as published, case when contains(html, 'published_time') then 0.9::double else 0.3::double end as confidence from pages")
def publication(v: Views) -> DataFrame:
    found = F.regexp_extract("html", 'published_time" content="([0-9-]+)', 1)
    return v.table("pages").select("page_id", F.coalesce(F.nullif(found, F.lit("")), F.lit("2024-01-31")).alias("published"), F.when(F.contains("html", F.lit("published_time")), 0.9).otherwise(0.3).alias("confidence"))


_RULE_SQL = "case when o_orderkey % 7 = 0 then null else 'FREQ=' || case o_orderkey % 3 when 0 then 'DAILY' when 1 then 'WEEKLY' else 'MONTHLY' end || case when o_orderkey % 2 = 0 then ';INTERVAL=' || (2 + o_orderkey % 4) else '' end || case when o_orderkey % 3 = 1 then ';BYDAY=MO,FR' else '' end end"


@query("dat_05_recurrence_text", f"select o_orderkey, concat_ws(' ', 'Repeats ' || lower(nullif(regexp_extract(rule, 'FREQ=([A-Z]+)', 1), '')), 'every ' || nullif(regexp_extract(rule, 'INTERVAL=([0-9]+)', 1), ''), 'on ' || nullif(regexp_extract(rule, 'BYDAY=([A-Z,]+)', 1), '')) as body from (select o_orderkey, {_RULE_SQL} as rule from orders) s")
def recurrence(v: Views) -> DataFrame:
    """Calendar rules in words, one rule an order."""
    k = F.col("o_orderkey")
    freq = F.when(k % 3 == 0, "DAILY").when(k % 3 == 1, "WEEKLY").otherwise("MONTHLY")
    rule = F.when(k % 7 != 0, F.concat(F.lit("FREQ="), freq, F.when(k % 2 == 0, F.concat(F.lit(";INTERVAL="), 2 + k % 4)).otherwise(""), F.when(k % 3 == 1, ";BYDAY=MO,FR").otherwise("")))
    part = lambda p: F.nullif(F.regexp_extract("rule", p, 1), F.lit(""))
    body = F.concat_ws(" ", F.concat(F.lit("Repeats "), F.lower(part("FREQ=([A-Z]+)"))), F.concat(F.lit("every "), part("INTERVAL=([0-9]+)")), F.concat(F.lit("on "), part("BYDAY=([A-Z,]+)")))
    return v.table("orders").select("o_orderkey", rule.alias("rule")).select("o_orderkey", body.alias("body"))
