"""Document preparation queries: filters, identifiers, redaction, tags, dates, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import documents as doc
from .registry import query
from .views import Views


def _values(v: Views, rows: list[tuple], schema: str) -> DataFrame:
    """A small in-code fixture: the driver's tables never hold these cases."""
    return v.spark.createDataFrame(rows, schema)


def _sql_values(rows: list[tuple]) -> str:
    lit = lambda x: "null" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)


@query("flt_01_keyword_filter", "select doc_id from documents where length(text) between 200 and 5000 and (contains(lower(text), 'tion') or contains(lower(text), 'ing')) and not contains(lower(text), 'heit')")
def keyword(v: Views) -> DataFrame:
    low = F.lower("text")
    return v.table("documents").where(F.length("text").between(200, 5000) & (F.contains(low, F.lit("tion")) | F.contains(low, F.lit("ing"))) & ~F.contains(low, F.lit("heit"))).select("doc_id")


@query("flt_02_active_documents", "select doc_id from memories where not superseded and not is_chunk and length(text) > 500", "memories")
def active(v: Views) -> DataFrame:
    return v.memories.where("not superseded and not is_chunk and length(text) > 500").select("doc_id")


@query("flt_03_ilike", "select doc_id from memories where text ilike '%THE and%' or rid ilike '%SRC7/%'", "memories")
def ilike(v: Views) -> DataFrame:
    return v.memories.where(F.col("text").ilike("%THE and%") | F.col("rid").ilike("%SRC7/%")).select("doc_id")


@query("flt_10_min_confidence", "select extraction_rid, confidence from extractions where confidence >= 80", "extractions")
def min_confidence(v: Views) -> DataFrame:
    return v.extractions.where("confidence >= 80").select("extraction_rid", "confidence")


@query("flt_14_article_url", "select page_id from pages where regexp_matches(url, '^https?://[^/]+/[a-z]{2}/[0-9]+') and not contains(url, '.html')")
def article_url(v: Views) -> DataFrame:
    return v.table("pages").where(F.col("url").rlike("^https?://[^/]+/[a-z]{2}/[0-9]+") & ~F.contains("url", F.lit(".html"))).select("page_id")


@query("flt_15_skip_rules", "select conv_id, turn from turns where length(text) >= 50 and length(text) <= 1500 and role <> 'system' and turn < 6", "turns")
def skip_rules(v: Views) -> DataFrame:
    return v.turns.where("length(text) >= 50 and length(text) <= 1500 and role <> 'system' and turn < 6").select("conv_id", "turn")


@query("flt_16_first_route", "select doc_id, case when contains(source || ' ' || lang, 'src1') then 'alpha' when contains(source || ' ' || lang, 'fr') then 'beta' when contains(source || ' ' || lang, 'src') then 'gamma' end as route from documents")
def route(v: Views) -> DataFrame:
    """First matching route wins: the ordered routes are one expression, so no row moves."""
    subject, found = F.concat_ws(" ", "source", "lang"), F
    for pattern, name in (("src1", "alpha"), ("fr", "beta"), ("src", "gamma")):
        found = found.when(F.contains(subject, F.lit(pattern)), name)
    return v.table("documents").select("doc_id", found.alias("route"))


@query("flt_17_quality_filter", "select doc_id, e as entity from extractions, unnest(entities) as u(e) where length(e) between 4 and 12 and regexp_matches(e, '^[A-Z][a-z]+$') and lower(e) not in ('the', 'that', 'this', 'with')", "extractions")
def quality(v: Views) -> DataFrame:
    e = v.extractions.select("doc_id", F.explode("entities").alias("entity"))
    return e.where(F.length("entity").between(4, 12) & F.col("entity").rlike("^[A-Z][a-z]+$") & ~F.lower("entity").isin("the", "that", "this", "with"))


@query("flt_19_deny_list", "select distinct e as entity from extractions, unnest(entities) as u(e) where length(e) >= 2 and e not in (select n_name from nation) and e not in ('Th', 'An')", "extractions")
def deny(v: Views) -> DataFrame:
    denied = v.table("nation").select(F.col("n_name").alias("entity")).union(_values(v, [("Th",), ("An",)], "entity string"))
    return v.extractions.select(F.explode("entities").alias("entity")).where(F.length("entity") >= 2).distinct().join(denied, "entity", "left_anti")


@query("flt_20_person_name", "select s_suppkey, regexp_matches(s_name, '^[A-Z][a-z]+ [A-Z][a-z]+$') as valid from supplier")
def person(v: Views) -> DataFrame:
    return v.table("supplier").select("s_suppkey", F.col("s_name").rlike("^[A-Z][a-z]+ [A-Z][a-z]+$").alias("valid"))


@query("flt_21_navigation_context", "select doc_id, regexp_matches(substr(text, greatest(1, strpos(text, 'tion') - 50), 104), '[.]') as nav from documents where strpos(text, 'tion') > 0")
def navigation(v: Views) -> DataFrame:
    at = F.locate("tion", F.col("text"))
    around = F.substring(F.col("text"), F.greatest(F.lit(1), at - 50), F.lit(104))
    return v.table("documents").where(at > 0).select("doc_id", F.contains(around, F.lit(".")).alias("nav"))


@query("flt_22_eligible", "select doc_id from documents left join labels using (doc_id) where quality is null or n_chars > 3000 order by doc_id limit 100")
def eligible(v: Views) -> DataFrame:
    d = v.table("documents").select("doc_id", "n_chars").join(v.table("labels").select("doc_id", "quality"), "doc_id", "left")
    return d.where("quality is null or n_chars > 3000").select("doc_id").orderBy("doc_id").limit(100)


@query("prj_01_json_fields", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_fields(v: Views) -> DataFrame:
    return v.table("events").select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


@query("prj_02_metadata_passthrough", "select doc_id, array_to_string(list_filter([case when lang is not null then 'lang=' || lang end, case when n_chars > 1000 then 'long=true' end], lambda x: x is not null), ';') as metadata from documents")
def metadata(v: Views) -> DataFrame:
    pairs = F.array_compact(F.array(F.concat(F.lit("lang="), "lang"), F.when(F.col("n_chars") > 1000, "long=true")))
    return v.table("documents").select("doc_id", F.array_join(pairs, ";").alias("metadata"))


@query("prj_03_wire_events", "select seq, '{\"rid\":\"' || rid || '\",\"event_type\":\"' || event_type || '\",\"hash\":\"' || hash || '\"}' as wire from log", "log")
def wire(v: Views) -> DataFrame:
    return v.log.select("seq", F.to_json(F.struct("rid", "event_type", "hash")).alias("wire"))


@query("str_03_document_rid", "select doc_id, case lang when 'en' then 'orn:web.page:' || source || '/' || doc_id when 'fr' then 'orn:forum.topic:' || doc_id else 'orn:document:' || lang || '/' || doc_id end as rid from documents")
def document_rid(v: Views) -> DataFrame:
    d = F.col("doc_id")
    rid = F.when(F.col("lang") == "en", F.concat(F.lit("orn:web.page:"), "source", F.lit("/"), d)).when(F.col("lang") == "fr", F.concat(F.lit("orn:forum.topic:"), d)).otherwise(F.concat(F.lit("orn:document:"), "lang", F.lit("/"), d))
    return v.table("documents").select("doc_id", rid.alias("rid"))


@query("str_04_hashed_rid", "select page_id, 'orn:web.page:' || substr(sha256(url), 1, 16) as rid from pages")
def hashed_rid(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", t.hashed_id("orn:web.page:", F.col("url")).alias("rid"))


@query("str_05_entity_rid", "select p_partkey, 'part:entity:' || lower(p_brand) || ':' || regexp_replace(substr(replace(lower(p_name), ' ', '-'), 1, 50), '[^a-z0-9\\-_]', '', 'g') || ':' || lpad(cast(p_partkey % 1000 as varchar), 3, '0') as rid from part")
def entity_rid(v: Views) -> DataFrame:
    return v.table("part").select("p_partkey", F.concat(F.lit("part:entity:"), F.lower("p_brand"), F.lit(":"), t.slug(F.col("p_name")), F.lit(":"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("rid"))


@query("str_06_kg_rid_parse", "select extraction_rid, split_part(extraction_rid, ':kg:', 1) as parent, len(string_split(extraction_rid, ':kg:')) = 2 as valid from extractions", "extractions")
def kg_rid(v: Views) -> DataFrame:
    parts = F.split("extraction_rid", ":kg:")
    return v.extractions.select("extraction_rid", parts[0].alias("parent"), (F.size(parts) == 2).alias("valid"))


@query("str_07_rid_chain", "select extraction_rid, extraction_rid like memory_rid || ':kg:%:v%' as valid from extractions", "extractions")
def rid_chain(v: Views) -> DataFrame:
    return v.extractions.select("extraction_rid", F.like("extraction_rid", F.concat("memory_rid", F.lit(":kg:%:v%"))).alias("valid"))


@query("str_08_html_to_text", r"""select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g')) as plain from pages""")
def html_to_text(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", t.strip_tags(F.col("html")).alias("plain"))


@query("str_09_html_links", r"""select page_id, regexp_replace(html, '<a href="([^"]*)">([^<]*)</a>', '\2 (\1)', 'g') as linked from pages""")
def html_links(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", F.regexp_replace("html", '<a href="([^"]*)">([^<]*)</a>', "$2 ($1)").alias("linked"))


@query("str_10_main_content")
def main_content(v: Views) -> DataFrame:
    return doc.page_texts(v.table("pages"), "page_id", "html")


_URLS = [("https://a.example/x?utm_source=f&q=1#top",), ("https://a.example/",), ("http://b.example/p?ref=x",), ("https://c.example/p?b=2&utm_medium=m&c=3",)]


@query("str_11_clean_url", f"""select url, regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '/$', '') || case when k <> '' then '?' || k else '' end as clean from (select url, array_to_string(list_filter(string_split(split_part(split_part(url, '#', 1), '?', 2), '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid|ref|mc_cid|mc_eid)=')), '&') as k from (select url from pages union all values {_sql_values(_URLS)}) p) q""")
def clean(v: Views) -> DataFrame:
    return v.table("pages").select("url").union(_values(v, _URLS, "url string")).select("url", t.clean_url(F.col("url")).alias("clean"))


@query("str_12_internal_links", r"""select page_id, list_sort(list_distinct(list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda h: h like '/%' and not regexp_matches(h, '[?#]|[.](pdf|png|jpg|zip)$')))) [1:50] as l, len(l) as n from pages""".replace("[1:50] as l, len(l) as n", "as l").replace("select page_id, list_sort", "select page_id, array_to_string(list_sort").replace("as l from", ", ' ') as links from"))
def internal(v: Views) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    kept = F.filter(found, lambda h: F.startswith(h, F.lit("/")) & ~h.rlike(r"[?#]|[.](pdf|png|jpg|zip)$"))
    return v.table("pages").select("page_id", F.array_join(F.array_sort(F.array_distinct(kept)), " ").alias("links"))


#: The four rules in DuckDB's dialect, white space spelled out.
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_PERSONAL_RULES = (
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[REDACTED_EMAIL]"),
    (r"(?i)(?:(?:https?://)?(?:t\.me|telegram\.me)/|@)[A-Za-z0-9_]{5,32}", "[REDACTED_TELEGRAM]"),
    (rf"(?:\+\p{{Nd}}{{1,3}}(?:[-.]|{_SPACES})?)?\(?\p{{Nd}}{{3}}\)?(?:[-.]|{_SPACES})?\p{{Nd}}{{3}}(?:[-.]|{_SPACES})?\p{{Nd}}{{4}}", "[REDACTED_PHONE]"),
    (r"\b[A-Za-z0-9_]+#\p{Nd}{4}\b", "[REDACTED_DISCORD]"),
)
_PERSONAL = "text"
for _rule, _mark in _PERSONAL_RULES:
    _PERSONAL = f"regexp_replace({_PERSONAL}, '{_rule}', '{_mark}', 'g')"


@query("str_13_redact_personal", f"select doc_id, md5({_PERSONAL}) as redacted from documents")
def redact(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.md5(t.redact(F.col("text"))).alias("redacted"))


#: The eight rules in DuckDB's dialect: white space spelled out, word starts as a group in front.
_SP = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_START = r"(^|[^\p{L}\p{N}\p{M}_])"
_SECRET_RULES = (
    (rf"""{_START}[A-Z_]{{2,}}=(?:"[^"]*"|''[^'']*''|[^{_SP}]+)""", r"\1[REDACTED_ENV]"),
    (rf"{_START}(?:sk-[a-zA-Z0-9]{{20,}}|ghp_[a-zA-Z0-9]{{20,}}|ghu_[a-zA-Z0-9]{{20,}}|github_pat_[a-zA-Z0-9_]{{20,}})", r"\1[REDACTED_KEY]"),
    (rf"Bearer[{_SP}]+[a-zA-Z0-9._\-]{{20,}}", "Bearer [REDACTED]"),
    (r"-----BEGIN[A-Z ]*PRIVATE KEY-----(?s:.*?)-----END[A-Z ]*PRIVATE KEY-----", "[REDACTED_PRIVATE_KEY]"),
    (rf"(?:postgresql|postgres|mongodb|mysql|redis)://[^{_SP}]+", "[REDACTED_CONN_STRING]"),
    (rf"https?://[^:]+:[^@]+@[^{_SP}]+", "[REDACTED_URL_CREDS]"),
    (r"[A-Za-z0-9+/]{50,}={0,2}", "[REDACTED_BASE64]"),
    (rf"[^{_SP}]*(?:\.env|credentials|secrets|\.pem|\.key)[^{_SP}]*", "[REDACTED_PATH]"),
)
_REDACTED = "text"
for _rule, _mark in _SECRET_RULES:
    _REDACTED = f"regexp_replace({_REDACTED}, '{_rule}', '{_mark}', 'g')"


@query("str_14_redact_secrets", f"select doc_id, {_REDACTED} as clean from documents")
def secrets(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", t.redact_secrets(F.col("text")).alias("clean"))


@query("str_15_auto_tags", "select doc_id, array_to_string(list_sort(list_filter([case when contains(lower(text), 'tion') or contains(lower(text), 'ment') then 'action' end, case when contains(lower(text), 'heit') then 'state' end, case when contains(lower(text), 'ing') then 'process' end], lambda x: x is not null)), ',') as tags from documents")
def auto_tags(v: Views) -> DataFrame:
    found = t.tags(F.col("text"), {"action": ("tion", "ment"), "state": ("heit",), "process": ("ing",)})
    return v.table("documents").select("doc_id", F.array_join(found, ",").alias("tags"))


@query("str_16_count_parse", """
select doc_id, c, case when c like '%K' then cast(trunc(round(cast(replace(c, 'K', '') as double) * 1000, 3)) as bigint) when c like '%M' then cast(trunc(round(cast(replace(c, 'M', '') as double) * 1000000, 3)) as bigint)
 else coalesce(try_cast(replace(c, ',', '') as bigint), 0) end as n
from (select doc_id, case doc_id % 6 when 0 then cast(n_chars as varchar) when 1 then (n_chars // 100) // 10 || '.' || (n_chars // 100) % 10 || 'K' when 2 then n_chars // 1000 || 'M'
 when 3 then (n_chars + 1000) // 1000 || ',' || lpad(cast(n_chars % 1000 as varchar), 3, '0') when 4 then '' end as c from documents) t""")
def counts(v: Views) -> DataFrame:
    c = F.col("c")
    scaled = lambda mark, by: F.round(F.replace(c, F.lit(mark), F.lit("")).cast("double") * by, 3).cast("long")
    n = F.when(F.endswith(c, F.lit("K")), scaled("K", 1000)).when(F.endswith(c, F.lit("M")), scaled("M", 1_000_000)).otherwise(F.coalesce(F.replace(c, F.lit(","), F.lit("")).try_cast("long"), F.lit(0)))
    n_chars = F.col("n_chars")
    tenth = F.expr("n_chars div 100")
    written = F.when(F.col("doc_id") % 6 == 0, n_chars.cast("string")).when(F.col("doc_id") % 6 == 1, F.concat(F.expr("(n_chars div 100) div 10"), F.lit("."), tenth % 10, F.lit("K")))
    written = written.when(F.col("doc_id") % 6 == 2, F.concat(F.expr("n_chars div 1000"), F.lit("M"))).when(F.col("doc_id") % 6 == 3, F.concat(F.expr("(n_chars + 1000) div 1000"), F.lit(","), F.lpad((n_chars % 1000).cast("string"), 3, "0")))
    written = written.when(F.col("doc_id") % 6 == 4, "")
    return v.table("documents").select("doc_id", written.alias("c")).select("doc_id", "c", n.alias("n"))


@query("str_17_domain_organisation", "select page_id, split_part(regexp_extract(url, '://([^/]+)', 1), '.', -2) as organisation from pages")
def organisation(v: Views) -> DataFrame:
    host = F.regexp_extract("url", "://([^/]+)", 1)
    return v.table("pages").select("page_id", F.split_part(host, F.lit("."), F.lit(-2)).alias("organisation"))


@query("str_18_labels_and_uris", "select p_partkey, trim(lower(p_name)) as label, 'urn:' || replace(p_name, ' ', '_') as uri, replace(p_name, '\"', '\\\"') as literal from part")
def labels(v: Views) -> DataFrame:
    n = F.col("p_name")
    return v.table("part").select("p_partkey", F.trim(F.lower(n)).alias("label"), F.concat(F.lit("urn:"), F.replace(n, F.lit(" "), F.lit("_"))).alias("uri"), F.replace(n, F.lit('"'), F.lit('\\"')).alias("literal"))


_STYLE_SQL = r"""
with d as (select doc_id, case doc_id % 5 when 0 then translate(substr(text, 1, 300), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') when 1 then text || ' !!! It might be so????' when 2 then text || ' possibly announced, lol' when 3 then text || ' confirmed and verified....' else text end as text from documents),
 c as (select doc_id, text, case when length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 10 and length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 0.3
   then array_to_string(list_transform(list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda w: w <> ''), lambda w: case when length(w) > 3 and not regexp_matches(w, '\p{Ll}') and regexp_matches(w, '\p{Lu}') and not starts_with(w, '#') then substr(w, 1, 1) || lower(substr(w, 2)) else w end), ' ') else text end as calm from d),
 q as (select doc_id, text, calm, regexp_replace(regexp_replace(regexp_replace(calm, '!{3,}', '!', 'g'), '\?{3,}', '?', 'g'), '\.{4,}', '...', 'g') as quiet from c),
 r as (select *, case when contains(lower(quiet), 'might be') or contains(lower(quiet), 'could be') then regexp_replace(quiet, '(?i)\b(might|could)\s+be\b', 'is', 'g') else quiet end as one from q),
 t as (select *, case when contains(lower(quiet), 'possibly') then trim(regexp_replace(regexp_replace(one, '(?i)\bpossibly\b', '', 'g'), '[ \t\n\r\f]+', ' ', 'g')) else one end as two from r),
 u as (select *, case when contains(lower(quiet), 'potentially') then trim(regexp_replace(regexp_replace(two, '(?i)\bpotentially\b', '', 'g'), '[ \t\n\r\f]+', ' ', 'g')) else two end as content from t),
 m as (select *, len(list_filter(['announced', 'confirmed', 'launched', 'released', 'published', 'verified', 'documented', 'recorded', 'achieved', 'completed', 'established', 'implemented'], lambda w: contains(lower(content), w))) as marks,
   len(list_filter(['\b(lol|omg|wtf|tbh|imo|imho)\b', '\b(gonna|wanna|gotta|kinda|sorta)\b', '\b(awesome|amazing|incredible|unbelievable)\b'], lambda p: regexp_matches(lower(content), p))) as informal from u)
select doc_id, md5(content) as content, greatest(0.0::double, round(1 - (case when calm <> text then 0.1 else 0 end + case when quiet <> calm then 0.1 else 0 end + 0.2 * len(list_filter(['might be', 'could be', 'possibly', 'potentially'], lambda p: contains(lower(quiet), p)))
  + case when round(greatest(0, case when marks > 0 then least(1.0, marks * 0.3) else 0.5 end - informal * 0.2), 6) < 0.5 then 0.2 else 0 end)::double, 6)) as score from m where length(text) > 0"""


@query("str_19_style_rules", _STYLE_SQL)
def style(v: Views) -> DataFrame:
    """All style rules with their points over whole texts, some of them made to break each rule."""
    k, x = F.col("doc_id") % 5, F.col("text")
    made = F.when(k == 0, F.translate(F.substring(x, 1, 300), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(k == 1, F.concat(x, F.lit(" !!! It might be so????"))).when(k == 2, F.concat(x, F.lit(" possibly announced, lol"))).when(k == 3, F.concat(x, F.lit(" confirmed and verified...."))).otherwise(x)
    d = v.table("documents").select("doc_id", made.alias("text")).where(F.length("text") > 0)
    return d.select("doc_id", t.styled(F.col("text")).alias("s")).select("doc_id", F.md5("s.content").alias("content"), "s.score")


@query("str_20_post_compose", r"select doc_id, case when length(text) <= 280 then text else regexp_replace(substr(text, 1, 277), '\s+\S*\z', '') || '...' end as post from documents")
def compose(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.when(F.length("text") <= 280, F.col("text")).otherwise(F.concat(F.regexp_replace(F.substring("text", 1, 277), r"\s+\S*\z", ""), F.lit("..."))).alias("post"))


@query("str_22_negation", """
with pairs as (select c.conv_id, c.turn, c.text as a, case when c.turn % 2 = 0 then replace(p.text, ' ', ' not ') else p.text end as b from turns c join turns p on p.conv_id = c.conv_id and p.turn = c.turn - 1),
 plain as (select conv_id, turn, a, b, string_split(replace(a, 'not ', ''), ' ') as x, string_split(replace(b, 'not ', ''), ' ') as y from pairs)
select conv_id, turn, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) as similarity, contains(a, 'not ') <> contains(b, 'not ') as opposed from plain""", "turns")
def negation(v: Views) -> DataFrame:
    """Each message against the one before it (every other one negated throughout): likeness without "not", and whether one negates."""
    words = lambda c: F.split(F.replace(F.col(c), F.lit("not "), F.lit("")), " ")
    has = lambda c: F.contains(c, F.lit("not "))
    before = v.turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("before"))
    pairs = v.turns.join(before, ["conv_id", "turn"]).select("conv_id", "turn", F.col("text").alias("a"), F.when(F.col("turn") % 2 == 0, F.replace("before", F.lit(" "), F.lit(" not "))).otherwise(F.col("before")).alias("b"))
    return pairs.select("conv_id", "turn", F.round(t.jaccard(words("a"), words("b")), 6).alias("similarity"), (has("a") != has("b")).alias("opposed"))


@query("str_23_reply_fences", r"""
select event_id, coalesce(try_cast(json_extract_string(nullif(regexp_extract(reply, '(\{[^}]*\})', 1), ''), '$.k') as bigint), 0) as k
from (select event_id, case event_id % 3 when 0 then '```json' || chr(10) || props || chr(10) || '```' when 1 then 'Here: ' || props else replace(props, '{', '') end as reply from events) t""")
def fences(v: Views) -> DataFrame:
    """The value in a model's reply: JSON in a fence, JSON after words, or none."""
    e = F.col("event_id") % 3
    reply = F.when(e == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(e == 1, F.concat(F.lit("Here: "), "props")).otherwise(F.replace("props", F.lit("{"), F.lit("")))
    body = F.regexp_extract("reply", r"(\{[^}]*\})", 1)
    return v.table("events").select("event_id", reply.alias("reply")).select("event_id", F.coalesce(F.from_json(body, "k long").getField("k"), F.lit(0)).alias("k"))


#: File name marks and their categories, in the order they are tried.
_CATEGORIES = (("blog.", "blog"), ("/en/", "english"), ("/de/", "german"), ("/fr/", "french"), ("forum", "forum"), ("docs", "documentation"), (".html", "file"))


@query("str_24_taxonomy", "select page_id, case " + " ".join(f"when contains(lower(url), '{m}') then '{c}'" for m, c in _CATEGORIES) + " else 'other' end as category from pages")
def taxonomy(v: Views) -> DataFrame:
    """Eight categories, the first that matches."""
    low, out = F.lower("url"), F
    for mark, category in _CATEGORIES:
        out = out.when(F.contains(low, F.lit(mark)), category)
    return v.table("pages").select("page_id", out.otherwise("other").alias("category"))


@query("str_25_name_variations", "select n_nationkey, case n_name when 'NATION_1' then 'First' when 'NATION_2' then 'Second' else n_name end as name from nation")
def variations(v: Views) -> DataFrame:
    names = F.create_map(F.lit("NATION_1"), F.lit("First"), F.lit("NATION_2"), F.lit("Second"))
    return v.table("nation").select("n_nationkey", F.coalesce(F.try_element_at(names, F.col("n_name")), F.col("n_name")).alias("name"))


@query("dat_01_zulu", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' as stamp from events")
def zulu(v: Views) -> DataFrame:
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return v.table("events").select("event_id", F.regexp_replace(text, r"\+00:00$", "Z").alias("stamp"))


@query("dat_03_feed_dates", "select event_id, case event_id % 4 when 2 then strftime(ts, '%Y-%m-%d 00:00:00') when 3 then null else strftime(ts, '%Y-%m-%d %H:%M:%S') end as parsed from events")
def feed_dates(v: Views) -> DataFrame:
    """Dates as feeds write them (mail style, ISO with an offset of one hour, days, words), read back in UTC."""
    e = F.col("event_id") % 4
    ts = F.date_trunc("second", F.col("ts").cast("timestamp_ntz"))
    hour_on = F.date_format(ts + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss")
    written = F.when(e == 0, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))).when(e == 1, F.concat(hour_on, F.lit("+01:00"))).when(e == 2, F.date_format(ts, "yyyy-MM-dd")).otherwise("soon")
    return v.table("events").select("event_id", written.alias("text")).select("event_id", F.date_format(doc.parse_date(F.col("text")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("mth_01_cosine", "select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as similarity from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def cosine(v: Views) -> DataFrame:
    e = v.table("embeddings").select("vec_id", "embedding")
    return e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id").select("vec_id", F.round(t.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query("arr_01_tags", "select conv_id, array_to_string(list_sort(list_distinct(list(role))), ',') as tags from turns group by 1", "turns")
def tag_arrays(v: Views) -> DataFrame:
    return v.turns.groupBy("conv_id").agg(F.array_join(F.slice(F.array_sort(F.collect_set("role")), 1, 100), ",").alias("tags"))


@query("jsn_02_typed_properties", """
select event_id, kind, case kind when 'title' then 't' || k when 'rich_text' then 'r' || k when 'number' then cast(k as varchar) when 'select' then 's' || k when 'multi_select' then 'm' || k || ', n' || k
 when 'status' then 'st' || k when 'date' then '2024-01-' || lpad(cast(1 + k % 28 as varchar), 2, '0') when 'people' then 'p' || k || ', q' when 'checkbox' then case when k % 2 = 0 then 'true' else 'false' end
 when 'url' then 'https://x.example/' || k when 'relation' then 'a' || k || ', rel' || k end as flat
from (select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, ['title', 'rich_text', 'number', 'select', 'multi_select', 'status', 'date', 'people', 'checkbox', 'url', 'email', 'phone_number', 'relation', 'formula'][event_id % 14 + 1] as kind from events) t""")
def properties(v: Views) -> DataFrame:
    """Typed properties as note pages carry them, one kind an event, flattened; mail addresses and telephone numbers are left out."""
    k = F.get_json_object("props", "$.k").cast("long")
    kinds = F.array(*map(F.lit, "title rich_text number select multi_select status date people checkbox url email phone_number relation formula".split()))
    named = lambda prefix: F.struct(F.concat(F.lit(prefix), k).alias("name"))
    plain = lambda prefix: F.array(F.struct(F.concat(F.lit(prefix), k).alias("plain_text")))
    kind = F.element_at(kinds, (F.col("event_id") % 14 + 1).cast("int"))
    value = F.to_json(
        F.struct(
            kind.alias("type"), plain("t").alias("title"), plain("r").alias("rich_text"), k.alias("number"), named("s").alias("select"), F.array(named("m"), named("n")).alias("multi_select"), named("st").alias("status"),
            F.struct(F.concat(F.lit("2024-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0")).alias("start")).alias("date"), F.array(F.struct(F.lit("2").alias("id"), F.lit("q").alias("name")), F.struct(F.lit("1").alias("id"), F.concat(F.lit("p"), k).alias("name"))).alias("people"), (k % 2 == 0).alias("checkbox"),
            F.concat(F.lit("https://x.example/"), k).alias("url"), F.concat(F.lit("e"), k, F.lit("@x.example")).alias("email"), F.concat(F.lit("+"), k).alias("phone_number"),
            F.array(*[F.struct(F.concat(F.lit(x), k).alias("id")) for x in ("rel", "a", "rel")]).alias("relation"),
        )
    )
    return v.table("events").select("event_id", value.alias("property")).select("event_id", F.get_json_object("property", "$.type").alias("kind"), doc.flatten_property(F.col("property")).alias("flat"))


@query("map_01_lookups", "select conv_id, turn, case role when 'user' then 'U' when 'assistant' then 'A' else '?' end as mark from turns", "turns")
def lookups(v: Views) -> DataFrame:
    marks = F.create_map(F.lit("user"), F.lit("U"), F.lit("assistant"), F.lit("A"))
    return v.turns.select("conv_id", "turn", F.coalesce(F.try_element_at(marks, F.col("role")), F.lit("?")).alias("mark"))


@query("chk_01_token_windows", r"""
with w as (select doc_id, list_filter(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), lambda x: x <> '') as tk from documents),
 n as (select doc_id, tk, greatest(0, cast(ceil((len(tk) - 500) / 450) as bigint)) as last from w where len(tk) > 0)
select doc_id, cast(i as integer) as index, i * 450 as start_token, least(i * 450 + 500, len(tk)) as end_token, last + 1 as total_chunks, md5(array_to_string(tk[i * 450 + 1 : i * 450 + 500], ' ')) as chunk from n, unnest(generate_series(0, last)) g(i)""")
def token_windows(v: Views) -> DataFrame:
    out = doc.token_windows(v.table("documents"), "doc_id", "text", 500, 50)
    return out.withColumn("chunk", F.md5("chunk"))


_SENTENCE_WALK = r"""tk as (select doc_id, list_filter(string_split_regex(coalesce({text}, ''), '\s+'), lambda x: x <> '') as t from documents), docs as (select *, len(t) as n from tk where len(t) > 0),
 ends as (select doc_id, list(i order by i) as e from (select doc_id, t, unnest(range(1, n + 1)) as i from docs) u where regexp_matches(t[i], '[.!?]["'')\]]*$') group by doc_id),
 walk(doc_id, k, a, b) as (select doc_id, 0, 0::bigint, 0::bigint from docs
  union all select doc_id, k + 1, a2, case when a2 + 500 < n then coalesce(list_max(list_filter(e, lambda x: x <= a2 + 500 and x >= a2 + 400)), a2 + 500) else n end
   from (select w.doc_id, w.k, d.n, e, case when w.k = 0 then 0 else greatest(w.b - 50, w.a + 1) end as a2, w.b from walk w join docs d using (doc_id) left join ends using (doc_id)) s where s.b < n),
 spans as (select *, lead(k) over (partition by doc_id order by k) as later, b - a < 100 and k > 1 as short, coalesce(lead(b - a) over (partition by doc_id order by k) < 100, false) as joins, lead(b) over (partition by doc_id order by k) as b2 from walk where k > 0),
 windows as (select doc_id, row_number() over (partition by doc_id order by k) - 1 as index, a as start_token, case when joins then b2 else b end as end_token from spans where not short)"""


@query("chk_02_sentence_windows", f"with recursive {_SENTENCE_WALK.replace('{text}', 'text')} select doc_id, index, start_token, end_token from windows")
def sentence_windows(v: Views) -> DataFrame:
    return doc.sentence_windows(v.table("documents"), "doc_id", "text").select("doc_id", "index", "start_token", "end_token")


@query("chk_03_char_windows", "select doc_id, cast(i as integer) as index, md5(substr(text, i * 900 + 1, 1000)) as chunk from (select * from documents where length(text) > 0) d, unnest(generate_series(0, (length(text) - 1) // 900)) g(i)")
def char_windows(v: Views) -> DataFrame:
    return doc.char_windows(v.table("documents"), "doc_id", "text", 1000, 100).withColumn("chunk", F.md5("chunk"))


@query("chk_04_turn_pair_chunks", "with t as (select *, lead(role) over w as nr, lead(text) over w as nt from turns window w as (partition by conv_id order by turn)) select conv_id, turn, md5(substr('User: ' || text || chr(10) || 'Assistant: ' || coalesce(nt, ''), 1, 8000)) as chunk from t where role = 'user' and nr = 'assistant' and (trim(text) <> '' or trim(nt) <> '')", "turns")
def pair_chunks(v: Views) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    p = v.turns.withColumn("nr", F.lead("role").over(w)).withColumn("nt", F.lead("text").over(w)).where("role = 'user' and nr = 'assistant' and (trim(text) <> '' or trim(nt) <> '')")
    chunk = F.concat(F.lit("User: "), "text", F.lit("\nAssistant: "), F.coalesce("nt", F.lit("")))
    return p.select("conv_id", "turn", F.md5(F.substring(chunk, 1, 8000)).alias("chunk"))


@query("emb_02_truncate_tokens", r"select doc_id, md5(case when len(string_split_regex(trim(text), '\s+')) <= 100 then text else array_to_string(string_split_regex(trim(text), '\s+')[1:100], ' ') end) as cut from documents")
def truncate(v: Views) -> DataFrame:
    words = F.split(F.trim("text"), r"\s+")
    return v.table("documents").select("doc_id", F.md5(F.when(F.size(words) <= 100, F.col("text")).otherwise(F.array_join(F.slice(words, 1, 100), " "))).alias("cut"))


@query("emb_03_missing_embeddings", "select doc_id from documents where doc_id not in (select vec_id from embeddings) order by doc_id limit 64")
def missing(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id").join(v.table("embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id", "left_anti").orderBy("doc_id").limit(64)


@query("src_01_crawl_frontier", "select distinct page_id from pages p where not exists (select 1 from documents d where d.doc_id = p.page_id * 2 and d.n_chars > 1000)")
def frontier(v: Views) -> DataFrame:
    done = v.table("documents").where("n_chars > 1000").select(F.col("doc_id").alias("k"))
    p = v.table("pages").select("page_id")
    return p.join(done, p.page_id * 2 == done.k, "left_anti").distinct()


@query("src_08_recent_activity", "select user_id, seq from (select user_id, seq, row_number() over (partition by user_id order by ts desc, seq desc) as n from log where ts >= timestamp '2024-01-24') t where n <= 10", "log")
def activity(v: Views) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("seq")))
    return v.log.where("ts >= timestamp_ntz'2024-01-24'").select("user_id", "seq", "ts").withColumn("n", n).where("n <= 10").select("user_id", "seq")


@query("src_11_common_schema", "select 'document' as source_type, cast(doc_id as varchar) as id, text as content, lang from documents union all select 'page', cast(page_id as varchar), null, null from pages union all select 'chat', conv_id || '/' || turn, text, null from conversations")
def common(v: Views) -> DataFrame:
    a = v.table("documents").select(F.lit("document").alias("source_type"), F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), "lang")
    b = v.table("pages").select(F.lit("page").alias("source_type"), F.col("page_id").cast("string").alias("id"))
    c = v.table("conversations").select(F.lit("chat").alias("source_type"), F.concat("conv_id", F.lit("/"), "turn").alias("id"), F.col("text").alias("content"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
