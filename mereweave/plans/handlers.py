"""Queries of the extension points: handlers in phases, adapters, extractors, sites and id types."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import handlers as h
from ..streaming import events as st
from .registry import query
from .views import Views

_CHAIN = h.Pipeline()


@_CHAIN.handler("rid")
def named(c) -> dict[str, Column]:
    """Rows without an id go no further."""
    return {"status": F.lit("named"), h.STOP: c("rid").isNull()}


@_CHAIN.handler("manifest", event_types=("FORGET",))
def forgotten(c) -> dict[str, Column]:
    return {"status": F.lit("forgotten"), h.STOP: F.lit(True)}


@_CHAIN.handler("bundle", namespaces=("user.state",))
def too_small(c) -> dict[str, Column]:
    return {"status": F.when(c("size_bytes") < 1000, "skipped").otherwise(c("status")), h.STOP: c("size_bytes") < 1000}


@_CHAIN.handler("bundle")
def sensor(c) -> dict[str, Column]:
    return {"sensor": t.sensor_base_name(c("source_node"))}


@_CHAIN.handler("network", event_types=("NEW",))
def announced(c) -> dict[str, Column]:
    return {"status": F.concat(F.lit("announced by "), c("sensor"))}


@_CHAIN.handler("final", namespaces=("nowhere",))
def never(c) -> dict[str, Column]:
    return {"status": F.lit("lost")}


@_CHAIN.handler("final")
def done(c) -> dict[str, Column]:
    return {"status": F.when(c("status") == "named", "done").otherwise(c("status"))}


_CHAIN_SQL = """
select seq, case when rid is null then 'named' when event_type = 'FORGET' then 'forgotten' when size_bytes < 1000 then 'skipped' when event_type = 'NEW' then 'announced by ' || kind || '-sensor' else 'done' end as status,
 case when rid is not null and event_type <> 'FORGET' and size_bytes >= 1000 then kind || '-sensor' end as sensor,
 case when rid is null then 'named' when event_type = 'FORGET' then 'forgotten' when size_bytes < 1000 then 'too_small' end as stopped_by from log"""


@query("udf_01_handler_chain", _CHAIN_SQL, "log")
def chain(v: Views) -> DataFrame:
    """Handlers of all five phases over the whole log, with namespace and event filters and STOP."""
    return _CHAIN.process(v.log).select("seq", "status", "sensor", "stopped_by")


@query("stm_01_five_phases", _CHAIN_SQL, "log")
def five_phases(v: Views) -> DataFrame:
    """The same chain on a stream of the landed log: no state, so each micro-batch is written as it comes."""
    from .streams import shared_base

    base = shared_base(v.spark)
    v.log.withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(4, "seq").write.parquet(f"{base}/log")
    stream = v.spark.readStream.schema(v.spark.read.parquet(f"{base}/log").schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/log")
    out = _CHAIN.process(stream).select("seq", "status", "sensor", "stopped_by")
    st.run_available(out, f"phases_{uuid.uuid4().hex}", f"{base}/checkpoint", sink=lambda df, n: df.write.mode("overwrite").parquet(f"{base}/out/batch={n}"))
    return v.spark.read.parquet(f"{base}/out").select("seq", "status", "sensor", "stopped_by")


class _Pages(h.Adapter):
    def __init__(self, v: Views):
        self.v = v

    def collect(self) -> DataFrame:
        return self.v.table("pages")

    def rid(self) -> Column:
        return t.hashed_id("orn:web.page:", F.col("url"))

    def content(self) -> Column:
        return t.strip_tags(F.col("html"))


@query("udf_02_source_adapter", r"""
select rid, sha256(content) as hash from (select 'orn:web.page:' || substr(sha256(url), 1, 16) as rid, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g')) as content from pages) p where length(trim(content)) > 0""")
def adapter(v: Views) -> DataFrame:
    return _Pages(v).documents().select("rid", "hash")


class _Capitals(h.Extractor):
    """Runs of two or more capitalised words."""

    def extract(self, text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit("[A-Z][a-z]+(?: [A-Z][a-z]+)+"), F.lit(0)))
        return F.transform(found, lambda x: F.struct(F.lit("name").alias("kind"), x.alias("value"), F.when(F.size(F.split(x, " ")) > 2, 0.9).otherwise(0.7).alias("confidence")))


@query("udf_03_extractor", "select doc_id, 'name' as kind, value, case when len(string_split(value, ' ')) > 2 then 0.9::double else 0.7::double end as confidence from (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+(?: [A-Z][a-z]+)+'))) as value from documents) e")
def extractor(v: Views) -> DataFrame:
    return _Capitals().apply(v.table("documents"), "doc_id", "text")


#: Pages as a forum and a plain site would serve them: the address tells the site and the kind, the markup is put in front.
_SITE_SQL = """select page_id, html, case page_id % 5 when 0 then 'https://forum.x.example/t/topic-' || page_id when 1 then 'https://forum.x.example/c/cat-' || page_id when 2 then 'https://forum.x.example/latest'
 when 3 then 'https://www.y.example/blog/' || page_id else 'https://www.y.example/docs/' || page_id || '/' end as url from pages"""
_FRONT = (
    '<a href="/t/a-1?page=2">1</a><a href="/t/a-1#x">2</a><a href="/c/b/latest">3</a><a href="/u/ann">4</a><a href="https://forum.x.example/c/b">5</a><a href="https://z.example/t/9">6</a><a href="mailto:a@b">7</a>'
    '<span class="reply-count"> 12 </span><a class="category-name" href="/c/b">Cat</a><a class="discourse-tag" href="/g/1">one</a><a class="discourse-tag" href="/g/2">two</a><div class="category-description"> What it is. </div><span class="creator">Ann</span>'
    '<div class="cooked"><p>Post &amp; more</p><blockquote>quoted</blockquote></div>'
)


def _sites(v: Views) -> tuple[DataFrame, list[h.Site], h.Site]:
    k, i = F.col("page_id") % 5, F.col("page_id")
    url = F.when(k == 0, F.concat(F.lit("https://forum.x.example/t/topic-"), i)).when(k == 1, F.concat(F.lit("https://forum.x.example/c/cat-"), i)).when(k == 2, "https://forum.x.example/latest")
    url = url.when(k == 3, F.concat(F.lit("https://www.y.example/blog/"), i)).otherwise(F.concat(F.lit("https://www.y.example/docs/"), i, F.lit("/")))
    return v.table("pages").select("page_id", F.concat(F.lit(_FRONT), "html").alias("html"), url.alias("url")), [h.Forum("forum.x.example")], h.Site("www.y.example")


@query("udf_04_site_content_types", f"select page_id, ['forum_topic', 'forum_category', 'forum_index', 'article', 'documentation'][page_id % 5 + 1] as content_type from ({_SITE_SQL}) p")
def site_types(v: Views) -> DataFrame:
    pages, sites, default = _sites(v)
    return pages.select("page_id", h.by_site(sites, F.col("url"), lambda s: s.content_type(F.col("url")), default).alias("content_type"))


@query("str_28_links_to_follow", f"""
select page_id, array_to_string(list_sort(list_distinct(case when page_id % 5 <= 2 then ['https://forum.x.example/t/a-1', 'https://forum.x.example/c/b'] || own_forum else ['https://www.y.example/t/a-1?page=2', 'https://www.y.example/t/a-1#x', 'https://www.y.example/c/b/latest', 'https://www.y.example/u/ann', 'https://www.y.example/c/b', 'https://www.y.example/g/1', 'https://www.y.example/g/2'] || own_plain end)), ' ') as links
from (select page_id, list_transform(list_filter(hrefs, lambda x: starts_with(x, '/')), lambda x: 'https://www.y.example' || x) || list_filter(hrefs, lambda x: regexp_matches(x, '^https?://') and contains(x, 'www.y.example')) as own_plain,
  list_filter(list_transform(list_filter(hrefs, lambda x: starts_with(x, '/') and not regexp_matches(x, '/u/|/users/|/login|/signup|/password-reset')), lambda x: 'https://forum.x.example' || x), lambda x: contains(x, '/t/') or (contains(x, '/c/') and not contains(x, '/latest'))) as own_forum
 from (select page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1) as hrefs from ({_SITE_SQL}) p) q) r""")
def site_links(v: Views) -> DataFrame:
    """Links to follow by site: a forum's topics and categories without pages and anchors, elsewhere all of the domain."""
    pages, sites, default = _sites(v)
    links = h.by_site(sites, F.col("url"), lambda s: s.links(F.col("html")), default)
    return pages.select("page_id", F.array_join(F.array_sort(F.array_distinct(links)), " ").alias("links"))


@query("str_29_site_metadata", f"""
select page_id, case page_id % 5 when 0 then 'author=Ann;category=Cat;content_type=forum_topic;reply_count=12;tags=one,two' when 1 then 'author=Ann;content_type=forum_category;description=What it is.' when 2 then 'author=Ann;content_type=forum_index' else '' end as metadata,
 case page_id % 5 when 0 then 'Post & more' when 1 then 'What it is.' end as body from ({_SITE_SQL}) p""")
def site_metadata(v: Views) -> DataFrame:
    pages, sites, default = _sites(v)
    url, html = F.col("url"), F.col("html")
    entries = F.map_entries(h.by_site(sites, url, lambda s: s.metadata(html, url), default))
    joined = F.array_join(F.array_sort(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    body = F.when(F.col("page_id") % 5 < 2, h.by_site(sites, url, lambda s: s.text(html, url), default))
    return pages.select("page_id", joined.alias("metadata"), body.alias("body"))


@query("udf_05_id_types", "select doc_id, kind, made from (select doc_id, case doc_id % 3 when 0 then 'web page' when 1 then 'memo' end as kind, case doc_id % 3 when 0 then 'orn:web.page:' || source || '/' || doc_id when 1 then 'orn:memo:' || source || '/' || doc_id end as made from documents) t")
def id_types(v: Views) -> DataFrame:
    """Kinds by the registry, with one type added; ids of an unknown namespace have none and are not made."""
    types = h.IdTypes()
    types.register("memo", "memo")
    k = F.col("doc_id") % 3
    made = F.when(k == 0, types.create("web.page", F.col("source"), F.col("doc_id"))).when(k == 1, types.create("memo", F.col("source"), F.col("doc_id"))).otherwise(types.create("other", F.col("source")))
    return v.table("documents").select("doc_id", made.alias("made"), F.coalesce(made, F.lit("orn:other:1")).alias("rid")).select("doc_id", types.kind(F.col("rid")).alias("kind"), "made")
