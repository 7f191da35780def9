"""Every page as one of three kinds of sites, twelve kinds of addresses, with a block of the site's marks in front."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import handlers as h
from ..operators import sites as s
from .registry import query
from .views import Views

_URLS = (
    "https://www.news.example/news/a", "https://news.example/grants/b", "https://news.example/team/c", "https://news.example/about/", "https://docs.portal.example/d", "https://guides.portal.example/e/", "https://registry.portal.example/project/f", "https://portal.example/blog/g",
    "https://meet.example/weekly-meetups/h", "https://meet.example/projects/i", "https://meet.example/reports/j", "https://portal.example/",
)
_FRONT = (
    '<span class="big category">Cat</span><h1 class="project-name">Soil Grant</h1><p>Up to $1,200.50. Application Deadline: May 5, 2024</p><div class="team-member"><h3>Ann Lee</h3>x</div><div class="x bio"><strong>Bob</strong></div><span class="author"> Ann </span>'
    '<ul class="tag-list"><li>one</li><li>two</li></ul><span class="version">v2</span><nav class="breadcrumb"><a href="/x">Home</a><a href="/y">Guides</a></nav><span class="credit-class">C01</span><div class="post-tags"><a class="tag" href="/t/1">red</a><span>no</span></div>'
    '<p>Attendees: Ann Lee, Bob Stone and Ann Lee</p><b>Status: open</b><a href="rel">r</a><a href="#top">t</a><a href="/f.pdf">f</a><a href="/login">l</a><a href="https://news.example/q?x=1#y">q</a><a href="https://docs.portal.example/z">z</a><a href="/members/m">m</a><a href="https://meet.example/projects/p#k">p</a><a href="https://far.example/">far</a>'
)
_OWN_SQL = f"own as (select page_id, page_id % 12 as k, [{', '.join(repr(u) for u in _URLS)}][page_id % 12 + 1] as url, '{_FRONT}' || coalesce(html, '') as html from pages)"


def _own(v: Views) -> tuple[DataFrame, list[h.Site], h.Site]:
    url = F.element_at(F.array(*map(F.lit, _URLS)), (F.col("page_id") % 12 + 1).cast("int"))
    sites = [s.NewsSite("news.example"), s.PortalSite("portal.example"), s.MeetingSite("meet.example", "weekly_numbers")]
    return v.table("pages").select("page_id", url.alias("url"), F.concat(F.lit(_FRONT), F.coalesce("html", F.lit(""))).alias("html")), sites, h.Site("other.example")


_TYPES = ("news", "grant_program", "team", "about", "documentation", "guide", "registry_project", "blog_post", "meeting", "project", "report", "index")


@query("udf_04_sites", f"with {_OWN_SQL} select page_id, [{', '.join(repr(x) for x in _TYPES)}][k + 1] as content_type, k <> 11 as wanted from own")
def site_types(v: Views) -> DataFrame:
    """Kinds of pages by site, and whether their content is wanted."""
    own, sites, default = _own(v)
    u = F.col("url")
    return own.select("page_id", h.by_site(sites, u, lambda x: x.content_type(u), default).alias("content_type"), h.by_site(sites, u, lambda x: x.wanted(u), default).alias("wanted"))


_METADATA = (
    "author=Ann;category=Cat;content_type=news;tags=one,two", "application_deadline=May 5, 2024;author=Ann;content_type=grant_program;grant_amount=$1,200.50;grant_name=Soil Grant;tags=one,two", "author=Ann;content_type=organizational;tags=one,two;team_members=Ann Lee,Bob",
    "author=Ann;content_type=organizational;tags=one,two", "content_type=documentation;version=v2", "category=Guides;content_type=guide", "content_type=registry_project;credit_class=C01;project_name=Soil Grant", "author=Ann;content_type=blog_post;tags=red",
    "attendees=Ann Lee,Bob Stone;content_type=meeting;meeting_type=weekly_numbers", "content_type=project;project_status=open", "content_type=report", "content_type=page",
)


@query("str_29_metadata_of_sites", f"with {_OWN_SQL} select page_id, [{', '.join(repr(x) for x in _METADATA)}][k + 1] as metadata from own")
def site_metadata(v: Views) -> DataFrame:
    own, sites, default = _own(v)
    u, html = F.col("url"), F.col("html")
    found = F.map_entries(h.by_site(sites, u, lambda x: x.metadata(html, u), default))
    return own.select("page_id", F.array_join(F.array_sort(F.transform(found, lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";").alias("metadata"))


@query("str_28_links_of_sites", rf"""
with {_OWN_SQL}, found as (select page_id, k, url, regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) as hs from own),
 news as (select page_id, list_transform(list_filter(list_transform(hs, lambda x: case when x like '/%' then case when contains(url, 'www.') then 'https://www.news.example' else 'https://news.example' end || x when regexp_matches(x, '^https?://') then x end),
   lambda x: x is not null and contains(x, 'news.example') and not regexp_matches(x, '\.(pdf|doc|docx|zip|jpg|png|gif)$') and not regexp_matches(x, '/login|/auth|/api/')), lambda x: split_part(split_part(x, '#', 1), '?', 1)) as l from found where k < 4),
 portal as (select page_id, list_filter(list_transform(hs, lambda x: case when x like '/%' then base || x when regexp_matches(x, '^(https?://|#)') then x else base || '/' || x end), lambda x: regexp_matches(x, '^https?://') and not contains(x, '#') and contains(x, 'portal.example') and not regexp_matches(x, '/login|/auth|/search|/api/|\.pdf|\.zip')) as l
   from (select *, regexp_extract(url, 'https://[^/]+') as base from found where k between 4 and 7 or k = 11) b),
 meet as (select page_id, list_filter(list_transform(list_filter(list_transform(hs, lambda x: case when x like '/%' then 'https://meet.example' || x when regexp_matches(x, '^https?://') then x end), lambda x: x is not null and contains(x, 'meet.example')), lambda x: split_part(x, '#', 1)), lambda x: not regexp_matches(x, '/members/|twitter.com')) as l from found where k between 8 and 10)
select page_id, array_to_string(list_sort(list_distinct(l)), ' ') as links from (select * from news union all select * from portal union all select * from meet) a""")
def site_links(v: Views) -> DataFrame:
    """Links to follow by site."""
    own, sites, _ = _own(v)
    u, html = F.col("url"), F.col("html")
    links = F
    for x in sites:
        links = links.when(x.owns(u), x.page_links(html, u))
    return own.select("page_id", F.array_join(F.array_sort(links), " ").alias("links"))
