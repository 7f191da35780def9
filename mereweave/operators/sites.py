"""Rules of three kinds of sites beside forums: an organisation's news site, a portal with subdomains, and a site of meetings and projects.

Pages are read by patterns, as columns: an element is what stands between its tag and the next closing tag of its name, so an element that
holds another one of the same name ends with that one. Domains are parameters. What is not found is no entry of the metadata; null pages and
addresses give nulls or empty maps and lists.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as t
from .handlers import Site

#: What is skipped, and how addresses name kinds of pages.
_DOCUMENTS = (".pdf", ".doc", ".docx", ".zip")
_MEDIA = (*_DOCUMENTS, ".jpg", ".png", ".gif")
_SIGN_IN = ("/login", "/auth", "/api/")
_PORTAL_SKIPS = ("/login", "/auth", "/search", "/api/", ".pdf", ".zip")
_MEETING_PAGES = ("/weekly-meetups/", "/projects/", "/reports/", "/executive-summary", "/ethics-guidelines")


def has(text: Column, *marks: str) -> Column:
    return F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(text, m))


def _ends(text: Column, marks: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, marks)), lambda m: F.endswith(text, m))


def _classed(css: str) -> str:
    return rf"""class\s*=\s*["'](?:[^"']*\s)?(?:{css})(?:\s[^"']*)?["']"""


def _plain(html: Column) -> Column:
    return F.nullif(F.trim(t.strip_tags(html)), F.lit(""))


def element(html: Column, tags: str, css: str | None = None) -> Column:
    """The text of the first element of one of the tags (and a class)."""
    inside = rf"[^>]*?{_classed(css)}" if css else ""
    return _plain(F.regexp_extract(html, rf"(?is)<({tags})\b{inside}[^>]*>(.*?)</\1\s*>", 2))


def elements(html: Column, tags: str, css: str | None = None) -> Column:
    """The texts of all such elements that have one."""
    inside = rf"[^>]*?{_classed(css)}" if css else ""
    return F.array_compact(F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<({tags})\b{inside}[^>]*>(.*?)</\1\s*>"), F.lit(2)), _plain))


def block(html: Column, tag: str, css: str) -> Column:
    """The markup inside the first element of a tag and class."""
    return F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*?{_classed(css)}[^>]*>(.*?)</{tag}\s*>", 1), F.lit(""))


def meta(html: Column, kind: str, name: str) -> Column:
    return F.nullif(F.regexp_extract(html, rf"""(?is)<meta\b[^>]*?{kind}\s*=\s*["']{name}["'][^>]*?content\s*=\s*["']([^"']*)["']""", 1), F.lit(""))


def _joined(values: Column) -> Column:
    return F.nullif(F.array_join(values, ","), F.lit(""))


def _entries(**fields: Column) -> Column:
    """The fields that are there, as a map."""
    each = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in fields.items()])
    return F.map_from_entries(F.filter(each, lambda e: e["value"].isNotNull()))


def _hrefs(html: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1)), F.array().cast("array<string>"))


class NewsSite(Site):
    """An organisation: news, grants, team, governance."""

    def wanted(self, url: Column) -> Column:
        return ~has(F.lower(url), "/login", "/auth", "/api/", "/search") & ~_ends(url, _DOCUMENTS)

    def page_links(self, html: Column, url: Column) -> Column:
        """Links on the domain without queries and anchors, but those to files and sign-in pages; each once."""
        base = F.when(F.contains(url, F.lit(f"www.{self.domain}")), F.lit(f"https://www.{self.domain}")).otherwise(F.lit(f"https://{self.domain}"))
        absolute = F.transform(_hrefs(html), lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(base, h)).when(h.rlike("^https?://"), h))
        kept = F.filter(absolute, lambda h: h.isNotNull() & F.contains(h, F.lit(self.domain)) & ~_ends(h, _MEDIA) & ~has(h, *_SIGN_IN))
        return F.array_distinct(F.transform(kept, lambda h: F.substring_index(F.substring_index(h, "#", 1), "?", 1)))

    def content_type(self, url: Column) -> Column:
        return (
            F.when(has(url, "/news/", "/announcements/", "/blog/"), "news").when(has(url, "/grants/", "/funding/"), "grant_program").when(has(url, "/team/"), "team").when(has(url, "/about/", "/mission/"), "about")
            .when(has(url, "/governance/"), "governance").when(F.endswith(url, F.lit("/")), "index").otherwise("page")
        )

    def metadata(self, html: Column, url: Column) -> Column:
        news, grant, team, about = has(url, "/news/", "/announcements/"), has(url, "/grants/", "/funding/"), has(url, "/team/"), has(url, "/team/", "/about/")
        kind = F.when(news, "news").when(grant, "grant_program").when(about, "organizational").when(has(url, "/governance/"), "governance").otherwise("page")
        whole, h1 = t.strip_tags(html), element(html, "h1")
        of_grant = lambda c: F.when((kind == "grant_program") & (c != ""), c)
        cards = F.regexp_extract_all(html, F.lit(r"""(?is)<div\b[^>]*?class\s*=\s*["'][^"']*(?:team-member|member-card|bio)[^"']*["'][^>]*>(.*?)</div\s*>"""), F.lit(1))
        members = F.slice(F.array_compact(F.transform(cards, lambda c: element(c, "h3|h4|strong"))), F.lit(1), F.lit(20))  # the rule itself names twenty at most
        box = F.coalesce(block(html, "div", "tags"), block(html, "ul", "tag-list"))
        return _entries(
            content_type=F.when(url.isNotNull(), kind), category=F.when(kind == "news", F.coalesce(element(html, "span", "category"), element(html, "a", "category-link"))), grant_amount=of_grant(F.regexp_extract(whole, r"\$[0-9,]+(?:\.[0-9]{2})?", 0)),
            application_deadline=of_grant(F.regexp_extract(whole, r"(?i)(?:Application )?Deadline[:\s]+([A-Za-z]+ [0-9]{1,2},? [0-9]{4})", 1)), grant_name=F.when(F.contains(F.lower(h1), F.lit("grant")), of_grant(h1)),
            team_members=F.when((kind == "organizational") & team, _joined(members)), author=F.coalesce(element(html, "span", "author"), meta(html, "name", "author")), tags=_joined(F.filter(elements(box, "a|span|li"), lambda x: F.length(x) < 50)),
        )


class PortalSite(Site):
    """A site with subdomains for documentation, guides and a registry, and a blog."""

    def __init__(self, domain: str):
        super().__init__(domain)
        self.docs, self.guides, self.registry = (f"{x}.{domain}" for x in ("docs", "guides", "registry"))

    def wanted(self, url: Column) -> Column:
        shallow = F.endswith(url, F.lit("/")) & (F.length(url) - F.length(F.replace(url, F.lit("/"), F.lit(""))) <= 3)
        return ~has(url, "/login", "/auth", "/search", "/api/") & ~shallow

    def page_links(self, html: Column, url: Column) -> Column:
        """Links to any subdomain without an anchor, but those to files, searches and sign-in pages; relative ones on the page's subdomain."""
        base = F.concat(F.lit("https://"), F.when(has(url, self.docs), self.docs).when(has(url, self.guides), self.guides).when(has(url, self.registry), self.registry).otherwise(self.domain))
        absolute = F.transform(_hrefs(html), lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(base, h)).when(~h.rlike("^(https?://|#)"), F.concat(base, F.lit("/"), h)).otherwise(h))
        return F.array_distinct(F.filter(absolute, lambda h: h.rlike("^https?://") & ~F.contains(h, F.lit("#")) & F.contains(h, F.lit(self.domain)) & ~has(h, *_PORTAL_SKIPS)))

    def content_type(self, url: Column) -> Column:
        return (
            F.when(has(url, self.docs), "documentation").when(has(url, self.guides), "guide").when(has(url, self.registry), F.when(has(url, "/project/"), "registry_project").otherwise("registry_index"))
            .when(has(url, "/blog/"), "blog_post").when(F.endswith(url, F.lit("/")), "index").otherwise("page")
        )

    def metadata(self, html: Column, url: Column) -> Column:
        kind = F.when(has(url, self.docs), "documentation").when(has(url, self.guides), "guide").when(has(url, self.registry), "registry_project").when(has(url, "/blog/"), "blog_post").otherwise("page")
        of = lambda name, c: F.when(kind == name, c)
        crumbs = elements(block(html, "nav", "breadcrumb"), "a")
        box = F.coalesce(block(html, "div", "tags"), block(html, "div", "post-tags"))
        tags = F.array_compact(F.transform(F.regexp_extract_all(box, F.lit(r"""(?is)<(a|span)\b[^>]*?class\s*=\s*["'][^"']*tag[^"']*["'][^>]*>(.*?)</\1\s*>"""), F.lit(2)), _plain))
        return _entries(
            content_type=F.when(url.isNotNull(), kind), version=of("documentation", element(html, "span", "version")), category=of("guide", F.get(F.reverse(crumbs), F.lit(0))), project_name=of("registry_project", element(html, "h1", "project-name")),
            credit_class=of("registry_project", element(html, "span", "credit-class")), author=of("blog_post", F.coalesce(element(html, "span", "author"), meta(html, "name", "author"))), tags=of("blog_post", _joined(tags)),
        )


class MeetingSite(Site):
    """Meetings with attendees, projects with a status, reports."""

    def __init__(self, domain: str, meeting_type: str = "weekly"):
        super().__init__(domain)
        self.meeting_type = meeting_type

    def page_links(self, html: Column, url: Column) -> Column:
        """Links on the domain without anchors: content pages, and all others but members' pages; each once."""
        absolute = F.transform(_hrefs(html), lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(F.lit(f"https://{self.domain}"), h)).when(h.rlike("^https?://"), h))
        bare = F.transform(F.filter(absolute, lambda h: h.isNotNull() & F.contains(h, F.lit(self.domain))), lambda h: F.substring_index(h, "#", 1))
        return F.array_distinct(F.filter(bare, lambda h: (h != "") & (has(h, *_MEETING_PAGES) | ~has(h, "/members/", "twitter.com"))))

    def content_type(self, url: Column) -> Column:
        return F.when(has(url, "/weekly-meetups/"), "meeting").when(has(url, "/projects/"), "project").when(has(url, "/reports/", "/executive-summary"), "report").when(has(url, "/ethics-guidelines"), "governance").when(F.endswith(url, F.lit("/")), "index").otherwise("page")

    def metadata(self, html: Column, url: Column) -> Column:
        kind = F.when(has(url, "/weekly-meetups/"), "meeting").when(has(url, "/projects/"), "project").when(has(url, "/reports/", "/executive-summary"), "report").otherwise("governance")
        said = F.filter(elements(html, "p|div|ul"), lambda x: has(F.lower(x), "attendee", "participant", "present"))
        names = F.array_sort(F.array_distinct(F.flatten(F.transform(said, lambda x: F.regexp_extract_all(x, F.lit("[A-Z][a-z]+ [A-Z][a-z]+"), F.lit(0))))))
        status = F.nullif(F.trim(F.regexp_replace(F.regexp_extract(html, r"(?i)>([^<]*Status:[^<]*)<", 1), "Status:", "")), F.lit(""))
        return _entries(content_type=F.when(url.isNotNull(), kind), meeting_type=F.when(kind == "meeting", self.meeting_type), attendees=F.when(kind == "meeting", _joined(names)), project_status=F.when(kind == "project", status), notion_page_id=meta(html, "property", "notion:page_id"))
