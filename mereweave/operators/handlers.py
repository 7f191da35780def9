"""Extension points: event handlers in phases, source adapters, extractors, site rules, and the registry of id types.

All of them are declarative: a handler or rule returns columns, so a whole chain is one projection without a shuffle and works on
streams as on tables.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

#: The phases of event processing, in order.
PHASES = ("rid", "manifest", "bundle", "network", "final")
#: The key under which a handler returns the condition on which it stops an event.
STOP = "STOP"
Change = Callable[[Callable[[str], Column]], Mapping[str, Column]]


@dataclass
class Handler:
    name: str
    change: Change
    phase: str
    namespaces: Sequence[str] = ()
    event_types: Sequence[str] = ()


@dataclass
class Pipeline:
    """Handlers by phase. Each sees the columns as the ones before left them; where it stops an event, its own changes to that event
    stand and no later handler touches it."""

    handlers: list[Handler] = field(default_factory=list)

    def handler(self, phase: str, namespaces: Sequence[str] = (), event_types: Sequence[str] = ()) -> Callable[[Change], Change]:
        """Registers ``f(column) -> {name: Column}`` for a phase; empty filters take every namespace or event type."""
        if phase not in PHASES:
            raise ValueError(f"no phase {phase}")

        def register(f: Change) -> Change:
            self.handlers.append(Handler(f.__name__, f, phase, tuple(namespaces), tuple(event_types)))
            return f

        return register

    def process(self, events: DataFrame, rid: str = "rid", event_type: str = "event_type") -> DataFrame:
        """Adds ``stopped_by`` (the handler that stopped a row, or null) and applies all handlers in phase order."""
        df = events.withColumn("stopped_by", F.lit(None).cast("string"))
        for phase in PHASES:
            for h in self.handlers:
                if h.phase != phase:
                    continue
                live = F.col("stopped_by").isNull()
                if h.namespaces:
                    live &= F.coalesce(t.namespace(F.col(rid)).isin(*h.namespaces), F.lit(False))
                if h.event_types:
                    live &= F.coalesce(F.col(event_type).isin(*h.event_types), F.lit(False))
                changes = dict(h.change(F.col))
                stop = changes.pop(STOP, None)
                new = {c: F.when(live, v).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c, v in changes.items()}
                if stop is not None:
                    new["stopped_by"] = F.when(live & F.coalesce(stop, F.lit(False)), h.name).otherwise(F.col("stopped_by"))
                df = df.withColumns(new)
        return df


class Adapter(ABC):
    """A source: what it offers, how its rows are named, and what their content is."""

    @abstractmethod
    def collect(self) -> DataFrame: ...

    @abstractmethod
    def rid(self) -> Column: ...

    @abstractmethod
    def content(self) -> Column: ...

    def documents(self) -> DataFrame:
        """(rid, content, hash) of all rows with content."""
        found = self.collect().select(self.rid().alias("rid"), self.content().alias("content"))
        return found.where(F.length(F.trim("content")) > 0).withColumn("hash", F.sha2("content", 256))


class Extractor(ABC):
    """Entities of a text: ``extract`` returns an array of structs (kind, value, confidence)."""

    @abstractmethod
    def extract(self, text: Column) -> Column: ...

    def apply(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return docs.select(F.col(id_col), F.explode(self.extract(F.col(text_col))).alias("e")).select(id_col, "e.*")


#: What follows a host in the addresses of a forum, in the order that kinds are tried.
_FORUM_KINDS = (("/t/", "forum_topic"), ("/c/", "forum_category"), ("/latest", "forum_index"), ("/top", "forum_index"))
#: Links of a forum that are not followed.
_FORUM_SKIPS = ("/u/", "/users/", "/login", "/signup", "/password-reset")


class Site:
    """The default rules of a web site; subclasses override single ones. ``html`` and ``url`` are columns."""

    def __init__(self, domain: str):
        self.domain = domain

    def owns(self, url: Column) -> Column:
        return F.contains(url, F.lit(self.domain))

    def wanted(self, url: Column) -> Column:
        """Whether a page's content is extracted at all."""
        return F.lit(True)

    def published(self, html: Column, url: Column) -> tuple[Column, Column]:
        """The publication day (text) and how far it is to be trusted."""
        day = F.nullif(F.regexp_extract(html, r'(?i)(?:published_time|datePublished)"\s+content="([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), F.lit(""))
        return day, F.when(day.isNotNull(), 0.9)

    def hrefs(self, html: Column) -> Column:
        """All absolute addresses on the same domain that a page links to."""
        found = F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))
        absolute = F.transform(found, lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(F.lit(f"https://{self.domain}"), h)).when(h.rlike("^https?://"), h))
        return F.filter(absolute, lambda h: h.isNotNull() & F.contains(h, F.lit(self.domain)))

    def links(self, html: Column) -> Column:
        return self.hrefs(html)

    def content_type(self, url: Column) -> Column:
        has = lambda *marks: F.greatest(*[F.contains(url, F.lit(m)) for m in marks], F.lit(False))
        return F.when(has("/meeting", "/weekly-meetup"), "meeting").when(has("/blog", "/article"), "article").when(has("/docs", "/guide", "/documentation"), "documentation").when(F.endswith(url, F.lit("/")) | has("/index"), "index").otherwise("page")

    def metadata(self, html: Column, url: Column) -> Column:
        return F.create_map().cast("map<string,string>")

    def text(self, html: Column, url: Column) -> Column:
        return t.strip_tags(html)


class Forum(Site):
    """Topics, categories and indexes; profiles, sign-in pages and other hosts are not followed."""

    def links(self, html: Column) -> Column:
        kept = F.filter(self.hrefs(html), lambda h: ~h.rlike("|".join(_FORUM_SKIPS)))
        bare = F.transform(kept, lambda h: F.when(F.contains(h, F.lit("?page=")) | F.contains(h, F.lit("#")), F.substring_index(F.substring_index(h, "?", 1), "#", 1)).otherwise(h))
        return F.array_distinct(F.filter(bare, lambda h: F.contains(h, F.lit("/t/")) | (F.contains(h, F.lit("/c/")) & ~F.contains(h, F.lit("/latest")))))

    def content_type(self, url: Column) -> Column:
        out = F
        for mark, kind in _FORUM_KINDS:
            out = out.when(F.contains(url, F.lit(mark)), kind)
        return out.otherwise("forum_page")

    def metadata(self, html: Column, url: Column) -> Column:
        of = lambda tag, css: F.nullif(F.trim(F.regexp_extract(html, rf'<{tag}\s[^>]*class="{css}"[^>]*>([^<]*)</{tag}>', 1)), F.lit(""))
        tags = F.nullif(F.array_join(F.regexp_extract_all(html, F.lit(r'<a\s[^>]*class="discourse-tag"[^>]*>\s*([^<]*?)\s*</a>'), F.lit(1)), ","), F.lit(""))
        topic, category = F.contains(url, F.lit("/t/")), F.contains(url, F.lit("/c/"))
        fields = {"content_type": self.content_type(url), "reply_count": F.when(topic, of("span", "reply-count")), "like_count": F.when(topic, of("span", "like-count")), "category": F.when(topic, of("a", "category-name")), "tags": F.when(topic, tags), "description": F.when(~topic & category, F.substring(of("div", "category-description"), 1, 500)), "author": F.coalesce(of("span", "creator"), of("a", "username"))}
        return F.map_filter(F.create_map(*[x for k, c in fields.items() for x in (F.lit(k), c)]), lambda _, x: x.isNotNull())

    def text(self, html: Column, url: Column) -> Column:
        """Posts of a topic without their quotes, a category's description, else the whole page's text."""
        posts = F.regexp_extract_all(html, F.lit(r'(?s)<div class="cooked">(.*?)</div>'), F.lit(1))
        own = F.array_join(F.transform(posts, lambda p: t.strip_tags(F.regexp_replace(p, r"(?s)<blockquote.*?</blockquote>", ""))), "\n\n")
        described = F.nullif(F.trim(F.regexp_extract(html, r'<div class="category-description">([^<]*)</div>', 1)), F.lit(""))
        whole = t.strip_tags(html)
        return F.when(F.contains(url, F.lit("/t/")) & (F.size(posts) > 0), own).when(F.contains(url, F.lit("/c/")) & ~F.contains(url, F.lit("/t/")), F.coalesce(described, whole)).otherwise(whole)


def by_site(sites: Sequence[Site], url: Column, rule: Callable[[Site], Column], default: Site) -> Column:
    """The rule of the first site that owns the address, else the default's: one expression, no dispatch of rows."""
    out = F
    for s in sites:
        out = out.when(s.owns(url), rule(s))
    return out.otherwise(rule(default)) if sites else rule(default)


#: Id types: namespace and the name of its kind.
ID_TYPES = (
    ("twitter.tweet", "tweet"), ("discourse.post", "post"), ("notion.page", "note page"), ("web.page", "web page"), ("github.file", "file"), ("gmail.message", "mail"), ("gmail.attachment", "attachment"),
)


class IdTypes:
    """The registry of id types: a map from namespaces, looked up by column."""

    def __init__(self, types: Sequence[tuple[str, str]] = ID_TYPES):
        self.types = dict(types)

    def register(self, namespace: str, kind: str) -> None:
        self.types[namespace] = kind

    def kind(self, rid: Column) -> Column:
        table = F.create_map(*[F.lit(x) for pair in self.types.items() for x in pair])
        return F.try_element_at(table, t.namespace(rid))

    def create(self, namespace: str, *parts: Column) -> Column:
        """An id of a known namespace from its parts; null for an unknown one or a null part."""
        return F.concat(F.lit(f"orn:{namespace}:"), *[x for k, p in enumerate(parts) for x in ([F.lit("/")] if k else []) + [p]]) if namespace in self.types else F.lit(None).cast("string")
