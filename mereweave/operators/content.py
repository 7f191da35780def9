"""Operators on what sources deliver: message and block JSON, articles, media, threads, response pages, headers, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .documents import sentence_windows, token_windows


def message_text(raw: Column) -> Column:
    """The text of a session message given as JSON: a string, an object with a string, or one with blocks (strings and text blocks,
    a line each); without a message its ``content``; else empty. Kinds are those of the JSON, not of how a text looks."""
    is_a = lambda v, kind: F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))
    inside = lambda v, path: F.try_variant_get(v, path, "variant")
    text = lambda v: F.try_variant_get(v, "$", "string")
    whole = F.try_parse_json(raw)
    message, content = inside(whole, "$.message"), inside(whole, "$.message.content")

    def block(b: Column) -> Column:
        own = F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit(""))
        return F.when(is_a(b, "STRING"), text(b)).when(is_a(b, "OBJECT") & (F.try_variant_get(b, "$.type", "string") == "text"), own)

    blocks = F.array_join(F.array_compact(F.transform(F.try_variant_get(content, "$", "array<variant>"), block)), "\n")
    nested = F.when(is_a(content, "ARRAY"), blocks).when(is_a(content, "STRING"), text(content)).otherwise(F.lit(""))
    alone = inside(whole, "$.content")
    return F.when(is_a(message, "STRING"), text(message)).when(is_a(message, "OBJECT"), nested).otherwise(F.when(is_a(alone, "STRING"), text(alone)).otherwise(F.lit("")))


#: Kinds of note blocks whose rich text stands for itself.
_TEXT_BLOCKS = tuple("paragraph heading_1 heading_2 heading_3 bulleted_list_item numbered_list_item to_do toggle quote callout".split())


def _rich(block: Column, path: str) -> Column:
    parts = F.from_json(F.get_json_object(block, path), "array<struct<plain_text: string>>")
    return F.coalesce(F.array_join(F.transform(parts, lambda x: x["plain_text"]), ""), F.lit(""))


def block_text(block: Column) -> Column:
    """A note block (JSON) as text, null for kinds without any: text kinds, code, tables, dividers, videos, embeds, bookmarks, audio."""
    get = lambda path: F.get_json_object(block, path)
    kind, out = get("$.type"), F
    for name in _TEXT_BLOCKS:
        out = out.when(kind == name, _rich(block, f"$.{name}.rich_text"))
    code = _rich(block, "$.code.rich_text")
    caption = lambda name: F.when(_rich(block, f"$.{name}.caption") != "", F.concat(F.lit(" - "), _rich(block, f"$.{name}.caption"))).otherwise("")
    shown = lambda name, label, url, none: F.when(F.length(url) > 0, F.concat(F.lit(f"[{label}: "), url, F.lit("]"), caption(name))).otherwise(none)
    out = out.when(kind == "code", F.when(code != "", F.concat(F.lit("```"), F.coalesce(get("$.code.language"), F.lit("")), F.lit("\n"), code, F.lit("\n```"))))
    out = out.when(kind == "table", "[Table]").when(kind == "divider", "---")
    video = F.when(get("$.video.type") == "external", shown("video", "Video", F.coalesce(get("$.video.external.url"), F.lit("")), "[Video: ]")).when(get("$.video.type") == "file", F.concat(F.lit("[Video Recording]"), caption("video"))).otherwise("[Video]")
    audio = F.when(get("$.audio.type") == "external", shown("audio", "Audio", get("$.audio.external.url"), "[Audio Recording]")).otherwise(F.concat(F.lit("[Audio Recording]"), caption("audio")))
    return out.when(kind == "video", video).when(kind == "embed", shown("embed", "Embed", get("$.embed.url"), "[Embed]")).when(kind == "bookmark", shown("bookmark", "Link", get("$.bookmark.url"), "[Bookmark]")).when(kind == "audio", audio)


def note_text(blocks: DataFrame, skip_sections: tuple[str, ...] = ()) -> DataFrame:
    """(page, content) of ``blocks`` (page, place, block): what stands under a heading in ``skip_sections`` (lower case) is left out,
    the heading too. A page's blocks meet in one row: a page is as long as a note is."""
    kind = F.get_json_object("block", "$.type")
    b = blocks.select("page", "place", block_text(F.col("block")).alias("line"), kind.isin("heading_1", "heading_2", "heading_3").alias("is_heading"))
    before = Window.partitionBy("page").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    section = F.last(F.when(F.col("is_heading"), F.lower("line")), ignorenulls=True).over(before)
    kept = b.withColumn("section", section).where("line <> ''")
    if skip_sections:
        kept = kept.where(~F.coalesce(F.col("section").isin(*skip_sections), F.lit(False)))
    return kept.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines")).select("page", F.array_join(F.transform("lines", lambda x: x["line"]), "\n\n").alias("content"))


def article(html: Column) -> Column:
    """(title, author, published) of an article page: the author from the first of meta tags, author links, a byline, "Written by"."""
    first = lambda p: F.nullif(F.trim(F.regexp_extract(html, p, 1)), F.lit(""))
    author = F.coalesce(
        first(r'<meta[^>]*(?:name="author"|property="article:author")[^>]*content="([^"]*)"'), first(r'<a[^>]*data-testid="authorName"[^>]*>([^<]*)</a>'), first(r'<a[^>]*rel="author"[^>]*>([^<]*)</a>'),
        first(r'<span[^>]*class="[^"]*(?:author|byline)[^"]*"[^>]*>([^<]*)</span>'), first(r'"author"\s*:\s*\{[^}]*"name"\s*:\s*"([^"]*)"'), first(r"Written by\s*</[a-z]+>\s*<[a-z]+[^>]*>([^<]*)<"),
    )
    named_day = F.try_to_timestamp(first(r"\b([A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4})"), F.lit("MMM d, yyyy"))
    published = F.coalesce(first(r'<time[^>]*datetime="([^"]*)"'), F.when(~html.rlike("<time"), F.date_format(named_day, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    title = F.coalesce(first(r"(?s)<h1[^>]*>([^<]*)</h1>"), first(r"(?s)<title>([^<]*)</title>"))
    return F.struct(title.alias("title"), author.alias("author"), published.alias("published"))


def episode_text(title: Column, url: Column, published: Column, milliseconds: Column, description: Column) -> Column:
    """An episode as a document: title, address, date, length in minutes, description."""
    length = F.when(F.coalesce(milliseconds, F.lit(0)) > 0, F.concat(F.floor(milliseconds / 60000).cast("string"), F.lit(" minutes"))).otherwise("Unknown")
    or_none = lambda x, none: F.coalesce(x, F.lit(none))
    return F.concat(F.lit("# "), or_none(title, "Untitled Episode"), F.lit("\n\n**Episode URL:** "), or_none(url, ""), F.lit("\n**Published:** "), or_none(published, ""), F.lit("\n**Duration:** "), length, F.lit("\n\n## Description\n"), or_none(description, "No description available"))


def video_text(description: Column, transcript: Column) -> Column:
    """A video's description, with its transcript where there is one."""
    return F.concat(F.coalesce(description, F.lit("")), F.coalesce(F.concat(F.lit("\n\n=== TRANSCRIPT ===\n\n"), transcript), F.lit("")))


def video_stamp(uploaded: Column) -> Column:
    """``yyyyMMdd`` as an ISO instant; null for none or another form."""
    return F.date_format(F.try_to_timestamp(uploaded, F.lit("yyyyMMdd")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def compose_thread(posts: DataFrame, fillers: tuple[str, ...], tags: str, least: int = 3, most: int = 5) -> DataFrame:
    """(thread, position, post) of ``posts`` (thread, place, body): at most ``most`` posts, fillers up to ``least``, numbered, tags on the last."""
    first = Window.partitionBy("thread").orderBy("place")
    own = posts.withColumn("position", F.row_number().over(first)).where(F.col("position") <= most).select("thread", "position", "body")
    short = own.groupBy("thread").agg(F.max("position").alias("held"))
    more = short.where(F.col("held") < least).select("thread", "held", F.posexplode(F.array(*map(F.lit, fillers))).alias("k", "body"))
    more = more.withColumn("position", F.col("held") + F.col("k") + 1).where(F.col("position") <= least)
    total = F.greatest(F.lit(least), F.col("held"))
    out = own.unionByName(more.select("thread", "position", "body")).join(short, "thread")
    tail = F.when(F.col("position") == total, F.lit(f" {tags}")).otherwise("")
    return out.select("thread", F.col("position").cast("long").alias("position"), F.concat("position", F.lit("/"), total, F.lit(" "), "body", tail).alias("post"))


def sliding_count(events: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Adds ``n``: the events in the ``seconds`` up to each one (open at the start). Time is cut into windows of that length; every
    event stands in its own and the next, so a window is counted by itself however long the log is."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slot = F.floor(micros / (seconds * 1_000_000))
    both = events.withColumn("_at", micros).withColumn("_own", slot).withColumn("_slot", F.explode(F.array(slot, slot + 1)))
    here = Window.partitionBy("_slot").orderBy("_at").rangeBetween(-(seconds * 1_000_000 - 1), 0)
    return both.withColumn("n", F.count("*").over(here)).where("_slot = _own").drop("_at", "_own", "_slot")


def contiguous_mark(rows: DataFrame, key: str, number: str) -> DataFrame:
    """(key, first, mark): the last number of each key's run without a gap from its first one. A number ends a run if its successor
    is missing, so the mark is the least such number: two grouped minima and no sort."""
    r = rows.select(F.col(key), F.col(number).alias("n")).distinct()
    ends = r.join(r.select(F.col(key), (F.col("n") - 1).alias("n")), [key, "n"], "left_anti")
    return r.groupBy(key).agg(F.min("n").alias("first")).join(ends.groupBy(key).agg(F.min("n").alias("mark")), key)


def unfold_pages(pages: DataFrame, body: str, field: str, item: str) -> DataFrame:
    """One row per entity of landed response pages; a page that is no JSON or has none of them gives no row."""
    found = F.from_json(F.get_json_object(body, f"$.{field}"), f"array<struct<{', '.join(': '.join(x.split()) for x in item.split(', '))}>>")
    return pages.withColumn("item", F.explode(found)).drop(body)


def header_entities(mail: DataFrame, personal: tuple[str, ...]) -> DataFrame:
    """(id, name, kind, confidence) of ``mail`` (id, from_name, from_address, to_addresses): the sender, the organisation that the
    sender's domain names, and those of recipients at 0.8 of the confidence; one row a name, domains of private mail left out."""
    domain = lambda a: F.regexp_extract(a, "@([^@]+)$", 1)
    org = lambda a: F.when((domain(a) != "") & ~domain(a).isin(*personal), F.initcap(F.element_at(F.split(domain(a), r"\."), -2)))
    entity = lambda name, kind, confidence: F.struct(name.alias("name"), F.lit(kind).alias("kind"), F.lit(confidence).alias("confidence"))
    sender = F.array(F.when(F.length("from_name") > 2, entity(F.col("from_name"), "Person", 0.95)), entity(org(F.col("from_address")), "Organization", 0.7))
    others = F.transform("to_addresses", lambda a: entity(org(a), "Organization", 0.56))
    each = mail.select("id", F.explode(F.concat(sender, others)).alias("e")).select("id", "e.*").where("name is not null")
    return each.groupBy("id", "name", "kind").agg(F.max("confidence").alias("confidence"))


def mail_chunks(mail: DataFrame, id_col: str, size: int = 500, overlap: int = 50, sentences: bool = False) -> DataFrame:
    """Token windows of ``Subject: ...`` and the body (subject, body, from_address), with the header's columns on every chunk; with
    ``sentences`` they end at sentence ends."""
    whole = F.when(F.length("subject") > 0, F.concat(F.lit("Subject: "), "subject", F.lit("\n\n"), "body")).otherwise(F.col("body"))
    windows = sentence_windows if sentences else token_windows
    chunks = windows(mail.select(id_col, whole.alias("whole")), id_col, "whole", size, overlap)
    return chunks.join(mail.select(id_col, "subject", "from_address"), id_col)




def follow_pages(pages: DataFrame, chain: str, key: str, next_key: str) -> tuple[DataFrame, DataFrame]:
    """Landed response pages followed by their next keys: (pages that are reached from their chain's first page, gaps).

    A chain's first page has the empty key. Pages hang together if one names the other as the next, so a chain is a component and is found by
    pointer jumping, however long it is; pages behind a page that is missing are in another one and are left out. ``gaps`` has, for each
    chain, the keys that a reached page names and no page has. Null keys name no page; a page that comes twice is returned twice.
    """
    from .kg import components

    node = lambda c: F.concat(chain, F.lit("\0"), c)
    known = pages.where(f"{key} is not null")
    there = known.select(node(F.col(key)).alias("node")).distinct()
    edges = known.where(f"{next_key} is not null and {next_key} <> ''").select(node(F.col(key)).alias("a"), node(F.col(next_key)).alias("b"))
    joined = components(edges.join(there.withColumnRenamed("node", "b"), "b", "left_semi")).select("node", "component")
    own = known.withColumn("node", node(F.col(key))).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    reached = own.where(F.col("component") == node(F.lit("")))  # the empty key sorts first in its component
    gaps = edges.join(reached.select(F.col("node").alias("a"), chain), "a").join(there.withColumnRenamed("node", "b"), "b", "left_anti")
    return reached.drop("node", "component"), gaps.select(chain, F.substring_index("b", "\0", -1).alias("missing")).distinct()
