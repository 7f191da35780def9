"""Posts of social sites as rows: fields of a post's markup, and documents of channels and their messages, pinned ones included.

Nulls and edges: a post without a text gives no row, a message without text, caption or media none; a field that is not there is null; counts
that cannot be read are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t


def parse_count(shown: Column) -> Column:
    """A count as it is shown: ``1.2K``, ``3M``, ``1,234``; 0 where it cannot be read."""
    plain = F.replace(F.upper(F.trim(shown)), F.lit(","), F.lit(""))
    scaled = lambda mark, by: F.round(F.replace(plain, F.lit(mark), F.lit("")).try_cast("double") * by, 3).try_cast("long")
    return F.coalesce(F.when(F.endswith(plain, F.lit("K")), scaled("K", 1000)).when(F.endswith(plain, F.lit("M")), scaled("M", 1_000_000)).otherwise(plain.try_cast("long")), F.lit(0).cast("long"))


def _part(html: Column, mark: str) -> Column:
    """The markup inside the first element with a test id, up to the next element with one or the end."""
    return F.regexp_extract(html, rf'(?is)<[^>]*data-testid="{mark}"[^>]*>(.*?)(?=<[^>]*data-testid="|$)', 1)


def _lines(html: Column) -> Column:
    """Text as it is shown: blocks and breaks end lines, empty lines go."""
    each = F.transform(F.split(html, r"(?i)<br\s*/?>|</(?:div|p)>"), lambda x: F.trim(t.strip_tags(x)))
    return F.array_join(F.filter(each, lambda x: x != ""), "\n")


def posts(pages: DataFrame, html: str) -> DataFrame:
    """``pages`` with the post's text, created_at, likes, retweets, replies, author_name, author_username, url and post_id."""
    h = F.col(html)
    count = lambda mark: F.when(_part(h, mark).rlike("(?i)<span"), parse_count(F.regexp_extract(_part(h, mark), r"(?is)<span[^>]*>([^<]*)<", 1)))
    user = F.filter(F.transform(F.split(_lines(_part(h, "User-Name")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    handle = F.get(user, F.lit(1))
    href = F.nullif(F.regexp_extract(h, r'(?i)<a\b[^>]*href="([^"]*/status/[^"]*)"', 1), F.lit(""))
    out = pages.withColumns({
        "text": F.nullif(_lines(_part(h, "tweetText")), F.lit("")), "created_at": F.nullif(F.regexp_extract(h, r'(?i)<time\b[^>]*datetime="([^"]*)"', 1), F.lit("")), "likes": count("like"), "retweets": count("retweet"), "replies": count("reply"),
        "author_name": F.get(user, F.lit(0)), "author_username": F.when(F.startswith(handle, F.lit("@")), F.substring(handle, 2, 1 << 20)), "url": F.concat(F.lit("https://twitter.com"), href), "post_id": F.nullif(F.regexp_extract(href, "/status/([0-9]+)", 1), F.lit("")),
    })
    return out.where("text is not null").drop(html)


def channel_documents(channels: DataFrame) -> DataFrame:
    """(rid, content, kind) of channels: id, title, kind, username, members, description, bio."""
    or_ = lambda c, other: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(other))
    name = F.coalesce(F.concat(F.lit("@"), F.nullif("username", F.lit(""))), F.lit("@N/A"))
    content = F.concat(F.lit("# "), "title", F.lit("\n\nType: "), "kind", F.lit("\nUsername: "), name, F.lit("\nMembers: "), or_("members", "Unknown"), F.lit("\n\n## Description\n"), or_("description", "No description available"), F.lit("\n\n## Bio\n"), or_("bio", "No bio available"), F.lit("\n"))
    return channels.select(F.concat(F.lit("telegram:channel:"), "id", F.lit(":info")).alias("rid"), content.alias("content"), F.lit("channel_info").alias("kind"))


def message_documents(messages: DataFrame) -> DataFrame:
    """(rid, content, author, kind, url) of messages: channel, username, id, text, caption, photo, video, document, audio, from_name, sender_title,
    pinned. The media are named after the text; ``kind`` is ``pinned`` or ``message``."""
    media = F.array_compact(F.array(
        F.when(F.col("photo"), "[Photo attached]"), F.when(F.col("video"), "[Video attached]"), F.when(F.col("document").isNotNull(), F.concat(F.lit("[Document: "), "document", F.lit("]"))), F.when(F.col("audio").isNotNull(), F.concat(F.lit("[Audio: "), F.coalesce(F.nullif("audio", F.lit("")), F.lit("Untitled")), F.lit("]"))),
    ))
    own = F.coalesce(F.nullif("text", F.lit("")), F.nullif("caption", F.lit("")), F.lit(""))
    content = F.concat(own, F.array_join(F.transform(media, lambda m: F.concat(F.lit("\n"), m)), ""))
    out = messages.select(
        F.concat(F.lit("telegram:channel:"), "channel", F.lit(":message:"), "id").alias("rid"), content.alias("content"), F.coalesce("from_name", "sender_title", F.lit("Unknown")).alias("author"), F.when(F.col("pinned"), "pinned").otherwise("message").alias("kind"),
        F.when(F.col("username") != "", F.concat(F.lit("https://t.me/"), "username", F.lit("/"), "id")).alias("url"),
    )
    return out.where("content <> ''")
