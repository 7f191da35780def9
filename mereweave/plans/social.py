"""Posts, channels and messages made from the conversations and nations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import social as s
from .registry import query
from .views import Views


@query("src_18_posts", """
select conv_id, turn, md5(trim(regexp_replace(replace(text, chr(10), ' '), '\\s+', ' ', 'g'))) as digest, '2024-01-01T00:00:' || lpad((turn % 60)::varchar, 2, '0') || 'Z' as created_at, (conv_id % 900)::bigint as likes, (1000 * (1 + turn % 9) + 200)::bigint as retweets, case when turn % 2 = 0 then 7::bigint end as replies, 'Name ' || role as author_name,
 case when turn % 3 <> 0 then role || conv_id end as author_username, 'https://twitter.com/u/status/' || (conv_id * 100 + turn) as url, (conv_id * 100 + turn)::varchar as post_id from turns where trim(text) <> ''""", "turns")
def posts(v: Views) -> DataFrame:
    """Every turn as a post's markup, read back as fields; a post without a text goes."""
    c, n = F.col("conv_id"), F.col("turn")
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    html = F.concat(
        F.lit('<article><div data-testid="User-Name"><div>Name '), "role", F.lit("</div><div>"), F.when(n % 3 != 0, F.concat(F.lit("@"), "role", c)).otherwise("no handle"), F.lit('</div></div><a href="/u/status/'), c * 100 + n, F.lit('/photo"><time datetime="2024-01-01T00:00:'), F.lpad((n % 60).cast("string"), 2, "0"),
        F.lit('Z"></time></a><div data-testid="tweetText">'), escaped, F.lit('</div><div data-testid="reply">'), F.when(n % 2 == 0, "<span>7</span>").otherwise(""), F.lit('</div><div data-testid="retweet"><span>'), (1 + n % 9), F.lit('.2K</span></div><div data-testid="like"><b></b><span>'), c % 900, F.lit("</span></div></article>"),
    )
    found = s.posts(v.turns.select("conv_id", "turn", html.alias("html")), "html")
    digest = F.md5(F.trim(F.regexp_replace(F.replace("text", F.lit("\n"), F.lit(" ")), r"\s+", " ")))
    return found.select("conv_id", "turn", digest.alias("digest"), "created_at", "likes", "retweets", "replies", "author_name", "author_username", F.regexp_replace("url", "/photo$", "").alias("url"), "post_id")


@query("src_19_channel_documents", """
select 'telegram:channel:' || n_nationkey || ':info' as rid, '# ' || n_name || chr(10) || chr(10) || 'Type: channel' || chr(10) || 'Username: @' || case when n_nationkey % 2 = 0 then 'n' || n_nationkey else 'N/A' end || chr(10) || 'Members: ' || n_regionkey || chr(10) || chr(10)
 || '## Description' || chr(10) || case when n_nationkey % 3 = 0 then 'No description available' else 'Of ' || n_name end || chr(10) || chr(10) || '## Bio' || chr(10) || 'No bio available' || chr(10) as content from nation
union all select 'telegram:channel:' || conv_id || ':message:' || turn, content from (select conv_id, turn, case when turn % 3 = 0 then '' else text end || case when turn % 2 = 0 then chr(10) || '[Photo attached]' else '' end || case when turn % 5 = 1 then chr(10) || '[Document: f' || turn || '.txt]' else '' end as content from turns) t where content <> ''""", "turns")
def channel_documents(v: Views) -> DataFrame:
    """Documents of channels and of all their messages, media named after the text."""
    k, n = F.col("n_nationkey"), F.col("turn")
    channels = v.table("nation").select(k.alias("id"), F.col("n_name").alias("title"), F.lit("channel").alias("kind"), F.when(k % 2 == 0, F.concat(F.lit("n"), k)).alias("username"), F.col("n_regionkey").alias("members"), F.when(k % 3 != 0, F.concat(F.lit("Of "), "n_name")).alias("description"), F.lit("").alias("bio"))
    none = F.lit(None).cast("string")
    messages = v.turns.select(F.col("conv_id").alias("channel"), F.lit("").alias("username"), n.alias("id"), F.when(n % 3 != 0, F.col("text")).alias("text"), none.alias("caption"), (n % 2 == 0).alias("photo"), F.lit(False).alias("video"), F.when(n % 5 == 1, F.concat(F.lit("f"), n, F.lit(".txt"))).alias("document"), none.alias("audio"), F.col("role").alias("from_name"), none.alias("sender_title"), (n == 0).alias("pinned"))
    return s.channel_documents(channels).select("rid", "content").union(s.message_documents(messages).select("rid", "content"))
