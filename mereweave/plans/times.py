"""Calendar times of all orders in four notations, and publication dates of all pages under every rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times as t
from .registry import query
from .views import Views

_STAMPS_SQL = "stamps as (select o_orderkey as id, o_orderkey % 4 as kind, o_orderdate::timestamp + ((o_orderkey % 24) * 60 + (o_orderkey % 7) * 8) * interval 1 minute as wall from orders)"


def _sunday(month: int, last: bool) -> str:
    """The first or last Sunday of a month of the wall clock's year, in SQL."""
    if last:
        end = f"(make_date(year(wall), {month}, 1) + interval 1 month - interval 1 day)"
        return f"({end} - dayofweek({end}) * interval 1 day)"
    first = f"make_date(year(wall), {month}, 1)"
    return f"({first} + ((7 - dayofweek({first})) % 7) * interval 1 day)"


@query("dat_04_calendar_times", f"""
with {_STAMPS_SQL}, u as (select *, case kind when 0 then wall + case when wall >= {_sunday(4, False)} + interval 2 hour and wall < {_sunday(10, True)} + interval 1 hour then 7 else 8 end * interval 1 hour
  when 1 then wall - case when wall >= {_sunday(3, True)} + interval 3 hour and wall < (case when year(wall) < 1996 then {_sunday(9, True)} else {_sunday(10, True)} end) + interval 3 hour then 2 else 1 end * interval 1 hour
  when 2 then wall else date_trunc('day', wall) end as starts from stamps)
select id, strftime(starts, '%Y-%m-%d %H:%M:%S') as starts, strftime(case when id % 3 = 0 and kind = 3 then starts + interval 2 day - interval 1 second when id % 3 = 0 then starts + interval 90 minute when id % 3 = 1 then starts + interval 26 hour when kind = 3 then starts + interval 86399 second else starts + interval 1 hour end, '%Y-%m-%d %H:%M:%S') as ends from u""")
def calendar_times(v: Views) -> DataFrame:
    """Floating times, times of a zone, UTC and whole days, with given ends (in UTC or whole days), durations or neither."""
    k = F.col("o_orderkey")
    wall = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + ((k % 24) * 60 + (k % 7) * 8) * 60)
    stamp = F.date_format(wall, "yyyyMMdd'T'HHmmss")
    kind = k % 4
    written = F.when(kind == 2, F.concat(stamp, F.lit("Z"))).when(kind == 3, F.date_format(wall, "yyyyMMdd")).otherwise(stamp)
    e = v.table("orders").select(k.alias("id"), kind.alias("kind"), wall.alias("wall"), written.alias("stamp"), F.when(kind == 1, "Europe/Berlin").alias("zone"))
    e = e.withColumn("starts", t.calendar_instant(F.col("stamp"), F.col("zone")))
    later = lambda s: F.timestamp_seconds(F.unix_seconds("starts") + s)
    given = F.when(F.col("id") % 3 == 0, F.when(F.col("kind") == 3, F.date_format(later(2 * 86_400), "yyyyMMdd")).otherwise(F.concat(F.date_format(later(5400), "yyyyMMdd'T'HHmmss"), F.lit("Z"))))
    lasts = F.when(F.col("id") % 3 == 1, "P1DT2H")
    ends = t.calendar_end(F.col("stamp"), F.col("starts"), given, F.lit(None).cast("string"), lasts)
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return e.select("id", show(F.col("starts")).alias("starts"), show(ends).alias("ends"))


_AS_OF = "2024-01-31 12:00:00"
_DAY = "strftime(date '2021-01-01' + (page_id % 900)::integer, '{}')"


@query("dat_02_dates_by_rule", f"""
with d as (select page_id, timestamp '2021-01-01' + (page_id % 900) * interval 1 day as day, timestamp '{_AS_OF}' as now from pages)
select page_id, strftime(case page_id % 9 when 0 then day when 1 then day when 2 then day + interval 3 hour when 3 then day when 4 then now - (1 + page_id % 50) * interval 1 hour when 5 then now - interval 1 day when 6 then now when 7 then day end, '%Y-%m-%d %H:%M:%S') as published,
  case page_id % 9 when 0 then 0.8 when 1 then 0.9 when 2 then 0.95 when 3 then 0.85 when 4 then 0.75 when 5 then 0.75 when 6 then 0.3 when 7 then 0.8 end::double as confidence from d""")
def dates_by_rule(v: Views) -> DataFrame:
    """Whole pages with a mark of their date in front, one of eight kinds by the page's number or none, under the rule that reads it."""
    p = F.col("page_id")
    day = F.date_add(F.lit("2021-01-01").cast("date"), (p % 900).cast("int"))
    iso, long_ = F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "MMMM d, yyyy")
    marks = (
        F.concat(F.lit("<ul><li>"), long_, F.lit("</li></ul>")), F.concat(F.lit("<p>Published  "), long_, F.lit("</p>")), F.concat(F.lit('<time class=x datetime="soon"></time><time datetime="'), iso, F.lit('T05:00:00.123+02:00">x</time>')),
        F.concat(F.lit('<span class="post-date">'), long_, F.lit("</span>")), F.concat(F.lit("<p>written "), (1 + p % 50).cast("string"), F.lit(" hours ago</p>")), F.lit("<p>Yesterday</p>"), F.lit("<p>Last updated 1 year ago</p>"),
        F.concat(F.lit('<meta content="'), iso, F.lit('" property="article:published_time">')),
    )
    mark, rule = F.lit(""), F.lit(None).cast("string")
    for k, (m, r) in enumerate(zip(marks, ("list", "publication", "forum", "forum", "forum", "forum", "docs", None), strict=True)):
        mark, rule = F.when(p % 9 == k, m).otherwise(mark), F.when(p % 9 == k, F.lit(r)).otherwise(rule)
    d = v.table("pages").select("page_id", F.concat(mark, F.coalesce("html", F.lit(""))).alias("html"), rule.alias("rule"))
    found = t.published(F.col("html"), F.col("rule"), F.lit(_AS_OF).cast("timestamp"))
    return d.select("page_id", found.alias("f")).select("page_id", F.date_format("f.at", "yyyy-MM-dd HH:mm:ss").alias("published"), "f.confidence")
