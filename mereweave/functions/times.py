"""Calendar times and publication dates as columns.

Calendar: a date is its midnight in UTC, a time with ``Z`` is UTC, a time with a zone is that zone's (in a gap it moves on by the gap, a
repeated hour is the first one). A floating time is the default zone's: in a gap it counts as summer time, a repeated hour as winter time.

Publication: what a page says about its date, by the rule of its domain, then by its meta tags, with a confidence. Relative phrases are
counted from ``as_of``, which is a parameter; without it they say nothing. Nulls give nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shifted(instant: Column, seconds: Column | int) -> Column:
    return F.timestamp_micros(F.unix_micros(instant) + F.lit(seconds).cast("long") * 1_000_000)


def _seconds(to: Column, since: Column) -> Column:
    return F.unix_seconds(to) - F.unix_seconds(since)


def calendar_instant(stamp: Column, zone: Column | None = None, default: str = "America/Vancouver") -> Column:
    """The instant of a calendar value as written: ``20240310``, ``20240310T023000``, ``20240310T103000Z``. Others give null.

    The session's time zone must be UTC: wall clocks are taken as instants of it.
    """
    zone = F.lit(None).cast("string") if zone is None else zone
    wall = F.try_to_timestamp(F.substring(stamp, 1, 15), F.lit("yyyyMMdd'T'HHmmss"))
    there = lambda z: F.to_utc_timestamp(wall, z)
    back = lambda instant: F.from_utc_timestamp(instant, default)
    own = there(F.lit(default))
    gap = _seconds(back(own), wall)  # over 0 where the clock skips this time
    again = lambda s: F.when(back(_shifted(own, s)) == wall, _shifted(own, s))
    floating = F.when(gap > 0, _shifted(own, -gap)).otherwise(F.coalesce(again(3600), again(1800), own))
    return F.when(stamp.rlike("^[0-9]{8}$"), F.try_to_timestamp(stamp, F.lit("yyyyMMdd"))).when(stamp.rlike("^[0-9]{8}T[0-9]{6}Z$"), wall).when(stamp.rlike("^[0-9]{8}T[0-9]{6}$"), F.when(zone.isNotNull(), there(zone)).otherwise(floating))


def duration_seconds(text: Column) -> Column:
    """The seconds of a calendar duration such as ``P1DT2H30M`` or ``-P1W``; null for anything else."""
    part = lambda p: F.coalesce(F.nullif(F.regexp_extract(text, p, 1), F.lit("")).cast("long"), F.lit(0).cast("long"))
    total = part("^[+-]?P([0-9]+)W") * 604_800 + part("^[+-]?P(?:[0-9]+W)?([0-9]+)D") * 86_400 + part("T([0-9]+)H") * 3600 + part("T(?:[0-9]+H)?([0-9]+)M") * 60 + part("T(?:[0-9]+H)?(?:[0-9]+M)?([0-9]+)S$")
    good = text.rlike("^[+-]?P(?=.)([0-9]+W)?([0-9]+D)?(T(?=.)([0-9]+H)?([0-9]+M)?([0-9]+S)?)?$")
    return F.when(good, F.when(F.startswith(text, F.lit("-")), -total).otherwise(total))


def calendar_end(start_stamp: Column, start: Column, end_stamp: Column, end_zone: Column, duration: Column, default: str = "America/Vancouver") -> Column:
    """The end of an event: as given (of whole days it is exclusive, so a second less), else by the duration, else the day's last second or
    an hour later."""
    days = start_stamp.rlike("^[0-9]{8}$")
    given = calendar_instant(end_stamp, end_zone, default)
    otherwise = F.coalesce(_shifted(start, duration_seconds(duration)), F.when(days, _shifted(start, 86_399)).otherwise(_shifted(start, 3600)))
    return F.when(end_stamp.isNotNull(), F.when(days, _shifted(given, -1)).otherwise(given)).otherwise(otherwise)


#: Phrases of relative time, in the order in which they are sought, with their seconds.
RELATIVE = ((r"(?i)([0-9]+)\s*min(?:ute)?s?\s+ago", 60), (r"(?i)([0-9]+)\s*h(?:ou)?rs?\s+ago", 3600), (r"(?i)([0-9]+)\s*d(?:ay)?s?\s+ago", 86_400), (r"(?i)yesterday", 86_400), (r"(?i)([0-9]+)\s*w(?:ee)?ks?\s+ago", 604_800))
_MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"


def relative_instant(text: Column, as_of: Column) -> Column:
    """``as_of`` less what the first kind of phrase that occurs in ``text`` says."""
    out = F
    for pattern, seconds in RELATIVE:
        amount = F.lit(1) if "(" not in pattern[4:] else F.regexp_extract(text, pattern, 1).try_cast("long")
        out = out.when(text.rlike(pattern), _shifted(as_of, -amount * seconds))
    return out.otherwise(F.lit(None).cast("timestamp"))


def written_date(text: Column) -> Column:
    """The date of a phrase such as ``May 22, 2025``."""
    return F.try_to_timestamp(F.regexp_replace(text, r"\s+", " "), F.lit("MMMM d, yyyy"))


def lenient_instant(text: Column) -> Column:
    """An instant as pages write it: with an offset, without one (UTC), or a day."""
    text = F.trim(text)
    return F.coalesce(F.try_to_timestamp(F.regexp_replace(text, r"\.[0-9]+", ""), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp(F.regexp_replace(text, r"\.[0-9]+", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")), written_date(text))


def _first(found: Column) -> Column:
    """The first of an array of instants that is one."""
    return F.get(F.array_compact(found), F.lit(0))


def published(html: Column, rule: Column, as_of: Column) -> Column:
    """(at, confidence) of a page. ``rule`` is the kind of its domain: ``list`` (dates in lists), ``publication`` (``Published May 22, 2025``),
    ``forum`` (time elements, then dates in elements classed so, then relative phrases), ``docs`` (``Last updated``), or null. Where that
    finds nothing the meta tags decide."""
    html = F.coalesce(html, F.lit(""))
    day = lambda p: _first(F.transform(F.slice(F.regexp_extract_all(html, F.lit(p), F.lit(1)), F.lit(1), F.lit(1)), written_date))
    every = lambda p: _first(F.transform(F.regexp_extract_all(html, F.lit(p), F.lit(1)), lenient_instant))
    timed = every(r"""(?is)<(?:time|relative-time)\b[^>]*?\bdatetime\s*=\s*["']([^"']+)["']""")
    classed = every(r"""(?is)<(?:span|div|time)\b[^>]*?\bclass\s*=\s*["'][^"']*(?:date|time)[^"']*["'][^>]*>([^<]*)<""")
    text = F.substring(F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", ""), r"(?s)<[^>]*>", ""), 1, 5000)  # the rule itself looks no further
    answer = lambda at, sure: F.when(at.isNotNull(), F.struct(at.alias("at"), F.lit(sure).alias("confidence")))
    by_rule = (
        F.when(rule == "list", answer(day(rf"({_MONTH}\s+[0-9]{{1,2}},\s+[0-9]{{4}})"), 0.8))
        .when(rule == "publication", answer(day(rf"Published\s+({_MONTH}\s+[0-9]{{1,2}},\s+[0-9]{{4}})"), 0.9))
        .when(rule == "forum", F.coalesce(answer(timed, 0.95), answer(classed, 0.85), answer(relative_instant(text, as_of), 0.75)))
        .when((rule == "docs") & F.contains(html, F.lit("Last updated")), answer(as_of, 0.3))
    )
    named = r"""(?:property|name)\s*=\s*["'][^"']*(?:article:published_time|date)[^"']*["']"""
    meta = every(rf"""(?is)<meta\b[^>]*?{named}[^>]*?\bcontent\s*=\s*["']([^"']+)["']""")
    reversed_ = every(rf"""(?is)<meta\b[^>]*?\bcontent\s*=\s*["']([^"']+)["'][^>]*?{named}""")
    return F.coalesce(by_rule, answer(F.coalesce(meta, reversed_), 0.8))
