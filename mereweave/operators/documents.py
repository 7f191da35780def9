"""Document preparation: chunking, sentence windows, HTML blocks, calendar times."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from html.parser import HTMLParser
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def char_windows(df: DataFrame, id_col: str, text_col: str, size: int, overlap: int) -> DataFrame:
    """(id, index, chunk): character windows with a stride of ``size - overlap``."""
    stride = size - overlap
    n = F.length(text_col)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(stride)))
    windows = F.transform(starts, lambda s: F.substring(F.col(text_col), s + 1, F.lit(size)))  # windows are cut before rows are made: no row carries the text
    return df.select(id_col, F.posexplode(windows).alias("index", "chunk"))


def token_windows(df: DataFrame, id_col: str, text_col: str, size: int, overlap: int) -> DataFrame:
    """(id, index, start_token, end_token, total_chunks, chunk): windows of white-space tokens. The last window is the one
    that reaches the end, so that the walk always ends."""
    stride = size - overlap
    tokens = F.filter(F.split(F.trim(F.regexp_replace(text_col, r"\s+", " ")), " "), lambda t: t != "")
    t = df.select(id_col, tokens.alias("tokens")).where(F.size("tokens") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("tokens") - size) / stride)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("tokens", i * stride + 1, F.lit(size)), " "))
    w = t.select(id_col, F.size("tokens").alias("n"), (last + 1).alias("total_chunks"), F.posexplode(windows).alias("index", "chunk"))
    start = F.col("index") * stride
    return w.select(id_col, "index", start.cast("long").alias("start_token"), F.least(start + size, F.col("n")).cast("long").alias("end_token"), F.col("total_chunks").cast("long").alias("total_chunks"), "chunk")


_SENTENCE_END = re.compile(r"[.!?][\"')\]]*$")


def sentence_spans(tokens: list[str], size: int, overlap: int, least: int) -> list[tuple[int, int]]:
    """Token windows that end at a sentence end when one lies in their last fifth; a tail shorter than ``least``
    joins the window before it."""
    spans, start, n = [], 0, len(tokens)
    while start < n:
        end = min(start + size, n)
        if end < n:
            for back in range(end, max(start + 1, end - size // 5) - 1, -1):
                if _SENTENCE_END.search(tokens[back - 1]):
                    end = back
                    break
        if spans and end - start < least:
            spans[-1] = (spans[-1][0], end)
        else:
            spans.append((start, end))
        if end >= n:
            break
        start = max(end - overlap, start + 1)
    return spans


def sentence_windows(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50, least: int = 100) -> DataFrame:
    """(id, index, start_token, end_token, total_chunks, chunk): the windows of ``sentence_spans``, in columns.

    A text's sentence ends are found once; the walk folds over as many steps as it can take at most, each of which looks for the last end
    in the last fifth of its window. A null text, or one without a token, gives no rows.
    """
    tokens = F.filter(F.split(F.col(text_col), r"(?U)[\s\x1c-\x1f]+"), lambda t: t != "")
    ends = F.filter(F.transform(F.col("tokens"), lambda t, i: F.when(t.rlike("[.!?][\"')\\]]*$"), i + 1)), lambda i: i.isNotNull())
    t = df.select(id_col, tokens.alias("tokens")).where(F.size("tokens") > 0).withColumn("n", F.size("tokens")).withColumn("ends", ends)
    n, fifth = F.col("n"), size // 5

    def after(a: Column, end: Column) -> Column:
        spans, joins = a["spans"], (F.size(a["spans"]) > 0) & (end - a["start"] < least)
        last = F.struct(F.element_at(spans, -1)["a"].alias("a"), end.alias("b"))
        grown = F.when(joins, F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(last))).otherwise(F.concat(spans, F.array(F.struct(a["start"].alias("a"), end.alias("b")))))
        return F.struct(F.when(end >= n, n).otherwise(F.greatest(end - overlap, a["start"] + 1)).alias("start"), grown.alias("spans"))

    def step(a: Column) -> Column:
        full = F.least(a["start"] + size, n)
        found = F.array_max(F.filter("ends", lambda x: (x <= full) & (x >= F.greatest(a["start"] + 1, full - fifth))))
        end = F.when(full < n, F.coalesce(found, full)).otherwise(n)
        return F.when(a["start"] >= n, a).otherwise(F.transform(F.array(end), lambda e: after(a, e))[0])  # the end is looked for once

    begin = F.struct(F.lit(0).alias("start"), F.expr("cast(array() as array<struct<a: int, b: int>>)").alias("spans"))
    steps = F.sequence(F.lit(0), F.ceil(n / max(1, size - fifth - overlap)).cast("int") + 1)
    walked = t.withColumn("spans", F.aggregate(steps, begin, lambda a, _: step(a), lambda a: a["spans"]))
    cut = F.transform("spans", lambda s: F.struct(s["a"].alias("start_token"), s["b"].alias("end_token"), F.array_join(F.slice("tokens", s["a"] + 1, s["b"] - s["a"]), " ").alias("chunk")))
    w = walked.select(id_col, F.size("spans").alias("total_chunks"), F.posexplode(cut).alias("index", "w"))
    return w.select(id_col, "index", "w.start_token", "w.end_token", "total_chunks", "w.chunk")


class _Blocks(HTMLParser):
    """Text of block elements, without scripts, styles and page furniture."""

    skip = frozenset(("script", "style", "nav", "footer", "aside", "noscript"))
    block = frozenset(("p", "div", "article", "section", "li", "h1", "h2", "h3", "h4", "td", "blockquote", "br"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.now, self.title, self.in_title = 0, [], [], [], False

    def flush(self):
        text = " ".join("".join(self.now).split())
        self.now = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.skip
        self.in_title = tag == "title" or (self.in_title and tag != "body")
        if tag in self.block:
            self.flush()

    def handle_endtag(self, tag):
        self.depth -= tag in self.skip and self.depth > 0
        if tag == "title":
            self.in_title = False
        if tag in self.block:
            self.flush()

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.depth:
            self.now.append(data)


def without_contained(blocks: list[str]) -> list[str]:
    """Blocks that are no part of an earlier kept one: an automaton of all blocks reads each kept one once and marks what it holds."""
    if len(blocks) < 8:
        kept: list[str] = []
        for b in blocks:
            if not any(b in k for k in kept):
                kept.append(b)
        return kept
    import ahocorasick

    a = ahocorasick.Automaton()
    number = {b: i for i, b in enumerate(dict.fromkeys(blocks))}
    for b, i in number.items():
        a.add_word(b, i)
    a.make_automaton()
    held, kept = set(), []
    for b in blocks:
        if number[b] not in held:
            kept.append(b)
            held.update(i for _, i in a.iter(b))
    return kept


def page_text(source: str | None) -> str:
    """Title and block texts of a page; a block that is part of an earlier one is dropped."""
    p = _Blocks()
    p.feed(source or "")
    p.flush()
    kept = without_contained(p.blocks)
    title = " ".join("".join(p.title).split())
    return "\n".join(([title] if title and title not in kept else []) + kept)


def page_texts(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({id_col: f[id_col], "content": [page_text(h) for h in f[html_col]]})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, html_col).mapInPandas(run, f"{id_col} {kind}, content string")


def calendar_utc(stamp: str, zone: str | None = None, default: str = "America/Vancouver") -> datetime:
    """A calendar time as UTC: ``Z`` as it is, a date as its midnight, floating times in the default zone. A time in a gap of
    the clock moves forward by the gap, a repeated one is its first occurrence."""
    if len(stamp) == 8:
        return datetime.strptime(stamp, "%Y%m%d").replace(tzinfo=timezone.utc)
    if stamp.endswith("Z"):
        return datetime.strptime(stamp, "%Y%m%dT%H%M%SZ").replace(tzinfo=timezone.utc)
    local = datetime.strptime(stamp, "%Y%m%dT%H%M%S").replace(tzinfo=ZoneInfo(zone or default))
    return local.astimezone(timezone.utc)


def duration(text: str) -> timedelta:
    """An ISO calendar duration such as ``P1DT2H30M``."""
    m = re.fullmatch(r"([+-]?)P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?", text)
    if not m:
        raise ValueError(f"no duration: {text}")
    weeks, days, hours, minutes, seconds = (int(x or 0) for x in m.groups()[1:])
    d = timedelta(weeks=weeks, days=days, hours=hours, minutes=minutes, seconds=seconds)
    return -d if m.group(1) == "-" else d


def parse_date(text: Column) -> Column:
    """A feed date: the RFC 822 form, then ISO forms, then plain dates; null where none fits."""
    return F.coalesce(
        F.try_to_timestamp(F.regexp_replace(text, r"^[A-Za-z]{3}, ", ""), F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(F.regexp_replace(text, r"\+00:00$", "Z"), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
    )


def flatten_property(value: Column) -> Column:
    """The text of a typed note property given as JSON: thirteen kinds, of which mail addresses and telephone numbers give null, as
    other kinds and properties without a value do. Lists are joined by a comma and a space: people by id, relations distinct and sorted.
    """
    get = lambda path: F.get_json_object(value, path)
    items = lambda kind, fields: F.from_json(get(f"$.{kind}"), f"array<struct<{fields}>>")
    joined = lambda found, name: F.array_join(F.transform(found, lambda x: x[name]), ", ")
    texts = lambda kind: F.array_join(F.transform(items(kind, "plain_text: string"), lambda x: x["plain_text"]), "")
    kind, out = get("$.type"), F
    for name, flat in (
        ("title", texts("title")), ("rich_text", texts("rich_text")), ("number", get("$.number")), ("select", get("$.select.name")), ("multi_select", joined(items("multi_select", "name: string"), "name")), ("status", get("$.status.name")),
        ("date", get("$.date.start")), ("people", joined(F.array_sort(items("people", "id: string, name: string")), "name")), ("checkbox", F.coalesce(get("$.checkbox"), F.lit("false"))), ("url", get("$.url")),
        ("relation", F.array_join(F.array_sort(F.array_distinct(F.transform(items("relation", "id: string"), lambda x: x["id"]))), ", ")), ("email", F.lit(None)), ("phone_number", F.lit(None)),
    ):
        out = out.when(kind == name, flat)
    return out
