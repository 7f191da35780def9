"""HTML main-text extraction by consensus host paths.

1. Every page is read into its containers. Containers are scored by the text in them that is no link and
   no boilerplate; the page's choice is its largest ``article`` or ``main`` with at least half of that
   text (the inner one of equals), else the deepest container with at least four fifths of it.
2. The choices' generalised paths (tags and classes from the root, digits removed) are counted per
   host in Spark: a vote per page. The path with most votes wins (ties: the smaller text).
3. Every page is read again by its host's winning path; where a page has no such container its own
   choice stands. The winners go to the pages by broadcast while they are checked to be under ``broadcast_bytes``; beyond it
   by a join on (host, share), for which every host's pages are dealt over ``SHARES`` shares, so no host is one task's.

The text is the container's without boilerplate elements (see ``_EXCLUDED`` and ``_BOILERPLATE``), with the page's
other headings and paragraphs that are no boilerplate, character references decoded, white space within a block
turned into one space, blocks joined by one space. A host's path alone decides where those others outweigh it.

A class, id or role marks boilerplate if all words of one of its tokens do (``cookie-notice``, not ``has-sidebar``), and so
does a ``form``, but never an element that holds an ``article`` or ``main``, or, on a page with neither, more than half of the
text.

Reading takes time and memory in proportion to the page: a tag's quoted values may hold ``<`` up to a length, a tag that the
page's end cuts off is no text, paths are kept as checksums along the tree and spelled out where they are asked for.

Nulls and edges: a null html is empty and gives empty text; a page without a host (null or odd url)
uses its own choice; a page that is all boilerplate gives empty text; repeated rows vote and are returned as
often as they come; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Cut, anti_clash, slices

# Element kinds of HTML and words that mark boilerplate in class and id attributes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_EXCLUDED = frozenset("aside button datalist dialog footer head iframe input menu nav noscript object script select style svg template textarea title".split())
_BOILERPLATE = frozenset("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted promotion related respond share sharing sidebar signup social sponsor sponsored subscribe subscription topbar widget".split())
#: Words that add nothing to a boilerplate word in a token.
_NEUTRAL = frozenset("bar block bottom box buttons global left links list main primary right secondary site top".split())
_OUTSIDE = frozenset("h1 h2 h3 h4 h5 h6 p".split())
_RAW = "script|style|noscript|template|textarea|title|iframe|svg"
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: An open element of these kinds keeps an implied end from reaching beyond it.
_FENCE = frozenset("ul ol dl table tbody thead tfoot article section main div body html blockquote".split())

#: What may stand in a tag: a value in quotes may hold "<" where it is no longer than 4,096; a tag has 2,000 parts at most.
_PARTS = r"""(?:[^'\"<>]++|"[^"<]*+"|'[^'<]*+'|"[^"]{0,4096}+"|'[^']{0,4096}+'){0,2000}+"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])({_PARTS})>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_PARTS})>|<(/?)([a-zA-Z][^\s/><]*+)[^<>]*+>|<[!?][^<>]*+>", re.S | re.I)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[a-z]+")


def _marks(token: str) -> bool:
    words = set(_WORDS.findall(token))
    return not words.isdisjoint(_BOILERPLATE) and words <= _BOILERPLATE | _NEUTRAL


class _Paths:
    """The paths of a page's containers, spelled out on demand."""

    def __init__(self, page: "Page"):
        self.page = page

    def __getitem__(self, k: int) -> str:
        steps = []
        while k:
            steps.append(self.page.step[k])
            k = self.page.parent[k]
        return "".join(reversed(steps))


class Page:
    """A page's containers (by number, in page order) and its text runs."""

    def __init__(self, source: str):
        self.tag, self.parent, self.step, self.sum, self.out = ["#root"], [0], [""], [0], [False]
        self.path = _Paths(self)
        self.in_link, self.in_main = [False], [False]
        self.runs: list[tuple[int, str]] = []  # (container, text); an empty text breaks a block
        self.linked: list[bool] = []
        self.marked = [False]  # by class, id or role
        self.open: dict[str, int] = {}
        stack, at = [0], 0
        end = source.rfind(">") + 1  # no tag ends after it
        for m in _TOKEN.finditer(source, 0, end):
            if m.start() > at:
                self._text(stack, source[at : m.start()])
            at = m.end()
            name = m.group(4) or m.group(7)
            if name is None:
                continue
            name = name.lower()
            if name in _BLOCK:
                self.runs.append((stack[-1], ""))
                self.linked.append(False)
            if m.group(3) or m.group(6):
                self._end(stack, name)
            elif name not in _VOID:
                self._start(stack, name, m.group(5) or "")
        rest = source[at:]
        cut = _CUT_OFF.search(rest, max(0, end - at))
        if cut:
            rest = rest[: cut.start()]
        if rest:
            self._text(stack, rest)
        self._drop_marked()

    def _drop_marked(self) -> None:
        """Marked elements go with all that is in them, but for those that hold the page's main part."""
        if not any(self.marked):
            return
        size = self._sizes()
        parts = [k for k, t in enumerate(self.tag) if t in ("article", "main") and not self.marked[k] and not self.out[k] and size[k]]
        holds = set()
        for k in parts:
            while k not in holds:
                holds.add(k)
                k = self.parent[k]
        for k in range(1, len(self.tag)):
            drop = self.marked[k] and self.tag[k] not in ("html", "body", "article", "main") and k not in holds and (bool(parts) or 2 * size[k] <= size[0])
            self.out[k] = self.out[k] or self.out[self.parent[k]] or drop

    def _sizes(self) -> list[int]:
        """The length of the text in each container that is no link and not out."""
        size = [0] * len(self.tag)
        for (k, text), link in zip(self.runs, self.linked, strict=True):
            if text and not link and not self.out[k]:
                size[k] += len(text.strip())
        for k in range(len(size) - 1, 0, -1):
            size[self.parent[k]] += size[k]
        return size

    def _text(self, stack: list[int], raw: str) -> None:
        self.runs.append((stack[-1], unescape(raw) if "&" in raw else raw))
        self.linked.append(self.in_link[stack[-1]])

    def _close(self, stack: list[int], k: int) -> None:
        """Closes the open elements from the stack's place ``k`` on."""
        for c in stack[k:]:
            self.open[self.tag[c]] -= 1
        del stack[k:]

    def _start(self, stack: list[int], name: str, attributes: str) -> None:
        if name in _BLOCK and self.open.get("p"):
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if self.tag[stack[k]] == "p":
                    self._close(stack, k)
                    break
                if self.tag[stack[k]] in _FENCE:
                    break
        ends = _CLOSES.get(name)
        if ends and any(self.open.get(e) for e in ends):
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] in ends:
                    self._close(stack, k)
                    break
                if self.tag[stack[k]] in _FENCE and self.tag[stack[k]] not in ends:
                    break
        above = stack[-1]
        classes, marked = "", False
        if attributes and not attributes.isspace():
            for key, *values in _ATTRIBUTE.findall(attributes):
                value = next((v for v in values if v), "").lower()
                if key.lower() == "class":
                    classes = ".".join(sorted(set(_DIGITS.sub("", value).split())))
                marked = marked or any(map(_marks, value.split()))
        gone = self.out[above] or name in _EXCLUDED or (name == "header" and not self.in_main[above])
        step = f"/{name}{'.' + classes if classes else ''}"
        self.tag.append(name)
        self.parent.append(above)
        self.step.append(step)
        self.sum.append(zlib.crc32(step.encode("utf-8", "surrogatepass"), self.sum[above]))
        self.out.append(gone)
        self.marked.append(marked or name == "form")
        self.in_link.append(self.in_link[above] or name == "a")
        self.in_main.append(self.in_main[above] or name in ("article", "main"))
        self.open[name] = self.open.get(name, 0) + 1
        stack.append(len(self.tag) - 1)

    def _end(self, stack: list[int], name: str) -> None:
        if self.open.get(name):
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] == name:
                    self._close(stack, k)
                    return

    def choice(self) -> int:
        """The container that the page itself would take."""
        score = self._sizes()
        total = score[0]
        if not total:
            return 0
        named = [k for k in range(len(score)) if self.tag[k] in ("article", "main") and not self.out[k] and 2 * score[k] >= total]
        if named:
            return min(named, key=lambda k: (-score[k], -k))
        best = 0
        for k in range(1, len(score)):
            if self.tag[k] in _BLOCK and self.tag[k] != "p" and not self.out[k] and 5 * score[k] >= 4 * total and self.parent_of(k, best):
                best = k
        return best

    def parent_of(self, k: int, above: int) -> bool:
        while k != above and k:
            k = self.parent[k]
        return k == above

    def text(self, path: str | None) -> str:
        """The text of all outermost containers of a path, or of the page's own choice, with other headings and paragraphs."""
        want = zlib.crc32(path.encode("utf-8", "surrogatepass")) if path else 0
        # the outermost containers of the path: paths grow downwards, so none lies in another
        start = {k for k in range(1, len(self.sum)) if self.sum[k] == want and not self.out[k] and self.path[k] == path} if path else set()
        by_path = bool(start)
        if not start:
            start = {self.choice()}
        inside = [False] * len(self.tag)
        for k in range(len(self.tag)):
            inside[k] = k in start or (k > 0 and inside[self.parent[k]])
        size = self._sizes()
        beside = [False] * len(self.tag)
        for k in range(1, len(self.tag)):
            beside[k] = not inside[k] and (beside[self.parent[k]] or (self.tag[k] in _OUTSIDE and size[k] > 0))
        tops = lambda of: sum(size[k] for k in range(1, len(of)) if of[k] and not of[self.parent[k]])
        if not by_path or tops(beside) <= tops(inside):
            inside = [a or b for a, b in zip(inside, beside, strict=True)]
        blocks, now = [], []
        for k, text in self.runs:
            if not text:
                blocks.append(" ".join("".join(now).split()))
                now = []
            elif inside[k] and not self.out[k]:
                now.append(text)
        blocks.append(" ".join("".join(now).split()))
        return " ".join(b for b in blocks if b)


def host_of(url: Column) -> Column:
    """Lower-case host without a leading ``www.``; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", F.regexp_replace(host, r"^www\.", ""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path that most pages of a host vote for; ``pages`` has host and html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 2 << 20):
            paths = []
            for source in batch.column(1).to_pylist():
                page = Page(source or "")
                paths.append(page.path[page.choice()] or None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], ["host", "path"])

    votes = pages.where("host is not null").select("host", "html").mapInArrow(run, "host string, path string")
    counted = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("n"))
    return counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("n"), F.col("path"))).alias("path"))


#: Shares over which the pages of each host are dealt.
SHARES = 64


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    kind = pages.schema[id_col].dataType.simpleString()
    own = anti_clash(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host_of(F.col("url")))
    winners = Cut(pages.sparkSession).keep(winning_paths(own))
    size = winners.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 64), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        joined = own.join(F.broadcast(winners), "host", "left")
    else:
        dealt = winners.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        joined = own.withColumn("share", F.pmod(F.xxhash64("page_id", "url"), F.lit(SHARES)).cast("int")).join(dealt, ["host", "share"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 2 << 20):
            texts = [Page(source or "").text(path) for source, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "path").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
