"""Column functions on identifiers and text. All stay inside Spark's own expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage with nothing for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def namespace(rid: Column) -> Column:
    """The namespace of a resource id: ``orn:<ns>:...``; null for web addresses; else what stands before the first colon."""
    orn = F.regexp_extract(rid, r"^orn:([^:]+):", 1)
    head = F.regexp_extract(rid, r"^([^:/]+):", 1)
    return F.when(orn != "", orn).when(rid.rlike("^(https?|ftp):"), F.lit(None)).when(head != "", head)


def rid_context(rid: Column) -> Column:
    """``scheme:namespace`` of orn and urn ids, else the scheme; null without a colon."""
    two = F.regexp_extract(rid, r"^((?:orn|urn):[^:]+):", 1)
    one = F.regexp_extract(rid, r"^([^:]+):", 1)
    return F.when(two != "", two).when(one != "", one)


def rid_reference(rid: Column) -> Column:
    context = rid_context(rid)
    return F.when(context.isNotNull(), F.substring(rid, F.length(context) + 2, F.length(rid)))


def hashed_id(prefix: str, value: Column) -> Column:
    """``prefix`` and the first 16 hex digits of the value's SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(value, 256), 1, 16))


def slug(name: Column) -> Column:
    """Lower case, spaces to hyphens, 50 characters at most, then only ``a-z0-9-_``."""
    return F.regexp_replace(F.substring(F.replace(F.lower(name), F.lit(" "), F.lit("-")), 1, 50), r"[^a-z0-9\-_]", "")


#: Sensor prefixes in the order they are tried; the longer of two overlapping ones first.
PREFIXES = ("website", "discourse", "github-activity", "github", "gitlab", "notion", "podcast")


def sensor_by_prefix(name: Column) -> Column:
    out = F.when(F.startswith(name, F.lit(PREFIXES[0])), PREFIXES[0])
    for p in PREFIXES[1:]:
        out = out.when(F.startswith(name, F.lit(p)), p)
    return out.otherwise("other")


#: Sensor kinds found anywhere in a name, in the order they are tried.
KINDS = ("website", "discourse", "github", "gitlab", "notion", "podcast", "telegram", "discord", "twitter", "medium")


def sensor_by_substring(name: Column) -> Column:
    out = F.when(F.contains(name, F.lit(KINDS[0])), KINDS[0])
    for k in KINDS[1:]:
        out = out.when(F.contains(name, F.lit(k)), k)
    return out.otherwise("unknown")


def sensor_base_name(node: Column) -> Column:
    """What stands up to ``-sensor``, else the text before the first hyphen."""
    base = F.regexp_extract(node, r"^(.*?-sensor)", 1)
    return F.when(base != "", base).otherwise(F.substring_index(node, "-", 1))


#: Redactions in the order they are applied, any case; each leaves a mark of its kind.
_ANY_SPACE = r"[\s\x1c-\x1f]"
REDACTIONS = (
    (r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z|]{2,}\b", "[REDACTED_EMAIL]"),
    (r"(?i)(?:(?:https?://)?(?:t\.me|telegram\.me)/|@)[A-Za-z0-9_]{5,32}", "[REDACTED_TELEGRAM]"),
    (rf"(?U)(?:\+\d{{1,3}}(?:[-.]|{_ANY_SPACE})?)?\(?\d{{3}}\)?(?:[-.]|{_ANY_SPACE})?\d{{3}}(?:[-.]|{_ANY_SPACE})?\d{{4}}", "[REDACTED_PHONE]"),
    (r"(?U)\b[A-Za-z0-9_]+#\d{4}\b", "[REDACTED_DISCORD]"),
)


def redact(text: Column) -> Column:
    for pattern, mark in REDACTIONS:
        text = F.regexp_replace(text, pattern, mark)
    return text


#: Secrets in the order they are removed, each with its own mark. White space is Python's, as in the source.
_SPACE = r"\s\x1c-\x1f"
SECRETS = (
    (rf"""(?U)\b[A-Z_]{{2,}}=(?:"[^"]*"|'[^']*'|[^{_SPACE}]+)""", "[REDACTED_ENV]"),
    (r"(?U)\b(sk-[a-zA-Z0-9]{20,}|ghp_[a-zA-Z0-9]{20,}|ghu_[a-zA-Z0-9]{20,}|github_pat_[a-zA-Z0-9_]{20,})", "[REDACTED_KEY]"),
    (rf"(?U)Bearer[{_SPACE}]+[a-zA-Z0-9._\-]{{20,}}", "Bearer [REDACTED]"),
    (r"-----BEGIN[A-Z ]*PRIVATE KEY-----[\s\S]*?-----END[A-Z ]*PRIVATE KEY-----", "[REDACTED_PRIVATE_KEY]"),
    (rf"(?U)(postgresql|postgres|mongodb|mysql|redis)://[^{_SPACE}]+", "[REDACTED_CONN_STRING]"),
    (rf"(?U)https?://[^:]+:[^@]+@[^{_SPACE}]+", "[REDACTED_URL_CREDS]"),
    # a hit takes its whole run, so it is only sought from a run's start
    (r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{50,}={0,2}", "[REDACTED_BASE64]"),
    # a hit takes its whole word, so it is only sought from a word's start
    (rf"(?U)(?<![^{_SPACE}])[^{_SPACE}]*(?:\.env|credentials|secrets|\.pem|\.key)[^{_SPACE}]*", "[REDACTED_PATH]"),
)


#: For each secret, literals of which every hit holds one (of each group): a text without them is not searched.
_SECRET_SIGNS = ((("=",),), (("sk-", "ghp_", "ghu_", "github_pat_"),), (("Bearer",),), (("-----BEGIN",), ("PRIVATE KEY-----",)), (("://",),), (("http",), ("://",), ("@",)), (), ((".env", "credentials", "secrets", ".pem", ".key"),))


def redact_secrets(text: Column) -> Column:
    """The secrets' marks in their places. Each step is a lambda over one value, so that its text is found once though it is named thrice."""

    def step(pattern: str, mark: str, signs: tuple) -> Callable[[Column], Column]:
        has = lambda x: reduce(and_, [reduce(or_, [F.contains(x, F.lit(s)) for s in group]) for group in signs], F.lit(True))
        return lambda x: F.when(has(x), F.regexp_replace(x, pattern, mark)).otherwise(x)

    for (pattern, mark), signs in zip(SECRETS, _SECRET_SIGNS, strict=True):
        text = F.get(F.transform(F.array(text), step(pattern, mark, signs)), F.lit(0))
    return text


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))


def strip_tags(html: Column) -> Column:
    """Text of simple HTML: scripts, styles and tags removed, the basic references decoded, white space collapsed."""
    text = F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse(text)


def clean_url(url: Column) -> Column:
    """An address without fragment, ``utm_*`` and other tracking parameters, and without a trailing slash."""
    base = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    query = F.when(F.contains(url, F.lit("?")), F.substring_index(F.regexp_extract(url, r"\?([^#]*)", 1), "#", 1)).otherwise("")
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|fbclid|gclid|ref|mc_cid|mc_eid)=")), "&")
    return F.concat(F.regexp_replace(base, "/$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def tags(text: Column, taxonomy: dict[str, tuple[str, ...]]) -> Column:
    """Sorted tags whose keywords occur in the text (any case)."""
    low = F.lower(text)
    found = []
    for tag, keywords in taxonomy.items():
        hit = F.lit(False)
        for k in keywords:
            hit = hit | F.contains(low, F.lit(k))
        found.append(F.when(hit, F.lit(tag)))
    return F.array_sort(F.array_compact(F.array(*found)))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def thirds(text: Column, most: int) -> Column:
    """A text of over ``most`` characters as its first, middle and last part of a third of that each, with marks between."""
    part, n = most // 3, F.length(text)
    middle = F.substring(text, F.floor(n / 2).cast("int") - part // 2 + 1, F.lit(part))
    return F.when(n <= most, text).otherwise(F.concat(F.substring(text, 1, part), F.lit("\n\n[...middle...]\n\n"), middle, F.lit("\n\n[...end...]\n\n"), F.right(text, F.lit(part))))


def thread_id(references: Column, reply_to: Column, own: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of a mail's root: first reference, else what it replies to, else itself."""
    first = lambda c: F.nullif(F.regexp_extract(c, r"(<[^>]+>)", 1), F.lit(""))
    return F.substring(F.sha2(F.coalesce(first(references), first(reply_to), own), 256), 1, 16)


#: Words of a professional tone, and informal ones by group.
PROFESSIONAL = tuple("announced confirmed launched released published verified documented recorded achieved completed established implemented".split())
INFORMAL = (r"\b(lol|omg|wtf|tbh|imo|imho)\b", r"\b(gonna|wanna|gotta|kinda|sorta)\b", r"\b(awesome|amazing|incredible|unbelievable)\b")


def calm_capitals(text: Column) -> Column:
    """Words of more than three capitals in a text of over 30 % capitals (and over ten letters) are written like others."""
    letters, capitals = F.length(F.regexp_replace(text, r"[^\p{L}]", "")), F.length(F.regexp_replace(text, r"[^\p{Lu}]", ""))
    words = F.filter(F.split(text, r"[ \t\n\r\f]+"), lambda w: w != "")
    loud = lambda w: (F.length(w) > 3) & ~w.rlike(r"\p{Ll}") & w.rlike(r"\p{Lu}") & ~F.startswith(w, F.lit("#"))
    fixed = F.array_join(F.transform(words, lambda w: F.when(loud(w), F.concat(F.substring(w, 1, 1), F.lower(F.substring(w, 2, 1 << 30)))).otherwise(w)), " ")
    return F.when((letters > 10) & (capitals / letters > 0.3), fixed).otherwise(text)


def styled(text: Column) -> Column:
    """(content, score) by the style rules: capitals, repeated punctuation and speculation are mended, each costing points, as does a
    low professional tone; no score is below 0."""
    calm = calm_capitals(text)
    quiet = F.regexp_replace(F.regexp_replace(F.regexp_replace(calm, "!{3,}", "!"), r"\?{3,}", "?"), r"\.{4,}", "...")
    low, content, points = F.lower(quiet), quiet, F.lit(0.0)
    for phrase in ("might be", "could be"):
        points = points + F.when(F.contains(low, F.lit(phrase)), 0.2).otherwise(0.0)
    content = F.when(F.contains(low, F.lit("might be")) | F.contains(low, F.lit("could be")), F.regexp_replace(content, r"(?i)\b(might|could)\s+be\b", "is")).otherwise(content)
    for word in ("possibly", "potentially"):
        held = F.contains(low, F.lit(word))
        points = points + F.when(held, 0.2).otherwise(0.0)
        content = F.when(held, F.trim(F.regexp_replace(F.regexp_replace(content, rf"(?i)\b{word}\b", ""), r"[ \t\n\r\f]+", " "))).otherwise(content)
    end = F.lower(content)
    marks, informal = F.lit(0), F.lit(0)
    for w in PROFESSIONAL:
        marks = marks + F.when(F.contains(end, F.lit(w)), 1).otherwise(0)
    for p in INFORMAL:
        informal = informal + F.when(end.rlike(p), 1).otherwise(0)
    tone = F.greatest(F.lit(0.0), F.when(marks > 0, F.least(F.lit(1.0), marks * 0.3)).otherwise(0.5) - informal * 0.2)
    cost = F.when(calm != text, 0.1).otherwise(0.0) + F.when(quiet != calm, 0.1).otherwise(0.0) + points + F.when(F.round(tone, 6) < 0.5, 0.2).otherwise(0.0)
    return F.struct(content.alias("content"), F.greatest(F.lit(0.0), F.round(1 - cost, 6)).alias("score"))
