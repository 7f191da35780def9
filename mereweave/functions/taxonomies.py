"""Tags and categories by fixed keyword lists, as columns. The lists are those of forum posts, articles, channel messages and
files, in their order. A network's own name is no fixed value: give it as ``own`` where it should count as a keyword."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORUM = (
    ("governance", ("proposal", "vote", "voting", "governance")), ("ecocredit", ("credit", "carbon", "batch", "retire")), ("marketplace", ("marketplace", "sell", "buy", "trade")), ("validator", ("validator", "stake", "delegation")),
    ("tokenomics", ("token", "tokenomics")), ("community", ("community", "commons", "dao")),
)
ARTICLES = (
    ("governance", ("governance", "proposal", "voting", "dao")), ("ecocredits", ("ecocredit", "credit", "carbon", "biodiversity", "nature-based")), ("marketplace", ("marketplace", "trading", "buying", "selling", "registry")),
    ("methodology", ("methodology", "protocol", "standard", "verification")), ("development", ("development", "technical", "blockchain", "cosmos", "sdk")), ("community", ("community", "commons", "regenerative", "ecosystem")),
    ("climate", ("climate", "climate change", "emissions", "sustainability")), ("agriculture", ("agriculture", "farming", "soil", "regenerative agriculture")), ("finance", ("finance", "refi", "investment", "funding", "tokenomics")),
)
CHANNELS = (("general", ("general",)), ("announcement", ("announce", "news")), ("governance", ("govern",)), ("development", ("dev", "tech")), ("support", ("help", "support")))
MESSAGES = (("governance", ("proposal", "vote")), ("climate", ("carbon", "climate")), ("ecological", ("eco",)))
FILES = (
    ("technical", ("github_",)), ("podcast", ("soundcloud_",)), ("website", ("website_",)), ("forum", ("discourse_", "forum_")), ("blog", ("medium_", "blog_")), ("governance", ("governance", "proposal", "vote")),
    ("registry", ("registry", "credit", "methodology")),
)


def _found(text: Column, rules: tuple) -> list[Column]:
    low = F.lower(F.coalesce(text, F.lit("")))
    any_of = lambda terms: F.exists(F.array(*map(F.lit, terms)), lambda term: F.contains(low, term))
    return [F.when(any_of(terms), F.lit(tag)) for tag, terms in rules]


def _tags(*each: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*each))))


def _with_own(rules: tuple, tag: str, own: str | None) -> tuple:
    return rules if own is None else tuple((t, (*terms, own) if t == tag else terms) for t, terms in rules)


def forum_tags(text: Column, given: Column | None = None, own: str | None = None) -> Column:
    """Sorted tags of a topic: those it has, and those of its content."""
    found = _tags(*_found(text, _with_own(FORUM, "tokenomics", own)))
    return found if given is None else F.array_sort(F.array_distinct(F.array_compact(F.concat(F.coalesce(given, F.array().cast("array<string>")), found))))


def article_tags(text: Column) -> Column:
    """Tags of an article, in the order of the list."""
    return F.array_compact(F.array(*_found(text, ARTICLES)))


def message_tags(text: Column, channel: Column, guild: Column, attachments: Column, embeds: Column, pinned: Column, own: str | None = None) -> Column:
    """Sorted tags of a message: by channel, content, guild (none where null), and whether it has attachments or embeds or is pinned."""
    named = F.concat(F.lit("guild:"), F.replace(F.lower(guild), F.lit(" "), F.lit("-")))
    kinds = [F.when(attachments, "has-attachments"), F.when(embeds, "has-embeds"), F.when(pinned, "pinned")]
    extra = () if own is None else ((own, (own,)),)
    return _tags(*_found(channel, CHANNELS), *_found(text, MESSAGES + extra), named, *kinds)


def file_category(name: Column) -> Column:
    """One of eight categories, the first that matches; ``other`` for the rest and for null names."""
    return F.coalesce(*_found(name, FILES), F.lit("other"))
