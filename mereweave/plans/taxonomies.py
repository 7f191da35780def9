"""Tags and categories over whole documents, to each of which a few words of the vocabularies are added by its number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomies as x
from .registry import query
from .views import Views

_WORDS = tuple(dict.fromkeys(term for rules in (x.FORUM, x.ARTICLES, x.MESSAGES) for _, terms in rules for term in terms))
_ROOMS = ("General chat", "dev-help", "News and announcements", "governance-tech", "random", "support")
_PREFIXES = ("github_", "soundcloud_", "Website_", "discourse_", "forum_", "medium_", "blog_", "Governance-", "credit-", "notes-", "methodology ")


def _pick_sql(values: tuple, step: int) -> str:
    return f"[{', '.join(repr(w) for w in values)}][(doc_id * {step}) % {len(values)} + 1]"


def _pick(values: tuple, step: int):
    return F.element_at(F.array(*map(F.lit, values)), ((F.col("doc_id") * step) % len(values) + 1).cast("int"))


_NOTED = f"noted as (select doc_id, source, text || ' ' || {_pick_sql(_WORDS, 1)} || case when doc_id % 3 = 0 then ' ' || upper({_pick_sql(_WORDS, 7)}) else '' end as text from documents)"


def _noted(v: Views) -> DataFrame:
    more = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), F.upper(_pick(_WORDS, 7)))).otherwise("")
    return v.table("documents").select("doc_id", "source", F.concat("text", F.lit(" "), _pick(_WORDS, 1), more).alias("text"))


def _case(text: str, rules: tuple) -> str:
    return ", ".join("case when " + " or ".join(f"contains(lower(coalesce({text}, '')), '{t}')" for t in terms) + f" then '{tag}' end" for tag, terms in rules)


@query("str_15_forum_tags", f"with {_NOTED} select doc_id, array_to_string(list_sort(list_distinct(list_filter([source, {_case('text', x.FORUM)}], lambda t: t is not null))), ',') as tags from noted")
def forum_tags(v: Views) -> DataFrame:
    return _noted(v).select("doc_id", F.array_join(x.forum_tags(F.col("text"), F.array("source")), ",").alias("tags"))


@query("str_15_article_tags", f"with {_NOTED} select doc_id, array_to_string(list_filter([{_case('text', x.ARTICLES)}], lambda t: t is not null), ',') as tags from noted")
def article_tags(v: Views) -> DataFrame:
    return _noted(v).select("doc_id", F.array_join(x.article_tags(F.col("text")), ",").alias("tags"))


@query("str_15_message_tags", f"""
with {_NOTED}, m as (select *, {_pick_sql(_ROOMS, 1)} as room from noted)
select doc_id, array_to_string(list_sort(list_distinct(list_filter([{_case('room', x.CHANNELS)}, {_case('text', x.MESSAGES)}, 'guild:the-' || lower(source), case when doc_id % 2 = 0 then 'has-attachments' end, case when doc_id % 5 = 0 then 'has-embeds' end, case when doc_id % 7 = 0 then 'pinned' end], lambda t: t is not null))), ',') as tags from m""")
def message_tags(v: Views) -> DataFrame:
    d = F.col("doc_id")
    found = x.message_tags(F.col("text"), _pick(_ROOMS, 1), F.concat(F.lit("The "), "source"), d % 2 == 0, d % 5 == 0, d % 7 == 0)
    return _noted(v).select("doc_id", F.array_join(found, ",").alias("tags"))


@query("str_24_file_categories", f"with f as (select {_pick_sql(_PREFIXES, 1)} || source || '-' || doc_id || '.json' as name from documents) select coalesce({_case('name', x.FILES)}, 'other') as category, count(*) as files, min(name) as first from f group by 1")
def file_categories(v: Views) -> DataFrame:
    """How many files each category has, all documents taken as files named by their source."""
    name = F.concat(_pick(_PREFIXES, 1), "source", F.lit("-"), "doc_id", F.lit(".json"))
    f = v.table("documents").select(name.alias("name"))
    return f.groupBy(x.file_category(F.col("name")).alias("category")).agg(F.count("*").alias("files"), F.min("name").alias("first"))
