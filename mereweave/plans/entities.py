"""Extraction over whole documents with a dictionary that is derived from them: whitelist, semantic rules, hybrid merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import entities as e
from ..operators.kg import ENTITY_RULES
from .registry import query
from .views import Views

_NAMES_SQL = r"names as (select w as name, case when length(w) % 2 = 0 then 'Person' else 'Organization' end as kind, length(w) % 3 = 0 as core from (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[ \n]([A-Z][a-z]{5,})[ .,\n]', 1))) as w from documents) t group by w having count(*) >= 3)"
_NOTES_SQL = """notes as (select doc_id, text || chr(10) || 'Filed under C' || lpad((doc_id % 97)::varchar, 2, '0') || case doc_id % 4 when 0 then ' carbon' when 1 then ' and soil' else '' end || ', VM' || lpad((doc_id % 50)::varchar, 4, '0') || ' and P' || lpad((doc_id % 700)::varchar, 3, '0')
  || case when doc_id % 5 = 0 then '. C' || lpad((doc_id % 97)::varchar, 2, '0') || ' uses VM' || lpad((doc_id % 50)::varchar, 4, '0') else '' end || '. It must follow rule ' || doc_id || '. Written by Ann ' || case when doc_id % 3 = 0 then 'Guide' else 'Reeder' end || '.' as text from documents)"""
_MENU_SQL = "(" + " or ".join(f"contains(context, '{m}')" for m in e.MENU_MARKS) + ")"


def names(v: Views) -> DataFrame:
    """A dictionary of capitalised words that three documents hold."""
    w = v.table("documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[ \n]([A-Z][a-z]{5,})[ .,\n]"), F.lit(1)))).alias("name"))
    kept = w.groupBy("name").agg(F.count("*").alias("n")).where("n >= 3")
    return kept.select("name", F.when(F.length("name") % 2 == 0, "Person").otherwise("Organization").alias("kind"), (F.length("name") % 3 == 0).alias("core"))


def notes(v: Views) -> DataFrame:
    """Every document with a line that files it under a class, a methodology and a project."""
    d = F.col("doc_id")
    pad = lambda n, size: F.lpad((d % n).cast("string"), size, "0")
    kind = F.when(d % 4 == 0, " carbon").when(d % 4 == 1, " and soil").otherwise("")
    uses = F.when(d % 5 == 0, F.concat(F.lit(". C"), pad(97, 2), F.lit(" uses VM"), pad(50, 4))).otherwise("")
    line = F.concat(F.col("text"), F.lit("\nFiled under C"), pad(97, 2), kind, F.lit(", VM"), pad(50, 4), F.lit(" and P"), pad(700, 3), uses, F.lit(". It must follow rule "), d, F.lit(". Written by Ann "), F.when(d % 3 == 0, "Guide").otherwise("Reeder"), F.lit("."))
    return v.table("documents").select("doc_id", line.alias("text"))


_TYPE_SQL = "case when contains(near, 'carbon') then 'carbon' when contains(near, 'biodiversity') then 'biodiversity' when contains(near, 'soil') then 'soil' else 'unknown' end"


def _ids_sql(around: int) -> str:
    rules = " union all ".join(f"select doc_id, text, '{k}' as kind, unnest(list_distinct(regexp_extract_all(text, '{p.replace('(?U)', '')}', 1))) as value from notes" for k, p in e.IDENTIFIERS)
    return rf"""ids as (select doc_id as id, kind, value, case when kind = 'CreditClass' then {_TYPE_SQL} end as credit_type from (select *, lower(substr(text, greatest(1, spot - {around}), least({around}, spot - 1) + length(value) + {around})) as near
  from (select *, length(string_split_regex(text, '\b' || value || '\b')[1]) + 1 as spot from ({rules}) r) s) u)"""


_HITS_SQL = """words as (select distinct doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as word from notes),
 held as (select d.doc_id, n.name, n.kind, n.core, d.text, strpos(lower(d.text), lower(n.name)) as spot from notes d join names n on contains(lower(d.text), lower(n.name)))"""


@query("ext_02_names_and_ids", f"""
with {_NAMES_SQL}, {_NOTES_SQL}, {_HITS_SQL}, {_ids_sql(100)},
 good as (select h.*, substr(text, greatest(1, spot - 50), least(50, spot - 1) + length(name) + 50) as context from held h join words w on w.doc_id = h.doc_id and w.word = lower(h.name))
select doc_id as id, kind, name as value, null as credit_type from good where not {_MENU_SQL} union all select id, kind, value, credit_type from ids""")
def names_and_ids(v: Views) -> DataFrame:
    """Listed names outside menus, tables and headings, and identifiers, over whole documents."""
    return e.whitelist(notes(v), "doc_id", "text", names(v)).select("id", "kind", "value", "credit_type")


_SEMANTIC_SQL = f"""{_NAMES_SQL}, {_NOTES_SQL}, {_HITS_SQL}, {_ids_sql(50)},
 semantic as (select doc_id as id, kind, name as value, case when not core and kind = 'Organization' then 0.9::double else 0.95::double end as confidence from held where core or contains(text, name)
  union all select doc_id, 'Person', w, 0.8::double from (select distinct doc_id, unnest(list_concat(regexp_extract_all(text, '(?:by|author|written by)\\s+([A-Z][a-z]+ [A-Z][a-z]+)', 1), regexp_extract_all(text, '—\\s*([A-Z][a-z]+ [A-Z][a-z]+)', 1))) as w from notes) t
   where not regexp_matches(lower(w), 'guide|process|checklist|setup') and lower(w) not in ({", ".join(repr(x) for x in e.NO_AUTHORS)})
  union all select id, kind, value, 0.95::double from ids)"""


@query("ext_03_semantic_entities", f"with {_SEMANTIC_SQL} select id, kind, value, max(confidence) as confidence from semantic group by all")
def semantic(v: Views) -> DataFrame:
    """Core names in any case, others as written, authors, and identifiers."""
    return e.semantic_entities(notes(v), "doc_id", "text", names(v)).select("id", "kind", "value", "confidence")


@query("ext_03_relations", f"""
with {_SEMANTIC_SQL}, runs as (select doc_id as id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_\\s]+')) as run from notes),
 ends as (select id, trim(regexp_extract(run, '(?i)^([\\p{{L}}\\p{{N}}_\\s]+)\\s+(?:' || verbs || ')\\s+([\\p{{L}}\\p{{N}}_\\s]+)$', 1)) as source, trim(regexp_extract(run, '(?i)^([\\p{{L}}\\p{{N}}_\\s]+)\\s+(?:' || verbs || ')\\s+([\\p{{L}}\\p{{N}}_\\s]+)$', 2)) as target from (select * from runs, (values {", ".join(f"('{x}')" for x in e.VERBS)}) t(verbs) where regexp_matches(run, '(?i)\\s(' || verbs || ')\\s')) r)
select id, source, target from ends join (select distinct id, value as source from semantic) s using (id, source) join (select distinct id, value as target from semantic) t using (id, target)""")
def relations(v: Views) -> DataFrame:
    """Relations whose ends are both entities of the document."""
    d = notes(v)
    return e.relations(d, "doc_id", "text", e.semantic_entities(d, "doc_id", "text", names(v)))


@query("ext_03_requirements", f"with {_NOTES_SQL} select doc_id as id, count(*) as statements, max(s) as last from (select doc_id, trim(regexp_replace(unnest(regexp_extract_all(text, '(?i)(?:must|should|required|recommended|may)\\s+[^.]+')), '\\s+', ' ', 'g')) as s from notes) t where length(s) > 10 group by 1")
def requirements(v: Views) -> DataFrame:
    """Requirements a document states, white space in them as one space."""
    c = e.claims(notes(v), "doc_id", "text").where("rule = 0").withColumn("s", F.trim(F.regexp_replace("statement", r"\s+", " "))).where("length(s) > 10")
    return c.groupBy("id").agg(F.count("*").alias("statements"), F.max("s").alias("last"))


_BAD_SQL = "|".join(e.BAD_PARTS)
_RULES_SQL = " union all ".join(f"select doc_id as id, '{k}' as kind, unnest(regexp_extract_all(text, '{p}')) as hit from notes" for k, p, _ in ENTITY_RULES)


@query("ext_04_hybrid_entities", f"""
with {_SEMANTIC_SQL}, hits as (select id, kind, trim(hit) as value, row_number() over () as place from ({_RULES_SQL}) r),
 valid as (select id, kind, upper(value) as key, arg_min(value, place) as value from hits where value <> '' and case kind when 'CreditClass' then regexp_matches(value, '^C[0-9]{{2,3}}$') when 'Project' then regexp_matches(value, '^P[0-9]{{3,4}}$') when 'Methodology' then regexp_matches(value, '^VM[0-9]{{4}}$') else true end group by 1, 2, 3),
 good as (select * from valid where length(value) >= 3 and not regexp_matches(lower(value), '{_BAD_SQL}') and not (kind in ('Person', 'Organization') and lower(value) = value) and case kind
   when 'Person' then regexp_matches(value, '^\\p{{Lu}}\\p{{Ll}}+ \\p{{Lu}}\\p{{Ll}}+$') and not regexp_matches(lower(value), 'guide|list|process|module|service')
   when 'Organization' then length(value) <= 50 and not lower(value) like '% inc' and not (regexp_matches(lower(value), '^(the|a|an) ') and length(value) > 30) and regexp_matches(value, '^\\p{{Lu}}') and len(string_split(value, ' ')) <= 4 and not regexp_matches(lower(value), 'release|guide|process|module')
   else kind in ('CreditClass', 'Project', 'Methodology') end),
 every as (select id, kind, value, 'pattern' as origin from good union all select id, kind, value, 'semantic' from semantic)
select id, kind, upper(value) as key, case when bool_or(origin = 'pattern') then 'pattern' else 'semantic' end as origin from every group by 1, 2, 3""")
def hybrid(v: Views) -> DataFrame:
    """Pattern hits that are plausible, and semantic entities beside them; of equal ones the pattern's."""
    return e.hybrid(notes(v), "doc_id", "text", names(v), brief=True)
