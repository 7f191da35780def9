"""The numbered queries: each binds one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, flac, html_text, langid, merkle, minhash, packing, quotes, substrings, token_files, toxicity, vectors
from .common import Cut

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"), window=35)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, num=85, den=100)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    segments = Cut(spark).keep(token_files.encode_segments(docs, public_tokenizers.path(WORD_BPE), end_id=2))
    return token_files.read_documents(spark, segments)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), end_id=1, capacity=4096)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()), public_tokenizers.path(PIECES))
    return langid.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_digests(Cut(spark).keep(flac.store_text(table(spark, sf_dir, "documents"))))


def op9_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def unlearned() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~unlearned()), label_col="toxic")
    return toxicity.score(docs, model).select("doc_id", unlearned().alias("held_out"), "score", "predicted")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf(*[F.col(c) for c in fields[:-1]], lower))
    rows = merkle.manifest(docs, "source", ["doc_id"], fields, carry={"doc_id": F.col("doc_id"), "tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    out = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), dims=64, clusters=40, rounds=5, scale=256, seed="2")


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_token_files": op5_token_files,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op8_media_columns": op8_media_columns,
    "op9_quote_links": op9_quote_links,
    "op10_html_text": op10_html_text,
    "op11_toxicity": op11_toxicity,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_centroid_clustering": op13_centroid_clustering,
}
_REACH = """reach(node, other) as (select a, b from links union select reach.node, links.b from reach join links on reach.other = links.a),
 lowest as (select node, min(other) as low from reach group by node)"""



def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _clusters(rounds: int) -> str:
    """Assignments and centroids, one pair of named tables a round."""
    product = "list_inner_product"
    out = """with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x) or abs(x) >= 524288)) = 0),
 c0 as (select row_number() over (order by sha256('2:' || coalesce(vec_id::varchar, '')), x) - 1 as c, x from v qualify c < 40)"""
    for r in range(rounds + 1):
        out += f""",
 a{r} as (select rid, min({{'d': ({product}(v.x, v.x) - 2 * {product}(v.x, k.x) + {product}(k.x, k.x))::bigint, 'c': k.c}}) as best from v cross join c{r} k group by rid)"""
        if r < rounds:
            out += f""",
 s{r} as (select best.c as c, i, sum(x[i])::bigint as s, count(*) as n from v join a{r} using (rid) cross join range(1, 65) as d(i) group by all),
 m{r} as (select c, list(((s - ((s % n) + n) % n) // n)::double order by i) as x from s{r} group by c),
 c{r + 1} as (select c{r}.c, coalesce(m{r}.x, c{r}.x) as x from c{r} left join m{r} using (c))"""
    last = f"a{rounds}"
    return out + f""",
 done as (select vec_id, best.c::int as cluster, best.d as distance from v join {last} using (rid))
select vec_id, cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia, sum(distance) over ()::bigint as inertia,
  sha256(array_to_string(c{rounds}.x::bigint[], ',')) as centroid_sha256 from done join c{rounds} on c = cluster"""


#: Plain SQL forms, by all pairs or all windows; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": f"""
with recursive good as (select vec_id, embedding::double[] as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
 links as (select x.vec_id as a, y.vec_id as b from good x join good y on x.vec_id <> y.vec_id and len(x.e) = len(y.e) where list_cosine_similarity(x.e, y.e) >= 0.95),
 {_REACH}, counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id <= coalesce(low, vec_id) as kept
from embeddings left join counted on a = vec_id left join lowest on node = vec_id""",
    "op3_substring_dedup": r"""
with split as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
 places as (select doc_id, w, unnest(generate_series(1, len(w))) as i from split),
 windows as (select doc_id, w[i] as word, i, case when i + 34 <= len(w) then md5(array_to_string(w[i : i + 34], ' ')) end as h from places),
 counted as (select *, case when h is not null and count(*) over (partition by h) > 1 then 1 else 0 end as again from windows),
 covered as (select doc_id, word, i, max(again) over (partition by doc_id order by i rows between 34 preceding and current row) as gone from counted),
 kept as (select doc_id, sum(gone)::bigint as n_removed, coalesce(string_agg(word, ' ' order by i) filter (gone = 0), '') as body from covered group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(body, '')) as kept_sha256 from split left join kept using (doc_id)""",
    "op4_minhash_dedup": rf"""
with recursive split as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
 sets as (select doc_id, case when len(w) >= 3 then list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i : i + 2], ' '))) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from split),
 rows_ as (select doc_id, unnest(s) as x from sets), sizes as (select doc_id, len(s)::bigint as n from sets),
 shared as (select p.doc_id as a, q.doc_id as b, count(*) as common from rows_ p join rows_ q on p.x = q.x and p.doc_id <> q.doc_id group by 1, 2),
 links as (select a, b from shared join sizes u on u.doc_id = a join sizes v on v.doc_id = b where 100 * common >= 85 * (u.n + v.n - common)),
 {_REACH}
select doc_id, n as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id, doc_id <= coalesce(low, doc_id) as kept from sizes left join lowest on node = doc_id""",
    "op12_merkle_manifest": rf"""
with recursive docs as (select row_number() over () as rid, doc_id, source, {_leaf("text")} as leaf, cast(doc_id as varchar) as id,
  {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as lowered from documents),
 leaves as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from docs),
 low(level, source, pos, node, n) as (select 0, source, pos, leaf, n from leaves
  union all select level + 1, source, pos // 16, sha256(string_agg(node, '' order by pos)), (n + 15) // 16 from low where n > 1 group by level, source, pos // 16, n),
 subroots as (select source, node as subroot, level as height, row_number() over (order by source nulls first) - 1 as place, count(*) over () as m from low where n = 1),
 high(level, pos, node, n) as (select 0, place, subroot, m from subroots
  union all select level + 1, pos // 16, sha256(string_agg(node, '' order by pos)), (n + 15) // 16 from high where n > 1 group by level, pos // 16, n),
 top as (select node as root from high where n = 1),
 steps as (select rid, l.level, x.pos, x.node, l.pos as own from (select rid, source, level, pos // power(16, level)::bigint as pos from leaves join (select distinct level from low) on true) l
   join low x on x.level = l.level and x.source is not distinct from l.source and x.pos // 16 = l.pos // 16 and x.n > 1
  union all select rid, 1000 + y.level, y.pos, y.node, z.own from (select rid, level, place // power(16, level)::bigint as own from leaves join subroots using (source) join (select distinct level from high) on true
    union all select rid, level, place // power(16, level)::bigint from leaves join subroots on leaves.source is null and subroots.source is null join (select distinct level from high) on true) z
   join high y on y.level = z.level and y.pos // 16 = z.own // 16 and y.n > 1),
 runs as (select rid, level, row_number() over (partition by rid order by level) as step, coalesce(string_agg(node, '' order by pos) filter (pos < own), '') as before, coalesce(string_agg(node, '' order by pos) filter (pos > own), '') as after from steps group by rid, level),
 proofs as (select rid, string_agg(before || after, '' order by step) as siblings from runs group by rid),
 bytes as (select rid, unnest(range(1, length(id) + 1)) as i, id from docs where id is not null),
 ops as (select rid, list([ascii(id[i]), -1, -1, -1, -1, -1, -1, -1, -1] order by i) as o from bytes group by rid),
 crcs as (select rid, xor(list_reduce(list_prepend(4294967295::bigint, flatten(o)::bigint[]), lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295::bigint) as crc from ops),
 fold(rid, step, node) as (select rid, 0::bigint, case when crc % 5 = 0 then lowered else leaf end from docs left join crcs using (rid)
  union all select rid, runs.step, sha256(before || node || after) from fold join runs using (rid) where runs.step = fold.step + 1),
 folded as (select rid, max_by(node, step) as folded_root from fold group by rid)
select doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) as proof_sha256, folded_root, folded_root = root as verified
from leaves join subroots on leaves.source is not distinct from subroots.source cross join top join folded using (rid) left join proofs using (rid)""",
    "op13_centroid_clustering": _clusters(5),
}
