"""The corpus pipeline: language ID, MinHash near-dedup, substring dedup, best-fit packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept. All but
the last return the columns of ``documents``; other columns of their input, whatever their names, are left out.

Nulls and edges: a null text has no language and goes; rows are told apart by (doc_id, text), so a null or repeated doc_id
names several documents and each is judged on its own text; of rows that repeat both, one stays; an empty table gives an
empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mereweave.llm import langid, minhash, packing, substrings
from mereweave.llm.common import Cut

#: SQL cannot express language models or tokenizers; the stages are tested against brute-force versions.
ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language; ``lang`` is the prediction. A text without a letter has none and goes."""
    own = docs.select(*COLUMNS)
    model = langid.fit(own, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.annotate(own, model).where("lang_pred <> 'und'").select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies (five-word shingles, similarity 0.8 or more): that of the smallest doc_id."""
    cut = Cut(spark)
    own = docs.select(*COLUMNS).withColumn("row", F.xxhash64("doc_id", "text"))
    near = minhash.near_duplicates(own, id_col="row", size=5, num=80, den=100).select(F.col("doc_id").alias("row"), "component_id")
    rows = own.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    each = near.groupBy("row").agg(F.min("component_id").alias("component_id")).join(rows, "row")
    kept = cut.keep(each.groupBy("component_id").agg(F.min(F.struct("doc_id", "row", "n")).alias("first")).select("first.row", "first.n"))
    out = own.join(kept.where("n = 1").hint("merge"), "row", "left_semi")
    repeated = kept.where("n > 1")
    if not repeated.isEmpty():  # partial aggregation leaves one of a repeated row per task before anything is sent
        out = out.unionByName(own.join(repeated, "row", "left_semi").dropDuplicates(["row"]))
    return out.select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 35 words or more that also stand elsewhere; other texts stay as they are."""
    own = docs.select(*COLUMNS)
    kept = substrings.repeats(own, Cut(spark), window=35).select("key", "mark", "kept")
    key, mark = substrings.row_key("doc_id", "text")
    out = own.withColumns({"key": key, "mark": mark}).join(kept, ["key", "mark"], "left")
    text = F.coalesce("kept", "text")
    return out.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length("kept").cast("long")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [("language ID", language_id), ("MinHash near-dedup", near_dedup), ("substring dedup", substring_dedup), ("best-fit packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = Cut(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut.keep(stage(spark, docs, sf_dir))
        cut.sweep()
    return STAGES[-1][1](spark, docs, sf_dir)
