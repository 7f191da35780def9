"""Writers: partitioned entity lines, current state, metrics, children of a key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_entities(df: DataFrame, path: str) -> None:
    """JSON lines, a folder per entity type; a type's rows are spread over tasks by the input's partitions."""
    df.write.mode("overwrite").partitionBy("entity_type").json(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_children(df: DataFrame, path: str, key: str) -> None:
    """Delete-then-insert of a key's rows: only the partitions of keys in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_snapshot(df: DataFrame, path: str, number: int | None = None) -> int:
    """Replaces a table as a whole, as a new numbered commit; returns its number.

    The rows go into a folder of their own. Only when they are complete a small file, named by the commit's number, is put beside the
    others: it is written under another name and renamed to one that does not exist yet. At no moment is there no version, a reader sees all
    of one, and a writer that dies leaves the last commit in place. Without ``number`` it is the next free one, also if others write
    meanwhile. With a number (of a stream's batch) the commit is made once: if it is there, nothing is written.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if number is not None and number in commits(spark, path):
        return number
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    fs, at = _fs(spark, path)
    draft = at(f"commits/.{version}")
    out = fs.create(draft, True)
    out.write(bytearray(version.encode()))
    out.close()
    while True:
        own = number if number is not None else max(commits(spark, path), default=-1) + 1
        target = at(f"commits/{own:012d}")
        if not fs.exists(target) and fs.rename(draft, target):
            return own
        if number is not None:  # another run of the same batch was first
            return number


def commits(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all complete commits."""
    fs, at = _fs(spark, path)
    if not fs.exists(at("commits")):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at("commits")) if s.getPath().getName().isdigit())


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The commit of the largest number, or the one asked for."""
    path = path.rstrip("/")
    found = commits(spark, path)
    if not found or (number is not None and number not in found):
        raise FileNotFoundError(f"no commit {'' if number is None else number} in {path}")
    own = found[-1] if number is None else number
    version = spark.read.text(f"{path}/commits/{own:012d}", wholetext=True).first()[0]
    return spark.read.parquet(f"{path}/{version}")


def write_through(state: str, key: str, order: str):
    """A sink for ``foreachBatch`` that keeps the current rows of every key in ``state``: of the committed ones and the batch's, the last
    by ``order``. A batch is committed under its number, so one that runs again changes nothing."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = [n for n in commits(spark, state) if n < number]
        every = batch if not held else read_snapshot(spark, state, held[-1]).unionByName(batch)
        others = [c for c in every.columns if c not in (key, order)]
        last = every.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("last"), F.max(order).alias(order))
        write_snapshot(last.select(key, "last.*", order).select(*batch.columns), state, number)

    return sink


def _fs(spark: SparkSession, path: str):
    """The file system of a folder, and what makes paths in it."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    return Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: Path(f"{path}/{name}")


def calendar_rows(events: DataFrame, chunk_size: int = 4000) -> tuple[DataFrame, DataFrame]:
    """(chunks, flags) of calendar events (uid, sequence, summary, description, status): the texts in pieces under their uid, and
    one row of flags an event. Both replace the rows of the same uid (``replace_children``)."""
    body = F.concat_ws("\n", "summary", "description")
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(body) - 1), F.lit(chunk_size)), lambda s: F.substring(body, s + 1, F.lit(chunk_size)))
    chunks = events.select("uid", "sequence", F.posexplode(pieces).alias("index", "chunk")).where("chunk <> ''")
    flags = events.select("uid", "sequence", (F.lower("status") == "cancelled").alias("cancelled"), (F.length(body) > chunk_size).alias("split"))
    return chunks, flags
