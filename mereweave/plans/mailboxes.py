"""Mailboxes landed in the shared folder and read back by UID, in one go and as a stream over restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.mailbox import SCHEMA, MailboxSource, land
from .registry import query
from .streams import shared_base
from .views import Views

_LATE, _LOST = "doc_id % 211 = 5", "doc_id % 331 = 7"


def _mails(v: Views) -> DataFrame:
    """Every document as a message of its language's folder; one in 331 can never be fetched."""
    raw = F.when(~F.expr(_LOST), F.concat(F.lit("Subject: "), "source", F.lit("\n\n"), "text").cast("binary"))
    return v.table("documents").select(F.col("lang").alias("folder"), (F.col("doc_id") + 1).alias("uid"), "doc_id", raw.alias("raw"))


def _folders(v: Views) -> str:
    return ",".join(sorted(r[0] for r in v.table("documents").select("lang").where("lang is not null").distinct().collect()))  # as configured: a few


@query("src_03_mail_stream", f"""
select folder, uid, size, md5(raw) as digest from (select lang as folder, doc_id + 1 as uid, 'Subject: ' || source || chr(10) || chr(10) || text as raw, strlen('Subject: ' || source || chr(10) || chr(10) || text) as size from documents where not ({_LOST})) t where raw is not null and folder is not null""")
def mail_stream(v: Views) -> DataFrame:
    """Polls until all that can be fetched has been read: once while one message in 211 is still missing, and again from the checkpoint."""
    base, mails = shared_base(v.spark), _mails(v)
    v.spark.dataSource.register(MailboxSource)
    early = mails.withColumn("raw", F.when(~F.expr(_LATE), F.col("raw"))).drop("doc_id")
    for k, part in enumerate((early, mails.where(_LATE).drop("doc_id"))):
        land(part, f"{base}/mail")
        options = {"path": f"{base}/mail", "folders": _folders(v), "state": f"{base}/state", "attempts": "2" if k else "1000000"}
        stream = v.spark.readStream.format("mailbox").options(**options).load()
        # the first run stops at messages that are missing yet: nothing is given up in so few polls
        sink = lambda df, n: df.write.mode("overwrite").parquet(f"{base}/out/batch={n}")
        w = stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink)
        q = (w.trigger(processingTime="0 seconds") if k else w.trigger(availableNow=True)).start()
        try:
            q.processAllAvailable() if k else q.awaitTermination()
        finally:
            q.stop()
    return v.spark.read.schema(SCHEMA).parquet(f"{base}/out").select("folder", "uid", "size", F.md5("raw").alias("digest"))


@query("src_06_mail_since_uid", f"""
select lang as folder, doc_id + 1 as uid, strlen('Subject: ' || source || chr(10) || chr(10) || text) as size from documents where doc_id >= 100 and not ({_LOST}) and strlen('Subject: ' || source || chr(10) || chr(10) || text) <= 20000 and lang is not null""")
def mail_since(v: Views) -> DataFrame:
    """Messages after a UID, but for those that can not be fetched or are too large."""
    base = shared_base(v.spark)
    v.spark.dataSource.register(MailboxSource)
    land(_mails(v), f"{base}/mail")
    found = v.spark.read.format("mailbox").options(path=f"{base}/mail", folders=_folders(v), since_uid="100", max_bytes="20000").load()
    return found.select("folder", "uid", "size")
