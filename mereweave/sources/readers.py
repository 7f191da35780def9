"""Readers of landed source files: mail, calendars, feeds, transcripts, entity lines, repositories.

Files are read by Spark (``binaryFile``, ``json``, ``text``), so any store that Spark reaches works; Python sees one
file's bytes at a time, in Arrow batches.
"""

from __future__ import annotations

import email
import email.policy
import hashlib
import re
from collections.abc import Iterator
from email.utils import getaddresses, parsedate_to_datetime
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import calendar_utc, duration

_MAIL = "path string, message_id string, thread_id string, from_address string, from_name string, to_addresses array<string>, subject string, date_sent string, body string, attachments int"
_EVENT = "path string, uid string, sequence int, summary string, starts string, ends string, all_day boolean, status string, recurrence string"


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Path and bytes of all files below ``path``; where it stands for many folders (``base/*``) they are listed by tasks. Spark plans a task
    for some 30 small files, which would cost more than the files, so tasks take several such parts."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")
    parts = found.rdd.getNumPartitions()
    return found.coalesce(max(1, min(parts, max(4 * spark.sparkContext.defaultParallelism, parts // 16))))


def _plain(header: object) -> str | None:
    """A header as plain text: the parser's own text keeps its whole parse tree, some 20 KB a message, as long as it is held."""
    return None if header is None else str(header)


def _rows(found: Iterator[tuple], schema: str, most: int = 1000) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded length."""
    columns = [c.split()[0] for c in schema.split(", ")]
    while rows := list(islice(found, most)):
        yield pd.DataFrame(rows, columns=columns)


def _message(path: str, raw: bytes) -> tuple:
    m = email.message_from_bytes(raw, policy=email.policy.default)
    sender = getaddresses([str(m.get("From", ""))])[:1] or [("", "")]
    body = m.get_body(preferencelist=("plain", "html"))
    try:
        sent = parsedate_to_datetime(str(m["Date"])).isoformat() if m["Date"] else None
    except ValueError:
        sent = None
    refs = (str(m.get("References", "")) or str(m.get("In-Reply-To", ""))).split()
    text = _content(body) if body is not None else ""
    key = _plain(m.get("Message-ID"))
    return path, key, refs[0] if refs else key, sender[0][1], sender[0][0], [a for _, a in getaddresses([str(x) for x in m.get_all("To", [])])], _plain(m.get("Subject")), sent, text, sum(1 for _ in m.iter_attachments())


def _content(part: email.message.EmailMessage) -> str:
    """A text part; one in a character set that nobody knows is read as UTF-8 with replacements."""
    try:
        return part.get_content()
    except (LookupError, UnicodeError):
        return (part.get_payload(decode=True) or b"").decode("utf-8", "replace")


def read_maildir(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per message file, whatever is in it: what cannot be read of a message is null, its text has replacements."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield from _rows((_message(p, c) for p, c in zip(f["path"], f["content"], strict=True)), _MAIL)

    return _files(spark, path, glob).mapInPandas(run, _MAIL)


_ATTACHMENT = "path string, message_id string, place int, name string, content_type string, size long, sha256 string"


def read_attachments(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per attachment of each message file: its name, type, size and digest, not its bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for p, raw in zip(f["path"], f["content"], strict=True):
                m = email.message_from_bytes(raw, policy=email.policy.default)
                for k, part in enumerate(m.iter_attachments()):
                    data = part.get_payload(decode=True) or b""
                    rows.append((p, _plain(m.get("Message-ID")), k, part.get_filename(), part.get_content_type(), len(data), hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _ATTACHMENT.split(", ")])

    return _files(spark, path, glob).mapInPandas(run, _ATTACHMENT)


def read_documents(spark: SparkSession, path: str, schema: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """JSON documents of a folder, one a file, but files whose names hold one of ``exclude``; a file that is no JSON gives nulls."""
    found = spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", "*.json").json(path).withColumn("path", F.input_file_name())
    for mark in exclude:
        found = found.where(~F.contains(F.substring_index("path", "/", -1), F.lit(mark)))
    return found


def read_pages(spark: SparkSession, path: str, field: str, item: str) -> DataFrame:
    """Landed response pages of a ledger or forum (one JSON a file), unfolded to one row per entity of ``field``."""
    from ..operators.content import unfold_pages

    bodies = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))
    return unfold_pages(bodies, "body", field, item)


def read_mbox(spark: SparkSession, path: str) -> DataFrame:
    """Messages of mbox files, split by Spark on the ``From `` lines, so that a large file is not one task's memory."""
    parts = spark.read.option("lineSep", "\nFrom ").text(path).select(F.input_file_name().alias("path"), F.regexp_replace("value", r"^(From )?[^\n]*\n", "").alias("body"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield from _rows((_message(p, b.encode()) for p, b in zip(f["path"], f["body"], strict=True) if b.strip()), _MAIL)

    return parts.mapInPandas(run, _MAIL)


def parse_calendar(path: str, raw: bytes) -> list[tuple]:
    """The events of a calendar file; an event without UID or with an unreadable time is skipped."""
    lines = re.sub(r"\r?\n[ \t]", "", raw.decode("utf-8", "replace")).splitlines()
    out, now = [], None
    for line in lines:
        name, _, value = line.partition(":")
        key, *params = name.upper().split(";")
        zone = next((p.partition("=")[2] for p in name.split(";")[1:] if p.upper().startswith("TZID=")), None)
        if key == "BEGIN" and value.strip().upper() == "VEVENT":
            now = {}
        elif key == "END" and value.strip().upper() == "VEVENT" and now is not None:
            try:
                start, start_zone = now["DTSTART"]
                begins = calendar_utc(start, start_zone)
                if "DTEND" in now:
                    ends = calendar_utc(*now["DTEND"])
                elif "DURATION" in now:
                    ends = begins + duration(now["DURATION"][0])
                else:
                    ends = begins
                out.append((path, now["UID"][0], int(now["SEQUENCE"][0]) if "SEQUENCE" in now else None, now.get("SUMMARY", (None, None))[0], begins.isoformat(), ends.isoformat(), len(start) == 8, now.get("STATUS", (None, None))[0], now.get("RRULE", (None, None))[0]))
            except (KeyError, ValueError):
                pass
            now = None
        elif now is not None:
            now.setdefault(key, (value.strip(), zone))
    return out


def read_calendars(spark: SparkSession, path: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([r for p, c in zip(f["path"], f["content"], strict=True) for r in parse_calendar(p, c)], columns=[c.split()[0] for c in _EVENT.split(", ")]).astype({"sequence": "Int32"})

    return _files(spark, path, "*.ics").mapInPandas(run, _EVENT)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Session lines of users and assistants; lines that are no JSON are dropped."""
    schema = "type string, timestamp string, cwd string, gitBranch string, message struct<model: string, content: string>"
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where("type in ('user', 'assistant')")


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    schema = "entity_type string, value string, confidence double, properties map<string, string>, source_document string, extracted_at string"
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_feed(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Feed entries: title, link, description, published (text)."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema("title string, link string, description string, pubDate string").load(path)
    return rows.withColumnRenamed("pubDate", "published")


def read_repository(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".md", ".rst", ".txt"), stems: tuple[str, ...] = ("readme", "changelog", "license")) -> DataFrame:
    """Documentation files of a checked-out tree: by suffix or by file stem."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("content"))
    name = F.lower(F.substring_index("path", "/", -1))
    by_suffix = F.lit(False)
    for s in suffixes:
        by_suffix = by_suffix | F.endswith(name, F.lit(s))
    return files.where(by_suffix | F.substring_index(name, ".", 1).isin(*stems))


def new_only(found: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a source offers that has not been processed."""
    return found.join(done.select(key), key, "left_anti")
