"""Mailboxes as a data source, in batches and as a stream whose offset is the contiguous UID.

The store that is read holds messages as (folder, uid, raw); a message whose ``raw`` is null can not be fetched (yet). Any client with the
three methods of ``Store`` serves as well.

As a stream, each folder's offset covers a contiguous run of messages that were fetched or given up. A poll goes on from there; it stops at
the first message that can not be fetched, so that the next poll tries it again before anything behind it is read. A poll looks for all of
its ``most`` messages, so that failures behind the first one are counted as well, and lost messages do not cost a poll each. After
``attempts`` polls that looked for it in vain a message is given up. Attempts are part of the offset, so they outlive a restart, as does the run: no message is read
twice, and none before the mark is lost. A change of a folder's ``uidvalidity`` starts the folder anew.

Only UIDs and whether a message is there are seen while a poll is planned, ``most`` a folder; tasks fetch ranges of ``per_task`` messages.

    spark.dataSource.register(MailboxSource)
    spark.readStream.format("mailbox").option("path", ...).option("folders", "inbox,lists").option("state", ...).load()

``state`` is a folder for the last offset: Spark does not tell a restarted reader where it is before the reader has looked.

Nulls and edges: rows of the store without folder or uid are ignored; a uid that comes twice is one message (the first one that is there);
an unknown or empty folder gives nothing; messages over ``max_bytes`` are skipped in the batch form as in the stream.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import islice, takewhile

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "folder string, uid long, size long, raw binary"


class Store:
    """Messages in Parquet files, in any file system that Arrow knows by its address.

    It is read a row group at a time, and of those only what may hold the asked UIDs, by the files' statistics: files in the order of
    ``folder`` and ``uid`` (``land``) are read once, however many polls and tasks there are. A column ``size`` that is null where ``raw`` is
    saves reading messages to see whether they are there.
    """

    def __init__(self, path: str):
        self.path = path
        self.known: dict[str, list] = {}  # row groups by file; files do not change

    def __getstate__(self) -> dict:
        return {"path": self.path, "known": {}}

    def _groups(self, folder: str, after: int, upto: int | None) -> list[tuple]:
        """(least uid, row group, test) of the row groups that may hold such messages, by their least UIDs."""
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSystem

        fs, where = FileSystem.from_uri(self.path)
        out = []
        for f in ds.dataset(where, format="parquet", filesystem=fs).get_fragments():
            if f.path not in self.known:
                self.known[f.path] = [(p, p.row_groups[0].statistics or {}) for p in f.split_by_row_group()]
            for p, stats in self.known[f.path]:
                u, own = stats.get("uid"), stats.get("folder")
                if u and (u["max"] <= after or (upto is not None and u["min"] > upto)):
                    continue
                if own and not own["min"] <= folder <= own["max"]:
                    continue
                out.append((u["min"] if u else after, p))
        test = (ds.field("folder") == folder) & (ds.field("uid") > after)
        if upto is not None:
            test &= ds.field("uid") <= upto
        return [(low, p, test) for low, p in sorted(out, key=lambda x: (x[0], x[1].path, x[1].row_groups[0].id))]

    def listed(self, folder: str, after: int) -> Iterator[tuple[int, bool]]:
        """UIDs after one, in order, and whether each can be fetched; no more is read than is taken."""
        import pyarrow.dataset as ds

        found: dict[int, bool] = {}
        groups = self._groups(folder, after, None)
        for k, (_, p, test) in enumerate(groups):
            there = "size" if "size" in p.physical_schema.names else "raw"
            for batch in p.to_batches(columns={"uid": ds.field("uid"), "there": ds.field(there).is_valid()}, filter=test, batch_size=10_000, batch_readahead=0):
                for uid, ok in zip(batch["uid"].to_pylist(), batch["there"].to_pylist(), strict=True):
                    found[uid] = found.get(uid, False) or ok
            upto = groups[k + 1][0] if k + 1 < len(groups) else None  # later row groups may still hold this one
            for uid in sorted(found if upto is None else (u for u in found if u < upto)):
                yield uid, found.pop(uid)

    def fetch(self, folder: str, after: int, upto: int) -> Iterator[tuple[int, bytes]]:
        """(uid, raw) of the messages after one, up to another, that are there."""
        seen = set()
        for _, p, test in self._groups(folder, after, upto):
            for batch in p.to_batches(columns=["uid", "raw"], filter=test, batch_size=100, batch_readahead=0):
                for uid, raw in zip(batch["uid"].to_pylist(), batch["raw"], strict=True):
                    if raw.is_valid and uid not in seen:
                        seen.add(uid)
                        yield uid, raw.as_py()


def land(messages, path: str) -> None:
    """Adds messages (folder, uid, raw) to a store, in the order in which they are read, in row groups of about 4 MB."""
    from pyspark.sql import functions as F

    rows = messages.select("folder", "uid", F.octet_length("raw").cast("long").alias("size"), "raw")
    rows.repartitionByRange("folder", "uid").sortWithinPartitions("folder", "uid").write.mode("append").option("parquet.block.size", str(4 << 20)).parquet(path)


class _Range(InputPartition):
    def __init__(self, folder: str, after: int, upto: int, gone: list[int]):
        self.folder, self.after, self.upto, self.gone = folder, after, upto, gone


def poll(listed: Iterable[tuple[int, bool]], at: dict, attempts: int, most: int) -> dict:
    """A folder's offset after one poll: ``uid`` (the mark), ``failing`` and ``tries``, ``behind`` (tries of those that failed behind it), and
    ``gone`` (given up since the last mark)."""
    tried = {at["failing"]: at["tries"], **{int(u): n for u, n in at.get("behind", {}).items()}}
    out = {"validity": at["validity"], "uid": at["uid"], "failing": None, "tries": 0, "gone": [], "behind": {}}
    for uid, there in islice(listed, most):
        if not there:
            tries = tried.get(uid, 0) + 1
            if out["failing"] is not None:
                out["behind"][str(uid)] = tries
            elif tries < attempts:
                out |= {"failing": uid, "tries": tries}
            else:
                out["gone"].append(uid)
        if out["failing"] is None:
            out["uid"] = uid
    return out


class _Options:
    def __init__(self, options: dict):
        self.store = Store(options["path"])
        self.folders = [f for f in options.get("folders", "").split(",") if f]
        self.attempts, self.most = int(options.get("attempts", 3)), int(options.get("most", 10_000))
        self.per_task, self.max_bytes = int(options.get("per_task", 1000)), int(options.get("max_bytes", 50 << 20))
        self.since, self.validity, self.state = int(options.get("since_uid", 0)), options.get("uidvalidity", "1"), options.get("state")

    def ranges(self, folder: str, uids: Iterable[int], after: int, gone: list[int]) -> list[_Range]:
        out = []
        uids = iter(uids)
        while part := list(islice(uids, self.per_task)):
            out.append(_Range(folder, after, part[-1], gone))
            after = part[-1]
        return out

    def rows(self, p: _Range) -> Iterator[tuple]:
        gone = set(p.gone)  # given up: what comes after that is not read, or a replay would differ
        for uid, raw in self.store.fetch(p.folder, p.after, p.upto):
            if uid not in gone and len(raw) <= self.max_bytes:
                yield p.folder, uid, len(raw), raw


class MailboxReader(DataSourceReader):
    """All messages after ``since_uid``; those that can not be fetched are left out."""

    def __init__(self, options: dict):
        self.own = _Options(options)

    def partitions(self) -> list[_Range]:
        out = []
        for f in self.own.folders:
            out += self.own.ranges(f, (u for u, _ in self.own.store.listed(f, self.own.since)), self.own.since, [])
        return out

    def read(self, partition: _Range | None) -> Iterator[tuple]:
        return self.own.rows(partition) if partition is not None else iter(())


class MailboxStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.own, self.at = _Options(options), None
        if not self.own.state:
            raise ValueError("a mailbox stream needs a folder for its state")

    def initialOffset(self) -> dict:
        return {f: self._start() for f in self.own.folders}

    def _start(self) -> dict:
        return {"validity": self.own.validity, "uid": self.own.since, "failing": None, "tries": 0, "gone": [], "behind": {}}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._saved() or self.initialOffset()
        out = {}
        for f in self.own.folders:
            at = self.at.get(f)
            if at is None or at["validity"] != self.own.validity:
                at = self._start()
            new = poll(self.own.store.listed(f, at["uid"]), at, self.own.attempts, self.own.most)
            same = lambda x: (x["uid"], x["failing"], x["tries"], x.get("behind", {}))
            out[f] = at if same(new) == same(at) else new
        if out != self.at:
            self._save(out)
        self.at = out
        return out

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        self.at = end
        out = []
        for f, e in end.items():
            s = start.get(f)
            after = s["uid"] if s is not None and s["validity"] == e["validity"] else self.own.since
            out += self.own.ranges(f, takewhile(lambda u, upto=e["uid"]: u <= upto, (u for u, _ in self.own.store.listed(f, after))), after, e["gone"])
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.own.rows(partition)

    def _save(self, end: dict) -> None:
        """Remembers where a restarted reader goes on. It is never behind the stream's checkpoint, which alone decides what is read."""
        fs, where = self._file()
        with fs.open_output_stream(where) as out:
            out.write(json.dumps(end).encode())

    def _saved(self) -> dict | None:
        fs, where = self._file()
        try:
            with fs.open_input_stream(where) as f:
                return json.loads(f.read())
        except (FileNotFoundError, ValueError):
            return None

    def _file(self):
        from pyarrow.fs import FileSystem

        fs, where = FileSystem.from_uri(self.own.state)
        fs.create_dir(where, recursive=True)
        return fs, f"{where}/mark.json"


class MailboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MailboxReader:
        return MailboxReader(self.options)

    def streamReader(self, schema) -> MailboxStream:
        return MailboxStream(self.options)
