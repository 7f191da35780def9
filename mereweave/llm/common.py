"""Shared helpers of the operators: durable cuts, batch slicing, vectorised word hashing."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of the word contract: space and the control characters 0x09 to 0x0D.
WORD_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one is set only where that is unset on a local master (tests)."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
        where = getattr(sc, "_mereweave_shared", None)
        if where is None:
            where = sc._mereweave_shared = "file://" + tempfile.mkdtemp(prefix="mereweave-")
    return where.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """While it lasts, Arrow batches between the JVM and Python hold about ``size`` bytes: long texts and blobs would make them large."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Cut:
    """Tables written to the shared folder so that lineage ends there and executors may be lost.

    ``keep`` writes a frame and rereads it; ``drop`` deletes a table that no later frame reads. An operator's last tables are read
    by the frame that it returns: ``sweep`` deletes them once that frame has been written.
    """

    opened: ClassVar[list["Cut"]] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/mereweave-{uuid.uuid4().hex}"
        self.n = 0
        Cut.opened.append(self)

    def sweep(self) -> None:
        """Deletes all tables of the cuts that were opened after this one, whose frames are no longer read."""
        k = Cut.opened.index(self) + 1
        for later in Cut.opened[k:]:
            later._delete(later.base)
        del Cut.opened[k:]

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:04d}"
        with small_batches(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._mereweave_path = path
        return out

    def release(self) -> None:
        """Lets Spark delete shuffle files of steps that are over: it does so when their plans are collected as garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        self._delete(df._mereweave_path)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_KEPT: dict[object, object] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def kept(key: object, make) -> object:
    """A worker's memo that outlives a task. Only one is held at a time: an operator's makes room for the next one's."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Drops the memo of an earlier operator and hands freed memory back; steps that need no memo call it before they take memory."""
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, target: int = 6 << 20, most: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that ``column`` holds about ``target`` bytes in each (one row at least, ``most`` rows at most)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = min(at + most, max(at + 1, int(np.searchsorted(ends, done + target, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


# --- words -------------------------------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(WORD_SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and row offsets into them; a null is an empty text."""
    col = col.fill_null("") if col.null_count else col
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Finds the words ``[^\\x20\\x09-\\x0D]+`` of each row, without a loop over rows.

    Returns byte start and end of every word, a 64-bit hash of its bytes and, per row, the index of
    its first word (with a closing entry). ``lower`` maps A-Z to a-z first.
    """
    n = len(data)
    if lower:
        data = _LOWER[data]
    sep = _IS_SEP[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    inside = ~sep
    first = inside.copy()
    first[1:] &= sep[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= sep[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    row_first = np.searchsorted(starts, offsets)
    return starts, ends, hash_spans(data, starts, ends), row_first


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: eight bytes at a time, mixed after each, in order."""
    h = mix64((ends - starts).astype(np.uint64) + _MULT)
    if not len(starts):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at, live = starts.copy(), np.arange(len(starts))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    while len(live):
        left = ends[live] - at[live]
        block = np.ascontiguousarray(eight[at[live]]).view("<u8").ravel()
        short = left < 8
        if short.any():
            block[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        h[live] = mix64((h[live] ^ block) * _MULT)
        at[live] += 8
        live = live[left > 8]
    return h


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` consecutive word hashes (over the flat array, rows not yet told apart)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _MULT + h[i : i + n]
    return mix64(out)


def anti_clash(df: DataFrame, **columns: str) -> DataFrame:
    """Selects just the named inputs under the operator's own names, so that other columns cannot clash."""
    return df.select(*[F.col(f"`{name}`").alias(own) for own, name in columns.items()])
