"""Token-ID output as directly addressable codes (DAC).

An id is cut into chunks of fixed widths. Level 0 holds every id's lowest chunk; one bit per entry
says whether the id continues on the next level, and a rank directory (ones before each block of
512 bits) gives the place there. So the id at any position is found with one directory look-up and
one short popcount per level, without decoding a block before it.

A segment (one row of the Parquet container, itself a self-contained byte string) is laid out as::

    magic "DAC1" | u32 n_docs | u64 n_ids | u8 n_levels | u8 chunk widths[n_levels] | pad to 8
    i64 doc_ids[n_docs] | u64 doc_starts[n_docs + 1]           (starts within the segment)
    per level: u64 n | chunks (u8 or u16 each) | pad to 8 | bitmap bytes | pad to 8 | u32 ranks[] | pad to 8

Segments are ordered by doc_id; a document never spans two.
Nulls and edges: a null text is an empty one (its segment entry holds only the closing id); rows
with equal doc_id are kept, in the order of their texts; a null doc_id sorts first and is stored as
the smallest 64-bit integer with its null flag kept by the container's column; an empty table gives no
segments.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import anti_clash, crc32, slices
from .word_tokens import encoder

MAGIC = b"DAC1"
WIDTHS = (8, 8, 8, 8)
BLOCK = 512
SEGMENT_SCHEMA = "part int, seg int, n_docs long, n_ids long, null_ids array<int>, payload binary"
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_NO_ID = -(2**63)


def _pad(out: list[bytes], piece: bytes) -> None:
    out.append(piece)
    if len(piece) % 8:
        out.append(b"\0" * (-len(piece) % 8))


def write_segment(doc_ids: list[int], starts: np.ndarray, ids: np.ndarray, widths=WIDTHS) -> bytes:
    """Encodes one segment: ``ids`` are all its ids, ``starts`` the documents' places and the end."""
    top, used, bits = int(ids.max()) if len(ids) else 0, 0, 0
    while used == 0 or (top >> bits and used < len(widths)):
        bits += widths[used]
        used += 1
    if top >> bits:
        raise ValueError(f"id {top} does not fit chunk widths {widths}")
    out: list[bytes] = []
    head = MAGIC + struct.pack("<IQB", len(doc_ids), len(ids), used) + bytes(widths[:used])
    _pad(out, head)
    _pad(out, np.asarray(doc_ids, "<i8").tobytes())
    _pad(out, np.asarray(starts, "<u8").tobytes())
    rest = ids.astype(np.uint64)
    for k in range(used):
        w = widths[k]
        chunk = rest & np.uint64((1 << w) - 1)
        rest = rest >> np.uint64(w)
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (BLOCK // 8), np.uint8)])
        ones = _POPCOUNT[bitmap].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else np.zeros(0)
        _pad(out, struct.pack("<QQ", len(chunk), len(bitmap)))
        _pad(out, chunk.astype("<u1" if w <= 8 else "<u2").tobytes())
        _pad(out, bitmap.tobytes())
        _pad(out, ranks.astype("<u4").tobytes())
        rest = rest[more]
    return b"".join(out)


class Segment:
    """Random access to a segment's ids; nothing is decoded until asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        self.raw = payload
        n_docs, self.n_ids, used = struct.unpack_from("<IQB", payload, 4)
        self.widths = payload[17 : 17 + used]
        self.at = -(-(17 + used) // 8) * 8
        self.doc_ids = self._take("<i8", n_docs)
        self.starts = self._take("<u8", n_docs + 1).astype(np.int64)
        self.levels = []
        for w in self.widths:
            n, n_bitmap = self._take("<u8", 2).tolist()
            chunks = self._take("<u1" if w <= 8 else "<u2", n)
            bitmap = self._take("<u1", n_bitmap)
            ranks = self._take("<u4", n_bitmap // (BLOCK // 8))
            self.levels.append((w, chunks, bitmap, ranks))

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.raw, kind, n, self.at)
        self.at += -(-out.nbytes // 8) * 8
        return out

    def get(self, where: np.ndarray) -> np.ndarray:
        """The ids at any positions, in any order."""
        at = np.asarray(where, np.int64)
        out = np.zeros(len(at), np.uint64)
        live, shift = np.arange(len(at)), 0
        for w, chunks, bitmap, ranks in self.levels:
            out[live] |= chunks[at].astype(np.uint64) << np.uint64(shift)
            shift += w
            goes_on = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            keep = np.flatnonzero(goes_on)
            if not len(keep):
                break
            live, at = live[keep], self._rank(bitmap, ranks, at[keep])
        return out

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each position: the directory's count, then the bits of the block before it."""
        block, byte = at // BLOCK, at >> 3
        r = ranks[block].astype(np.int64)
        first = block * (BLOCK // 8)
        if len(at) * 8 > len(bitmap):  # many positions: one running count serves them all
            before = np.concatenate([[0], np.cumsum(_POPCOUNT[bitmap], dtype=np.int64)])
            r += before[byte] - before[first]
        else:
            for k in range(BLOCK // 8):
                inner = first + k < byte
                if not inner.any():
                    break
                r += np.where(inner, _POPCOUNT[bitmap[np.minimum(first + k, len(bitmap) - 1)]], 0)
        return r + _POPCOUNT[bitmap[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)]

    def document(self, k: int) -> np.ndarray:
        return self.get(np.arange(self.starts[k], self.starts[k + 1]))


def encode_segments(docs: DataFrame, vocab_path: str, end_id: int, id_col="doc_id", text_col="text", segment_ids: int = 1 << 20) -> DataFrame:
    """Tokenises whole texts and returns the segments of the file format, in ascending id order.

    The texts are dealt out by ranges of their ids once; a partition's segments hold at least
    ``segment_ids`` ids each (but the last), so memory is bounded by that and one document.
    """
    rows = anti_clash(docs, doc_id=id_col, text=text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, close = TaskContext.get().partitionId(), encoder(vocab_path), np.array([end_id], "<u4")
        seg, doc_ids, found, size = 0, [], [], 0

        def flush():
            nonlocal seg, doc_ids, found, size
            starts = np.cumsum([0, *map(len, found)])
            payload = write_segment([_NO_ID if d is None else d for d in doc_ids], starts, np.concatenate(found))
            nulls = [k for k, d in enumerate(doc_ids) if d is None]
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([len(doc_ids)], pa.int64()), pa.array([size], pa.int64()), pa.array([nulls], pa.list_(pa.int32())), pa.array([payload], pa.binary())], ["part", "seg", "n_docs", "n_ids", "null_ids", "payload"])
            seg, doc_ids, found, size = seg + 1, [], [], 0
            return out

        for batch in slices(batches, "text", 2 << 20):
            for d, raw in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.concatenate([np.frombuffer(raw, "<u2").astype("<u4"), close])
                doc_ids.append(d)
                found.append(ids)
                size += len(ids)
                if size >= segment_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    return rows.mapInArrow(run, SEGMENT_SCHEMA)


def read_documents(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """Reads segments back: one row per document with its global start, length and checksum.

    The starts come from a running sum over parts (one small row per written partition), then over
    the segments of a part; no id passes through the driver.
    """
    from pyspark.sql import Window

    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("part").orderBy("seg")
    places = segments.select("part", "seg", "n_ids").select("part", "seg", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("before"))
    places = places.join(base, "part").select("part", "seg", (F.col("base") + F.col("before")).alias("first"))
    placed = segments.select("part", "seg", "null_ids", "payload").join(places, ["part", "seg"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pydict()
                s, nulls, first = Segment(one["payload"][0]), set(one["null_ids"][0] or ()), one["first"][0]
                ids = s.get(np.arange(s.n_ids)).astype("<u4").tobytes()
                at = s.starts.tolist()
                sums = [crc32(ids[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
                names = [None if k in nulls else d for k, d in enumerate(s.doc_ids.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([first + a for a in at[:-1]], pa.int64()), pa.array([b - a for a, b in zip(at, at[1:], strict=False)], pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("first", "null_ids", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
