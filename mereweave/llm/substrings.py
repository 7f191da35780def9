"""Substring dedup by fixed-block anchors.

A window is ``window`` consecutive words. Any window holds one whole block of the non-overlapping
blocks of ``window // 2 + 1`` words that tile its document, so a repeat is found by probing those
reference blocks with every rolling run of block length:

1. Every rolling run's hash, with a bit for "starts a reference block", is sent to the partition of
   its leading bits as a compact sorted code (four to five bytes a word) with the document's number in its
   chunk. A run that equals a reference block elsewhere is a hit of its document.
2. Hits are extended: each window around a hit is a candidate, and is kept if the same words start
   anywhere else, which is decided on 128-bit fingerprints of its words. Neighbouring kept windows form the
   maximal exact repeats. No pairs of places are made, so a passage in many documents costs as much
   as its copies.
3. Words covered by kept windows are removed.

Codes are dealt out over at most ``FAN`` parts at once, and a part of more entries is matched share by share of its range, so
that codes travel once up to ``FAN << SHARE_LOG`` times ``per_part`` entries (about 100 GB of text). Where the input needs more,
groups of codes of one part are merged and dealt again by the next bits, so a chunk never makes more than ``FAN`` rows and rows
stay large. At every level, equal codes that meet are decided on the spot and only one goes on: a passage in very many documents
reaches its last partition a bounded number of times for each group below it.

Windows are judged on the input, not on what is left. Nulls and edges: a null text has no words; texts
shorter than a window lose nothing; ids of any type, null or repeated, only name rows: documents are told apart
inside by two hashes of (id, text), and a repeated row repeats its windows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Cut, anti_clash, forget, slices, text_bytes, window_hashes, words

#: One row: a part's codes of a chunk or merged group (``hits`` null), or hits on their way back to a chunk's documents.
_CODES = "part long, chunk long, n int, high binary, low binary, extra binary, owner binary, ref binary, origin binary, origins binary, ids binary, hits binary"
_NAMES = [c.split()[0] for c in _CODES.split(", ")]
_KINDS = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in _CODES.split(", ")]
_MATCHED = "chunk long, ids binary, owner binary, hits binary"
#: Leading bits of one deal, and its parts; bits of the shares in which a part is matched.
FAN_LOG = 11
FAN = 1 << FAN_LOG
SHARE_LOG = 3
#: Bits of an anchor's code beyond those that name its last part; exact windows carry 64 bits and 64 more.
ANCHOR_BITS = 28
_SLICE = 2 << 20


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """(key, mark): 128 bits that tell rows apart by id and text, whatever the id's type; null ids are spread by their texts."""
    name, text = F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")
    return F.xxhash64(name, text).alias("key"), F.xxhash64(text, F.coalesce(name, F.lit("null")), F.lit(1)).alias("mark")


def _rolling(col: pa.Array, *sizes: int, salt: int = 0) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each size: hash, row and place in the row of every run of that many words that lies in one row."""
    data, offsets = text_bytes(col)
    _, _, h, first = words(data, offsets)
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n), dtype=np.int32), n)
    out = []
    for size in sizes:
        w = window_hashes(h, size)
        row = rows[: len(w)]
        place = np.arange(len(w), dtype=np.int32) - first[row].astype(np.int32)
        ok = place + size <= n[row]
        out.append((w[ok], row[ok], place[ok]))
    if salt:  # a second, independent hash of the last size's runs
        out.append(window_hashes(mix_words(h, salt), sizes[-1])[ok])
    return out


def mix_words(h: np.ndarray, salt: int) -> np.ndarray:
    """Word hashes under another polynomial, so that runs equal in one hash by chance differ in the other."""
    x = h * np.uint64(2 * salt + 1)
    return x ^ (x >> np.uint64(29))


def _widths(n: int, bits: int) -> tuple[int, int]:
    """(bitmap bits, raw bytes) of a code: the bitmap is at most about four times as long as the row has entries."""
    raw = -(-bits // 8)
    while raw and bits - 8 * (raw - 1) <= max(0, (4 * n).bit_length() - 1):
        raw -= 1
    return max(0, bits - 8 * raw), raw


def _write(h: np.ndarray, lead: int, bits: int) -> tuple[bytes, bytes]:
    """Sorted hashes without their ``lead`` first bits: unary-coded high parts and raw low bytes."""
    v = (h << np.uint64(lead)) >> np.uint64(64 - bits)
    top, raw = _widths(len(h), bits)
    if top:
        ones = np.zeros((1 << top) + len(h), bool)
        ones[(v >> np.uint64(bits - top)).astype(np.int64) + np.arange(len(h))] = True
        high = np.packbits(ones).tobytes()
    else:
        high = b""
    low = np.ascontiguousarray(v.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :raw]
    return high, low.tobytes()


def _read(high: bytes, low: bytes, n: int, part: int, lead: int, bits: int) -> np.ndarray:
    top, raw = _widths(n, bits)
    v = np.zeros((n, 8), np.uint8)
    v[:, :raw] = np.frombuffer(low, np.uint8).reshape(n, raw)
    v = v.view("<u8").ravel().astype(np.uint64)
    if top:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), count=(1 << top) + n))
        v |= (ones - np.arange(n)).astype(np.uint64) << np.uint64(bits - top)
    v = (v << np.uint64(64 - bits)) >> np.uint64(lead)
    return v | (np.uint64(part) << np.uint64(64 - lead)) if lead else v


class _Codes:
    """Entries of codes (hash, second hash or none, owner, reference bit, chunk), sorted by their hashes."""

    def __init__(self, h, extra, owner, ref, origin, origins):
        order = np.argsort(h, kind="stable") if extra is None else np.lexsort((extra, h))
        self.h, self.owner, self.ref, self.origin, self.origins = h[order], owner[order], ref[order], origin[order], origins
        self.extra = None if extra is None else extra[order]
        new = np.ones(len(h), bool)
        new[1:] = self.h[1:] != self.h[:-1]
        if extra is not None:
            new[1:] |= self.extra[1:] != self.extra[:-1]
        lead = np.flatnonzero(new)
        many = np.diff(np.append(lead, len(h)))
        #: entries of hashes that come twice and at a reference
        twice = (many >= 2) & np.logical_or.reduceat(self.ref, lead) if len(h) else np.zeros(0, bool)
        self.hit, self.first = np.repeat(twice, many), lead[twice]

    def hits(self) -> list[tuple]:
        """(chunk, owners, hashes) of the decided entries, one row a chunk."""
        return _hit_rows([self.decided()], self.origins)

    def decided(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Origins, owners and hashes of the decided entries."""
        return self.origin[self.hit], self.owner[self.hit], self.h[self.hit]

    def rows(self, lead: int, code_bits: int, chunk: int) -> list[tuple]:
        """Code rows of what goes on, by the first ``lead`` bits: all undecided entries and one of each decided hash."""
        sent = ~self.hit
        sent[self.first] = True
        ref = self.ref.copy()
        ref[self.first] = True
        h, owner, ref, origin = self.h[sent], self.owner[sent], ref[sent], self.origin[sent]
        extra = None if self.extra is None else self.extra[sent]
        part = (h >> np.uint64(64 - lead)).astype(np.int64) if lead else np.zeros(len(h), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])).tolist() if len(h) else [0]
        single, table = len(self.origins) == 1, self.origins.astype("<i8").tobytes()
        out = []
        for a, b in zip(edges, edges[1:], strict=False):
            high, low = _write(h[a:b], lead, code_bits - lead)
            out.append((int(part[a]), chunk, b - a, high, low, None if extra is None else extra[a:b].tobytes(), owner[a:b].tobytes(), np.packbits(ref[a:b]).tobytes(), None if single else origin[a:b].tobytes(), table, None, None))
        return out


def _hit_rows(decided: list[tuple], origins: np.ndarray) -> list[tuple]:
    """(chunk, owners, hashes) of decided entries of several shares, one row a chunk."""
    if not decided:
        return []
    of, owner, h = (np.concatenate(x) for x in zip(*decided, strict=True))
    at = np.argsort(of, kind="stable")
    of, owner, h = of[at], owner[at], h[at]
    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist() if len(of) else [0]
    return [(int(origins[of[a]]), owner[a:b].tobytes(), h[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)]


def _spread(chunk: int, lead: int) -> int:
    """The part through which a chunk's own rows travel."""
    return ((chunk >> 32) * 1_000_003 + (chunk & 0xFFFFFFFF)) % (1 << lead)


def _origin_kind(origins: np.ndarray) -> str:
    return "<u2" if len(origins) <= 1 << 16 else "<u4"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], _NAMES)


def _first_rows(h: np.ndarray, extra, owner: np.ndarray, ref: np.ndarray, ids: np.ndarray, lead: int, code_bits: int, chunk: int) -> pa.RecordBatch:
    """A chunk's rows: its ids with the hits that it decides itself, and its codes by part."""
    if code_bits < 64:
        h = h & np.uint64(((1 << code_bits) - 1) << (64 - code_bits))
    codes = _Codes(h, extra, owner.astype("<u2"), ref, np.zeros(len(h), "<u2"), np.array([chunk], np.int64))
    own = codes.hits()
    home = (_spread(chunk, lead), chunk, 0, None, None, None, own[0][1] if own else b"", None, None, None, ids.tobytes(), own[0][2] if own else b"")
    return _batch([home, *codes.rows(lead, code_bits, chunk)])


def _load(table: pa.Table, lead: int, code_bits: int, share_log: int = 0) -> tuple[list[dict], np.ndarray, Iterator[_Codes]]:
    """The rows of a group that only pass through, the chunks of its code entries, and the entries in shares by the bits after ``lead``."""
    through, parts, tables, base = [], [], [], 0
    for batch in table.select(_NAMES).to_batches():
        for r in batch.to_pylist():
            if r["hits"] is not None:
                through.append(r)
                continue
            n, origins = r["n"], np.frombuffer(r["origins"], "<i8")
            h = _read(r["high"], r["low"], n, r["part"], lead, code_bits - lead)
            edges = [0, n]
            if share_log:
                share = (h << np.uint64(lead)) >> np.uint64(64 - share_log)
                edges = np.searchsorted(share, np.arange((1 << share_log) + 1, dtype=np.uint64)).tolist()
            origin = None if r["origin"] is None else np.frombuffer(r["origin"], _origin_kind(origins))
            extra = None if r["extra"] is None else np.frombuffer(r["extra"], np.uint64)
            ref = np.unpackbits(np.frombuffer(r["ref"], np.uint8), count=n).astype(bool)
            parts.append((edges, h, extra, np.frombuffer(r["owner"], "<u2"), ref, origin, base))
            tables.append(origins)
            base += len(origins)
    every = np.concatenate(tables) if tables else np.zeros(0, np.int64)

    def shares() -> Iterator[_Codes]:
        for k in range(1 << share_log if parts else 0):
            some = []
            for edges, h, extra, owner, ref, origin, first in parts:
                lo, hi = edges[k], edges[k + 1]
                if hi > lo:
                    of = np.full(hi - lo, first, np.int64) if origin is None else origin[lo:hi].astype(np.int64) + first
                    some.append((h[lo:hi], None if extra is None else extra[lo:hi], owner[lo:hi], ref[lo:hi], of))
            if some:
                h, extra, owner, ref, of = zip(*some, strict=True)
                yield _Codes(np.concatenate(h), None if extra[0] is None else np.concatenate(extra), np.concatenate(owner), np.concatenate(ref), np.concatenate(of), every)

    return through, every, shares()


def _deal_again(codes: DataFrame, lead: int, to: int, code_bits: int, groups: int) -> DataFrame:
    """Merges the codes of a part, in ``groups`` shares by chunk, and deals each share out by its next bits."""

    def run(table: pa.Table) -> pa.Table:
        through, _, shares = _load(table, lead, code_bits)
        merged = next(shares, None)
        out = [(_spread(r["chunk"], to), *[r[name] for name in _NAMES[1:]]) for r in through]
        if merged is not None:
            out += [(_spread(c, to), c, 0, None, None, None, owner, None, None, None, None, hits) for c, owner, hits in merged.hits()]
            used, merged.origin = np.unique(merged.origin, return_inverse=True)
            merged.origins = merged.origins[used]
            merged.origin = merged.origin.astype(_origin_kind(merged.origins))
            out += merged.rows(to, code_bits, int(merged.origins[0]))
        return pa.Table.from_batches([_batch(out)])

    return codes.withColumn("share", F.pmod(F.xxhash64("chunk"), F.lit(groups))).groupBy("part", "share").applyInArrow(run, _CODES)


def _match(codes: DataFrame, lead: int, code_bits: int, share_log: int = 0) -> DataFrame:
    """(chunk, ids, owner, hits): within each part, the entries whose hash comes twice and at a reference."""

    def run(table: pa.Table) -> pa.Table:
        through, origins, shares = _load(table, lead, code_bits, share_log)
        out = [(r["chunk"], r["ids"], r["owner"], r["hits"]) for r in through]
        out += [(c, None, owner, hits) for c, owner, hits in _hit_rows([codes.decided() for codes in shares], origins)]
        cols = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table({name: pa.array(c, k) for name, c, k in zip(("chunk", "ids", "owner", "hits"), cols, (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)})

    return codes.groupBy("part").applyInArrow(run, _MATCHED)


def _decided(codes: DataFrame, parts_log: int, code_bits: int, chunks: int, together: int = 128) -> DataFrame:
    """Deals first-level codes on, level by level, until shares of parts are as many as ``1 << parts_log``, and matches each."""
    lead = min(parts_log, FAN_LOG)
    while lead + SHARE_LOG < parts_log:
        to = min(parts_log - SHARE_LOG, lead + FAN_LOG)
        chunks //= together
        codes = _deal_again(codes, lead, to, code_bits, max(1, chunks))
        lead = to
    return _match(codes, lead, code_bits, parts_log - lead)


def _by_document(matched: DataFrame) -> DataFrame:
    """(key, mark, hits): every document's hit hashes, sorted and distinct, in one blob."""

    def run(table: pa.Table) -> pa.Table:
        ids, owner, hits = None, [np.zeros(0, np.uint16)], [np.zeros(0, np.uint64)]
        for i, o, h in zip(*[table[c].to_pylist() for c in ("ids", "owner", "hits")], strict=True):
            if i is not None:
                ids = np.frombuffer(i, np.int64).reshape(-1, 2)
            owner.append(np.frombuffer(o, "<u2"))
            hits.append(np.frombuffer(h, np.uint64))
        o, h = np.concatenate(owner), np.concatenate(hits)
        order = np.lexsort((h, o))
        o, h = o[order], h[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])[: len(o)]
        o, h = o[new], h[new]
        edges = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1], [True]])).tolist() if len(o) else [0]
        found = ids[o[edges[:-1]]] if len(o) else np.zeros((0, 2), np.int64)
        return pa.table({"key": pa.array(found[:, 0]), "mark": pa.array(found[:, 1]), "hits": pa.array([h[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary())})

    # Rows that repeat id and text get the same hits, each in its own chunk: any one of them serves.
    return matched.groupBy("chunk").applyInArrow(run, "key long, mark long, hits binary").dropDuplicates(["key", "mark"])


def _member(x: np.ndarray, blob: bytes) -> np.ndarray:
    """Which of ``x`` are in a sorted blob."""
    found = np.frombuffer(blob, np.uint64)
    if not len(found):
        return np.zeros(len(x), bool)
    return found[np.minimum(np.searchsorted(found, x), len(found) - 1)] == x


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)


def _anchor_codes(docs: DataFrame, block: int, lead: int, code_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        chunk = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", _SLICE, 65_535):
            ((h, row, place),) = _rolling(batch.column(2), block)
            yield _first_rows(h, None, row, place % block == 0, _ids(batch), lead, code_bits, chunk)
            chunk += 1

    return docs.select("key", "mark", "text").mapInArrow(run, _CODES)


def _window_codes(found: DataFrame, window: int, block: int, lead: int, anchor_bits: int) -> DataFrame:
    """Codes of the windows around the hits of each document."""
    mask = np.uint64(((1 << anchor_bits) - 1) << (64 - anchor_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        chunk = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", _SLICE, 65_535):
            blobs = batch.column(3).to_pylist()
            (h, row, _), (wide, wrow, _), second = _rolling(batch.column(2), block, window, salt=0x5DEECE66D)
            edges, wedges = np.searchsorted(row, np.arange(len(blobs) + 1)).tolist(), np.searchsorted(wrow, np.arange(len(blobs) + 1)).tolist()
            keep = np.zeros(len(wide), bool)
            for d, b in enumerate(blobs):
                lo, hi, wlo, whi = edges[d], edges[d + 1], wedges[d], wedges[d + 1]
                if whi > wlo:
                    seen = np.concatenate([[0], np.cumsum(_member(h[lo:hi] & mask, b))])
                    starts = np.arange(whi - wlo)
                    keep[wlo:whi] = seen[starts + window - block + 1] > seen[starts]
            yield _first_rows(wide[keep], second[keep], wrow[keep], np.ones(int(keep.sum()), bool), _ids(batch), lead, 64, chunk)
            chunk += 1

    return found.select("key", "mark", "text", "hits").mapInArrow(run, _CODES)


def _cut_words(found: DataFrame, window: int) -> DataFrame:
    """Removes the words of each document's repeated windows; only rows that lose words are returned."""
    schema = "key long, mark long, n_words long, n_removed long, kept string"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", _SLICE):
            blobs, names = batch.column(3).to_pylist(), _ids(batch).tolist()
            data, offsets = text_bytes(batch.column(2))
            start, end, h, first = words(data, offsets)
            w = window_hashes(h, window)
            at, raw, out = first.tolist(), data.data, []
            for d, b in enumerate(blobs):
                lo, hi = at[d], at[d + 1]
                if hi - lo < window:
                    continue
                hit = np.flatnonzero(_member(w[lo : hi - window + 1], b))
                step = np.zeros(hi - lo + 1, np.int32)
                np.add.at(step, hit, 1)
                np.add.at(step, hit + window, -1)
                gone = np.cumsum(step[:-1]) > 0
                if gone.any():
                    kept = b" ".join([raw[a:b] for a, b in zip(start[lo:hi][~gone].tolist(), end[lo:hi][~gone].tolist(), strict=True)])
                    out.append((*names[d], hi - lo, int(gone.sum()), kept.decode()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [c.split()[0] for c in schema.split(", ")])

    return found.select("key", "mark", "text", "hits").mapInArrow(run, schema)


def repeats(docs: DataFrame, cut: Cut, id_col="doc_id", text_col="text", window: int = 35, per_part: int = 1_000_000) -> DataFrame:
    """(key, mark, n_words, n_removed, kept): the rows that lose words, with what is kept of them.

    ``key`` and ``mark`` are those of ``row_key``. A part holds about ``per_part`` entries whatever the input's size.
    """
    block = window // 2 + 1
    own = docs.select(*row_key(id_col, text_col), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts_log = max(0, int(np.ceil(np.log2(max(1, size / 6.2 / per_part)))))
    anchor_bits, chunks, lead = min(64, parts_log + ANCHOR_BITS), 1 + size // _SLICE, min(parts_log, FAN_LOG)
    matched = cut.keep(_decided(_anchor_codes(own, block, lead, anchor_bits), parts_log, anchor_bits, chunks))
    hits = cut.keep(_by_document(matched))
    cut.drop(matched)
    cut.release()
    found = cut.keep(own.join(hits, ["key", "mark"]))
    cut.drop(hits)
    cut.release()
    matched = cut.keep(_decided(_window_codes(found, window, block, lead, anchor_bits), parts_log, 64, chunks))
    again = cut.keep(_by_document(matched))
    cut.drop(matched)
    cut.release()
    return cut.keep(_cut_words(found.drop("hits").join(again, ["key", "mark"]), window).dropDuplicates(["key", "mark"]))


def digests(docs: DataFrame, id_col="doc_id", text_col="text", window: int = 35, per_part: int = 1_000_000) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the SHA-256 of the kept words."""
    cut = Cut(docs.sparkSession)
    less = repeats(docs, cut, id_col, text_col, window, per_part).select("key", "mark", "n_removed", F.sha2("kept", 256).alias("less"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            data, offsets = text_bytes(batch.column(3))
            start, end, _, first = words(data, offsets)
            spans, at, raw = list(zip(start.tolist(), end.tolist(), strict=True)), first.tolist(), data.tobytes()
            sha = [hashlib.sha256(b" ".join([raw[a:b] for a, b in spans[lo:hi]])).hexdigest() for lo, hi in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(first)), pa.array(sha)], ["doc_id", "key", "mark", "n_words", "sha"])

    own = anti_clash(docs, doc_id=id_col, text=text_col).select("doc_id", *row_key("doc_id", "text"), "text")
    whole = own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, key long, mark long, n_words long, sha string")
    out = whole.join(less, ["key", "mark"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("less", "sha").alias("kept_sha256"))
