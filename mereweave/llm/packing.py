"""Best-fit packing with certified bin counts.

Documents are tokenised once; texts longer than the capacity are cut into full pieces, which fill a
sequence alone. The other pieces are dealt over partitions and packed there best-fit decreasing. A
dual-feasible-function bound (the best of the Fekete-Schepers rounding family and the plain sum)
says how few bins a partition could need; partitions whose count equals it are certified, the
others exchange their documents (a new deal over fewer, larger partitions; a single one left takes
in a certified partner) and run again, as long as that saves sequences. A new packing replaces the old one
only if it needs fewer sequences in all. ``certified`` says of each row whether its partition's count is proven
least; ``least_sequences`` gives the bound of any packing of the whole table.

Nulls and edges: a null text is an empty one (only its closing id); a repeated doc_id is packed as
often as it comes; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, anti_clash, crc32, slices
from .word_tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocab_path: str, end_id: int, capacity: int, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per piece of at most ``capacity`` ids of each whole text, closed with ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, close = encoder(vocab_path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text", 2 << 20):
            rows: tuple[list, ...] = ([], [], [], [], [])
            adds = [r.append for r in rows]
            for d, raw in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.frombuffer(raw, "<u2").astype("<u4").tobytes() + close
                for piece, at in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * at : 4 * (at + capacity)]
                    for add, v in zip(adds, (d, piece, at, len(part) // 4, crc32(part)), strict=True):
                        add(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return anti_clash(docs, doc_id=id_col, text=text_col).mapInArrow(run, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int, times: np.ndarray | None = None) -> int:
    """The bins that any packing needs at least, by dual feasible functions (``times``: how often each length comes).

    ``u_e`` counts items over capacity - e whole, drops those under e and rounds the rest by sum;
    ``phi_k`` rounds to multiples of 1/k. Both map feasible bins to sums of at most one.
    """
    if not len(lengths):
        return 0
    n, c = lengths.astype(np.int64), int(capacity)
    m = np.ones(len(n), np.int64) if times is None else times.astype(np.int64)
    best = -(-int((n * m).sum()) // c)
    small = n[n <= c // 2]
    for e in np.unique(np.quantile(small, np.linspace(0, 1, 33)).astype(np.int64)) if len(small) else [0]:
        mid = (n >= e) & (n <= c - e)
        best = max(best, int(m[n > c - e].sum()) + -(-int((n * m)[mid].sum()) // c))
    for k in range(1, 12):  # x -> x if (k+1)x/c is whole, else floor((k+1)x/c)/k; in units of c*k
        scaled = (k + 1) * n
        value = np.where(scaled % c == 0, n * k, (scaled // c) * c)
        best = max(best, -(-int((value * m).sum()) // (c * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the bin and offset of every item, and the number of bins."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: dict[int, list[int]] = {}
    sizes: list[int] = []  # the distinct free sizes of open bins, ascending
    n_bins = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        k = bisect.bisect_left(sizes, need)
        if k == len(sizes):
            b, free, n_bins = n_bins, capacity, n_bins + 1
        else:
            free = sizes[k]
            b = room[free].pop()
            if not room[free]:
                del room[free], sizes[k]
        bins[item], offsets[item] = b, capacity - free
        if free > need:
            left = free - need
            if left in room:
                room[left].append(b)
            else:
                room[left] = [b]
                bisect.insort(sizes, left)
    return bins, offsets, n_bins


def _packed(pieces: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    """Deals pieces over ``parts`` partitions and packs each; adds part, bin, offset, n_bins and the bound."""
    deal = F.pmod(F.xxhash64("doc_id", "piece", F.lit(salt)), F.lit(parts)).cast("int")
    dealt = pieces.withColumn("part", deal)

    def pack(table: pa.Table) -> pa.Table:
        order = table.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        lengths = order["length"].to_numpy()
        bins, offsets, n = best_fit(lengths, capacity)
        for name, values in (("bin", bins), ("offset", offsets), ("n_bins", np.full(len(bins), n)), ("bound", np.full(len(bins), lower_bound(lengths, capacity)))):
            order = order.append_column(name, pa.array(values, pa.int64()))
        return order

    return dealt.groupBy("part").applyInArrow(pack, f"{PIECES}, part int, bin long, offset long, n_bins long, bound long")


def least_sequences(pieces: DataFrame, capacity: int) -> int:
    """The sequences that any packing of all pieces needs at least, from the counts of their lengths (at most ``capacity`` rows)."""
    by = pieces.groupBy("length").agg(F.count("*").alias("n")).toArrow()
    return lower_bound(by["length"].to_numpy(), capacity, by["n"].to_numpy())


def pack(docs: DataFrame, vocab_path: str, end_id: int, capacity: int = 4096, id_col="doc_id", text_col="text", per_part: int = 50_000, growth: int = 8) -> DataFrame:
    """Packs whole documents; returns a row per piece with its sequence, gapless offset and certificate.

    ``per_part`` pieces meet in a partition (a few MB whatever the input), so the waste is under one
    open sequence per partition; the partitions of later exchanges hold up to ``growth`` times as many.
    """
    cut = Cut(docs.sparkSession)
    pieces = cut.keep(token_pieces(docs, vocab_path, end_id, capacity, id_col, text_col))
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    done: list[DataFrame] = []
    n = rest.count()
    current, layer = (cut.keep(_packed(rest, max(1, -(-n // per_part)), 0, capacity)), 0) if n else (None, 0)
    while current is not None:
        each = current.groupBy("part").agg(F.max("n_bins").alias("n_bins"), F.max("bound").alias("bound"), F.count("*").alias("n"))
        row = each.agg(F.count_if(F.col("n_bins") > F.col("bound")).alias("gaps"), F.min(F.when(F.col("n_bins") <= F.col("bound"), F.col("part"))).alias("partner")).first()
        if not row["gaps"] or (row["gaps"] == 1 and row["partner"] is None):
            break
        joins = F.col("n_bins") > F.col("bound")
        if row["gaps"] == 1:
            joins |= F.col("part") == row["partner"]
        old = each.where(joins).agg(F.sum("n_bins").alias("bins"), F.sum("n").alias("n")).first()
        layer += 1
        parts = max(1, -(-old["n"] // (per_part * min(growth, 2**layer))))
        again = cut.keep(_packed(current.where(joins).select(*pieces.columns), parts, layer, capacity))
        if again.groupBy("part").agg(F.max("n_bins").alias("n_bins")).agg(F.sum("n_bins")).first()[0] >= old["bins"]:
            cut.drop(again)
            layer -= 1
            break
        done.append(_numbered(current.where(~joins), layer - 1))
        current = again
    out = full.select(*pieces.columns, (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    for table in done if current is None else [*done, _numbered(current, layer)]:
        out = out.unionByName(table)
    return out


def _numbered(packed: DataFrame, layer: int) -> DataFrame:
    """Names the sequences of one exchange apart from those of the others."""
    place = F.lit(layer << 56) + F.col("part").cast("long") * F.lit(1 << 28) + F.col("bin")
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", place.alias("sequence_id"), "offset", (F.col("n_bins") <= F.col("bound")).alias("certified"))
