"""Embedding near-dedup by collision-counting projections.

1. Equal vectors form a class; one of each goes on, with the class's size.
2. Every vector is projected on ``tables * bits`` random directions. ``bits`` signs in a row are one
   sort key; a vector's window in a table is the run of equal keys around it. (Windows over single
   projections are too wide: at cosine 0.95 in 64 dimensions any choice of window and count that keeps
   99 % of the links visits about half of all pairs. See README.)
3. A pair's collisions over all tables are counted; the count and the number of tables are set from
   the collision probability at the threshold, so that a pair there passes with ``recall`` at least. Only ids and
   keys travel for this: windows of up to ``small`` vectors list their pairs, which are counted by pair, and vectors are joined
   to pairs that pass. Larger windows list no pairs: their vectors come with all their keys, blocks of ``tile`` vectors meet
   block by block, and a pair belongs to the first large window that it shares. Links are
   returned as counts and, for components, one label a vector.
4. Verification is the cosine in double precision, on the vectors as they are given.

Nulls and edges: vectors that are null, empty, zero or hold null or non-finite components link with
nothing, nor do vectors with a null id (their component is null); vectors of different length never
link; rows that repeat an id are expected to repeat the vector and count as further vectors; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, anti_clash, mix64
from .components import components

_SEED = 271828


def calibrate(threshold: float, bits: int, count: int, recall: float) -> int:
    """The least number of tables in which a pair at the threshold collides ``count`` times with ``recall``."""
    p = (1 - math.acos(threshold) / math.pi) ** bits
    tables = count
    while sum(math.comb(tables, c) * p**c * (1 - p) ** (tables - c) for c in range(count)) > 1 - recall:
        tables += 1
    return tables


def _codes(x: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Sort keys [vector, table] of ``bits`` signs each."""
    rng = np.random.default_rng([_SEED, x.shape[1]])
    weights = (1 << np.arange(bits, dtype=np.uint32)).astype(np.uint32)
    out = np.empty((len(x), tables), np.uint32)
    for t in range(tables):
        directions = rng.standard_normal((x.shape[1], bits))
        out[:, t] = ((x @ directions) >= 0).astype(np.uint32) @ weights
    return out


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors of one length from stored components, scaled by the largest first so that no square over- or underflows."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(vectors: DataFrame, tables: int, bits: int, kind: str) -> DataFrame:
    """(rep, copies, vector, code, keys) of each distinct vector; ``kind`` is how its components are stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                raw = [np.asarray(v, kind).tobytes() for v in batch.column(1).to_numpy(zero_copy_only=False)]
                dims = np.array([len(r) for r in raw])
                for d in np.unique(dims):
                    at = np.flatnonzero(dims == d)
                    part, own = batch.take(pa.array(at)), [raw[k] for k in at.tolist()]
                    code = _codes(_units(own, kind), tables, bits)
                    lead = mix64(code.astype(np.uint64) + (np.arange(tables, dtype=np.uint64) << np.uint64(32)) + (np.uint64(d) << np.uint64(48)))
                    keys = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * tables, pa.int32()), pa.array(lead.view(np.int64).ravel()))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(own, pa.binary()), pa.array([r.tobytes() for r in code.astype("<u4")], pa.binary()), keys], ["rep", "copies", "vector", "code", "keys"])

    return vectors.mapInArrow(run, "rep long, copies long, vector binary, code binary, keys array<long>")


def _large(rows: pa.Table, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and whether each vector's window is large, [vector, table]."""
    code = np.frombuffer(b"".join(rows["code"].to_pylist()), "<u4").reshape(-1, tables)
    large = np.zeros(code.shape, bool)
    for k, ts in enumerate(rows["large"].to_pylist()):
        large[k, ts or []] = True
    return code, large


def _of_pairs(pairs: DataFrame, coded: DataFrame, tables: int, kind: str, threshold: float) -> DataFrame:
    """(rep, n, label) of counted pairs that are links and share no large window."""
    side = lambda c: coded.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("copies", "vector", "code", "large")])
    rows = pairs.join(side("a"), "a").join(side("b").drop("large_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4000):
                part = pa.table(whole.slice(lo, 4000))
                va, vb = part["vector_a"].to_pylist(), part["vector_b"].to_pylist()
                part = part.filter(pa.array([len(x) == len(y) for x, y in zip(va, vb, strict=True)]))
                link = np.zeros(part.num_rows, bool)
                dims = np.array([len(x) for x in part["vector_a"].to_pylist()])
                va, vb = part["vector_a"].to_pylist(), part["vector_b"].to_pylist()
                for d in np.unique(dims):
                    at = np.flatnonzero(dims == d)
                    link[at] = np.einsum("ij,ij->i", _units([va[k] for k in at], kind), _units([vb[k] for k in at], kind)) >= threshold
                code_a, large = _large(part.select(["code_a", "large_a"]).rename_columns(["code", "large"]), tables)
                code_b = np.frombuffer(b"".join(part["code_b"].to_pylist()), "<u4").reshape(-1, tables)
                link &= ~((code_a == code_b) & large).any(axis=1)
                a, b, na, nb = (part[c].to_numpy()[link] for c in ("a", "b", "copies_a", "copies_b"))
                low = np.minimum(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((a, b), (nb, na), (low, low))], ["rep", "n", "label"])

    return rows.select("a", "b", "copies_a", "copies_b", "vector_a", "vector_b", "code_a", "code_b", "large_a").mapInArrow(run, "rep long, n long, label long")


def _of_windows(large: DataFrame, coded: DataFrame, tables: int, kind: str, threshold: float, count: int, tile: int) -> DataFrame:
    """(rep, n, label): links and least linked id that a pair of blocks of one large window finds for a vector."""
    sizes = large.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    dealt = large.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("rep", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "t")
    tiles = tiles.join(coded.select("rep", "copies", "vector", "code", "large"), "rep")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        _, i, j = (x.as_py() for x in key)
        block, rep, copies, t0 = rows["block"].to_numpy(), rows["rep"].to_numpy(), rows["copies"].to_numpy(), int(rows["t"][0].as_py())
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        unit = _units(rows["vector"].to_pylist(), kind)
        link = unit[left] @ unit[right].T >= threshold
        if i == j:
            np.fill_diagonal(link, False)
        total, label = np.zeros(len(rep), np.int64), rep.copy()
        if link.any():
            code, wide = _large(rows, tables)
            seen = np.zeros(link.shape, np.uint16)
            for t in range(tables):
                same = code[left, t][:, None] == code[right, t][None, :]
                seen += same
                if t < t0:
                    link &= ~(same & wide[left, t][:, None])
            link &= seen >= count
            total[left] += link @ copies[right]
            if i != j:
                total[right] += link.T @ copies[left]
            far = np.iinfo(np.int64).max
            while True:  # least labels over the block's links
                old = label.copy()
                label[left] = np.minimum(label[left], np.where(link, label[right][None, :], far).min(axis=1, initial=far))
                label[right] = np.minimum(label[right], np.where(link, label[left][:, None], far).min(axis=0, initial=far))
                if (label == old).all():
                    break
        some = np.flatnonzero(total > 0)
        return pa.table({"rep": rep[some], "n": total[some], "label": label[some]})

    return tiles.groupBy("key", "i", "j").applyInArrow(run, "rep long, n long, label long")


def near_duplicates(table: DataFrame, id_col="vec_id", vector_col="embedding", threshold: float = 0.95, recall: float = 0.995, count: int = 2, tile: int = 1500, small: int = 24) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    cut = Cut(table.sparkSession)
    single = table.schema[vector_col].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"
    own = anti_clash(table, vec_id=id_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<float>" if single else "array<double>"))
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("vec_id").isNotNull() & (F.size("vector") > 0) & ~odd & F.exists("vector", lambda v: v != 0)
    rows = own.withColumn("good", F.coalesce(good, F.lit(False)))
    marked = rows.select("vec_id", "good", F.when(F.col("good"), F.xxhash64("vector")).alias("h1"), F.when(F.col("good"), F.xxhash64(F.lit(7), F.reverse("vector"))).alias("h2"), "vector")
    usable = marked.where("good")
    classes = cut.keep(usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    n = max(2, classes.count())
    bits = min(30, max(8, math.ceil(math.log2(n))))
    tables = calibrate(threshold, bits, count, recall)
    firsts = usable.join(classes, ["h1", "h2"]).where("vec_id = rep").dropDuplicates(["h1", "h2"]).select("rep", "vector", "copies")
    coded = cut.keep(_coded(firsts, tables, bits, kind))
    keyed = coded.select("rep", F.posexplode("keys").alias("t", "key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut.keep(keyed.join(sizes, "key"))
    large = shared.where(F.col("n") > small).select("rep", "t", "key")
    few = shared.where(F.col("n") <= small).select("rep", "key")
    pairs = few.withColumnRenamed("rep", "a").join(few.withColumnRenamed("rep", "b"), "key").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= count).select("a", "b")
    wide = large.groupBy("rep").agg(F.collect_set("t").alias("large"))  # at most one entry a table
    coded = cut.keep(coded.drop("keys").join(wide, "rep", "left"))
    found = cut.keep(_of_pairs(pairs, coded, tables, kind, threshold).union(_of_windows(large, coded, tables, kind, threshold, count, tile)))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    comps = components(found.select(F.col("rep").alias("a"), F.col("label").alias("b")), cut)
    per = classes.join(links, "rep", "left").join(comps, F.col("rep") == F.col("node"), "left")
    per = per.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = marked.select("vec_id", "h1", "h2").join(per, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
