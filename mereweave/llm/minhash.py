"""MinHash near-deduplication: one-permutation hashing, optimal densification, banded buckets, stars.

1. Each text becomes its set of distinct word shingles (64-bit hashes). One permutation deals them
   into bins, the least hash of a bin is its value; an empty bin copies the first filled one of its own
   fixed pseudo-random order of bins (optimal densification).
2. Texts with equal sets form a class; only its smallest id goes on.
3. Bands of values are bucket keys; in each bucket the smallest id is the centre of a star, so candidates
   grow with the bucket and not with its square. Every document's edge to its least centre is confirmed on
   full sets first.
4. Stars that share members form candidate groups. Where a group still holds several components, members of
   different components are compared in tiles of bounded size: signatures pick the members that may have a partner, full
   sets of those decide, and only links that join two components leave a tile. So a centre that is no partner loses no
   link between others.
5. Components of confirmed links; a class's members take its component by a join.

Nulls and edges: a null text or one without words has an empty set and is linked with nothing; a text
of fewer words than a shingle is one shingle; a row with a null id is kept, compared with nothing and has a
null component; rows that repeat an id are one node; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, anti_clash, forget, mix64, slices, text_bytes, window_hashes, words
from .components import components

_MULT = np.uint64(0x9E3779B97F4A7C15)


def bands_for(num: int, den: int, values: int = 420, miss: float = 1e-4) -> tuple[int, int]:
    """(bands, rows): the longest bands, of at most ``values`` values in all, that miss a pair at the threshold with a probability under ``miss``.

    Long bands keep unlike texts out of a bucket: at 0.85 (35 bands of 9) texts of similarity 0.4 share one in 1 case of 100.
    """
    t = num / den
    for rows in range(16, 0, -1):
        bands = max(1, math.ceil(math.log(miss) / math.log1p(-(t**rows)))) if t < 1 else 1
        if bands * rows <= values:
            return bands, rows
    return values, 1


def shingle_sets(col: pa.Array, size: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, flat, and row offsets into them."""
    data, offsets = text_bytes(col)
    _, _, h, first = words(data, offsets, lower)
    n = np.diff(first)
    long = n >= size
    win = window_hashes(h, size)
    counts = np.where(long, n - size + 1, np.minimum(n, 1))
    out_first = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(n)), counts)
    at = np.arange(out_first[-1]) - out_first[row] + first[row]
    values = np.empty(len(at), np.uint64)
    is_long = long[row]
    values[is_long] = win[at[is_long]]
    for r in np.flatnonzero((n > 0) & ~long).tolist():  # a short text is one shingle of its own length
        acc = np.array([n[r]], np.uint64)
        for w in h[first[r] : first[r + 1]]:
            acc = mix64(acc * _MULT + w)
        values[out_first[r]] = acc[0]
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(n) + 1))


_ORDERS: dict[int, np.ndarray] = {}


def _orders(k: int) -> np.ndarray:
    if k not in _ORDERS:
        rng = np.random.default_rng(20240607)
        _ORDERS[k] = np.stack([rng.permutation(k) for _ in range(k)])
    return _ORDERS[k]


def signatures(values: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """One-permutation signatures [row, bin] of flat sorted sets, densified; rows with empty sets hold zeros."""
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    spread = mix64(values ^ _MULT)
    bins = ((spread >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    key = row * k + bins.astype(np.int64)
    order = np.lexsort((spread, key))
    key, spread = key[order], spread[order]
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    sig, filled = np.zeros(rows * k, np.uint64), np.zeros(rows * k, bool)
    sig[key[lead]], filled[key[lead]] = spread[lead], True
    sig, filled = sig.reshape(rows, k), filled.reshape(rows, k)
    r, b = np.nonzero(~filled & filled.any(axis=1)[:, None])
    out, orders, t = sig.copy(), _orders(k), 0
    while len(r):
        source = orders[b, t]
        hit = filled[r, source]
        out[r[hit], b[hit]] = sig[r[hit], source[hit]]
        r, b, t = r[~hit], b[~hit], t + 1
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    by = sig.reshape(len(sig), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    for c in range(rows):
        acc = mix64(acc * _MULT + by[:, :, c])
    return acc


#: Values of a signature that travel as one byte each, to estimate similarities in tiles.
ESTIMATE = 256


def _sketch(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", 2 << 20, 2000):
            values, first = shingle_sets(batch.column(1), size)
            sig = signatures(values, first, k)
            n = np.diff(first)
            acc1, acc2 = (np.concatenate([[0], np.cumsum(mix64(values ^ np.uint64(s)))]).astype(np.uint64) for s in (11, 77))
            k1, k2 = (mix64(a[first[1:]] - a[first[:-1]] + n.astype(np.uint64)) for a in (acc1, acc2))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * bands, pa.int32()), pa.array(band_keys(sig, bands, rows).view(np.int64).ravel()))
            short = (mix64(sig[:, :ESTIMATE]) >> np.uint64(56)).astype("u1")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), keys, pa.array([s.tobytes() for s in short], pa.binary())], ["doc_id", "n_shingles", "k1", "k2", "keys", "sig"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, keys array<long>, sig binary")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """Replaces ``text``, the last column, by ``shingles``: the sorted set of its shingles' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", 2 << 20):
            values, first = shingle_sets(batch.columns[-1], size)
            at = first.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([values[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary())], [*batch.schema.names[:-1], "shingles"])

    others = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[:-1]]
    return docs.mapInArrow(run, ", ".join([*others, "shingles binary"]))


def _confirm(pairs: DataFrame, docs: DataFrame, size: int, num: int, den: int, cut: Cut, per_task: int = 2000) -> DataFrame:
    """The pairs (a, b) whose full sets are similar.

    Members are dealt over salted shares of their centre ``a``, whose own set is sent once to each
    share; a task streams through sorted shares and holds one centre's set. Sets are made where the texts are and travel once.
    Both sides of the join with the texts grow with the corpus, so it is a merge at every size.
    """
    shares = cut.keep(pairs.groupBy("a").agg(F.ceil(F.count("*") / per_task).cast("int").alias("shares")))
    member = pairs.join(shares, "a").select(F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"), F.lit(1).alias("role"))
    centre = shares.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("shares") - 1).cast("long"))).alias("share"), F.lit(0).alias("role"))
    dealt = cut.keep(member.union(centre))
    rows = _sets(docs.join(dealt.hint("merge"), "doc_id").select("a", "share", "role", "doc_id", "text"), size)
    rows = rows.repartition("a", "share").sortWithinPartitions("a", "share", "role").select("a", "role", "doc_id", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for c, role, d, raw in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                x = np.frombuffer(raw, np.uint64)
                if role == 0:
                    own, now = c, x
                    continue
                if c == own and similar(now, x, num, den):
                    a.append(c)
                    b.append(d)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return cut.keep(rows.mapInArrow(run, "a long, b long").distinct())


def _tiles(rows: DataFrame, tile: int) -> DataFrame:
    """Deals the members of each candidate group over tiles of bounded size, so that members of different components meet in one.

    The members of a group's largest component (D) need no comparison among themselves; the others (X) meet D (kind 0) and each
    other (kind 1).
    """
    sizes = rows.groupBy("grp", "component").agg(F.count("*").alias("n"))
    groups = sizes.groupBy("grp").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.max("n").alias("n_d"), F.sum("n").alias("n_all"))
    groups = groups.select("grp", "main", F.ceil(F.col("n_d") / tile).cast("int").alias("bd"), F.ceil((F.col("n_all") - F.col("n_d")) / tile).cast("int").alias("bx")).where("bx > 0")
    dealt = rows.join(groups, "grp").withColumn("is_d", F.col("component") == F.col("main"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.when(F.col("is_d"), F.col("bd")).otherwise(F.col("bx"))).cast("int"))
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    place = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    of_d = F.transform(numbers("bx"), lambda i: place(0, i, F.col("block")))
    of_x = F.concat(F.transform(numbers("bd"), lambda j: place(0, F.col("block"), j)), F.transform(numbers("bx"), lambda j: place(1, F.least(F.col("block"), j), F.greatest(F.col("block"), j))))
    return dealt.withColumn("tile", F.explode(F.when(F.col("is_d"), of_d).otherwise(of_x))).select("tile.kind", "tile.i", "tile.j", "is_d", "block", *rows.columns)


def _sides(key: tuple, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, components, and the rows on either side of a tile."""
    _, kind, i, j = (x.as_py() for x in key)
    is_d, block = (table[c].to_numpy() for c in ("is_d", "block"))
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "u1").reshape(table.num_rows, -1)
    left = np.flatnonzero(~is_d & (block == i))
    right = np.flatnonzero(is_d if kind == 0 else ~is_d & (block == j))
    return sig, table["component"].to_numpy(), left, right


def _agree_least(k: int, t: float) -> int:
    """Six deviations below the mean agreement of ``k`` values at similarity ``t``."""
    return int(np.floor(k * t - 6 * np.sqrt(k * t * (1 - t))))


def _residual(rows: DataFrame, docs: DataFrame, size: int, num: int, den: int, cut: Cut, tile: int) -> DataFrame:
    """Links between different components of a candidate group, found without listing pairs.

    ``rows``: grp, doc_id, component, sig. First signatures alone travel to the tiles and say which members may have a partner in
    another component at all. Full sets of those go to tiles of their own: signatures pick, full sets decide, and only the first
    link between two components leaves a tile.
    """
    t = num / den

    def screen(key: tuple, table: pa.Table) -> pa.Table:
        sig, comps, left, right = _sides(key, table)
        least, hit, others = _agree_least(sig.shape[1], t), np.zeros(table.num_rows, bool), sig[right]
        for r in left.tolist():
            near = right[(np.count_nonzero(others == sig[r], axis=1) >= least) & (comps[right] != comps[r])]
            if len(near):
                hit[near] = True
                hit[r] = True
        return pa.table({"doc_id": table["doc_id"].filter(pa.array(hit))})

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        sig, comps, left, right = _sides(key, table)
        least, doc, comp, others = _agree_least(sig.shape[1], t), table["doc_id"].to_pylist(), comps.tolist(), sig[right]
        full = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        a, b = [], []
        for r in left.tolist():
            agree = np.count_nonzero(others == sig[r], axis=1)
            near = np.flatnonzero((agree >= least) & (comps[right] != comps[r]))
            for c in right[near[np.argsort(-agree[near], kind="stable")]].tolist():
                one, two = find(comp[r]), find(comp[c])
                if one != two and similar(full[r], full[c], num, den):
                    root[max(one, two)] = min(one, two)
                    a.append(min(doc[r], doc[c]))
                    b.append(max(doc[r], doc[c]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys = ("grp", "kind", "i", "j")
    some = cut.keep(_tiles(rows, tile).groupBy(*keys).applyInArrow(screen, "doc_id long").distinct())
    sets = cut.keep(_sets(docs.join(some.hint("merge"), "doc_id", "left_semi").select("doc_id", "text"), size))
    few = rows.join(sets, "doc_id")
    return _tiles(few, tile).groupBy(*keys).applyInArrow(compare, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether ``den * |x & y| >= num * |x | y|`` for sorted sets of hashes."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or len(x) * den < num * len(y):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return den * both >= num * (len(x) + len(y) - both)


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", size: int = 5, num: int = 80, den: int = 100, tile: int = 1500) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links), kept.

    Documents are linked when ``den * |A & B| >= num * |A | B|`` over their sets of ``size``-word shingles
    (A-Z in lower case).
    """
    cut = Cut(docs.sparkSession)
    own = anti_clash(docs, doc_id=id_col, text=text_col)
    bands, rows = bands_for(num, den)
    sketch = cut.keep(_sketch(own, size, bands, rows))
    some = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    placed = sketch.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2", "n_shingles"], "left")
    placed = cut.keep(placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")))
    reps = placed.where("doc_id = rep and n_shingles > 0").select("doc_id").distinct()
    keyed = cut.keep(some.select("doc_id", "keys").join(reps, "doc_id", "left_semi").select("doc_id", F.explode("keys").alias("key")))
    centres = keyed.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("most")).where("a < most").drop("most")
    near = cut.keep(keyed.join(centres, "key").select("a", F.col("doc_id").alias("b")).where("a <> b").distinct())
    cut.drop(keyed)
    groups = cut.keep(components(near, cut))
    stars = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = _confirm(stars, own, size, num, den, cut)
    cut.drop(near)
    first = components(links, cut)
    labelled = groups.select(F.col("node").alias("doc_id"), F.col("component").alias("grp")).join(first, F.col("doc_id") == F.col("node"), "left")
    labelled = cut.keep(labelled.select("grp", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    mixed = labelled.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("grp")
    left = cut.keep(labelled.join(mixed, "grp", "left_semi").join(some.select("doc_id", "sig"), "doc_id"))
    more = cut.keep(_residual(left, own, size, num, den, cut, tile))
    # A repeated id stands in several classes; it joins them.
    spread = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a < most")
    spread = placed.join(spread, "doc_id").select("a", F.col("rep").alias("b"))
    final = components(links.union(more).union(spread), cut)
    out = placed.join(final, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
