"""Centroid clustering with Drake's adaptive bounds, exact in integers.

Vectors become integers once and stay in a table of the shared folder, with their state: the assigned centroid, an upper bound of the
distance to it, the ``near`` next centroids with a lower bound each, and one remainder bound for all others. Each round is one pass
without a shuffle:

1. Bounds follow the centroids' drifts. Where the upper bound is below every lower bound, the vector stays and no distance is computed.
2. Else the distance to its centroid is computed; if that is below every lower bound, it stays.
3. Else the distances to the listed centroids are computed; if the least is below the remainder bound, the order is certified.
4. Else the vector is scanned against all centroids.

Sums per centroid change only by the vectors that moved: tasks add them up, one row a task and centroid is shuffled, and the driver holds
``clusters`` centroids and sums, whatever the table's size. Squared distances are exact integers: by floating-point products where they
all stay below 2**53, else in 64-bit integers. Bounds are rounded outwards and compared strictly, so ties are always decided by exact
distances, the smaller number first.

Nulls and edges: vectors that are null, not of ``dims`` components, with a null or non-finite component, or with a component beyond 2**19
(its squares would not fit ``distance``) give no row; a null id has the hash of an empty id; rows that repeat an id are separate vectors,
tied first ones in the order of their components; fewer vectors than ``clusters`` give as many centroids; an empty table gives no rows;
other columns go nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, anti_clash

_STATE = "vec_id {kind}, x array<int>, cluster int, old int, upper double, ids array<int>, lower array<double>, rest double"
_OUT, _IN = 1 + 1e-12, 1 - 1e-12
_BEYOND = 1 << 19


def _up(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * _OUT


def _down(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * _IN


def _exact_in_floats(x: np.ndarray, c: np.ndarray) -> bool:
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    return 4 * x.shape[1] * float(most) ** 2 < 2.0**53


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances [vector, centroid] of integer rows."""
    if _exact_in_floats(x, c):
        fx, fc = x.astype(np.float64), c.astype(np.float64)
        d = (fx * fx).sum(axis=1)[:, None] - 2 * (fx @ fc.T) + (fc * fc).sum(axis=1)[None, :]
        return d.astype(np.int64)
    out = np.empty((len(x), len(c)), np.int64)
    for j, one in enumerate(c):
        gap = x - one
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def squared_listed(x: np.ndarray, c: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to its listed centroids."""
    out = np.empty(ids.shape, np.int64)
    for j in range(ids.shape[1]):
        gap = x - c[ids[:, j]]
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def _scan(x: np.ndarray, c: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """cluster, upper, ids, lower and rest by a scan of all centroids."""
    d2 = squared(x, c)
    order = np.argsort(d2, axis=1, kind="stable")  # ties: smaller numbers first
    dist = np.take_along_axis(d2, order, axis=1)
    rest = _down(dist[:, near + 1]) if dist.shape[1] > near + 1 else np.full(len(x), np.inf)
    return order[:, 0].astype(np.int32), _up(dist[:, 0]), order[:, 1 : near + 1].astype(np.int32), _down(dist[:, 1 : near + 1]), rest


class Bounds:
    """The state of a block of vectors; ``move`` brings it to new centroids and counts what had to be computed."""

    def __init__(self, x, cluster, upper, ids, lower, rest):
        self.x, self.cluster, self.upper, self.ids, self.lower, self.rest = x, cluster, upper, ids, lower, rest
        self.kept = self.tightened = self.listed = self.scanned = 0

    def move(self, c: np.ndarray, drift: np.ndarray) -> None:
        self.upper = (self.upper + drift[self.cluster]) * _OUT
        self.lower = (self.lower - drift[self.ids] * _OUT) * _IN
        self.rest = (self.rest - drift.max() * _OUT) * _IN
        # a negative bound times _IN would move up, and says nothing either way
        self.lower, self.rest = np.maximum(self.lower, 0.0), np.maximum(self.rest, 0.0)
        bound = np.minimum(self.lower.min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(self.upper >= bound)
        self.kept += len(self.x) - len(open_)
        own = squared_listed(self.x[open_], c, self.cluster[open_, None])[:, 0]
        self.upper[open_] = _up(own)
        still = self.upper[open_] >= bound[open_]
        self.tightened += int((~still).sum())
        rows, own = open_[still], own[still]
        if not len(rows):
            return
        ids = np.concatenate([self.cluster[rows, None], self.ids[rows]], axis=1)
        d2 = np.concatenate([own[:, None], squared_listed(self.x[rows], c, ids[:, 1:])], axis=1)
        order = np.lexsort((ids, d2), axis=1)
        ids, d2 = np.take_along_axis(ids, order, axis=1), np.take_along_axis(d2, order, axis=1)
        sure = _up(d2[:, 0]) < self.rest[rows]
        self.listed += int(sure.sum())
        at = rows[sure]
        self.cluster[at], self.upper[at], self.ids[at], self.lower[at] = ids[sure, 0], _up(d2[sure, 0]), ids[sure, 1:], _down(d2[sure, 1:])
        far = rows[~sure]
        self.scanned += len(far)
        if len(far):
            self.cluster[far], self.upper[far], self.ids[far], self.lower[far], self.rest[far] = _scan(self.x[far], c, self.ids.shape[1])


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), kind))


def _assigned(state: DataFrame, c: np.ndarray, drift: np.ndarray | None, near: int, kind: str) -> DataFrame:
    """The state after an assignment to the centroids ``c``; without drifts (first round) every vector is scanned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4000):
                batch = whole.slice(lo, 4000)
                n = batch.num_rows
                x = _matrix(batch.column(1), n).astype(np.int64)
                if drift is None:
                    b = Bounds(x, *_scan(x, c, near))
                    old = np.full(n, -1, np.int32)
                else:
                    old = batch.column(2).to_numpy()
                    b = Bounds(x, old.copy(), batch.column(4).to_numpy().copy(), _matrix(batch.column(5), n).copy(), _matrix(batch.column(6), n).copy(), batch.column(7).to_numpy().copy())
                    b.move(c, drift)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(b.cluster, pa.int32()), pa.array(old, pa.int32()), pa.array(b.upper), _lists(b.ids, pa.int32()), _lists(b.lower, pa.float64()), pa.array(b.rest)],
                    ["vec_id", "x", "cluster", "old", "upper", "ids", "lower", "rest"],
                )

    return state.mapInArrow(run, _STATE.format(kind=kind))


def _moved(state: DataFrame, clusters: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """How sums and counts of each centroid change by the vectors that moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, dims + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = np.concatenate([_matrix(batch.column(0), batch.num_rows).astype(np.int64), np.ones((batch.num_rows, 1), np.int64)], axis=1)
                new, old = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                np.add.at(total, new, x)
                some = old >= 0
                np.subtract.at(total, old[some], x[some])
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), _lists(total[at], pa.int64())], ["cluster", "s"])

    parts = state.where("cluster <> old").select("x", "cluster", "old").mapInArrow(run, "cluster int, s array<long>")
    rows = parts.groupBy("cluster").agg(*[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(dims + 1)]).collect()  # ``clusters`` rows at most
    out = np.zeros((clusters, dims + 1), np.int64)
    for r in rows:
        out[r[0]] = r[1:]
    return out[:, :dims], out[:, dims]


def integers(table: DataFrame, id_col="vec_id", vector_col="embedding", dims: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, x): usable vectors as integers ``floor(scale * component)``."""
    own = anti_clash(table, vec_id=id_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<double>"))
    # of NaN and infinity neither is below the limit: Spark orders NaN above all numbers
    fits = F.forall("vector", lambda v: F.coalesce(F.abs(v) < F.lit(float(_BEYOND)), F.lit(False)))
    x = F.when((F.size("vector") == dims) & fits, F.transform("vector", lambda v: F.floor(F.lit(scale) * v).cast("int")))
    return own.select("vec_id", x.alias("x")).where("x is not null")


def cluster(table: DataFrame, id_col="vec_id", vector_col="embedding", dims: int = 64, clusters: int = 40, rounds: int = 5, scale: int = 256, seed: str = "2", near: int = 7) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, for every usable vector."""
    spark = table.sparkSession
    cut = Cut(spark)
    kind = table.schema[id_col].dataType.simpleString()
    vectors = cut.keep(integers(table, id_col, vector_col, dims, scale))
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.orderBy(chosen, "x").limit(clusters).select("x").collect()
    c = np.array([r["x"] for r in first], np.int64).reshape(len(first), dims)
    if not len(c):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    near = min(near, len(c) - 1)
    sums, counts, drift, state = np.zeros_like(c), np.zeros(len(c), np.int64), None, vectors
    for r in range(rounds + 1):
        after = cut.keep(_assigned(state, c, drift, near, kind))
        cut.drop(state)
        state = after
        if r == rounds:
            break
        more, n = _moved(state, len(c), dims)
        sums, counts = sums + more, counts + n
        new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], c)
        drift, c = _up(((new - c) ** 2).sum(axis=1)), new
    parts = state.select("vec_id", "x", "cluster").mapInArrow(_distances(c), f"vec_id {kind}, cluster int, distance long")
    done = cut.keep(parts)
    cut.drop(state)
    inertia = {r[0]: int(r[1]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # ``clusters`` rows at most
    total = sum(inertia.values())
    per = [(j, v, total, hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest()) for j, v in inertia.items()]
    found = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(found), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _distances(c: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, own = _matrix(batch.column(1), batch.num_rows).astype(np.int64), batch.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(squared_listed(x, c, own[:, None])[:, 0])], ["vec_id", "cluster", "distance"])

    return run
