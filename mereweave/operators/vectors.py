"""Exact nearest vectors, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of one block; two blocks meet as one matrix product.
_QUERIES, _ROWS = 512, 4096
#: More than double arithmetic can err by; what lies this close to the last place is compared by exact sums.
_SLACK = 1e-9


def _blocks(df: DataFrame, id_col: str, vector: str, size: int, names: tuple[str, str]) -> DataFrame:
    """Rows packed to ``size`` a block, never across partitions: ids and lists of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([ids[:size]], pa.list_(pa.int64())), pa.array([vectors[:size]], pa.list_(pa.list_(pa.float64())))], list(names))

        for batch in batches:
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            while len(ids) >= size:
                yield block()
                del ids[:size], vectors[:size]
        if ids:
            yield block()

    return df.select(F.col(id_col).cast("long"), F.col(vector).cast("array<double>")).mapInArrow(run, f"{names[0]} array<long>, {names[1]} array<array<double>>")


def _unit(vectors: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, filled up with zeros to ``width``, and their lengths; a null or zero one becomes NaN."""
    m, lengths = np.zeros((len(vectors), width)), np.zeros(len(vectors), np.int64)
    for i, x in enumerate(vectors):
        if x is not None:
            m[i, : len(x)], lengths[i] = x, len(x)
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / np.sqrt((m * m).sum(axis=1, keepdims=True)), lengths


def nearest(queries: DataFrame, rows: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """(query_id, vec_id, s): the ``k`` rows of largest cosine for each query but itself; ties by id, undefined cosines (also of
    vectors of different lengths) last.

    Blocks of queries meet blocks of rows; each meeting keeps its own ``k`` a query, partitions prune before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qi, qv, ri, rv in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                width = max((len(x) for x in (*qv, *rv) if x is not None), default=1)
                qi, ri, (q, q_len), (r, r_len) = np.array(qi), np.array(ri), _unit(qv, width), _unit(rv, width)
                with np.errstate(invalid="ignore"):
                    s = q @ r.T
                s = np.where(np.isnan(s) | (q_len[:, None] != r_len[None, :]), -2.0, s)
                s[qi[:, None] == ri[None, :]] = -3.0
                n = min(k, len(ri))
                least = np.partition(s, len(ri) - n, axis=1)[:, len(ri) - n]
                out_q, out_r, out_s = [], [], []
                for i in range(len(qi)):
                    near = np.flatnonzero((s[i] >= least[i] - _SLACK) & (s[i] > -3.0))
                    exact = np.where(s[i, near] > -2.0, (r[near] * q[i]).sum(axis=1), -2.0)
                    best = np.lexsort((ri[near], -exact))[:k]
                    out_q += [int(qi[i])] * len(best)
                    out_r += ri[near[best]].tolist()
                    out_s += [None if x == -2.0 else x for x in exact[best].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_r, pa.int64()), pa.array(out_s, pa.float64())], ["query_id", "vec_id", "s"])

    pairs = _blocks(queries, id_col, vector, _QUERIES, ("qi", "qv")).crossJoin(_blocks(rows, id_col, vector, _ROWS, ("ri", "rv")))
    found = pairs.mapInArrow(run, "query_id long, vec_id long, s double")
    n = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s"), "vec_id"))
    return found.withColumn("n", n).where(F.col("n") <= k).select("query_id", "vec_id", "s")
