"""Clustering with bounds against a plain version in Python integers."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from mereweave.llm import centroids, queries


def brute(rows, clusters=40, rounds=5, dims=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and abs(x) < 2**19 for x in v):
            kept.append((i, [int(np.floor(256 * float(x))) for x in v]))
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, x in kept[:clusters]]
    dist = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    own = []
    for r in range(rounds + 1):
        own = [min(range(len(c)), key=lambda j: (dist(x, c[j]), j)) for _, x in kept]
        if r < rounds:
            groups = [[x for (_, x), o in zip(kept, own, strict=True) if o == j] for j in range(len(c))]
            c = [[sum(col) // len(g) for col in zip(*g, strict=True)] if g else c[j] for j, g in enumerate(groups)]
    d = [dist(x, c[o]) for (_, x), o in zip(kept, own, strict=True)]
    per = {j: sum(v for v, o in zip(d, own, strict=True) if o == j) for j in set(own)}
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted([(i, o, v, per[o], sum(d), sha[o]) for (i, _), o, v in zip(kept, own, d, strict=True)], key=repr)


def awkward(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((9, 64))
    rows = [(i, (base[i % 9] + 0.3 * rng.standard_normal(64)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 64), (n + 3, [1.0] * 63), (n + 4, [1.0, None] * 32), (n + 5, [float("nan")] + [1.0] * 63), (n + 6, [float("-inf")] + [1.0] * 63)]
    rows += [(n + 7, [1e30] * 64), (n + 8, [-0.0] * 64), (n + 9, [-0.001] * 64), (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1])] + [(n + 20 + i, rows[0][1]) for i in range(30)]
    return rows


def test_clusters_match_brute_force(spark, tmp_path):
    rows = awkward(1, 260)
    schema = "vec_id long, embedding array<float>, label int, cluster string, x int, distance string"
    spark.createDataFrame([(i, v, 0, "clash", 1, "clash") for i, v in rows], schema).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, queries.op13_centroid_clustering(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(rows)


def test_few_equal_large_and_no_vectors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert centroids.cluster(frame([])).collect() == []
    rows = [(f"v{i}", [float(i % 3)] * 64) for i in range(12)]
    assert sorted(map(tuple, centroids.cluster(frame(rows)).collect()), key=repr) == brute(rows)
    rng = np.random.default_rng(3)
    rows = [(f"v{i}", (rng.standard_normal(64) * 100_000).tolist()) for i in range(90)]  # beyond what floating-point products hold exactly
    assert sorted(map(tuple, centroids.cluster(frame(rows), clusters=7).collect()), key=repr) == brute(rows, clusters=7)


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(8)
    base = rng.integers(-400, 400, (30, 16))
    x = base[rng.integers(0, 30, 3000)] + rng.integers(-60, 60, (3000, 16))
    c = x[:30].copy()
    b = centroids.Bounds(x, *centroids._scan(x, c, 5))
    for _ in range(12):
        new = np.array([x[b.cluster == j].sum(axis=0) // max(1, (b.cluster == j).sum()) if (b.cluster == j).any() else c[j] for j in range(30)])
        drift, c = centroids._up(((new - c) ** 2).sum(axis=1)), new
        b.move(c, drift)
        d = np.sqrt(centroids.squared(x, c).astype(float))
        assert (b.cluster == centroids.squared(x, c).argmin(axis=1)).all()
        assert (b.upper >= d[np.arange(len(x)), b.cluster]).all()
        assert (b.lower <= np.take_along_axis(d, b.ids.astype(int), axis=1) + 1e-9).all()
        others = np.ones(d.shape, bool)
        others[np.arange(len(x)), b.cluster] = False
        np.put_along_axis(others, b.ids.astype(int), False, axis=1)
        assert (b.rest[:, None] <= np.where(others, d, np.inf) + 1e-9).all()
    assert b.kept > b.scanned and b.listed > 0


def test_integers_are_floors(spark):
    df = spark.createDataFrame([(1, [-0.001, 0.0, 1.5, -1.0])], "vec_id long, embedding array<double>")
    assert centroids.integers(df, dims=4).select(F.col("x")).first()[0] == [-1, 0, 384, -256]
