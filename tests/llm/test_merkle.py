"""The Merkle manifest against a plain version in Python, with awkward rows, and paths that prove and refute."""

import hashlib
import zlib

from pyspark.sql import functions as F

from mereweave.llm import merkle, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, node int, held string, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def steps(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = at - at % 16
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        at //= 16
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r[:5])))
        trees[g] = climb([leaf(*r[:5]) for r in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path = steps(trees[g], i) + steps(top, k)
            own = leaf(*r[:5])
            node = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf(*r[:4], r[4] and r[4].translate(LOWER))
            for before, after in path:
                node = h(before, node, after)
            out.append((r[0], own, trees[g][-1][0], top[-1][0], h(*[b + a for b, a in path]), node, node == top[-1][0]))
    return sorted(out, key=repr)


def result(spark, rows, tmp_path, name):
    where = f"{tmp_path}/{name}"
    spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], SCHEMA).repartition(3).write.parquet(f"{where}/documents.parquet")
    return sorted(map(tuple, queries.op12_merkle_manifest(spark, where).collect()), key=repr)


def test_manifest_matches_brute_force(spark, tmp_path):
    rows = [(i, "hot", "en", 3, f"Text {i}") for i in range(700)]  # more than two blocks of 256 leaves
    rows += [(i, f"s{i % 20}", None if i % 3 else "de", None if i % 5 else i, None if i % 7 == 0 else ("É" * i + "ABC")) for i in range(1000, 1090)]
    rows += [(None, "hot", "en", 1, "no id"), (None, None, None, None, None), (5, "hot", "en", 3, "same id"), (7, "hot", "en", 3, "Text 7"), (7, "hot", "en", 3, "Text 7")]
    rows += [(2000, "", "en", 0, ""), (2001, "lone", "en", 200_000, "Long " * 40_000), (2002, None, "en", 1, "X"), (2003, "Ünï", "en", 1, "y"), (2004, "z\U0001f600", "en", 1, "Y")]
    assert result(spark, rows, tmp_path, "a") == brute(rows)


def test_small_and_empty_tables(spark, tmp_path):
    one = [(1, "a", "en", 1, "Q")]
    assert result(spark, one, tmp_path, "one") == brute(one)
    sixteen = [(i, "a", "en", 1, "Q") for i in range(17)] + [(i, "b", "en", 1, "Q") for i in range(20, 36)]
    assert result(spark, sixteen, tmp_path, "few") == brute(sixteen)
    assert result(spark, [], tmp_path, "none") == []


def test_blocks_of_other_shapes_give_the_same_tree(spark):
    df = spark.range(150).select("id", F.lit("g").alias("g"), F.concat(F.lit("v"), "id").alias("v"))
    want = None
    for depth in (1, 2, 3):
        rows = merkle.manifest(df, "g", ["id"], ["id", "v"], carry={"id": F.col("id")}, fan_out=4, depth=depth)
        got = sorted(map(tuple, rows.select("id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).collect()))
        assert all(r[-1] for r in got)
        want = want or got
        assert got == want
