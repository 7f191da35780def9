"""Merkle dataset manifest, by higher-order SQL functions on blocks of leaves.

1. Every row becomes a leaf: SHA-256 over its fields, each with its length. Only leaves and carried columns go on.
2. Leaves are sorted over ranges of (group, order columns, leaf); a leaf's place in its group is its place in the range plus the
   group's rows in earlier ranges, so no group is ever sorted or counted by one task.
3. ``fan_out ** depth`` consecutive leaves form a block: one ordered array, which ``sequence``, ``transform``, ``slice`` and
   ``aggregate`` collapse level by level. Block roots are the next round's leaves, until every group has one node; the groups'
   roots then form a tree of their own in the same way.
4. Paths come down the same rounds: a block's path to the root joins the block once, and each leaf puts its siblings within the
   block before it. All joins are on (group, block), so that a group that holds most rows is no hot key.

Everything is a column function; no Python runs in a task. What is held at once is a block (256 leaves by default).

Nulls and edges: a null field is the mark ``-`` and an empty text ``0:``; a null group is a group and comes first, a null in the order
columns comes first; rows that tie there go by leaf, and rows that are equal altogether take neighbouring places, which of them is of
no matter, since their leaves and therefore all outputs are equal as a set; an empty table gives no rows; columns that are not named go
nowhere, so their names may clash with any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Cut

_EMPTY_PATH = "cast(array() as array<struct<before: string, after: string>>)"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*[p.cast("string") for p in parts]).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field of a leaf: ``-`` for null, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along ``path``."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf's level to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def _places(nodes: DataFrame, order: list[str], cut: Cut) -> DataFrame:
    """Adds ``pos`` (from 0, within ``grp``) and ``n`` (the group's nodes)."""
    keys = ["grp", *order]
    dealt = cut.keep(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("part", F.shiftrightunsigned("at", 33))
    counted = dealt.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("m"))  # groups + ranges rows at most
    of_group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("m").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.select("grp", "part", (before - F.col("first")).alias("shift"), F.sum("m").over(of_group).alias("n"))
    return dealt.join(counted, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _levels(n: Column, fan_out: int, depth: int) -> Column:
    """How many levels a block of a group of ``n`` nodes collapses: all ``depth``, or what leaves one node."""
    out = F.lit(depth)
    for k in reversed(range(depth)):
        out = F.when(n <= fan_out**k, k).otherwise(out)
    return out


def _collapse(nodes: Column, levels: Column, fan_out: int, depth: int) -> Column:
    """The nodes of a block's levels, from its leaves to its root."""

    def up(below: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(below) / fan_out).cast("int") - 1)
        return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(below, r * fan_out + 1, fan_out), "").cast("binary"), 256))

    steps = F.slice(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), levels)
    return F.aggregate(steps, F.array(nodes), lambda done, _: F.concat(done, F.array(up(F.element_at(done, -1)))))


class Tree:
    """The rounds of blocks over (grp, pos, n, node, more): up to one node a group, and down again with paths."""

    def __init__(self, nodes: DataFrame, cut: Cut, fan_out: int, depth: int):
        self.cut, self.fan_out, self.depth, self.wide = cut, fan_out, depth, fan_out**depth
        self.rounds: list[DataFrame] = []
        self.roots: list[DataFrame] = []
        while True:
            more = F.struct(*[c for c in nodes.columns if c not in ("grp", "n")])
            blocks = nodes.groupBy("grp", F.floor(F.col("pos") / self.wide).alias("block")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(more)).alias("held"))
            self.rounds.append(cut.keep(blocks))
            root = F.element_at(F.element_at(self._collapsed(), -1), 1)
            roots = cut.keep(self.rounds[-1].select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / self.wide).alias("n"), root.alias("node")))
            self.roots.append(roots)
            nodes = roots.where("n > 1").select("pos", "node", "grp", "n")
            if nodes.isEmpty():
                break

    def _collapsed(self) -> Column:
        return _collapse(F.transform("held", lambda x: x["node"]), _levels(F.col("n"), self.fan_out, self.depth), self.fan_out, self.depth)

    def tops(self) -> DataFrame:
        """(grp, node): the root of every group."""
        out = self.roots[0]
        for r in self.roots[1:]:
            out = out.union(r)
        return out.where("n = 1").select("grp", "node")

    def _siblings(self, pos: Column, levels: Column) -> Column:
        at = (pos % self.wide).cast("int")
        nodes = F.col("levels")
        out = []
        for k in range(self.depth):
            mine = F.floor(at / self.fan_out**k).cast("int")
            inside = mine % self.fan_out
            before = F.array_join(F.slice(nodes[k], mine - inside + 1, inside), "")
            after = F.array_join(F.slice(nodes[k], mine + 2, self.fan_out - 1 - inside), "")
            out.append(F.struct(before.alias("before"), after.alias("after")))
        return F.filter(F.array(*[F.when(levels > k, s) for k, s in enumerate(out)]), lambda s: s.isNotNull())

    def paths(self, tops: DataFrame) -> DataFrame:
        """A row for each node of the first round, with its columns, its ``path`` and what ``tops`` (grp, path, others) has of its group."""
        others = [c for c in tops.columns if c not in ("grp", "path")]
        above: DataFrame | None = None
        for k in reversed(range(len(self.rounds))):
            ended = self.roots[k].where("n = 1").select("grp", F.col("pos").alias("block")).join(tops, "grp")
            up = ended if above is None else ended.unionByName(above.withColumnRenamed("pos", "block"))
            blocks = self.rounds[k].withColumn("levels", self._collapsed()).join(up, ["grp", "block"])
            above = blocks.select("grp", *others, F.explode(self._with_path(k)).alias("one")).select("grp", "one.*", *others)
            if k:
                above = self.cut.keep(above.drop("node"))
        return above

    def _with_path(self, k: int) -> Column:
        names, levels = self.rounds[k].schema["held"].dataType.elementType.fieldNames(), _levels(F.col("n"), self.fan_out, self.depth)
        return F.transform("held", lambda x: F.struct(*[x[c].alias(c) for c in names], F.concat(self._siblings(x["pos"], levels), F.col("path")).alias("path")))


def manifest(rows: DataFrame, group: str, order: list[str], fields: list[str], carry: dict[str, Column] | None = None, fan_out: int = 16, depth: int = 2) -> DataFrame:
    """A row for each row of ``rows``: ``leaf``, ``subroot`` (its group's), ``root``, ``path`` and the columns of ``carry``.

    ``path`` is an array of (before, after): the hex digests of a run's other nodes left and right of the own one, level by level.
    """
    cut = Cut(rows.sparkSession)
    name = lambda c: F.col(f"`{c}`")
    grp = F.coalesce(F.concat(F.lit("1"), name(group).cast("string")), F.lit("0"))
    keys = [name(c).alias(f"o{k}") for k, c in enumerate(order)]
    carried = F.struct(*[v.alias(k) for k, v in (carry or {"leaf": F.lit(None)}).items()]).alias("carried")
    leaves = cut.keep(rows.select(grp.alias("grp"), *keys, leaf(*[name(c) for c in fields]).alias("node"), carried, F.monotonically_increasing_id().alias("salt")))
    placed = _places(leaves, [f"o{k}" for k in range(len(order))] + ["node", "salt"], cut).select("pos", "node", "carried", "grp", "n")
    tree = Tree(placed, cut, fan_out, depth)
    groups = cut.keep(tree.tops().select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node"))
    above = Tree(_places(groups, ["name"], cut).select("pos", "node", "name", "grp", "n"), cut, fan_out, depth)
    whole = above.tops().select("grp", F.col("node").alias("root"), F.expr(_EMPTY_PATH).alias("path"))
    of_group = cut.keep(above.paths(whole).select(F.col("name").alias("grp"), F.col("node").alias("subroot"), "root", "path"))
    out = tree.paths(of_group)
    named = [F.col("carried")[k].alias(k) for k in carry or {}]
    return out.select(*named, F.col("node").alias("leaf"), "subroot", "root", "path")
