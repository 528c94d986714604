"""Typed hierarchies (J1-J8): closure, cycles, reachability, chains, levels, mirrored edges.

An edge table has child, parent, relation. Leaves (settlements) are many, the divisions above them few and shallow,
so every walk first follows only the edges between divisions, whose number does not grow with the leaves, and then
joins the leaves once. Each step is an equi join; the number of steps is the depth, checked against `max_depth`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.operators.lineage import cut

MAX_DEPTH = 32


def inner_edges(edges: DataFrame) -> DataFrame:
    """The edges whose child is a parent itself."""
    return edges.join(edges.select(F.col("parent").alias("p")).distinct(), F.col("child") == F.col("p"), "left_semi").select("child", "parent").distinct()


def ancestors(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, ancestor, distance) over the inner edges, the shortest distance, cycles walked once."""
    inner = cut(inner_edges(edges))
    reached = inner.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    frontier = reached
    for k in range(2, max_depth + 1):
        step = frontier.join(inner, frontier.ancestor == inner.child).select("node", F.col("parent").alias("ancestor"), F.lit(k).alias("distance")).distinct()
        frontier = cut(step.join(reached.select(F.col("node").alias("n"), F.col("ancestor").alias("a")), (F.col("node") == F.col("n")) & (F.col("ancestor") == F.col("a")), "left_anti"))
        if frontier.isEmpty():
            break
        reached = reached.unionAll(frontier)
    return reached


def descendants(edges: DataFrame, root: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node) of everything below `root`, leaves included."""
    inner = cut(inner_edges(edges))
    below = edges.sparkSession.createDataFrame([(root,)], "node string")
    frontier = below
    for _ in range(max_depth):
        step = inner.join(frontier, inner.parent == frontier.node).select(F.col("child").alias("node")).distinct()
        frontier = cut(step.join(below.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left_anti"))
        if frontier.isEmpty():
            break
        below = below.unionAll(frontier)
    return edges.join(below.withColumnRenamed("node", "n"), F.col("parent") == F.col("n"), "left_semi").select(F.col("child").alias("node")).distinct()


def cycles(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node) of the nodes that are their own ancestors."""
    return ancestors(edges, max_depth).where("node = ancestor").select("node").distinct()


def unreachable(nodes: DataFrame, edges: DataFrame, root: str) -> DataFrame:
    """(node) of those that no chain of edges leads to `root`."""
    return nodes.where(F.col("node") != root).join(descendants(edges, root).withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left_anti")


def first_parents(edges: DataFrame) -> DataFrame:
    """(child, parent): the smallest parent of each child (trap T7)."""
    return edges.groupBy("child").agg(F.min("parent").alias("parent"))


def chains(nodes: DataFrame, edges: DataFrame, root: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, chain): one chain per parent, going on by first parents; the root only as a first parent."""
    up = first_parents(edges)
    out = nodes.join(edges, nodes.node == edges.child).select("node", F.array("parent").alias("chain"), F.col("parent").alias("last"))
    up = up.join(edges.select(F.col("parent").alias("x")).distinct(), F.col("child") == F.col("x"), "left_semi").where(F.col("parent") != root)
    up = cut(up.select(F.col("child").alias("c"), F.col("parent").alias("next")))
    walk, depth = up, 0
    while depth < max_depth and not walk.isEmpty():
        walk = cut(walk.join(up.select(F.col("c").alias("c2"), F.col("next").alias("n2")), F.col("next") == F.col("c2")).select("c", F.col("n2").alias("next")))
        depth += 1
    for _ in range(depth):
        out = out.join(up, F.col("last") == F.col("c"), "left").select(
            "node",
            F.when(F.col("next").isNotNull() & ~F.array_contains("chain", F.col("next")), F.concat("chain", F.array("next"))).otherwise(F.col("chain")).alias("chain"),
            F.when(~F.array_contains("chain", F.col("next")), F.col("next")).alias("last"),
        )
    return out.select("node", "chain")


def levels(edges: DataFrame, root: str, kind_level: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, level) of the divisions: one below the first parent, and at least the kind's level; the root is 0."""
    up = cut(first_parents(inner_edges(edges)))
    known = edges.sparkSession.createDataFrame([(root, 0)], "node string, level int")
    floor = kind_level.select(F.col("node").alias("k"), F.col("level").alias("least")) if kind_level is not None else None
    frontier = known
    for _ in range(max_depth):
        step = up.join(frontier, up.parent == frontier.node).select(F.col("child").alias("node"), (F.col("level") + 1).alias("level"))
        if floor is not None:
            step = step.join(floor, F.col("node") == F.col("k"), "left").select("node", F.greatest("level", F.coalesce("least", F.lit(0))).alias("level"))
        frontier = cut(step)
        if frontier.isEmpty():
            break
        known = known.unionAll(frontier)
    return known


def top_divisions(edges: DataFrame, root: str) -> DataFrame:
    """(node, top): the division right under the root that each node lies in."""
    tops = edges.where(F.col("parent") == root).select(F.col("child").alias("top"))
    up = ancestors(edges)
    inside = up.join(tops, F.col("ancestor") == F.col("top"), "left_semi").select("node", F.col("ancestor").alias("top"))
    inside = inside.unionAll(tops.select(F.col("top").alias("node"), "top")).distinct()
    leaves = edges.join(inside.withColumnRenamed("node", "n"), F.col("parent") == F.col("n")).select(F.col("child").alias("node"), "top")
    return inside.unionAll(leaves).distinct()


def mirror_shared(edges: DataFrame, pairs: DataFrame, relation: str) -> DataFrame:
    """New (child, parent) edges: the children of a division also under its counterpart, unless another division of
    the counterpart's relation has them (J7). pairs: (division, counterpart)."""
    other = edges.where(F.col("relation") == relation).select(F.col("child").alias("c")).distinct()
    own = edges.where(F.col("relation") != relation)
    found = own.join(pairs, own.parent == pairs.division).select("child", F.col("counterpart").alias("parent"))
    return found.join(other, F.col("child") == F.col("c"), "left_anti").distinct()


def manual_edges(edges: DataFrame, manual: DataFrame) -> DataFrame:
    """The edges and the manual ones that they don't have yet."""
    keys = ["child", "parent", "relation"]
    return edges.select(keys).unionAll(manual.select(keys).join(edges.select(keys), keys, "left_anti").distinct())
