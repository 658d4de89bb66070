"""Trees and spanning trees over edge tables; a table ends each round's lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.cut import cut


def tree_paths(edges: DataFrame, roots: DataFrame, between: str = "/") -> DataFrame:
    """node, depth, path of what hangs below roots (node) over edges (src, dst), a tree; a node met again is not entered twice."""
    front, depth = cut(roots.select("node", F.lit(0).alias("depth"), F.col("node").alias("path"))), 0
    seen = front
    while not front.isEmpty():
        depth += 1
        below = front.join(edges, F.col("node") == F.col("src")).groupBy("dst").agg(F.min(F.concat("path", F.lit(between), "dst")).alias("path"))
        front = cut(below.select(F.col("dst").alias("node"), F.lit(depth).alias("depth"), "path").join(seen, "node", "left_anti"))
        seen = seen.unionAll(front)
    return seen


def shallowest_parents(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """node, parent, depth of a spanning tree: the least of the parents that are nearest to a root; roots have none."""
    front, depth = cut(roots.select("node", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth"))), 0
    seen = front
    while not front.isEmpty():
        depth += 1
        below = front.select(F.col("node").alias("src")).join(edges, "src").groupBy("dst").agg(F.min("src").alias("parent"))
        front = cut(below.select(F.col("dst").alias("node"), "parent", F.lit(depth).alias("depth")).join(seen, "node", "left_anti"))
        seen = seen.unionAll(front)
    return seen


def forest(nodes: DataFrame, no_parent: int) -> DataFrame:
    """id, parent (null for roots), children of nodes (id, parent): a parent that is no_parent or missing makes a root."""
    ids = nodes.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    linked = nodes.join(ids, "parent", "left").select("id", F.when(F.col("known") & (F.col("parent") != no_parent), F.col("parent")).alias("parent"))
    count = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("children"))
    return linked.join(count, "id", "left").select("id", "parent", F.coalesce("children", F.lit(0)).alias("children"))
