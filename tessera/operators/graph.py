"""Iterative graph operators over edge tables; a table ends each round's lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.cut import cut


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """node, depth: what can be reached from roots (node) over edges (src, dst), with the least number of steps."""
    seen = cut(roots.select("node").distinct().withColumn("depth", F.lit(0)))
    front, depth = seen, 0
    while not front.isEmpty():
        depth += 1
        nxt = front.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        front = cut(nxt.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        seen = seen.unionAll(front)
    return seen


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node connected to it) of all nodes of edges (src, dst), which count both ways.

    Alternating rounds link each node's larger neighbours, then the smaller ones, to its least one: rounds follow the logarithm
    of the longest way.
    """
    e = cut(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def propagate_labels(nodes: DataFrame, edges: DataFrame, conflict: str = "least") -> DataFrame:
    """node, label: the least label of what is connected to it. nodes: node, label or null; edges (src, dst) count both ways.

    conflict: least, or error, which stops where connected nodes have different labels.
    """
    own = nodes.join(components(edges), "node", "left").select("node", "label", F.coalesce("root", "node").alias("root"))
    told = own.groupBy("root").agg(F.min("label").alias("label"), F.max("label").alias("_other"))
    if conflict == "error":
        wrong = F.raise_error(F.concat(F.lit("connected nodes are "), F.col("label").cast("string"), F.lit(" and "), F.col("_other").cast("string")))
        told = told.withColumn("label", F.when(F.col("label") == F.col("_other"), F.col("label")).when(F.col("label").isNotNull(), wrong.cast(nodes.schema["label"].dataType)))
    return own.select("node", "root").join(told.select("root", "label"), "root").select("node", "label")


def dependency_hash(nodes: DataFrame, edges: DataFrame, levels: int = 64) -> DataFrame:
    """node, hash: crc32 over the node's own hash and those of its dependencies in the order of their names, from the leaves up.

    edges: src depends on dst, without cycles (a cycle stops the query). Each round settles the nodes whose dependencies all are.
    """
    need = edges.groupBy("src").agg(F.count("*").alias("n"))
    own = nodes.select("node", F.col("hash").alias("own"))
    done = cut(own.join(need, own.node == need.src, "left_anti").select("node", F.crc32(F.col("own").cast("string").cast("binary")).alias("hash")))
    total = own.count()
    for _ in range(levels):
        if done.count() == total:
            return done
        parts = edges.join(done, F.col("dst") == F.col("node")).groupBy("src").agg(F.count("*").alias("have"), F.array_sort(F.collect_list(F.struct("dst", "hash"))).alias("deps"))
        ready = parts.join(need, "src").where("have = n").join(done.select(F.col("node").alias("src")), "src", "left_anti").join(own, F.col("src") == F.col("node"))
        text = F.concat_ws(";", F.col("own").cast("string"), F.array_join(F.transform("deps", lambda d: F.concat_ws(":", d["dst"].cast("string"), d["hash"].cast("string"))), ";"))
        done = cut(done.unionAll(ready.select("node", F.crc32(text.cast("binary")).alias("hash"))))
    raise ValueError("the dependencies have a cycle, or are deeper than levels")


def teleport_edges(doors: DataFrame, areas: DataFrame) -> DataFrame:
    """kind, sx, sy, dx, dy both ways. doors: ax, ay, bx, by, where a null stops the query; areas: kind and bounds of origin and destination, joined at their centres, rows with a null bound left out."""
    from tessera.functions.masks import centre

    bounds = [f"{a}_{b}_{c}" for a in ("orig", "dest") for b in ("min", "max") for c in ("x", "y")]
    mid = lambda a, c: centre(F.col(f"{a}_min_{c}"), F.col(f"{a}_max_{c}"))
    e = areas.na.drop(subset=bounds).select("kind", mid("orig", "x").alias("sx"), mid("orig", "y").alias("sy"), mid("dest", "x").alias("dx"), mid("dest", "y").alias("dy"))
    there = lambda c: F.coalesce(c, F.raise_error(F.lit(f"a door without {c}")).cast("int")).alias(c)
    e = e.unionAll(doors.select(F.lit("door"), *map(there, ("ax", "ay", "bx", "by"))))
    return e.unionAll(e.select("kind", F.col("dx"), F.col("dy"), F.col("sx"), F.col("sy")))
