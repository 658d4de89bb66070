"""Rectangles and points. Joins go over square bins, so neither side is broadcast and no pair outside a shared bin is made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.masks import DIRECTIONS


def _bin(v: Column, size: int) -> Column:
    return F.floor(v / size)


def _bins(rects: DataFrame, size: int) -> DataFrame:
    """A row for each bin that a rectangle (x, y, w, h; half open) touches; empty rectangles touch none."""
    span = lambda lo, n: F.sequence(_bin(F.col(lo), size), _bin(F.col(lo) + F.col(n) - 1, size))
    return rects.where("w > 0 AND h > 0").withColumn("bx", F.explode(span("x", "w"))).withColumn("by", F.explode(span("y", "h")))


def rect_overlap(a: DataFrame, b: DataFrame, size: int = 64) -> DataFrame:
    """a_id, b_id of rectangles (id, x, y, w, h, whole numbers) that share a cell; a pair is found in the bin of its first shared cell only."""
    name = lambda f, p: _bins(f.select("id", "x", "y", "w", "h"), size).select("bx", "by", *(F.col(c).alias(f"{p}_{c}") for c in ("id", "x", "y", "w", "h")))
    j = name(a, "a").join(name(b, "b"), ["bx", "by"])
    for c, n in (("x", "w"), ("y", "h")):
        p, q = F.col(f"a_{c}"), F.col(f"b_{c}")
        j = j.where((p < q + F.col(f"b_{n}")) & (q < p + F.col(f"a_{n}")) & (_bin(F.greatest(p, q), size) == F.col(f"b{c}")))
    return j.select("a_id", "b_id")


def first_cover(points: DataFrame, rects: DataFrame, size: int = 64) -> DataFrame:
    """points (px, py and others) with the least id of the rectangles that hold them; points in none are left out."""
    r = _bins(rects.select("id", "x", "y", "w", "h"), size)
    p = points.withColumns({"bx": _bin(F.col("px"), size), "by": _bin(F.col("py"), size)})
    inside = p.join(r, ["bx", "by"]).where("px >= x AND px < x + w AND py >= y AND py < y + h")
    return inside.groupBy(*points.columns).agg(F.min("id").alias("id"))


def bounds(points: DataFrame, group: str, axes: list[str]) -> DataFrame:
    """Least and largest value of each axis in a group; both begin at 0."""
    return points.groupBy(group).agg(*(f(F.lit(0), g(a)).alias(f"{n}_{a}") for a in axes for n, f, g in (("min", F.least, F.min), ("max", F.greatest, F.max))))


def blocked(tiles: DataFrame) -> DataFrame:
    """x, y, blocked: bits of directions that can't be left. tiles: x, y, shut (bits), centre (boolean).

    A direction is shut by the tile's own bit, the neighbour's centre or the neighbour's opposite bit; a tile that is
    missing shuts nothing. A diagonal is shut too where one of the two sides beside it is.
    """
    ways = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("bit", "dx", "dy", "opposite", "needs"), (b, dx, dy, o, n), strict=True))) for b, _, dx, dy, o, n in DIRECTIONS))
    sent = tiles.select("x", "y", "shut", "centre", F.explode(ways).alias("d")).select((F.col("x") - F.col("d.dx")).alias("x"), (F.col("y") - F.col("d.dy")).alias("y"), F.when(F.col("centre") | (F.expr("shut & shiftleft(1, d.opposite)") != 0), F.expr("shiftleft(1, d.bit)")).otherwise(0).alias("told"))
    all_ = tiles.select("x", "y", "shut", F.lit(True).alias("own")).unionByName(sent.select("x", "y", F.col("told").alias("shut"), F.lit(False).alias("own")))
    at = all_.groupBy("x", "y").agg(F.bit_or(F.col("shut").cast("int")).alias("m"), F.max("own").alias("own")).where("own")
    out = F.col("m")
    for b, *_, needs in DIRECTIONS:
        if needs:
            out = out.bitwiseOR(F.when(F.col("m").bitwiseAND(needs) != 0, 1 << b).otherwise(0))
    return at.select("x", "y", out.alias("blocked"))
