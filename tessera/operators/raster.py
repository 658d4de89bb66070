"""Grids: quad-tree roll-ups, 2 x 2 means, neighbourhood means, level carries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pyramid(tiles: DataFrame, zooms: int) -> DataFrame:
    """zoom, px, py, n, open_bits: counts on all levels, each made from the one below, so the tiles are read once."""
    level = tiles.groupBy(F.col("x").alias("px"), F.col("y").alias("py")).agg(F.count("*").alias("n"), F.sum(F.bit_count("walk_mask")).cast("long").alias("open_bits"))
    out = None
    for z in range(zooms + 1):
        if z:
            level = level.groupBy(F.shiftright("px", 1).alias("px"), F.shiftright("py", 1).alias("py")).agg(F.sum("n").alias("n"), F.sum("open_bits").alias("open_bits"))
        row = level.select(F.lit(z).alias("zoom"), "px", "py", "n", "open_bits")
        out = row if out is None else out.unionAll(row)
    return out


def mip_mean(cells: DataFrame, value: str) -> DataFrame:
    """(a + b + c + d + 2) div 4 of each 2 x 2 group; a missing cell is 0."""
    return cells.groupBy(F.shiftright("x", 1).alias("px"), F.shiftright("y", 1).alias("py")).agg(F.expr(f"(sum({value}) + 2) div 4").alias(value))


def kernel_mean(cells: DataFrame, value: str, low: int = -4, high: int = 5) -> DataFrame:
    """Mean over the cells with dx and dy from low to high around each cell: summed along x, then along y, so a cell is sent 2 (high - low + 1) times, not its square."""
    spread = lambda c: F.explode(F.sequence(F.col(c) - high, F.col(c) - low)).alias(c)
    row = cells.select(spread("x"), "y", F.col(value).alias("v")).groupBy("x", "y").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    both = row.select("x", spread("y"), "s", "n").groupBy("x", "y").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return cells.select("x", "y").join(both, ["x", "y"]).select("x", "y", F.round(F.col("s") / F.col("n"), 6).alias("mean"))


def height_carry(levels: DataFrame) -> DataFrame:
    """Heights summed up the levels of a place: 1 counts 0, missing or 0 counts 30."""
    step = F.when(F.coalesce("extra", F.lit(0)) == 0, 30).when(F.col("extra") == 1, 0).otherwise(F.col("extra"))
    return levels.withColumn("height", F.sum(step).over(Window.partitionBy("x", "y").orderBy("level")))


def in_rect(px, py, x: str, y: str, w: str, h: str):
    """Half-open containment."""
    return (px >= F.col(x)) & (px < F.col(x) + F.col(w)) & (py >= F.col(y)) & (py < F.col(y) + F.col(h))


def mip_hash(cells: DataFrame, value: str) -> DataFrame:
    """crc32 over the four hashes of each 2 x 2 group in the order of y, then x; a missing cell is 0."""
    from tessera.functions.hashes import crc_chain

    at = lambda k: F.max(F.when((F.col("x") % 2) + (F.col("y") % 2) * 2 == k, F.col(value)))
    return cells.groupBy(F.shiftright("x", 1).alias("px"), F.shiftright("y", 1).alias("py")).agg(*(at(k).alias(f"_{k}") for k in range(4))).select("px", "py", crc_chain(*(F.col(f"_{k}") for k in range(4))).alias("hash"))
