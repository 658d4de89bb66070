"""The tile pipeline: latest row wins, overrides, reconciliation of masks between neighbours, reachability, sanitised masks."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.masks import DIRECTIONS, directions, region_id
from tessera.plans.cut import cut

KEY = ["x", "y", "plane"]


def latest_wins(rows: DataFrame, *order: str) -> DataFrame:
    """Of each tile the last row by order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*(F.desc(c) for c in order)))).where("_n = 1").drop("_n")


def apply_overrides(tiles: DataFrame, forced: DataFrame) -> DataFrame:
    """walk_mask replaced where forced (x, y, plane, force_mask, or_mask) has force_mask, else with the bits of or_mask; tiles are never made."""
    o = forced.select(*KEY, "force_mask", "or_mask")
    mask = F.coalesce("force_mask", F.coalesce("walk_mask", F.lit(0)).bitwiseOR(F.coalesce("or_mask", F.lit(0))))
    return tiles.join(o, KEY, "left").withColumn("walk_mask", F.when(F.col("force_mask").isNull() & F.col("or_mask").isNull(), F.col("walk_mask")).otherwise(mask)).drop("force_mask", "or_mask")


def steps(tiles: DataFrame) -> DataFrame:
    """x, y, plane, bit, nx, ny: each set bit with the tile that it leads to. Eight rows for a tile at most."""
    d = F.broadcast(directions(tiles.sparkSession))
    t = tiles.select(*KEY, F.coalesce("walk_mask", F.lit(0)).cast("int").alias("m")).join(d)
    return t.where("(m & shiftleft(1, bit)) <> 0").select(*KEY, "bit", "opposite", "needs", (F.col("x") + F.col("dx")).alias("nx"), (F.col("y") + F.col("dy")).alias("ny"))


def reconcile(tiles: DataFrame) -> DataFrame:
    """walk_mask with the bits that the neighbour's opposite bit confirms; a diagonal also needs this tile's two confirmed cardinals.

    One join of the set bits with the masks, not one for each direction.
    """
    other = tiles.select(F.col("x").alias("nx"), F.col("y").alias("ny"), "plane", F.coalesce("walk_mask", F.lit(0)).cast("int").alias("nm"))
    ok = steps(tiles).join(other, ["nx", "ny", "plane"]).where("(nm & shiftleft(1, opposite)) <> 0")
    bits = ok.groupBy(*KEY).agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("m"))
    kept = F.col("m").bitwiseAND(15)
    for b, _, _, _, _, needs in DIRECTIONS:
        if needs:
            kept = kept + F.when((F.col("m").bitwiseAND(1 << b) != 0) & (F.col("m").bitwiseAND(needs) == needs), 1 << b).otherwise(0)
    rest = [c for c in tiles.columns if c not in (*KEY, "walk_mask")]
    return tiles.join(bits, KEY, "left").select(*KEY, F.coalesce(kept, F.lit(0)).cast("long").alias("walk_mask"), *rest)


def expand(x: np.ndarray, y: np.ndarray, mask: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Tiles reached inside one region and plane from those seen; x, y within it."""
    size = 64
    m, s = np.zeros((size + 2, size + 2), np.int64), np.zeros((size + 2, size + 2), bool)
    here = np.zeros_like(s)
    xs, ys = (x & 63) + 1, (y & 63) + 1
    m[xs, ys], s[xs, ys], here[xs, ys] = mask, seen, True
    before = -1
    while (now := int(s.sum())) != before:
        before = now
        for b, _, dx, dy, _, _ in DIRECTIONS:
            s |= here & np.roll(s & (m >> b & 1 > 0), (dx, dy), (0, 1))
    return s[xs, ys]


def reachable(tiles: DataFrame, seeds: DataFrame) -> DataFrame:
    """x, y, plane reached from seeds over the set bits of reconciled tiles.

    Each round solves the regions (64 x 64 tiles, so of bounded size) in which tiles were newly reached, and passes on what
    crosses their borders: rounds follow the number of regions on a way, not of tiles, and a round reads and writes only
    regions that change. Tiles are written once, in folders by band of regions, so a round skips the others.
    """
    t = tiles.select(*KEY, F.coalesce("walk_mask", F.lit(0)).cast("int").alias("m"), region_id(F.col("x"), F.col("y")).alias("r"))
    t = cut(t.withColumn("band", F.shiftright("r", 10)), "band")
    at = lambda d: d.withColumn("r", region_id(F.col("x"), F.col("y"))).withColumn("band", F.shiftright("r", 10))
    front = cut(at(seeds.select(*KEY).distinct()).join(t.select(*KEY), KEY, "left_semi"))
    found: list[DataFrame] = [t.limit(0).select(*KEY, "r")]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        reached = expand(*(pdf[c].to_numpy() for c in ("x", "y", "m", "seen")))
        return pdf[reached & ~pdf["before"].to_numpy()][[*KEY, "m", "r"]]

    kind = "x int, y int, plane int, m int, r int"
    while not front.isEmpty():
        regions = front.select("band", "r", "plane").distinct()
        active = t.join(regions, ["band", "r", "plane"], "left_semi")
        seen = reduce(DataFrame.unionAll, found).join(regions.select("r", "plane"), ["r", "plane"], "left_semi").select(*KEY, F.lit(True).alias("before"))
        marked = active.join(seen, KEY, "left").join(front.select(*KEY, F.lit(True).alias("new")), KEY, "left")
        marked = marked.select(*KEY, "m", "r", F.coalesce("before", F.lit(False)).alias("before"), (F.coalesce("before", F.lit(False)) | F.coalesce("new", F.lit(False))).alias("seen"))
        new = cut(marked.groupBy("r", "plane").applyInPandas(solve, kind))
        found.append(new.select(*KEY, "r"))
        if len(found) == 16:
            found = [cut(reduce(DataFrame.unionAll, found))]
        edge = steps(new.withColumn("walk_mask", F.col("m"))).select(F.col("nx").alias("x"), F.col("ny").alias("y"), "plane", region_id(F.col("x"), F.col("y")).alias("_from"))
        over = at(edge).where("r <> _from").drop("_from").distinct()
        known = reduce(DataFrame.unionAll, found).select(*KEY)
        front = cut(over.join(t.select(*KEY, "band"), [*KEY, "band"], "left_semi").join(known, KEY, "left_anti").select(*KEY, "r", "band"))
    return reduce(DataFrame.unionAll, found).select(*KEY)


def sanitise(tiles: DataFrame, reached: DataFrame) -> DataFrame:
    """The reached tiles, without bits that lead to a tile that isn't."""
    own = tiles.join(reached, KEY, "left_semi")
    to = reached.select(F.col("x").alias("nx"), F.col("y").alias("ny"), "plane")
    bits = steps(own).join(to, ["nx", "ny", "plane"], "left_semi").groupBy(*KEY).agg(F.bit_or(F.expr("shiftleft(1, bit)")).cast("long").alias("_m"))
    return own.join(bits, KEY, "left").withColumn("walk_mask", F.coalesce("_m", F.lit(0)).cast("long")).drop("_m")


def seeds(start: DataFrame, ends: DataFrame, forced: DataFrame) -> DataFrame:
    """x, y, plane where reachability begins: the start, all ends of teleports (both of doors, objects and NPCs, where a lodestone, item or interface slot leads) and forced tiles. With those, teleports need not be followed as edges."""
    return start.select(*KEY).unionAll(ends.select(*KEY)).unionAll(forced.where("force_mask IS NOT NULL").select(*KEY)).na.drop().distinct()


def put_back(sanitised: DataFrame, forced: DataFrame) -> DataFrame:
    """Overrides hold in the result too, also where they lead to a tile that isn't reached."""
    return apply_overrides(sanitised, forced).withColumn("walk_mask", F.col("walk_mask").cast("long"))


def ring_overrides(rings: DataFrame) -> DataFrame:
    """x, y, plane, force_mask, or_mask: a ring's own tile is forced open, its eight neighbours get the bit towards it (and for a diagonal both cardinals)."""
    d = F.broadcast(directions(rings.sparkSession))
    r = rings.select(*KEY).where("x IS NOT NULL AND y IS NOT NULL AND plane IS NOT NULL")
    near = r.join(d).select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"), "plane", F.lit(None).cast("int").alias("f"), F.expr("shiftleft(1, opposite)").alias("o"), F.col("opposite"))
    needs = F.create_map(*(F.lit(v) for b, *_, n in DIRECTIONS for v in (b, n)))
    near = near.select(*KEY, "f", F.col("o").bitwiseOR(needs[F.col("opposite")]).alias("o"))
    own = r.select(*KEY, F.lit(255).alias("f"), F.lit(0).alias("o"))
    return own.unionAll(near).groupBy(*KEY).agg(F.max("f").alias("force_mask"), F.bit_or("o").alias("or_mask"))
