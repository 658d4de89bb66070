"""Map squares: tiles with heights and settings, objects on them, what blocks a way, heights between tiles.

A tile is a row x, z, level, ...; all rules are joins and aggregates over tiles, so a world of any size is a table, not a grid in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the flags of new maps and the settings that they stand for; water has none in old maps.
FLAGS = ((2, 1), (4, 2), (8, 4), (32, 8), (64, 16), (16, 128))
#: Bits of what shuts a tile: the middle, left, bottom, right, top, then the four corners.
MIDDLE, SIDES, CORNERS = 0, (1, 2, 3, 4), (5, 6, 7, 8)
#: Types of objects that fill their tiles, and which side a wall of each rotation stands at.
FULL_TYPES = (9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21)
WALL_SIDE = (1, 4, 3, 2)


def settings_of_flags(flags: Column) -> Column:
    out = F.lit(0)
    for bit, value in FLAGS:
        out = out.bitwiseOR(F.when(flags.bitwiseAND(bit) != 0, value).otherwise(0))
    return out


def raised(tiles: DataFrame, height: str = "height") -> DataFrame:
    """tiles with y: heights added up from the lowest level; 1 counts as 0, nothing and 0 as 30."""
    step = F.when(F.coalesce(F.col(height), F.lit(0)) == 0, 30).when(F.col(height) == 1, 0).otherwise(F.col(height))
    return tiles.withColumn("y", F.sum(step).over(Window.partitionBy("x", "z").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)))


def corners(tiles: DataFrame) -> DataFrame:
    """tiles (x, z, level, y) with y01, y10, y11: the heights of the tiles to the right, above, and both, or its own where those are missing. One shuffle."""
    ways = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dz).alias("dz")) for dx, dz in ((0, 0), (1, 0), (0, 1), (1, 1))))
    sent = tiles.select("x", "z", "level", "y", F.explode(ways).alias("d"))
    sent = sent.select((F.col("x") - F.col("d.dx")).alias("x"), (F.col("z") - F.col("d.dz")).alias("z"), "level", "d.dx", "d.dz", "y")
    at = lambda dx, dz: F.max(F.when((F.col("dx") == dx) & (F.col("dz") == dz), F.col("y")))
    out = sent.groupBy("x", "z", "level").agg(at(0, 0).alias("y"), at(1, 0).alias("y01"), at(0, 1).alias("y10"), at(1, 1).alias("y11"))
    return out.where("y IS NOT NULL").select("x", "z", "level", "y", *(F.coalesce(c, "y").alias(c) for c in ("y01", "y10", "y11")))


def height_at(points: DataFrame, corners_: DataFrame) -> DataFrame:
    """points (px, pz, level and others) with height, weighed between the four corners of their tile; 0 off the map, the water's where a tile has some (water, may be missing)."""
    t = corners_.select(F.col("x").alias("_x"), F.col("z").alias("_z"), "level", "y", "y01", "y10", "y11", (F.col("water") if "water" in corners_.columns else F.lit(None).cast("double")).alias("_water"))
    p = points.withColumns({"_x": F.floor("px"), "_z": F.floor("pz")})
    fx, fz = F.col("px") - F.col("_x"), F.col("pz") - F.col("_z")
    between = F.col("y") * (1 - fx) * (1 - fz) + F.col("y01") * fx * (1 - fz) + F.col("y10") * (1 - fx) * fz + F.col("y11") * fx * fz
    return p.join(t, ["_x", "_z", "level"], "left").select(*points.columns, F.when(F.col("y").isNull(), 0.0).otherwise(F.coalesce("_water", between)).alias("height"))


def shown_levels(tiles: DataFrame) -> DataFrame:
    """tiles (x, z, level, settings) with effective, the level whose rules hold there: one lower where level 1 of the place is a bridge (setting 2);
    and visual, the least level at which it shows: from above a roof (setting 4 of the effective tile) on, until one that always shows (setting 8); of the tiles around it the highest, unless it always shows itself."""
    place = Window.partitionBy("x", "z")
    has = lambda c, bit: F.coalesce(c, F.lit(0)).bitwiseAND(bit) != 0
    bridge = F.coalesce(F.max(F.when((F.col("level") == 1) & has(F.col("settings"), 2), 1)).over(place), F.lit(0)) == 1
    t = tiles.select("x", "z", "level", "settings").withColumn("effective", F.col("level") - F.when(bridge, 1).otherwise(0))
    up = place.orderBy("level")
    t = t.withColumn("_under", F.when(F.col("effective") == F.col("level"), F.col("settings")).otherwise(F.lag("settings").over(up)))
    event = F.when(has(F.col("_under"), 4), F.col("effective") + 1).when(has(F.col("settings"), 8), 0)
    below = F.last(event, ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("_own", F.when(has(F.col("settings"), 8), 0).otherwise(F.coalesce(below, F.lit(0))))
    ways = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dz).alias("dz")) for dx in (-1, 0, 1) for dz in (-1, 0, 1)))
    sent = t.select("x", "z", "level", "_own", F.explode(ways).alias("d")).select((F.col("x") + F.col("d.dx")).alias("x"), (F.col("z") + F.col("d.dz")).alias("z"), "level", "_own")
    around = sent.groupBy("x", "z", "level").agg(F.max("_own").alias("_around"))
    out = t.join(around, ["x", "z", "level"]).withColumn("visual", F.when(has(F.col("settings"), 8), 0).otherwise(F.col("_around")))
    rest = [c for c in tiles.columns if c not in ("x", "z", "level", "settings")]
    out = out.select("x", "z", "level", "settings", "effective", "visual")
    return out.join(tiles.select("x", "z", "level", *rest), ["x", "z", "level"]) if rest else out


def shut_by_settings(tiles: DataFrame) -> DataFrame:
    """x, z, level, walk of tiles (x, z, level, settings): setting 1 shuts the middle; on bridges the level above is what counts."""
    t = shown_levels(tiles).where("effective >= 0")
    own = t.select("x", "z", F.col("effective").alias("level"), F.col("level").alias("_from"), F.when(F.coalesce("settings", F.lit(0)).bitwiseAND(1) != 0, 1).otherwise(0).alias("walk"))
    return own.groupBy("x", "z", "level").agg(F.max_by("walk", "_from").alias("walk"))


def shut_bits(kind: Column, rotation: Column, blocks: Column) -> Column:
    """Bits that an object of a type and rotation shuts on each of its tiles: ground decoration (22) the middle if it blocks, walls a side, corners two, diagonals a corner, the rest all of it."""
    turn = F.pmod(rotation, F.lit(4))
    side = lambda t: F.get(F.array(*(F.lit(1 << k) for k in WALL_SIDE)), F.pmod(t, F.lit(4)).cast("int"))
    corner = F.get(F.array(*(F.lit(1 << k) for k in CORNERS)), turn.cast("int"))
    return F.when((kind == 22) & F.coalesce(blocks, F.lit(False)), 1).when(kind == 0, side(rotation)).when(kind == 2, side(rotation).bitwiseOR(side(rotation + 1))).when(kind.isin(1, 3), corner).when(kind.isin(*FULL_TYPES), 1).otherwise(0)


def footprints(objects: DataFrame) -> DataFrame:
    """A row for each tile of objects (x, z, width, length, rotation): turned by a quarter, the sides are swapped; sizes that are missing are 1."""
    w, n = F.coalesce("width", F.lit(1)), F.coalesce("length", F.lit(1))
    turned = F.col("rotation") % 2 == 1
    xs, zs = F.when(turned, n).otherwise(w), F.when(turned, w).otherwise(n)
    out = objects.withColumns({"_dx": F.explode(F.sequence(F.lit(0), xs - 1))}).withColumn("_dz", F.explode(F.sequence(F.lit(0), zs - 1)))
    return out.withColumns({"x": F.col("x") + F.col("_dx"), "z": F.col("z") + F.col("_dz")}).drop("_dx", "_dz")


def collision(tiles: DataFrame, objects: DataFrame) -> DataFrame:
    """x, z, level, walk, sight of tiles: bits shut by settings and by the objects on them.

    objects: x, z, level, width, length, rotation, type, blocks, see_through, no_collision. Objects off the map shut nothing.
    """
    bits = shut_bits(F.col("type"), F.col("rotation"), F.col("blocks"))
    on = footprints(objects.where("NOT coalesce(no_collision, false)")).withColumn("walk", bits)
    # ground decoration never stops sight
    stops = ~F.coalesce("see_through", F.lit(False)) & (F.col("type") != 22)
    on = on.select("x", "z", "level", "walk", F.when(stops, F.col("walk")).otherwise(0).alias("sight"), F.lit(False).alias("_own"))
    own = shut_by_settings(tiles).select("x", "z", "level", "walk", F.lit(0).alias("sight"), F.lit(True).alias("_own"))
    out = own.unionByName(on.select("x", "z", F.col("level").cast(own.schema["level"].dataType).alias("level"), "walk", "sight", "_own"))
    return out.groupBy("x", "z", "level").agg(F.bit_or("walk").alias("walk"), F.bit_or("sight").alias("sight"), F.max("_own").alias("_own")).where("_own").drop("_own")


def any_collision(grids: DataFrame) -> DataFrame:
    """x, z, level, walk, sight shut in any of several grids that overlap."""
    return grids.groupBy("x", "z", "level").agg(F.bit_or("walk").alias("walk"), F.bit_or("sight").alias("sight"))


def height_layer(collision_: DataFrame, corners_: DataFrame) -> DataFrame:
    """x, z, level, height, packed: a sixteenth of the mean of a tile's corners, and its nine bits as digits to base 3 (0 open, 1 to be seen over, 2 shut)."""
    bit = lambda c, k: F.shiftright(c, k).bitwiseAND(1) == 1
    packed = sum((F.when(bit("walk", k), F.when(bit("sight", k), 2).otherwise(1)).otherwise(0) * 3**k for k in range(9)), F.lit(0))
    mean = (F.col("y") + F.col("y01") + F.col("y10") + F.col("y11")) / 4
    return collision_.join(corners_, ["x", "z", "level"]).select("x", "z", "level", F.floor(mean / 16).cast("int").alias("height"), packed.alias("packed"))


def visible_objects(objects: DataFrame, x: int, z: int, xsize: int, zsize: int, level: int) -> DataFrame:
    """Objects whose tile lies in a half-open box, and whose level shows: at most level, or forced (always)."""
    inside = F.col("x").between(x, x + xsize - 1) & F.col("z").between(z, z + zsize - 1)
    return objects.where(inside & ((F.col("visual") <= level) | F.coalesce("always", F.lit(False))))


def summary(objects: DataFrame, x: int, z: int, xsize: int, zsize: int) -> DataFrame:
    """name, id, count, places (sorted) of the named objects in a half-open box."""
    own = objects.where(F.col("name").isNotNull() & F.col("x").between(x, x + xsize - 1) & F.col("z").between(z, z + zsize - 1))
    return own.groupBy("id", "name").agg(F.count("*").alias("count"), F.array_sort(F.collect_list(F.struct("level", "x", "z", "rotation", "type"))).alias("places"))


def label_uses(objects: DataFrame, labels: DataFrame, functions: DataFrame) -> DataFrame:
    """label, sprite, uses: places of the objects that have a map function, by the label that it names; of an object that turns into others the default one's function.

    objects: x, z, function, default_function; functions: function, label; labels: label, sprite.
    """
    used = objects.select("x", "z", F.coalesce("function", "default_function").alias("function")).where("function IS NOT NULL")
    j = used.join(functions, "function").join(labels, "label")
    return j.groupBy("label", "sprite").agg(F.array_sort(F.collect_list(F.struct("x", "z"))).alias("uses"))


def instances(placements: DataFrame) -> DataFrame:
    """id, instances of placements (id, plane, x, z, rotation, type, and more), in this order."""
    first = ["plane", "x", "z", "rotation", "type"]
    rest = [c for c in placements.columns if c not in ("id", *first)]
    return placements.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(*first, *rest))).alias("instances"))


def placement_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """id, plane, x, z, rotation, type, change (add, delete, edit) between placements of two versions, each with hash; edit: there in both with another hash, or an object whose own hash (dephash) is another."""
    key = ["id", "plane", "x", "z", "rotation", "type"]
    a = old.select(*key, F.struct("hash", "dephash").alias("_a"))
    b = new.select(*key, F.struct("hash", "dephash").alias("_b"))
    change = F.when(F.col("_a").isNull(), "add").when(F.col("_b").isNull(), "delete").when(F.col("_a") != F.col("_b"), "edit")
    return a.join(b, key, "full").select(*key, change.alias("change")).where("change IS NOT NULL")


def floor_changes(old: DataFrame, new: DataFrame, level: int) -> DataFrame:
    """gx, gz of floor groups (gx, gz, hashes, dephash) that differ at a level, or are in one only."""
    at = lambda d, n: d.select("gx", "gz", F.struct(F.get("hashes", F.lit(level)).alias("h"), "dephash").alias(n))
    return at(old, "_a").join(at(new, "_b"), ["gx", "gz"], "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("gx", "gz")


def matching_versions(files: DataFrame, chunks: DataFrame, metas: DataFrame) -> DataFrame:
    """file, version for each file (file, firstbuild, build) whose chunks (file, chunk) all have a meta (chunk, version, firstbuild, build) that was valid when it was: the first by version of each chunk."""
    j = files.join(chunks, "file").join(metas.select("chunk", "version", F.col("firstbuild").alias("_f"), F.col("build").alias("_b")), "chunk", "left")
    fits = (F.col("_b") >= F.col("firstbuild")) & (F.col("_f") <= F.col("build"))
    first = j.groupBy("file", "chunk").agg(F.min(F.when(fits, F.col("version"))).alias("version"))
    return first.withColumn("_all", F.min(F.col("version").isNotNull()).over(Window.partitionBy("file"))).where("_all").select("file", "chunk", "version")


def area(text: str, presets: dict[str, list[tuple[int, int, int, int]]] | None = None) -> list[tuple[int, int, int, int]]:
    """x, z, xsize, zsize, in squares, of a preset by name (full, test, or those given) or of ranges like 50.50-52.51."""
    from tessera.operators.indexes import id_ranges

    # fixed values: the areas that have names
    named = {"": [(0, 0, 100, 200)], "full": [(0, 0, 100, 200)], "test": [(49, 49, 3, 3)], **(presets or {})}
    if text in named:
        return named[text]
    if text.isidentifier():
        raise ValueError(f"no area {text}")
    out = [(int(lo[0]), int(lo[1]), int(hi[0] - lo[0] + 1), int(hi[1] - lo[1] + 1)) for lo, hi in id_ranges(text, 2)]
    if not out:
        raise ValueError("no area")
    return out


def zone_areas(bounds: DataFrame) -> DataFrame:
    """x, z, xsize, zsize in squares of zones whose bounds (xstart, zstart, xend, zend, inclusive) are in tiles."""
    lo = lambda c: F.floor(F.col(c) / 64)
    size = lambda a, b: F.ceil((F.col(b) + 1) / 64) - lo(a) + 1
    return bounds.select(lo("xstart").alias("x"), lo("zstart").alias("z"), size("xstart", "xend").alias("xsize"), size("zstart", "zend").alias("zsize")).distinct()


def padded(tiles: DataFrame, square: int = 64, pad: int = 20) -> DataFrame:
    """A row for each square and each tile that lies in it or within pad of it: what a square's rendering needs, without a join."""
    near = lambda c: F.sequence(F.floor((F.col(c) - pad) / square), F.floor((F.col(c) + pad) / square))
    return tiles.withColumn("square_x", F.explode(near("x"))).withColumn("square_z", F.explode(near("z")))


def blended(tiles: DataFrame) -> DataFrame:
    """x, z, level, r, g, b: of the visible tiles from 4 before to 5 after a tile, each way, the mean colour; null if none is visible. tiles: x, z, level, visible, r, g, b.

    Sums run along z and then along x, so a tile is moved 20 times and not 100.
    """
    cells = tiles.select("x", "z", "level", *(F.when(F.col("visible"), F.col(c)).alias(c) for c in "rgb"), F.when(F.col("visible"), 1).otherwise(0).alias("n"))
    own = tiles.select("x", "z", "level")
    for axis in ("z", "x"):
        spread = cells.withColumn("_to", F.explode(F.sequence(F.col(axis) - 5, F.col(axis) + 4)))
        other = "x" if axis == "z" else "z"
        cells = spread.groupBy(other, "level", F.col("_to").alias(axis)).agg(*(F.sum(c).alias(c) for c in ("r", "g", "b", "n")))
    return own.join(cells, ["x", "z", "level"], "left").select("x", "z", "level", *((F.col(c) / F.nullif(F.col("n"), F.lit(0))).alias(c) for c in "rgb"))


def material_repeats(tiles: DataFrame, x: int, z: int, xsize: int, zsize: int) -> DataFrame:
    """material, repeat: the largest repeat of each material in a half-open box of tiles (x, z, materials: array of material, repeat)."""
    own = tiles.where(F.col("x").between(x, x + xsize - 1) & F.col("z").between(z, z + zsize - 1))
    return own.select(F.inline("materials")).groupBy("material").agg(F.max("repeat").alias("repeat"))


def mesh_centres(meshes: DataFrame) -> DataFrame:
    """id, cx, cy, cz: the mean place of a model's vertices, each counted as often as its meshes (id, positions: array of x, y, z, indices) use it."""
    used = meshes.select("id", F.explode(F.transform("indices", lambda i: F.get("positions", i))).alias("p"))
    return used.groupBy("id").agg(*(F.avg(f"p.{a}").alias(f"c{a}") for a in "xyz"))
