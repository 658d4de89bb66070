"""Dependencies between records: who uses what, with a hash of each record.

A collector reads decoded records (id, hash, and the fields it looks at; missing columns count as null) and gives edges: holder, dep, both named
type-id, where dep depends on holder. hashes() gives a row name, hash of each record. All are projections; edges are made distinct once, at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tessera.functions import hashes as h
from tessera.functions.colour import rgb_int
from tessera.operators.graph import closure
from tessera.plans.cut import cut

#: The types in the order of their numbers.
TYPES = ("material", "model", "item", "loc", "mapsquare", "sequence", "skeleton", "frameset", "animgroup", "npc", "framebase", "texture", "enum", "overlay", "underlay")


def name(kind: str, id_: Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), id_.cast("string"))


def path(df: DataFrame, *steps: str) -> Column:
    """The value at a path of fields, flattened through arrays to an array of numbers; null if a step is missing."""

    def go(col: Column, kind, rest: tuple[str, ...]) -> Column:
        if isinstance(kind, ArrayType):
            inner = kind.elementType
            each = F.transform(col, lambda x: go(x, inner, rest))
            return F.flatten(F.filter(each, lambda x: x.isNotNull()))
        if not rest:
            return F.when(col.isNotNull(), F.array(col.cast("long")))
        if not isinstance(kind, StructType) or rest[0] not in kind.names:
            return F.lit(None).cast("array<long>")
        return go(col[rest[0]], kind[rest[0]].dataType, rest[1:])

    if steps[0] not in df.columns:
        return F.lit(None).cast("array<long>")
    return go(F.col(f"`{steps[0]}`"), df.schema[steps[0]].dataType, steps[1:])


def uses(df: DataFrame, kind: str, holder: str, *paths: tuple[str, ...], zero: bool = True) -> DataFrame:
    """An edge for each number at the paths of each record; zero: whether 0 counts."""
    all_ = F.concat(*(F.coalesce(path(df, *p), F.array().cast("array<long>")) for p in paths))
    out = df.select("id", F.explode(all_).alias("_n"))
    out = out.where("_n IS NOT NULL") if zero else out.where("_n <> 0")
    return out.select(name(holder, F.col("_n")).alias("holder"), name(kind, F.col("id")).alias("dep"))


def _first(df: DataFrame, *paths: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.get(path(df, *p), F.lit(0)) for p in paths))


def locations(df: DataFrame) -> DataFrame:
    """Objects use their animation, models of both kinds, and what they turn into by default (the last of the first list of morphs that there is; -1 for nothing)."""
    morphs = F.coalesce(path(df, "morphs_1", "unk2"), path(df, "morphs_2", "unk2"))
    out = uses(df, "loc", "sequence", ("probably_animation",), zero=False)
    out = out.unionAll(uses(df, "loc", "model", ("models", "values"), ("models_05", "models", "values")))
    own = df.select("id", F.get(morphs, F.lit(0)).alias("_m")).where("_m <> -1")
    return out.unionAll(own.select(name("loc", F.col("_m")), name("loc", F.col("id"))))


#: The fields of an item that name models.
ITEM_MODELS = (("baseModel",), ("maleModels_0", "id"), ("maleModels_1",), ("maleModels_2",), ("femaleModels_0", "id"), ("femaleModels_1",), ("femaleModels_2",), ("maleHeads_0",), ("maleHeads_1",), ("femaleHeads_0",), ("femaleHeads_1",))


def items(df: DataFrame) -> DataFrame:
    return uses(df, "item", "model", *ITEM_MODELS).unionAll(uses(df, "item", "item", ("noteTemplate",), zero=False))


def npcs(df: DataFrame) -> DataFrame:
    return uses(df, "npc", "animgroup", ("animation_group",), zero=False).unionAll(uses(df, "npc", "model", ("models",), ("headModels",)))


def animgroups(df: DataFrame) -> DataFrame:
    """The animation that a group names first, else the one for standing."""
    own = df.select("id", _first(df, ("unknown_26",), ("baseAnims", "idle")).alias("_n")).where("_n <> 0")
    return own.select(name("sequence", F.col("_n")).alias("holder"), name("animgroup", F.col("id")).alias("dep"))


def materials(df: DataFrame, build: int) -> DataFrame:
    """By build: a texture of the same number, that of its sprite, nothing known, or all its textures (a struct of numbers)."""
    if build <= 377:
        return df.select(name("texture", F.col("id")).alias("holder"), name("material", F.col("id")).alias("dep"))
    if build <= 471:
        return uses(df, "material", "texture", ("spriteid",))
    if build < 759:
        return df.limit(0).select(F.lit("").alias("holder"), F.lit("").alias("dep"))
    return material_textures(df)


def material_textures(df: DataFrame) -> DataFrame:
    kind = df.schema["textures"].dataType
    return uses(df, "material", "texture", *(("textures", f) for f in kind.names))


def overlays(df: DataFrame) -> DataFrame:
    return uses(df, "overlay", "material", ("material",), zero=False)


def underlays(df: DataFrame) -> DataFrame:
    return uses(df, "underlay", "material", ("material",), zero=False)


def squares(placements: DataFrame, tiles: DataFrame) -> DataFrame:
    """Squares use the objects placed on them (square, id), and the overlays and underlays of their tiles (square, overlay, underlay)."""
    of = lambda df, c, kind: df.where(F.col(c).isNotNull()).select(name(kind, F.col(c)).alias("holder"), name("mapsquare", F.col("square")).alias("dep")).distinct()
    return of(placements, "id", "loc").unionAll(of(tiles, "overlay", "overlay")).unionAll(of(tiles, "underlay", "underlay"))


def square_locations(placements: DataFrame) -> DataFrame:
    return placements.select(name("loc", F.col("id")).alias("holder"), name("mapsquare", F.col("square")).alias("dep"))


def sequences(df: DataFrame, build: int) -> DataFrame:
    """Sequences use a skeleton, and the set of their first frame; not known up to build 484."""
    if build <= 484:
        return df.limit(0).select(F.lit("").alias("holder"), F.lit("").alias("dep"))
    own = df.select("id", F.get(path(df, "frames", "frameidhi"), F.lit(0)).alias("_n")).where("_n IS NOT NULL")
    frames = own.select(name("frameset", F.col("_n")).alias("holder"), name("sequence", F.col("id")).alias("dep"))
    return uses(df, "sequence", "skeleton", ("skeletal_animation",), zero=False).unionAll(frames)


def skeletons(df: DataFrame) -> DataFrame:
    return uses(df, "skeleton", "framebase", ("framebase",))


def framesets(frames: DataFrame) -> DataFrame:
    """The frame base of the first frame (id, frame, probably_framemap_id) of each set."""
    first = frames.groupBy("id").agg(F.min_by("probably_framemap_id", "frame").alias("probably_framemap_id"))
    return uses(first, "frameset", "framebase", ("probably_framemap_id",))


def hashes(df: DataFrame, kind: str) -> DataFrame:
    """name, hash of records (id, hash). Models give only these."""
    return df.select(name(kind, F.col("id")).alias("name"), F.col("hash").cast("long").alias("hash"))


def floor_hash(df: DataFrame) -> Column:
    """Checksum of how a floor looks: bleeding, its priority, material, three colours, tiling, each as four bytes; missing numbers are -1, missing colours magenta."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None)
    colour = lambda c: F.coalesce(rgb_int(*(F.get(F.col(c), F.lit(k)).cast("long") for k in range(3))), F.lit(0xFF00FF)) if c in df.columns else F.lit(0xFF00FF)
    number = lambda *cs: F.coalesce(*(has(c).cast("long") for c in cs), F.lit(-1))
    bleeds = F.when(F.coalesce(has("bleedToUnderlay").cast("boolean"), F.lit(False)), 1).otherwise(0)
    return h.crc_chain(bleeds, number("bleedpriority"), number("materialbyte", "material"), colour("color"), colour("secondary_colour"), colour("tertiary_colour"), number("material_tiling"))


def graph(*edges: DataFrame) -> DataFrame:
    """Distinct holder, dep of all collectors."""
    return reduce(DataFrame.unionAll, edges).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """name, dependencies, dependents of every name in an edge, sorted."""
    a = edges.select(F.col("dep").alias("name"), F.col("holder").alias("needs"), F.lit(None).cast("string").alias("feeds"))
    b = edges.select(F.col("holder").alias("name"), F.lit(None).cast("string").alias("needs"), F.col("dep").alias("feeds"))
    return a.unionAll(b).groupBy("name").agg(F.array_sort(F.collect_set("needs")).alias("dependencies"), F.array_sort(F.collect_set("feeds")).alias("dependents"))


def closure_list(edges: DataFrame, known: DataFrame, roots: DataFrame) -> DataFrame:
    """node, depth, entry ("name-hash", hash 0 if unknown) of all that roots (node) depend on, themselves included."""
    found = closure(edges.select(F.col("dep").alias("src"), F.col("holder").alias("dst")), roots)
    joined = found.join(known.select(F.col("name").alias("node"), "hash"), "node", "left")
    return joined.select("node", "depth", F.concat("node", F.lit("-"), F.coalesce("hash", F.lit(0)).cast("string")).alias("entry"))


def preorder(edges: DataFrame, root: str, most: int = 64) -> DataFrame:
    """place, node: what root depends on in the order of a walk that enters each at its first place (holders by name), ready to be hashed.

    Paths are made level by level and sorted at the end; a name is entered from the least of its paths.
    """
    spark = edges.sparkSession
    front = spark.createDataFrame([(root, [root])], "node string, path array<string>")
    seen = cut(front)
    for _ in range(most):
        nxt = front.join(edges, F.col("node") == F.col("dep")).where(~F.array_contains("path", F.col("holder"))).select(F.col("holder").alias("node"), F.concat("path", F.array("holder")).alias("path"))
        front = cut(nxt.groupBy("node").agg(F.min("path").alias("path")))
        if front.isEmpty():
            break
        both = seen.unionAll(front).groupBy("node").agg(F.min("path").alias("path"))
        seen = cut(both)
    from tessera.operators.ordered import running_total

    return running_total(seen, ["path"], F.lit(1), "place").select("place", "node")
