"""Lookups between records: parameters with defaults, panels, morphs, names, files known already, placements by object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def struct_param(rows: DataFrame, extra: DataFrame, params: DataFrame, last) -> DataFrame:
    """rows (struct, param and others) with value: the struct's own (struct, param, value), else the parameter's default (param, default), else last.

    A parameter that params doesn't have stops the query. Text parameters take "" for last, numbers -1.
    """
    own = extra.groupBy("struct", "param").agg(F.first("value").alias("_own")) if "pos" not in extra.columns else extra.groupBy("struct", "param").agg(F.min_by("value", "pos").alias("_own"))
    j = rows.join(params.select("param", "default", F.lit(True).alias("_known")), "param", "left").join(own, ["struct", "param"], "left")
    kind = extra.schema["value"].dataType.simpleString()
    value = F.when(F.col("_known"), F.coalesce("_own", "default", F.lit(last))).otherwise(F.raise_error(F.concat(F.lit("unknown parameter "), F.col("param").cast("string"))).cast(kind))
    return j.select(*rows.columns, value.alias("value"))


def chain(rows: DataFrame, *links: tuple[DataFrame, str, dict[str, object]]) -> DataFrame:
    """rows through a chain of lookups: each link is a table, the column both have as key, and the columns taken from it with what stands in for nothing."""
    out = rows
    for table, key, taken in links:
        first = table.select(key, *taken).dropDuplicates([key])
        out = out.join(first, key, "left")
        for c, default in taken.items():
            if default is not None:
                out = out.withColumn(c, F.coalesce(c, F.lit(default)))
    return out


def overlaid(rows: DataFrame, key: str, to: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row with its empty fields filled from the row that it turns into (to names that row's key); keep stay as they are."""
    fields = [c for c in rows.columns if c not in (key, to, *keep)]
    base = rows.select(F.col(key).alias("_base"), *(F.col(c).alias(f"_b_{c}") for c in fields))
    return rows.join(base, F.col(to) == F.col("_base"), "left").select(*(F.coalesce(c, f"_b_{c}").alias(c) if c in fields else F.col(c) for c in rows.columns))


def by_hash(names: DataFrame, index: DataFrame, hash_of: Column, value: str) -> DataFrame:
    """names with the least value of the index rows (hash, value) whose hash is theirs; names without one are left out."""
    first = index.groupBy("hash").agg(F.min(value).alias(value))
    return names.withColumn("_hash", hash_of).join(first, F.col("_hash") == F.col("hash")).select(*names.columns, value)


def without(rows: DataFrame, blacklist: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(blacklist.select(*on), on, "left_anti")


def known_files(wanted: DataFrame, have: DataFrame, on: list[str], value: str, default) -> DataFrame:
    """wanted with value of the file that has the same name and hash, and state: found or missing."""
    best = have.groupBy(*on).agg(F.min(value).alias(value)).withColumn("_hit", F.lit(True))
    return wanted.join(best, on, "left").select(*wanted.columns, F.coalesce(value, F.lit(default)).alias(value), F.when(F.col("_hit"), "found").otherwise("missing").alias("state"))


def placements(squares: DataFrame, id_: int | None = None) -> DataFrame:
    """square, id, x, y, plane, rotation, type: the placements of squares (square, locations: array of id, uses); of one object if id_ is given."""
    one = squares.select("square", F.inline("locations")).select("square", "id", "uses")
    if id_ is not None:
        one = one.where(F.col("id") == id_)
    return one.select("square", "id", F.inline("uses")).select("square", "id", "x", "y", "plane", "rotation", "type")


def grouped(rows: DataFrame, key: str, kind: str, id_: str) -> DataFrame:
    """key, kinds (distinct, sorted, comma-joined), uses, newest of the rows of each key."""
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.count("*").alias("uses"), F.max(id_).alias("newest"))


def purged(versions: DataFrame, state: str, marked: Column, inside: Column, name: str = "purged") -> DataFrame:
    """Versions inside a range, with the state of the marked ones changed to name."""
    return versions.where(inside).withColumn(state, F.when(marked, F.lit(name)).otherwise(F.col(state)))


def delta_decoded(rows: DataFrame, group: list[str], order: list[str], step: str, held: Column) -> DataFrame:
    """rows with running, the sum of step up to each, and held, the last value of held that isn't null."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({"running": F.sum(step).over(w), "held": F.last(held, ignorenulls=True).over(w)})


def skeleton_groups(sequences: DataFrame, frames: DataFrame, skeletons: DataFrame) -> DataFrame:
    """framemap, sequences (in order): each sequence by the frame map of its skeleton, or of its first frame if it names no skeleton; a skeleton that isn't there gives none.

    sequences: id, skeleton, frame; frames: frame, framemap; skeletons: skeleton, framemap.
    """
    j = sequences.join(frames.select("frame", F.col("framemap").alias("_f")), "frame", "left").join(skeletons.select("skeleton", F.col("framemap").alias("_s")), "skeleton", "left")
    j = j.withColumn("framemap", F.when(F.col("skeleton").isNotNull(), F.col("_s")).otherwise(F.col("_f")))
    return j.where("framemap IS NOT NULL").groupBy("framemap").agg(F.array_sort(F.collect_list("id")).alias("sequences"))


def chat_lines(categories: DataFrame, lines: DataFrame) -> DataFrame:
    """category, place, line, text: the lines that categories (category, lines: array of ids) list, in order."""
    own = categories.select("category", F.posexplode("lines").alias("place", "line"))
    return own.join(lines.select("line", "text"), "line", "left").select("category", "place", "line", "text")


def chat_hotkeys(categories: DataFrame, root: int = 85) -> DataFrame:
    """category, depth, path of hotkeys of the tree of chat categories below root: 0 for a hotkey means the next free number, its last digit.

    categories: category, subcategories (array of id, hotkey), lines. Subcategories are numbered before lines, and a category is entered once.
    """
    from tessera.plans.cut import cut

    subs = categories.select("category", F.posexplode("subcategories").alias("pos", "s")).select("category", "pos", F.col("s.id").alias("id"), F.col("s.hotkey").alias("key"))
    free = F.sum(F.when(F.col("key") == 0, 1).otherwise(0)).over(Window.partitionBy("category").orderBy("pos"))
    edges = cut(subs.select("category", "id", F.when(F.col("key") == 0, (free % 10).cast("string")).otherwise(F.chr(F.col("key"))).alias("key")))
    front = cut(categories.where(F.col("category") == root).select("category", F.lit(0).alias("depth"), F.lit("").alias("path")))
    seen, depth = front, 0
    while not front.isEmpty():
        depth += 1
        below = front.select(F.col("category").alias("_c"), "path").join(edges, F.col("_c") == F.col("category")).groupBy("id").agg(F.min(F.concat("path", "key")).alias("path"))
        front = cut(below.select(F.col("id").alias("category"), F.lit(depth).alias("depth"), "path").join(seen, "category", "left_anti"))
        seen = seen.unionAll(front)
    return seen


def clue_places(enum: DataFrame) -> DataFrame:
    """value, level, x, z of the packed places of an enum's entries (value), distinct, in order of value."""
    from tessera.functions.masks import unpack_clue

    c = unpack_clue(F.col("value"))
    return enum.select("value").distinct().select("value", c["level"].alias("level"), c["x"].alias("x"), c["z"].alias("z")).orderBy("value")


def with_param(items: DataFrame, prop: int) -> DataFrame:
    """Items whose extra (entries prop, ...) has a parameter."""
    return items.where(F.exists("extra", lambda e: e["prop"] == prop))


def npc_models(npcs: DataFrame) -> DataFrame:
    """id, size (1 if missing), name ("" if missing), models (none if missing)."""
    return npcs.select("id", F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("name", F.lit("")).alias("name"), F.coalesce("models", F.array().cast("array<int>")).alias("models"))


def array_stats(configs: DataFrame, ids: str) -> DataFrame:
    """config, low, high, files, missing of arrays of ids: how many between 0 and the highest aren't there."""
    return configs.select("config", F.array_min(ids).alias("low"), F.array_max(ids).alias("high"), F.size(ids).alias("files"), (F.array_max(ids) + 1 - F.size(F.array_distinct(ids))).alias("missing"))


def newest_version(index: DataFrame, majors: list[int]) -> DataFrame:
    """version: the highest of some majors, as newer builds count versions by time."""
    return index.where(F.col("major").isin(majors)).agg(F.max("version").alias("version"))
