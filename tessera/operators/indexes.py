"""Logical ids of files: how a mode's ids map to major, minor and file, and ranges over them.

files: a row for each file, major, minor, fileid (its number in the archive). Each index adds the logical id as columns id0, id1, ...
and keeps the rows that the mode has; ranges then compare those columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import legacy_name_hash, name_hash

Range = tuple[tuple[float, ...], tuple[float, ...]]
STRIDE = 128


def id_ranges(text: str, parts: int = 3) -> list[Range]:
    """"a.b.c-d.e.f,..." as inclusive ranges; a missing end is open, one value is a point. Ranges may overlap; each counts."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        lo, dash, hi = part.partition("-")
        ends = [[int(v) if v else None for v in e.split(".")] + [None] * parts for e in ((lo, hi) if dash else (lo, lo))]
        out.append((tuple(v or 0 for v in ends[0][:parts]), tuple(float("inf") if v is None else v for v in ends[1][:parts])))
    return out


def _at_least(cols: list[Column], low: tuple[float, ...]) -> Column:
    rest = F.lit(True) if len(cols) == 1 else _at_least(cols[1:], low[1:])
    return (cols[0] > low[0]) | ((cols[0] == low[0]) & rest)


def _at_most(cols: list[Column], high: tuple[float, ...]) -> Column:
    if high[0] == float("inf"):
        return F.lit(True)
    rest = F.lit(True) if len(cols) == 1 else _at_most(cols[1:], high[1:])
    return (cols[0] < high[0]) | ((cols[0] == high[0]) & rest)


def in_range(cols: list[Column], low: tuple[float, ...], high: tuple[float, ...]) -> Column:
    """Whether the columns lie between low and high in lexical order: a later part bounds only rows at the end of the earlier ones.

    The bounds of the first part stand apart, so that a scan can skip by them.
    """
    return _at_least(cols, low) & _at_most(cols, high) & (cols[0] >= low[0]) & (F.lit(True) if high[0] == float("inf") else cols[0] <= high[0])


def in_ranges(cols: list[Column], text: str) -> Column:
    out = F.lit(False)
    for low, high in id_ranges(text, max(3, len(cols))):
        out = out | in_range(cols, low, high)
    return out


def all_ranges(files: DataFrame, cols: list[str], text: str) -> DataFrame:
    """The files of each range one after the other: a file in two ranges comes twice; range is the number of its range."""
    out = None
    for k, (low, high) in enumerate(id_ranges(text, max(3, len(cols)))):
        part = files.where(in_range([F.col(c) for c in cols], low, high)).withColumn("range", F.lit(k))
        out = part if out is None else out.unionAll(part)
    return files.withColumn("range", F.lit(None).cast("int")).limit(0) if out is None else out


def extract_order(files: DataFrame) -> DataFrame:
    return files.orderBy("major", "minor", "fileid")


# -- numbering ----------------------------------------------------------------------------------------

# fixed values: ids of majors, and how many ids an archive of a major holds; other majors hold one
MAJORS = {"config": 2, "mapsquares": 5, "enums": 17, "npcs": 18, "items": 19, "objects": 16, "sequences": 20, "spotanims": 21, "structs": 22, "materials": 26, "achievements": 57, "index": 255}
STRIDES = {"items": 256, "npcs": 128, "structs": 32, "enums": 256, "objects": 256, "sequences": 128, "spotanims": 256, "achievements": 128}
#: Pages of major 2 that held some majors' files before build 488.
OLD_PAGES = {"objects": 6, "npcs": 9, "items": 10, "spotanims": 13}
CONFIG_SINCE = 488


def _by_major(major: Column, of: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for name, value in of.items():
        out = F.when(major == MAJORS[name], value).otherwise(out)
    return out


def stride(major: Column) -> Column:
    """Ids in an archive of the major; for materials all of them."""
    return F.when(major == MAJORS["materials"], F.lit(2**53 - 1)).otherwise(F.coalesce(_by_major(major, STRIDES), F.lit(1)).cast("long"))


def place_of(major: Column, file: Column, build: Column) -> Column:
    """struct major, minor, subid of a file id; old builds keep some majors in pages of the config major."""
    page = F.when(build < CONFIG_SINCE, _by_major(major, OLD_PAGES))
    n = stride(major)
    new = F.struct(major.cast("long").alias("major"), F.floor(file / n).cast("long").alias("minor"), F.pmod(file.cast("long"), n).alias("subid"))
    return F.when(page.isNotNull(), F.struct(F.lit(MAJORS["config"]).cast("long").alias("major"), page.cast("long").alias("minor"), file.cast("long").alias("subid"))).otherwise(new)


def id_of(major: Column, minor: Column, sub: Column) -> Column:
    return minor.cast("long") * stride(major) + sub


def square_minor(x: Column, z: Column) -> Column:
    """Minor of a map square, and legacy_square that of old caches."""
    return x + z * STRIDE


def legacy_square(x: Column, z: Column) -> Column:
    return x * 256 + z


def tile_index(x: Column, z: Column, level: Column, xsize: int = 64, zsize: int = 64) -> Column:
    """Number of a tile in a grid that goes along z, then x, then level."""
    return z + x * zsize + level * (xsize * zsize)


def tile_place(index: Column, xsize: int = 64, zsize: int = 64) -> Column:
    """struct x, z, level: the inverse of tile_index."""
    return F.struct((F.floor(index / zsize) % xsize).alias("x"), F.pmod(index, F.lit(zsize)).alias("z"), F.floor(index / (xsize * zsize)).alias("level"))


def square_tiles(tiles: DataFrame, square: int = 64) -> DataFrame:
    """World coordinates x, z of tiles given as square_x, square_z, index, level."""
    at = tile_place(F.col("index"), square, square)
    return tiles.withColumns({"x": F.col("square_x") * square + at["x"], "z": F.col("square_z") * square + at["z"], "tile_level": at["level"]})


# -- indexes ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """find: files -> the mode's files with id0, id1, ...; dimensions: how many parts an id has."""

    dimensions: int
    find: Callable[[DataFrame], DataFrame]

    def ids(self) -> list[str]:
        return [f"id{k}" for k in range(self.dimensions)]

    def files(self, files: DataFrame, ranges: str | None = None) -> DataFrame:
        out = self.find(files)
        return out if ranges is None or not self.dimensions else out.where(in_ranges([F.col(c) for c in self.ids()], ranges))

    def box(self, files: DataFrame, x: tuple[int, int], z: tuple[int, int]) -> DataFrame:
        """Of an id of two parts: both between their bounds."""
        return self.find(files).where(F.col("id0").between(*x) & F.col("id1").between(*z))


def _ids(*cols: Column) -> dict[str, Column]:
    return {f"id{k}": c.cast("long") for k, c in enumerate(cols)}


def standard(major: int) -> Index:
    return Index(2, lambda f: f.where(F.col("major") == major).withColumns(_ids(F.col("minor"), F.col("fileid"))))


def chunked(major: int) -> Index:
    return Index(1, lambda f: f.where(F.col("major") == major).withColumns(_ids(id_of(F.col("major"), F.col("minor"), F.col("fileid")))))


def single_minor(major: int, minor: int) -> Index:
    return Index(1, lambda f: f.where((F.col("major") == major) & (F.col("minor") == minor)).withColumns(_ids(F.col("fileid"))))


def no_archive(major: int) -> Index:
    """A file other than 0 stops the query."""
    only = F.when(F.col("fileid") == 0, F.col("minor")).otherwise(F.raise_error(F.lit("a file other than 0 in an index without archives")).cast("int"))
    return Index(1, lambda f: f.where(F.col("major") == major).withColumns(_ids(only)))


def any_file() -> Index:
    return Index(3, lambda f: f.withColumns(_ids(F.col("major"), F.col("minor"), F.col("fileid"))))


def world_map(subfile: int, major: int = MAJORS["mapsquares"]) -> Index:
    return Index(2, lambda f: f.where((F.col("major") == major) & (F.col("fileid") == subfile)).withColumns(_ids(F.col("minor") % STRIDE, F.floor(F.col("minor") / STRIDE))))


def old_world_map(spark, key: str, old_hash: bool = False, major: int = MAJORS["mapsquares"], xs: int = 101, zs: int = 201) -> Index:
    """Squares that are found by the hash of their name, like m50_50; files carry name. xs x zs names are made, whatever the input."""
    hashed = legacy_name_hash if old_hash else name_hash
    names = spark.range(xs * zs).select((F.col("id") % xs).alias("id0"), F.floor(F.col("id") / xs).alias("id1"))
    names = names.withColumn("name", hashed(F.concat(F.lit(key), F.col("id0").cast("string"), F.lit("_"), F.col("id1").cast("string"))))
    return Index(2, lambda f: f.where((F.col("major") == major) & (F.col("fileid") == 0)).join(F.broadcast(names), "name"))


def without(index: Index, blacklist: DataFrame) -> Index:
    """Without the archives (major, minor) of blacklist."""
    return Index(index.dimensions, lambda f: index.find(f).join(blacklist.select("major", "minor"), ["major", "minor"], "left_anti"))


def index_files(root: DataFrame) -> Index:
    """The index files that a root index (minor) names."""
    own = root.select(F.lit(MAJORS["index"]).alias("major"), "minor", F.lit(0).alias("fileid"))
    return Index(1, lambda f: own.withColumns(_ids(F.col("minor"))))


def root_index_file(spark) -> Index:
    return Index(0, lambda f: spark.range(1).select(F.lit(MAJORS["index"]).alias("major"), F.lit(255).alias("minor"), F.lit(0).alias("fileid")))


# fixed values: the record modes of a cache, and which index each has
MODES = (
    ("framemaps", "chunked", 1),
    ("items", "chunked", 19),
    ("enums", "chunked", 17),
    ("npcs", "chunked", 18),
    ("soundjson", "standard but 0", 14),
    ("musicjson", "standard but 0", 40),
    ("objects", "chunked", 16),
    ("achievements", "chunked", 57),
    ("structs", "chunked", 22),
    ("sequences", "chunked", 20),
    ("spotanims", "chunked", 21),
    ("materials", "chunked", 26),
    ("oldmaterials", "single", 26, 0),
    ("quickchatcats", "single", 24, 0),
    ("quickchatlines", "single", 24, 1),
    ("dbtables", "single", 2, 40),
    ("dbrows", "single", 2, 41),
    ("overlays", "single", 2, 4),
    ("identitykit", "single", 2, 3),
    ("params", "single", 2, 11),
    ("underlays", "single", 2, 1),
    ("mapscenes", "single", 2, 34),
    ("environments", "single", 2, 29),
    ("animgroupconfigs", "single", 2, 32),
    ("maplabels", "single", 2, 36),
    ("mapzones", "single", 23, 0),
    ("cutscenes", "plain", 66),
    ("particles0", "single", 27, 0),
    ("particles1", "single", 27, 1),
    ("maptiles", "squares", 3),
    ("maptiles_nxt", "squares", 5),
    ("maplocations", "squares", 0),
    ("mapenvs", "squares", 6),
    ("maptiles_old", "old squares", "m"),
    ("maplocations_old", "old squares", "l"),
    ("frames", "standard", 48),
    ("models", "plain", 47),
    ("oldmodels", "plain", 7),
    ("skeletons", "plain", 56),
    ("proctextures", "plain", 9),
    ("oldproctextures", "single", 9, 0),
    ("interfaces", "standard", 3),
    ("classicmodels", "single", 0, 0),
    ("indices", "index files"),
    ("rootindex", "root"),
    ("test", "any"),
    ("clientscriptops", "plain", 12),
)


def index_of(spark, kind: str, *args, root: DataFrame | None = None) -> Index:
    """The index of a row of MODES."""
    if kind == "standard but 0":
        return without(standard(*args), spark.createDataFrame([(args[0], 0)], "major int, minor int"))
    if kind == "old squares":
        return old_world_map(spark, *args)
    if kind == "index files":
        return index_files(root if root is not None else spark.createDataFrame([], "minor int"))
    if kind == "root":
        return root_index_file(spark)
    return {"standard": standard, "chunked": chunked, "single": single_minor, "plain": no_archive, "squares": world_map, "any": any_file}[kind](*args)


def load_layouts(folder: str) -> dict[str, object]:
    """Layouts by name from a folder of .json and .jsonc files (JSON with comments) that describe records, as decode takes them."""
    import json
    import pathlib
    import re

    out = {}
    for f in sorted(pathlib.Path(folder).glob("*.json*")):
        text = f.read_text()
        # comments outside of texts, then commas before an end
        text = re.sub(r'("(?:\\.|[^"\\])*")|//[^\n]*|/\*.*?\*/', lambda m: m[1] or "", text, flags=re.S)
        out[f.name.partition(".")[0]] = json.loads(re.sub(r'("(?:\\.|[^"\\])*")|,(?=\s*[\]}])', lambda m: m[1] or "", text))
    return out


class Modes:
    """Named views of a cache: an index and, where its files are records, the layout that decodes them."""

    def __init__(self):
        self.modes: dict[str, tuple[Index, object | None]] = {}

    @staticmethod
    def standard(spark, layouts: dict[str, object] | None = None, root: DataFrame | None = None) -> Modes:
        """All of MODES, with the layouts given by mode."""
        out = Modes()
        for name, kind, *args in MODES:
            out.add(name, index_of(spark, kind, *args, root=root), (layouts or {}).get(name))
        return out

    def add(self, name: str, index: Index, layout: object | None = None) -> None:
        self.modes[name] = (index, layout)

    def view(self, name: str, files: DataFrame, build: int, ranges: str | None = None, aliases: dict | None = None) -> DataFrame:
        """id0, ..., value, error of the mode's files (major, minor, fileid, bytes); without a layout the bytes as they are."""
        from tessera.operators.decode import decode

        index, layout = self.modes[name]
        rows = index.files(files, ranges)
        if layout is None:
            return rows.select(*index.ids(), "bytes")
        return decode(rows.select(*index.ids(), "bytes"), "bytes", layout, build, aliases)

    def register(self, files: DataFrame, build: int, aliases: dict | None = None) -> None:
        """A temporary view for each mode, read when it is asked for."""
        for name in self.modes:
            self.view(name, files, build, None, aliases).createOrReplaceTempView(name)
