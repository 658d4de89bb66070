"""Commands: python -m tessera.cli <command> ... Each is a function of a session and paths too, which returns a DataFrame or writes one."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import assets, indexes, lookups, spatial, tiles, versions, vm
from tessera.operators.decode import decode, decode_report
from tessera.plans.cut import cut
from tessera.sources import containers, schema, sheets, sinks, tables

# -- tiles --------------------------------------------------------------------------------------------


def load_tiles(spark: SparkSession, walk: str, out: str, overrides: str | None = None) -> None:
    """Walk files into tiles, in folders by region: of a tile the last of file and place in it counts, then overrides, of which the last line counts."""
    rows = tables.walk_json(spark, walk)
    t = tiles.latest_wins(rows, "file", "pos").select("x", "y", "plane", "walk_mask", "RegionID")
    if overrides:
        o = tables.overrides_text(spark, overrides)
        last = o.groupBy("x", "y", "plane").agg(F.max_by("walk_mask", "line").cast("long").alias("_o"))
        both = t.join(last, tiles.KEY, "full")
        t = both.select(*tiles.KEY, F.coalesce("_o", "walk_mask").alias("walk_mask"), F.coalesce("RegionID", tiles.region_id(F.col("x"), F.col("y"))).alias("RegionID"))
    t.write.mode("overwrite").partitionBy("RegionID").parquet(out)


def clean_tiles(spark: SparkSession, tiles_: str, teleports: dict[str, DataFrame], start: tuple[int, int, int], out: str) -> None:
    """The tiles that can be reached from start and all teleports, with masks that lead only to such tiles; fairy rings are forced open before and after."""
    t = spark.read.parquet(tiles_)
    rings = teleports.get("teleports_fairy_rings_nodes")
    forced = cut(tiles.ring_overrides(rings if rings is not None else spark.createDataFrame([], schema.TABLES["teleports_fairy_rings_nodes"])))
    own = cut(tiles.reconcile(tiles.apply_overrides(t, forced)))
    begin = spark.createDataFrame([start], "x int, y int, plane int")
    reached = tiles.reachable(own, tiles.seeds(begin, schema.teleport_ends(teleports), forced))
    tiles.put_back(tiles.sanitise(own, reached), forced).write.mode("overwrite").partitionBy("RegionID").parquet(out)


def walk_flags(tiles_: DataFrame, out: str) -> None:
    """Walk files from tiles (x, y, plane, shut, centre), a line for each square."""
    planes = [r["plane"] for r in tiles_.select("plane").distinct().collect()]  # four at most
    done = None
    for p in planes:
        b = spatial.blocked(tiles_.where(F.col("plane") == p)).select("x", "y", F.lit(p).alias("plane"), (255 - F.col("blocked")).alias("walk_mask"))
        done = b if done is None else done.unionAll(b)
    if done is not None:
        sinks.write_walk_json(done, out)


# -- caches -------------------------------------------------------------------------------------------


def files_of(spark: SparkSession, source: str, build: int) -> DataFrame:
    """major, minor, fileid, namehash, bytes of all files of a SQLite cache: its index files say what its archives hold."""
    spark.dataSource.register(containers.JcacheSource)
    place = source.partition(":")[2] or source
    index = containers.indices(containers.decompressed(spark.read.format("jcache").option("index", "true").load(place).select("major", "data")).select("major", "data"), build)
    blobs = containers.decompressed(spark.read.format("jcache").load(place).select("major", "minor", "data"))
    both = blobs.where("error IS NULL").join(index.where("error IS NULL").select("major", "minor", "subindices", "subnames"), ["major", "minor"])
    return containers.unpacked(both, "table")


def extract(spark: SparkSession, files: DataFrame, mode: str, modes: indexes.Modes, out: str, ranges: str | None = None, build: int = 0, layout: str = "files", batch: int = 0) -> None:
    """Records of a mode as JSON: files (one for each archive), batch (at most batch rows to a file) or single (one file)."""
    rows = modes.view(mode, files, build, ranges)
    first = [c for c in rows.columns if c.startswith("id")]
    rows = rows.orderBy(*first)
    if layout == "single":
        rows.coalesce(1).write.mode("overwrite").json(out)
    elif layout == "batch":
        rows.write.mode("overwrite").option("maxRecordsPerFile", batch or 1000).json(out)
    else:
        rows.withColumn("archive", F.col(first[0])).write.mode("overwrite").partitionBy("archive").json(out)


def edit(spark: SparkSession, files: DataFrame, edits: DataFrame, folder: str) -> None:
    """Archives written again with edited files in a SQLite cache."""
    whole = containers.packed(cut(containers.merged_edits(files, edits)), "table")
    containers.write_blobs(whole.select("major", "minor", "data"), folder)


def overview(index: DataFrame) -> DataFrame:
    return assets.index_overview(index.select("major", "minor", F.coalesce("size", F.lit(0)).alias("size")))


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """major, minor, fileid, change between the files of two caches, of majors that both have."""
    both = old.select("major").distinct().join(new.select("major").distinct(), "major")
    in_both = lambda d: d.join(both, "major", "left_semi")
    return assets.snapshot_diff(in_both(old), in_both(new), ["major", "minor", "fileid"], "bytes")


def test_decode(files: DataFrame, mode: str, layout: object, build: int, keep=None, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """How many files (id, bytes) of a mode decode, and the first errors, smallest files first; keep: a function from files to the files to try."""
    rows = files if keep is None else keep(files)
    return decode_report(cut(decode(rows.select("id", "bytes"), "bytes", layout, build)), mode, most)


def historic_decode(caches: DataFrame, before: str, files_in, mode: str, layout: object, most: int = 20) -> DataFrame:
    """mode, build, passed, failed for each cache before a date; files_in(build) gives its files (id, bytes). Stops after `most` failing builds."""
    out, failing = None, 0
    for r in versions.in_order(versions.before(caches, before)).collect():  # a catalogue of versions
        counts, _ = test_decode(files_in(r["build"]), mode, layout, r["build"])
        counts = cut(counts.withColumn("build", F.lit(r["build"])))
        out = counts if out is None else out.unionAll(counts)
        failing += counts.first()["failed"] > 0
        if failing >= most:
            break
    return out


def file_history(rows: DataFrame, all_versions: DataFrame) -> DataFrame:
    """key, run, value, versions of each file over all versions."""
    return assets.file_history(rows, all_versions, "key", "version", "value")


def quick_chat(categories: DataFrame, lines: DataFrame) -> DataFrame:
    """category, depth, path, place, line, text of all chat lines that can be reached."""
    return lookups.chat_hotkeys(categories).join(lookups.chat_lines(categories, lines), "category")


def cache_ids(caches: DataFrame, date: str | None = None, near: int | None = None) -> DataFrame:
    out = versions.between(caches, date) if date else caches
    return versions.near(out, near) if near is not None else versions.in_order(out)


clue_coords, sequence_groups, game_interfaces, script_module = lookups.clue_places, lookups.skeleton_groups, lookups.chain, vm.references


def scrape_avatars(*_) -> None:
    raise NotImplementedError("needs a network")


# -- the command line ---------------------------------------------------------------------------------


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *args: str, **options) -> None:
        c = sub.add_parser(name)
        for a in args:
            c.add_argument(a)
        for k, default in options.items():
            c.add_argument(f"--{k.replace('_', '-')}", default=default, **({"action": "store_true"} if default is False else {}))

    command("load-tiles", "walk", "out", overrides=None)
    command("import-xlsx", "workbook", "folder", sheets=None, truncate=False, dry_run=False)
    command("tile-cleaner", "tiles", "teleports", "out", start="3200,3200,0")
    command("extract", "source", "out", mode="items", ids=None, build=940, layouts=None, layout="files", batch=0)
    command("indexoverview", "source", "out", build=940)
    command("diff", "old", "new", "out", build=940)
    command("testdecode", "source", "out", mode="items", build=940, layouts=None)
    command("openrs2ids", "catalog", "out", date=None, near=None)
    command("failures", "log", "out")
    command("coordinates", "text", "out", head="", foot="")
    command("scrapeavatars")
    a = p.parse_args(argv)
    if a.command == "scrapeavatars":
        scrape_avatars()
    spark = SparkSession.builder.getOrCreate()
    if a.command == "load-tiles":
        load_tiles(spark, a.walk, a.out, a.overrides)
    elif a.command == "import-xlsx":
        r = sheets.import_workbook(spark, a.workbook, a.folder, schema.TABLES, a.sheets.split(",") if a.sheets else None, a.truncate, a.dry_run)
        print(r)
    elif a.command == "tile-cleaner":
        found = {n: spark.read.schema(s).parquet(f"{a.teleports}/{n}") for n, s in schema.TABLES.items() if n.startswith("teleports_")}
        clean_tiles(spark, a.tiles, found, tuple(map(int, a.start.split(","))), a.out)
    elif a.command in ("extract", "testdecode"):
        layouts = indexes.load_layouts(a.layouts) if a.layouts else {}
        files = files_of(spark, a.source, int(a.build))
        modes = indexes.Modes.standard(spark, layouts)
        if a.command == "extract":
            extract(spark, files, a.mode, modes, a.out, a.ids, int(a.build), a.layout, int(a.batch))
        else:
            rows = modes.modes[a.mode][0].files(files).select(F.col("id0").alias("id"), "bytes")
            test_decode(rows, a.mode, layouts[a.mode], int(a.build))[0].write.mode("overwrite").json(a.out)
    elif a.command == "indexoverview":
        spark.dataSource.register(containers.JcacheSource)
        raw = containers.decompressed(spark.read.format("jcache").option("index", "true").load(a.source).select("major", "data"))
        overview(containers.indices(raw.select("major", "data"), int(a.build))).write.mode("overwrite").json(a.out)
    elif a.command == "diff":
        diff(files_of(spark, a.old, int(a.build)), files_of(spark, a.new, int(a.build))).write.mode("overwrite").json(a.out)
    elif a.command == "openrs2ids":
        cache_ids(spark.read.parquet(a.catalog), a.date, int(a.near) if a.near else None).write.mode("overwrite").json(a.out)
    elif a.command == "failures":
        sinks.write_failures(tables.failures_log(spark, a.log), a.out)
    elif a.command == "coordinates":
        points = tables.coordinates_text(spark, a.text).withColumn("n", F.monotonically_increasing_id())
        sinks.coordinate_lines(points, a.head, a.foot).write.mode("overwrite").text(a.out)


if __name__ == "__main__":
    main()
