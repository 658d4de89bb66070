"""The fixed tables: their types, making them, copying them, and the view of all teleports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

_AREA = lambda p: f"{p}_min_x int, {p}_max_x int, {p}_min_y int, {p}_max_y int, {p}_plane int"
_POINT = lambda p: f"{p}_x int, {p}_y int, {p}_plane int"
_NEXT = "next_node_type string, next_node_id int"



def _struct(columns: str) -> StructType:
    kinds = {"int": IntegerType(), "long": LongType(), "string": StringType()}
    return StructType([StructField(n, kinds[k]) for n, k in (c.split() for c in columns.split(", "))])


# fixed values: the tables
TABLES: dict[str, StructType] = {
    name: _struct(columns)
    for name, columns in {
        "teleports_door_nodes": f"id int, direction string, real_id_open int, real_id_closed int, {_POINT('location_open')}, {_POINT('location_closed')}, {_POINT('tile_inside')}, {_POINT('tile_outside')}, open_action string, cost int, {_NEXT}, requirements string",
        "teleports_ifslot_nodes": f"id int, interface_id int, component_id int, slot_id int, click_id int, {_AREA('dest')}, cost int, {_NEXT}, requirements string",
        "teleports_item_nodes": f"id int, match_type string, name string, item_id int, action string, {_AREA('dest')}, {_NEXT}, cost int, requirements string",
        "teleports_lodestone_nodes": f"id int, lodestone string, {_POINT('dest')}, cost int, {_NEXT}, requirements string",
        "teleports_npc_nodes": f"id int, match_type string, npc_id int, npc_name string, action string, {_AREA('dest')}, search_radius int, cost int, {_AREA('orig')}, {_NEXT}, requirements string",
        "teleports_object_nodes": f"id int, match_type string, object_id int, object_name string, action string, {_AREA('dest')}, {_AREA('orig')}, search_radius int, cost int, {_NEXT}, requirements string",
        "teleports_fairy_rings_nodes": f"id int, object_id int, x int, y int, plane int, cost int, code string, action string, {_NEXT}, requirements string",
        "teleports_requirements": "id int, metaInfo string, key string, value string, comparison string",
        "tiles": "x int, y int, plane int, walk_mask long, RegionID int",
    }.items()
}

# fixed values: where each kind of teleport begins and ends in the view; fairy rings are not in it
_VIEW = (
    ("door", "teleports_door_nodes", "tile_outside_x", "tile_outside_y", "tile_outside_plane", "tile_inside_x", "tile_inside_y", "tile_inside_plane"),
    ("lodestone", "teleports_lodestone_nodes", None, None, None, "dest_x", "dest_y", "dest_plane"),
    ("npc", "teleports_npc_nodes", "orig_min_x", "orig_min_y", "orig_plane", "dest_min_x", "dest_min_y", "dest_plane"),
    ("object", "teleports_object_nodes", "orig_min_x", "orig_min_y", "orig_plane", "dest_min_x", "dest_min_y", "dest_plane"),
    ("item", "teleports_item_nodes", None, None, None, "dest_min_x", "dest_min_y", "dest_plane"),
    ("ifslot", "teleports_ifslot_nodes", None, None, None, "dest_min_x", "dest_min_y", "dest_plane"),
)


def has_tables(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database) and any(not t.isTemporary for t in spark.catalog.listTables(database))


def create_tables(spark: SparkSession, database: str) -> None:
    """All of TABLES, empty; a database that has tables is refused. What an index would do is left to partitions: tiles go by region."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if has_tables(spark, database):
        raise ValueError(f"{database} has tables already")
    for name, schema in TABLES.items():
        w = spark.createDataFrame([], schema).write.mode("error").format("parquet")
        (w.partitionBy("RegionID") if name == "tiles" else w).saveAsTable(f"`{database}`.{name}")
    make_view(spark, database)


def describe(spark: SparkSession, database: str) -> dict[str, StructType]:
    """Tables of a database with their types."""
    return {t.name: spark.table(f"`{database}`.{t.name}").schema for t in spark.catalog.listTables(database) if t.tableType != "VIEW" and not t.isTemporary}


def copy_tables(spark: SparkSession, database: str, to: str, skip: tuple[str, ...] = ("tiles",)) -> list[str]:
    """Tables of a database but some, with their partitions, into another; their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{to}`")
    done = []
    for name in sorted(describe(spark, database)):
        if name in skip:
            continue
        w = spark.table(f"`{database}`.{name}").write.mode("error").format("parquet")
        by = [c.name for c in spark.catalog.listColumns(f"`{database}`.{name}") if c.isPartition]
        (w.partitionBy(*by) if by else w).saveAsTable(f"`{to}`.{name}")
        done.append(name)
    return done


def teleports_all(tables: dict[str, DataFrame]) -> DataFrame:
    """kind, id, src_x, src_y, src_plane, dst_x, dst_y, dst_plane, cost, requirements of the teleports of six kinds: where one begins is null for those that work anywhere; of areas the least corner counts. Interface slots without a place are left out."""
    names = ("src_x", "src_y", "src_plane", "dst_x", "dst_y", "dst_plane")

    def one(kind: str, table: str, *at: str | None) -> DataFrame:
        rows = tables[table]
        if kind == "ifslot":
            rows = rows.where("dest_min_x IS NOT NULL")
        return rows.select(F.lit(kind).alias("kind"), "id", *((F.col(c) if c else F.lit(None).cast("int")).alias(n) for c, n in zip(at, names, strict=True)), "cost", "requirements")

    return reduce(DataFrame.unionAll, (one(*v) for v in _VIEW))


def make_view(spark: SparkSession, database: str) -> None:
    """The view teleports_all of a database."""
    parts = [f"SELECT '{kind}' AS kind, id, {', '.join(f'{c or "CAST(NULL AS INT)"} AS {n}' for c, n in zip(at, ('src_x', 'src_y', 'src_plane', 'dst_x', 'dst_y', 'dst_plane'), strict=True))}, cost, requirements FROM `{database}`.{table}{' WHERE dest_min_x IS NOT NULL' if kind == 'ifslot' else ''}" for kind, table, *at in _VIEW]
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.teleports_all AS {' UNION ALL '.join(parts)}")


def copy_views(spark: SparkSession, database: str, to: str) -> list[str]:
    """Views that can be made again over another database's tables; those that can't are passed over. Names of the made ones."""
    done = []
    for t in spark.catalog.listTables(database):
        if t.tableType == "VIEW" and not t.isTemporary:
            text = spark.sql(f"SHOW CREATE TABLE `{database}`.{t.name}").first()[0]
            try:
                spark.sql(text.replace(f"{database}.", f"{to}.").replace(f"`{database}`", f"`{to}`"))
                done.append(t.name)
            except Exception:  # a view of what isn't there is no reason to stop
                continue
    return done


def area_edges(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(doors: ax, ay, bx, by; areas: kind and bounds) as graph.teleport_edges takes them."""
    doors = tables["teleports_door_nodes"].select(F.col("tile_outside_x").alias("ax"), F.col("tile_outside_y").alias("ay"), F.col("tile_inside_x").alias("bx"), F.col("tile_inside_y").alias("by"))
    bounds = [f"{a}_{b}_{c}" for a in ("orig", "dest") for b in ("min", "max") for c in ("x", "y")]
    areas = tables["teleports_object_nodes"].select(F.lit("object").alias("kind"), *bounds).unionAll(tables["teleports_npc_nodes"].select(F.lit("npc").alias("kind"), *bounds))
    return doors, areas


def teleport_ends(tables: dict[str, DataFrame]) -> DataFrame:
    """x, y, plane of all ends at which reachability may begin: both of doors, objects and NPCs, where lodestones, items and interface slots lead, and fairy rings.

    A null in a door or lodestone stops the query; other rows with one are left out.
    """
    from tessera.functions.masks import centre

    need = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast("int"))
    point = lambda t, p: tables[t].select(*(need(f"{p}_{c}").alias(c) for c in ("x", "y", "plane")))

    def mid(t: str, p: str, also: str | None = None) -> DataFrame:
        both = [q for q in (p, also) if q]
        cols = [f"{q}_{b}" for q in both for b in ("min_x", "max_x", "min_y", "max_y", "plane")]
        return tables[t].na.drop(subset=cols).select(centre(F.col(f"{p}_min_x"), F.col(f"{p}_max_x")).cast("int").alias("x"), centre(F.col(f"{p}_min_y"), F.col(f"{p}_max_y")).cast("int").alias("y"), F.col(f"{p}_plane").alias("plane"))

    parts = [point("teleports_door_nodes", "tile_outside"), point("teleports_door_nodes", "tile_inside"), point("teleports_lodestone_nodes", "dest")]
    for t in ("teleports_object_nodes", "teleports_npc_nodes"):
        parts += [mid(t, "orig", "dest"), mid(t, "dest", "orig")]
    parts += [mid("teleports_item_nodes", "dest"), mid("teleports_ifslot_nodes", "dest")]
    return reduce(DataFrame.unionAll, parts)
