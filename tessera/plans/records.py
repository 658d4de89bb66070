"""Queries of the containers, logical indexes, records, scripts, squares, versions and images, over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import checksums, hashes, markup, text, vm
from tessera.operators import assets, dependencies, images, indexes, lookups, squares, versions
from tessera.operators import vm as machine
from tessera.operators.decode import decode
from tessera.operators.encode import encode
from tessera.plans import grid
from tessera.plans.register import query
from tessera.sources import containers, schema, sheets
from tessera.sources.tables import table

T = f"WITH {grid.TILES_SQL} "

# -- logical indexes ----------------------------------------------------------------------------------

_FILES = "SELECT CAST(CASE l_suppkey % 5 WHEN 0 THEN 5 WHEN 1 THEN 19 WHEN 2 THEN 2 WHEN 3 THEN 47 ELSE 8 END AS INT) AS major, CAST(l_orderkey % 2000 AS INT) AS minor, CAST(l_linenumber AS INT) AS fileid, l_partkey, l_suppkey, l_orderkey FROM lineitem"


def _files(spark, d):
    return spark.sql(_FILES.replace("FROM lineitem", "FROM {rows}"), rows=table(spark, d, "lineitem"))


_KEPT = "major, minor, fileid, l_partkey, l_suppkey, l_orderkey"


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT} FROM f WHERE (major, minor, fileid) >= (5, 3, 2) AND (major, minor, fileid) <= (8, 700, 1) OR (major, minor) >= (19, 40) OR (major = 2 AND minor = 77)")
def id_ranges_three_parts(spark, d):
    f = _files(spark, d)
    return f.where(indexes.in_ranges([F.col("major"), F.col("minor"), F.col("fileid")], "5.3.2-8.700.1, 19.40-,2.77"))


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT}, CAST(minor AS BIGINT) AS id0, CAST(fileid AS BIGINT) AS id1 FROM f WHERE major = 8 AND (minor > 3 OR minor = 3 AND fileid >= 2) AND (minor < 900 OR minor = 900 AND fileid <= 4)")
def index_standard(spark, d):
    return indexes.standard(8).files(_files(spark, d), "3.2-900.4")


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT}, CAST(minor AS BIGINT) * 256 + fileid AS id0 FROM f WHERE major = 19 AND minor * 256 + fileid BETWEEN 1000 AND 400000")
def index_chunked(spark, d):
    return indexes.chunked(19).files(_files(spark, d), "1000-400000")


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT}, CAST(fileid AS BIGINT) AS id0 FROM f WHERE major = 2 AND minor = 40")
def index_single_minor(spark, d):
    return indexes.single_minor(2, 40).files(_files(spark, d))


@query(f"WITH f AS ({_FILES}) SELECT major, minor, 0 AS fileid, count(*) AS n, CAST(minor AS BIGINT) AS id0 FROM f WHERE major = 47 GROUP BY 1, 2 HAVING minor <= 500")
def index_without_archives(spark, d):
    f = _files(spark, d).groupBy("major", "minor").agg(F.lit(0).alias("fileid"), F.count("*").alias("n")).select("major", "minor", "fileid", "n")
    return indexes.no_archive(47).files(f, "0-500")


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT}, CAST(major AS BIGINT) AS id0, CAST(minor AS BIGINT) AS id1, CAST(fileid AS BIGINT) AS id2 FROM f WHERE major = 5 AND (minor, fileid) >= (10, 3) AND minor <= 90")
def index_any_file(spark, d):
    return indexes.any_file().files(_files(spark, d), "5.10.3-5.90")


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT}, CAST(minor % 128 AS BIGINT) AS id0, CAST(minor // 128 AS BIGINT) AS id1 FROM f WHERE major = 5 AND fileid = 3 AND minor % 128 BETWEEN 20 AND 90 AND minor // 128 BETWEEN 2 AND 11")
def index_world_map(spark, d):
    return indexes.world_map(3).box(_files(spark, d), (20, 90), (2, 11))


_HASH31 = "list_reduce(list_prepend(0::HUGEINT, list_transform(string_split({}, ''), lambda c: ascii(c)::HUGEINT)), lambda a, c: (a * 31 + c) % 4294967296)"


@query("WITH f AS (SELECT DISTINCT CAST(l_partkey % 120 AS INT) AS x, CAST(l_orderkey % 210 AS INT) AS z FROM lineitem) SELECT CAST(5 AS INT) AS major, x * 1000 + z AS minor, 0 AS fileid, CAST(" + _HASH31.format("'m' || x || '_' || z") + " AS BIGINT) AS name, CAST(x AS BIGINT) AS id0, CAST(z AS BIGINT) AS id1 FROM f WHERE x BETWEEN 7 AND 100 AND z BETWEEN 3 AND 200")
def index_old_world_map(spark, d):
    f = table(spark, d, "lineitem").selectExpr("cast(l_partkey % 120 as int) x", "cast(l_orderkey % 210 as int) z").distinct()
    named = text.name_hash(F.concat(F.lit("m"), F.col("x").cast("string"), F.lit("_"), F.col("z").cast("string")))
    files = f.select(F.lit(5).alias("major"), (F.col("x") * 1000 + F.col("z")).alias("minor"), F.lit(0).alias("fileid"), named.alias("name"))
    return indexes.old_world_map(spark, "m").box(files, (7, 100), (3, 200)).select("major", "minor", "fileid", "name", "id0", "id1")


@query(f"WITH f AS ({_FILES}) SELECT {_KEPT}, CAST(minor AS BIGINT) AS id0, CAST(fileid AS BIGINT) AS id1 FROM f WHERE major = 8 AND minor NOT IN (SELECT p_partkey % 2000 FROM part WHERE p_size > 30)")
def index_without_blacklist(spark, d):
    black = table(spark, d, "part").where("p_size > 30").selectExpr("8 major", "cast(p_partkey % 2000 as int) minor")
    return indexes.without(indexes.standard(8), black).files(_files(spark, d))


@query("SELECT 255 AS major, CAST(s_suppkey AS INT) AS minor, 0 AS fileid, s_suppkey AS id0 FROM supplier WHERE s_suppkey BETWEEN 5 AND 60")
def index_of_index_files(spark, d):
    root = table(spark, d, "supplier").selectExpr("cast(s_suppkey as int) minor")
    return indexes.index_files(root).files(root, "5-60")


_STRIDE = "CASE major WHEN 19 THEN 256 WHEN 18 THEN 128 WHEN 22 THEN 32 WHEN 17 THEN 256 WHEN 16 THEN 256 WHEN 20 THEN 128 WHEN 21 THEN 256 WHEN 57 THEN 128 WHEN 26 THEN 9007199254740991 ELSE 1 END"
_PAGE = "CASE WHEN build < 488 THEN CASE major WHEN 16 THEN 6 WHEN 18 THEN 9 WHEN 19 THEN 10 WHEN 21 THEN 13 END END"


@query(f"WITH o AS (SELECT o_orderkey AS k, 15 + o_custkey % 13 AS major, 400 + o_orderkey % 200 AS build FROM orders) SELECT k, CAST(CASE WHEN {_PAGE} IS NULL THEN major ELSE 2 END AS BIGINT) AS major2, CAST(CASE WHEN {_PAGE} IS NULL THEN k // {_STRIDE} ELSE {_PAGE} END AS BIGINT) AS minor, CAST(CASE WHEN {_PAGE} IS NULL THEN k % {_STRIDE} ELSE k END AS BIGINT) AS subid, CAST(k % 64 + (k // 64) * 64 AS BIGINT) AS again FROM o")
def file_places(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey k", "15 + o_custkey % 13 major", "400 + o_orderkey % 200 build")
    p = o.withColumn("p", indexes.place_of(F.col("major"), F.col("k"), F.col("build"))).withColumn("t", indexes.tile_place(F.col("k")))
    return p.select("k", F.col("p.major").alias("major2"), "p.minor", "p.subid", indexes.tile_index(F.col("t.x"), F.col("t.z"), F.col("t.level")).cast("long").alias("again"))


# -- containers ---------------------------------------------------------------------------------------

_PARTS = "SELECT CAST(7 AS INT) AS major, CAST(p_size AS INT) AS minor, CAST(row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS INT) - 1 AS fileid, p_name AS name FROM part"


def _archives(spark, d):
    p = spark.sql(_PARTS.replace("FROM part", "FROM {rows}"), rows=table(spark, d, "part"))
    return p.select("major", "minor", "fileid", F.encode("name", "UTF-8").alias("bytes"))


def _round_trip(spark, d, form):
    packed = containers.packed(_archives(spark, d), form).withColumn("subnames", F.lit(None).cast("array<long>"))
    out = containers.unpacked(packed, form)
    return out.where(F.when(F.col("error").isNull(), True).otherwise(F.raise_error("error").cast("boolean"))).select("major", "minor", "fileid", F.decode("bytes", "UTF-8").alias("name"))


@query(_PARTS)
def archives_network(spark, d):
    return _round_trip(spark, d, "network")


@query(_PARTS)
def archives_table(spark, d):
    return _round_trip(spark, d, "table")


@query("SELECT 7 AS major, CAST(p_size AS INT) AS minor, CAST(sum(length(p_name)) AS BIGINT) AS size FROM part GROUP BY p_size")
def archive_sizes(spark, d):
    return containers.archive_sizes(_archives(spark, d))


@query(f"WITH p AS ({_PARTS}) SELECT major, minor, fileid, CASE WHEN minor % 2 = 0 AND fileid % 3 = 0 THEN 'new ' || name ELSE name END AS name FROM p WHERE minor IN (SELECT minor FROM p WHERE minor % 2 = 0 AND fileid % 3 = 0)")
def archive_edits(spark, d):
    old = _archives(spark, d)
    new = old.where("minor % 2 = 0 AND fileid % 3 = 0").withColumn("bytes", F.encode(F.concat(F.lit("new "), F.decode("bytes", "UTF-8")), "UTF-8"))
    return containers.merged_edits(old, new).select("major", "minor", "fileid", F.decode("bytes", "UTF-8").alias("name"))


@query("SELECT p_partkey, p_name, NULL::VARCHAR AS error FROM part")
def blobs_decompressed(spark, d):
    """Every part's name packed in one of four ways, and unpacked again."""
    kinds = ("sqlite", "none", "bzip2", "gzip")

    def run(frames):
        for f in frames:
            yield f.assign(data=[containers.compress(n.encode(), kinds[k % 4]) for k, n in zip(f["p_partkey"], f["p_name"], strict=True)]).drop(columns="p_name")

    blobs = table(spark, d, "part").select("p_partkey", "p_name").mapInPandas(run, "p_partkey long, data binary")
    return containers.decompressed(blobs).select("p_partkey", F.decode("data", "UTF-8").alias("p_name"), "error")


@query("WITH o AS (SELECT DISTINCT CAST(o_custkey % 40 AS INT) AS major, CAST(o_orderkey % 3000 AS INT) AS minor FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY major ORDER BY minor) AS k FROM o) SELECT major, minor, CAST(minor * 7 + major AS BIGINT) AS crc, CAST(k AS BIGINT) AS version, CAST(2 AS INT) AS subindexcount, [minor % 9, minor % 9 + 4]::VARCHAR AS subindices FROM n")
def index_files_decoded(spark, d):
    """An index file for each major, made of its rows, and decoded again."""
    o = table(spark, d, "orders").selectExpr("cast(o_custkey % 40 as int) major", "cast(o_orderkey % 3000 as int) minor").distinct()
    rows = o.groupBy("major").agg(F.array_sort(F.collect_list("minor")).alias("m"))  # at most 3000 each
    hexed = lambda col, n: F.array_join(F.transform(col, lambda v: F.lpad(F.hex(v.cast("long")), 2 * n, "0")), "")
    steps = F.transform("m", lambda v, i: v - F.when(i > 0, F.get("m", i - 1)).otherwise(0))
    crc, version = F.transform("m", lambda v: v * 7 + F.col("major")), F.transform("m", lambda v, i: i + 1)
    subs = F.flatten(F.transform("m", lambda v: F.array(v % 9, F.lit(4))))
    data = F.concat(F.lit("0500"), F.lpad(F.hex(F.size("m").cast("long")), 4, "0"), hexed(steps, 2), hexed(crc, 4), hexed(version, 4), hexed(F.transform("m", lambda v: F.lit(2)), 2), hexed(subs, 2))
    out = containers.indices(rows.select("major", F.unhex(data).alias("data")), 900)
    out = out.where(F.when(F.col("error").isNull(), True).otherwise(F.raise_error("error").cast("boolean")))
    listed = F.concat(F.lit("["), F.array_join(F.transform("subindices", lambda v: v.cast("string")), ", "), F.lit("]"))
    return out.select("major", "minor", "crc", "version", "subindexcount", listed.alias("subindices"))


@query("WITH i AS (SELECT CAST(p_size AS INT) AS major, CAST(p_partkey AS INT) AS minor, p_brand FROM part), n AS (SELECT DISTINCT 'Brand#' || (s_suppkey % 60) AS name FROM supplier) SELECT name, major, min(minor) AS minor FROM n JOIN i ON p_brand = name GROUP BY 1, 2")
def files_by_name(spark, d):
    index = table(spark, d, "part").select(F.col("p_size").cast("int").alias("major"), F.col("p_partkey").cast("int").alias("minor"), text.name_hash(F.col("p_brand")).alias("name"))
    names = table(spark, d, "supplier").select(F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 60).cast("string")).alias("name")).distinct()
    return containers.by_name(index, names)


@query("SELECT name, major, min(minor) AS minor FROM (SELECT *, min(major) OVER (PARTITION BY name) AS first FROM (SELECT p_brand AS name, CAST(p_size AS INT) AS major, CAST(p_partkey AS INT) AS minor FROM part)) WHERE major = first GROUP BY 1, 2")
def any_file_by_name(spark, d):
    p = table(spark, d, "part")
    index = p.select(F.col("p_size").cast("int").alias("major"), F.col("p_partkey").cast("int").alias("minor"), text.name_hash(F.col("p_brand")).alias("name"))
    return containers.any_named(index, p.select(F.col("p_brand").alias("name")).distinct())


@query("WITH w AS (SELECT CAST(o_custkey % 7 AS INT) AS major, CAST(o_orderkey AS INT) AS minor, o_custkey AS crc FROM orders) SELECT major, minor, crc, CASE WHEN minor % 3 = 0 AND minor % 2 = 0 THEN 'x' || minor END AS data, CASE WHEN minor % 3 <> 0 THEN 'unknown' WHEN minor % 2 = 0 THEN 'hit' ELSE 'missing' END AS state FROM w")
def blocks_cached(spark, d):
    w = table(spark, d, "orders").selectExpr("cast(o_custkey % 7 as int) major", "cast(o_orderkey as int) minor", "o_custkey crc")
    kept = w.where("minor % 3 = 0").withColumn("data", F.when(F.col("minor") % 2 == 0, F.encode(F.concat(F.lit("x"), F.col("minor").cast("string")), "UTF-8")))
    return containers.with_cached(w, kept).withColumn("data", F.decode("data", "UTF-8"))


@query("SELECT e AS extension, count(*) AS files FROM (SELECT CASE l_suppkey % 3 WHEN 0 THEN 'jcache' WHEN 1 THEN 'dat' ELSE '' END AS e FROM lineitem) GROUP BY 1")
def file_types(spark, d):
    ext = F.when(F.col("l_suppkey") % 3 == 0, ".JCache").when(F.col("l_suppkey") % 3 == 1, ".dat").otherwise("")
    return containers.file_types(table(spark, d, "lineitem").select(F.concat(F.lit("a.b/file"), ext).alias("path")))


# -- records ------------------------------------------------------------------------------------------

_PLAIN = ["struct", ["key", "uint"], ["line", "ubyte"], ["part", "ushort"], ["low", "int"], ["$pad", "ushort_le"]]


@query("SELECT l_orderkey AS key, l_linenumber AS line, CAST(l_partkey % 65536 AS INT) AS part, CAST(-l_suppkey AS INT) AS low FROM lineitem")
def decode_plain_records(spark, d):
    b, c = hashes.big_endian, F.col
    data = F.concat(b(c("l_orderkey")), b(c("l_linenumber"), 1), b(c("l_partkey"), 2), b(-c("l_suppkey")), F.lit(b"\x01\x02"))
    out = decode(table(spark, d, "lineitem").select(data.alias("data")), "data", _PLAIN, 900)
    return out.where(F.when(c("error").isNull(), True).otherwise(F.raise_error("error").cast("boolean"))).select("value.*")


_RECORD = ["struct", ["$has", "ubyte"], ["order", "uint"], ["part", ["opt", ["$has", 0, "bitflag"], "varushort"]], ["flag", "string"], ["$n", "ubyte"], ["keys", ["array", ["ref", "$n"], "varint"]], ["tail", ["match", "buildnr", {">=500": "tailed varushort", "other": "ubyte"}]]]


@query("SELECT l_orderkey AS order_, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey % 30000 AS INT) END AS part, l_returnflag AS flag, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_suppkey - 40000 + l_partkey END AS keys_sum, l_partkey * 5 AS tail FROM lineitem")
def encode_round_trip(spark, d):
    c = F.col
    keys = F.when(c("l_linenumber") % 3 == 0, F.array().cast("array<int>")).otherwise(F.array((c("l_suppkey") - 40000).cast("int"), c("l_partkey").cast("int")))
    rows = table(spark, d, "lineitem").select(F.struct(c("l_orderkey").alias("order"), F.when(c("l_linenumber") % 2 == 0, (c("l_partkey") % 30000).cast("int")).alias("part"), c("l_returnflag").alias("flag"), keys.alias("keys"), (c("l_partkey") * 5).alias("tail")).alias("v"))
    sent = encode(rows, "v", _RECORD, 900)
    sent = sent.where(F.when(c("error").isNull(), True).otherwise(F.raise_error("error").cast("boolean"))).select("data")
    out = decode(sent, "data", _RECORD, 900)
    v = out.where(F.when(c("error").isNull(), True).otherwise(F.raise_error("error").cast("boolean"))).select("value.*")
    return v.select(c("order").alias("order_"), "part", "flag", F.aggregate("keys", F.lit(0).cast("long"), lambda a, x: a + x).alias("keys_sum"), "tail")


# -- sheets -------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_custkey % 3 <> 0 AS is_sheet, CASE WHEN c_custkey % 3 = 2 THEN 'https://docs.google.com/spreadsheets/d/doc' || c_custkey || '/export?format=xlsx&gid=' || c_nationkey WHEN c_custkey % 3 = 1 THEN 'https://docs.google.com/spreadsheets/d/doc' || c_custkey || '/export?format=xlsx' END AS export FROM customer")
def sheet_urls(spark, d):
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    u = F.when(k % 3 == 2, F.concat(F.lit("https://docs.google.com/spreadsheets/d/doc"), s, F.lit("/edit#gid="), F.col("c_nationkey").cast("string"))).when(k % 3 == 1, F.concat(F.lit("http://docs.google.com/spreadsheets/d/doc"), s, F.lit("/edit"))).otherwise(F.concat(F.lit("https://example.com/"), s))
    return table(spark, d, "customer").select("c_custkey", sheets.is_sheet_url(u).alias("is_sheet"), sheets.export_url(u).alias("export"))


@query("SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_acctbal = c_nationkey WHEN 1 THEN c_acctbal <> c_nationkey WHEN 2 THEN c_acctbal < c_nationkey WHEN 3 THEN c_acctbal <= c_nationkey WHEN 4 THEN c_acctbal >= c_nationkey END AS ok FROM customer")
def requirement_met(spark, d):
    how = F.get(F.array(*map(F.lit, ("=", "!=", "<", "<=", ">=", "~"))), (F.col("c_custkey") % 6).cast("int"))
    return table(spark, d, "customer").select("c_custkey", sheets.meets(F.col("c_acctbal"), how, F.col("c_nationkey")).alias("ok"))


@query("WITH o AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal FROM customer WHERE c_custkey % 3 = 0), n AS (SELECT CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey END AS id, s_acctbal AS bal, s_suppkey AS row FROM supplier), k AS (SELECT * FROM n WHERE id IS NOT NULL), b AS (SELECT coalesce(o.id, k.id) AS id, name, CASE WHEN k.id IS NOT NULL THEN k.bal ELSE o.bal END AS bal FROM o FULL JOIN k ON o.id = k.id) SELECT * FROM b UNION ALL SELECT (SELECT max(id) FROM b) + row_number() OVER (ORDER BY row), NULL, bal FROM n WHERE id IS NULL")
def sheet_upsert(spark, d):
    old = table(spark, d, "customer").where("c_custkey % 3 = 0").selectExpr("c_custkey id", "c_name name", "c_acctbal bal")
    new = table(spark, d, "supplier").selectExpr("CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey END id", "s_acctbal bal", "s_suppkey row")
    return sheets.upsert(old, new, "id", "row")


# -- teleports ----------------------------------------------------------------------------------------

_DOORS = "SELECT 'door' AS kind, CAST(o_orderkey AS INT) AS id, CAST(o_orderkey % 96 AS INT) AS src_x, CAST(o_custkey % 96 AS INT) AS src_y, 0 AS src_plane, CAST(o_orderkey % 96 + 1 AS INT) AS dst_x, CAST(o_custkey % 96 AS INT) AS dst_y, 0 AS dst_plane, 1 AS cost, NULL::VARCHAR AS requirements FROM orders WHERE o_orderstatus = 'F'"


def _nodes(spark, d) -> dict:
    """The teleport tables, made from the driver's; columns that aren't named are null."""
    made = {}

    def add(name, rows, **cols):
        out = {c.name: F.lit(None).cast(c.dataType).alias(c.name) for c in schema.TABLES[name].fields}
        out |= {k: F.expr(v).cast(schema.TABLES[name][k].dataType).alias(k) for k, v in cols.items()}
        made[name] = rows.select(*out.values())

    c, s, n, r = (table(spark, d, t) for t in ("customer", "supplier", "nation", "region"))
    add("teleports_door_nodes", table(spark, d, "orders").where("o_orderstatus = 'F'"), id="o_orderkey", tile_outside_x="o_orderkey % 96", tile_outside_y="o_custkey % 96", tile_outside_plane="0", tile_inside_x="o_orderkey % 96 + 1", tile_inside_y="o_custkey % 96", tile_inside_plane="0", cost="1")
    add("teleports_lodestone_nodes", n, id="n_nationkey", dest_x="n_nationkey * 3", dest_y="n_regionkey * 7", dest_plane="0", cost="17", requirements="'1;2'")
    add("teleports_npc_nodes", s, id="s_suppkey", orig_min_x="s_suppkey % 96", orig_max_x="s_suppkey % 5", orig_min_y="s_nationkey", orig_max_y="s_nationkey", orig_plane="0", dest_min_x="s_suppkey % 31", dest_max_x="s_suppkey % 31 + 4", dest_min_y="s_nationkey", dest_max_y="s_nationkey - 30", dest_plane="1", cost="2")
    add("teleports_object_nodes", c, id="c_custkey", orig_min_x="CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 96 END", orig_max_x="c_custkey % 7 - 5", orig_min_y="c_nationkey", orig_max_y="c_nationkey + 3", orig_plane="0", dest_min_x="c_custkey % 50", dest_max_x="c_custkey % 50 - 9", dest_min_y="c_nationkey * 2", dest_max_y="c_nationkey", dest_plane="0", cost="3")
    add("teleports_item_nodes", s, id="s_suppkey", dest_min_x="s_suppkey % 90", dest_max_x="s_suppkey % 90 + 5", dest_min_y="s_nationkey", dest_max_y="s_nationkey + 9", dest_plane="0", cost="4")
    add("teleports_ifslot_nodes", r, id="r_regionkey", dest_min_x="CASE WHEN r_regionkey <> 2 THEN r_regionkey * 20 END", dest_max_x="r_regionkey * 20 + 3", dest_min_y="r_regionkey * 20", dest_max_y="r_regionkey * 20 + 3", dest_plane="0", cost="5")
    add("teleports_fairy_rings_nodes", n, id="n_nationkey", x="n_nationkey", y="n_regionkey", plane="0")
    return made


_SIX = f"""{_DOORS}
UNION ALL SELECT 'lodestone', CAST(n_nationkey AS INT), NULL, NULL, NULL, CAST(n_nationkey * 3 AS INT), CAST(n_regionkey * 7 AS INT), 0, 17, '1;2' FROM nation
UNION ALL SELECT 'npc', CAST(s_suppkey AS INT), CAST(s_suppkey % 96 AS INT), CAST(s_nationkey AS INT), 0, CAST(s_suppkey % 31 AS INT), CAST(s_nationkey AS INT), 1, 2, NULL FROM supplier
UNION ALL SELECT 'object', CAST(c_custkey AS INT), CAST(CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 96 END AS INT), CAST(c_nationkey AS INT), 0, CAST(c_custkey % 50 AS INT), CAST(c_nationkey * 2 AS INT), 0, 3, NULL FROM customer
UNION ALL SELECT 'item', CAST(s_suppkey AS INT), NULL, NULL, NULL, CAST(s_suppkey % 90 AS INT), CAST(s_nationkey AS INT), 0, 4, NULL FROM supplier
UNION ALL SELECT 'ifslot', CAST(r_regionkey AS INT), NULL, NULL, NULL, CAST(r_regionkey * 20 AS INT), CAST(r_regionkey * 20 AS INT), 0, 5, NULL FROM region WHERE r_regionkey <> 2"""


@query(_SIX)
def teleports_of_six_kinds(spark, d):
    return schema.teleports_all(_nodes(spark, d))


def _mid(a, b):
    return f"CAST(trunc((CAST({a} AS DOUBLE) + {b}) / 2) AS INT)"


@query(f"""WITH d AS ({_DOORS}) SELECT src_x AS x, src_y AS y, 0 AS plane FROM d UNION SELECT dst_x, dst_y, 0 FROM d UNION SELECT CAST(n_nationkey * 3 AS INT), CAST(n_regionkey * 7 AS INT), 0 FROM nation
UNION SELECT {_mid('s_suppkey % 96', 's_suppkey % 5')}, CAST(s_nationkey AS INT), 0 FROM supplier UNION SELECT {_mid('s_suppkey % 31', 's_suppkey % 31 + 4')}, {_mid('s_nationkey', 's_nationkey - 30')}, 1 FROM supplier
UNION SELECT {_mid('c_custkey % 96', 'c_custkey % 7 - 5')}, {_mid('c_nationkey', 'c_nationkey + 3')}, 0 FROM customer WHERE c_custkey % 11 <> 0 UNION SELECT {_mid('c_custkey % 50', 'c_custkey % 50 - 9')}, {_mid('c_nationkey * 2', 'c_nationkey')}, 0 FROM customer WHERE c_custkey % 11 <> 0
UNION SELECT {_mid('s_suppkey % 90', 's_suppkey % 90 + 5')}, {_mid('s_nationkey', 's_nationkey + 9')}, 0 FROM supplier UNION SELECT {_mid('r_regionkey * 20', 'r_regionkey * 20 + 3')}, {_mid('r_regionkey * 20', 'r_regionkey * 20 + 3')}, 0 FROM region WHERE r_regionkey <> 2""")
def teleport_ends(spark, d):
    return schema.teleport_ends(_nodes(spark, d)).distinct()


# -- scripts ------------------------------------------------------------------------------------------

_WRAP = "CAST((({}) + 2147483648) % 4294967296 - 2147483648 AS INT)"
_POS = "((({}) % 4294967296) + 4294967296)"


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(f"{_WRAP.format(_POS.format(e))} AS {n}" for n, e in (("add_", "l_orderkey * 100003 + l_partkey"), ("sub_", "l_partkey - l_orderkey * 100003"), ("mul_", "l_orderkey * 65537 * l_partkey"))) + ", CAST(CASE WHEN l_partkey - 900 < 0 THEN -((900 - l_partkey) // (l_linenumber + 2)) ELSE (l_partkey - 900) // (l_linenumber + 2) END AS INT) AS div_, l_orderkey & l_partkey AS and_, l_orderkey | l_partkey AS or_, least(l_orderkey, l_partkey) AS min_, greatest(l_orderkey, l_partkey) AS max_, l_orderkey <= l_partkey AS lteq, CAST(l_orderkey::HUGEINT * 4611686018427387904 + l_partkey AS VARCHAR) AS long_, CAST((l_orderkey * 8589934593) >> 32 AS INT) AS high FROM lineitem")
def vm_numbers(spark, d):
    a, b, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    far = (a * 100003).cast("long")
    return table(spark, d, "lineitem").select(a, n, vm.add(far, b).alias("add_"), vm.sub(b, far).alias("sub_"), vm.mul(a * 65537, b).alias("mul_"), vm.div(b - 900, n + 2).alias("div_"), vm.bit_and(a, b).alias("and_"), vm.bit_or(a, b).alias("or_"), vm.least(a, b).alias("min_"), vm.greatest(a, b).alias("max_"), vm.branch("lteq", a, b).alias("lteq"), vm.long_add(a.cast("decimal(18,0)") * F.lit(4611686018427387904).cast("decimal(19,0)"), b).cast("decimal(38,0)").cast("string").alias("long_"), vm.long_unpack(a * 8589934593)["high"].alias("high"))


@query("SELECT p_partkey, CAST(length(p_name) AS INT) AS n, lower(p_brand) || '/' || p_type AS joined, CASE WHEN p_brand < p_type THEN -1 WHEN p_brand > p_type THEN 1 ELSE 0 END AS order_, CASE WHEN p_partkey % 2 = 0 AND p_partkey > 0 THEN '-' ELSE '' END || printf('%x', p_partkey) AS hex_, CAST(p_partkey >> 12 & 65535 AS INT) AS table_, CAST(p_partkey >> 4 & 255 AS INT) AS column_, CAST(p_partkey & 15 AS INT) AS sub, CASE p_size % 4 WHEN 1 THEN 10 WHEN 3 THEN 30 ELSE -7 END AS jump FROM part")
def vm_text(spark, d):
    k = F.col("p_partkey")
    a = vm.field_address(k)
    cases = F.array(*(F.struct(F.lit(v).alias("value"), F.lit(j).alias("jump")) for v, j in ((1, 10), (3, 30), (1, 99))))
    return table(spark, d, "part").select("p_partkey", vm.length(F.col("p_name")).alias("n"), vm.join(vm.lower(F.col("p_brand")), F.lit("/"), F.col("p_type")).alias("joined"), vm.compare(F.col("p_brand"), F.col("p_type")).alias("order_"), vm.to_text(F.when(k % 2 == 0, -k).otherwise(k), 16).alias("hex_"), a["table"].cast("int").alias("table_"), a["column"].cast("int").alias("column_"), a["sub"].cast("int").alias("sub"), vm.switch(F.col("p_size") % 4, cases, F.lit(-7)).alias("jump"))


def _machine() -> machine.Machine:
    """Script 1: the sum of all numbers up to an argument, doubled by script 2, and as text; script 3 counts without an end."""
    push, local = (lambda n: ("pushconst", n, None)), (lambda op, n: (op, n, None))
    loop = [local("pushlocalint", 0), push(0), ("branch_lteq", 9, None), local("pushlocalint", 1), local("pushlocalint", 0), ("ADD", 0, None), local("poplocalint", 1), local("pushlocalint", 0), push(1), ("SUB", 0, None), local("poplocalint", 0), ("jump", -12, None)]
    end = [local("pushlocalint", 1), ("gosub", 2, None), local("poplocalint", 2), local("pushlocalint", 2), push(36), ("inttostring", 0, None), ("pushconst", 0, "#"), ("joinstring", 2, None), local("pushlocalint", 2), ("return", 0, None)]
    return machine.Machine({1: machine.Script(loop + end, args=(1, 0, 0)), 2: machine.Script([push(2), ("MUL", 0, None), ("return", 0, None)]), 3: machine.Script([("jump", -1, None)])})


@query("SELECT p_partkey AS call, CASE WHEN p_partkey % 50 <> 0 THEN (p_partkey % 20) * (p_partkey % 20 + 1) END AS sum_, p_partkey % 50 = 0 AS failed FROM part")
def script_runs(spark, d):
    calls = table(spark, d, "part").select(F.col("p_partkey").alias("call"), F.when(F.col("p_partkey") % 50 == 0, 9).otherwise(1).alias("script"), F.array((F.col("p_partkey") % 20).cast("int")).alias("ints"), F.array().cast("array<string>").alias("texts"))
    out = machine.run_scripts(calls, _machine())
    return out.select("call", F.get("ints", F.lit(0)).cast("long").alias("sum_"), F.col("error").isNotNull().alias("failed"))


@query("SELECT DISTINCT CASE l_linenumber % 4 WHEN 0 THEN 'enum' WHEN 1 THEN 'param' WHEN 2 THEN 'script' END AS kind, l_partkey AS id FROM lineitem WHERE l_linenumber % 4 <> 3")
def script_references(spark, d):
    op = F.when(F.col("l_linenumber") % 4 == 0, "enum_getvalue").when(F.col("l_linenumber") % 4 == 1, "struct_getparam").when(F.col("l_linenumber") % 4 == 2, "gosub").otherwise("ADD")
    return machine.references(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("script"), op.alias("op"), F.col("l_partkey").alias("imm")))


@query("SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem WHERE l_returnflag = 'R'")
def script_calls(spark, d):
    op = F.when(F.col("l_returnflag") == "R", "gosub").otherwise("ADD")
    return machine.call_edges(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("script"), op.alias("op"), F.col("l_partkey").alias("imm")))


@query("WITH k AS (SELECT o_orderkey, o_custkey % 12 AS key FROM orders) SELECT o_orderkey, coalesce(CASE WHEN key < 5 THEN key * 100 END, -3) AS value, 7 AS entries FROM k")
def enum_values(spark, d):
    entries = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in ((0, 0), (1, 100), (2, 200), (3, 300), (4, 400), (4, 999), (1, 5))))
    return table(spark, d, "orders").select("o_orderkey", vm.enum_value(entries, F.col("o_custkey") % 12, F.lit(-3)).cast("long").alias("value"), vm.enum_count(entries).alias("entries"))


# -- dependencies -------------------------------------------------------------------------------------


def _items(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    return p.select(k.alias("id"), F.when(k % 2 == 0, k % 70).alias("baseModel"), F.struct((k % 9).alias("id")).alias("maleModels_0"), F.when(k % 3 == 0, k % 11).alias("maleHeads_0"), (k % 4).alias("noteTemplate"))


@query("SELECT DISTINCT holder, 'item-' || p_partkey AS dep FROM part, (VALUES (0), (1), (2), (3)) v(k), LATERAL (SELECT CASE k WHEN 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'model-' || (p_partkey % 70) END WHEN 1 THEN 'model-' || (p_partkey % 9) WHEN 2 THEN CASE WHEN p_partkey % 3 = 0 THEN 'model-' || (p_partkey % 11) END ELSE CASE WHEN p_partkey % 4 <> 0 THEN 'item-' || (p_partkey % 4) END END AS holder) WHERE holder IS NOT NULL")
def dependencies_of_items(spark, d):
    return dependencies.graph(dependencies.items(_items(spark, d)))


@query("WITH p AS (SELECT o_orderkey, o_custkey FROM orders) SELECT DISTINCT holder, dep FROM (SELECT 'model-' || (o_custkey % 50 + n.n) AS holder, 'loc-' || o_orderkey AS dep FROM p, (VALUES (0), (1), (7)) n(n) WHERE o_orderkey % 2 = 0 OR n.n = 7 UNION ALL SELECT 'sequence-' || (o_custkey % 3), 'loc-' || o_orderkey FROM p WHERE o_custkey % 3 <> 0 UNION ALL SELECT 'loc-' || (o_custkey % 5), 'loc-' || o_orderkey FROM p WHERE o_orderkey % 5 = 0)")
def dependencies_of_locations(spark, d):
    m = F.col("o_custkey") % 50
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(F.struct(F.array(m, m + 1).alias("values")))).alias("models"),
        F.struct(F.array(F.struct(F.array(m + 7).alias("values"))).alias("models")).alias("models_05"),
        (F.col("o_custkey") % 3).alias("probably_animation"),
        F.when(F.col("o_orderkey") % 5 == 0, F.struct((F.col("o_custkey") % 5).alias("unk2"))).when(F.col("o_orderkey") % 7 == 0, F.struct(F.lit(-1).cast("long").alias("unk2"))).alias("morphs_1"),
    )
    return dependencies.graph(dependencies.locations(o))


@query("WITH e AS (SELECT DISTINCT 'loc-' || l_partkey AS holder, 'mapsquare-' || (l_orderkey % 50) AS dep FROM lineitem UNION SELECT DISTINCT 'overlay-' || (l_suppkey % 9), 'mapsquare-' || (l_orderkey % 50) FROM lineitem WHERE l_suppkey % 9 <> 0 UNION SELECT DISTINCT 'underlay-' || l_linenumber, 'mapsquare-' || (l_orderkey % 50) FROM lineitem) SELECT name, CAST(count(*) FILTER (WHERE k = 0) AS INT) AS dependencies, CAST(count(*) FILTER (WHERE k = 1) AS INT) AS dependents FROM (SELECT dep AS name, 0 AS k FROM e UNION ALL SELECT holder, 1 FROM e) GROUP BY name")
def dependencies_of_squares(spark, d):
    li = table(spark, d, "lineitem")
    square = (F.col("l_orderkey") % 50).alias("square")
    tiles_ = li.select(square, F.when(F.col("l_suppkey") % 9 != 0, F.col("l_suppkey") % 9).alias("overlay"), F.col("l_linenumber").alias("underlay"))
    e = dependencies.graph(dependencies.squares(li.select(square, F.col("l_partkey").alias("id")), tiles_))
    return dependencies.both_ways(e).select("name", F.size("dependencies").alias("dependencies"), F.size("dependents").alias("dependents"))


@query("WITH RECURSIVE e AS (SELECT 'region-' || n_regionkey AS dep, 'nation-' || n_nationkey AS holder FROM nation UNION ALL SELECT 'nation-' || c_nationkey, 'customer-' || c_custkey FROM customer), r AS (SELECT 'region-1' AS node, 0 AS depth UNION SELECT holder, depth + 1 FROM r JOIN e ON dep = node) SELECT node, CAST(depth AS INT) AS depth, node || '-' || CASE WHEN node LIKE 'nation%' THEN length(node) ELSE 0 END AS entry FROM r")
def dependency_list(spark, d):
    n, c = table(spark, d, "nation"), table(spark, d, "customer")
    e = n.selectExpr("'region-' || n_regionkey dep", "'nation-' || n_nationkey holder").unionAll(c.selectExpr("'nation-' || c_nationkey", "'customer-' || c_custkey"))
    known = n.selectExpr("'nation-' || n_nationkey name").withColumn("hash", F.length("name").cast("long"))
    return dependencies.closure_list(e, known, spark.createDataFrame([("region-1",)], "node string"))


# -- squares ------------------------------------------------------------------------------------------

_LEVELS = "lv AS (SELECT x, y AS z, CAST(l AS INT) AS level, CAST((walk_mask >> (2 * l)) & 15 AS INT) AS settings, CAST((walk_mask * (l + 3)) % 5 AS INT) AS height FROM tiles, (SELECT unnest(range(0, 4)) AS l))"


def _levels(spark, d):
    t = grid.tiles(spark, d).select("x", F.col("y").alias("z"), "walk_mask", F.explode(F.array(*(F.lit(k) for k in range(4)))).alias("level"))
    return t.select("x", "z", "level", F.expr("cast(shiftright(walk_mask, 2 * level) & 15 as int)").alias("settings"), ((F.col("walk_mask") * (F.col("level") + 3)) % 5).cast("int").alias("height"))


_RAISED = "rz AS (SELECT *, CAST(sum(CASE WHEN coalesce(height, 0) = 0 THEN 30 WHEN height = 1 THEN 0 ELSE height END) OVER (PARTITION BY x, z ORDER BY level) AS BIGINT) AS y FROM lv)"
_CORNERS = "co AS (SELECT a.x, a.z, a.level, a.y, coalesce(e.y, a.y) AS y01, coalesce(n.y, a.y) AS y10, coalesce(b.y, a.y) AS y11 FROM rz a LEFT JOIN rz e ON e.x = a.x + 1 AND e.z = a.z AND e.level = a.level LEFT JOIN rz n ON n.x = a.x AND n.z = a.z + 1 AND n.level = a.level LEFT JOIN rz b ON b.x = a.x + 1 AND b.z = a.z + 1 AND b.level = a.level)"


@query(T + f", {_LEVELS}, {_RAISED}, {_CORNERS} SELECT * FROM co")
def square_corners(spark, d):
    return squares.corners(squares.raised(_levels(spark, d)))


@query(T + f", {_LEVELS}, {_RAISED}, {_CORNERS}, p AS (SELECT c_custkey, (c_custkey % 400) / 4.0::DOUBLE AS px, (c_nationkey * 3) / 2.0::DOUBLE AS pz, CAST(c_custkey % 4 AS INT) AS level FROM customer) SELECT c_custkey, round(CASE WHEN y IS NULL THEN 0.0::DOUBLE ELSE y * (1 - (px - floor(px))) * (1 - (pz - floor(pz))) + y01 * (px - floor(px)) * (1 - (pz - floor(pz))) + y10 * (1 - (px - floor(px))) * (pz - floor(pz)) + y11 * (px - floor(px)) * (pz - floor(pz)) END, 6) AS height FROM p LEFT JOIN co ON co.x = floor(px) AND co.z = floor(pz) AND co.level = p.level")
def square_heights(spark, d):
    p = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 400 / 4.0).alias("px"), (F.col("c_nationkey") * 3 / 2.0).alias("pz"), (F.col("c_custkey") % 4).cast("int").alias("level"))
    return squares.height_at(p, squares.corners(squares.raised(_levels(spark, d)))).select("c_custkey", F.round("height", 6).alias("height"))


_FLAG = " | ".join(f"(CASE WHEN (p_partkey & {a}) <> 0 THEN {b} ELSE 0 END)" for a, b in squares.FLAGS)


@query(f"SELECT p_partkey, CAST({_FLAG} AS INT) AS settings FROM part")
def square_flags(spark, d):
    return table(spark, d, "part").select("p_partkey", squares.settings_of_flags(F.col("p_partkey")).alias("settings"))


_OBJECTS = "ob AS (SELECT CAST(l_partkey % 96 AS INT) AS x, CAST(l_orderkey % 96 AS INT) AS z, CAST(l_suppkey % 4 AS INT) AS level, CAST(1 + l_linenumber % 3 AS INT) AS width, CAST(1 + l_suppkey % 2 AS INT) AS length, CAST(l_partkey % 4 AS INT) AS rotation, CAST(l_orderkey % 23 AS INT) AS type, l_returnflag = 'R' AS blocks, l_linestatus = 'O' AS see_through, l_linenumber = 7 AS no_collision FROM lineitem WHERE l_quantity < 5)"


def _objects(spark, d):
    return spark.sql(_OBJECTS.partition("(")[2].rpartition(")")[0].replace("FROM lineitem", "FROM {rows}"), rows=table(spark, d, "lineitem"))


_BRIDGE = "br AS (SELECT x, z, max(CASE WHEN level = 1 AND (settings & 2) <> 0 THEN 1 ELSE 0 END) AS bridge FROM lv GROUP BY 1, 2), ef AS (SELECT lv.*, level - bridge AS effective FROM lv JOIN br USING (x, z))"
_SIDE = "CASE (r) % 4 WHEN 0 THEN 2 WHEN 1 THEN 16 WHEN 2 THEN 8 ELSE 4 END"
_BITS = f"CASE WHEN type = 22 AND blocks THEN 1 WHEN type = 0 THEN {_SIDE.replace('(r)', 'rotation')} WHEN type = 2 THEN {_SIDE.replace('(r)', 'rotation')} | {_SIDE.replace('(r)', '(rotation + 1)')} WHEN type IN (1, 3) THEN 32 << rotation WHEN type BETWEEN 9 AND 21 THEN 1 ELSE 0 END"


@query(T + f", {_LEVELS}, {_OBJECTS}, {_BRIDGE}, own AS (SELECT x, z, effective AS level, CASE WHEN (arg_max(settings, level) & 1) <> 0 THEN 1 ELSE 0 END AS walk FROM ef WHERE effective >= 0 GROUP BY x, z, effective), ft AS (SELECT x + dx AS x, z + dz AS z, level, {_BITS} AS walk, CASE WHEN see_through OR type = 22 THEN 0 ELSE {_BITS} END AS sight FROM ob, LATERAL (SELECT unnest(range(0, CASE WHEN rotation % 2 = 1 THEN length ELSE width END)) AS dx), LATERAL (SELECT unnest(range(0, CASE WHEN rotation % 2 = 1 THEN width ELSE length END)) AS dz) WHERE NOT no_collision) SELECT own.x, own.z, own.level, CAST(own.walk | coalesce(f.walk, 0) AS INT) AS walk, CAST(coalesce(f.sight, 0) AS INT) AS sight FROM own LEFT JOIN (SELECT x, z, level, bit_or(walk) AS walk, bit_or(sight) AS sight FROM ft GROUP BY 1, 2, 3) f ON f.x = own.x AND f.z = own.z AND f.level = own.level")
def square_collision(spark, d):
    return squares.collision(_levels(spark, d), _objects(spark, d))


@query(T + ", v AS (SELECT x, y AS z, 0 AS level, walk_mask % 3 <> 0 AS visible, walk_mask % 256 AS r, walk_mask * 7 % 256 AS g, walk_mask * 13 % 256 AS b FROM tiles) SELECT a.x, a.z, a.level, round(avg(CASE WHEN b.visible THEN b.r END), 6) AS r, round(avg(CASE WHEN b.visible THEN b.g END), 6) AS g, round(avg(CASE WHEN b.visible THEN b.b END), 6) AS b FROM v a JOIN v b ON b.x BETWEEN a.x - 4 AND a.x + 5 AND b.z BETWEEN a.z - 4 AND a.z + 5 GROUP BY a.x, a.z, a.level")
def square_colours(spark, d):
    m = F.col("walk_mask")
    t = grid.tiles(spark, d).select("x", F.col("y").alias("z"), F.lit(0).alias("level"), (m % 3 != 0).alias("visible"), (m % 256).alias("r"), (m * 7 % 256).alias("g"), (m * 13 % 256).alias("b"))
    return squares.blended(t).select("x", "z", "level", *(F.round(c, 6).alias(c) for c in "rgb"))


@query(f"WITH {_OBJECTS} SELECT x, z, level, type FROM ob WHERE x >= 10 AND x < 40 AND z >= 20 AND z < 60 AND (level <= 1 OR blocks)")
def objects_visible(spark, d):
    o = _objects(spark, d).withColumnRenamed("level", "visual").withColumnRenamed("blocks", "always")
    return squares.visible_objects(o, 10, 20, 30, 40, 1).select("x", "z", F.col("visual").alias("level"), "type")


@query(f"WITH {_OBJECTS} SELECT CAST(type AS BIGINT) AS id, 'object ' || type AS name, count(*) AS count, min(level * 100000000 + x * 10000 + z) AS first FROM ob WHERE type % 5 <> 0 AND x >= 0 AND x < 50 AND z >= 0 AND z < 50 GROUP BY type")
def objects_summary(spark, d):
    o = _objects(spark, d).withColumns({"id": F.col("type").cast("long"), "name": F.when(F.col("type") % 5 != 0, F.concat(F.lit("object "), F.col("type").cast("string")))})
    first = F.get("places", F.lit(0))
    return squares.summary(o, 0, 0, 50, 50).select("id", "name", "count", (first["level"] * 100000000 + first["x"] * 10000 + first["z"]).alias("first"))


_PLACED = "SELECT o_custkey % 60 AS id, CAST(o_orderkey % 4 AS INT) AS plane, CAST(o_orderkey % 91 AS INT) AS x, CAST(o_orderkey % 83 AS INT) AS z, CAST(o_orderkey % 3 AS INT) AS rotation, CAST(o_custkey % 22 AS INT) AS type, min(o_orderkey) AS hash, min(o_custkey) AS dephash FROM orders"
_GROUP = " GROUP BY 1, 2, 3, 4, 5, 6"


@query(f"WITH a AS ({_PLACED} WHERE o_orderkey % 7 <> 0{_GROUP}), b AS ({_PLACED.replace('min(o_orderkey) AS hash', 'min(o_orderkey) + CASE WHEN min(o_orderkey) % 10 = 0 THEN 1 ELSE 0 END AS hash')} WHERE o_orderkey % 5 <> 0{_GROUP}) SELECT * FROM (SELECT coalesce(a.id, b.id) AS id, coalesce(a.plane, b.plane) AS plane, coalesce(a.x, b.x) AS x, coalesce(a.z, b.z) AS z, coalesce(a.rotation, b.rotation) AS rotation, coalesce(a.type, b.type) AS type, CASE WHEN a.id IS NULL THEN 'add' WHEN b.id IS NULL THEN 'delete' WHEN a.hash <> b.hash OR a.dephash <> b.dephash THEN 'edit' END AS change FROM a FULL JOIN b ON a.id = b.id AND a.plane = b.plane AND a.x = b.x AND a.z = b.z AND a.rotation = b.rotation AND a.type = b.type) WHERE change IS NOT NULL")
def placement_changes(spark, d):
    o = table(spark, d, "orders")
    at = lambda where, bump: spark.sql(_PLACED.replace("FROM orders", "FROM {rows}") + _GROUP, rows=o.where(where)).withColumn("hash", F.col("hash") + (F.when(F.col("hash") % 10 == 0, 1).otherwise(0) if bump else 0))
    return squares.placement_changes(at("o_orderkey % 7 <> 0", False), at("o_orderkey % 5 <> 0", True))


@query("WITH f AS (SELECT c_custkey AS file, c_custkey % 50 AS firstbuild, c_custkey % 50 + 40 AS build FROM customer), ch AS (SELECT c_custkey AS file, 'c' || ((c_custkey + k) % 30) AS chunk FROM customer, (VALUES (0), (1), (2)) v(k)), m AS (SELECT 'c' || (s_suppkey % 30) AS chunk, s_suppkey AS version, s_suppkey % 45 AS firstbuild, s_suppkey % 45 + 9 AS build FROM supplier), j AS (SELECT ch.file, ch.chunk, min(CASE WHEN m.build >= f.firstbuild AND m.firstbuild <= f.build THEN version END) AS version FROM f JOIN ch USING (file) LEFT JOIN m ON m.chunk = ch.chunk GROUP BY 1, 2) SELECT file, chunk, version FROM j WHERE file NOT IN (SELECT file FROM j WHERE version IS NULL)")
def versions_matching(spark, d):
    c = table(spark, d, "customer")
    f = c.selectExpr("c_custkey file", "c_custkey % 50 firstbuild", "c_custkey % 50 + 40 build")
    ch = c.select(F.col("c_custkey").alias("file"), F.explode(F.array(*map(F.lit, range(3)))).alias("k")).select("file", F.concat(F.lit("c"), ((F.col("file") + F.col("k")) % 30).cast("string")).alias("chunk"))
    m = table(spark, d, "supplier").selectExpr("'c' || (s_suppkey % 30) chunk", "s_suppkey version", "s_suppkey % 45 firstbuild", "s_suppkey % 45 + 9 build")
    return squares.matching_versions(f, ch, m)


# -- lookups ------------------------------------------------------------------------------------------


@query("WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 40 END AS skeleton, o_orderkey % 60 AS frame FROM orders), m AS (SELECT id, CASE WHEN skeleton IS NOT NULL THEN CASE WHEN skeleton < 30 THEN skeleton % 7 END ELSE CASE WHEN frame < 50 THEN frame % 9 END END AS framemap FROM s) SELECT framemap, CAST(count(*) AS INT) AS n, min(id) AS first, max(id) AS last FROM m WHERE framemap IS NOT NULL GROUP BY framemap")
def skeleton_groups(spark, d):
    s = table(spark, d, "orders").selectExpr("o_orderkey id", "CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 40 END skeleton", "o_orderkey % 60 frame")
    frames = spark.range(50).selectExpr("id frame", "id % 9 framemap")
    skeletons = spark.range(30).selectExpr("id skeleton", "id % 7 framemap")
    g = lookups.skeleton_groups(s, frames, skeletons)
    return g.select("framemap", F.size("sequences").alias("n"), F.get("sequences", F.lit(0)).alias("first"), F.element_at("sequences", -1).alias("last"))


@query("SELECT s_suppkey AS category, k AS place, CAST((s_suppkey * 3 + k) % 40 AS INT) AS line, CASE WHEN (s_suppkey * 3 + k) % 40 < 25 THEN (SELECT n_name FROM nation WHERE n_nationkey = (s_suppkey * 3 + k) % 40) END AS text FROM supplier, (VALUES (0), (1), (2)) v(k)")
def chat_lines(spark, d):
    s = table(spark, d, "supplier")
    cats = s.select(F.col("s_suppkey").alias("category"), F.array(*(((F.col("s_suppkey") * 3 + k) % 40).cast("int") for k in range(3))).alias("lines"))
    return lookups.chat_lines(cats, table(spark, d, "nation").selectExpr("cast(n_nationkey as int) line", "n_name text"))


@query("SELECT DISTINCT l_partkey * 20000 + l_suppkey AS value, CAST(((l_partkey * 20000 + l_suppkey) >> 28) & 3 AS INT) AS level, CAST(((l_partkey * 20000 + l_suppkey) >> 14) & 16383 AS INT) AS x, CAST((l_partkey * 20000 + l_suppkey) & 16383 AS INT) AS z FROM lineitem")
def clue_places(spark, d):
    out = lookups.clue_places(table(spark, d, "lineitem").selectExpr("l_partkey * 20000 + l_suppkey value"))
    return out.select("value", *(F.col(c).cast("int").alias(c) for c in ("level", "x", "z")))


@query("SELECT p_partkey AS id, coalesce(CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS INT) END, 1) AS size, coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_name END, '') AS name, CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 2 END AS INT) AS models FROM part")
def npc_models(spark, d):
    k = F.col("p_partkey")
    n = table(spark, d, "part").select(k.alias("id"), F.when(k % 3 == 0, F.col("p_size").cast("int")).alias("size"), F.when(k % 4 != 0, F.col("p_name")).alias("name"), F.when(k % 5 != 0, F.array(F.lit(1), F.lit(2))).alias("models"))
    return lookups.npc_models(n).withColumn("models", F.size("models"))


@query("SELECT o_custkey AS config, min(o_orderkey) AS low, max(o_orderkey) AS high, CAST(count(*) AS INT) AS files, max(o_orderkey) + 1 - count(DISTINCT o_orderkey) AS missing FROM orders GROUP BY 1")
def config_arrays(spark, d):
    return lookups.array_stats(table(spark, d, "orders").groupBy(F.col("o_custkey").alias("config")).agg(F.collect_list("o_orderkey").alias("ids")), "ids")


@query("SELECT max(o_orderkey) AS version FROM orders WHERE o_custkey % 10 IN (2, 5, 7)")
def newest_version(spark, d):
    return lookups.newest_version(table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("major"), F.col("o_orderkey").alias("version")), [2, 5, 7])


# -- versions -----------------------------------------------------------------------------------------

_CACHES = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'de' ELSE 'en' END AS language, CASE WHEN o_custkey % 8 = 0 THEN 'beta' ELSE 'live' END AS environment, 'runescape' AS game, CASE WHEN o_orderkey % 10 <> 3 THEN CAST(o_orderdate AS TIMESTAMP) END AS timestamp, o_custkey % 300 AS build, o_orderkey % 3 AS minor FROM orders"


def _caches(spark, d):
    c = spark.sql(_CACHES.replace("FROM orders", "FROM {rows}"), rows=table(spark, d, "orders"))
    return c.withColumn("builds", F.when(F.col("id") % 11 == 0, F.array().cast("array<struct<major:bigint,minor:bigint>>")).otherwise(F.array(F.struct(F.col("build").alias("major"), "minor")))).drop("build", "minor")


@query(f"SELECT id, build, minor FROM ({_CACHES}) WHERE language = 'en' AND environment = 'live' AND timestamp IS NOT NULL AND id % 11 <> 0 AND id NOT IN (SELECT c_custkey FROM customer)")
def caches_valid(spark, d):
    return versions.valid_caches(_caches(spark, d), table(spark, d, "customer").selectExpr("c_custkey id")).select("id", "build", "minor")


@query(f"SELECT id FROM ({_CACHES}) WHERE timestamp >= TIMESTAMP '1995-01-01' AND timestamp <= TIMESTAMP '1997-01-01'")
def caches_between(spark, d):
    return versions.between(_caches(spark, d), "1995-1997").select("id")


@query(f"SELECT id, CAST(build AS BIGINT) AS build FROM ({_CACHES}) WHERE language = 'en' AND environment = 'live' AND timestamp IS NOT NULL AND id % 11 <> 0 ORDER BY build DESC, minor DESC, timestamp DESC, id LIMIT 1 OFFSET 4")
def caches_recent(spark, d):
    return versions.recent(versions.valid_caches(_caches(spark, d), spark.createDataFrame([], "id long")), 4).select("id", "build")


@query(f"SELECT id, CASE WHEN id % 11 = 0 OR build = 0 THEN -1 ELSE build END AS build FROM ({_CACHES})")
def caches_builds(spark, d):
    return _caches(spark, d).select("id", versions.build_of(F.col("builds")).alias("build"))


@query("WITH e AS (SELECT user_id, event_id % 40 AS v, max(event_type) AS t FROM events GROUP BY 1, 2), r AS (SELECT *, CASE WHEN lag(t) OVER w = t AND lag(v) OVER w = v - 1 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY v)), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY v) AS run FROM r) SELECT user_id, CAST(run AS BIGINT) AS run, min(t) AS t, min(v) AS first, max(v) AS last, CAST(count(*) AS INT) AS n FROM g GROUP BY user_id, run")
def file_history(spark, d):
    e = table(spark, d, "events").groupBy("user_id", (F.col("event_id") % 40).alias("v")).agg(F.max("event_type").alias("t"))
    out = assets.file_history(e, spark.range(40).withColumnRenamed("id", "v"), "user_id", "v", "t")
    return out.select("user_id", "run", "t", F.array_min("versions").alias("first"), F.array_max("versions").alias("last"), F.size("versions").alias("n"))


@query("SELECT DISTINCT x, z, CAST(x * 4 + (z // 4) * 800 + z % 800 AS BIGINT) AS place FROM (SELECT CAST(o_custkey % 200 AS INT) AS x, CAST(o_orderkey % 150 AS INT) AS z FROM orders)")
def zigzag_order(spark, d):
    cells = table(spark, d, "orders").selectExpr("cast(o_custkey % 200 as int) x", "cast(o_orderkey % 150 as int) z")
    return versions.zigzag(cells, 200).withColumn("place", F.col("place").cast("long"))


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n <= 10")
def first_of_each(spark, d):
    return versions.first_of_each(table(spark, d, "events"), "user_id", [F.desc("ts"), "event_id"]).select("user_id", "event_id")


@query("SELECT event_type AS parser, CAST(sum(event_id) AS DOUBLE) AS seconds FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def slowest_parsers(spark, d):
    return versions.slowest(table(spark, d, "events").selectExpr("event_type parser", "cast(event_id as double) seconds"), 3)


@query("WITH s AS (SELECT c_custkey AS id, c_custkey % 37 AS x, c_nationkey AS z FROM customer), w AS (SELECT DISTINCT s_suppkey % 37 AS x, s_nationkey AS z FROM supplier), o AS (SELECT *, row_number() OVER (ORDER BY id DESC) AS n FROM s WHERE (x, z) NOT IN (SELECT x, z FROM w)) SELECT id, x, z FROM o WHERE n <= 8 UNION ALL SELECT s.* FROM s JOIN w USING (x, z)")
def squares_kept(spark, d):
    s = table(spark, d, "customer").selectExpr("c_custkey id", "c_custkey % 37 x", "c_nationkey z")
    return versions.kept_squares(s, table(spark, d, "supplier").selectExpr("s_suppkey % 37 x", "s_nationkey z").distinct())


# -- images -------------------------------------------------------------------------------------------


@query("WITH b AS (SELECT c_custkey % 20 AS image, (c_custkey % 90) / 40.0::DOUBLE - 1.2 AS x1, (c_nationkey % 9) / 4.0::DOUBLE - 1.1 AS y1 FROM customer), c AS (SELECT image, least(63, greatest(0, CAST(floor((x1 + 1) / 2 * 64) AS INT))) AS a, least(63, greatest(0, CAST(floor((x1 + 0.0625 + 1) / 2 * 64) AS INT))) AS b2, least(63, greatest(0, CAST(floor((y1 + 1) / 2 * 64) AS INT))) AS c, least(63, greatest(0, CAST(floor((y1 + 0.03125 + 1) / 2 * 64) AS INT))) AS d FROM b WHERE x1 + 0.0625 >= -1 AND x1 <= 1 AND y1 + 0.03125 >= -1 AND y1 <= 1) SELECT DISTINCT image, CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy FROM c, LATERAL (SELECT unnest(range(a, b2 + 1)) AS cx), LATERAL (SELECT unnest(range(c, d + 1)) AS cy)")
def image_cells(spark, d):
    b = table(spark, d, "customer").selectExpr("c_custkey % 20 image", "(c_custkey % 90) / 40.0D - 1.2D x1", "(c_nationkey % 9) / 4.0D - 1.1D y1")
    out = images.touched_cells(b.withColumns({"x2": F.col("x1") + 0.0625, "y2": F.col("y1") + 0.03125}))
    return out.select("image", F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"))


@query("WITH w AS (SELECT c_custkey % 400 AS name, c_nationkey AS hash, c_custkey AS id FROM customer), h AS (SELECT s_suppkey % 400 AS name, s_nationkey AS hash, max_by('f' || s_suppkey, s_suppkey) AS file FROM supplier GROUP BY 1, 2) SELECT id, name, hash, file, CASE WHEN file IS NULL THEN 'render' ELSE 'reuse' END AS action FROM w LEFT JOIN h USING (name, hash)")
def images_reused(spark, d):
    tasks = table(spark, d, "customer").selectExpr("c_custkey % 400 name", "c_nationkey hash", "c_custkey id")
    stored = table(spark, d, "supplier").selectExpr("s_suppkey % 400 name", "s_nationkey hash", "'f' || s_suppkey file", "s_suppkey version")
    return images.reused(tasks, stored)


@query("SELECT event_type AS hash, max(event_id) AS event_id, max_by(user_id, event_id) AS user_id FROM events GROUP BY 1")
def images_distinct(spark, d):
    return images.distinct_images(table(spark, d, "events").selectExpr("event_type hash", "event_id", "user_id"), "event_id")


# -- text and checksums -------------------------------------------------------------------------------


@query("SELECT page_id, replace(replace(replace(replace(replace(coalesce(url, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&#39;') || '<span style=' || chr(34) || 'color:#ff00' || (10 + page_id % 80) || ';' || chr(34) || '>x<br/></span>' AS html FROM pages")
def markup_pages(spark, d):
    t = F.concat(F.coalesce("url", F.lit("")), F.lit("<col=ff00"), (F.col("page_id") % 80 + 10).cast("string"), F.lit(">x<br>"))
    return table(spark, d, "pages").select("page_id", markup.markup_html(t).alias("html"))


@query()
def placement_hashes(spark, d):
    o = _objects(spark, d)
    moved = [F.col("x"), F.col("z"), *([F.lit(None).cast("int")] * 5)]
    return o.select("x", "z", checksums.placement_hash(F.col("type"), F.col("rotation"), F.col("level")).alias("plain"), checksums.placement_hash(F.col("type"), F.col("rotation"), F.col("level"), F.array("x", "z", "level", "type"), moved).alias("moved"))
