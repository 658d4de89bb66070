"""Queries of the lookup, spatial, ordered, tree, number and binary-record operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import colour, hashes, text
from tessera.operators import assets, decode, ordered, raster, spatial, trees
from tessera.operators import lookups as library
from tessera.functions.masks import DIRECTIONS
from tessera.plans import grid
from tessera.plans.register import query
from tessera.sources.tables import table

T = f"WITH {grid.TILES_SQL} "

# -- rectangles ---------------------------------------------------------------------------------------

_A = "SELECT c_custkey AS id, CAST(c_custkey % 500 * 10 AS INT) AS x, c_nationkey * 40 AS y, CAST(1 + c_custkey % 37 AS INT) AS w, CAST(1 + c_custkey % 23 AS INT) AS h FROM customer"
_B = "SELECT p_partkey AS id, CAST(p_partkey % 500 * 10 + 3 AS INT) AS x, p_size * 20 AS y, 60 AS w, 40 AS h FROM part WHERE p_partkey % 5 = 0"

_B_ALL = _B.partition(" WHERE ")[0]


def _rects(spark, d, sql, name):
    return spark.sql(sql.replace(f"FROM {name}", "FROM {rows}"), rows=table(spark, d, name))


@query(f"WITH a AS ({_A}), b AS ({_B}) SELECT a.id AS a_id, b.id AS b_id FROM a JOIN b ON a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h")
def rect_overlap(spark, d):
    return spatial.rect_overlap(_rects(spark, d, _A, "customer"), _rects(spark, d, _B, "part"))


@query(f"WITH b AS ({_B}) SELECT o_orderkey, CAST(o_custkey * 7 % 5000 AS INT) AS px, CAST(o_orderkey % 1000 AS INT) AS py, min(id) AS id FROM orders JOIN b ON o_custkey * 7 % 5000 >= x AND o_custkey * 7 % 5000 < x + w AND o_orderkey % 1000 >= y AND o_orderkey % 1000 < y + h GROUP BY 1, 2, 3")
def first_covering_rect(spark, d):
    points = table(spark, d, "orders").selectExpr("o_orderkey", "cast(o_custkey * 7 % 5000 as int) px", "cast(o_orderkey % 1000 as int) py")
    return spatial.first_cover(points, _rects(spark, d, _B, "part"))


@query(f"WITH a AS ({_A}), b AS ({_B_ALL}) SELECT a.id AS a_id, b.id AS b_id FROM a JOIN b ON a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h")
def rect_overlap_all(spark, d):
    """rect_overlap with a rectangle for every part."""
    return spatial.rect_overlap(_rects(spark, d, _A, "customer"), _rects(spark, d, _B_ALL, "part"))


@query(f"WITH b AS ({_B_ALL}) SELECT o_orderkey, CAST(o_custkey * 7 % 5000 AS INT) AS px, CAST(o_orderkey % 1000 AS INT) AS py, min(id) AS id FROM orders JOIN b ON o_custkey * 7 % 5000 >= x AND o_custkey * 7 % 5000 < x + w AND o_orderkey % 1000 >= y AND o_orderkey % 1000 < y + h GROUP BY 1, 2, 3")
def first_covering_rect_all(spark, d):
    """first_covering_rect with a rectangle for every part."""
    points = table(spark, d, "orders").selectExpr("o_orderkey", "cast(o_custkey * 7 % 5000 as int) px", "cast(o_orderkey % 1000 as int) py")
    return spatial.first_cover(points, _rects(spark, d, _B_ALL, "part"))


@query("SELECT s_nationkey, least(0, min(s_acctbal)) AS min_s_acctbal, greatest(0, max(s_acctbal)) AS max_s_acctbal, least(0, min(s_suppkey)) AS min_s_suppkey, greatest(0, max(s_suppkey)) AS max_s_suppkey FROM supplier GROUP BY 1")
def bounding_boxes(spark, d):
    return spatial.bounds(table(spark, d, "supplier"), "s_nationkey", ["s_acctbal", "s_suppkey"])


_SHUT = " | ".join([f"(SELECT coalesce(bit_or(CASE WHEN n.centre OR (n.shut & {1 << o}) <> 0 THEN {1 << b} ELSE 0 END), 0) FROM s n WHERE n.x = s.x + ({dx}) AND n.y = s.y + ({dy}))" for b, _, dx, dy, o, _ in DIRECTIONS])


@query(T + f", s AS (SELECT x, y, 255 - walk_mask AS shut, walk_mask % 5 = 0 AS centre FROM tiles), m AS (SELECT x, y, shut | {_SHUT} AS m FROM s) SELECT x, y, CAST(m | " + " | ".join(f"(CASE WHEN (m & {n}) <> 0 THEN {1 << b} ELSE 0 END)" for b, *_, n in DIRECTIONS if n) + " AS INT) AS blocked FROM m")
def tiles_blocked_export(spark, d):
    t = grid.tiles(spark, d)
    return spatial.blocked(t.select("x", "y", (255 - F.col("walk_mask")).cast("int").alias("shut"), (F.col("walk_mask") % 5 == 0).alias("centre")))


@query(T + "SELECT RegionID, round(avg(CASE WHEN (walk_mask & 1) <> 0 THEN 1 ELSE 0 END), 6) AS coverage, bool_or(walk_mask = 0) AS any_shut, bit_or(CAST(walk_mask AS BIGINT)) AS any_open FROM tiles GROUP BY 1")
def grid_coverage(spark, d):
    bit = F.col("walk_mask").bitwiseAND(1) != 0
    return grid.tiles(spark, d).groupBy("RegionID").agg(F.round(F.avg(bit.cast("int")), 6).alias("coverage"), F.bool_or(F.col("walk_mask") == 0).alias("any_shut"), F.bit_or("walk_mask").alias("any_open"))


@query()
def mip_hash_rollup(spark, d):
    return raster.mip_hash(grid.tiles(spark, d).withColumn("hash", hashes.crc_chain(F.col("walk_mask"))), "hash")


# -- lookups ------------------------------------------------------------------------------------------


@query("SELECT c_custkey, coalesce(a.v, 0) AS v, CASE WHEN a.k IS NULL THEN 'missing' ELSE 'found' END AS state FROM (SELECT c_custkey, c_nationkey, CAST(c_custkey % 9 AS INT) AS h FROM customer) c LEFT JOIN (SELECT s_nationkey AS k, CAST(s_suppkey % 9 AS INT) AS h, min(s_suppkey) AS v FROM supplier GROUP BY 1, 2) a ON a.k = c_nationkey AND a.h = c.h")
def file_meta_lookup(spark, d):
    have = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") % 9).cast("int").alias("h"), F.col("s_suppkey").alias("v"))
    want = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 9).cast("int").alias("h"))
    return library.known_files(want, have, ["k", "h"], "v", 0).select("c_custkey", "v", "state")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS BIGINT) END, -1) AS value FROM orders JOIN part ON p_partkey = o_custkey % 100 + 1")
def struct_param_default(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "o_orderkey struct", "o_custkey % 100 + 1 param", "o_custkey")
    params = table(spark, d, "part").selectExpr("p_partkey param", "CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS BIGINT) END default")
    own = rows.where("struct % 3 = 0").selectExpr("struct", "param", "o_custkey value")
    return library.struct_param(rows, own, params, -1).select("o_orderkey", "value")


@query("SELECT c_custkey, coalesce(n_name, '') AS n_name, coalesce(r_name, '') AS r_name FROM (SELECT c_custkey, c_custkey % 30 AS k FROM customer) LEFT JOIN nation ON n_nationkey = k LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey <> 2")
def panel_chain(spark, d):
    c, r = table(spark, d, "customer").selectExpr("c_custkey", "c_custkey % 30 n_nationkey"), table(spark, d, "region").where("r_regionkey <> 2").withColumnRenamed("r_regionkey", "n_regionkey")
    out = library.chain(c, (table(spark, d, "nation"), "n_nationkey", {"n_name": "", "n_regionkey": None}), (r, "n_regionkey", {"r_name": ""}))
    return out.select("c_custkey", "n_name", "r_name")


@query("SELECT s_suppkey, min(p_partkey) AS p_partkey FROM supplier JOIN part ON list_reduce(list_prepend(0::HUGEINT, list_transform(string_split(p_brand, ''), lambda c: ascii(c)::HUGEINT)), lambda a, c: (a * 31 + c) % 4294967296) = list_reduce(list_prepend(0::HUGEINT, list_transform(string_split('Brand#' || CAST(s_suppkey % 60 AS VARCHAR), ''), lambda c: ascii(c)::HUGEINT)), lambda a, c: (a * 31 + c) % 4294967296) GROUP BY 1")
def name_hash_lookup(spark, d):
    index = table(spark, d, "part").select(text.name_hash(F.col("p_brand")).alias("hash"), "p_partkey")
    names = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 60).cast("string")).alias("name"))
    return library.by_hash(names, index, text.name_hash(F.col("name")), "p_partkey").select("s_suppkey", "p_partkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)")
def blacklist_anti(spark, d):
    black = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return library.without(table(spark, d, "orders"), black, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'delete' WHEN a.k IS NULL THEN 'add' ELSE 'edit' END AS change FROM (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1) b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v")
def root_index_diff(spark, d):
    count = lambda where: table(spark, d, "orders").where(where).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("v"))
    return assets.snapshot_diff(count("o_orderkey % 2 = 0"), count("o_orderkey % 3 <> 0"), ["k"], "v")


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds, count(*) AS uses, max(event_id) AS newest FROM events GROUP BY 1")
def placements_by_id(spark, d):
    return library.grouped(table(spark, d, "events"), "user_id", "event_type", "event_id")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 'purged' ELSE event_type END AS state FROM events WHERE ts BETWEEN TIMESTAMP '1900-01-01' AND TIMESTAMP '2100-01-01' AND user_id BETWEEN 3 AND 40")
def purge_marking(spark, d):
    inside = F.expr("ts BETWEEN timestamp'1900-01-01' AND timestamp'2100-01-01' AND user_id BETWEEN 3 AND 40")
    return library.purged(table(spark, d, "events").withColumnRenamed("event_type", "state"), "state", F.col("state") == "click", inside).select("event_id", "state")


# -- orders -------------------------------------------------------------------------------------------


@query("SELECT id, score, held FROM (SELECT *, CAST(sum(size) OVER (ORDER BY score, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS held FROM (SELECT o_orderkey AS id, least(100, o_custkey % 150) - least(100, 10 * (o_orderkey % 13)) AS score, 1 + o_orderkey % 9 AS size FROM orders)) WHERE held <= 20000")
def cache_usage_score(spark, d):
    e = table(spark, d, "orders").selectExpr("o_orderkey id", "o_custkey % 150 age", "o_orderkey % 13 uses", "1 + o_orderkey % 9 size")
    return ordered.kept_in_cache(e, 20000).select("id", "score", "held")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 3000 THEN sum(CASE WHEN c_acctbal < 3000 THEN 1 ELSE 0 END) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) % 10 END AS hotkey FROM customer")
def hotkey_counter(spark, d):
    return ordered.hotkeys(table(spark, d, "customer"), "c_nationkey", ["c_custkey"], F.col("c_acctbal") < 3000).select("c_custkey", "hotkey")


@query("SELECT event_id, row_number() OVER w AS page, CAST(coalesce(sum(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_ FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def running_offsets(spark, d):
    return ordered.running_offset(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_id")).select("event_id", "page", F.col("offset").alias("offset_"))


@query("SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS BIGINT) AS batch FROM orders")
def archive_batches(spark, d):
    return ordered.batches(table(spark, d, "orders"), "o_custkey", ["o_orderkey"], 4).select("o_orderkey", "batch")


@query("SELECT DISTINCT x, y, y * 500 + CASE WHEN y % 2 = 0 THEN x ELSE 499 - x END AS place FROM (SELECT CAST(c_custkey % 500 AS INT) AS x, c_nationkey AS y FROM customer)")
def serpentine_order(spark, d):
    return ordered.serpentine(table(spark, d, "customer").selectExpr("cast(c_custkey % 500 as int) x", "c_nationkey y"), 500)


@query(T + "SELECT x, y, level, max(CASE WHEN (walk_mask >> level) & 1 = 1 THEN level END) OVER (PARTITION BY x, y ORDER BY level) AS roof FROM tiles, (SELECT CAST(unnest(range(0, 4)) AS INT) AS level)")
def effective_level(spark, d):
    t = grid.tiles(spark, d).select("x", "y", "walk_mask", F.explode(F.array(*(F.lit(k) for k in range(4)))).alias("level"))
    return ordered.level_carry(t, F.expr("(shiftright(walk_mask, level) & 1) = 1")).select("x", "y", "level", "roof")


# -- trees --------------------------------------------------------------------------------------------

_TREE = "e AS (SELECT 'region-' || n_regionkey AS src, 'nation-' || n_nationkey AS dst FROM nation UNION ALL SELECT 'nation-' || c_nationkey, 'customer-' || c_custkey FROM customer)"


def _tree(spark, d):
    return table(spark, d, "nation").selectExpr("'region-' || n_regionkey src", "'nation-' || n_nationkey dst").unionAll(table(spark, d, "customer").selectExpr("'nation-' || c_nationkey", "'customer-' || c_custkey"))


@query(f"WITH RECURSIVE {_TREE}, r AS (SELECT 'region-1' AS node, 0 AS depth, 'region-1' AS path UNION ALL SELECT dst, depth + 1, path || '/' || dst FROM r JOIN e ON src = node) SELECT node, CAST(depth AS INT) AS depth, path FROM r")
def tree_walk(spark, d):
    return trees.tree_paths(_tree(spark, d), spark.createDataFrame([("region-1",)], "node string"))


_DAG = "e AS (SELECT DISTINCT 'p' || (p_size % 9) AS src, 'q' || (p_partkey % 40) AS dst FROM part UNION SELECT DISTINCT 'q' || (p_partkey % 40), 'r' || (p_partkey % 77) FROM part UNION SELECT 'p1', 'r' || r_regionkey FROM region)"


@query(f"WITH RECURSIVE {_DAG}, r AS (SELECT 'p1' AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON src = node), m AS (SELECT node, min(depth) AS depth FROM r GROUP BY 1) SELECT m.node, CAST(m.depth AS INT) AS depth, min(p.node) AS parent FROM m LEFT JOIN (SELECT e.dst, m2.node, m2.depth FROM e JOIN m m2 ON m2.node = e.src) p ON p.dst = m.node AND p.depth = m.depth - 1 GROUP BY 1, 2")
def shallowest_parent_tree(spark, d):
    p = table(spark, d, "part")
    e = p.selectExpr("'p' || (p_size % 9) src", "'q' || (p_partkey % 40) dst").unionAll(p.selectExpr("'q' || (p_partkey % 40)", "'r' || (p_partkey % 77)")).unionAll(table(spark, d, "region").selectExpr("'p1'", "'r' || r_regionkey")).distinct()
    return trees.shallowest_parents(e, spark.createDataFrame([("p1",)], "node string"))


@query("WITH n AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 65535 ELSE p_partkey % 50 END AS parent FROM part), l AS (SELECT n.id, CASE WHEN n.parent <> 65535 THEN q.id END AS parent FROM n LEFT JOIN n q ON q.id = n.parent) SELECT l.id, l.parent, count(c.id) AS children FROM l LEFT JOIN l c ON c.parent = l.id GROUP BY 1, 2")
def interface_tree(spark, d):
    return trees.forest(table(spark, d, "part").selectExpr("p_partkey id", "CASE WHEN p_partkey % 7 = 0 THEN 65535 ELSE p_partkey % 50 END parent"), 65535)


# -- numbers, colours, bytes --------------------------------------------------------------------------


@query("SELECT o_orderkey, printf('%x', o_orderkey) AS hex_, CAST(sign(strcmp_) AS INT) AS order_, o_orderkey * 2 - 7 AS parsed, CAST(((o_orderkey & 255) << 8) + ((o_orderkey >> 8) & 255) AS BIGINT) AS swapped, CAST((((o_custkey - 500) % 37) + 37) % 37 AS BIGINT) AS mod_ FROM (SELECT *, CASE WHEN o_orderpriority < o_orderstatus THEN -1 WHEN o_orderpriority > o_orderstatus THEN 1 ELSE 0 END AS strcmp_ FROM orders)")
def number_text_functions(spark, d):
    a, b, n = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey") * 2 - 7
    digits = F.when(n < 0, F.concat(F.lit("-0x"), F.lower(F.hex(-n)))).when(n % 3 == 0, F.concat(F.lit("0x"), F.hex(n))).when(n % 3 == 1, F.concat(F.lit("0b"), F.bin(n))).otherwise(n.cast("string"))
    return table(spark, d, "orders").select("o_orderkey", F.lower(F.hex("o_orderkey")).alias("hex_"), F.when(a < b, -1).when(a > b, 1).otherwise(0).alias("order_"), hashes.parse_int(digits).alias("parsed"), hashes.swap16(F.col("o_orderkey")).alias("swapped"), F.pmod(F.col("o_custkey") - 500, F.lit(37)).alias("mod_"))


_HALF = "((p_partkey & 255) << 8) + ((p_partkey >> 8) & 255)"


@query(f"SELECT p_partkey, CASE WHEN w >> 15 = 1 THEN -1.0 ELSE 1.0 END * CASE WHEN (w >> 10) & 31 = 0 THEN (w & 1023) / 1024.0::DOUBLE * pow(2, -15) ELSE (1 + (w & 1023) / 1024.0::DOUBLE) * pow(2.0, ((w >> 10) & 31) - 15) END AS half FROM (SELECT p_partkey, {_HALF} AS w FROM part)")
def half_floats(spark, d):
    return table(spark, d, "part").select("p_partkey", hashes.swapped_half(F.col("p_partkey")).alias("half"))


@query("SELECT p_partkey, CAST((p_partkey >> 10) & 63 AS INT) AS h, CAST((p_partkey >> 7) & 7 AS INT) AS s, CAST(p_partkey & 127 AS INT) AS l, (p_partkey % 256 << 16) + (p_size % 256 << 8) + p_partkey * 7 % 256 AS rgb FROM part")
def packed_colours(spark, d):
    k = F.col("p_partkey")
    hsl = colour.unpack_hsl(k)
    return table(spark, d, "part").select("p_partkey", *(hsl[c].cast("int").alias(c) for c in "hsl"), colour.rgb_int(k % 256, (F.col("p_size") % 256).cast("long"), k * 7 % 256).alias("rgb"))


@query("SELECT p_partkey, round((p_partkey % 256) / 255.0::DOUBLE, 6) AS r, round((p_size % 256) / 255.0::DOUBLE, 6) AS g, round((p_partkey * 7 % 256) / 255.0::DOUBLE, 6) AS b, round((greatest(p_partkey % 256, p_size % 256, p_partkey * 7 % 256) + least(p_partkey % 256, p_size % 256, p_partkey * 7 % 256)) / 510.0::DOUBLE, 6) AS light FROM part")
def colour_round_trip(spark, d):
    k, z = F.col("p_partkey"), F.col("p_size")
    p = table(spark, d, "part").select("p_partkey", colour.rgb_to_hsl(k % 256 / 255, z % 256 / 255, k * 7 % 256 / 255).alias("c"))
    p = p.select("p_partkey", "c", colour.hsl_to_rgb(F.col("c.h"), F.col("c.s"), F.col("c.l")).alias("o"))
    return p.select("p_partkey", *(F.round(F.col(f"o.{c}"), 6).alias(c) for c in "rgb"), F.round("c.l", 6).alias("light"))


@query()
def crc_chains(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", hashes.crc_chain(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")).alias("chain"), hashes.forward_crc(F.encode(F.col("l_returnflag"), "UTF-8")).alias("page"))


@query("SELECT c_custkey, CAST(c_custkey % 100 AS INT) AS x, c_nationkey AS z, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 4 END AS xs, CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 3 = 1 THEN 4 ELSE 9 END AS zs FROM customer WHERE c_custkey % 11 <> 0 UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL FROM customer WHERE c_custkey % 11 = 0")
def map_areas(spark, d):
    k = F.col("c_custkey")
    s = F.concat_ws(":", (k % 100).cast("string"), F.col("c_nationkey").cast("string"), F.when(k % 3 > 0, "4"), F.when(k % 3 == 2, "9"))
    a = text.map_area(F.when(k % 11 == 0, "a,b").when(k % 2 == 0, F.replace(s, F.lit(":"), F.lit(","))).otherwise(s))
    return table(spark, d, "customer").select("c_custkey", *(a[c].alias(c) for c in ("x", "z", "xs", "zs")))


# -- binary records -----------------------------------------------------------------------------------

_RECORD = ["struct", ["$flags", "ubyte"], ["order", "uint"], ["line", "ubyte"], ["part", ["opt", ["$flags", 0, "bitflag"], "ushort"]], ["supplier", ["opt", "$flags&2", "int"]], ["parity", ["ref", "order", [0, 1]]], ["flag", "string"], ["keys", ["array", "ubyte", "ushort"]]]


@query("SELECT l_orderkey AS order_, l_linenumber AS line, CASE WHEN l_orderkey % 4 IN (1, 3) THEN l_partkey % 65536 END AS part, CASE WHEN l_orderkey % 4 >= 2 THEN -l_suppkey END AS supplier, l_orderkey % 2 AS parity, l_returnflag AS flag, CASE WHEN l_linenumber % 3 = 0 THEN 0 WHEN l_linenumber % 3 = 1 THEN l_partkey % 1000 ELSE l_partkey % 1000 + l_suppkey % 1000 END AS keys_sum FROM lineitem")
def decode_records(spark, d):
    b, c = hashes.big_endian, F.col
    flags, n = c("l_orderkey") % 4, c("l_linenumber") % 3
    nothing = F.lit(b"")
    data = F.concat(b(flags, 1), b(c("l_orderkey")), b(c("l_linenumber"), 1), F.when(flags.isin(1, 3), b(c("l_partkey"), 2)).otherwise(nothing), F.when(flags >= 2, b(-c("l_suppkey"))).otherwise(nothing), F.encode(c("l_returnflag"), "UTF-8"), F.lit(b"\0"), b(n, 1), F.when(n > 0, b(c("l_partkey") % 1000, 2)).otherwise(nothing), F.when(n > 1, b(c("l_suppkey") % 1000, 2)).otherwise(nothing))
    out = decode.decode(table(spark, d, "lineitem").select(data.alias("data")), "data", _RECORD, 900)
    v = out.where(F.when(c("error").isNull(), True).otherwise(F.raise_error(c("error")).cast("boolean"))).select("value.*")
    return v.select(c("order").alias("order_"), "line", "part", "supplier", "parity", "flag", F.aggregate("keys", F.lit(0), lambda a, x: a + x).alias("keys_sum"))
