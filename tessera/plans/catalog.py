"""Every query of the library over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import masks, text
from tessera.operators import assets, graph, indexes, raster, search, tiles
from tessera.operators import lookups as library
from tessera.plans import grid
from tessera.plans.cut import cut
from tessera.plans.register import query as _query, registered
from tessera.sources.tables import table

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tessera.plans import lookups, records  # noqa: F401  register their queries

    return {k: f for k, (f, _) in registered.items()}


def oracle_sql() -> dict[str, str]:
    from tessera.plans import lookups, records  # noqa: F401

    return {k: s for k, (_, s) in registered.items() if s}


T = f"WITH {grid.TILES_SQL} "
TR = f"WITH RECURSIVE {grid.TILES_SQL}, {grid.REACH_SQL} "
OVER_SQL = "over_ AS (SELECT CAST(l_partkey % m AS INT) AS x, CAST(l_orderkey % m AS INT) AS y, max_by(CAST(l_suppkey % 256 AS INT), (l_orderkey, l_partkey, l_suppkey)) AS force_mask FROM lineitem, side WHERE l_returnflag = 'R' AND l_linenumber = 1 AND l_orderkey % 16 = 0 GROUP BY 1, 2)"

# -- tiles ----------------------------------------------------------------------------------------


@_query(T + "SELECT x, y, plane, walk_mask, RegionID FROM tiles")
def tiles_load(spark, d):
    return grid.tiles(spark, d)


@_query("SELECT x, y, plane, walk_mask FROM (SELECT CAST(l_partkey % 96 AS INT) AS x, CAST(l_suppkey % 96 AS INT) AS y, 0 AS plane, CAST(l_orderkey % 256 AS BIGINT) AS walk_mask, row_number() OVER (PARTITION BY l_partkey % 96, l_suppkey % 96 ORDER BY l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1")
def tiles_load_latest_wins(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_partkey") % 96).cast("int").alias("x"), (F.col("l_suppkey") % 96).cast("int").alias("y"), F.lit(0).alias("plane"), (F.col("l_orderkey") % 256).alias("walk_mask"), "l_orderkey", "l_linenumber")
    return tiles.latest_wins(rows, "l_orderkey", "l_linenumber").select("x", "y", "plane", "walk_mask")


@_query(T + f", {OVER_SQL} SELECT x, y, plane, coalesce(CAST(force_mask AS BIGINT), walk_mask) AS walk_mask, RegionID FROM tiles LEFT JOIN over_ USING (x, y)")
def tiles_apply_overrides(spark, d):
    t = tiles.apply_overrides(grid.tiles(spark, d), grid.overrides(spark, d))
    return t.select("x", "y", "plane", F.col("walk_mask").cast("long").alias("walk_mask"), "RegionID")


@_query(T + f", {grid.EVERY_OVERRIDE_SQL} SELECT x, y, plane, coalesce(CAST(force_mask AS BIGINT), walk_mask) AS walk_mask, RegionID FROM tiles LEFT JOIN over_ USING (x, y)")
def tiles_apply_overrides_all(spark, d):
    """tiles_apply_overrides with every returned line."""
    t = tiles.apply_overrides(grid.tiles(spark, d), grid.every_override(spark, d))
    return t.select("x", "y", "plane", F.col("walk_mask").cast("long").alias("walk_mask"), "RegionID")


@_query(T + "SELECT RegionID, count(*) AS tiles, CAST(sum(bit_count(walk_mask)) AS BIGINT) AS open_bits, min(x) AS min_x, max(y) AS max_y FROM tiles GROUP BY RegionID")
def region_rollup(spark, d):
    return grid.tiles(spark, d).groupBy("RegionID").agg(F.count("*").alias("tiles"), F.sum(F.bit_count("walk_mask")).cast("long").alias("open_bits"), F.min("x").alias("min_x"), F.max("y").alias("max_y"))


@_query(T + "SELECT t.x, t.y, CAST(coalesce(m, 0) AS BIGINT) AS walk_mask FROM tiles t LEFT JOIN (SELECT x, y, bit_or(1 << bit) AS m FROM rec GROUP BY x, y) r USING (x, y)")
def tiles_reconcile(spark, d):
    return tiles.reconcile(grid.tiles(spark, d)).select("x", "y", "walk_mask")


def _reached(spark, d):
    t = grid.reconciled(spark, d)
    return t, tiles.reachable(t, grid.start(t, grid.side(spark, d)))


@_query(TR + "SELECT x, y FROM reach")
def tiles_reachable(spark, d):
    return _reached(spark, d)[1].select("x", "y")


@_query(TR + "SELECT t.x, t.y, CAST(coalesce(m, 0) AS BIGINT) AS walk_mask, t.RegionID FROM tiles t JOIN reach USING (x, y) LEFT JOIN (SELECT rec.x, rec.y, bit_or(1 << bit) AS m FROM rec JOIN reach r2 ON rec.nx = r2.x AND rec.ny = r2.y GROUP BY rec.x, rec.y) s USING (x, y)")
def tiles_reachable_sanitised(spark, d):
    t, reached = _reached(spark, d)
    return tiles.sanitise(t, reached).select("x", "y", "walk_mask", "RegionID")


@_query(f"WITH d(bit, dx, dy, opp, needs) AS (VALUES {grid.DIR_SQL}), ring AS (SELECT CAST(c_custkey % 500 AS INT) AS x, CAST(c_nationkey * 3 AS INT) AS y FROM customer WHERE c_custkey % 9 = 0), a AS (SELECT x, y, 255 AS f, 0 AS o FROM ring UNION ALL SELECT x + d.dx, y + d.dy, NULL, (1 << d.opp) | d2.needs FROM ring, d JOIN d d2 ON d2.bit = d.opp) SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, max(f) AS force_mask, CAST(bit_or(o) AS INT) AS or_mask FROM a GROUP BY 1, 2")
def ring_overrides(spark, d):
    r = table(spark, d, "customer").where("c_custkey % 9 = 0").select((F.col("c_custkey") % 500).cast("int").alias("x"), (F.col("c_nationkey") * 3).cast("int").alias("y"), F.lit(0).alias("plane"))
    return tiles.ring_overrides(r).select("x", "y", "force_mask", "or_mask")


@_query(f"WITH d(bit, dx, dy, opp, needs) AS (VALUES {grid.DIR_SQL}), {grid.RINGS_SQL} SELECT * FROM ring_over")
def ring_overrides_all(spark, d):
    """ring_overrides with a ring for every customer."""
    return tiles.ring_overrides(grid.rings(spark, d)).select("x", "y", "force_mask", "or_mask")


# -- scalar functions -------------------------------------------------------------------------------


@_query(T + "SELECT x, y, " + ", ".join(f"(walk_mask & {1 << b}) <> 0 AS {n}_" for b, n, *_ in masks.DIRECTIONS) + ", list_filter([" + ", ".join(f"CASE WHEN (walk_mask & {1 << b}) <> 0 THEN '{n}' END" for b, n, *_ in masks.DIRECTIONS) + "], lambda v: v IS NOT NULL)::VARCHAR AS names FROM tiles")
def mask_decode(spark, d):
    t = grid.tiles(spark, d).select("x", "y", "walk_mask", masks.decode(F.col("walk_mask")).alias("m"))
    return t.select("x", "y", *(F.col(f"m.{n}").alias(f"{n}_") for _, n, *_ in masks.DIRECTIONS), F.concat(F.lit("["), F.array_join(masks.names(F.col("walk_mask")), ", "), F.lit("]")).alias("names"))


@_query("SELECT l_orderkey, l_linenumber, CAST((CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) + (CASE WHEN l_discount > 0.05 THEN 4 ELSE 0 END) + (CASE WHEN l_tax > 0.04 THEN 16 ELSE 0 END) AS INT) AS mask, CAST((CASE WHEN l_returnflag = 'R' THEN 8 ELSE 2 END) + 64 AS INT) AS named FROM lineitem")
def mask_encode(spark, d):
    flags = {"left": F.col("l_quantity") > 25, "right": F.col("l_discount") > 0.05, "topleft": F.col("l_tax") > 0.04}
    names = F.array(F.when(F.col("l_returnflag") == "R", " Up").otherwise("down"), F.lit(""), F.lit("BottomRight"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", masks.encode(flags).cast("int").alias("mask"), masks.encode_names(names).alias("named"))


@_query("SELECT o_orderkey, CAST(trunc((CAST(o_custkey AS DOUBLE) - 700 + (o_orderkey % 1000) - 900) / 2) AS INT) AS mid, CAST((o_orderkey >> 28) & 3 AS INT) AS level, CAST((o_orderkey >> 14) & 16383 AS INT) AS cx, CAST(o_orderkey & 16383 AS INT) AS cz, CAST(o_orderkey // 128 AS BIGINT) AS archive, CAST(o_orderkey % 128 AS BIGINT) AS sub FROM orders")
def coordinate_functions(spark, d):
    o = table(spark, d, "orders")
    clue = masks.unpack_clue(F.col("o_orderkey"))
    return o.select("o_orderkey", masks.centre(F.col("o_custkey") - 700, F.col("o_orderkey") % 1000 - 900).alias("mid"), clue["level"].cast("int").alias("level"), clue["x"].cast("int").alias("cx"), clue["z"].cast("int").alias("cz"), F.expr("o_orderkey div 128").alias("archive"), (F.col("o_orderkey") % 128).alias("sub"))


@_query("SELECT p_partkey, CAST(" + " + ".join(f"(CASE WHEN (p_partkey >> {i}) & 1 = 1 THEN (CASE WHEN (p_size >> {i % 6}) & 1 = 1 THEN 2 ELSE 1 END) ELSE 0 END) * {3**i}" for i in range(9)) + " AS INT) AS packed FROM part")
def collision_base3(spark, d):
    bit = lambda c, i: F.shiftright(c, i).bitwiseAND(1) == 1
    return table(spark, d, "part").select("p_partkey", masks.base3([bit("p_partkey", i) for i in range(9)], [bit("p_size", i % 6) for i in range(9)]).cast("int").alias("packed"))


@_query("SELECT p_partkey, CAST(list_reduce(list_prepend(0::HUGEINT, list_transform(string_split(p_name, ''), lambda c: ascii(c)::HUGEINT)), lambda a, c: (a * 31 + c) % 4294967296) AS BIGINT) AS hash FROM part")
def name_hash(spark, d):
    return table(spark, d, "part").select("p_partkey", text.name_hash(F.col("p_name")).alias("hash"))


@_query("SELECT page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS escaped, CAST(strpos(url, 'example') - 1 AS INT) AS at, substring(url, 5, 7) AS part, lower(url) AS low, CAST(length(url) AS INT) AS n FROM pages WHERE url IS NOT NULL")
def string_ops(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").where("url IS NOT NULL").select("page_id", text.escape_html(u).alias("escaped"), text.index_of(u, F.lit("example"), F.lit(0)).alias("at"), text.js_substring(u, F.lit(11), F.lit(4)).alias("part"), F.lower(u).alias("low"), F.length(u).alias("n"))


_WRAP = "CAST((({}) + 2147483648) % 4294967296 - 2147483648 AS INT)"


@_query("SELECT l_orderkey, l_linenumber, " + _WRAP.format("(l_orderkey * 65537 * l_partkey) % 4294967296 + 4294967296") + " AS mul, CAST(l_orderkey % 1000 // (l_linenumber + 1) AS INT) AS quot, CAST(least(l_partkey, l_suppkey) AS BIGINT) AS low FROM lineitem")
def int32_arithmetic(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", text.int32(F.col("l_orderkey") * 65537 * F.col("l_partkey")).alias("mul"), F.expr("(l_orderkey % 1000) div (l_linenumber + 1)").cast("int").alias("quot"), F.least("l_partkey", "l_suppkey").alias("low"))


@_query("SELECT c_custkey, CAST(c_custkey % 7 AS VARCHAR) || ';' || CAST(c_nationkey AS VARCHAR) AS requirements, CASE WHEN c_custkey % 5 = 0 THEN 1 WHEN c_custkey % 5 = 1 THEN 0 WHEN c_custkey % 5 = 2 THEN CAST(sign(c_acctbal) * floor(abs(CAST(c_acctbal AS DECIMAL(18, 2))) + 0.5) AS BIGINT) END AS cell FROM customer")
def cell_coercion(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 5
    cell = F.when(k == 0, " Yes").when(k == 1, "FALSE").when(k == 2, F.col("c_acctbal").cast("decimal(18,2)").cast("string")).when(k == 3, "n/a")
    req = F.concat(F.lit(" "), (F.col("c_custkey") % 7).cast("string"), F.lit(" ; "), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", text.requirement_list(req).alias("requirements"), text.to_integer(cell).alias("cell"))


# -- teleports ----------------------------------------------------------------------------------------

_AREAS = "SELECT 'object' AS kind, c_custkey AS id, CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 96 END AS ax, c_custkey % 7 - 5 AS bx, c_nationkey AS ay, c_nationkey + 3 AS yb, c_custkey % 50 AS cx, c_custkey % 50 - 9 AS ex, c_nationkey * 2 AS cy, c_nationkey AS ey FROM customer UNION ALL SELECT 'npc', s_suppkey, s_suppkey % 96, s_suppkey % 5, s_nationkey, s_nationkey, s_suppkey % 31, s_suppkey % 31 + 4, s_nationkey, s_nationkey - 30 FROM supplier"


def _mid(a, b):
    return f"CAST(trunc((CAST({a} AS DOUBLE) + {b}) / 2) AS INT)"


@_query(f"WITH a AS ({_AREAS}), e AS (SELECT kind, {_mid('ax', 'bx')} AS sx, {_mid('ay', 'yb')} AS sy, {_mid('cx', 'ex')} AS dx, {_mid('cy', 'ey')} AS dy FROM a WHERE ax IS NOT NULL UNION ALL SELECT 'door', CAST(o_orderkey % 96 AS INT), CAST(o_custkey % 96 AS INT), CAST(o_orderkey % 96 + 1 AS INT), CAST(o_custkey % 96 AS INT) FROM orders WHERE o_orderstatus = 'F') SELECT * FROM e UNION ALL SELECT kind, dx, dy, sx, sy FROM e")
def teleport_center_edges(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    named = lambda f, kind, cols: f.select(F.lit(kind).alias("kind"), *(F.expr(v).cast("int").alias(k) for k, v in cols.items()))
    a = named(c, "object", {"orig_min_x": "CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 96 END", "orig_max_x": "c_custkey % 7 - 5", "orig_min_y": "c_nationkey", "orig_max_y": "c_nationkey + 3", "dest_min_x": "c_custkey % 50", "dest_max_x": "c_custkey % 50 - 9", "dest_min_y": "c_nationkey * 2", "dest_max_y": "c_nationkey"})
    b = named(s, "npc", {"orig_min_x": "s_suppkey % 96", "orig_max_x": "s_suppkey % 5", "orig_min_y": "s_nationkey", "orig_max_y": "s_nationkey", "dest_min_x": "s_suppkey % 31", "dest_max_x": "s_suppkey % 31 + 4", "dest_min_y": "s_nationkey", "dest_max_y": "s_nationkey - 30"})
    doors = table(spark, d, "orders").where("o_orderstatus = 'F'").selectExpr("cast(o_orderkey % 96 as int) ax", "cast(o_custkey % 96 as int) ay", "cast(o_orderkey % 96 + 1 as int) bx", "cast(o_custkey % 96 as int) by")
    return graph.teleport_edges(doors, a.unionByName(b))


@_query("SELECT 'customer' AS kind, c_custkey AS id, CAST(c_nationkey AS BIGINT) AS src, CAST(c_custkey % 25 AS BIGINT) AS dst FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_suppkey % 25 FROM supplier UNION ALL SELECT 'order', o_orderkey, NULL, o_custkey % 25 FROM orders WHERE o_orderpriority IS NOT NULL")
def teleports_all(spark, d):
    row = lambda name, kind, i, s, t: table(spark, d, name).select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.expr(s).cast("long").alias("src"), F.expr(t).cast("long").alias("dst"))
    orders = table(spark, d, "orders").where("o_orderpriority IS NOT NULL").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.lit(None).cast("long").alias("src"), (F.col("o_custkey") % 25).alias("dst"))
    return row("customer", "customer", "c_custkey", "c_nationkey", "c_custkey % 25").unionByName(row("supplier", "supplier", "s_suppkey", "s_nationkey", "s_suppkey % 25")).unionByName(orders)


_ENDS = f"""edges AS ({registered["teleport_center_edges"][1]}),
ends AS (SELECT sx AS x, sy AS y FROM edges UNION ALL SELECT dx, dy FROM edges UNION ALL SELECT CAST(n_nationkey * 3 AS INT), CAST(n_regionkey * 7 AS INT) FROM nation UNION ALL SELECT {_mid("s_suppkey % 90", "s_suppkey % 90 + 5")}, {_mid("s_nationkey", "s_nationkey + 9")} FROM supplier UNION ALL SELECT {_mid("r_regionkey * 20", "r_regionkey * 20 + 3")}, {_mid("r_regionkey * 20", "r_regionkey * 20 + 3")} FROM region)"""
CLEAN = f"WITH RECURSIVE {_ENDS}, {grid.CLEAN_SQL} "


def _ends(spark, d):
    """Both ends of doors, objects and NPCs; nations as lodestones, suppliers as items, regions as interface slots."""
    e = teleport_center_edges(spark, d)
    at = lambda f, x, y: f.select(x.cast("int").alias("x"), y.cast("int").alias("y"))
    near = lambda v, n: masks.centre(v, v + n)
    c, all_ = F.col, at(e, F.col("sx"), F.col("sy")).unionAll(at(e, F.col("dx"), F.col("dy")))
    all_ = all_.unionAll(at(table(spark, d, "nation"), c("n_nationkey") * 3, c("n_regionkey") * 7))
    all_ = all_.unionAll(at(table(spark, d, "supplier"), near(c("s_suppkey") % 90, 5), near(c("s_nationkey"), 9)))
    all_ = all_.unionAll(at(table(spark, d, "region"), near(c("r_regionkey") * 20, 3), near(c("r_regionkey") * 20, 3)))
    return all_.withColumn("plane", F.lit(0))


def _seeded(spark, d):
    forced = cut(tiles.ring_overrides(grid.rings(spark, d)))
    t = tiles.apply_overrides(tiles.apply_overrides(grid.tiles(spark, d), grid.every_override(spark, d)), forced)
    t = cut(tiles.reconcile(t))
    return t, forced, tiles.reachable(t, tiles.seeds(grid.start(t, grid.side(spark, d)), _ends(spark, d), forced))


@_query(CLEAN + "SELECT x, y FROM reach")
def tiles_reachable_from_seeds(spark, d):
    """The whole of tiles_reachable's job: overrides before reconciling, and all ends of teleports and forced tiles as seeds."""
    return _seeded(spark, d)[2].select("x", "y")


@_query(CLEAN + "SELECT t.x, t.y, CAST(coalesce(force_mask, coalesce(m, 0) | coalesce(or_mask, 0)) AS BIGINT) AS walk_mask, t.RegionID FROM tiles t JOIN reach USING (x, y) LEFT JOIN (SELECT rec.x, rec.y, bit_or(1 << bit) AS m FROM rec JOIN reach r2 ON rec.nx = r2.x AND rec.ny = r2.y GROUP BY rec.x, rec.y) s USING (x, y) LEFT JOIN ring_over USING (x, y)")
def tiles_cleaned(spark, d):
    """The whole of tiles_reachable_sanitised's job: from all seeds, with overrides put back at the end."""
    t, forced, reached = _seeded(spark, d)
    return tiles.put_back(tiles.sanitise(t, reached), forced).select("x", "y", "walk_mask", "RegionID")


# -- versioned assets ---------------------------------------------------------------------------------


@_query("SELECT major, files, total, largest, smallest, mean, highest, highest + 1 - files AS missing FROM (SELECT o_custkey AS major, count(*) AS files, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total, max(o_totalprice) AS largest, min(o_totalprice) AS smallest, floor(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) * 100 + 0.5) / 100 AS mean, max(o_orderkey) AS highest FROM orders GROUP BY o_custkey)")
def index_overview(spark, d):
    return assets.index_overview(table(spark, d, "orders").select(F.col("o_custkey").alias("major"), F.col("o_orderkey").alias("minor"), F.col("o_totalprice").alias("size")))


@_query("SELECT o_custkey, k + 1 AS gap_from, n - 1 AS gap_to FROM (SELECT o_custkey, k, lead(k) OVER (PARTITION BY o_custkey ORDER BY k) AS n FROM (SELECT DISTINCT o_custkey, o_orderkey AS k FROM orders)) WHERE n > k + 1")
def config_gaps(spark, d):
    return assets.gaps(table(spark, d, "orders"), "o_custkey", "o_orderkey")


@_query("WITH a AS (SELECT o_custkey, o_orderkey, CAST(o_totalprice AS VARCHAR) AS v FROM orders WHERE o_orderkey % 7 <> 0), b AS (SELECT o_custkey, o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS VARCHAR) AS v FROM orders WHERE o_orderkey % 7 <> 1) SELECT * FROM (SELECT o_custkey, o_orderkey, CASE WHEN a.v IS NULL THEN 'add' WHEN b.v IS NULL THEN 'delete' WHEN a.v <> b.v THEN 'edit' END AS change FROM a FULL JOIN b USING (o_custkey, o_orderkey)) WHERE change IS NOT NULL")
def snapshot_diff(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("v"))
    new = o.where("o_orderkey % 7 <> 1").withColumn("v", F.when(F.col("o_orderkey") % 5 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return assets.snapshot_diff(o.where("o_orderkey % 7 <> 0"), new, ["o_custkey", "o_orderkey"], "v")


@_query("WITH p AS (SELECT user_id, event_type, row_number() OVER w AS pos, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM p) SELECT user_id, CAST(run AS BIGINT) AS run, min(event_type) AS event_type, CAST(min(pos) AS INT) AS first_pos, CAST(max(pos) AS INT) AS last_pos, count(*) AS n FROM r GROUP BY user_id, run")
def version_history(spark, d):
    return assets.version_history(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type")


@_query("SELECT user_id, event_id, request_id FROM (SELECT *, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS request_id FROM events) WHERE event_type = 'purchase'")
def log_asof_request(spark, d):
    return assets.as_of(table(spark, d, "events"), ["ts", "event_id"], F.col("event_type") == "view", F.col("event_type") == "purchase", "user_id")


@_query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY abs(epoch_us(CAST(o_orderdate AS TIMESTAMP)) - epoch_us(TIMESTAMP '1996-06-01')), o_orderkey LIMIT 10")
def nearest_versions(spark, d):
    return assets.nearest(table(spark, d, "orders"), "o_orderdate", "1996-06-01", 10, "o_orderkey").select("o_orderkey", "o_orderdate")


@_query("WITH n AS (SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS INT) AS rn FROM customer) SELECT n.c_custkey, n.rn FROM n, (SELECT rn AS r0 FROM n WHERE c_custkey = 77) WHERE abs(rn - r0) <= 10")
def catalog_neighbours(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return assets.catalog_neighbours(c, [F.desc("c_acctbal"), "c_custkey"], F.col("c_custkey") == 77, 10).select("c_custkey", "rn")


@_query("SELECT c_custkey, c_nationkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1 OFFSET 3")
def recent_offset(spark, d):
    return table(spark, d, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").offset(3).limit(1).select("c_custkey", "c_nationkey")


@_query("SELECT o_orderkey, min(l_linenumber) AS l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE CAST(o_orderdate AS TIMESTAMP) <= CAST(l_shipdate AS TIMESTAMP) + INTERVAL 30 DAY AND CAST(l_shipdate AS TIMESTAMP) <= CAST(o_orderdate AS TIMESTAMP) + INTERVAL 60 DAY GROUP BY o_orderkey")
def range_overlap_match(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "cast(o_orderdate as timestamp) lo", "cast(o_orderdate as timestamp) + interval 60 day hi")
    li = table(spark, d, "lineitem").selectExpr("l_orderkey o_orderkey", "l_linenumber", "cast(l_shipdate as timestamp) rlo", "cast(l_shipdate as timestamp) + interval 30 day rhi")
    return assets.first_range(o, li, ["o_orderkey"], "lo", "hi", "rlo", "rhi", "l_linenumber").select("o_orderkey", "l_linenumber")


@_query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NOT NULL THEN b.v ELSE a.v END AS v, a.w FROM (SELECT c_custkey AS k, c_acctbal AS v, c_name AS w FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey AS k, c_acctbal * 2 AS v FROM customer WHERE c_custkey % 2 = 0) b ON a.k = b.k")
def upsert_given_columns(spark, d):
    c = table(spark, d, "customer")
    old = c.where("c_custkey % 3 <> 0").selectExpr("c_custkey k", "c_acctbal v", "c_name w")
    return assets.upsert(old, c.where("c_custkey % 2 = 0").selectExpr("c_custkey k", "c_acctbal * 2 v"), ["k"])


@_query("SELECT o_orderkey, coalesce(n_name, 'none') AS n_name FROM (SELECT o_orderkey, o_custkey % 40 AS k FROM orders) LEFT JOIN nation ON n_nationkey = k")
def enum_lookup_default(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey % 40 k")
    return assets.lookup_default(o, table(spark, d, "nation").selectExpr("n_nationkey k", "n_name", "n_nationkey pos"), "k", "n_name", "none").select("o_orderkey", "n_name")


@_query("SELECT a.p_partkey, coalesce(CASE WHEN a.p_size % 3 <> 0 THEN a.p_name END, b.p_name) AS p_name, coalesce(CASE WHEN a.p_size % 2 = 0 THEN a.p_type END, b.p_type) AS p_type FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey % 100")
def morph_overlay(spark, d):
    p = table(spark, d, "part")
    base = p.select((-F.col("p_partkey") - 1).alias("key"), F.lit(None).cast("long").alias("to"), "p_name", "p_type")
    own = p.select(F.col("p_partkey").alias("key"), (-(F.col("p_partkey") % 100) - 1).alias("to"), F.when(F.col("p_size") % 3 != 0, F.col("p_name")).alias("p_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("p_type"))
    return library.overlaid(own.unionAll(base), "key", "to").where("key >= 0").select(F.col("key").alias("p_partkey"), "p_name", "p_type")


@_query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey = 5 AND l_linenumber >= 2) OR (l_orderkey > 5 AND l_orderkey < 90) OR l_orderkey = 200 EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (7, 8) AND ((l_orderkey = 5 AND l_linenumber >= 2) OR (l_orderkey > 5 AND l_orderkey < 90) OR l_orderkey = 200)")
def id_range_filter(spark, d):
    li = table(spark, d, "lineitem")
    inside = indexes.in_ranges([F.col("l_orderkey"), F.col("l_linenumber")], "5.2-89,200")
    black = spark.createDataFrame([(7,), (8,)], "l_orderkey long")
    return library.without(li.where(inside), black, ["l_orderkey"]).select("l_orderkey", "l_linenumber")


@_query("SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS INT) = 42 AND contains(lower(event_type), 'c')")
def json_path_search(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k int").alias("props"))
    return search.search(e, [(["props", "k"], 42), (["event_type"], "C")], None).select("event_id")


@_query("SELECT l_orderkey, l_linenumber, sum(l_partkey) OVER w AS running, last_value(CASE WHEN l_returnflag = 'R' THEN l_suppkey END IGNORE NULLS) OVER w AS held FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)".replace("sum(l_partkey) OVER w", "CAST(sum(l_partkey) OVER w AS BIGINT)"))
def delta_decode_hold_last(spark, d):
    held = F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))
    return library.delta_decoded(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_partkey", held).select("l_orderkey", "l_linenumber", "running", "held")


# -- rasters ------------------------------------------------------------------------------------------


@_query(T + "SELECT z.z AS zoom, CAST(x >> z.z AS INT) AS px, CAST(y >> z.z AS INT) AS py, count(*) AS n, CAST(sum(bit_count(walk_mask)) AS BIGINT) AS open_bits FROM tiles, (SELECT CAST(unnest(range(0, 6)) AS INT) AS z) z GROUP BY 1, 2, 3")
def quadtree_rollup(spark, d):
    return raster.pyramid(grid.tiles(spark, d), 5)


@_query(T + "SELECT CAST(x >> 1 AS INT) AS px, CAST(y >> 1 AS INT) AS py, CAST((sum(walk_mask) + 2) // 4 AS BIGINT) AS walk_mask FROM tiles GROUP BY 1, 2")
def mip_mean(spark, d):
    return raster.mip_mean(grid.tiles(spark, d), "walk_mask")


@_query(T + "SELECT a.x, a.y, round(CAST(sum(b.walk_mask) AS DOUBLE) / count(*), 6) AS mean FROM tiles a JOIN tiles b ON b.x BETWEEN a.x - 4 AND a.x + 5 AND b.y BETWEEN a.y - 4 AND a.y + 5 GROUP BY a.x, a.y")
def neighbourhood_kernel_mean(spark, d):
    return raster.kernel_mean(grid.tiles(spark, d), "walk_mask")


@_query(T + ", l AS (SELECT x, y, l.l AS level, CASE WHEN (walk_mask >> l.l) & 1 = 1 THEN (walk_mask * (l.l + 1)) % 4 END AS extra FROM tiles, (SELECT CAST(unnest(range(0, 4)) AS INT) AS l) l) SELECT x, y, level, CAST(sum(CASE WHEN coalesce(extra, 0) = 0 THEN 30 WHEN extra = 1 THEN 0 ELSE extra END) OVER (PARTITION BY x, y ORDER BY level) AS BIGINT) AS height FROM l")
def cumulative_height(spark, d):
    t = grid.tiles(spark, d).select("x", "y", "walk_mask", F.explode(F.array(*(F.lit(k) for k in range(4)))).alias("level"))
    extra = F.expr("CASE WHEN (shiftright(walk_mask, level) & 1) = 1 THEN (walk_mask * (level + 1)) % 4 END")
    return raster.height_carry(t.withColumn("extra", extra)).select("x", "y", "level", "height")


@_query(T + "SELECT x, y FROM tiles WHERE x >= 10 AND x < 30 AND y >= 20 AND y < 25")
def point_in_rect(spark, d):
    t = grid.tiles(spark, d).withColumns({"rx": F.lit(10), "ry": F.lit(20), "rw": F.lit(20), "rh": F.lit(5)})
    return t.where(raster.in_rect(F.col("x"), F.col("y"), "rx", "ry", "rw", "rh")).select("x", "y")


# -- graphs -------------------------------------------------------------------------------------------


def _dependencies(spark, d):
    n, c, o = table(spark, d, "nation"), table(spark, d, "customer"), table(spark, d, "orders")
    return n.selectExpr("'region-' || n_regionkey src", "'nation-' || n_nationkey dst").unionAll(c.selectExpr("'nation-' || c_nationkey", "'customer-' || c_custkey")).unionAll(o.selectExpr("'customer-' || o_custkey", "'order-' || o_orderkey"))


@_query("WITH RECURSIVE e AS (SELECT 'region-' || n_regionkey AS src, 'nation-' || n_nationkey AS dst FROM nation UNION ALL SELECT 'nation-' || c_nationkey, 'customer-' || c_custkey FROM customer UNION ALL SELECT 'customer-' || o_custkey, 'order-' || o_orderkey FROM orders), r AS (SELECT 'region-1' AS node, 0 AS depth UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node) SELECT node, min(depth) AS depth FROM r GROUP BY node")
def dependency_closure(spark, d):
    return graph.closure(_dependencies(spark, d), spark.createDataFrame([("region-1",)], "node string"))


@_query()
def dependency_hash(spark, d):
    e = _dependencies(spark, d)
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct().withColumn("hash", F.crc32("node"))
    return graph.dependency_hash(nodes, e)


@_query("WITH RECURSIVE e AS (SELECT DISTINCT p_size AS a, CAST(p_partkey % 53 + 100 AS BIGINT) AS b FROM part WHERE p_partkey % 17 = 0), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS label FROM u UNION SELECT u.b, r.label FROM r JOIN u ON u.a = r.node) SELECT CAST(node AS BIGINT) AS node, CAST(min(label) AS BIGINT) AS label FROM r GROUP BY node")
def label_propagation(spark, d):
    e = table(spark, d, "part").where("p_partkey % 17 = 0").selectExpr("cast(p_size as bigint) src", "cast(p_partkey % 53 + 100 as bigint) dst").distinct()
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    return graph.propagate_labels(nodes.withColumn("label", F.col("node")), e)


@_query("WITH RECURSIVE e AS (SELECT DISTINCT p_size AS a, CAST(p_partkey % 53 + 100 AS BIGINT) AS b FROM part), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS label FROM u UNION SELECT u.b, r.label FROM r JOIN u ON u.a = r.node) SELECT CAST(node AS BIGINT) AS node, CAST(min(label) AS BIGINT) AS label FROM r GROUP BY node")
def label_propagation_all(spark, d):
    """label_propagation over every part."""
    e = table(spark, d, "part").selectExpr("cast(p_size as bigint) src", "cast(p_partkey % 53 + 100 as bigint) dst").distinct()
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    return graph.propagate_labels(nodes.withColumn("label", F.col("node")), e)
