"""The tile relation that the library's queries use, derived from lineitem, and the same in SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.masks import DIRECTIONS, region_id
from tessera.plans.cut import cut
from tessera.sources.tables import table


#: Lines that fall on a place of the grid on the average, so that it grows with the tables and stays as dense.
LINES_PER_PLACE = 3.75


def side(spark: SparkSession, sf_dir: str) -> int:
    """Places along a side of the grid."""
    return int(math.sqrt(table(spark, sf_dir, "lineitem").count() / LINES_PER_PLACE))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, y, plane, walk_mask, RegionID."""
    m = side(spark, sf_dir)
    h = F.sum(F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber"))
    cells = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % m).cast("int").alias("x"), (F.col("l_orderkey") % m).cast("int").alias("y")).agg(h.alias("h")).where("h % 10 >= 1")
    mask = sum((F.when((F.col("h") * (2 * i + 3) + 7 * i) % 13 >= 2, 1 << i).otherwise(0) for i in range(8)), F.lit(0))
    return cells.select("x", "y", F.lit(0).alias("plane"), mask.cast("long").alias("walk_mask"), region_id(F.col("x"), F.col("y")).alias("RegionID"))


def start(t: DataFrame, m: int) -> DataFrame:
    """The tile with a cardinal bit nearest to the middle."""
    d = (F.col("x") - m // 2) * (F.col("x") - m // 2) + (F.col("y") - m // 2) * (F.col("y") - m // 2)
    return t.where("(walk_mask & 15) <> 0").orderBy(d, "x", "y").limit(1).select("x", "y", "plane")


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, y, plane, force_mask, or_mask from returned lines: the last line of a tile counts."""
    m = side(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_linenumber = 1 AND l_orderkey % 16 = 0")
    at = [(F.col("l_partkey") % m).cast("int").alias("x"), (F.col("l_orderkey") % m).cast("int").alias("y")]
    last = li.groupBy(*at).agg(F.max_by((F.col("l_suppkey") % 256).cast("int"), F.struct("l_orderkey", "l_partkey", "l_suppkey")).alias("force_mask"))
    return last.select("x", "y", F.lit(0).alias("plane"), "force_mask", F.lit(None).cast("int").alias("or_mask"))


def every_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like overrides(), from all returned lines in the order of (l_orderkey, l_linenumber)."""
    m = side(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    at = [(F.col("l_partkey") % m).cast("int").alias("x"), (F.col("l_orderkey") % m).cast("int").alias("y")]
    last = li.groupBy(*at).agg(F.max_by((F.col("l_suppkey") % 256).cast("int"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("force_mask"))
    return last.select("x", "y", F.lit(0).alias("plane"), "force_mask", F.lit(None).cast("int").alias("or_mask"))


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") % 500).cast("int").alias("x"), (F.col("c_nationkey") * 3).cast("int").alias("y"), F.lit(0).alias("plane"))


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.tiles import reconcile

    return cut(reconcile(tiles(spark, sf_dir)))


DIR_SQL = ", ".join(f"({b}, {dx}, {dy}, {o}, {n})" for b, _, dx, dy, o, n in DIRECTIONS)
TILES_SQL = f"""
side AS (SELECT CAST(floor(sqrt(count(*) / {LINES_PER_PLACE})) AS INT) AS m FROM lineitem),
cells AS (SELECT CAST(l_partkey % m AS INT) AS x, CAST(l_orderkey % m AS INT) AS y, CAST(sum(l_orderkey * 31 + l_partkey * 17 + l_linenumber) AS BIGINT) AS h FROM lineitem, side GROUP BY 1, 2),
tiles AS (SELECT x, y, 0 AS plane, CAST({" + ".join(f"CASE WHEN (h * {2 * i + 3} + {7 * i}) % 13 >= 2 THEN {1 << i} ELSE 0 END" for i in range(8))} AS BIGINT) AS walk_mask, ((x >> 6) << 8) + (y >> 6) AS RegionID FROM cells WHERE h % 10 >= 1),
d(bit, dx, dy, opp, needs) AS (VALUES {DIR_SQL}),
e0 AS (SELECT t.x, t.y, d.bit, d.needs, n.x AS nx, n.y AS ny FROM tiles t, d, tiles n WHERE n.x = t.x + d.dx AND n.y = t.y + d.dy AND (t.walk_mask & (1 << d.bit)) <> 0 AND (n.walk_mask & (1 << d.opp)) <> 0),
card AS (SELECT x, y, bit_or(1 << bit) AS c FROM e0 WHERE bit < 4 GROUP BY x, y),
rec AS (SELECT e0.* FROM e0 LEFT JOIN card USING (x, y) WHERE bit < 4 OR (c & needs) = needs)
"""
REACH_SQL = """
begin AS (SELECT x, y FROM side, tiles JOIN (SELECT x, y, bit_or(1 << bit) AS m2 FROM rec GROUP BY x, y) r USING (x, y) WHERE (m2 & 15) <> 0 ORDER BY (x - m // 2) * (x - m // 2) + (y - m // 2) * (y - m // 2), x, y LIMIT 1),
reach AS (SELECT x, y FROM begin UNION SELECT rec.nx, rec.ny FROM reach JOIN rec ON rec.x = reach.x AND rec.y = reach.y)
"""
EVERY_OVERRIDE_SQL = "over_ AS (SELECT CAST(l_partkey % m AS INT) AS x, CAST(l_orderkey % m AS INT) AS y, max_by(CAST(l_suppkey % 256 AS INT), (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS force_mask FROM lineitem, side WHERE l_returnflag = 'R' GROUP BY 1, 2)"
RINGS_SQL = """ring AS (SELECT CAST(c_custkey % 500 AS INT) AS x, CAST(c_nationkey * 3 AS INT) AS y FROM customer),
ring_all AS (SELECT x, y, 255 AS f, 0 AS o FROM ring UNION ALL SELECT x + d.dx, y + d.dy, NULL, (1 << d.opp) | d2.needs FROM ring, d JOIN d d2 ON d2.bit = d.opp),
ring_over AS (SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, max(f) AS force_mask, CAST(bit_or(o) AS INT) AS or_mask FROM ring_all GROUP BY 1, 2)"""
_BEFORE, _AFTER = TILES_SQL.split("\ne0 AS", 1)
#: As TILES_SQL and REACH_SQL, with overrides in tiles and reachability from all seeds; ends are named by the caller.
CLEAN_SQL = f"""{_BEFORE.replace("tiles AS (", "raw AS (")}
{EVERY_OVERRIDE_SQL}, {RINGS_SQL},
tiles AS (SELECT x, y, plane, coalesce(r.force_mask, coalesce(o.force_mask, walk_mask) | coalesce(r.or_mask, 0)) AS walk_mask, RegionID FROM raw LEFT JOIN over_ o USING (x, y) LEFT JOIN ring_over r USING (x, y)),
e0 AS{_AFTER}, {REACH_SQL.split("reach AS", 1)[0]}
seeds AS (SELECT x, y FROM begin UNION SELECT x, y FROM ends UNION SELECT x, y FROM ring),
reach AS (SELECT x, y FROM seeds JOIN tiles USING (x, y) UNION SELECT rec.nx, rec.ny FROM reach JOIN rec ON rec.x = reach.x AND rec.y = reach.y)
"""
