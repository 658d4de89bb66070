"""Catalogues of versions: which caches count, their build, their order, dates of a range, what lies near, which are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.assets import catalog_neighbours

#: caches: id, language, environment, game, timestamp, builds (array of major, minor)
ORDER = ("build", "minor")


def build_of(builds: Column) -> Column:
    """The first build that isn't 0, else -1."""
    return F.coalesce(F.get(F.filter(builds, lambda b: b["major"] != 0), F.lit(0))["major"], F.lit(-1))


def valid_caches(caches: DataFrame, blacklist: DataFrame) -> DataFrame:
    """The English live caches of the game that have a time and a build and aren't on the blacklist (id), newest build first, with build and minor."""
    own = caches.where("language = 'en' AND environment = 'live' AND game = 'runescape' AND timestamp IS NOT NULL AND size(builds) > 0")
    own = own.join(blacklist.select("id"), "id", "left_anti")
    first = F.get("builds", F.lit(0))
    return in_order(own.withColumns({"build": first["major"], "minor": F.coalesce(first["minor"], F.lit(0))}))


def _keys() -> list[Column]:
    return [F.desc("build"), F.desc("minor"), F.desc("timestamp"), F.asc("id")]


def in_order(caches: DataFrame) -> DataFrame:
    return caches.orderBy(*_keys())


def recent(caches: DataFrame, n: int) -> DataFrame:
    """The n-th of the catalogue, from 0; no row beyond its end."""
    return in_order(caches).offset(n).limit(1)


def between(caches: DataFrame, text: str) -> DataFrame:
    """Caches of a year ("2015", its end included), or from one year to another ("2010-2015", open at an end that isn't a number); rows without a time are left out."""
    lo, dash, hi = text.partition("-")
    # fixed values: where an open range begins and ends
    year = lambda t, default: int(t) if t.strip().isdigit() else default
    first = year(lo, 1900)
    last = year(hi, 2100) if dash else (first + 1 if lo.strip().isdigit() else 2100)
    return caches.where(F.col("timestamp").between(F.lit(f"{first:04d}-01-01").cast("timestamp"), F.lit(f"{last:04d}-01-01").cast("timestamp")))


def before(caches: DataFrame, moment: str) -> DataFrame:
    return caches.where(F.col("timestamp") < F.lit(moment).cast("timestamp"))


def near(caches: DataFrame, id_: int, n: int = 10) -> DataFrame:
    """The caches up to n places before or after one in the catalogue's order, with rn."""
    return catalog_neighbours(caches, _keys(), F.col("id") == id_, n)


def date_or(text: Column, default: str) -> Column:
    """A moment from text, or default if it isn't one."""
    return F.coalesce(text.try_cast("timestamp"), F.lit(default).cast("timestamp"))


def history_name(status: Column, major_name: Column, major: Column, minor: Column, sub: Column, source: Column, ext: Column) -> Column:
    """status-major-minor-sub-source.ext; a major without a name is unknown-<number>."""
    return F.format_string("%s-%s-%d-%d-%s.%s", status, F.coalesce(major_name, F.concat(F.lit("unknown-"), major.cast("string"))), minor.cast("long"), sub.cast("long"), source, ext)


def slowest(timings: DataFrame, n: int = 10, least: float = 0.01) -> DataFrame:
    """The n parsers that took longest in all, of those over least."""
    return timings.groupBy("parser").agg(F.sum("seconds").alias("seconds")).orderBy(F.desc("seconds"), "parser").limit(n).where(F.col("seconds") > least)


def kept_squares(squares: DataFrame, wanted: DataFrame, least: int = 8, most: int = 11) -> DataFrame:
    """Squares (id, x, z) that stay in memory: the wanted ones (x, z), and of the others, once there are most of them, the least newest by id."""
    old = squares.join(wanted.select("x", "z"), ["x", "z"], "left_anti")
    rank = old.withColumn("_n", F.row_number().over(Window.orderBy(F.desc("id")))).crossJoin(F.broadcast(old.agg(F.count("*").alias("_of"))))  # a scene's squares; one row
    stay = rank.where(F.when(F.col("_of") >= most, F.col("_n") <= least).otherwise(True)).select(*squares.columns)
    return squares.join(wanted.select("x", "z"), ["x", "z"], "left_semi").select(*squares.columns).unionAll(stay)


def first_of_each(files: DataFrame, group: str, order: list, n: int = 10) -> DataFrame:
    """The first n files of each group."""
    return files.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def by_size(files: DataFrame, column: str = "bytes") -> DataFrame:
    """Smallest first; then by major, minor and file."""
    return files.orderBy(F.octet_length(column), "major", "minor", "fileid")


def zigzag(cells: DataFrame, width: int, scan: int = 4) -> DataFrame:
    """Distinct cells (x, z) with place, their order in bands of scan rows: along a band, row by row inside a column."""
    step = width * scan
    return cells.select("x", "z").distinct().withColumn("place", F.col("x") * scan + F.floor(F.col("z") / scan) * step + F.col("z") % step)


def run_gate(states: DataFrame, own: str, hours: int = 20) -> DataFrame:
    """version, go: whether a run may be done: it isn't done yet, or it is one's own, or its lock is older than some hours. states: version, run, state, since, now."""
    old = F.col("since") < F.col("now") - F.expr(f"INTERVAL {hours} HOURS")
    return states.select("version", (F.col("state").isNull() | ((F.col("state") != "done") & ((F.col("run") == own) | old))).alias("go"))
