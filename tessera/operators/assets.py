"""Versioned assets: index statistics, snapshot differences, version histories, as-of and range lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import running_total


def index_overview(files: DataFrame) -> DataFrame:
    """For each major: count, total, largest, smallest, mean size (2 places), highest minor, missing minors. files: major, minor, size."""
    cents = F.col("size").cast("decimal(18,2)")  # sums don't depend on the order
    return files.groupBy("major").agg(F.count("*").alias("files"), F.sum(cents).cast("double").alias("total"), F.max("size").alias("largest"), F.min("size").alias("smallest"), (F.floor(F.sum(cents).cast("double") / F.count("*") * 100 + 0.5) / 100).alias("mean"), F.max("minor").alias("highest")).withColumn("missing", F.col("highest") + 1 - F.col("files"))


def gaps(ids: DataFrame, group: str, id_: str) -> DataFrame:
    """First and last missing id of each gap inside a group."""
    nxt = F.lead(id_).over(Window.partitionBy(group).orderBy(id_))
    return ids.select(group, id_).distinct().withColumn("_n", nxt).where(F.col("_n") > F.col(id_) + 1).select(group, (F.col(id_) + 1).alias("gap_from"), (F.col("_n") - 1).alias("gap_to"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, change (add, delete, edit) between two snapshots; equal rows are left out. One shuffle by key."""
    a, b = old.select(*key, F.col(value).alias("_a"), F.lit(True).alias("_ina")), new.select(*key, F.col(value).alias("_b"), F.lit(True).alias("_inb"))
    change = F.when(F.col("_ina").isNull(), "add").when(F.col("_inb").isNull(), "delete").when(~F.col("_a").eqNullSafe(F.col("_b")), "edit")
    return a.join(b, key, "full").select(*key, change.alias("change")).where("change IS NOT NULL")


def version_history(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Runs of equal values in order: key, run, value, first and last place, how many."""
    w = Window.partitionBy(key).orderBy(*order)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int")
    r = rows.withColumn("_pos", F.row_number().over(w)).withColumn("_new", F.when(F.col("_pos") == 1, 1).otherwise(changed))
    r = r.withColumn("run", F.sum("_new").over(w))
    return r.groupBy(key, "run").agg(F.min(value).alias(value), F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"), F.count("*").alias("n"))


def file_history(rows: DataFrame, versions: DataFrame, key: str, version: str, value: str) -> DataFrame:
    """Runs of equal values of a file over all versions: key, run, value, versions (in order). A version without the file ends a run.

    rows: key, version, value; versions: version, all there are, in their order.
    """
    numbered = running_total(versions.select(version).distinct(), [version], F.lit(1), "_at")
    w = Window.partitionBy(key).orderBy("_at")
    r = rows.join(numbered, version)
    same = F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.col("_at") == F.lag("_at").over(w) + 1)
    r = r.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("_new").over(w))
    return r.groupBy(key, "run").agg(F.min(value).alias(value), F.array_sort(F.collect_list(version)).alias("versions"))


def as_of(rows: DataFrame, order: list[str], is_request, is_response, group: str) -> DataFrame:
    """Each response with the id of the last request of its group before it (event_id, request_id)."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("request_id", F.last(F.when(is_request, F.col("event_id")), ignorenulls=True).over(w)).where(is_response).select(group, "event_id", "request_id")


def nearest(rows: DataFrame, when: str, moment: str, n: int, key: str) -> DataFrame:
    """The n rows nearest to a moment in time; ties by key."""
    return rows.withColumn("_d", F.abs(F.unix_micros(F.col(when).cast("timestamp")) - F.unix_micros(F.lit(moment).cast("timestamp")))).orderBy("_d", key).limit(n).drop("_d")


def catalog_neighbours(rows: DataFrame, order: list, mine, k: int) -> DataFrame:
    """Rows up to k places before or after the first row where mine is true, with rn, their place; order is total."""
    numbered = running_total(rows, order, F.lit(1), "rn").withColumn("rn", F.col("rn").cast("int"))
    at = numbered.where(mine).agg(F.min("rn").alias("_rn"))  # one row
    return numbered.join(F.broadcast(at), F.abs(F.col("rn") - F.col("_rn")) <= k).drop("_rn")


def first_range(left: DataFrame, right: DataFrame, on: list[str], lo: str, hi: str, rlo: str, rhi: str, rkey: str) -> DataFrame:
    """Left rows with the key of the first right row of the same group whose range overlaps; an equi-join on the group first."""
    j = left.join(right, on).where((F.col(lo) <= F.col(rhi)) & (F.col(rlo) <= F.col(hi)))
    return j.groupBy(*left.columns).agg(F.min(rkey).alias(rkey))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of both; where both have a key the columns that new has replace those of old, and the others stay."""
    given = [c for c in new.columns if c not in key]
    n = new.select(*key, *(F.col(c).alias(f"_new_{c}") for c in given), F.lit(True).alias("_in"))
    cols = [F.when(F.col("_in"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in old.columns]
    return old.join(n, key, "full").select(*cols)


def lookup_default(rows: DataFrame, entries: DataFrame, on: str, value: str, default) -> DataFrame:
    """Left lookup with a default; of several entries with a key the least by pos counts."""
    first = entries.groupBy(on).agg(F.min_by(value, "pos").alias(value))
    return rows.join(first, on, "left").withColumn(value, F.coalesce(value, F.lit(default)))
