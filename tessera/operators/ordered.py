"""Running values over an order. A total over all rows is summed part by part, so no task has to hold the whole order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.cut import cut

UP = (Window.unboundedPreceding, Window.currentRow)


def running_total(rows: DataFrame, order: list, value: Column, name: str, parts: int = 0) -> DataFrame:
    """rows with the sum of value up to each row in a total order over all rows; parts of the range are summed apart."""
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.withColumn("_v", value).repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy("_part").agg(F.sum("_v").alias("_s"))  # at most n rows
    before = sums.select("_part", (F.sum("_s").over(Window.orderBy("_part").rowsBetween(*UP)) - F.col("_s")).alias("_before"))
    inside = F.sum("_v").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(*UP))
    return dealt.withColumn(name, inside).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_v", "_before")


def kept_in_cache(entries: DataFrame, cap: int) -> DataFrame:
    """Entries (id, age, uses, size) that stay: the lowest of min(100, age) - min(100, 10 uses) first, while the sizes add up to cap at most."""
    score = F.least(F.lit(100), "age") - F.least(F.lit(100), 10 * F.col("uses"))
    return running_total(entries.withColumn("score", score), ["score", "id"], F.col("size"), "held").where(F.col("held") <= cap)


def hotkeys(rows: DataFrame, group: str, order: list, wanted: Column) -> DataFrame:
    """rows with hotkey: the last digit of the running number among the wanted rows of the group; else null."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(*UP)
    return rows.withColumn("hotkey", F.when(wanted, F.sum(wanted.cast("int")).over(w) % 10))


def running_offset(rows: DataFrame, group: str, order: list, size: Column) -> DataFrame:
    """rows with page, counted from 1, and offset, the sizes of the group's rows before it."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumns({"page": F.row_number().over(w), "offset": F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})


def batches(rows: DataFrame, group: str, order: list, limit: int) -> DataFrame:
    """rows with batch, from 0: a new one begins with each group and after limit rows."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1) / limit))


def serpentine(cells: DataFrame, width: int) -> DataFrame:
    """Distinct cells (x, y) with their place on a path that runs along each row, every second one backwards."""
    return cells.select("x", "y").distinct().withColumn("place", F.col("y") * width + F.when(F.col("y") % 2 == 0, F.col("x")).otherwise(width - 1 - F.col("x")))


def level_carry(levels: DataFrame, flag: Column) -> DataFrame:
    """levels (x, y, level) with roof: the highest flagged level up to this one, or null."""
    return levels.withColumn("roof", F.max(F.when(flag, F.col("level"))).over(Window.partitionBy("x", "y").orderBy("level").rowsBetween(*UP)))
