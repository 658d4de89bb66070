"""Readers: the driver's tables, walk files, override and coordinate text, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.cut import cut

WALK_JSON = "chunk struct<x:long,z:long,chunkSize:long>, tiles array<struct<x:long,y:long,plane:long,walkMask:long>>, _corrupt_record string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def walk_json(spark: SparkSession, folder: str) -> DataFrame:
    """x, y, plane, walk_mask, RegionID, file, pos of all tiles of the *.json files; a file that doesn't parse, or has a tile without x, y or plane, is left out whole."""
    raw = spark.read.schema(WALK_JSON).option("multiLine", True).option("mode", "PERMISSIVE").json(f"{folder}/*.json")
    good = raw.select("*", F.col("_metadata.file_path").alias("file")).where("_corrupt_record IS NULL AND NOT exists(coalesce(tiles, array()), t -> t.x IS NULL OR t.y IS NULL OR t.plane IS NULL)")
    rows = good.select("file", F.posexplode("tiles").alias("pos", "t"))
    x, y = F.col("t.x").cast("int"), F.col("t.y").cast("int")
    from tessera.functions.masks import region_id

    return rows.select(x.alias("x"), y.alias("y"), F.col("t.plane").cast("int").alias("plane"), F.col("t.walkMask").alias("walk_mask"), region_id(x, y).alias("RegionID"), "file", "pos")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), block, value of text files. A file is read in blocks by many tasks; their lines are counted first."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"))
    raw = cut(raw)
    count = raw.groupBy("file", "block").agg(F.count("*").alias("_n"))  # a row for each block
    before = count.select("file", "block", F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("_id"))
    return raw.withColumn("_own", own).join(before, ["file", "block"]).select("file", (F.col("_before") + F.col("_own")).alias("line"), "block", "value")


def overrides_text(spark: SparkSession, path: str) -> DataFrame:
    """line, x, y, plane, walk_mask of lines "x,y,plane,mask"; blanks are passed over, any other line stops the query with its number."""
    lines = numbered_lines(spark, path).where("trim(value) <> ''")
    parts = F.transform(F.split("value", ","), lambda p: F.trim(p).try_cast("int"))
    ok = (F.size(parts) == 4) & F.forall(parts, lambda p: p.isNotNull())
    parts = F.when(ok, parts).otherwise(F.raise_error(F.concat(F.lit("bad override on line "), F.col("line").cast("string"))).cast("array<int>"))
    return lines.select("line", parts.alias("p")).select("line", *(F.col("p")[k].alias(c) for k, c in enumerate(("x", "y", "plane", "walk_mask"))))


def coordinates_text(spark: SparkSession, path: str) -> DataFrame:
    """x, y, plane of the lines of three fields; others are dropped."""
    p = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.size(p) == 3).select(*(p[k].try_cast("int").alias(c) for k, c in enumerate(("x", "y", "plane"))))


def failures_log(spark: SparkSession, path: str) -> DataFrame:
    """Failures of logs with the request before, in the same file: file, response_line, response_ts, start, request_line, request_ts, request_start, request_goal.

    The last request is carried on inside a block of the file; what the blocks before had last is added to that.
    """
    lines = numbered_lines(spark, path).withColumnRenamed("value", "s")
    ts = F.nullif(F.regexp_extract("s", r"^\[(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3})\]", 1), F.lit(""))
    triple = lambda k: F.when(F.col("s").rlike(rf"{k}=\[X: -?\d+, Y: -?\d+, Z: -?\d+\]"), F.array(*(F.regexp_extract("s", rf"{k}=\[X: (-?\d+), Y: (-?\d+), Z: (-?\d+)\]", i).cast("int") for i in (1, 2, 3))))
    request = F.when(F.contains("s", F.lit("Options(command=python3")) & triple("start").isNotNull(), F.struct(F.col("line"), ts.alias("ts"), triple("start").alias("start"), triple("goal").alias("goal")))
    fails = F.contains("s", F.lit("start_coordinate_not_found"))
    # only lines that say something go on
    some = cut(lines.withColumn("request", request).where(F.col("request").isNotNull() | fails))
    last = some.groupBy("file", "block").agg(F.max_by("request", F.when(F.col("request").isNotNull(), F.col("line"))).alias("_last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("file", "block", F.last("_last", ignorenulls=True).over(earlier).alias("_earlier"))  # a row for each block
    inside = F.last("request", ignorenulls=True).over(Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    with_request = some.withColumn("request", inside).join(last, ["file", "block"]).withColumn("request", F.coalesce("request", "_earlier"))
    payload = F.from_json(F.expr("substring(s, instr(s, '{'))"), "actions array<struct<metadata:struct<reason:string>,from:struct<max:array<int>,min:array<int>>>>")
    found = with_request.where(fails).select("file", "line", ts.alias("ts"), "request", F.explode(F.filter(payload["actions"], lambda a: a["metadata"]["reason"] == "start_coordinate_not_found")).alias("a"))
    start = F.when(F.size("a.from.max") == 3, F.col("a.from.max")).when(F.size("a.from.min") == 3, F.col("a.from.min"))
    return found.select("file", F.col("line").alias("response_line"), F.col("ts").alias("response_ts"), start.alias("start"), F.col("request.line").alias("request_line"), F.col("request.ts").alias("request_ts"), F.col("request.start").alias("request_start"), F.col("request.goal").alias("request_goal"))


def path_table(spark: SparkSession, name: str, entrance_from: int | None = None) -> DataFrame:
    """Rows of a table of paths, by its ends; its name may hold letters, digits and _ only."""
    if not name.isidentifier():
        raise ValueError(f"not a table's name: {name}")
    rows = spark.table(name)
    return (rows if entrance_from is None else rows.where(F.col("entrance_from") == entrance_from)).orderBy("entrance_from", "entrance_to")
