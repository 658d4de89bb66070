"""Tiles kept up to date from a stream of walk files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WALK_LINES = "chunk struct<x:long,z:long,chunkSize:long>, tiles array<struct<x:long,y:long,plane:long,walkMask:long>>"


def changes(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """x, y, plane, walk_mask, seen (time of the file) of the tiles in walk files of a chunk a line, as they arrive."""
    raw = spark.readStream.schema(WALK_LINES).option("maxFilesPerTrigger", files_at_once).option("recursiveFileLookup", True).json(folder)
    rows = raw.select(F.col("_metadata.file_modification_time").alias("seen"), F.inline("tiles"))
    return rows.where("x IS NOT NULL AND y IS NOT NULL AND plane IS NOT NULL").select(*(F.col(c).cast("int").alias(c) for c in ("x", "y", "plane")), F.col("walkMask").alias("walk_mask"), "seen")


def keep_latest(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch to folder/batch=n, over what a lost attempt at the same batch left; ends when all that has arrived is in."""

    def write(batch: DataFrame, n: int) -> None:
        newest = batch.groupBy("x", "y", "plane").agg(F.max_by("walk_mask", "seen").alias("walk_mask"), F.max("seen").alias("seen"))
        newest.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The last mask of each tile over all batches."""
    order = F.struct("seen", "batch")
    return spark.read.parquet(folder).groupBy("x", "y", "plane").agg(F.max_by("walk_mask", order).alias("walk_mask"))
