"""Tables that end a plan's lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of the session's own only where none is set and all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_.isDefined():
            return set_.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, *by: str) -> DataFrame:
    """df as a table, in folders by some columns if they are given."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tessera-cut-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
