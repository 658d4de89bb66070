"""Writers: walk files, failure reports, path points, coordinate text, versioned files. Each writes from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import masks, text
from tessera.plans.cut import cut


def write_walk_json(tiles: DataFrame, folder: str, square: int = 64) -> None:
    """A line of JSON {chunk, tiles} for each square of tiles, in folders by chunk_x; what walk_json reads with lines=True."""
    where = {"chunk_x": F.floor(F.col("x") / square), "chunk_z": F.floor(F.col("y") / square)}
    tile = F.struct("x", "y", "plane", F.col("walk_mask").alias("walkMask"), masks.decode(F.col("walk_mask")).alias("walk"))
    chunks = tiles.withColumns(where).groupBy("chunk_x", "chunk_z").agg(F.array_sort(F.collect_list(tile)).alias("tiles"))  # at most square * square * planes tiles each
    chunk = F.struct(F.col("chunk_x").alias("x"), F.col("chunk_z").alias("z"), F.lit(square).alias("chunkSize"))
    chunks.select("chunk_x", chunk.alias("chunk"), "tiles").write.partitionBy("chunk_x").mode("overwrite").json(folder)


def write_failures(failures: DataFrame, folder: str) -> None:
    """Failures as csv/ (a column for each coordinate, empty where there is none) and as json/ (coordinates as arrays)."""
    f = cut(failures)
    parts = [F.get(c, F.lit(i)).alias(f"{c}_{a}") for c in ("start", "request_goal") for i, a in enumerate("xyz")]
    f.select("response_ts", "request_ts", *parts, "request_line", "response_line").write.mode("overwrite").option("header", True).csv(f"{folder}/csv")
    f.select("response_ts", "start", "request_ts", F.col("request_goal").alias("goal"), "request_line", "response_line").write.mode("overwrite").json(f"{folder}/json")


def path_points(paths: DataFrame) -> DataFrame:
    """entrance_from, entrance_to, step, x, y, plane of paths with a text path_blob; an empty or null path gives one row of nulls."""
    points = paths.select("entrance_from", "entrance_to", F.posexplode_outer(text.triplets(text.blob_bytes(F.col("path_blob")))).alias("step", "p"))
    return points.select("entrance_from", "entrance_to", "step", "p.x", "p.y", "p.plane")


def coordinate_lines(points: DataFrame, head: str, foot: str) -> DataFrame:
    """value: the lines of a code listing of points (n, x, y, plane), in order of n, with a comma after each but the last."""
    last = points.agg(F.max("n").alias("last"))
    line = F.format_string("    new Coordinate(%d, %d, %d)", "x", "y", "plane")
    body = points.crossJoin(F.broadcast(last)).select(F.col("n").cast("long").alias("n"), F.concat(line, F.when(F.col("n") < F.col("last"), ",").otherwise("")).alias("value"))  # one row
    ends = points.sparkSession.createDataFrame([(-(2**62), head), (2**62, foot)], "n long, value string")
    return body.unionByName(ends).orderBy("n").select("value")


def upsert_versions(versions: DataFrame, now: DataFrame) -> DataFrame:
    """versions (version, ...) with the rows of now whose version is not there yet, newest first."""
    return versions.unionByName(now.join(versions, "version", "left_anti")).orderBy(F.desc("version"))


def write_extract(records: DataFrame, folder: str, per_file: int = 0) -> None:
    """Records as JSON in folders by archive, at most per_file rows to a file if it is given."""
    out = records.write.mode("overwrite").partitionBy("archive")
    (out.option("maxRecordsPerFile", per_file) if per_file else out).json(folder)
