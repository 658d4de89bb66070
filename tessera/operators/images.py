"""Images as bytes: palette sprites to pixels, their hashes, equality, bounds and emptiness; areas of an image that polygons touch.

Pixels are rows of width * height * 4 bytes, red, green, blue, alpha. Work goes by Arrow batches, one image at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tessera.plans.cut import cut


def _paletted(data: np.ndarray, palette: np.ndarray, width: int, height: int, alpha: bool, columns: bool) -> np.ndarray:
    """Pixels of one image of palette numbers (0: nothing), by columns or by rows, then of its alphas if it has them."""
    n = width * height
    shaped = (lambda x: x.reshape(width, height).T) if columns else (lambda x: x.reshape(height, width))
    index = shaped(data[:n])
    colours = np.concatenate([np.zeros((1, 3), np.uint8), palette, np.zeros((256, 3), np.uint8)])
    # alphas are always by rows' places as the numbers are
    opaque = shaped(data[n : 2 * n]) if alpha else np.full((height, width), 255, np.uint8)
    out = np.dstack([colours[index], opaque])
    out[index == 0] = 0
    return out


def read_sprites(data: bytes) -> list[tuple[int, int, int, int, np.ndarray]]:
    """(x, y, full width, full height, pixels) of each image: many under one palette, described at the end, or one of full colours."""
    b = np.frombuffer(data, np.uint8)
    last = int.from_bytes(data[-2:], "big")
    count = last & 0x7FFF
    if last >> 15:
        if b[0]:
            raise ValueError(f"unknown type {b[0]}")
        width, height = (int.from_bytes(data[k : k + 2], "big") for k in (2, 4))
        n = width * height
        colours = b[6 : 6 + 3 * n].reshape(height, width, 3)
        # fixed value: alphas begin two bytes after the colours
        alpha = b[8 + 3 * n : 8 + 4 * n].reshape(height, width) if b[1] & 1 else np.full((height, width), 255, np.uint8)
        return [(0, 0, width, height, np.dstack([colours, alpha]))]
    foot = len(data) - 7 - 8 * count
    full = tuple(int.from_bytes(data[foot + k : foot + k + 2], "big") for k in (0, 2))
    colours = int(b[foot + 4])
    box = np.frombuffer(data, ">u2", 4 * count, foot + 5).reshape(4, count).astype(int)
    palette = b[foot - 3 * colours : foot].reshape(-1, 3)
    out, at = [], 0
    for x, y, width, height in box.T.tolist():
        if width and height:
            flags = int(b[at])
            n = width * height * (2 if flags & 2 else 1)
            out.append((x, y, *full, _paletted(b[at + 1 : at + 1 + n], palette, width, height, bool(flags & 2), bool(flags & 1))))
            at += 1 + n
    return out


_SPRITE = "id long, sub int, x int, y int, full_width int, full_height int, width int, height int, pixels binary, error string"


def sprites(files: DataFrame) -> DataFrame:
    """A row for each image of sprite files (id, bytes)."""
    names = [f.split()[0] for f in _SPRITE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), *[pa.int32()] * 7, pa.binary(), pa.string())
        for b in batches:
            rows = []
            for i, data in zip(b.column("id").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                try:
                    rows += [(i, k, x, y, fw, fh, p.shape[1], p.shape[0], p.tobytes(), None) for k, (x, y, fw, fh, p) in enumerate(read_sprites(data))]
                except Exception as e:  # a bad file must not stop the others
                    rows.append((i, *[None] * 8, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return files.select(F.col("id").cast("long").alias("id"), "bytes").mapInArrow(run, _SPRITE)


@F.pandas_udf(LongType())
def sprite_hash(pixels: pd.Series) -> pd.Series:
    """CRC32 of the pixels, with a blue of 1 where it is 0."""

    def one(p: bytes | None) -> int | None:
        if p is None:
            return None
        a = np.frombuffer(p, np.uint8).reshape(-1, 4).copy()
        a[a[:, 2] == 0, 2] = 1
        return zlib.crc32(a.tobytes())

    return pd.Series(list(map(one, pixels)), dtype="Int64")


def _array(pixels: bytes, width: int) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8).reshape(-1, int(width), 4)


@F.pandas_udf(StructType([StructField(n, IntegerType()) for n in ("x", "y", "width", "height")]))
def bounds(pixels: pd.Series, width: pd.Series) -> pd.DataFrame:
    """The smallest box around all pixels that are not wholly transparent; nothing but zeros for none."""
    out = []
    for p, w in zip(pixels, width, strict=True):
        seen = _array(p, w)[:, :, 3] > 0
        ys, xs = np.flatnonzero(seen.any(1)), np.flatnonzero(seen.any(0))
        out.append((xs[0], ys[0], xs[-1] - xs[0] + 1, ys[-1] - ys[0] + 1) if len(xs) else (0, 0, 0, 0))
    return pd.DataFrame(out, columns=["x", "y", "width", "height"])


def is_empty(mode: str = "transparent"):
    """A column function of (pixels): whether all pixels are transparent, or (mode black) 0 in every channel."""
    channels = slice(3, 4) if mode == "transparent" else slice(0, 4)

    @F.pandas_udf(BooleanType())
    def empty(pixels: pd.Series) -> pd.Series:
        return pixels.map(lambda p: not np.frombuffer(p, np.uint8).reshape(-1, 4)[:, channels].any())

    return empty


@F.pandas_udf(BooleanType())
def equal(a: pd.Series, b: pd.Series, width: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    """Whether two images of one size agree in the box from (x1, y1) up to (x2, y2): no pixel's channels differ by 5 or more in sum."""

    def one(p, q, w, xa, ya, xb, yb):
        if len(p) != len(q):
            raise ValueError("images of different size")
        s, t = (_array(v, w)[int(ya) : int(yb), int(xa) : int(xb)].astype(int) for v in (p, q))
        return bool((np.abs(s - t).sum(2) < 5).all())

    return pd.Series([one(*r) for r in zip(a, b, width, x1, y1, x2, y2, strict=True)])


# -- areas --------------------------------------------------------------------------------------------


def touched_cells(boxes: DataFrame, size: int = 64) -> DataFrame:
    """image, cx, cy: cells of a size x size grid over [-1, 1] x [-1, 1] that boxes (image, x1, y1, x2, y2) touch; what lies outside is cut off."""
    cell = lambda c, edge: F.least(F.lit(size - 1), F.greatest(F.lit(0), F.floor((F.col(c) + 1) / 2 * size + edge)))
    seen = boxes.where("x2 >= -1 AND x1 <= 1 AND y2 >= -1 AND y1 <= 1")
    wide = seen.select("image", F.explode(F.sequence(cell("x1", 0), cell("x2", 0))).alias("cx"), "y1", "y2")
    return wide.select("image", "cx", F.explode(F.sequence(cell("y1", 0), cell("y2", 0))).alias("cy")).distinct()


def projected_boxes(polygons: DataFrame, projection: list[list[float]]) -> DataFrame:
    """image, id, x1, y1, x2, y2, inside of polygons (image, id, points: arrays of x, y, z) under a 4 x 4 matrix: the box around the places on the image, and whether it meets the image."""
    row = lambda k, p: sum((F.lit(float(projection[k][j])) * p[a] for j, a in enumerate("xyz")), F.lit(float(projection[k][3])))
    flat = lambda p: F.struct((row(0, p) / row(3, p)).alias("x"), (row(1, p) / row(3, p)).alias("y"))
    on = F.transform("points", flat)
    side = lambda f, a: f(F.transform(on, lambda p: p[a]))
    out = polygons.select("image", "id", *(side(f, a).alias(f"{a}{n}") for n, f in ((1, F.array_min), (2, F.array_max)) for a in "xy"))
    return out.withColumn("inside", F.expr("x2 >= -1 AND x1 <= 1 AND y2 >= -1 AND y1 <= 1"))


def coverage(cells: DataFrame, size: int = 64) -> DataFrame:
    """image, share: which part of the grid's cells is touched."""
    return cells.groupBy("image").agg((F.count("*") / (size * size)).alias("share"))


def _cluster(points: np.ndarray, most: int, rounds: int) -> np.ndarray:
    """x1, y1, x2, y2 (inclusive) of at most `most` boxes around the cells: seeds far apart, each cell to the nearest box, boxes drawn again."""
    seeds = [points[0]]
    while len(seeds) < min(most, len(points)):
        away = np.abs(points[:, None] - np.array(seeds)[None]).sum(2).min(1)
        if not away.any():
            break
        seeds.append(points[int(away.argmax())])
    boxes = np.hstack([np.array(seeds)] * 2)
    for _ in range(rounds):
        off = np.maximum(boxes[None, :, :2] - points[:, None], 0) + np.maximum(points[:, None] - boxes[None, :, 2:], 0)
        own = off.sum(2).argmin(1)
        new = np.array([np.r_[points[own == k].min(0), points[own == k].max(0)] for k in np.unique(own)])
        if new.shape == boxes.shape and (new == boxes).all():
            break
        boxes = new
    return boxes


def _merged(boxes: np.ndarray, filled: set, full: float) -> np.ndarray:
    """Two boxes become one as long as the cells in the box around both fill it to more than full."""
    out = [tuple(b) for b in boxes]
    again = True
    while again:
        again = False
        for i in range(len(out)):
            for j in range(i):
                a, b = out[i], out[j]
                u = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
                area = (u[2] - u[0] + 1) * (u[3] - u[1] + 1)
                if sum((x, y) in filled for x in range(u[0], u[2] + 1) for y in range(u[1], u[3] + 1)) > full * area:
                    out = [o for k, o in enumerate(out) if k not in (i, j)] + [u]
                    again = True
                    break
            if again:
                break
    return np.array(sorted(out))


def cell_boxes(cells: DataFrame, most: int = 16, rounds: int = 10, full: float = 0.9) -> DataFrame:
    """image, x, y, w, h: boxes that hold all touched cells of each image (a grid is of bounded size)."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf[["cx", "cy"]].drop_duplicates().sort_values(["cx", "cy"]).to_numpy()
        b = _merged(_cluster(points, most, rounds), set(map(tuple, points.tolist())), full)
        return pd.DataFrame({"image": key[0], "x": b[:, 0], "y": b[:, 1], "w": b[:, 2] - b[:, 0] + 1, "h": b[:, 3] - b[:, 1] + 1})

    kind = cells.schema["image"].dataType.simpleString()
    return cut(cells.groupBy("image").applyInPandas(run, f"image {kind}, x long, y long, w long, h long"))


def reused(tasks: DataFrame, stored: DataFrame) -> DataFrame:
    """tasks (name, hash) with file, the stored one of the same name and hash (the newest by version), and action: reuse or render."""
    best = stored.groupBy("name", "hash").agg(F.max_by("file", "version").alias("file"))
    return tasks.join(best, ["name", "hash"], "left").withColumn("action", F.when(F.col("file").isNotNull(), "reuse").otherwise("render"))


def distinct_images(images: DataFrame, order: str) -> DataFrame:
    """One row for each hash: the last by order."""
    kept = [c for c in images.columns if c != "hash"]
    return images.groupBy("hash").agg(F.max_by(F.struct(*kept), order).alias("_r")).select("hash", *(F.col(f"_r.{c}").alias(c) for c in kept))


def zoom_range(tile: Column, xsize: Column, zsize: Column, per_square: Column) -> Column:
    """struct min, max, base: zooms at which a map of xsize by zsize squares fits one image of tile pixels, a layer has its own scale, and a square fills an image."""
    least = F.floor(F.log2(tile / (F.greatest(xsize, zsize) * 64)))
    return F.struct(least.alias("min"), F.log2(per_square.cast("double")).alias("max"), F.log2(tile / 64).alias("base"))
