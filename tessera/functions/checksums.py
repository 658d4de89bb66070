"""Checksums of assets: seeded, strided and forged CRC32, and the hashes of placements, floors, scripts and meshes as columns."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from tessera.functions.hashes import big_endian, crc_chain


@F.pandas_udf(LongType())
def seeded_crc(data: pd.Series, seed: pd.Series) -> pd.Series:
    """CRC32 of the bytes, going on from seed."""
    return pd.Series([None if d is None else zlib.crc32(d, int(s)) for d, s in zip(data, seed, strict=True)], dtype="Int64")


def crc_range(data: Column, begin: Column, end: Column) -> Column:
    """CRC32 of the bytes from begin up to end."""
    return F.crc32(F.substring(data, begin + 1, end - begin))


@F.pandas_udf(LongType())
def strided_crc(data: pd.Series, offset: pd.Series, stride: pd.Series, size: pd.Series, count: pd.Series) -> pd.Series:
    """CRC32 over count groups of size bytes that begin stride apart, the first at offset."""
    out = []
    for d, at, step, n, k in zip(data, offset, stride, size, count, strict=True):
        places = (int(at) + int(step) * np.arange(int(k)))[:, None] + np.arange(int(n))
        out.append(None if d is None else zlib.crc32(np.frombuffer(d, np.uint8)[places.ravel()].tobytes()))
    return pd.Series(out, dtype="Int64")


def _tables() -> tuple[list[int], list[int]]:
    """What a byte does to a register, and which byte has a given top byte there."""
    table = []
    for k in range(256):
        c = k
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    back = [0] * 256
    for k, c in enumerate(table):
        back[c >> 24] = k
    return table, back


def forge_bytes(front: int, wanted: int) -> bytes:
    """Four bytes that, put after bytes of checksum front, make the checksum wanted."""
    table, back = _TABLES
    r = wanted ^ 0xFFFFFFFF
    for _ in range(4):
        k = back[r >> 24]
        r = (r ^ table[k]) << 8 & 0xFFFFFFFF | k
    return (r ^ front ^ 0xFFFFFFFF).to_bytes(4, "little")


@F.pandas_udf(BinaryType())
def forged(front: pd.Series, wanted: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else forge_bytes(int(a), int(b)) for a, b in zip(front, wanted, strict=True)], dtype=object)


# -- of assets ----------------------------------------------------------------------------------------


def _chain(numbers: Column) -> Column:
    """Bytes of an array of numbers, four each."""
    return F.unhex(F.array_join(F.transform(numbers, lambda v: F.substring(F.lpad(F.hex(F.coalesce(v, F.lit(0)).cast("long")), 16, "0"), 9, 8)), ""))


def placement_bytes(loc: Column, rotation: Column, kind: Column, turn: Column | None = None, moved: list[Column] | None = None) -> Column:
    """What the hash of a placement is taken of: object, rotation and type, then, of placements that are moved, the four numbers of a turn if there is one, and seven more (missing: 0)."""
    own = F.concat(big_endian(loc), big_endian(rotation), big_endian(kind))
    if moved is None:
        return own
    more = F.concat(*(big_endian(F.coalesce(m, F.lit(0))) for m in moved))
    four = F.when(turn.isNotNull(), _chain(F.slice(turn, 1, 4))).otherwise(F.lit(b"")) if turn is not None else F.lit(b"")
    return F.concat(own, four, more)


def placement_hash(loc: Column, rotation: Column, kind: Column, turn: Column | None = None, moved: list[Column] | None = None) -> Column:
    return F.crc32(placement_bytes(loc, rotation, kind, turn, moved))


def height_hash(placement: Column, heights: Column, base: Column) -> Column:
    """Checksum of a placement's bytes and the heights around it (an array, in order) above that of its own tile."""
    return F.crc32(F.concat(placement, _chain(F.transform(heights, lambda h: h - base))))


def floor_groups(tiles: DataFrame, levels: int = 4, size: int = 2) -> DataFrame:
    """gx, gz, hashes: for each square of size x size tiles and each level the checksum of the visible tiles shown there.

    tiles: x, z, level, visible, effective (the level from which a tile shows), height, overlay, settings, shape, underlay. Tiles go by
    level, then x, then z; one without anything visible is passed over.
    """
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1))
    own = crc_chain(*(number(c) for c in ("height", "overlay", "settings", "shape", "underlay")), F.col("effective"))
    at = {"gx": F.floor(F.col("x") / size), "gz": F.floor(F.col("z") / size)}
    rows = tiles.where("visible").withColumns(at).select("gx", "gz", F.struct("level", "x", "z", "effective", own.alias("hash")).alias("t"))
    sorted_ = F.array_sort(F.collect_list("t"))  # at most size * size * levels tiles
    shown = lambda k: F.crc32(F.concat(F.lit(b""), _chain(F.transform(F.filter("ts", lambda t: t["effective"] <= k), lambda t: t["hash"]))))
    return rows.groupBy("gx", "gz").agg(sorted_.alias("ts")).select("gx", "gz", F.array(*(shown(k) for k in range(levels))).alias("hashes"))


def rect_hash(rects: DataFrame, squares: DataFrame) -> DataFrame:
    """id, hash, exists of rects (id, x, z, xsize, zsize, in squares): the checksum of the hashes of their squares (x, z, hash), row by row; a missing square counts as 0."""
    cells = rects.select("id", F.explode(F.sequence(F.col("z"), F.col("z") + F.col("zsize") - 1)).alias("z"), "x", "xsize").select("id", "z", F.explode(F.sequence(F.col("x"), F.col("x") + F.col("xsize") - 1)).alias("x"))
    j = cells.join(squares.select("x", "z", "hash"), ["x", "z"], "left")
    return j.groupBy("id").agg(F.crc32(_chain(F.transform(F.array_sort(F.collect_list(F.struct("z", "x", F.coalesce("hash", F.lit(0)).alias("h")))), lambda c: c["h"]))).alias("hash"), F.bool_or(F.col("hash").isNotNull()).alias("exists"))


def script_hash(head: list[Column], ops: Column, switches: Column) -> Column:
    """Checksum of a script: its numbers, then each operation (opcode, imm, ints: more numbers or null, text or null), then its switches (arrays of value, jump), each with its length."""
    hex4 = lambda v: F.substring(F.lpad(F.hex(v.cast("long")), 16, "0"), 9, 8)
    op = lambda o: F.concat(hex4(o["opcode"]), hex4(o["imm"]), F.coalesce(F.array_join(F.transform(o["ints"], hex4), ""), F.lit("")), F.coalesce(F.hex(F.encode(o["text"], "ISO-8859-1")), F.lit("")))
    case = lambda s: F.concat(hex4(F.size(s)), F.array_join(F.transform(s, lambda c: F.concat(hex4(c["value"]), hex4(c["jump"]))), ""))
    return F.crc32(F.unhex(F.concat(*map(hex4, head), F.array_join(F.transform(ops, op), ""), hex4(F.size(switches)), F.array_join(F.transform(switches, case), ""))))


def mesh_hashes(*buffers: Column) -> list[Column]:
    """For each buffer of a mesh (texture places, normals, positions) the checksum of its first twenty bytes and of all."""
    return [h for b in buffers for h in (F.crc32(F.substring(b, 1, 20)), F.crc32(b))]


_TABLES = _tables()
