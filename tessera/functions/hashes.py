"""Checksums, byte order and ciphers as columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def big_endian(v: Column, size: int = 4) -> Column:
    """The lowest bytes of a number, highest first."""
    return F.unhex(F.substring(F.lpad(F.hex(v.cast("long")), 16, "0"), 17 - 2 * size, 2 * size))


def crc_chain(*values: Column) -> Column:
    """crc32 over 32-bit numbers in order; null counts as 0."""
    return F.crc32(F.concat(*(big_endian(F.coalesce(v, F.lit(0))) for v in values)))


def forward_crc(data: Column) -> Column:
    """crc32 with its bits unreflected, from 0, as in Ogg pages."""
    at = lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("long")
    bit = lambda c, _: F.when(c >= 2147483648, ((c - 2147483648) * 2).bitwiseXOR(F.lit(0x04C11DB7))).otherwise(c * 2)
    eight = F.sequence(F.lit(1), F.lit(8))
    places = F.when(F.octet_length(data) > 0, F.sequence(F.lit(1), F.octet_length(data))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.lit(0).cast("long"), lambda c, i: F.aggregate(eight, c.bitwiseXOR(at(i) * 16777216), bit))


def swap16(v: Column) -> Column:
    return F.shiftleft(v.bitwiseAND(255), 8) + F.shiftright(v, 8).bitwiseAND(255)


def swapped_half(v: Column) -> Column:
    """A byte-swapped 16-bit float; exponent 0 counts as 2^-15, and the highest one is a number like the others."""
    w = swap16(v)
    sign, power, part = F.shiftright(w, 15).bitwiseAND(1), F.shiftright(w, 10).bitwiseAND(31), w.bitwiseAND(1023) / 1024
    return F.when(sign == 1, -1.0).otherwise(1.0) * F.when(power == 0, part * 2.0**-15).otherwise((1 + part) * F.pow(F.lit(2.0), power - 15))


def parse_int(s: Column) -> Column:
    """Decimal, 0x, 0o or 0b text as a long, with a sign or none; else null."""
    t = F.lower(F.trim(s))
    sign = F.when(t.startswith("-"), -1).otherwise(1)
    body = F.regexp_replace(t, "^[+-]", "")
    of = lambda base, digits: F.when(body.rlike(f"^0[{'xob'[[16, 8, 2].index(base)]}]{digits}+$"), F.conv(F.substring(body, 3, 64), base, 10).cast("long"))
    return sign * F.coalesce(of(16, "[0-9a-f]"), of(8, "[0-7]"), of(2, "[01]"), F.when(body.rlike("^([1-9][0-9]*|0+)$"), body.try_cast("long")))


def xtea(data: bytes, key: bytes) -> bytes:
    """Blocks of eight bytes deciphered by 32 rounds of XTEA under a key of 16 bytes; bytes after the last block stay."""
    whole = len(data) // 8 * 8
    v, ks = np.frombuffer(data[:whole], ">u4").astype(np.uint32).reshape(-1, 2), [int(x) for x in np.frombuffer(key, ">u4")]
    a, b, total = v[:, 0].copy(), v[:, 1].copy(), (0x9E3779B9 * 32) & 0xFFFFFFFF
    for _ in range(32):
        b -= (((a << np.uint32(4)) ^ (a >> np.uint32(5))) + a) ^ np.uint32((total + ks[(total >> 11) & 3]) & 0xFFFFFFFF)
        total = (total - 0x9E3779B9) & 0xFFFFFFFF
        a -= (((b << np.uint32(4)) ^ (b >> np.uint32(5))) + b) ^ np.uint32((total + ks[total & 3]) & 0xFFFFFFFF)
    return np.stack([a, b], 1).astype(">u4").tobytes() + data[whole:]


@F.pandas_udf(BinaryType())
def xtea_decrypt(data: pd.Series, key: pd.Series) -> pd.Series:
    """xtea of each row; null where either is."""
    return pd.Series([None if d is None or k is None else xtea(d, k) for d, k in zip(data, key, strict=True)], dtype=object)
