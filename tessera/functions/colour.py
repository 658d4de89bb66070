"""Colours as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unpack_hsl(v: Column) -> Column:
    """h, s, l of a packed 16-bit colour: six, three and seven bits."""
    return F.struct(F.shiftright(v, 10).bitwiseAND(63).alias("h"), F.shiftright(v, 7).bitwiseAND(7).alias("s"), v.bitwiseAND(127).alias("l"))


def rgb_int(r: Column, g: Column, b: Column) -> Column:
    return F.shiftleft(r, 16) + F.shiftleft(g, 8) + b


def rgb_to_hsl(r: Column, g: Column, b: Column) -> Column:
    """h, s, l from 0 to 1 of channels from 0 to 1; grey has neither hue nor saturation."""
    hi, lo = F.greatest(r, g, b), F.least(r, g, b)
    light, span = (hi + lo) / 2, hi - lo
    hue = F.when(hi == r, (g - b) / span + F.when(g < b, 6.0).otherwise(0.0)).when(hi == g, (b - r) / span + 2).otherwise((r - g) / span + 4) / 6
    grey = span == 0
    return F.struct(F.when(grey, 0.0).otherwise(hue).alias("h"), F.when(grey, 0.0).otherwise(span / (1 - F.abs(2 * light - 1))).alias("s"), light.alias("l"))


def hsl_to_rgb(h: Column, s: Column, light: Column) -> Column:
    """r, g, b from 0 to 1."""
    reach = s * F.least(light, 1 - light)

    def channel(n: int) -> Column:
        k = F.pmod(h * 12 + n, F.lit(12.0))
        return light - reach * F.greatest(F.lit(-1.0), F.least(k - 3, 9 - k, F.lit(1.0)))

    return F.struct(channel(0).alias("r"), channel(8).alias("g"), channel(4).alias("b"))
