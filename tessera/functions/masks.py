"""Movement masks and coordinates as columns.

Bits: 0 left, 1 bottom, 2 right, 3 top, 4 topleft, 5 bottomleft, 6 bottomright, 7 topright; y grows upwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: (bit, name, dx, dy, bit of the opposite direction, bits that a diagonal needs on the same tile)
DIRECTIONS = (
    (0, "left", -1, 0, 2, 0),
    (1, "bottom", 0, -1, 3, 0),
    (2, "right", 1, 0, 0, 0),
    (3, "top", 0, 1, 1, 0),
    (4, "topleft", -1, 1, 6, 9),
    (5, "bottomleft", -1, -1, 7, 3),
    (6, "bottomright", 1, -1, 4, 6),
    (7, "topright", 1, 1, 5, 12),
)
ALIASES = {"up": "top", "down": "bottom"}


def directions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIRECTIONS, "bit int, name string, dx int, dy int, opposite int, needs int")


def has_bit(mask: Column, bit: int) -> Column:
    return mask.bitwiseAND(1 << bit) != 0


def decode(mask: Column) -> Column:
    """A struct of eight booleans."""
    return F.struct(*(has_bit(mask, b).alias(n) for b, n, *_ in DIRECTIONS))


def encode(flags: dict[str, Column]) -> Column:
    """The mask of boolean columns by direction; null counts as false."""
    out = F.lit(0)
    for b, n, *_ in DIRECTIONS:
        if n in flags:
            out = out + F.when(flags[n], 1 << b).otherwise(0)
    return out


def names(mask: Column) -> Column:
    """Direction names in the order of the bits."""
    return F.array_compact(F.array(*(F.when(has_bit(mask, b), n) for b, n, *_ in DIRECTIONS)))


def encode_names(list_: Column) -> Column:
    """The mask of an array of names: trimmed, any case, up and down known as top and bottom, blanks passed over; another name is an error."""
    known = {n: 1 << b for b, n, *_ in DIRECTIONS}
    known |= {a: known[n] for a, n in ALIASES.items()}
    table = F.create_map(*(F.lit(x) for kv in known.items() for x in kv))

    def bit(v: Column) -> Column:
        name = F.lower(F.trim(v))
        return F.when(name == "", 0).otherwise(F.coalesce(table[name], F.raise_error(F.concat(F.lit("unknown direction: "), name, F.lit("; known: " + ", ".join(sorted(known))))).cast("int")))

    return F.aggregate(list_, F.lit(0), lambda a, v: a.bitwiseOR(bit(v)))


def region_id(x: Column, y: Column) -> Column:
    return F.shiftleft(F.shiftright(x, 6), 8) + F.shiftright(y, 6)


def centre(low: Column, high: Column) -> Column:
    """Middle of two bounds in either order, cut towards zero."""
    total = low.cast("long") + high.cast("long")
    return F.when(total < 0, -F.floor(-total / 2)).otherwise(F.floor(total / 2)).cast("int")


def unpack_clue(v: Column) -> Column:
    """level, x, z of a packed coordinate."""
    return F.struct(F.shiftright(v, 28).bitwiseAND(3).alias("level"), F.shiftright(v, 14).bitwiseAND(16383).alias("x"), v.bitwiseAND(16383).alias("z"))


def base3(walk: list[Column], sight: list[Column]) -> Column:
    """Nine cells as base-3 digits: 0 free, 1 blocked, 2 blocked for sight too."""
    out = F.lit(0)
    for i, (w, s) in enumerate(zip(walk, sight, strict=True)):
        out = out + F.when(w, F.when(s, 2).otherwise(1)).otherwise(0) * 3**i
    return out
