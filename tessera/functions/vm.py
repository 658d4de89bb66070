"""What the operations of a script machine compute, as columns: 32-bit and long arithmetic, comparisons, text, enums, parameters, table fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import index_of, int32, js_substring

COMPARE = {
    "eq": lambda a, b: a == b,
    "not": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "lteq": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "gteq": lambda a, b: a >= b,
}


def branch(how: str, a: Column, b: Column) -> Column:
    return COMPARE[how](a, b)


def add(a: Column, b: Column) -> Column:
    return int32(a.cast("long") + b)


def sub(a: Column, b: Column) -> Column:
    return int32(a.cast("long") - b)


def mul(a: Column, b: Column) -> Column:
    return int32(a.cast("long") * b)


def div(a: Column, b: Column) -> Column:
    """Towards zero; null for a divisor of 0."""
    q = F.floor(F.abs(a.cast("long")) / F.nullif(F.abs(b.cast("long")), F.lit(0)))
    return int32(F.when((a < 0) != (b < 0), -q).otherwise(q))


def bit_and(a: Column, b: Column) -> Column:
    return a.bitwiseAND(b)


def bit_or(a: Column, b: Column) -> Column:
    return a.bitwiseOR(b)


def least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def greatest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


# -- longs: exact beyond 64 bits ----------------------------------------------------------------------


def long_add(a: Column, b: Column) -> Column:
    return a.cast("decimal(37,0)") + b.cast("decimal(37,0)")


def long_sub(a: Column, b: Column) -> Column:
    return a.cast("decimal(37,0)") - b.cast("decimal(37,0)")


def int_to_long(a: Column) -> Column:
    return a.cast("long")


def long_to_text(a: Column) -> Column:
    return a.cast("string")


def long_unpack(a: Column) -> Column:
    """struct high, low: a 64-bit number as two of 32 bits with a sign."""
    return F.struct(F.shiftright(a, 32).cast("int").alias("high"), int32(a.bitwiseAND(4294967295)).alias("low"))


# -- text ---------------------------------------------------------------------------------------------


def length(s: Column) -> Column:
    """UTF-16 units: characters beyond the first plane count twice."""
    return F.length(s) + F.length(F.regexp_replace(s, r"[^\x{10000}-\x{10FFFF}]", ""))


def lower(s: Column) -> Column:
    return F.lower(s)


def join(*parts: Column) -> Column:
    return F.concat(*parts)


def compare(a: Column, b: Column) -> Column:
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def to_text(n: Column, radix: int = 10) -> Column:
    """A number in a base from 2 to 36, in lower case, with its sign."""
    digits = F.lower(F.conv(F.abs(n.cast("long")).cast("string"), 10, radix))
    return F.when(n < 0, F.concat(F.lit("-"), digits)).otherwise(digits)


substring, find = js_substring, index_of


# -- data ---------------------------------------------------------------------------------------------


def enum_value(enum: Column, key: Column, default: Column) -> Column:
    """The value of the first entry (key, value) of an enum that has the key."""
    first = F.get(F.filter(enum, lambda e: e["key"] == key), F.lit(0))
    return F.when(first.isNotNull(), first["value"]).otherwise(default)


def enum_count(enum: Column) -> Column:
    return F.coalesce(F.size(enum), F.lit(0))


def param(extra: Column, prop: Column, default: Column, known: Column, last: Column) -> Column:
    """A record's own value of a parameter (entries prop, value), else the parameter's default, else last; a parameter that isn't known is an error."""
    own = F.get(F.filter(extra, lambda e: e["prop"] == prop), F.lit(0))["value"]
    return F.when(known, F.coalesce(own, default, last)).otherwise(F.raise_error(F.concat(F.lit("unknown parameter "), prop.cast("string"))).cast("int"))


def field_address(v: Column) -> Column:
    """struct table, column, sub of a packed address of a table's field."""
    return F.struct(F.shiftright(v, 12).bitwiseAND(0xFFFF).alias("table"), F.shiftright(v, 4).bitwiseAND(0xFF).alias("column"), v.bitwiseAND(15).alias("sub"))


def field_values(columns: Column, sub: Column) -> Column:
    """Of a column's values the sub-th, counted from 1, as an array; all of them for 0."""
    return F.when(sub == 0, columns).otherwise(F.slice(columns, F.greatest(sub, F.lit(1)), 1))


def switch(value: Column, cases: Column, otherwise: Column) -> Column:
    """Where a switch (entries value, jump) goes on."""
    hit = F.get(F.filter(cases, lambda c: c["value"] == value), F.lit(0))
    return F.when(hit.isNotNull(), hit["jump"]).otherwise(otherwise)
