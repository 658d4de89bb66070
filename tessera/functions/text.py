"""Text, hash and number functions as columns; all built from JVM functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_hash(s: Column) -> Column:
    """h = 31 h + code unit, as an unsigned 32-bit number."""
    return F.aggregate(F.transform(F.split(s, ""), lambda c: F.ascii(c).cast("long")), F.lit(0).cast("long"), lambda a, c: F.pmod(a * 31 + c, F.lit(4294967296)))


def legacy_name_hash(s: Column) -> Column:
    """h = 61 h + code unit - 32 over upper case, as an unsigned 32-bit number."""
    return F.aggregate(F.transform(F.split(F.upper(s), ""), lambda c: F.ascii(c).cast("long")), F.lit(0).cast("long"), lambda a, c: F.pmod(a * 61 + c - 32, F.lit(4294967296)))


def escape_html(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def low_name(s: Column) -> Column:
    """Lower case with space, hyphen and plus as _; any other character that is not of a word is an error."""
    t = F.lower(F.translate(s, " -+", "___"))
    return F.when(t.rlike(r"^\w*$"), t).otherwise(F.raise_error(F.concat(F.lit("not a name: "), s)))


def requirement_list(s: Column) -> Column:
    """A ;-list of digits with each part trimmed; empty stays empty and null null, another part is an error."""
    parts = F.transform(F.split(s, ";"), lambda p: F.trim(p))
    ok = F.forall(parts, lambda p: p.rlike("^[0-9]+$"))
    return F.when(s.isNull(), s).when(F.trim(s) == "", "").when(ok, F.array_join(parts, ";")).otherwise(F.raise_error(F.concat(F.lit("not a requirement list: "), s)))


def to_integer(s: Column) -> Column:
    """Text of a sheet cell as a long: yes, y, on and true 1, no, n, off and false 0, numbers rounded half away from zero; else null."""
    t = F.lower(F.trim(s))
    return F.when(t.isin("true", "yes", "y", "on"), 1).when(t.isin("false", "no", "n", "off"), 0).otherwise(F.round(t.try_cast("decimal(38,6)")).cast("long")).cast("long")


def int32(x: Column) -> Column:
    """A long wrapped to a signed 32-bit number."""
    return (F.pmod(x.cast("long") + 2147483648, F.lit(4294967296)) - 2147483648).cast("int")


def js_substring(s: Column, a: Column, b: Column) -> Column:
    """Characters between two places in either order, both clamped to the string."""
    n = F.length(s)
    a, b = F.greatest(F.lit(0), F.least(a, n)), F.greatest(F.lit(0), F.least(b, n))
    return F.substring(s, F.least(a, b) + 1, F.abs(a - b))


def index_of(s: Column, part: Column, start: Column) -> Column:
    """Place of part at or after start, from 0; -1 if it isn't there."""
    return F.call_function("locate", part, s, start + 1) - 1


def blob_bytes(s: Column) -> Column:
    """Bytes of a text blob: X'..' or \\x.. or bare hex, base64, else its UTF-8."""
    quoted, slashed = F.regexp_extract(s, r"^[xX]'([0-9A-Fa-f]*)'$", 1), F.regexp_extract(s, r"^\\x([0-9A-Fa-f]*)$", 1)
    hexed = s.rlike(r"^([0-9A-Fa-f]{2})+$")
    b64 = s.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$") & (F.length(s) > 0)
    return F.when(quoted != "", F.unhex(quoted)).when(slashed != "", F.unhex(slashed)).when(hexed, F.unhex(s)).when(b64, F.unbase64(s)).otherwise(F.encode(s, "UTF-8"))


def triplets(b: Column) -> Column:
    """(x, y, plane) of packed little-endian 32-bit numbers, none for null; another length is an error."""

    def i32(at: Column) -> Column:
        byte = lambda k: F.conv(F.substring(F.hex(b), (at + k) * 2 + 1, F.lit(2)), 16, 10).cast("long")
        return int32(byte(0) + byte(1) * 256 + byte(2) * 65536 + byte(3) * 16777216)

    n = F.octet_length(b)
    ok = F.when(n.isNull() | (n % 12 == 0), n).otherwise(F.raise_error(F.lit("path length is not a multiple of 12")).cast("int"))
    at = F.when(ok > 0, F.sequence(F.lit(0), ok - 12, F.lit(12))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i32(i).alias("x"), i32(i + 4).alias("y"), i32(i + 8).alias("plane")))


def map_area(s: Column) -> Column:
    """x, z, xs, zs of "x,z[,xs[,zs]]" with , . / : or ; between; sizes are 1 and xs by default; null fields if x or z isn't a number."""
    p = F.split(s, "[,./:;]")
    at = lambda k: F.trim(F.get(p, F.lit(k))).try_cast("int")
    ok = at(0).isNotNull() & at(1).isNotNull()
    xs = F.coalesce(at(2), F.lit(1))
    return F.struct(*(F.when(ok, v).alias(n) for n, v in (("x", at(0)), ("z", at(1)), ("xs", xs), ("zs", F.coalesce(at(3), xs)))))
