"""Search in nested rows by path, with any-of semantics through arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StringType, StructType


def matches(schema: StructType, path: list[str], value) -> Column:
    """Whether any value at path equals value: text by case-insensitive containment, numbers and booleans by equality; a missing path, or another type, is no match."""
    field = next((f for f in schema.fields if f.name == path[0]), None) if path else None
    return F.lit(False) if field is None else F.coalesce(_any(F.col(f"`{path[0]}`"), field.dataType, path[1:], value), F.lit(False))


def _any(col: Column, kind: DataType, rest: list[str], value) -> Column:
    if isinstance(kind, ArrayType):
        return F.exists(col, lambda x: F.coalesce(_any(x, kind.elementType, rest, value), F.lit(False)))
    if rest:
        field = next((f for f in kind.fields if f.name == rest[0]), None) if isinstance(kind, StructType) else None
        return F.lit(False) if field is None else _any(col[rest[0]], field.dataType, rest[1:], value)
    if isinstance(value, bool):
        return col == value if isinstance(kind, BooleanType) else F.lit(False)
    if isinstance(value, (int, float)):
        return col == value if isinstance(kind, NumericType) else F.lit(False)
    return F.contains(F.lower(col), F.lit(str(value).lower())) if isinstance(kind, StringType) else F.lit(False)


def search(rows: DataFrame, filters: list[tuple[list[str], object]], limit: int | None = 500, order: str | None = None) -> DataFrame:
    """Rows that meet all filters; the first 500 of a report, by order if it is given."""
    out = rows
    for path, value in filters:
        out = out.where(matches(rows.schema, path, value))
    if order is not None:
        out = out.orderBy(order)
    return out if limit is None else out.limit(limit)


def path_types(schema: StructType, path: list[str]) -> list[str]:
    """What may follow a path, as name:kind (kind: string, number, boolean, object): fields of the structs there, through arrays."""
    kind: DataType = schema
    for step in path:
        while isinstance(kind, ArrayType):
            kind = kind.elementType
        if not isinstance(kind, StructType) or step not in kind.names:
            return []
        kind = kind[step].dataType
    while isinstance(kind, ArrayType):
        kind = kind.elementType

    def named(k: DataType) -> str:
        while isinstance(k, ArrayType):
            k = k.elementType
        return "string" if isinstance(k, StringType) else "number" if isinstance(k, NumericType) else "boolean" if isinstance(k, BooleanType) else "object"

    return [f"{f.name}:{named(f.dataType)}" for f in kind.fields] if isinstance(kind, StructType) else []
