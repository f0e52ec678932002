"""Array and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_nulls(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.isNotNull())


def has_intersection(a: Column, b: Column) -> Column:
    """Whether two lists share a value; NULL and empty lists share nothing."""
    return F.coalesce(F.arrays_overlap(drop_nulls(a), drop_nulls(b)), F.lit(False))


def max_repetition(arr: Column) -> Column:
    """How often the most frequent value of a list occurs."""
    return F.array_max(F.transform(F.array_distinct(arr), lambda v: F.size(F.filter(arr, lambda x: x.eqNullSafe(v)))))


def parse_json(col: Column, ddl: str) -> Column:
    """JSON text to a typed value; malformed text gives NULL fields."""
    return F.from_json(col, ddl)


def flatten_struct(col: str, fields: list[str], default) -> list[Column]:
    """Struct fields as columns, NULL replaced by a default."""
    return [F.coalesce(F.col(f"{col}.{f}"), F.lit(default)).alias(f) for f in fields]
