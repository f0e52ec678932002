"""Unions, stitching, defaults and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def union_tenants(tenants: Mapping[str, DataFrame], out: str = "tenant") -> DataFrame:
    """Union of per-tenant sources with the tenant as a column."""
    return union_all(*[df.withColumn(out, F.lit(name)) for name, df in tenants.items()])


def stitch_history(source: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """History up to the source's first record of each key, then the source; the overlapping row is cut."""
    firsts = source.groupBy(F.col(key).alias("__k")).agg(F.min("valid_from").alias("__first"))
    old = history.join(firsts, history[key] == F.col("__k"), "left").where(
        F.col("__first").isNull() | (F.col("valid_from") < F.col("__first"))
    )
    cut = old.withColumn("valid_to", F.least("valid_to", "__first")).select(*history.columns)
    return cut.unionByName(source, allowMissingColumns=True)


def array_ops(a: Column, b: Column) -> dict[str, Column]:
    """Set operations of two lists."""
    return {
        "united": F.array_sort(F.array_union(a, b)),
        "common": F.array_sort(F.array_intersect(a, b)),
        "only_left": F.array_sort(F.array_except(a, b)),
        "overlap": F.arrays_overlap(a, b),
    }


def fill_from_defaults(df: DataFrame, defaults: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Missing values come from a defaults table of the same columns."""
    values = [c for c in df.columns if c not in keys]
    d = defaults.select(*keys, *[F.col(c).alias(f"__d_{c}") for c in values])
    return df.join(d, list(keys), "left").select(*keys, *[F.coalesce(c, f"__d_{c}").alias(c) for c in values])


def reconcile(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys on both sides with differing columns, and keys on one side only."""
    left = a.select(F.col(key), F.struct(*cols).alias("a"))
    right = b.select(F.col(key), F.struct(*cols).alias("b"))
    j = left.join(right, key, "full")
    differing = F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), c) for c in cols]))
    kind = F.when(F.col("a").isNull(), "missing in a").when(F.col("b").isNull(), "missing in b").otherwise("differs")
    return j.select(key, kind.alias("kind"), F.array_join(differing, ",").alias("columns")).where(
        (F.col("kind") != "differs") | (F.col("columns") != "")
    )
