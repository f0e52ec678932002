"""Python where Spark has no expression: vectorised, per batch of rows, never per group."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def infer_over(
    df: DataFrame,
    keep: Sequence[str],
    features: str,
    predict: Callable[[np.ndarray], np.ndarray],
    out: str = "prediction",
) -> DataFrame:
    """Score an array column batch by batch with a function of a (rows x features) matrix."""
    schema = StructType([df.schema[c] for c in keep] + [StructField(out, DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.stack(b[features].to_numpy()).astype("float64")
                yield b[list(keep)].assign(**{out: predict(x)})

    return df.select(*keep, features).mapInPandas(run, schema)


def sorted_lists(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Values of a group in the order of a column; what a per-group Python function would build."""
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("__l"))
    return rows.select(*keys, F.transform("__l", lambda s: s[value]).alias(out))


def entropy(df: DataFrame, keys: Sequence[str], value: str, out: str = "entropy") -> DataFrame:
    """Shannon entropy (bits) of the values of a group, from value counts."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    n, s = F.sum("__n"), F.sum(F.col("__n") * F.log2("__n"))
    return counts.groupBy(*keys).agg((F.log2(n) - s / n).alias(out))


def aggregate_views(df: DataFrame, keys: Sequence[str], views: Mapping[str, Column]) -> DataFrame:
    """Declared aggregate expressions, evaluated together."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in views.items()])


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character of ``b``."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit) | (row - hit)
    return len(a) - (row & full).bit_count()


def _partial(a: str, b: str) -> float:
    """Best similarity (0..100) of the shorter text with any stretch of the longer one of at most its length."""
    short, long = sorted((a, b), key=len)
    m = len(short)
    if m == 0:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    stretches = {long[max(i, 0) : i + m] for i in range(1 - m, len(long))}
    return max(200.0 * _common(short, w) / (m + len(w)) for w in stretches)


@F.pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Best-stretch similarity of two short texts; meant for distinct tokens."""
    return pd.Series([None if x is None or y is None else _partial(x, y) for x, y in zip(a, b)], dtype="float64")
