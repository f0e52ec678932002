"""Vector expressions over ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    """The vector scaled to length one; a zero vector stays zero.

    The norm is bound once as a lambda variable: an expression inside ``transform`` would be evaluated per element.
    """
    scaled = F.transform(
        F.array(F.struct(a.alias("v"), norm(a).alias("n"))),
        lambda s: F.transform(s["v"], lambda x: F.when(s["n"] > 0, x.cast("double") / s["n"]).otherwise(F.lit(0.0))),
    )
    return scaled[0]


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def weighted_distance(x: Column, target: Column, weight: Column, scale: float = 10.0) -> Column:
    """``sum((scale * (x - target) * weight) ** 2)``, missing and NaN terms as 0."""
    diff = F.zip_with(x, target, lambda p, q: p - q)
    terms = F.zip_with(diff, weight, lambda d, w: F.nanvl(F.coalesce(F.lit(scale) * d * w, F.lit(0.0)), F.lit(0.0)))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t * t)


def mean_vectors(df: DataFrame, keys: list[str], vec: str, dims: int, out: str = "centroid") -> DataFrame:
    """Mean vector per group as ``dims`` plain averages: partially aggregated, no per-element explode."""
    means = df.groupBy(*keys).agg(*[F.avg(F.col(vec)[i].cast("double")).alias(f"__{i}") for i in range(dims)])
    return means.select(*keys, F.array(*[F.col(f"__{i}") for i in range(dims)]).alias(out))
