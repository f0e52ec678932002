"""A/B test statistics from group moments and ranks."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from larder.operators.aggregates import summary
from larder.operators.chunked import running


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    # Modified Lentz evaluation of 1 / (1 + d1 / (1 + d2 / (1 + ...))).
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 300):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for num in (even, odd):
            d = 1 / ((1 + num * d) or tiny)
            c = (1 + num / c) or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * value


def _upper_t(t: float, df: float) -> float:
    """P(T > t) for Student's t."""
    tail = 0.5 * _incomplete_beta(df / 2, 0.5, df / (df + t * t))
    return tail if t >= 0 else 1 - tail


@F.pandas_udf(DoubleType())
def upper_t(t: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of Student's t; applied to the one row of a test result."""
    return pd.Series([None if pd.isna(a) or pd.isna(b) else _upper_t(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def upper_normal(z: pd.Series) -> pd.Series:
    """Upper tail of the standard normal distribution."""
    return pd.Series([None if pd.isna(a) else 0.5 * math.erfc(a / math.sqrt(2)) for a in z], dtype="float64")


def group_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    return summary(df, [group], value)


def ab_test(df: DataFrame, is_test: Column, value: str, alternative: str = "two-sided", ratio_limit: float = 4.0) -> DataFrame:
    """t-test of test against control: pooled variance if the variance ratio is below the limit, else Welch.

    One partial aggregate over the rows; everything after it is arithmetic on one row.
    """
    rows = df.where(F.col(value).isNotNull())
    on = lambda agg, cond: agg(F.when(cond, F.col(value)))
    m = rows.agg(
        *[
            e.alias(n)
            for name, cond in (("t", is_test), ("c", ~is_test))
            for n, e in (
                (f"n_{name}", on(F.count, cond)),
                (f"mean_{name}", on(F.avg, cond)),
                (f"var_{name}", on(F.var_samp, cond)),
                (f"pop_{name}", on(F.var_pop, cond)),
            )
        ]
    )
    c = F.col
    pooled = ((c("n_t") - 1) * c("var_t") + (c("n_c") - 1) * c("var_c")) / (c("n_t") + c("n_c") - 2)
    ratio = F.greatest(F.try_divide(c("pop_t"), c("pop_c")), F.try_divide(c("pop_c"), c("pop_t")))
    a, b = c("var_t") / c("n_t"), c("var_c") / c("n_c")
    m = m.withColumns({"diff": c("mean_t") - c("mean_c"), "equal_var": ratio < ratio_limit, "pooled": pooled})
    se = F.when(c("equal_var"), F.sqrt(c("pooled") * (1 / c("n_t") + 1 / c("n_c")))).otherwise(F.sqrt(a + b))
    welch = F.pow(a + b, F.lit(2)) / (F.pow(a, F.lit(2)) / (c("n_t") - 1) + F.pow(b, F.lit(2)) / (c("n_c") - 1))
    m = m.withColumns(
        {
            "t_statistic": F.try_divide(c("diff"), se),
            "df": F.when(c("equal_var"), (c("n_t") + c("n_c") - 2).cast("double")).otherwise(welch),
            "cohen_d": F.try_divide(c("diff"), F.sqrt("pooled")),
        }
    )
    p = {
        "two-sided": 2 * upper_t(F.abs("t_statistic"), F.col("df")),
        "greater": upper_t(F.col("t_statistic"), F.col("df")),
        "less": upper_t(-F.col("t_statistic"), F.col("df")),
    }[alternative]
    size = F.abs("cohen_d")
    label = F.when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").otherwise("large")
    return m.select(
        "n_t", "n_c", "mean_t", "mean_c", "equal_var", "t_statistic", "df", p.alias("p_value"), "cohen_d", label.alias("effect_size")
    )


def mann_whitney(df: DataFrame, is_test: Column, value: str) -> DataFrame:
    """Mann-Whitney U of the test group with tie-corrected two-sided normal approximation.

    Equal values are counted first; ranks come from a running count over the distinct values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(
        F.count(F.when(is_test, 1)).alias("t"), F.count("*").alias("n")
    )
    ranked = running(counts, [], ["x"], {"upto": F.col("n")})
    rank = F.col("upto") - F.col("n") + (F.col("n") + 1) / 2
    s = ranked.agg(
        F.sum(F.col("t") * rank).alias("r"),
        F.sum("t").cast("double").alias("n1"),
        F.sum("n").cast("double").alias("n"),
        F.sum(F.pow("n", F.lit(3)) - F.col("n")).alias("ties"),
    )
    n1, n = F.col("n1"), F.col("n")
    n2 = n - n1
    u = F.col("r") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    s = s.select(u.alias("u_statistic"), F.try_divide(F.abs(u - n1 * n2 / 2) - 0.5, sd).alias("z"))
    return s.select("u_statistic", "z", F.least(F.lit(1.0), 2 * upper_normal("z")).alias("p_value"))
