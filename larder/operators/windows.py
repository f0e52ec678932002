"""Window operators.

Groups that may hold any number of rows (the events of a user) go through the
chunked functions.  Plain windows appear only over frames with one row per
period of a series, whose groups are as long as the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import year_week_diff
from larder.operators.chunked import fill_down, neighbour, row_numbers, running, with_totals


def rank_rows(df: DataFrame, part: Sequence[str], order: Sequence[str], out: str = "rn") -> DataFrame:
    """Position in the group."""
    return row_numbers(df, part, order, out)


def version_rank(df: DataFrame, part: Sequence[str], ts: str) -> DataFrame:
    """Dense rank of an instant in its group, counted up (``version``) and down (``version_desc``)."""
    points = row_numbers(df.select(*part, ts).distinct(), part, [ts], "version")
    ranks = with_totals(points, part, __n=F.count("*"))
    ranks = ranks.withColumn("version_desc", F.col("__n") - F.col("version") + 1).drop("__n")
    return df.join(ranks, [*part, ts])


def lag_cols(df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return neighbour(df, part, order, {f"previous_{c}": c for c in cols})


def lead_or(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, default: Column) -> DataFrame:
    """Next row's value, or a default on the last row."""
    out = neighbour(df, part, order, {f"next_{col}": col, "__has": F.lit(True)}, forward=True)
    return out.withColumn(
        f"next_{col}", F.when(F.col("__has").isNull(), default).otherwise(F.col(f"next_{col}"))
    ).drop("__has")


def ffill(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    return fill_down(df, part, order, {f"{col}_filled": F.col(col)})


def running_totals(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    return running(df, part, order, {"running_count": F.lit(1).cast("long"), "running_sum": F.col(col)})


def partition_totals(df: DataFrame, part: Sequence[str], **aggs: Column) -> DataFrame:
    return with_totals(df, part, **aggs)


def distinct_over(df: DataFrame, part: Sequence[str], col: str, mean: str) -> DataFrame:
    """Number of distinct values and the mean of another column, on every row of the group."""
    n = df.where(F.col(col).isNotNull()).groupBy(*part, col).agg(F.lit(1).alias("__one"))
    n = n.groupBy(*part).agg(F.count("*").alias("n_distinct"))
    return with_totals(df, part, mean=F.avg(mean)).join(n, list(part), "left").fillna(0, ["n_distinct"])


def qualify_first(df: DataFrame, part: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per group; the planner cuts each task's rows to one per group before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn("__rn", rn).where("__rn = 1").drop("__rn")


def moving_avg(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, sizes: Sequence[int]) -> DataFrame:
    """Mean of the previous N rows, without the current one; NULL until there are N."""
    w = Window.partitionBy(*part).orderBy(*order)
    out = {}
    for n in sizes:
        frame = w.rowsBetween(-n, -1)
        out[f"moving_avg_{n}"] = F.when(F.count(col).over(frame) == n, F.avg(col).over(frame))
    return df.withColumns(out)


def lags(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, sizes: Sequence[int]) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumns({f"{col}_lag_{n}": F.lag(col, n).over(w) for n in sizes})


def rolling_ratio(
    df: DataFrame, part: Sequence[str], order: Sequence[str], num: str, den: str, n: int, mask: Column, out: str
) -> DataFrame:
    """Ratio of rolling sums over N rows including the current one; masked-out rows count as zero."""
    frame = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(n - 1), 0)
    m = mask.cast("int")
    total = lambda c: F.when(F.count(F.col(c) * m).over(frame) == n, F.sum(F.col(c) * m).over(frame))
    return df.withColumn(out, F.try_divide(total(num), total(den)))


def label_ahead(df: DataFrame, key: Sequence[str], ts: str, col: str, n: int, out: str = "label") -> DataFrame:
    """Whether the value ``n`` rows ahead exceeds ``n``; near the end the nearer row, then not exceeding."""
    frame = Window.partitionBy(*key).orderBy(ts).rowsBetween(n - 1, n)
    return df.withColumn(out, F.when(F.last(col).over(frame) > n, "churned").otherwise("active"))


def ffill_weeks(df: DataFrame, part: Sequence[str], monday: str, cols: Sequence[str]) -> DataFrame:
    """Complete each series to one row per week, missing weeks taking the last known values."""
    span = df.groupBy(*part).agg(F.min(monday).alias("__lo"), F.max(monday).alias("__hi"))
    grid = span.select(*part, F.explode(F.sequence("__lo", "__hi", F.expr("interval 7 days"))).alias(monday))
    w = Window.partitionBy(*part).orderBy(monday).rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(df, [*part, monday], "left")
    return joined.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def seasonality(df: DataFrame, part: Sequence[str], order: Sequence[str], week: str, col: str) -> DataFrame:
    """Mean deviation from the 52-week moving average, per ISO week."""
    ma = moving_avg(df, part, order, col, [52])
    per_week = ma.groupBy(*part, week).agg(F.avg(F.col(col) - F.col("moving_avg_52")).alias("seasonality"))
    return ma.join(per_week, [*part, week])


def number_periods(df: DataFrame, part: Sequence[str], date: str, out: str = "seq") -> DataFrame:
    """Sequence number of each distinct period."""
    w = Window.partitionBy(*part).orderBy(date)
    return df.select(*part, date).distinct().withColumn(out, F.row_number().over(w))


def rank_by_score(df: DataFrame, part: Sequence[str], score: str, tie: str, out: str = "order_rank") -> DataFrame:
    """Rank by falling score, ties by falling-in order of ``tie``."""
    neg = df.withColumn("__neg", -F.col(score))
    return row_numbers(neg, part, ["__neg", tie], out).drop("__neg")


def weeks_since_last(df: DataFrame, item: Sequence[str], week: str) -> DataFrame:
    """Previous ``yyyyww`` in which an item appeared, and the weeks since."""
    w = Window.partitionBy(*item).orderBy(week)
    seen = df.select(*item, week).distinct().withColumn("last_week", F.lag(week).over(w))
    return seen.withColumn("weeks_since", year_week_diff(week, "last_week"))
