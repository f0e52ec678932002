"""Aggregations.

Everything here is partially aggregated before its shuffle.  Group totals that
rows need are joined back from an aggregate instead of computed in a window
over the whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.chunked import exact_median, row_numbers, with_totals


def agg(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def count_distinct_if(df: DataFrame, keys: Sequence[str], col: str, buckets: Mapping[str, Column]) -> DataFrame:
    """Distinct values overall and per condition.

    One row per distinct (keys, value) with the conditions it met, then plain sums.
    """
    per_value = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(
        *[F.max(cond.cast("int")).alias(n) for n, cond in buckets.items()]
    )
    return per_value.groupBy(*keys).agg(
        F.count("*").alias("n_distinct"), *[F.sum(F.coalesce(n, F.lit(0))).alias(n) for n in buckets]
    )


def pivot_case(df: DataFrame, keys: Sequence[str], col: str, values: Mapping[str, object], measure: Column) -> DataFrame:
    """One summed column per value of a column."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(col) == v, measure).otherwise(0)).alias(n) for n, v in values.items()]
    )


def arg_extremes(df: DataFrame, keys: Sequence[str], value: Column, by: Column) -> DataFrame:
    """Value at the smallest and the largest ordering key; rows with a NULL ordering key do not count."""
    return df.groupBy(*keys).agg(F.min_by(value, by).alias("first_value"), F.max_by(value, by).alias("last_value"))


def any_value(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Some non-NULL value per group; the greatest one, so that reruns agree."""
    return df.groupBy(*keys).agg(F.max(col).alias(col))


def collect_sorted(df: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str = "items") -> DataFrame:
    """Rows of a group as one sorted array of structs.

    The array is the result itself: use it for keys whose rows belong in one value, such as the lines of a basket.
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(out))


def distinct_values(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Distinct non-NULL values per group, found before anything is collected."""
    return df.where(F.col(col).isNotNull()).select(*keys, col).distinct()


def set_size(df: DataFrame, keys: Sequence[str], col: str, out: str = "n_distinct") -> DataFrame:
    """Size of the set of values, counted without building the set."""
    return distinct_values(df, keys, col).groupBy(*keys).agg(F.count("*").alias(out))


def combination_id(df: DataFrame, keys: Sequence[str], col: str, sep: str = ",") -> DataFrame:
    """md5 over the sorted distinct values of a group."""
    sets = distinct_values(df, keys, col).groupBy(*keys).agg(F.array_sort(F.collect_list(col)).alias("members"))
    return sets.withColumn("combination_id", F.md5(F.array_join(F.col("members").cast("array<string>"), sep)))


def string_agg(df: DataFrame, keys: Sequence[str], col: str, sep: str = ", ", out: str = "joined") -> DataFrame:
    """Distinct values of a group as one sorted text."""
    return (
        distinct_values(df, keys, col)
        .groupBy(*keys)
        .agg(F.array_join(F.array_sort(F.collect_list(F.col(col).cast("string"))), sep).alias(out))
    )


def having_below_global_max(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Groups whose newest value is older than the newest of the table."""
    newest = df.agg(F.max(col)).scalar()
    return df.groupBy(*keys).agg(F.max(col).alias(col)).where(F.col(col) < newest)


def bool_any(df: DataFrame, keys: Sequence[str], cond: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.bool_or(cond).alias("has_any"), F.sum(cond.cast("int")).alias("n_true"))


def weighted_avg(value: Column, weight: Column) -> Column:
    """Weighted mean; NULL for a total weight of zero."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def whole_unit_total(quantity: Column, unit: Column) -> Column:
    """Cost of a quantity bought in whole units: the summed quantity rounded up, times the unit price."""
    return F.ceil(F.sum(quantity)).cast("double") * F.max(unit)


def pivot_attributes(df: DataFrame, keys: Sequence[str], attr: str, val: Column, values: Sequence | None = None) -> DataFrame:
    """Attribute rows to columns; the attributes come from the data, and one outside a stated list is an error."""
    if values is None:
        return df.groupBy(*keys).pivot(attr).agg(val)
    stated = F.col(attr).isNull() | F.col(attr).isin(*values)
    unknown = F.raise_error(F.concat(F.lit(f"{attr} is not among the stated columns: "), F.col(attr).cast("string")))
    checked = df.withColumn(attr, F.when(stated, F.col(attr)).otherwise(unknown.cast(df.schema[attr].dataType)))
    return checked.groupBy(*keys).pivot(attr, list(values)).agg(val)


def share_of_total(df: DataFrame, keys: Sequence[str], val: str, out: str = "share") -> DataFrame:
    t = with_totals(df, keys, __total=F.sum(val))
    return t.withColumn(out, F.try_divide(F.col(val), F.col("__total"))).drop("__total")


def normalise_to(df: DataFrame, keys: Sequence[str], col: str, target: Column) -> DataFrame:
    """Scale values so that each group sums to its target."""
    t = with_totals(df, keys, __total=F.sum(col))
    return t.withColumn(col, F.try_divide(F.col(col), F.col("__total")) * target).drop("__total")


def normalise_with_targets(
    df: DataFrame, keys: Sequence[str], part: str, col: str, targets: Mapping, on_top: bool = False
) -> DataFrame:
    """Some parts get fixed shares; the other parts share the rest (or 1, ``on_top``)."""
    fixed = F.col(part).isin(*targets)
    slot = df.withColumn("__slot", F.when(fixed, F.col(part).cast("string")).otherwise(""))
    rest = 1.0 if on_top else 1.0 - sum(targets.values())
    target = F.lit(rest)
    for p, share in targets.items():
        target = F.when(F.col(part) == p, F.lit(share)).otherwise(target)
    return normalise_to(slot, [*keys, "__slot"], col, target).drop("__slot")


def median_ratio(df: DataFrame, keys: Sequence[str], num: str, den: str, out: str = "rate") -> DataFrame:
    """Exact median of num/den per group; a denominator of zero counts as ratio 0."""
    r = df.withColumn("__r", F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(0.0))
    return exact_median(r, keys, "__r", out)


def median_ratio_grid(df: DataFrame, day: str, week: str, num: str, den: str, out: str = "rate") -> DataFrame:
    """Median ratio per (week, day) on the full grid of days; a gap takes the last known value before it.

    The grid holds weeks x days to cutoff, at most 53 x a few dozen rows, so one ordered window is enough.
    """
    rates = median_ratio(df, [day, week], num, den, out)
    span = rates.agg(F.sequence(F.min(day), F.max(day)).alias("days"))
    weeks = rates.select(week).distinct()
    grid = weeks.withColumn(day, F.explode(span.scalar()))
    w = Window.partitionBy(F.lit(1)).orderBy(week, day).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(rates, [day, week], "left").withColumn(out, F.last(out, ignorenulls=True).over(w))


def summary(df: DataFrame, group: Sequence[str], val: str) -> DataFrame:
    """Mean, median, standard deviation and count."""
    moments = df.groupBy(*group).agg(
        F.avg(val).alias("mean"), F.stddev_samp(val).alias("std"), F.count(val).alias("count")
    )
    return moments.join(exact_median(df, group, val), list(group), "left")


def threshold_metrics(df: DataFrame, keys: Sequence[str], col: str, cut: float) -> DataFrame:
    """Rows over a threshold: count, share in percent, any-flag."""
    over = F.col(col) > cut
    n = F.count(F.when(over, True))
    return df.groupBy(*keys).agg(
        F.count("*").alias("total"),
        n.alias("broken"),
        F.round(n / F.count("*") * 100, 2).alias("percentage"),
        F.bool_or(over).alias("any_broken"),
    )


def offenders(df: DataFrame, keys: Sequence[str], id_col: str, cond: Column) -> DataFrame:
    """Ids that break a rule, in long form: one row per (keys, id)."""
    return df.where(cond).select(*keys, id_col).distinct()


def repetition(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """How often values repeat in a group: count of the most frequent one, mean count over group size."""
    per_value = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("__n"))
    return per_value.groupBy(*keys).agg(
        F.max("__n").alias("max_repetition"), (F.avg("__n") / F.sum("__n")).alias("repeated_share")
    )


def mean_of_bool(cond: Column) -> Column:
    """Share of true; missing counts as false."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("double"))


def contains_any(cond: Column) -> Column:
    """1.0 if any row is true."""
    return F.max(F.coalesce(cond, F.lit(False)).cast("double"))


def basket_features(
    lines: DataFrame,
    basket: str,
    means: Mapping[str, Column],
    shares: Mapping[str, Column],
    at_least_one: Mapping[str, Column],
    repeated: Mapping[str, str],
) -> DataFrame:
    """Feature vector of a basket in one aggregate, plus one two-level aggregate per repetition feature."""
    out = lines.groupBy(basket).agg(
        *[F.avg(c).alias(n) for n, c in means.items()],
        *[mean_of_bool(c).alias(n) for n, c in shares.items()],
        *[contains_any(c).alias(n) for n, c in at_least_one.items()],
    )
    for name, col in repeated.items():
        rep = repetition(lines, [basket], col).select(basket, F.col("repeated_share").alias(name))
        out = out.join(rep, basket, "left")
    return out


def binned(col: Column, edges: Sequence[float]) -> Column:
    """Label of the right-closed bin ``(a, b]`` of a value; NULL outside all bins."""
    out = None
    for a, b in zip(edges, edges[1:]):
        cond, label = (col > a) & (col <= b), F.lit(f"({a:g}, {b:g}]")
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def binned_metrics(df: DataFrame, by: Column, edges: Sequence[float], val: str) -> DataFrame:
    return summary(df.withColumn("bin", binned(by, edges)).where("bin is not null"), ["bin"], val)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns of the newest row per key, as one partial aggregate without a sort."""
    newest = F.max(F.struct(*order, *cols)).alias("__m")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__m.{c}") for c in cols])


def nested_json(df: DataFrame, outer: Sequence[str], inner: Sequence[str], val: str, order: str) -> DataFrame:
    """Two-level roll-up to JSON: per outer key a list of inner groups with their ordered values."""
    one = df.groupBy(*outer, *inner).agg(F.array_sort(F.collect_list(F.struct(order, val))).alias("__l"))
    one = one.withColumn("values", F.transform("__l", lambda s: s[val]))
    return one.groupBy(*outer).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct(*inner, "values")))).alias("json")
    )


def allocate(df: DataFrame, parent: Sequence[str], amount: str, weight: Column, out: str = "allocated") -> DataFrame:
    """Spread a header amount over its lines by weight; equally if the weights sum to zero."""
    t = with_totals(df.withColumn("__w", weight), parent, __total=F.sum("__w"), __n=F.count("*"))
    share = F.when(F.col("__total") == 0, F.lit(1.0) / F.col("__n")).otherwise(F.col("__w") / F.col("__total"))
    return t.withColumn(out, F.col(amount) * share).drop("__w", "__total", "__n")


def minmax_rank(df: DataFrame, item: str, score: str) -> DataFrame:
    """Items ordered by their largest, then smallest score, then id, with their position over all items."""
    per_item = df.groupBy(item).agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"))
    order = ["max_score", "min_score", item]
    return row_numbers(per_item, [], order, "position")
