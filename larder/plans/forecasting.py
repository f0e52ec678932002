"""Weekly forecasting: cleaning, features, projections, holidays, metrics.

Series have one row per (company, week), so windows per company are as long as
the calendar.  Customer-level rows are aggregated to that grain first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import default_cutoff, has_week_53, iso_week_start, iso_year
from larder.operators.aggregates import binned, normalise_to, share_of_total
from larder.operators.windows import lags, moving_avg, rolling_ratio, seasonality


def _with_year_week(df: DataFrame, monday: str) -> DataFrame:
    return df.withColumns({"year": iso_year(monday).cast("int"), "week": F.weekofyear(monday)})


def clean_estimations(df: DataFrame, cutoff_weekday: int, min_weeks: int) -> DataFrame:
    """Estimates per (company, year, week, estimation date) with the days left to the cutoff.

    ``df``: company, product, year, week, estimated_at, id, quantity.  The first estimate of a product and day counts;
    products are summed; week 53 of years without one is dropped; a day that covers fewer than ``min_weeks`` weeks is
    extended with its last value.
    """
    key = ["company", "year", "week", "estimation_date"]
    first = F.min(F.struct("estimated_at", "id", "quantity"))["quantity"].alias("quantity")
    daily = df.withColumn("estimation_date", F.to_date("estimated_at")).groupBy(*key, "product").agg(first)
    daily = daily.groupBy(*key).agg(F.sum("quantity").alias("quantity"))
    daily = daily.where((F.col("week") != 53) | has_week_53("year"))
    monday = iso_week_start("year", "week")
    tail = daily.groupBy("company", "estimation_date").agg(
        F.countDistinct("year", "week").alias("n"),
        F.max(F.struct(monday.alias("monday"), "quantity")).alias("last"),
    )
    more = tail.where(F.col("n") < min_weeks).select(
        "company",
        "estimation_date",
        "last.quantity",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), (F.lit(min_weeks) - F.col("n")).cast("int")),
                lambda i: F.date_add("last.monday", i * 7),
            )
        ).alias("monday"),
    )
    out = daily.unionByName(_with_year_week(more, "monday").drop("monday"))
    cutoff = default_cutoff("year", "week", cutoff_weekday)
    return out.withColumn("days_to_cutoff", F.datediff(cutoff, "estimation_date"))


def forecast_features(
    weekly: DataFrame, estimations: DataFrame, retention: DataFrame, holidays: DataFrame, target: str = "orders"
) -> DataFrame:
    """Feature set per company, week and estimation date: lags, moving averages, seasonality, retention projection,
    holiday flags.  ``retention``: days_to_cutoff, rate.  ``holidays``: year, week and flags."""
    part, order = ["company"], ["year", "week"]
    f = lags(weekly, part, order, target, [12, 52])
    f = moving_avg(f, part, order, target, [12])
    f = seasonality(f, part, order, "week", target)
    e = estimations.join(retention, "days_to_cutoff", "left").withColumn(
        "projected", F.col("quantity") * F.col("rate")
    )
    return f.join(e, ["company", "year", "week"]).join(holidays, ["year", "week"], "left")


def training_features(
    weekly: DataFrame, estimations: DataFrame, holidays: DataFrame, targets: Sequence[str], total: str, partial: str
) -> DataFrame:
    """Feature rows of past weeks per estimation date, for models that learn several targets.

    ``weekly``: company, year, week, targets.  ``estimations``: company, year, week, estimation_date, days_to_cutoff and
    two estimates.  ``holidays``: year, week and flags, 0 for weeks it does not list.  Weeks keep their estimates from
    before the cutoff (``days_to_cutoff`` of 0 and more); weeks without any give no rows.  The rate of a target is its
    median ratio to an estimate by company and days to the cutoff, an estimate of 0 counting as ratio 0; the rates of the
    ``partial`` estimate come from rows without a NULL, and rows whose days have no such rate go.  The first target has
    lags, moving averages and the seasonality of its week.
    """
    part, order, week = ["company"], ["year", "week"], ["company", "year", "week"]
    known = weekly.select(*week, *targets).join(
        estimations.select(*week, "estimation_date", "days_to_cutoff", total, partial), week, "left"
    ).where("days_to_cutoff >= 0")
    # A group holds a row per past week, so its ratios are as many as the calendar has weeks.
    by = ["company", "days_to_cutoff"]
    rate = lambda target, estimate, where: F.median(
        F.when(where, F.when(F.col(estimate) > 0, F.col(target) / F.col(estimate)).otherwise(0.0))
    ).alias(f"{target}_rate_{estimate}")
    whole = F.lit(True)
    for c in [*targets, total, partial]:
        whole = whole & F.col(c).isNotNull()
    rates = known.groupBy(*by).agg(
        *[rate(x, total, F.col(x).isNotNull()) for x in targets],
        *[rate(x, partial, whole) for x in targets],
        F.bool_or(whole).alias("__whole"),
    )
    rows = known.join(rates.where("__whole").drop("__whole"), by)
    projected = {f"{x}_projected_{e}": F.col(f"{x}_rate_{e}") * F.col(e) for x in targets for e in (total, partial)}
    f = lags(weekly.select(*week, targets[0]), part, order, targets[0], [12, 52])
    f = moving_avg(f, part, order, targets[0], [12])
    f = seasonality(f, part, order, "week", targets[0]).drop(targets[0])
    flags = [c for c in holidays.columns if c not in order]
    out = rows.withColumns(projected).join(f, week).join(holidays, order, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in flags})


def _same_week(hist: DataFrame, weeks: DataFrame, target: str, years: int) -> DataFrame:
    """Past value of the same week; gaps take the neighbours before, then after."""
    past = hist.select("company", (F.col("year") + years).alias("year"), "week", F.col(target).alias("__p"))
    w = Window.partitionBy("company").orderBy("year", "week")
    j = weeks.join(past, ["company", "year", "week"], "left")
    back = F.last("__p", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("__p", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return j.withColumn("past", F.coalesce(back, ahead)).drop("__p")


def baseline_projection(past: DataFrame, future: DataFrame, target: str, years: int = 1, rolling: int = 4) -> DataFrame:
    """Naive projections per future week: last value scaled, or shifted, by last year's development, and last year's
    value times the median ratio of the newest weeks."""
    by_time = F.struct("year", "week")
    last = past.groupBy("company").agg(F.max_by(target, by_time).alias("now"))
    base = past.where("week <> 53").groupBy("company").agg(F.max(by_time).alias("t")).select("company", "t.*")
    base = _same_week(past, base, target, years).select("company", F.col("past").alias("past_now"))
    w = Window.partitionBy("company").orderBy(F.desc("year"), F.desc("week"))
    recent = past.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= rolling).drop("__rn")
    ratio = _same_week(past, recent, target, years).groupBy("company").agg(
        F.median(F.col(target) / F.col("past")).alias("ratio")
    )
    f = _same_week(past, future, target, years)
    f = f.join(last, "company").join(base, "company").join(ratio, "company")
    return f.select(
        "company",
        "year",
        "week",
        (F.col("now") * F.col("past") / F.col("past_now")).alias("week_ratio"),
        (F.col("now") + F.col("past") - F.col("past_now")).alias("week_diff"),
        (F.col("past") * F.col("ratio")).alias("rolling_ratio"),
    )


def blend(df: DataFrame, total: str, part: str, share: str) -> DataFrame:
    """Part predicted directly and as share of the total, their mean, all rounded."""
    calc = F.round(F.col(total) * F.col(share))
    return df.withColumns(
        {
            f"{part}_calc": calc,
            f"{part}_avg": F.round((calc + F.col(part)) / 2),
            part: F.round(part),
            total: F.round(total),
        }
    )


def project_growth(known: DataFrame, future: DataFrame, target: str, mapped: str, quiet: Column, regress_on: int = 20) -> DataFrame:
    """Growth rates of the newest known weeks carried to the future weeks, and the orders they give.

    ``quiet`` marks weeks without holidays; other weeks count as zero in the rolling ratios.
    """
    part, order = ["company"], ["year", "week"]
    k = known.withColumn("growth", F.try_divide(F.col(target), F.col(mapped)))
    for n in (4, 12):
        k = rolling_ratio(k, part, order, target, mapped, n, quiet, f"growth_{n}")
    by_time = F.struct(*order)
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), by_time)).alias(c)
    last = k.groupBy("company").agg(*[newest(c) for c in ("growth", "growth_4", "growth_12")])
    back = Window.partitionBy("company").orderBy(F.desc("year"), F.desc("week"))
    tail = k.withColumn("__rn", F.row_number().over(back)).where(F.col("__rn") <= regress_on)
    n = F.count("*").over(Window.partitionBy("company"))
    tail = tail.withColumn("x", (n - F.col("__rn")).cast("double"))
    line = tail.groupBy("company").agg(
        F.regr_slope("growth", "x").alias("slope"),
        F.regr_intercept("growth", "x").alias("intercept"),
        F.count("*").alias("n"),
    )
    ahead = Window.partitionBy("company").orderBy(*order)
    f = future.withColumn("__i", F.row_number().over(ahead) - 1).join(last, "company").join(line, "company")
    f = f.withColumn("growth_linear", F.col("intercept") + F.col("slope") * (F.col("n") + F.col("__i")))
    rates = ("growth", "growth_4", "growth_12", "growth_linear")
    return f.select(
        "company", *order, mapped, *rates, *[(F.col(r) * F.col(mapped)).alias(f"orders_by_{r}") for r in rates]
    )


def estimate_pivot(estimations: DataFrame, actual: DataFrame, by: str = "company") -> DataFrame:
    """Estimates per days-to-cutoff (rows) and series (columns, as found); day 0 shows the actual orders."""
    e = estimations.join(actual, [by, "year", "week"], "left")
    value = F.when(F.col("days_to_cutoff") == 0, F.coalesce("orders", "quantity")).otherwise(F.col("quantity"))
    return e.groupBy("year", "week", "days_to_cutoff").pivot(by).agg(F.max(value))


def estimate_deltas(estimations: DataFrame) -> DataFrame:
    """Change of each estimate from the next earlier estimation day, labelled ``from-to`` in days to cutoff.

    Estimation days are a few dozen per week, so the windows are short.
    """
    days = estimations.select("days_to_cutoff").distinct()
    w = Window.partitionBy(F.lit(1)).orderBy("days_to_cutoff")
    steps = days.withColumn("days_from", F.lead("days_to_cutoff").over(w)).where("days_from is not null")
    prev = estimations.select(
        "company", "year", "week", F.col("days_to_cutoff").alias("days_from"), F.col("quantity").alias("quantity_from")
    )
    j = estimations.join(steps, "days_to_cutoff").join(prev, ["company", "year", "week", "days_from"])
    return j.select(
        "company",
        "year",
        "week",
        F.concat_ws("-", "days_from", "days_to_cutoff").alias("step"),
        (F.col("quantity") - F.col("quantity_from")).alias("diff"),
    )


def holiday_days(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Holiday features of every date.  ``days``: day.  ``holidays``: day, holiday.

    Distances run to strictly later and earlier holidays and fall back to the ends of the calendar.
    """
    j = days.join(holidays.groupBy("day").agg(F.min("holiday").alias("holiday")), "day", "left")
    w = Window.partitionBy(F.lit(1)).orderBy("day")  # A calendar: a few thousand dates.
    mark = F.when(F.col("holiday").isNotNull(), F.col("day"))
    later = F.first(mark, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    earlier = F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    work = lambda n: F.lag(F.col("holiday").isNotNull() & (F.weekday("day") < 5), n).over(w)
    dow, on = F.weekday("day"), F.col("holiday").isNotNull()
    beside = F.coalesce(work(1), F.lit(False)) | F.coalesce(work(-1), F.lit(False))
    return j.withColumns(
        {
            "days_until_next_holiday": F.datediff(F.coalesce(later, F.max("day").over(whole)), "day"),
            "days_since_last_holiday": F.datediff("day", F.coalesce(earlier, F.min("day").over(whole))),
            "is_squeeze_day": dow.isin(0, 4) & ~on & beside,
            "is_long_weekend": dow.isin(0, 4) & on,
            "is_holiday_on_monday": (dow == 0) & on,
            "is_holiday_on_thursday": (dow == 3) & on,
            "is_holiday_on_saturday": (dow == 5) & on,
            "is_holiday_on_sunday": (dow == 6) & on,
        }
    )


def holiday_weeks(daily: DataFrame, names: Sequence[str], easter: str, exempt: Sequence[str], around: int = 2) -> DataFrame:
    """Weekly roll-up of :func:`holiday_days`: counts, flags, one column per holiday, distance from Easter.

    A holiday on a weekend does not count as an effective one, unless the week has a long weekend or an ``exempt`` holiday.
    """
    d = daily.withColumns({"year": iso_year("day").cast("int"), "week": F.weekofyear("day")})
    flag = lambda c: F.max(F.col(c).cast("int"))
    w = d.groupBy("year", "week").agg(
        F.count("holiday").alias("n_holidays"),
        flag("is_long_weekend").alias("has_long_weekend"),
        flag("is_squeeze_day").alias("has_squeeze_day"),
        flag("is_holiday_on_saturday").alias("has_holiday_on_saturday"),
        flag("is_holiday_on_sunday").alias("has_holiday_on_sunday"),
        *[F.max(F.coalesce((F.col("holiday") == h).cast("int"), F.lit(0))).alias(h) for h in names],
        F.array_join(F.array_sort(F.collect_set("holiday")), ",").alias("holiday_list"),
    )
    plain = F.col("has_long_weekend") == 0
    for h in exempt:
        plain = plain & (F.col(h) == 0)
    lost = sum(F.when(plain, F.col(c)).otherwise(0) for c in ("has_holiday_on_saturday", "has_holiday_on_sunday"))
    easters = w.where(F.col(easter) == 1).groupBy("year").agg(F.min("week").alias("__e"))
    w = w.withColumn("n_holidays_effective", F.col("n_holidays") - lost).join(easters, "year", "left")
    since = F.col("week") - F.col("__e")
    return w.withColumns(
        {"weeks_since_easter": since, "is_around_easter": F.coalesce(F.abs(since) <= around, F.lit(False))}
    ).drop("__e")


def forecast_metrics(df: DataFrame, keys: Sequence[str], pred: str, actual: str) -> DataFrame:
    """Mean error, MAE and MAPE (in percent, zero actuals left out) per group."""
    err = F.col(pred) - F.col(actual)
    return df.groupBy(*keys).agg(
        F.avg(err).alias("mean_error"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(F.try_divide(err, F.col(actual)))) * 100).alias("mape"),
        F.count("*").alias("n"),
    )


def binned_forecast_metrics(df: DataFrame, pred: str, actual: str, edges: Sequence[float]) -> DataFrame:
    """The same metrics by size of the actual value."""
    return forecast_metrics(df.withColumn("bin", binned(F.col(actual), edges)).where("bin is not null"), ["bin"], pred, actual)


def share_targets(quantities: DataFrame, period: Sequence[str], value: str) -> DataFrame:
    """Share of each variation in its period and the log of the share, the training target."""
    s = share_of_total(quantities, period, value, "share")
    return s.withColumn("log_share", F.when(F.col("share") > 0, F.log("share")))


def share_forecast(predicted: DataFrame, totals: DataFrame, period: Sequence[str]) -> DataFrame:
    """Predicted log shares back to shares that sum to 1 per period, times the period's total."""
    p = predicted.withColumn("share", F.exp("predicted_log"))
    p = normalise_to(p, period, "share", F.lit(1.0))
    return p.join(totals, list(period)).withColumn("quantity", F.col("share") * F.col("total"))


def publish_forecast(
    model: DataFrame, external: DataFrame, keys: Sequence[str], value: str, splits: Mapping[str, Column], run: Column
) -> tuple[DataFrame, DataFrame]:
    """(forecast rows, run metadata): external values overwrite the model's, each row split into named parts."""
    e = external.select(*keys, F.col(value).alias("__external"))
    j = model.join(e, list(keys), "left").withColumn("is_external", F.col("__external").isNotNull())
    j = j.withColumn(value, F.coalesce("__external", value)).withColumn("run_id", run)
    parts = F.array(*[F.struct(F.lit(n).alias("variation"), F.round(F.col(value) * s).alias("v")) for n, s in splits.items()])
    rows = j.select("run_id", *keys, "is_external", F.explode(parts).alias("p"))
    rows = rows.select("run_id", *keys, "is_external", "p.variation", F.col("p.v").alias(value))
    meta = j.groupBy("run_id", keys[0]).agg(
        F.count("*").alias("horizon"), F.sum(F.col("is_external").cast("int")).alias("n_external")
    )
    return rows, meta
