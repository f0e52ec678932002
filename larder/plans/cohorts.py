"""Cohort curves and order projections from customer starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import iso_year
from larder.operators.aggregates import share_of_total


def cohort_curve(starts: DataFrame, orders: DataFrame, weeks: int = 8) -> DataFrame:
    """Average orders per started customer for each week since the start, by start month.

    ``starts``: customer, company, segment, start (Monday).  ``orders``: customer, monday.
    """
    cohort = ["company", "segment", "year", "month"]
    s = starts.withColumns({"year": F.year("start"), "month": F.month("start")})
    size = s.groupBy(*cohort).agg(F.count_distinct("customer", "start").alias("n_started"))
    # Orders are counted per customer and week before they meet the starts.
    per_week = orders.groupBy("customer", "monday").agg(F.count("*").alias("n"))
    served = s.withColumn("cohort_week", F.explode(F.sequence(F.lit(1), F.lit(weeks)))).withColumn(
        "monday", F.expr("date_add(start, 7 * (cohort_week - 1))")
    )
    hits = served.join(per_week, ["customer", "monday"]).groupBy(*cohort, "cohort_week").agg(F.sum("n").alias("n_orders"))
    return hits.join(size, cohort).select(
        *cohort, "cohort_week", "n_orders", "n_started", (F.col("n_orders") / F.col("n_started")).alias("average_orders")
    )


def keep_latest_cohorts(curve: DataFrame, months: int, weeks: int = 8) -> DataFrame:
    """Curves of the newest start months that reach the last cohort week, per company and segment.

    A company has one row per month and cohort week, so the ranking window is short.
    """
    full = curve.where(F.col("cohort_week") == weeks).select("company", "segment", "year", "month").distinct()
    w = Window.partitionBy("company", "segment").orderBy(F.desc("year"), F.desc("month"))
    newest = full.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= months).drop("__rn")
    return curve.join(newest, ["company", "segment", "year", "month"], "left_semi")


def start_deliveries(marketing: DataFrame, delays: DataFrame, calendar: DataFrame) -> DataFrame:
    """Customers starting delivery per week from monthly sign-up plans.

    ``marketing``: company, source, segment, year, month, estimate.  ``delays``: company, source, weeks_til_start,
    split.  ``calendar``: year, month, monday; sign-ups spread evenly over the weeks of a month.
    """
    per_month = calendar.groupBy("year", "month").agg(
        F.collect_set("monday").alias("mondays"), F.count_distinct("monday").alias("n_weeks")
    )
    m = marketing.join(per_month, ["year", "month"]).withColumn("monday", F.explode("mondays"))
    m = m.join(delays, ["company", "source"])
    started = F.floor(F.round(F.col("split") * F.col("estimate") / F.col("n_weeks"), 9))
    m = m.withColumns({"start": F.expr("date_add(monday, 7 * weeks_til_start)"), "n": started})
    key = ["company", "source", "segment", "year", "month", "start"]
    return m.groupBy(*key).agg(F.sum("n").alias("n_started"))


def project_orders(starts: DataFrame, curve: DataFrame, effects: DataFrame) -> DataFrame:
    """Orders per delivery week: starts x cohort curve x source effect, shifted by the cohort week.

    The curve is joined on (company, segment, month): at most one row per cohort week and year kept.
    """
    c = curve.select("company", "segment", "month", "cohort_week", "average_orders")
    j = starts.join(effects, ["company", "source"]).join(c, ["company", "segment", "month"])
    n = F.floor(F.round(F.col("n_started") * F.col("average_orders") * F.col("effect"), 9))
    j = j.withColumns({"delivery": F.expr("date_add(start, 7 * (cohort_week - 1))"), "n": n})
    return j.groupBy("company", "segment", "source", "year", "month", "delivery").agg(F.sum("n").alias("n_orders"))


def extend_curve(curve: DataFrame, decay: DataFrame, until_week: int, weeks: int = 8) -> DataFrame:
    """Curve beyond its last week: the last value decaying by a weekly rate per company."""
    end = curve.where(F.col("cohort_week") == weeks).join(decay, "company").drop("cohort_week")
    more = end.withColumn("cohort_week", F.explode(F.sequence(F.lit(weeks + 1), F.lit(until_week))))
    value = F.col("average_orders") * F.pow("decay", F.col("cohort_week") - weeks)
    return more.select("company", "segment", "year", "month", "cohort_week", value.alias("average_orders"))


def compound_retention(
    established: DataFrame, retention: DataFrame, frequency: DataFrame, end: Column, weeks_compounded: int = 52
) -> DataFrame:
    """Orders of established customers per week until ``end``.

    ``established``: company, signup_year, segment, monday, n_customers.  ``retention``: company, signup_year,
    share_active (over ``weeks_compounded`` weeks).  ``frequency``: company, segment, orders_per_customer.
    """
    weekly = F.exp(F.log("share_active") / (weeks_compounded - 1))
    e = established.join(retention, ["company", "signup_year"]).withColumn("rate", weekly)
    e = e.withColumn("delivery", F.explode(F.sequence("monday", end, F.expr("interval 7 days"))))
    k = F.datediff("delivery", "monday") / 7
    e = e.withColumn("retained", F.round(F.col("n_customers") * F.pow("rate", k)))
    e = e.join(frequency, ["company", "segment"])
    orders = F.round(F.round(F.col("orders_per_customer") * F.col("retained"), 9))
    return e.withColumn("n", orders).groupBy("company", "delivery").agg(F.sum("n").cast("long").alias("n_orders"))


def budget_summary(
    parts: Sequence[DataFrame], forecast: DataFrame, merge_segments: dict[str, str], start: int, end: int
) -> DataFrame:
    """Orders per company, week and segment in the budget span, with the share of all segments and the forecast.

    ``parts``: company, segment, delivery, n_orders.  ``forecast``: company, year_week, forecast_orders.
    """
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    segment = F.col("segment")
    for old, new in merge_segments.items():
        segment = F.when(F.col("segment") == old, new).otherwise(segment)
    yw = (iso_year("delivery") * 100 + F.weekofyear("delivery")).cast("int")
    s = rows.withColumns({"segment": segment, "year_week": yw}).where(F.col("year_week").between(start, end))
    s = s.groupBy("company", "year_week", "segment").agg(F.sum("n_orders").alias("n_orders"))
    return share_of_total(s, ["company", "year_week"], "n_orders", "segment_share").join(
        forecast, ["company", "year_week"], "left"
    )
