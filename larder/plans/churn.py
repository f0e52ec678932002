"""Churn features and labels at snapshot dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import weeks_between
from larder.operators.windows import label_ahead


def order_features(orders: DataFrame, snapshot: Column) -> DataFrame:
    """Recency and frequency from (customer, delivery_date)."""
    return (
        orders.where(F.col("delivery_date") <= snapshot)
        .groupBy("customer")
        .agg(F.max("delivery_date").alias("last_delivery"), F.count("*").alias("n_orders"))
        .withColumn("weeks_since_last_delivery", weeks_between(snapshot, F.col("last_delivery")))
    )


def event_features(
    events: DataFrame, snapshot: Column, kinds: Mapping[str, Column], last_n: int = 4, average_n: int = 10
) -> DataFrame:
    """Counts per kind of event: all time, last n weeks, last week, weekly average; one pass over the events."""
    aggs = []
    for name, cond in kinds.items():
        since = lambda weeks: F.count(F.when(cond & (F.col("ts") > F.date_sub(snapshot, weeks * 7)), 1))
        aggs += [
            F.count(F.when(cond, 1)).alias(f"total_{name}"),
            since(last_n).alias(f"{name}_last_n_weeks"),
            since(1).alias(f"{name}_last_week"),
            (since(average_n) / average_n).alias(f"{name}_weekly_average"),
        ]
    return events.where(F.col("ts") <= snapshot).groupBy("customer").agg(*aggs)


def complaint_features(complaints: DataFrame, snapshot: Column, last_n: int = 4) -> DataFrame:
    """Number of complaints, recent ones, weeks since and category of the last."""
    seen = complaints.where(F.col("complained_on") <= snapshot)
    newest = F.max_by("category", F.struct("complained_on", "category"))
    return seen.groupBy("customer").agg(
        F.count("*").alias("n_complaints"),
        F.count(F.when(F.col("complained_on") > F.date_sub(snapshot, last_n * 7), 1)).alias("n_complaints_last_n"),
        weeks_between(snapshot, F.max("complained_on")).alias("weeks_since_complaint"),
        newest.alias("last_category"),
    )


def churn_features(
    customers: DataFrame, orders: DataFrame, events: DataFrame, complaints: DataFrame, snapshot: Column,
    kinds: Mapping[str, Column],
) -> DataFrame:
    """One row per customer that exists at the snapshot date; missing counts are 0."""
    alive = customers.where(F.col("started_on") <= snapshot).withColumn(
        "tenure_weeks", weeks_between(snapshot, F.col("started_on"))
    )
    e = event_features(events, snapshot, kinds)
    c = complaint_features(complaints, snapshot)
    counts = [x for x in e.columns if x != "customer"] + ["n_complaints", "n_complaints_last_n", "n_orders"]
    return (
        alive.join(order_features(orders, snapshot), "customer", "left")
        .join(e, "customer", "left")
        .join(c, "customer", "left")
        .fillna(0, counts)
    )


def label_and_split(
    snapshots: DataFrame, key: str, ts: str, weeks_since: str, ahead: int, first_week: int, holdout_weeks: int
) -> DataFrame:
    """Churn label and ``train``/``holdout`` by year-week, the newest weeks being held out."""
    labelled = label_ahead(snapshots, [key], ts, weeks_since, ahead)
    yw = (F.year(ts) * 100 + F.weekofyear(ts)).cast("int")
    rows = labelled.withColumn("year_week", yw).where(F.col("year_week") >= first_week)
    newest = rows.select("year_week").distinct().orderBy(F.desc("year_week")).limit(holdout_weeks)
    cut = newest.agg(F.min("year_week")).scalar()
    return rows.withColumn("part", F.when(F.col("year_week") >= cut, "holdout").otherwise("train"))
