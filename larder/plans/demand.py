"""Demand for the coming weeks from subscriptions and customer deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVERY_WEEK, EVEN_WEEKS, ODD_WEEKS = 10, 20, 30


def delivering_baskets(baskets: DataFrame, weeks: DataFrame, schedule: DataFrame) -> DataFrame:
    """Baskets that deliver in a coming week.

    A basket delivers on its default weeks unless the schedule says no, and on other weeks if the schedule says yes.
    ``baskets``: customer, company, basket, delivery_type, slot, postal.  ``weeks``: company, monday (a few per company).
    ``schedule``: customer, monday, has_delivery, slot.
    """
    # The coming weeks of a company as one short array: a basket is joined once and expanded.
    ahead = weeks.groupBy("company").agg(F.array_sort(F.collect_set("monday")).alias("__weeks"))
    b = baskets.join(ahead, "company").withColumn("monday", F.explode("__weeks")).drop("__weeks")
    s = schedule.select("customer", "monday", "has_delivery", F.col("slot").alias("__slot"))
    j = b.join(s, ["customer", "monday"], "left")
    parity = F.when(F.weekofyear("monday") % 2 == 0, EVEN_WEEKS).otherwise(ODD_WEEKS)
    default = (F.col("delivery_type") == EVERY_WEEK) | (F.col("delivery_type") == parity)
    delivers = F.when(default, F.coalesce("has_delivery", F.lit(True))).otherwise(
        F.coalesce("has_delivery", F.lit(False)) & (F.col("delivery_type") != EVERY_WEEK)
    )
    return j.where(delivers).withColumn("slot", F.coalesce("__slot", "slot")).drop("__slot", "has_delivery")


def estimate_demand(
    baskets: DataFrame,
    weeks: DataFrame,
    schedule: DataFrame,
    deviations: DataFrame,
    deviation_items: DataFrame,
    defaults: DataFrame,
    blocked: DataFrame,
    blacklist: DataFrame,
) -> DataFrame:
    """Items expected per basket and coming week.

    ``deviations`` (basket, monday, deviation) replace the default items of their week by ``deviation_items``
    (deviation, item, quantity); ``defaults``: basket, item, quantity.  Baskets at ``blocked`` postal codes and in
    blacklisted slots (company, monday, slot, postal, fallback) without a fallback do not count.
    """
    cols = ("company", "customer", "basket", "monday", "item", "quantity", "origin")
    live = delivering_baskets(baskets, weeks, schedule)
    live = live.join(blocked.select("postal").distinct(), "postal", "left_anti")
    closed = blacklist.where("fallback is null").select("company", "monday", "slot", "postal").distinct()
    live = live.join(closed, ["company", "monday", "slot", "postal"], "left_anti")
    changed = live.join(deviations, ["basket", "monday"])
    by_deviation = changed.join(deviation_items, "deviation").withColumn("origin", F.lit("deviation"))
    plain = live.join(deviations.select("basket", "monday"), ["basket", "monday"], "left_anti")
    by_default = plain.join(defaults, "basket").withColumn("origin", F.lit("default"))
    return by_default.select(*cols).unionByName(by_deviation.select(*cols))
