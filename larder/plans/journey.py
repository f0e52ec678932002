"""Customer journey: menu weeks, first orders, weekly segments, reactivations.

A frame with one row per (customer, week) is as long per customer as the
calendar, whatever the number of orders, so plain windows per customer are
bounded there.  Orders are aggregated to that grain before any window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import future, iso_year, monday_of
from larder.operators.calendars import financial_calendar
from larder.operators.chunked import sent_if_small
from larder.operators.projections import classify

# The order in which the segment rules are tested decides.
SEGMENTS = [
    "partial_signup",
    "pending_onboarding",
    "regret",
    "onboarding",
    "reactivated",
    "occasional",
    "regular",
    "frequent",
    "always_on",
    "churned",
]


def menu_weeks(orders: DataFrame) -> DataFrame:
    """Menu-week calendar per company from (company, monday, created_at) of orders.

    The cutoff is 23:59 of the day before the first order of the week was created.
    """
    weeks = orders.groupBy("company", "monday").agg(F.min(F.to_date("created_at")).alias("first_day"))
    w = Window.partitionBy("company").orderBy("monday")
    last = Window.partitionBy("company").orderBy(F.desc("monday"))
    day = F.date_sub("first_day", 1).cast("timestamp_ntz")
    following = F.date_add("monday", 7)
    return (
        weeks.select(
            "company",
            "monday",
            (iso_year("monday") * 100 + F.weekofyear("monday")).cast("int").alias("year_week"),
            (day + F.expr("interval '23:59' hour to minute")).alias("cutoff"),
        )
        .withColumn("seq", F.row_number().over(w))
        .withColumn("previous_cutoff", F.lag("cutoff").over(w))
        .withColumn("next_year_week", (iso_year(following) * 100 + F.weekofyear(following)).cast("int"))
        .withColumn("is_latest", F.coalesce(F.row_number().over(last) == 1, F.lit(False)) & F.col("company").isNotNull())
    )


def first_orders(orders: DataFrame, customer: str) -> DataFrame:
    """First menu week per customer, when it was ordered, and its financial periods."""
    firsts = orders.groupBy(customer).agg(
        F.min_by("created_at", F.struct("monday", "created_at")).alias("first_created_at"),
        F.min("monday").alias("first_monday"),
    )
    cal = financial_calendar(firsts.select(F.col("first_monday").alias("day")).distinct())
    cal = cal.select(
        F.col("day").alias("first_monday"), "financial_week", "financial_month", "financial_quarter", "financial_year"
    )
    return firsts.join(cal, "first_monday", "left")


def journey_weeks(customers: DataFrame, orders: DataFrame, weeks: DataFrame) -> DataFrame:
    """One row per customer and menu week from signup to deletion, with its segment.

    ``customers``: customer, company, signup_at, partial_signup_at, full_signup_at, deleted_at.
    ``orders``: customer, monday.  ``weeks``: company, monday, cutoff, previous_cutoff, seq.
    """
    spark = customers.sparkSession
    # The weeks in which a customer ordered, as a map: no longer than the calendar.
    per_week = orders.groupBy("customer", "monday").agg(F.count("*").alias("n"))
    per_week = per_week.groupBy("customer").agg(
        F.min("monday").alias("first_monday"), F.map_from_entries(F.collect_list(F.struct("monday", "n"))).alias("__orders")
    )
    weeks = sent_if_small(weeks.select("company", "seq", "monday", "cutoff", "previous_cutoff"), 100_000)
    calendar = weeks.groupBy("company").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "seq",
                    "monday",
                    F.coalesce("cutoff", F.col("monday").cast("timestamp_ntz")).alias("end"),
                    F.coalesce("previous_cutoff", F.date_sub("monday", 7).cast("timestamp_ntz")).alias("before"),
                )
            )
        ).alias("__weeks")
    )
    c = customers.join(per_week, "customer", "left").withColumn("signup_monday", monday_of("signup_at"))
    c = c.withColumn("__start", F.least("signup_monday", "first_monday")).where("__start is not null")
    # Customers are spread by their id, a few hundred bytes each, and their weeks are made where the windows run.  Another
    # number than the shuffle's keeps this step apart from the joins before, which may end in one partition.
    spread = 2 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A customer's place in the calendar is looked up once; the weeks follow from positions, not from comparing dates.
    c = c.repartition(spread, "customer").join(sent_if_small(calendar, 10_000), "company")
    place = F.size(F.filter("__weeks", lambda w: w["monday"] < F.col("__start"))) + 1
    full = F.col("full_signup_at")
    possible = F.filter("__weeks", lambda w: (w["end"] >= full) & (w["before"] < full))
    c = c.select(
        "customer",
        "company",
        "first_monday",
        "deleted_at",
        "signup_monday",
        monday_of("partial_signup_at").alias("partial_monday"),
        monday_of("full_signup_at").alias("full_monday"),
        "__orders",
        F.when(place <= F.size("__weeks"), F.sequence(place, F.size("__weeks"))).alias("__places"),
        F.explode_outer(F.transform(possible, lambda w: w["monday"])).alias("possible_monday"),
    )
    g = c.withColumn("seq", F.explode("__places")).drop("__places")
    g = g.join(weeks.select("company", "seq", "monday", "cutoff"), ["company", "seq"])
    g = g.where(F.col("cutoff") < F.coalesce("deleted_at", future()))
    g = g.withColumn("n_orders", F.coalesce(F.try_element_at("__orders", F.col("monday")), F.lit(0))).drop("__orders")
    by = Window.partitionBy("customer").orderBy("seq")
    # Weeks are consecutive in seq, so row frames are week frames.
    g = g.withColumns(
        {
            "n8": F.sum("n_orders").over(by.rowsBetween(-7, 0)),
            "n_before": F.coalesce(F.sum("n_orders").over(by.rowsBetween(-8, -1)), F.lit(0)),
        }
    )
    back = F.when((F.col("n_orders") > 0) & (F.col("n_before") == 0), F.col("monday"))
    g = g.withColumn("reactivated_monday", F.last(back, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    weeks_since = lambda d: (F.datediff("monday", d) / 7).cast("int")
    g = g.withColumns(
        {
            "since_possible": weeks_since("possible_monday"),
            "since_first": F.when(F.col("first_monday") <= F.col("monday"), weeks_since("first_monday")),
            "since_back": weeks_since("reactivated_monday"),
        }
    )
    return g.where(F.col("monday") >= F.col("signup_monday")).withColumn("segment", _segment())


def _segment() -> Column:
    c = F.col
    few = (c("n8") > 0) & (c("n8") < 4)
    rules = [
        (c("monday") >= c("partial_monday")) & (c("monday") < F.coalesce("full_monday", F.to_date(future()))),
        (F.coalesce("since_possible", F.lit(0)) < 3) & (c("monday") >= c("full_monday")) & c("since_first").isNull(),
        (c("since_possible") >= 3) & c("since_first").isNull(),
        (c("since_first") < 7) & few,
        (c("since_back") < 7) & few,
        few & (c("since_first") >= 7),
        (c("n8") >= 4) & (c("n8") < 6),
        (c("n8") >= 6) & (c("n8") < 8),
        c("n8") >= 7,
        (c("since_first") >= 7) & (c("n8") == 0),
    ]
    return classify(list(zip(rules, SEGMENTS)), "unknown")


def journey_segments(customers: DataFrame, orders: DataFrame, weeks: DataFrame) -> DataFrame:
    """Weekly segments merged to validity rows: from the week of a change to the next change or the deletion."""
    w = Window.partitionBy("customer").orderBy("monday")
    rows = journey_weeks(customers, orders, weeks)
    prev = F.lag("segment").over(w)
    changed = rows.withColumn("__prev", prev).where(F.col("__prev").isNull() | (F.col("segment") != F.col("__prev")))
    end = F.least(F.to_date(future()), F.to_date("deleted_at"))
    return changed.select(
        "customer",
        "segment",
        F.col("monday").alias("monday_from"),
        F.col("cutoff").alias("cutoff_from"),
        F.coalesce(F.lead("monday").over(w), end).alias("monday_to"),
    )


def reactivations(segments: DataFrame, discounts: DataFrame) -> DataFrame:
    """Reactivation cohorts: from one reactivation to the next, with the first discount of the starting week.

    ``discounts``: customer, monday, discount.
    """
    w = Window.partitionBy("customer").orderBy("monday_from")
    back = segments.where("segment = 'reactivated'").select(
        "customer",
        "monday_from",
        F.coalesce(F.lead("monday_from").over(w), F.to_date(future())).alias("monday_to"),
    )
    used = discounts.groupBy("customer", F.col("monday").alias("monday_from")).agg(F.min("discount").alias("discount"))
    return back.join(used, ["customer", "monday_from"], "left")
