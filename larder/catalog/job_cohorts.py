"""Jobs: cohorts and budget projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.job_journey import MENU, menu_orders
from larder.catalog.registry import Tables, query
from larder.functions.dates import year_week
from larder.plans import cohorts as C


def starts(t: Tables):
    first = menu_orders(t).groupBy("customer", "company").agg(F.min("monday").alias("start"))
    return first.withColumn("segment", F.when(F.col("customer") % 4 == 0, "reactivated").otherwise("new"))


CURVE = f"""{MENU}, st AS (SELECT customer, company, min(monday) AS start, CASE WHEN customer % 4 = 0 THEN 'reactivated' ELSE 'new'
    END AS segment FROM menu GROUP BY customer, company),
sz AS (SELECT company, segment, year(start) AS year, month(start) AS month, count(*) AS n_started FROM st GROUP BY ALL),
ct AS (SELECT st.company, segment, year(start) AS year, month(start) AS month, (monday - start) // 7 + 1 AS cohort_week,
  count(*) AS n_orders FROM st JOIN menu USING (customer) WHERE (monday - start) // 7 < 8 GROUP BY ALL),
curve AS (SELECT company, segment, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, CAST(cohort_week AS INTEGER)
  AS cohort_week, n_orders, n_started, n_orders / n_started AS average_orders FROM ct JOIN sz USING (company, segment, year, month))"""


def curve(t: Tables):
    return C.cohort_curve(starts(t), menu_orders(t))


@query(
    "job_20",
    f"""WITH {CURVE} SELECT company, segment, year, month, cohort_week, n_orders, n_started, round(average_orders, 8)
    AS average_orders FROM curve""",
)
def job_20(t: Tables):
    return curve(t).withColumn("average_orders", F.round("average_orders", 8))


LATEST = f"""{CURVE}, fl AS (SELECT DISTINCT company, segment, year, month FROM curve WHERE cohort_week = 8
  QUALIFY dense_rank() OVER (PARTITION BY company, segment ORDER BY year DESC, month DESC) <= 3),
latest AS (SELECT curve.* FROM curve JOIN fl USING (company, segment, year, month))"""


@query(
    "job_20_latest",
    f"""WITH {LATEST} SELECT company, segment, year, month, cohort_week, round(average_orders, 8) AS average_orders FROM latest""",
)
def job_20_latest(t: Tables):
    c = C.keep_latest_cohorts(curve(t), 3)
    return c.select("company", "segment", "year", "month", "cohort_week", F.round("average_orders", 8).alias("average_orders"))


_STARTS = f"""{LATEST}, mk AS (SELECT c_nationkey AS company, c_mktsegment AS source, CASE WHEN c_custkey % 4 = 0 THEN 'reactivated'
    ELSE 'new' END AS segment, CAST(2001 AS INTEGER) AS year, CAST(1 + c_custkey % 12 AS INTEGER) AS month, count(*) * 40 AS estimate
  FROM customer GROUP BY ALL),
cal AS (SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, m AS monday FROM (SELECT DISTINCT
  CAST(range AS DATE) AS m FROM range(DATE '2001-01-01', DATE '2002-01-01', INTERVAL 7 DAY))),
nw AS (SELECT year, month, count(*) AS n FROM cal GROUP BY 1, 2),
dl AS (SELECT DISTINCT c_nationkey AS company, c_mktsegment AS source, w, s FROM customer, (VALUES (1, 0.75), (3, 0.25)) v(w, s)),
sd AS (SELECT company, source, segment, year, month, monday + 7 * w AS start, sum(floor(round(s * estimate / n, 9))) AS n_started
  FROM mk JOIN cal USING (year, month) JOIN nw USING (year, month) JOIN dl USING (company, source) GROUP BY ALL),
po AS (SELECT sd.company, sd.segment, source, sd.year, sd.month, start + 7 * (cohort_week - 1) AS delivery,
  CAST(sum(floor(round(sd.n_started * average_orders * CASE WHEN source = 'BUILDING' THEN 0.9 ELSE 1.1 END, 9))) AS BIGINT) AS n_orders
  FROM sd JOIN latest l ON l.company = sd.company AND l.segment = sd.segment AND l.month = sd.month GROUP BY ALL)"""


def projected(t: Tables):
    marketing = t.customer.groupBy(
        F.col("c_nationkey").alias("company"),
        F.col("c_mktsegment").alias("source"),
        F.when(F.col("c_custkey") % 4 == 0, "reactivated").otherwise("new").alias("segment"),
        F.lit(2001).alias("year"),
        (1 + F.col("c_custkey") % 12).cast("int").alias("month"),
    ).agg((F.count("*") * 40).alias("estimate"))
    sources = marketing.select("company", "source").distinct()
    split = F.explode(
        F.array(*[F.struct(F.lit(w).alias("weeks_til_start"), F.lit(s).alias("split")) for w, s in ((1, 0.75), (3, 0.25))])
    )
    delays = sources.select("company", "source", split.alias("d")).select("company", "source", "d.*")
    # Weeks of the plan year, taken from the years that the plan names.
    mondays = marketing.select("year").distinct().select(
        F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31)), F.expr("interval 7 days"))).alias("monday")
    )
    calendar = mondays.select(F.year("monday").alias("year"), F.month("monday").alias("month"), "monday")
    effects = sources.withColumn("effect", F.when(F.col("source") == "BUILDING", 0.9).otherwise(1.1))
    begun = C.start_deliveries(marketing, delays, calendar)
    return C.project_orders(begun, C.keep_latest_cohorts(curve(t), 3), effects)


@query("job_21", f"WITH {_STARTS} SELECT * FROM po")
def job_21(t: Tables):
    return projected(t)


_DECAY = f"""{LATEST}, dc AS (SELECT DISTINCT company, 0.9 + company % 5 / 100.0 AS decay FROM latest),
ext AS (SELECT company, segment, year, month, CAST(w AS INTEGER) AS cohort_week, average_orders * pow(decay, w - 8) AS average_orders
  FROM latest JOIN dc USING (company), range(9, 13) r(w) WHERE cohort_week = 8)"""


@query(
    "job_21_extended",
    f"""WITH {_DECAY} SELECT company, segment, year, month, cohort_week, round(average_orders, 8) AS average_orders FROM ext""",
)
def job_21_extended(t: Tables):
    latest = C.keep_latest_cohorts(curve(t), 3)
    decay = latest.select("company").distinct().withColumn("decay", 0.9 + F.col("company") % 5 / 100.0)
    out = C.extend_curve(latest, decay, 12)
    return out.withColumn("average_orders", F.round("average_orders", 8))


_ESTABLISHED = f"""{MENU}, f AS (SELECT customer, company, CAST(year(min(monday)) AS INTEGER) AS signup_year, max(monday) AS last,
    count(*) AS n FROM menu GROUP BY 1, 2),
mx AS (SELECT company, max(last) AS monday FROM f GROUP BY 1),
es AS (SELECT company, signup_year, CASE WHEN n > 10 THEN 'frequent' ELSE 'regular' END AS segment, monday, count(*) * 20
  AS n_customers, sum(n) AS n_orders FROM f JOIN mx USING (company) GROUP BY ALL),
rt AS (SELECT DISTINCT company, signup_year, 0.5 + signup_year % 4 / 10.0 AS share_active FROM es),
fq AS (SELECT company, segment, sum(n_orders) / sum(n_customers) AS opc FROM es GROUP BY 1, 2),
cr AS (SELECT company, CAST(unnest(generate_series(monday, DATE '2001-12-31', INTERVAL 7 DAY)) AS DATE) AS delivery FROM mx),
eo AS (SELECT es.company, delivery, CAST(sum(round(round(opc * round(n_customers * pow(exp(ln(share_active) / 51),
  (delivery - monday) // 7)), 9))) AS BIGINT) AS n_orders FROM es JOIN rt USING (company, signup_year)
  JOIN fq USING (company, segment) JOIN cr ON cr.company = es.company GROUP BY 1, 2)"""


def established_orders(t: Tables):
    per = menu_orders(t).groupBy("customer", "company").agg(
        F.year(F.min("monday")).alias("signup_year"), F.max("monday").alias("last"), F.count("*").alias("n")
    )
    newest = per.groupBy("company").agg(F.max("last").alias("monday"))
    seg = F.when(F.col("n") > 10, "frequent").otherwise("regular")
    es = per.join(newest, "company").groupBy("company", "signup_year", seg.alias("segment"), "monday").agg(
        (F.count("*") * 20).alias("n_customers"), F.sum("n").alias("n_orders")
    )
    retention = es.select("company", "signup_year").distinct().withColumn(
        "share_active", 0.5 + F.col("signup_year") % 4 / 10.0
    )
    frequency = es.groupBy("company", "segment").agg(
        (F.sum("n_orders") / F.sum("n_customers")).alias("orders_per_customer")
    )
    return C.compound_retention(es.drop("n_orders"), retention, frequency, F.lit("2001-12-31").cast("date"))


@query("job_22", f"WITH {_ESTABLISHED} SELECT * FROM eo")
def job_22(t: Tables):
    return established_orders(t)


@query(
    "job_23",
    f"""WITH {_STARTS}, {_ESTABLISHED.removeprefix(MENU + ', ')},
    al AS (SELECT company, 'started' AS segment, delivery, n_orders FROM po UNION ALL
      SELECT company, 'established', delivery, n_orders FROM eo),
    y AS (SELECT company, CAST(isoyear(delivery) * 100 + weekofyear(delivery) AS INTEGER) AS year_week, segment,
      CAST(sum(n_orders) AS BIGINT) AS n_orders FROM al GROUP BY ALL),
    fc AS (SELECT company, year_week, CAST(sum(n_orders) AS BIGINT) + 1 AS forecast_orders FROM y
      WHERE segment = 'established' GROUP BY 1, 2)
    SELECT company, year_week, segment, n_orders, round(n_orders / nullif(sum(n_orders) OVER (PARTITION BY company, year_week), 0), 8)
    AS segment_share, forecast_orders FROM y LEFT JOIN fc USING (company, year_week)
    WHERE year_week BETWEEN 200132 AND 200150""",
)
def job_23(t: Tables):
    est = established_orders(t).withColumn("segment", F.lit("established"))
    begun = projected(t).select("company", "segment", "delivery", "n_orders")
    forecast = est.groupBy("company", year_week("delivery").alias("year_week")).agg(
        (F.sum("n_orders") + 1).alias("forecast_orders")
    )
    out = C.budget_summary(
        [begun, est.select("company", "segment", "delivery", "n_orders")],
        forecast,
        {"new": "started", "reactivated": "started"},
        200132,
        200150,
    )
    return out.withColumn("segment_share", F.round("segment_share", 8))
