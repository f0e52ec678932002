"""Jobs: menu weeks, segments, cohorts, demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.functions.dates import monday_of
from larder.plans import demand, journey


def menu_orders(t: Tables):
    """Orders with the menu week they are for: the week after the order."""
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        F.col("o_custkey").alias("customer"),
        F.col("c_nationkey").alias("company"),
        "o_orderkey",
        F.col("o_orderdate").alias("created_at"),
        F.date_add(monday_of("o_orderdate"), 7).alias("monday"),
        "o_orderpriority",
    )


MENU = """menu AS (SELECT o_custkey AS customer, c_nationkey AS company, o_orderkey, o_orderdate AS created_at,
  CAST(date_trunc('week', o_orderdate) AS DATE) + 7 AS monday, o_orderpriority FROM orders
  JOIN customer ON o_custkey = c_custkey)"""
WEEKS = f"""{MENU}, weeks AS (SELECT company, monday, CAST(isoyear(monday) * 100 + weekofyear(monday) AS INTEGER) AS year_week,
  CAST(min(CAST(created_at AS DATE)) - 1 AS TIMESTAMP) + INTERVAL 1439 MINUTE AS cutoff,
  CAST(row_number() OVER (PARTITION BY company ORDER BY monday) AS INTEGER) AS seq FROM menu GROUP BY company, monday),
mw AS (SELECT *, lag(cutoff) OVER (PARTITION BY company ORDER BY seq) AS previous_cutoff,
  CAST(isoyear(monday + 7) * 100 + weekofyear(monday + 7) AS INTEGER) AS next_year_week,
  monday = max(monday) OVER (PARTITION BY company) AS is_latest FROM weeks)"""


@query("job_02", f"WITH {WEEKS} SELECT * FROM mw")
def job_02(t: Tables):
    return journey.menu_weeks(menu_orders(t))


@query(
    "job_03",
    f"""WITH {MENU}, f AS (SELECT customer, min(monday) AS first_monday, arg_min(created_at, (monday, created_at))
      AS first_created_at FROM menu GROUP BY customer)
    SELECT customer, first_monday, first_created_at, CAST(CASE WHEN month(first_monday) = 12 AND weekofyear(first_monday) = 1
    THEN 53 ELSE weekofyear(first_monday) END AS INTEGER) AS financial_week,
    CAST(month(first_monday) AS INTEGER) AS financial_month, CAST(quarter(first_monday) AS INTEGER) AS financial_quarter,
    CAST(year(first_monday) AS INTEGER) AS financial_year FROM f""",
)
def job_03(t: Tables):
    return journey.first_orders(menu_orders(t), "customer")


def journey_customers(t: Tables):
    """Signup and deletion times derived from the orders of a customer."""
    k = F.col("customer").cast("int")
    span = menu_orders(t).groupBy("customer", "company").agg(
        F.min("created_at").alias("lo"), F.max("created_at").alias("hi")
    )
    days = lambda c, d: (F.date_add(F.to_date(c), d)).cast("timestamp_ntz")
    return span.select(
        "customer",
        "company",
        days("lo", -(k % 60)).alias("signup_at"),
        F.when(k % 3 == 0, days("lo", -(k % 60))).alias("partial_signup_at"),
        days("lo", (k % 3) * 7 - (k % 60)).alias("full_signup_at"),
        F.when(k % 11 == 0, days("hi", F.lit(30))).alias("deleted_at"),
    )


_CUST = """cust AS (SELECT customer, company, CAST(CAST(min(created_at) AS DATE) - CAST(customer % 60 AS INTEGER) AS TIMESTAMP)
  AS signup_at,
  CASE WHEN customer % 3 = 0 THEN CAST(CAST(min(created_at) AS DATE) - CAST(customer % 60 AS INTEGER) AS TIMESTAMP) END
  AS partial_signup_at,
  CAST(CAST(min(created_at) AS DATE) + CAST((customer % 3) * 7 - customer % 60 AS INTEGER) AS TIMESTAMP) AS full_signup_at,
  CASE WHEN customer % 11 = 0 THEN CAST(CAST(max(created_at) AS DATE) + 30 AS TIMESTAMP) END AS deleted_at
  FROM menu GROUP BY customer, company)"""

JOURNEY = f"""{WEEKS}, {_CUST},
o AS (SELECT customer, company, monday, seq FROM menu JOIN weeks USING (company, monday)),
firsts AS (SELECT customer, min(monday) AS fm FROM menu GROUP BY customer),
base AS (SELECT c.customer, w.company, w.monday, w.seq, w.cutoff, c.deleted_at, fm,
    CAST(date_trunc('week', partial_signup_at) AS DATE) AS pm, CAST(date_trunc('week', full_signup_at) AS DATE) AS flm,
    p.monday AS possible
  FROM cust c JOIN firsts USING (customer) JOIN mw w ON w.company = c.company
    AND w.monday >= CAST(date_trunc('week', signup_at) AS DATE)
    AND w.cutoff < coalesce(deleted_at, TIMESTAMP '9999-12-31')
  LEFT JOIN mw p ON p.company = c.company AND p.cutoff >= full_signup_at
    AND coalesce(p.previous_cutoff, p.monday - INTERVAL 7 DAY) < full_signup_at),
n8 AS (SELECT b.customer, b.monday, count(*) AS n FROM base b JOIN o ON o.customer = b.customer
  AND o.seq BETWEEN b.seq - 7 AND b.seq GROUP BY 1, 2),
back AS (SELECT DISTINCT a.customer, a.monday FROM o a WHERE NOT EXISTS (SELECT 1 FROM o b WHERE b.customer = a.customer
  AND b.seq BETWEEN a.seq - 8 AND a.seq - 1)),
lb AS (SELECT b.customer, b.monday, max(k.monday) AS bm FROM base b JOIN back k ON k.customer = b.customer
  AND k.monday <= b.monday GROUP BY 1, 2),
d AS (SELECT b.*, n, (b.monday - possible) // 7 AS sp, CASE WHEN fm <= b.monday THEN (b.monday - fm) // 7 END AS sf,
  (b.monday - bm) // 7 AS sb FROM base b LEFT JOIN n8 USING (customer, monday) LEFT JOIN lb USING (customer, monday)),
seg AS (SELECT customer, monday, cutoff, deleted_at, CASE
  WHEN monday >= pm AND monday < coalesce(flm, DATE '9999-12-31') THEN 'partial_signup'
  WHEN coalesce(sp, 0) < 3 AND monday >= flm AND sf IS NULL THEN 'pending_onboarding'
  WHEN sp >= 3 AND sf IS NULL THEN 'regret' WHEN sf < 7 AND n < 4 THEN 'onboarding'
  WHEN sb < 7 AND n < 4 THEN 'reactivated' WHEN n < 4 AND sf >= 7 THEN 'occasional' WHEN n >= 4 AND n < 6 THEN 'regular'
  WHEN n >= 6 AND n < 8 THEN 'frequent' WHEN n >= 7 THEN 'always_on' WHEN sf >= 7 AND n IS NULL THEN 'churned'
  ELSE 'unknown' END AS segment FROM d),
ch AS (SELECT * FROM (SELECT *, lag(segment) OVER (PARTITION BY customer ORDER BY monday) AS p FROM seg)
  WHERE p IS NULL OR p <> segment),
segments AS (SELECT customer, segment, monday AS monday_from, cutoff AS cutoff_from,
  coalesce(lead(monday) OVER (PARTITION BY customer ORDER BY monday), least(DATE '9999-12-31', CAST(deleted_at AS DATE)))
  AS monday_to FROM ch)"""


def segments(t: Tables):
    orders = menu_orders(t)
    return journey.journey_segments(journey_customers(t), orders, journey.menu_weeks(orders))


@query("job_01", f"WITH {JOURNEY} SELECT * FROM segments")
def job_01(t: Tables):
    return segments(t)


@query(
    "job_04",
    f"""WITH {JOURNEY}, r AS (SELECT customer, monday_from, coalesce(lead(monday_from) OVER (PARTITION BY customer
      ORDER BY monday_from), DATE '9999-12-31') AS monday_to FROM segments WHERE segment = 'reactivated')
    SELECT r.*, (SELECT min(o_orderpriority) FROM menu m WHERE m.customer = r.customer AND m.monday = r.monday_from
    AND o_orderpriority < '4') AS discount FROM r""",
)
def job_04(t: Tables):
    used = menu_orders(t).where("o_orderpriority < '4'").select(
        "customer", "monday", F.col("o_orderpriority").alias("discount")
    )
    return journey.reactivations(segments(t), used)


_DEMAND = f"""{MENU},
w AS (SELECT company, max(monday) + CAST(7 * i AS INTEGER) AS monday FROM menu, range(1, 5) r(i) GROUP BY company, i),
b AS (SELECT c_custkey AS customer, c_nationkey AS company, c_custkey * 10 AS basket, 10 * (1 + c_custkey % 3) AS dt,
  c_custkey % 4 AS slot, c_custkey % 100 AS postal FROM customer),
s AS (SELECT customer, w.monday, customer % 8 = 0 AS hd, 9 AS slot FROM b JOIN w USING (company)
  WHERE customer % 4 = 0 AND day(w.monday) % 2 = 0),
last AS (SELECT customer, max(o_orderkey) AS ok FROM menu GROUP BY customer),
items AS (SELECT customer, l_partkey AS item, sum(l_quantity) AS quantity FROM last JOIN lineitem ON l_orderkey = ok
  GROUP BY 1, 2),
dev AS (SELECT basket, min(w.monday) AS monday, basket + 1 AS deviation FROM b JOIN w USING (company)
  WHERE customer % 5 = 0 GROUP BY basket),
live AS (SELECT b.company, b.customer, basket, w.monday, coalesce(s.slot, b.slot) AS slot, postal FROM b JOIN w USING (company)
  LEFT JOIN s ON s.customer = b.customer AND s.monday = w.monday
  WHERE CASE WHEN dt = 10 OR dt = CASE WHEN weekofyear(w.monday) % 2 = 0 THEN 20 ELSE 30 END THEN coalesce(hd, true)
    ELSE coalesce(hd, false) END
  AND postal NOT IN (7, 77)),
ok AS (SELECT * FROM live WHERE NOT (slot = 3 AND company % 2 = 0 AND postal < 50))"""


@query(
    "job_05",
    f"""WITH {_DEMAND}
    SELECT company, ok.customer, ok.basket, ok.monday, item, quantity, 'default' AS origin FROM ok
    JOIN items ON items.customer = ok.customer LEFT JOIN dev ON dev.basket = ok.basket AND dev.monday = ok.monday
    WHERE dev.basket IS NULL
    UNION ALL SELECT company, ok.customer, ok.basket, ok.monday, item, quantity + 1, 'deviation' FROM ok
    JOIN dev ON dev.basket = ok.basket AND dev.monday = ok.monday JOIN items ON items.customer = ok.customer""",
)
def job_05(t: Tables):
    orders = menu_orders(t)
    k = F.col("customer")
    weeks = orders.groupBy("company").agg(F.max("monday").alias("m")).select(
        "company", F.explode(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.date_add("m", i * 7))).alias("monday")
    )
    baskets = t.customer.select(
        F.col("c_custkey").alias("customer"),
        F.col("c_nationkey").alias("company"),
        (F.col("c_custkey") * 10).alias("basket"),
        (10 * (1 + F.col("c_custkey") % 3)).alias("delivery_type"),
        (F.col("c_custkey") % 4).alias("slot"),
        (F.col("c_custkey") % 100).alias("postal"),
    )
    by_week = baskets.join(weeks, "company")
    schedule = by_week.where((k % 4 == 0) & (F.day("monday") % 2 == 0)).select(
        "customer", "monday", (k % 8 == 0).alias("has_delivery"), F.lit(9).cast("long").alias("slot")
    )
    last = orders.groupBy("customer").agg(F.max("o_orderkey").alias("l_orderkey"))
    items = t.lineitem.join(last, "l_orderkey").groupBy("customer", F.col("l_partkey").alias("item")).agg(
        F.sum("l_quantity").alias("quantity")
    )
    deviations = by_week.where(k % 5 == 0).groupBy("basket").agg(F.min("monday").alias("monday"))
    deviations = deviations.withColumn("deviation", F.col("basket") + 1)
    blacklist = by_week.where("company % 2 = 0 and postal < 50").select(
        "company", "monday", F.lit(3).cast("long").alias("slot"), "postal", F.lit(None).cast("long").alias("fallback")
    )
    return demand.estimate_demand(
        baskets,
        weeks,
        schedule,
        deviations,
        items.select((k * 10 + 1).alias("deviation"), "item", (F.col("quantity") + 1).alias("quantity")),
        items.select((k * 10).alias("basket"), "item", "quantity"),
        baskets.where("postal in (7, 77)"),
        blacklist,
    )
