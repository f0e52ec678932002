"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.jn import WEEKLY, weekly_orders
from larder.catalog.registry import Tables, query
from larder.functions.dates import future, iso_week_start, monday_of, year_week
from larder.operators import calendars
from larder.operators import windows as W


@query(
    "win_01",
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1
    WHEN 'O' THEN 2 ELSE 3 END, o_orderdate, o_orderkey) AS rn FROM orders""",
)
def win_01(t: Tables):
    prio = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", prio.alias("prio"))
    return W.rank_rows(o, ["o_custkey"], ["prio", "o_orderdate", "o_orderkey"]).select("o_orderkey", "rn")


@query(
    "win_02",
    """SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts)) AS version,
    dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts) DESC) AS version_desc FROM events""",
)
def win_02(t: Tables):
    ev = t.events.select("event_id", "user_id", F.date_trunc("hour", "ts").alias("hour"))
    return W.version_rank(ev, ["user_id"], "hour").select("event_id", "version", "version_desc")


@query(
    "win_03",
    """SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    AS previous_o_totalprice FROM orders""",
)
def win_03(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return W.lag_cols(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"]).select(
        "o_orderkey", "previous_o_totalprice"
    )


@query(
    "win_04",
    """SELECT event_id, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
    TIMESTAMP '9999-12-31 00:00:00') AS next_ts FROM events""",
)
def win_04(t: Tables):
    ev = t.events.select("event_id", "user_id", "ts")
    return W.lead_or(ev, ["user_id"], ["ts", "event_id"], "ts", future()).select("event_id", "next_ts")


@query(
    "win_05",
    """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER
    (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent_filled
    FROM events""",
)
def win_05(t: Tables):
    spent = F.when(F.col("event_type") == "purchase", F.col("value"))
    ev = t.events.select("event_id", "user_id", "ts", spent.alias("spent"))
    return W.ffill(ev, ["user_id"], ["ts", "event_id"], "spent").select("event_id", "spent_filled")


@query(
    "win_06",
    """SELECT o_orderkey, count(*) OVER w AS running_count, round(sum(o_totalprice) OVER w, 2) AS running_sum
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win_06(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = W.running_totals(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice")
    return r.select("o_orderkey", "running_count", F.round("running_sum", 2).alias("running_sum"))


@query(
    "win_07",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, count(*) OVER p AS n, sum(l_quantity) OVER p AS qty,
    max(l_discount) OVER p AS top_discount FROM lineitem WINDOW p AS (PARTITION BY l_orderkey)""",
)
def win_07(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    out = W.partition_totals(
        lines, ["l_orderkey"], n=F.count("*"), qty=F.sum("l_quantity"), top_discount=F.max("l_discount")
    )
    return out.drop("l_discount")


@query(
    "win_08",
    """WITH d AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_distinct, round(avg(l_discount), 8) AS mean
    FROM lineitem GROUP BY 1) SELECT l.l_orderkey, l_partkey, l_linenumber, n_distinct, mean FROM lineitem l
    JOIN d ON l.l_orderkey = d.l_orderkey""",
)
def win_08(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_discount")
    out = W.distinct_over(lines, ["l_orderkey"], "l_suppkey", "l_discount")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "n_distinct", F.round("mean", 8).alias("mean"))


@query(
    "win_09",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def win_09(t: Tables):
    o = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return W.qualify_first(o, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")])


@query(
    "win_10",
    f"""WITH {WEEKLY} SELECT company, year, week, CASE WHEN count(orders) OVER a = 12 THEN round(avg(orders) OVER a, 6)
    END AS moving_avg_12, CASE WHEN count(orders) OVER b = 52 THEN round(avg(orders) OVER b, 6) END AS moving_avg_52
    FROM weekly WINDOW a AS (PARTITION BY company ORDER BY year, week ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
    b AS (PARTITION BY company ORDER BY year, week ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING)""",
)
def win_10(t: Tables):
    m = W.moving_avg(weekly_orders(t), ["company"], ["year", "week"], "orders", [12, 52])
    return m.select("company", "year", "week", *[F.round(c, 6).alias(c) for c in ("moving_avg_12", "moving_avg_52")])


@query(
    "win_11",
    f"""WITH {WEEKLY} SELECT company, year, week, lag(orders, 12) OVER w AS orders_lag_12,
    lag(orders, 52) OVER w AS orders_lag_52 FROM weekly WINDOW w AS (PARTITION BY company ORDER BY year, week)""",
)
def win_11(t: Tables):
    return W.lags(weekly_orders(t), ["company"], ["year", "week"], "orders", [12, 52]).drop("orders")


@query(
    "win_12",
    f"""WITH {WEEKLY}, m AS (SELECT a.*, b.orders AS past, CASE WHEN a.week IN (1, 52) THEN 0 ELSE 1 END AS k
      FROM weekly a LEFT JOIN weekly b ON a.company = b.company AND a.year = b.year + 1 AND a.week = b.week)
    SELECT company, year, week, CASE WHEN count(orders * k) OVER w = 4 AND count(past * k) OVER w = 4 THEN
    round(sum(orders * k) OVER w / sum(past * k) OVER w, 8) END AS growth FROM m
    WINDOW w AS (PARTITION BY company ORDER BY year, week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
)
def win_12(t: Tables):
    w = weekly_orders(t)
    past = w.select("company", (F.col("year") + 1).alias("year"), "week", F.col("orders").alias("past"))
    m = w.join(past, ["company", "year", "week"], "left")
    r = W.rolling_ratio(
        m, ["company"], ["year", "week"], "orders", "past", 4, ~F.col("week").isin(1, 52), "growth"
    )
    return r.select("company", "year", "week", F.round("growth", 8).alias("growth"))


@query(
    "win_13",
    """WITH s AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, count(*) AS n
      FROM orders GROUP BY 1, 2),
    g AS (SELECT *, CAST(day(last_day(snapshot_date)) - 25 + n AS BIGINT) AS weeks FROM s)
    SELECT o_custkey, snapshot_date, CASE WHEN last_value(weeks) OVER (PARTITION BY o_custkey ORDER BY snapshot_date
    ROWS BETWEEN 3 FOLLOWING AND 4 FOLLOWING) > 4 THEN 'churned' ELSE 'active' END AS label FROM g""",
)
def win_13(t: Tables):
    s = t.orders.groupBy("o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("snapshot_date")).agg(
        F.count("*").alias("n")
    )
    s = s.withColumn("weeks", F.day(F.last_day("snapshot_date")) - 25 + F.col("n"))
    return W.label_ahead(s, ["o_custkey"], "snapshot_date", "weeks", 4).select("o_custkey", "snapshot_date", "label")


_GAPPY = """g AS (SELECT n_regionkey AS company, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday,
  count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE weekofyear(o_orderdate) % 5 <> 0 GROUP BY 1, 2)"""


@query(
    "win_14",
    f"""WITH {_GAPPY}, s AS (SELECT company, min(monday) AS lo, max(monday) AS hi FROM g GROUP BY company),
    c AS (SELECT company, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS monday FROM s)
    SELECT company, monday, last_value(orders IGNORE NULLS) OVER (PARTITION BY company ORDER BY monday
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS orders FROM c LEFT JOIN g USING (company, monday)""",
)
def win_14(t: Tables):
    w = weekly_orders(t).where("week % 5 <> 0")
    w = w.select("company", iso_week_start("year", "week").alias("monday"), "orders")
    return W.ffill_weeks(w, ["company"], "monday", ["orders"])


@query(
    "win_15",
    f"""WITH {WEEKLY}, m AS (SELECT *, orders - CASE WHEN count(*) OVER w = 52 THEN avg(orders) OVER w END AS d
      FROM weekly WINDOW w AS (PARTITION BY company ORDER BY year, week ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING))
    SELECT company, year, week, round(avg(d) OVER (PARTITION BY company, week), 6) AS seasonality FROM m""",
)
def win_15(t: Tables):
    s = W.seasonality(weekly_orders(t), ["company"], ["year", "week"], "week", "orders")
    return s.select("company", "year", "week", F.round("seasonality", 6).alias("seasonality"))


@query(
    "win_16",
    """SELECT *, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY monday) AS INTEGER) AS seq FROM
    (SELECT DISTINCT c_nationkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM orders
    JOIN customer ON o_custkey = c_custkey)""",
)
def win_16(t: Tables):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return W.number_periods(o.select("c_nationkey", monday_of("o_orderdate").alias("monday")), ["c_nationkey"], "monday")


@query(
    "win_17",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('week', o_orderdate) AS DATE) AS m
      FROM orders)
    SELECT day, CAST(row_number() OVER (PARTITION BY year(m), quarter(m) ORDER BY day) AS INTEGER)
    AS day_of_financial_quarter, CAST(row_number() OVER (PARTITION BY year(m), month(m) ORDER BY day) AS INTEGER)
    AS day_of_financial_month FROM d""",
)
def win_17(t: Tables):
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return calendars.financial_calendar(days).select("day", "day_of_financial_quarter", "day_of_financial_month")


@query(
    "win_18",
    """SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY s DESC, id) AS order_rank
    FROM (SELECT *, l_discount + l_tax AS s, l_orderkey * 100000000 + l_partkey * 10 + l_linenumber AS id FROM lineitem)""",
)
def win_18(t: Tables):
    lines = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_suppkey",
        (F.col("l_discount") + F.col("l_tax")).alias("score"),
        (F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("id"),
    )
    return W.rank_by_score(lines, ["l_suppkey"], "score", "id").select(
        "l_orderkey", "l_partkey", "l_linenumber", "order_rank"
    )


@query(
    "win_19",
    """WITH w AS (SELECT DISTINCT l_partkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS m FROM lineitem),
    p AS (SELECT *, lag(m) OVER (PARTITION BY l_partkey ORDER BY m) AS pm FROM w)
    SELECT l_partkey, CAST(isoyear(m) * 100 + weekofyear(m) AS INTEGER) AS yw,
    CAST(isoyear(pm) * 100 + weekofyear(pm) AS INTEGER) AS last_week, CAST((m - pm) // 7 AS INTEGER) AS weeks_since FROM p""",
)
def win_19(t: Tables):
    lines = t.lineitem.select("l_partkey", year_week("l_shipdate").alias("yw"))
    return W.weeks_since_last(lines, ["l_partkey"], "yw")
