"""Jobs: weekly forecasting."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.jn import WEEKLY, weekly_orders
from larder.catalog.registry import Tables, query
from larder.functions.dates import monday_of, iso_year
from larder.operators.aggregates import median_ratio
from larder.plans import forecasting as P


def estimations(t: Tables):
    target = F.date_add(monday_of("ts"), ((F.col("event_id") % 3 + 1) * 7).cast("int"))
    ev = t.events.select(
        (F.col("user_id") % 4).alias("company"),
        F.col("event_type").alias("product"),
        iso_year(target).cast("int").alias("year"),
        F.weekofyear(target).alias("week"),
        F.col("ts").alias("estimated_at"),
        F.col("event_id").alias("id"),
        F.round(F.col("value") * 100).cast("long").alias("quantity"),
    )
    return ev


EST = """ev AS (SELECT user_id % 4 AS company, event_type AS product, CAST(date_trunc('week', ts) AS DATE)
    + CAST((event_id % 3 + 1) * 7 AS INTEGER) AS monday, ts, event_id, CAST(round(value * 100) AS BIGINT) AS quantity FROM events),
fst AS (SELECT company, monday, CAST(ts AS DATE) AS d, product, arg_min(quantity, (ts, event_id)) AS q FROM ev GROUP BY ALL),
daily AS (SELECT company, monday, d, CAST(sum(q) AS BIGINT) AS quantity FROM fst GROUP BY ALL),
tl AS (SELECT company, d, count(*) AS n, max(monday) AS lm, arg_max(quantity, monday) AS lq FROM daily GROUP BY 1, 2),
est AS (SELECT company, monday, d, quantity FROM daily UNION ALL
  SELECT company, lm + CAST(7 * i AS INTEGER), d, lq FROM tl, range(1, 6) r(i) WHERE i <= 5 - n),
estimations AS (SELECT company, CAST(isoyear(monday) AS INTEGER) AS year, CAST(weekofyear(monday) AS INTEGER) AS week,
  d AS estimation_date, quantity, CAST(monday - 6 - d AS INTEGER) AS days_to_cutoff FROM est)"""


@query("job_13", f"WITH {EST} SELECT * FROM estimations")
def job_13(t: Tables):
    return P.clean_estimations(estimations(t), cutoff_weekday=2, min_weeks=5)


# The estimates cover 2024: actual orders of the same weeks are counted from the events.
ACTUAL = """actual AS (SELECT user_id % 4 AS company, CAST(isoyear(ts) AS INTEGER) AS year,
  CAST(weekofyear(ts) AS INTEGER) AS week, count(*) * 40 AS orders FROM events GROUP BY ALL)"""


def actual(t: Tables):
    return t.events.groupBy(
        (F.col("user_id") % 4).alias("company"), iso_year("ts").cast("int").alias("year"), F.weekofyear("ts").alias("week")
    ).agg((F.count("*") * 40).alias("orders"))


@query(
    "job_14",
    f"""WITH {EST}, {ACTUAL},
    ret AS (SELECT days_to_cutoff, median(CASE WHEN quantity > 0 THEN orders / quantity ELSE 0 END) AS rate
      FROM estimations JOIN actual USING (company, year, week) GROUP BY 1),
    f AS (SELECT *, lag(orders, 2) OVER w AS x, lag(orders, 12) OVER w AS orders_lag_12 FROM actual
      WINDOW w AS (PARTITION BY company ORDER BY year, week))
    SELECT company, f.year, f.week, orders, orders_lag_12, estimation_date, quantity, days_to_cutoff,
    round(quantity * rate, 6) AS projected, CAST(f.week % 4 = 0 AS INTEGER) AS has_holiday
    FROM f JOIN estimations e USING (company, year, week) LEFT JOIN ret USING (days_to_cutoff)""",
)
def job_14(t: Tables):
    est = P.clean_estimations(estimations(t), cutoff_weekday=2, min_weeks=5)
    act = actual(t)
    seen = est.join(act, ["company", "year", "week"])
    retention = median_ratio(seen, ["days_to_cutoff"], "orders", "quantity")
    holidays = act.select("year", "week").distinct().withColumn("has_holiday", (F.col("week") % 4 == 0).cast("int"))
    f = P.forecast_features(act, est, retention, holidays)
    return f.select(
        "company", "year", "week", "orders", "orders_lag_12", "estimation_date", "quantity", "days_to_cutoff",
        F.round("projected", 6).alias("projected"), "has_holiday",
    )


_RATES = ["orders_rate_total", "orders_rate_dishes", "dish_share_rate_total", "dish_share_rate_dishes"]
_PROJECTED = [c.replace("_rate_", "_projected_") for c in _RATES]
_HISTORY = ["orders_lag_12", "orders_lag_52", "moving_avg_12", "moving_avg_52", "seasonality"]
_ratio = lambda x, e: f"median(CASE WHEN {e} > 0 THEN {x} / {e} ELSE 0 END)"


@query(
    "job_14_targets",
    f"""WITH o AS (SELECT n_regionkey AS company, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, CAST(o_orderdate AS DATE) AS d,
      CAST(7 * (o_orderkey % 3 + 1) AS INTEGER) AS ahead, o_orderpriority < '3' AS dish
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    wk AS (SELECT company, CAST(isoyear(monday) AS INTEGER) AS year, CAST(weekofyear(monday) AS INTEGER) AS week, count(*) AS orders,
      count(*) FILTER (dish) / count(*) AS dish_share FROM o GROUP BY ALL),
    es AS (SELECT company, monday + ahead AS m, d, count(*) * 3 AS total, nullif(count(*) FILTER (dish) * 3, 0) AS dishes FROM o GROUP BY ALL),
    e AS (SELECT company, CAST(isoyear(m) AS INTEGER) AS year, CAST(weekofyear(m) AS INTEGER) AS week, d AS estimation_date,
      CAST(m - 6 - d AS INTEGER) AS days_to_cutoff, total, dishes FROM es),
    h AS (SELECT * FROM wk JOIN e USING (company, year, week) WHERE days_to_cutoff >= 0),
    rt AS (SELECT company, days_to_cutoff, {_ratio("orders", "total")} AS r1, {_ratio("dish_share", "total")} AS r2 FROM h GROUP BY 1, 2),
    rd AS (SELECT company, days_to_cutoff, {_ratio("orders", "dishes")} AS r3, {_ratio("dish_share", "dishes")} AS r4 FROM h
      WHERE dishes IS NOT NULL GROUP BY 1, 2),
    f AS (SELECT company, year, week, orders AS n, lag(orders, 12) OVER w AS orders_lag_12, lag(orders, 52) OVER w AS orders_lag_52,
      CASE WHEN count(*) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) = 12 THEN avg(orders) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
      END AS ma12, CASE WHEN count(*) OVER (w ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING) = 52 THEN avg(orders) OVER
      (w ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING) END AS ma52 FROM wk WINDOW w AS (PARTITION BY company ORDER BY year, week)),
    s AS (SELECT company, week, avg(n - ma52) AS seasonality FROM f GROUP BY 1, 2)
    SELECT company, year, week, orders, round(dish_share, 8) AS dish_share, estimation_date, days_to_cutoff, total, dishes,
      round(r1, 8) AS orders_rate_total, round(r3, 8) AS orders_rate_dishes, round(r2, 8) AS dish_share_rate_total,
      round(r4, 8) AS dish_share_rate_dishes, round(r1 * total, 8) AS orders_projected_total, round(r3 * dishes, 8) AS orders_projected_dishes,
      round(r2 * total, 8) AS dish_share_projected_total, round(r4 * dishes, 8) AS dish_share_projected_dishes, orders_lag_12, orders_lag_52,
      round(ma12, 8) AS moving_avg_12, round(ma52, 8) AS moving_avg_52, round(seasonality, 8) AS seasonality,
      CAST(week % 4 = 0 AS INTEGER) AS has_holiday
    FROM h JOIN rt USING (company, days_to_cutoff) JOIN rd USING (company, days_to_cutoff) JOIN f USING (company, year, week)
    JOIN s USING (company, week)""",
)
def job_14_targets(t: Tables):
    """Two targets and two estimates per region; orders stand for estimates of the weeks after them."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    o = o.select(
        F.col("n_regionkey").alias("company"), F.to_date("o_orderdate").alias("estimation_date"),
        F.date_add(monday_of("o_orderdate"), (7 * (F.col("o_orderkey") % 3 + 1)).cast("int")).alias("monday"),
        (F.col("o_orderpriority") < "3").alias("dish"),
    )
    week = lambda c: [iso_year(c).cast("int").alias("year"), F.weekofyear(c).alias("week")]
    dishes = F.count_if("dish")
    weekly = o.groupBy("company", *week("estimation_date")).agg(
        F.count("*").alias("orders"), (dishes / F.count("*")).alias("dish_share")
    )
    e = o.groupBy("company", "monday", "estimation_date").agg(
        (F.count("*") * 3).alias("total"), F.when(dishes > 0, dishes * 3).alias("dishes")
    )
    e = e.select(
        "company", *week("monday"), "estimation_date", "total", "dishes",
        (F.datediff("monday", "estimation_date") - 6).alias("days_to_cutoff"),
    )
    holidays = weekly.where("week % 4 = 0").select("year", "week").distinct().withColumn("has_holiday", F.lit(1))
    f = P.training_features(weekly, e, holidays, ["orders", "dish_share"], "total", "dishes")
    rounded = [F.round(c, 8).alias(c) for c in ["dish_share", *_RATES, *_PROJECTED, *_HISTORY[2:]]]
    return f.select(
        "company", "year", "week", "orders", "estimation_date", "days_to_cutoff", "total", "dishes", *_HISTORY[:2], "has_holiday", *rounded
    )


SPLIT = f"""{WEEKLY}, past AS (SELECT * FROM weekly WHERE year * 100 + week < 200101),
future AS (SELECT company, year, week FROM weekly WHERE year * 100 + week >= 200101)"""


def split(t: Tables):
    w = weekly_orders(t)
    yw = F.col("year") * 100 + F.col("week")
    return w.where(yw < 200101), w.where(yw >= 200101).select("company", "year", "week")


@query(
    "job_15",
    f"""WITH {SPLIT}, l AS (SELECT company, arg_max(orders, (year, week)) AS now FROM past GROUP BY 1),
    bt AS (SELECT company, max((year, week)) AS t FROM past WHERE week <> 53 GROUP BY 1),
    b AS (SELECT bt.company, orders AS past_now FROM bt LEFT JOIN past p ON p.company = bt.company AND p.year + 1 = bt.t[1]
      AND p.week = bt.t[2]),
    r4 AS (SELECT * FROM past QUALIFY row_number() OVER (PARTITION BY company ORDER BY year DESC, week DESC) <= 4),
    r5 AS (SELECT r4.*, p.orders AS v FROM r4 LEFT JOIN past p ON p.company = r4.company AND p.year + 1 = r4.year AND p.week = r4.week),
    r AS (SELECT company, median(orders / pv) AS ratio FROM (SELECT *, coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN
      UNBOUNDED PRECEDING AND CURRENT ROW), first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS pv
      FROM r5 WINDOW w AS (PARTITION BY company ORDER BY year, week)) GROUP BY 1),
    j AS (SELECT f.*, p.orders AS v FROM future f LEFT JOIN past p ON p.company = f.company AND p.year + 1 = f.year
      AND p.week = f.week),
    g AS (SELECT *, coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS past FROM j
      WINDOW w AS (PARTITION BY company ORDER BY year, week))
    SELECT company, year, week, round(now * past / past_now, 6) AS week_ratio, now + past - past_now AS week_diff,
    round(past * ratio, 6) AS rolling_ratio FROM g JOIN l USING (company) JOIN b USING (company) JOIN r USING (company)""",
)
def job_15(t: Tables):
    past, future = split(t)
    p = P.baseline_projection(past, future, "orders")
    return p.select(
        "company", "year", "week", F.round("week_ratio", 6).alias("week_ratio"), "week_diff",
        F.round("rolling_ratio", 6).alias("rolling_ratio"),
    )


@query(
    "job_16",
    f"""WITH {WEEKLY}, p AS (SELECT company, year, week, orders * 1.1 AS total, orders * 0.41 AS dishes, 0.35 AS share FROM weekly)
    SELECT company, year, week, round(total)::DOUBLE AS total, round(dishes)::DOUBLE AS dishes,
    round(total * share)::DOUBLE AS dishes_calc, round((round(total * share) + dishes) / 2)::DOUBLE AS dishes_avg FROM p""",
)
def job_16(t: Tables):
    dec = lambda c, x: (F.col(c).cast("decimal(18,0)") * F.lit(x).cast("decimal(4,2)"))
    w = weekly_orders(t).select(
        "company", "year", "week", dec("orders", 1.1).alias("total"), dec("orders", 0.41).alias("dishes"),
        F.lit(0.35).cast("decimal(4,2)").alias("share"),
    )
    out = P.blend(w, "total", "dishes", "share").drop("share")
    return out.select("company", "year", "week", *[F.col(c).cast("double").alias(c) for c in ("total", "dishes", "dishes_calc", "dishes_avg")])


_MAPPED = f"""{SPLIT}, known AS (SELECT p.company, p.year, p.week, p.orders, q.orders AS mapped FROM past p
  LEFT JOIN weekly q ON q.company = p.company AND q.year = p.year - 1 AND q.week = p.week),
fut AS (SELECT f.*, q.orders AS mapped FROM future f LEFT JOIN weekly q ON q.company = f.company AND q.year = f.year - 1
  AND q.week = f.week)"""


@query(
    "job_17",
    f"""WITH {_MAPPED}, g AS (SELECT *, orders / mapped AS growth, CASE WHEN week IN (1, 52) THEN 0 ELSE 1 END AS k FROM known),
    h AS (SELECT *, CASE WHEN count(orders * k) OVER a = 4 AND count(mapped * k) OVER a = 4 THEN sum(orders * k) OVER a
      / sum(mapped * k) OVER a END AS g4, CASE WHEN count(orders * k) OVER b = 12 AND count(mapped * k) OVER b = 12 THEN
      sum(orders * k) OVER b / sum(mapped * k) OVER b END AS g12 FROM g
      WINDOW a AS (PARTITION BY company ORDER BY year, week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
      b AS (PARTITION BY company ORDER BY year, week ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
    l AS (SELECT company, arg_max(growth, (year, week)) FILTER (growth IS NOT NULL) AS growth, arg_max(g4, (year, week)) FILTER
      (g4 IS NOT NULL) AS g4, arg_max(g12, (year, week)) FILTER (g12 IS NOT NULL) AS g12 FROM h GROUP BY 1),
    x AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY year, week) - 1 AS x FROM (SELECT * FROM h
      QUALIFY row_number() OVER (PARTITION BY company ORDER BY year DESC, week DESC) <= 20)),
    s AS (SELECT company, regr_slope(growth, x) AS sl, regr_intercept(growth, x) AS ic, count(*) AS n FROM x GROUP BY 1),
    f AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY year, week) - 1 AS i FROM fut)
    SELECT company, year, week, round(growth, 6) AS growth, round(g4, 6) AS growth_4, round(g12, 6) AS growth_12,
    round(ic + sl * (n + i), 6) AS growth_linear, round((ic + sl * (n + i)) * mapped, 4) AS orders_by_growth_linear
    FROM f JOIN l USING (company) JOIN s USING (company)""",
)
def job_17(t: Tables):
    w = weekly_orders(t)
    past, future = split(t)
    prev = w.select("company", (F.col("year") + 1).alias("year"), "week", F.col("orders").alias("mapped"))
    known = past.join(prev, ["company", "year", "week"], "left")
    fut = future.join(prev, ["company", "year", "week"], "left")
    g = P.project_growth(known, fut, "orders", "mapped", ~F.col("week").isin(1, 52))
    cols = ("growth", "growth_4", "growth_12", "growth_linear")
    return g.select(
        "company", "year", "week", *[F.round(c, 6).alias(c) for c in cols],
        F.round("orders_by_growth_linear", 4).alias("orders_by_growth_linear"),
    )


@query(
    "job_18",
    f"""WITH {EST}, {ACTUAL}, v AS (SELECT e.*, CASE WHEN days_to_cutoff = 0 THEN coalesce(orders, quantity) ELSE quantity END
      AS v FROM estimations e LEFT JOIN actual USING (company, year, week))
    SELECT year, week, days_to_cutoff, max(v) FILTER (company = 0) AS "0", max(v) FILTER (company = 1) AS "1",
    max(v) FILTER (company = 2) AS "2", max(v) FILTER (company = 3) AS "3" FROM v GROUP BY 1, 2, 3""",
)
def job_18(t: Tables):
    est = P.clean_estimations(estimations(t), cutoff_weekday=2, min_weeks=5)
    return P.estimate_pivot(est, actual(t))


@query(
    "job_18_deltas",
    f"""WITH {EST}, s AS (SELECT days_to_cutoff AS d, lead(days_to_cutoff) OVER (ORDER BY days_to_cutoff) AS df FROM
      (SELECT DISTINCT days_to_cutoff FROM estimations))
    SELECT e.company, e.year, e.week, df || '-' || d AS step, e.quantity - p.quantity AS diff FROM estimations e
    JOIN s ON e.days_to_cutoff = d JOIN estimations p ON p.company = e.company AND p.year = e.year AND p.week = e.week
    AND p.days_to_cutoff = df""",
)
def job_18_deltas(t: Tables):
    return P.estimate_deltas(P.clean_estimations(estimations(t), cutoff_weekday=2, min_weeks=5))


_HOL = """yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
hol AS (SELECT make_date(y, m, d) AS day, n AS holiday FROM yrs, (VALUES (1, 1, 'new_year'), (5, 1, 'labour_day'),
    (5, 17, 'constitution_day'), (12, 25, 'christmas_day')) v(m, d, n)
  UNION ALL SELECT CAST(date_trunc('week', make_date(y, 4, 10 + y % 7)) AS DATE) + 6, 'easter' FROM yrs
  UNION ALL SELECT CAST(date_trunc('week', make_date(y, 4, 10 + y % 7)) AS DATE) + 7, 'easter_monday' FROM yrs),
span AS (SELECT date_trunc('year', min(o_orderdate)) AS lo, date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR AS hi FROM orders),
cal AS (SELECT CAST(unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
hd AS (SELECT day, holiday, isodow(day) - 1 AS dow,
  coalesce((SELECT min(h.day) FROM hol h WHERE h.day > cal.day), (SELECT max(day) FROM cal)) - day AS until,
  day - coalesce((SELECT max(h.day) FROM hol h WHERE h.day < cal.day), (SELECT min(day) FROM cal)) AS since,
  EXISTS (SELECT 1 FROM hol h WHERE abs(h.day - cal.day) = 1 AND isodow(h.day) < 6) AS beside
  FROM cal LEFT JOIN hol USING (day))"""


def _holidays(t: Tables):
    fixed = [(1, 1, "new_year"), (5, 1, "labour_day"), (5, 17, "constitution_day"), (12, 25, "christmas_day")]
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct()
    easter = F.date_add(monday_of(F.make_date("y", F.lit(4), 10 + F.col("y") % 7)), 6)
    days = [F.struct(F.make_date("y", F.lit(m), F.lit(d)).alias("day"), F.lit(n).alias("holiday")) for m, d, n in fixed]
    days += [F.struct(easter.alias("day"), F.lit("easter").alias("holiday"))]
    days += [F.struct(F.date_add(easter, 1).alias("day"), F.lit("easter_monday").alias("holiday"))]
    hol = years.select(F.explode(F.array(*days)).alias("h")).select("h.*")
    span = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    lo = F.trunc(F.to_date("lo"), "year")
    hi = F.date_sub(F.add_months(F.trunc(F.to_date("hi"), "year"), 12), 1)
    return P.holiday_days(span.select(F.explode(F.sequence(lo, hi)).alias("day")), hol)


@query(
    "job_19",
    f"""WITH {_HOL} SELECT day, holiday, CAST(until AS INTEGER) AS days_until_next_holiday, CAST(since AS INTEGER)
    AS days_since_last_holiday, dow IN (0, 4) AND holiday IS NULL AND beside AS is_squeeze_day,
    dow IN (0, 4) AND holiday IS NOT NULL AS is_long_weekend, dow = 0 AND holiday IS NOT NULL AS is_holiday_on_monday,
    dow = 3 AND holiday IS NOT NULL AS is_holiday_on_thursday, dow = 5 AND holiday IS NOT NULL AS is_holiday_on_saturday,
    dow = 6 AND holiday IS NOT NULL AS is_holiday_on_sunday FROM hd""",
)
def job_19(t: Tables):
    return _holidays(t)


@query(
    "job_19_weekly",
    f"""WITH {_HOL}, w AS (SELECT CAST(isoyear(day) AS INTEGER) AS year, CAST(weekofyear(day) AS INTEGER) AS week,
      count(holiday) AS n_holidays, max(CAST(dow IN (0, 4) AND holiday IS NOT NULL AS INTEGER)) AS lw,
      max(CAST(dow = 5 AND holiday IS NOT NULL AS INTEGER)) AS sat, max(CAST(dow = 6 AND holiday IS NOT NULL AS INTEGER)) AS sun,
      max(CASE WHEN holiday = 'easter' THEN 1 ELSE 0 END) AS easter,
      max(CASE WHEN holiday IN ('christmas_day', 'new_year') THEN 1 ELSE 0 END) AS ex,
      coalesce(string_agg(DISTINCT holiday, ',' ORDER BY holiday), '') AS holiday_list FROM hd GROUP BY 1, 2),
    e AS (SELECT year, min(week) AS ew FROM w WHERE easter = 1 GROUP BY 1)
    SELECT w.year, week, n_holidays, n_holidays - CASE WHEN lw = 0 AND ex = 0 THEN sat + sun ELSE 0 END AS n_holidays_effective,
    lw AS has_long_weekend, easter, holiday_list, week - ew AS weeks_since_easter, coalesce(abs(week - ew) <= 2, false)
    AS is_around_easter FROM w LEFT JOIN e ON w.year = e.year""",
)
def job_19_weekly(t: Tables):
    names = ["new_year", "labour_day", "constitution_day", "christmas_day", "easter", "easter_monday"]
    w = P.holiday_weeks(_holidays(t), names, "easter", ["christmas_day", "new_year"])
    return w.select(
        "year", "week", "n_holidays", "n_holidays_effective", "has_long_weekend", "easter", "holiday_list",
        "weeks_since_easter", "is_around_easter",
    )


_PRED = f"""{WEEKLY}, p AS (SELECT a.*, b.orders AS pred FROM weekly a JOIN weekly b ON a.company = b.company
  AND a.year = b.year + 1 AND a.week = b.week)"""


def _predictions(t: Tables):
    w = weekly_orders(t)
    pred = w.select("company", (F.col("year") + 1).alias("year"), "week", F.col("orders").alias("pred"))
    return w.join(pred, ["company", "year", "week"])


@query(
    "job_43",
    f"""WITH {_PRED} SELECT company, year, round(avg(pred - orders), 6) AS mean_error, round(avg(abs(pred - orders)), 6) AS mae,
    round(avg(abs((pred - orders) / nullif(orders, 0))) * 100, 6) AS mape, count(*) AS n FROM p GROUP BY 1, 2""",
)
def job_43(t: Tables):
    m = P.forecast_metrics(_predictions(t), ["company", "year"], "pred", "orders")
    return m.select("company", "year", *[F.round(c, 6).alias(c) for c in ("mean_error", "mae", "mape")], "n")


@query(
    "job_43_binned",
    f"""WITH {_PRED}, b AS (SELECT *, CASE WHEN orders > 0 AND orders <= 7 THEN '(0, 7]' WHEN orders > 7 AND orders <= 10
      THEN '(7, 10]' WHEN orders > 10 AND orders <= 1000 THEN '(10, 1000]' END AS bin FROM p)
    SELECT bin, round(avg(pred - orders), 6) AS mean_error, round(avg(abs(pred - orders)), 6) AS mae,
    round(avg(abs((pred - orders) / nullif(orders, 0))) * 100, 6) AS mape, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY 1""",
)
def job_43_binned(t: Tables):
    m = P.binned_forecast_metrics(_predictions(t), "pred", "orders", [0, 7, 10, 1000])
    return m.select("bin", *[F.round(c, 6).alias(c) for c in ("mean_error", "mae", "mape")], "n")


_SHARES = """q AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, p_brand, sum(l_quantity) AS qty FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


@query(
    "job_48",
    f"""WITH {_SHARES}, s AS (SELECT *, qty / sum(qty) OVER (PARTITION BY month) AS share, sum(qty) OVER (PARTITION BY month)
      AS total FROM q), e AS (SELECT month, p_brand, share, total, exp(ln(share) * 0.9) AS p FROM s)
    SELECT month, p_brand, round(share, 11) AS share, round(p / sum(p) OVER (PARTITION BY month) * total, 4) AS forecast FROM e""",
)
def job_48(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    q = lines.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month"), "p_brand").agg(F.sum("l_quantity").alias("qty"))
    s = P.share_targets(q, ["month"], "qty")
    predicted = s.select("month", "p_brand", F.col("share").alias("known"), (F.col("log_share") * 0.9).alias("predicted_log"))
    totals = q.groupBy("month").agg(F.sum("qty").alias("total"))
    f = P.share_forecast(predicted, totals, ["month"])
    return f.select("month", "p_brand", F.round("known", 11).alias("share"), F.round("quantity", 4).alias("forecast"))


_PUBLISH = f"""{WEEKLY}, e AS (SELECT company, year, week, orders + 5 AS x FROM weekly WHERE week % 10 = 0)"""


def _published(t: Tables):
    w = weekly_orders(t)
    external = w.where("week % 10 = 0").withColumn("orders", F.col("orders") + 5)
    splits = {"flex": F.lit(0.25), "non_flex": F.lit(0.75)}
    return P.publish_forecast(w, external, ["company", "year", "week"], "orders", splits, F.lit("run"))


@query(
    "job_49",
    f"""WITH {_PUBLISH}, j AS (SELECT w.*, x IS NOT NULL AS is_external, coalesce(x, orders) AS v FROM weekly w
      LEFT JOIN e USING (company, year, week))
    SELECT 'run' AS run_id, company, year, week, is_external, n AS variation, round(v * s)::DOUBLE AS orders FROM j,
    (VALUES ('flex', 0.25), ('non_flex', 0.75)) p(n, s)""",
)
def job_49(t: Tables):
    return _published(t)[0]


@query(
    "job_49_runs",
    f"""WITH {_PUBLISH} SELECT 'run' AS run_id, company, count(*) AS horizon, CAST(count(x) AS BIGINT) AS n_external
    FROM weekly LEFT JOIN e USING (company, year, week) GROUP BY company""",
)
def job_49_runs(t: Tables):
    return _published(t)[1]
