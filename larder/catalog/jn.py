"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.catalog.scd import ISLANDS, islands
from larder.functions.dates import iso_year, monday_of
from larder.operators import joins as J
from larder.operators.chunked import row_numbers


@query(
    "jn_01",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def jn_01(t: Tables):
    j = J.left_join(t.orders, t.customer, [("o_custkey", "c_custkey")])
    j = J.left_join(j, t.nation, [("c_nationkey", "n_nationkey")])
    j = J.left_join(j, t.region, [("n_regionkey", "r_regionkey")])
    return j.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "jn_02",
    """SELECT o_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM orders JOIN lineitem
    ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY o_orderkey""",
)
def jn_02(t: Tables):
    # Lines are aggregated on the join key first, so the join moves one row per order.
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("qty")
    )
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey").join(lines, "o_orderkey")


@query(
    "jn_03",
    """WITH a AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS ordered FROM lineitem WHERE l_returnflag <> 'N'
      GROUP BY 1, 2),
    b AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS planned FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
    SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_partkey, b.l_partkey) AS l_partkey,
    ordered, planned FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey""",
)
def jn_03(t: Tables):
    key = ["l_orderkey", "l_partkey"]
    a = t.lineitem.where("l_returnflag <> 'N'").groupBy(*key).agg(F.sum("l_quantity").alias("ordered"))
    b = t.lineitem.where("l_linestatus = 'O'").groupBy(*key).agg(F.sum("l_quantity").alias("planned"))
    return J.full_join_coalesce(a, b, key)


@query(
    "jn_04",
    """SELECT n_nationkey, r_regionkey, r_name, total FROM nation, region,
    (SELECT count(*) AS total FROM customer)""",
)
def jn_04(t: Tables):
    pairs = J.cross_small(t.nation.select("n_nationkey"), t.region, max_rows=100)
    total = t.customer.agg(F.count("*")).scalar()
    return pairs.withColumn("total", total)


@query(
    "jn_05",
    """SELECT c_custkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) o
    ON c_custkey = o_custkey WHERE o_custkey IS NULL""",
)
def jn_05(t: Tables):
    return J.anti_join(t.customer, t.orders.where("o_totalprice > 300000"), ("c_custkey", "o_custkey")).select(
        "c_custkey"
    )


@query(
    "jn_06",
    """WITH p AS (SELECT user_id, min(ts) AS first_ts, 'purchase' AS src FROM events WHERE event_type = 'purchase'
      AND value > 120 GROUP BY user_id),
    f AS (SELECT user_id, min(ts) AS first_ts, 'view' AS src FROM events WHERE event_type = 'view' GROUP BY user_id)
    SELECT * FROM p UNION ALL SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = f.user_id)""",
)
def jn_06(t: Tables):
    firsts = lambda cond, src: t.events.where(cond).groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.lit(src).alias("src")
    )
    return J.union_missing(
        firsts("event_type = 'purchase' and value > 120", "purchase"), firsts("event_type = 'view'", "view"), "user_id"
    )


@query("jn_07", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def jn_07(t: Tables):
    return J.semi_join(t.customer, t.orders.where("o_orderstatus = 'P'"), ("c_custkey", "o_custkey")).select(
        "c_custkey", "c_name"
    )


def _facts(t: Tables):
    return t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")


@query(
    "jn_08",
    f"""WITH {ISLANDS}, e AS (SELECT event_id, user_id, ts + INTERVAL 7 HOURS AS ts FROM events WHERE event_type = 'purchase')
    SELECT e.event_id, i.state FROM e LEFT JOIN islands i
    ON e.user_id = i.user_id AND e.ts >= i.valid_from AND e.ts < i.valid_to""",
)
def jn_08(t: Tables):
    later = _facts(t).withColumn("ts", F.expr("ts + interval 7 hours"))  # the state may have changed since the purchase
    return J.as_of_validity(later, islands(t), ["user_id"], "ts").select("event_id", "state")


@query(
    "jn_09",
    f"""WITH {ISLANDS} SELECT e.event_id, i.state FROM events e LEFT JOIN islands i
    ON e.user_id = i.user_id AND e.ts >= i.valid_from AND e.ts <= i.valid_to WHERE e.event_type = 'purchase'""",
)
def jn_09(t: Tables):
    return J.as_of_validity(_facts(t), islands(t), ["user_id"], "ts", closed="both").select(
        "event_id", "state"
    )


_BANDS = """bands AS (SELECT r.l_returnflag, b.i AS level, b.i * 10000.0 AS min_value, (b.i + 1) * 10000.0 AS max_value,
  v.f AS valid_from, v.u AS valid_to FROM (SELECT DISTINCT l_returnflag FROM lineitem) r, range(0, 12) b(i),
  (VALUES (TIMESTAMP '1990-01-01', TIMESTAMP '1998-01-01'), (TIMESTAMP '1998-01-01', TIMESTAMP '2010-01-01')) v(f, u))"""


def _bands(t: Tables):
    flags = t.lineitem.select("l_returnflag").distinct()
    versions = F.array(
        *[
            F.struct(F.expr(f"timestamp_ntz'{a} 00:00:00'").alias("valid_from"), F.expr(f"timestamp_ntz'{b} 00:00:00'").alias("valid_to"))
            for a, b in (("1990-01-01", "1998-01-01"), ("1998-01-01", "2010-01-01"))
        ]
    )
    leveled = flags.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(11)))).withColumn("v", F.explode(versions))
    return leveled.select(
        "l_returnflag",
        "level",
        (F.col("level") * 10000.0).alias("min_value"),
        ((F.col("level") + 1) * 10000.0).alias("max_value"),
        "v.*",
    )


@query(
    "jn_10",
    f"""WITH {_BANDS} SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(level AS INTEGER) AS level,
    b.valid_from FROM lineitem l LEFT JOIN bands b ON l.l_returnflag = b.l_returnflag
    AND l_extendedprice >= min_value AND l_extendedprice < max_value
    AND l_shipdate >= valid_from AND l_shipdate < valid_to""",
)
def jn_10(t: Tables):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice", "l_shipdate"
    )
    return J.band_join(lines, _bands(t), ["l_returnflag"], "l_extendedprice", "l_shipdate", 10000.0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "level", "valid_from"
    )


@query(
    "jn_11",
    """WITH p AS (SELECT l_partkey, l_shipdate AS d, max(l_extendedprice / l_quantity) AS price FROM lineitem
      GROUP BY 1, 2),
    o AS (SELECT DISTINCT l_partkey, CAST(o_orderdate AS DATE) AS order_date FROM lineitem JOIN orders
      ON l_orderkey = o_orderkey)
    SELECT o.l_partkey, order_date, round(price, 9) AS price FROM o ASOF LEFT JOIN p
    ON o.l_partkey = p.l_partkey AND o.order_date >= p.d""",
)
def jn_11(t: Tables):
    prices = t.lineitem.groupBy("l_partkey", F.to_date("l_shipdate").alias("d")).agg(
        F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )
    wanted = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_partkey", F.to_date("o_orderdate").alias("order_date"))
        .distinct()
    )
    hit = J.as_of(wanted, prices, ["l_partkey"], "order_date", "d", "m")
    return hit.select("l_partkey", "order_date", F.round("m.price", 9).alias("price"))


@query(
    "jn_12",
    """WITH f AS (SELECT user_id, ts AS fts, value FROM events WHERE event_type = 'view'),
    e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
    SELECT event_id, CASE WHEN fts >= ts - INTERVAL 2 DAY THEN value END AS value,
    CASE WHEN fts >= ts - INTERVAL 2 DAY THEN fts END AS fts
    FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.fts""",
)
def jn_12(t: Tables):
    feats = t.events.where("event_type = 'view'").select("user_id", F.col("ts").alias("fts"), "value")
    return J.point_in_time(_facts(t), feats, ["user_id"], "ts", "fts", "2 days").select(
        "event_id", "value", "fts"
    )


@query(
    "jn_13",
    """WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n, sum(o_totalprice) AS total
      FROM orders GROUP BY 1, 2)
    SELECT a.o_custkey, a.day, coalesce(sum(b.n), 0) AS prior_orders, round(coalesce(sum(b.total), 0), 2) AS prior_total
    FROM d a LEFT JOIN d b ON a.o_custkey = b.o_custkey AND b.day < a.day AND b.day >= a.day - 42
    AND date_trunc('week', a.day) <> date_trunc('week', b.day) GROUP BY a.o_custkey, a.day""",
)
def jn_13(t: Tables):
    daily = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total")
    )
    pairs = J.trailing_days(daily.select("o_custkey", "day"), daily, "o_custkey", "day", 42)
    return pairs.groupBy("o_custkey", "day").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("prior_orders"),
        F.round(F.coalesce(F.sum("total"), F.lit(0.0)), 2).alias("prior_total"),
    )


@query(
    "jn_14",
    """WITH w AS (SELECT o_custkey, CAST((CAST(date_trunc('week', o_orderdate) AS DATE) - DATE '1995-01-02') // 7 AS BIGINT)
      AS seq, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT a.o_custkey, a.seq, sum(b.n) AS orders_in_8 FROM w a JOIN w b ON a.o_custkey = b.o_custkey
    AND b.seq BETWEEN a.seq - 7 AND a.seq GROUP BY a.o_custkey, a.seq""",
)
def jn_14(t: Tables):
    seq = F.floor(F.datediff(monday_of("o_orderdate"), F.lit("1995-01-02").cast("date")) / 7)
    weekly = t.orders.groupBy("o_custkey", seq.alias("seq")).agg(F.count("*").alias("n"))
    pairs = J.trailing_periods(weekly.select("o_custkey", "seq"), weekly, ["o_custkey"], "seq", 8)
    return pairs.groupBy("o_custkey", "seq").agg(F.sum("n").alias("orders_in_8"))


@query(
    "jn_15",
    f"""WITH {ISLANDS} SELECT a.user_id, a.valid_from, a.state, b.state AS previous_state FROM islands a
    LEFT JOIN islands b ON a.user_id = b.user_id AND a.valid_from = b.valid_to""",
)
def jn_15(t: Tables):
    return J.previous_version(islands(t), ["user_id"], ["state"]).select(
        "user_id", "valid_from", "state", "previous_state"
    )


@query(
    "jn_16",
    """WITH q AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
    SELECT a.o_custkey, a.n, a.day, b.day AS next_day FROM q a LEFT JOIN q b
    ON a.o_custkey = b.o_custkey AND b.n = a.n + 1""",
)
def jn_16(t: Tables):
    numbered = row_numbers(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n").select(
        "o_custkey", "n", F.to_date("o_orderdate").alias("day")
    )
    return J.next_row(numbered, ["o_custkey"], "n", ["day"])


@query(
    "jn_17",
    f"""WITH {_BANDS}, odd AS (SELECT l_returnflag, level, min_value,
      CASE WHEN level % 4 = 1 THEN max_value - 1 ELSE max_value END AS max_value, valid_from, valid_to FROM bands)
    SELECT c.l_returnflag, CAST(c.level AS INTEGER) AS level, c.valid_from, c.min_value, p.max_value AS max_value_below
    FROM odd c JOIN odd p ON c.l_returnflag = p.l_returnflag AND c.level = p.level + 1
    AND c.valid_from < p.valid_to AND p.valid_from < c.valid_to WHERE c.min_value <> p.max_value""",
)
def jn_17(t: Tables):
    odd = _bands(t).withColumn(
        "max_value", F.when(F.col("level") % 4 == 1, F.col("max_value") - 1).otherwise(F.col("max_value"))
    )
    return J.level_mismatch(odd, ["l_returnflag"], "level").select(
        "l_returnflag", "level", "valid_from", "min_value", "max_value_below"
    )


@query(
    "jn_18",
    """WITH l AS (SELECT l_orderkey, coalesce(CASE WHEN l_partkey % 3 > 0 THEN l_partkey END, -l_suppkey) AS k,
      sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
    SELECT CAST(k AS BIGINT) AS k, count(*) AS n, sum(qty) AS qty, max(p_name) AS p_name FROM l
    LEFT JOIN part ON k = p_partkey GROUP BY k""",
)
def jn_18(t: Tables):
    key = J.match_key(F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey")), -F.col("l_suppkey"))
    lines = t.lineitem.groupBy("l_orderkey", key.alias("k")).agg(F.sum("l_quantity").alias("qty"))
    items = lines.groupBy("k").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))
    return items.join(t.part.select(F.col("p_partkey").alias("k"), "p_name"), "k", "left")


def weekly_orders(t: Tables):
    """Orders per region and ISO week."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return o.groupBy(
        F.col("n_regionkey").alias("company"),
        iso_year("o_orderdate").cast("int").alias("year"),
        F.weekofyear("o_orderdate").alias("week"),
    ).agg(F.count("*").alias("orders"))


WEEKLY = """weekly AS (SELECT n_regionkey AS company, CAST(isoyear(o_orderdate) AS INTEGER) AS year,
  CAST(weekofyear(o_orderdate) AS INTEGER) AS week, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)"""


@query(
    "jn_19",
    f"""WITH {WEEKLY}, j AS (SELECT a.*, b.orders AS v FROM weekly a LEFT JOIN weekly b
      ON a.company = b.company AND a.year = b.year + 1 AND a.week = b.week)
    SELECT company, year, week, orders, coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW), first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    AS orders_prev_year_1 FROM j WINDOW w AS (PARTITION BY company ORDER BY year, week)""",
)
def jn_19(t: Tables):
    return J.prev_year_join(weekly_orders(t), ["company"], "orders", 1)


_JN20_WEEKS = """weekly AS (SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS year,
  CAST(weekofyear(o_orderdate) AS INTEGER) AS week, count(*) AS orders FROM orders GROUP BY 1, 2),
weeks AS (SELECT *, CASE WHEN abs(week - (14 + year % 3)) <= 2 THEN week - (14 + year % 3) END AS weeks_since_easter,
  CAST(week = 20 + year % 2 AS INTEGER) AS may_day, CAST(week = 52 AS INTEGER) AS xmas,
  CASE WHEN week = 14 + year % 3 THEN 2 WHEN week IN (20 + year % 2, 52) THEN 1 ELSE 0 END AS nh FROM weekly)"""


def _jn20_weeks(t: Tables):
    w = t.orders.groupBy(
        iso_year("o_orderdate").cast("int").alias("year"), F.weekofyear("o_orderdate").alias("week")
    ).agg(F.count("*").alias("orders"))
    easter = F.lit(14) + F.col("year") % 3
    may = F.lit(20) + F.col("year") % 2
    hol = F.when(F.col("week") == easter, 2).when((F.col("week") == may) | (F.col("week") == 52), 1).otherwise(0)
    return w.withColumns(
        {
            "weeks_since_easter": F.when(F.abs(F.col("week") - easter) <= 2, F.col("week") - easter),
            "may_day": (F.col("week") == may).cast("int"),
            "xmas": (F.col("week") == 52).cast("int"),
            "n_holidays": hol,
            "n_holidays_effective": hol,
        }
    )


@query(
    "jn_20",
    f"""WITH {_JN20_WEEKS},
    m AS (SELECT c.*, c.year - 2 AS my, coalesce(e.week, CASE WHEN c.may_day = 1 THEN h.week END,
        CASE WHEN c.xmas = 1 THEN x.week END, c.week) AS mw,
      coalesce(e.orders, CASE WHEN c.may_day = 1 THEN h.orders END, CASE WHEN c.xmas = 1 THEN x.orders END, s.orders) AS mo
      FROM weeks c LEFT JOIN weeks e ON e.year = c.year - 2 AND e.weeks_since_easter = c.weeks_since_easter
      LEFT JOIN weeks h ON h.year = c.year - 2 AND h.may_day = 1 LEFT JOIN weeks x ON x.year = c.year - 2 AND x.xmas = 1
      LEFT JOIN weeks s ON s.year = c.year - 2 AND s.week = c.week
      WHERE c.year >= (SELECT min(year) + 2 FROM weeks)),
    a AS (SELECT m.*, m.nh IS DISTINCT FROM p.nh AS att FROM m LEFT JOIN weeks p ON p.year = my AND p.week = mw),
    n AS (SELECT a.*, l.orders AS lo, l.nh AS lnh,
      lag(a.nh, 1) OVER w AS n1, lag(my, 1) OVER w AS y1, lag(mw, 1) OVER w AS w1, lag(mo, 1) OVER w AS o1,
      lead(a.nh, 1) OVER w AS n2, lead(my, 1) OVER w AS y2, lead(mw, 1) OVER w AS w2, lead(mo, 1) OVER w AS o2,
      lag(a.nh, 2) OVER w AS n3, lag(my, 2) OVER w AS y3, lag(mw, 2) OVER w AS w3, lag(mo, 2) OVER w AS o3,
      lead(a.nh, 2) OVER w AS n4, lead(my, 2) OVER w AS y4, lead(mw, 2) OVER w AS w4, lead(mo, 2) OVER w AS o4
      FROM a LEFT JOIN weeks l ON l.year = a.year - 1 AND l.week = a.week WINDOW w AS (ORDER BY a.year, a.week)),
    k AS (SELECT *, CASE WHEN NOT (att AND nh = 0) THEN 0 WHEN lnh = 0 THEN 9 WHEN n1 = 0 THEN 1 WHEN n2 = 0 THEN 2
      WHEN n3 = 0 THEN 3 WHEN n4 = 0 THEN 4 ELSE 0 END AS pick FROM n)
    SELECT year, week, orders, att AS needs_attention,
    CASE pick WHEN 9 THEN year - 1 WHEN 1 THEN y1 WHEN 2 THEN y2 WHEN 3 THEN y3 WHEN 4 THEN y4 ELSE my END AS mapped_year,
    CASE pick WHEN 9 THEN week WHEN 1 THEN w1 WHEN 2 THEN w2 WHEN 3 THEN w3 WHEN 4 THEN w4 ELSE mw END AS mapped_week,
    CASE pick WHEN 9 THEN lo WHEN 1 THEN o1 WHEN 2 THEN o2 WHEN 3 THEN o3 WHEN 4 THEN o4 ELSE mo END AS mapped_orders
    FROM k""",
)
def jn_20(t: Tables):
    return J.map_comparable_weeks(_jn20_weeks(t), 2, ["may_day", "xmas"]).select(
        "year", "week", "orders", "needs_attention", "mapped_year", "mapped_week", "mapped_orders"
    )
