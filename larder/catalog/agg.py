"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.operators import aggregates as A


def lines_orders(t: Tables):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "agg_01",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
    round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n, min(l_quantity) AS min_qty,
    max(l_quantity) AS max_qty, round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY ALL""",
)
def agg_01(t: Tables):
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    return A.agg(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        sum_qty=F.sum("l_quantity"),
        sum_price=F.round(F.sum(price), 2),
        revenue=F.round(F.sum(price * (1 - disc)), 4),
        n=F.count("*"),
        min_qty=F.min("l_quantity"),
        max_qty=F.max("l_quantity"),
        avg_disc=F.round(F.avg(disc), 6),
    )


@query(
    "agg_02",
    """SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_distinct,
    count(DISTINCT CASE WHEN o_totalprice > 300000 THEN o_custkey END) AS big,
    count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS finished FROM orders GROUP BY o_orderpriority""",
)
def agg_02(t: Tables):
    conds = {"big": F.col("o_totalprice") > 300000, "finished": F.col("o_orderstatus") == "F"}
    return A.count_distinct_if(t.orders, ["o_orderpriority"], "o_custkey", conds)


@query(
    "agg_03",
    """SELECT o_custkey, round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS open,
    round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS finished FROM orders GROUP BY o_custkey""",
)
def agg_03(t: Tables):
    p = A.pivot_case(t.orders, ["o_custkey"], "o_orderstatus", {"open": "O", "finished": "F"}, F.col("o_totalprice"))
    return p.select("o_custkey", F.round("open", 2).alias("open"), F.round("finished", 2).alias("finished"))


@query(
    "agg_04",
    """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_value,
    arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_value FROM orders WHERE o_orderstatus <> 'P'
    GROUP BY o_custkey UNION ALL SELECT o_custkey, NULL, NULL FROM orders GROUP BY o_custkey
    HAVING bool_and(o_orderstatus = 'P')""",
)
def agg_04(t: Tables):
    by = F.when(F.col("o_orderstatus") != "P", F.struct("o_orderdate", "o_orderkey"))
    return A.arg_extremes(t.orders, ["o_custkey"], F.col("o_orderkey"), by)


@query("agg_05", "SELECT p_brand, max(CASE WHEN p_size > 25 THEN p_type END) AS big_type FROM part GROUP BY p_brand")
def agg_05(t: Tables):
    big = t.part.withColumn("big_type", F.when(F.col("p_size") > 25, F.col("p_type")))
    return A.any_value(big, ["p_brand"], "big_type")


@query(
    "agg_06",
    """SELECT l_orderkey, string_agg(l_partkey || ':' || CAST(l_quantity AS BIGINT), ','
    ORDER BY l_partkey, l_quantity) AS items FROM lineitem GROUP BY l_orderkey""",
)
def agg_06(t: Tables):
    out = A.collect_sorted(t.lineitem, ["l_orderkey"], ["l_partkey", "l_quantity"])
    text = F.transform("items", lambda s: F.concat(s["l_partkey"], F.lit(":"), s["l_quantity"].cast("long")))
    return out.select("l_orderkey", F.array_join(text, ",").alias("items"))


@query("agg_07", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_distinct FROM lineitem GROUP BY l_orderkey")
def agg_07(t: Tables):
    return A.set_size(t.lineitem, ["l_orderkey"], "l_suppkey")


@query(
    "agg_08",
    """SELECT l_orderkey, md5(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey)) AS combination_id
    FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY l_orderkey""",
)
def agg_08(t: Tables):
    return A.combination_id(t.lineitem, ["l_orderkey"], "l_partkey").drop("members")


@query(
    "agg_09",
    """SELECT l_orderkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS joined FROM lineitem
    JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
)
def agg_09(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return A.string_agg(lines, ["l_orderkey"], "p_brand")


@query(
    "agg_10",
    """SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey
    HAVING max(o_orderdate) < (SELECT max(o_orderdate) FROM orders)""",
)
def agg_10(t: Tables):
    return A.having_below_global_max(t.orders, ["o_custkey"], "o_orderdate")


@query(
    "agg_11",
    """SELECT l_orderkey, bool_or(l_discount > 0.08) AS has_any, CAST(sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END)
    AS BIGINT) AS n_true FROM lineitem GROUP BY l_orderkey""",
)
def agg_11(t: Tables):
    return A.bool_any(t.lineitem, ["l_orderkey"], F.col("l_discount") > 0.08)


@query(
    "agg_12",
    """SELECT l_partkey, round(sum(l_extendedprice * CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END)
    / nullif(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END), 0), 6) AS avg_price FROM lineitem
    GROUP BY l_partkey""",
)
def agg_12(t: Tables):
    weight = F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity"))
    return A.agg(t.lineitem, ["l_partkey"], avg_price=F.round(A.weighted_avg(F.col("l_extendedprice"), weight), 6))


@query(
    "agg_13",
    """SELECT l_partkey, round(ceil(sum(CAST(l_quantity AS DECIMAL(12, 2)) * 0.25)) * max(l_tax), 4) AS whole_cost,
    round(CAST(sum(CAST(l_quantity AS DECIMAL(12, 2)) * 0.25) AS DOUBLE) * max(l_tax), 4) AS part_cost FROM lineitem
    GROUP BY l_partkey""",
)
def agg_13(t: Tables):
    q = F.col("l_quantity").cast("decimal(12,2)") * F.lit(0.25).cast("decimal(3,2)")
    return A.agg(
        t.lineitem,
        ["l_partkey"],
        whole_cost=F.round(A.whole_unit_total(q, F.col("l_tax")), 4),
        part_cost=F.round(F.sum(q) * F.max("l_tax"), 4),
    )


@query(
    "agg_14",
    """SELECT year(o_orderdate) AS y, max(o_totalprice) FILTER (o_orderstatus = 'F') AS F,
    max(o_totalprice) FILTER (o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (o_orderstatus = 'P') AS P
    FROM orders GROUP BY 1""",
)
def agg_14(t: Tables):
    o = t.orders.withColumn("y", F.year("o_orderdate"))
    return A.pivot_attributes(o, ["y"], "o_orderstatus", F.max("o_totalprice"))


_NATION = """n AS (SELECT n_regionkey, n_nationkey, sum(o_totalprice) AS revenue FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def _nation_revenue(t: Tables):
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("x"))
    j = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return j.groupBy("n_regionkey", "n_nationkey").agg(F.sum("x").alias("revenue"))


@query(
    "agg_15",
    f"""WITH {_NATION} SELECT n_regionkey, n_nationkey, round(revenue, 2) AS revenue,
    round(revenue / sum(revenue) OVER (PARTITION BY n_regionkey), 8) AS share FROM n""",
)
def agg_15(t: Tables):
    s = A.share_of_total(_nation_revenue(t), ["n_regionkey"], "revenue")
    return s.select("n_regionkey", "n_nationkey", F.round("revenue", 2).alias("revenue"), F.round("share", 8).alias("share"))


@query(
    "agg_16",
    """WITH q AS (SELECT p_brand, p_type, sum(l_quantity) AS v FROM lineitem JOIN part ON l_partkey = p_partkey
      GROUP BY 1, 2),
    s AS (SELECT *, CASE p_type WHEN 'PROMO' THEN 0.2 WHEN 'SMALL' THEN 0.1 ELSE 0.7 END AS target,
      CASE WHEN p_type IN ('PROMO', 'SMALL') THEN p_type ELSE '' END AS slot FROM q)
    SELECT p_brand, p_type, round(v / sum(v) OVER (PARTITION BY p_brand, slot) * target, 8) AS v FROM s""",
)
def agg_16(t: Tables):
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("q"))
    q = per_part.join(t.part, "p_partkey").groupBy("p_brand", "p_type").agg(F.sum("q").alias("v"))
    out = A.normalise_with_targets(q, ["p_brand"], "p_type", "v", {"PROMO": 0.2, "SMALL": 0.1})
    return out.select("p_brand", "p_type", F.round("v", 8).alias("v"))


@query(
    "agg_17",
    """WITH r AS (SELECT CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS delay, CASE WHEN l_discount > 0
      THEN l_tax / l_discount ELSE 0 END AS ratio FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT CAST(floor(delay / 30) AS BIGINT) AS bucket, round(median(ratio), 8) AS rate FROM r GROUP BY 1""",
)
def agg_17(t: Tables):
    j = lines_orders(t).withColumn("bucket", F.floor(F.datediff("l_shipdate", "o_orderdate") / 30))
    m = A.median_ratio(j, ["bucket"], "l_tax", "l_discount")
    return m.select("bucket", F.round("rate", 8).alias("rate"))


@query(
    "agg_17_grid",
    """WITH r AS (SELECT CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS d, weekofyear(l_shipdate) AS w,
      CASE WHEN l_discount > 0 THEN l_tax / l_discount ELSE 0 END AS ratio FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey),
    s AS (SELECT CAST(floor(d / 10) AS BIGINT) AS day, CAST(w AS INTEGER) AS week, median(ratio) AS rate FROM r
      WHERE w + floor(d / 10) <> 60 GROUP BY 1, 2),
    g AS (SELECT day, week FROM (SELECT range AS day FROM range((SELECT min(day) FROM s), (SELECT max(day) + 1 FROM s))),
      (SELECT DISTINCT week FROM s))
    SELECT day, week, round(last_value(rate IGNORE NULLS) OVER (ORDER BY week, day ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW), 8) AS rate FROM g LEFT JOIN s USING (day, week)""",
)
def agg_17_grid(t: Tables):
    j = lines_orders(t).select(
        F.floor(F.datediff("l_shipdate", "o_orderdate") / 10).alias("day"),
        F.weekofyear("l_shipdate").alias("week"),
        "l_tax",
        "l_discount",
    )
    m = A.median_ratio_grid(j.where("week + day <> 60"), "day", "week", "l_tax", "l_discount")
    return m.select("day", "week", F.round("rate", 8).alias("rate"))


@query(
    "agg_18",
    """SELECT event_type, round(avg(value), 6) AS mean, round(median(value), 6) AS median,
    round(stddev_samp(value), 6) AS std, count(value) AS count FROM events GROUP BY event_type""",
)
def agg_18(t: Tables):
    s = A.summary(t.events, ["event_type"], "value")
    return s.select("event_type", *[F.round(c, 6).alias(c) for c in ("mean", "median", "std")], "count")


@query(
    "agg_19",
    """SELECT l_returnflag, count(*) AS total, count(*) FILTER (l_discount > 0.07) AS broken,
    round(count(*) FILTER (l_discount > 0.07) / count(*) * 100, 2) AS percentage,
    bool_or(l_discount > 0.07) AS any_broken FROM lineitem GROUP BY l_returnflag""",
)
def agg_19(t: Tables):
    return A.threshold_metrics(t.lineitem, ["l_returnflag"], "l_discount", 0.07)


@query(
    "agg_19_ids",
    "SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_discount > 0.07",
)
def agg_19_ids(t: Tables):
    return A.offenders(t.lineitem, ["l_returnflag"], "l_orderkey", F.col("l_discount") > 0.07)


@query(
    "agg_20",
    """SELECT l_orderkey, max(n) AS max_repetition, round(avg(n) / sum(n), 8) AS repeated_share FROM
    (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_orderkey""",
)
def agg_20(t: Tables):
    r = A.repetition(t.lineitem, ["l_orderkey"], "l_suppkey")
    return r.select("l_orderkey", "max_repetition", F.round("repeated_share", 8).alias("repeated_share"))


@query(
    "agg_21",
    """SELECT l_orderkey, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END), 8) AS share,
    max(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE AS any_returned FROM lineitem GROUP BY l_orderkey""",
)
def agg_21(t: Tables):
    cond = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag") == "R")
    return A.agg(
        t.lineitem, ["l_orderkey"], share=F.round(A.mean_of_bool(cond), 8), any_returned=A.contains_any(cond)
    )


@query(
    "agg_22",
    """WITH l AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),
    r AS (SELECT l_orderkey, avg(n) / sum(n) AS repeated_brand FROM (SELECT l_orderkey, p_brand, count(*) AS n FROM l
      GROUP BY 1, 2) GROUP BY 1)
    SELECT l_orderkey, round(avg(p_size), 6) AS mean_size, round(avg(l_quantity), 6) AS mean_quantity,
    round(avg(l_discount), 6) AS mean_discount,
    round(avg(CASE WHEN p_type = 'PROMO' THEN 1.0 ELSE 0 END), 6) AS promo_share,
    round(avg(CASE WHEN p_name LIKE '%ring%' THEN 1.0 ELSE 0 END), 6) AS ring_share,
    max(CASE WHEN p_type = 'SMALL' THEN 1.0 ELSE 0.0 END)::DOUBLE AS has_small,
    round(max(repeated_brand), 6) AS repeated_brand FROM l JOIN r USING (l_orderkey) GROUP BY l_orderkey""",
)
def agg_22(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    out = A.basket_features(
        lines,
        "l_orderkey",
        {"mean_size": F.col("p_size"), "mean_quantity": F.col("l_quantity"), "mean_discount": F.col("l_discount")},
        {"promo_share": F.col("p_type") == "PROMO", "ring_share": F.col("p_name").contains("ring")},
        {"has_small": F.col("p_type") == "SMALL"},
        {"repeated_brand": "p_brand"},
    )
    return out.select("l_orderkey", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(
    "agg_23",
    """WITH b AS (SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN '(0, 10]' WHEN l_quantity > 10
      AND l_quantity <= 25 THEN '(10, 25]' WHEN l_quantity > 25 AND l_quantity <= 50 THEN '(25, 50]' END AS bin,
      l_extendedprice AS x FROM lineitem)
    SELECT bin, round(avg(x), 4) AS mean, round(median(x), 4) AS median, round(stddev_samp(x), 4) AS std,
    count(x) AS count FROM b WHERE bin IS NOT NULL GROUP BY bin""",
)
def agg_23(t: Tables):
    m = A.binned_metrics(t.lineitem, F.col("l_quantity"), [0, 10, 25, 50], "l_extendedprice")
    return m.select("bin", *[F.round(c, 4).alias(c) for c in ("mean", "median", "std")], "count")


@query(
    "agg_24",
    """SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus,
    arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice FROM orders GROUP BY o_custkey""",
)
def agg_24(t: Tables):
    return A.latest_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(
    "agg_25",
    """WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, '{"y":' || year(o_orderdate) || ',"values":[' ||
      string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) || ']}' AS j FROM orders GROUP BY 1, 2)
    SELECT o_custkey, '[' || string_agg(j, ',' ORDER BY y) || ']' AS json FROM y GROUP BY o_custkey""",
)
def agg_25(t: Tables):
    o = t.orders.withColumn("y", F.year("o_orderdate"))
    return A.nested_json(o, ["o_custkey"], ["y"], "o_orderkey", "o_orderdate")


@query(
    "agg_26",
    """WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, o_totalprice,
      CASE WHEN o_orderstatus = 'P' THEN 0 ELSE l_extendedprice END AS w FROM lineitem JOIN orders
      ON l_orderkey = o_orderkey)
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(o_totalprice * CASE WHEN sum(w) OVER p = 0
    THEN 1.0 / count(*) OVER p ELSE w / sum(w) OVER p END, 6) AS allocated FROM l WINDOW p AS (PARTITION BY l_orderkey)""",
)
def agg_26(t: Tables):
    weight = F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(F.col("l_extendedprice"))
    out = A.allocate(lines_orders(t), ["l_orderkey"], "o_totalprice", weight)
    return out.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.round("allocated", 6).alias("allocated")
    )


@query(
    "agg_27",
    """WITH r AS (SELECT user_id, min(value) AS min_score, max(value) AS max_score FROM events GROUP BY user_id)
    SELECT *, row_number() OVER (ORDER BY max_score, min_score, user_id) AS position FROM r""",
)
def agg_27(t: Tables):
    return A.minmax_rank(t.events, "user_id", "value")
