"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.functions import dates, text
from larder.functions.arrays import flatten_struct, parse_json
from larder.functions.keys import surrogate_key
from larder.operators import projections as P


@query(
    "prj_01",
    """SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
    upper(trim(o_orderstatus)) AS status, CAST(o_orderdate AS DATE) AS order_date,
    array_to_string(list_transform(string_split(substr(o_orderpriority, 3), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
      AS priority, CAST(round(o_totalprice) AS BIGINT) AS price FROM orders""",
)
def prj_01(t: Tables):
    return P.stage(
        t.orders,
        {
            "order_id": "cast(o_orderkey as bigint)",
            "customer_id": "cast(o_custkey as bigint)",
            "status": "upper(trim(o_orderstatus))",
            "order_date": "cast(o_orderdate as date)",
            "priority": "initcap(substring(o_orderpriority, 3))",
            "price": "cast(round(o_totalprice) as bigint)",
        },
    )


@query("prj_02", "SELECT * EXCLUDE (l_tax, l_shipdate, l_returnflag) FROM lineitem")
def prj_02(t: Tables):
    return P.select_except(t.lineitem, "l_tax", "l_shipdate", "l_returnflag")


@query(
    "prj_03",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'returned'
    WHEN p_size > 40 THEN 'bulk' WHEN l_discount >= 0.05 THEN 'discounted' WHEN l_linestatus = 'O' THEN 'open'
    ELSE 'standard' END AS line_type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def prj_03(t: Tables):
    rules = [
        (F.col("l_returnflag") == "R", "returned"),
        (F.col("p_size") > 40, "bulk"),
        (F.col("l_discount") >= 0.05, "discounted"),
        (F.col("l_linestatus") == "O", "open"),
    ]
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", P.classify(rules, "standard").alias("line_type"))


@query(
    "prj_04",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount >= 0.08 THEN 'Very High'
    WHEN l_discount >= 0.06 THEN 'High' WHEN l_discount >= 0.04 THEN 'Medium' WHEN l_discount >= 0.02 THEN 'Low'
    ELSE 'Very Low' END AS band, CASE WHEN l_discount >= 0.08 THEN 0 WHEN l_discount >= 0.06 THEN 1
    WHEN l_discount >= 0.04 THEN 2 WHEN l_discount >= 0.02 THEN 3 ELSE 4 END AS band_order FROM lineitem""",
)
def prj_04(t: Tables):
    label, order = P.band(
        F.col("l_discount"), [0.08, 0.06, 0.04, 0.02], ["Very High", "High", "Medium", "Low", "Very Low"]
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", label.alias("band"), order.alias("band_order")
    )


@query("prj_05", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')")
def prj_05(t: Tables):
    return P.filter_in(t.orders, "o_orderstatus", ["O", "P"]).select("o_orderkey", "o_orderstatus")


@query(
    "prj_06",
    """SELECT o_orderkey, md5(o_orderkey || '-' || o_orderstatus) AS pk_order,
    coalesce(md5(c_custkey || '-' || c_mktsegment), '0') AS fk_customer,
    md5(concat_ws('-', o_orderkey, c_mktsegment)) AS pk_loose FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) ON o_custkey = c_custkey""",
)
def prj_06(t: Tables):
    joined = t.orders.join(t.customer.where("c_nationkey < 20"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        "o_orderkey",
        surrogate_key("o_orderkey", "o_orderstatus").alias("pk_order"),
        surrogate_key("c_custkey", "c_mktsegment").alias("fk_customer"),
        surrogate_key("o_orderkey", "c_mktsegment", skip_nulls=True).alias("pk_loose"),
    )


@query(
    "prj_07",
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS fk_date, strftime(ts, '%H%M') AS fk_time
    FROM events""",
)
def prj_07(t: Tables):
    return t.events.select("event_id", dates.date_key("ts").alias("fk_date"), dates.time_key("ts").alias("fk_time"))


@query("prj_08", "SELECT * FROM nation UNION ALL SELECT -1, 'Not available', NULL")
def prj_08(t: Tables):
    return P.add_unknown_row(t.nation, {"n_nationkey": -1, "n_name": "Not available"})


@query(
    "prj_09",
    """SELECT l_orderkey AS order_id, l_quantity AS quantity, l_partkey AS item, CAST(NULL AS DOUBLE) AS price
    FROM lineitem UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice FROM orders""",
)
def prj_09(t: Tables):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").alias("quantity"), F.col("l_partkey").alias("item")
    )
    heads = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))
    return P.null_columns(lines, {"price": "double"}).unionByName(heads, allowMissingColumns=True)


@query(
    "prj_10",
    """SELECT event_id, CASE WHEN strftime(ts, '%H:%M:%S') = '00:00:00' OR ts >= TIMESTAMP '2024-01-15' THEN ts
    ELSE ts - INTERVAL 1 HOUR END AS ts_utc,
    CASE WHEN event_type = 'error' THEN ts ELSE ts - INTERVAL 1 HOUR END AS ts_by_writer FROM events""",
)
def prj_10(t: Tables):
    return t.events.select(
        "event_id",
        dates.repair_timezone("ts", "Europe/Oslo", "2024-01-15 00:00:00").alias("ts_utc"),
        dates.repair_timezone(
            "ts", "Europe/Oslo", None, keep_midnight=False, already_utc=F.col("event_type") == "error"
        ).alias("ts_by_writer"),
    )


@query(
    "prj_11",
    """SELECT event_id, coalesce(CASE WHEN event_type <> 'error' AND value > 20 THEN 'E-' || event_id END,
    CASE event_type WHEN 'click' THEN 'R-CLICK' WHEN 'view' THEN 'R-VIEW' WHEN 'error' THEN 'R-ERROR'
    ELSE 'R-OTHER' END) AS reason_id FROM events""",
)
def prj_11(t: Tables):
    known = F.when((F.col("event_type") != "error") & (F.col("value") > 20), F.concat(F.lit("E-"), "event_id"))
    rules = {"click": "R-CLICK", "view": "R-VIEW", "error": "R-ERROR"}
    return t.events.select(
        "event_id", P.impute_from_reason(known, F.col("event_type"), rules, F.lit("R-OTHER")).alias("reason_id")
    )


@query(
    "prj_12",
    """SELECT p_partkey, lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%blue%' AS is_coloured,
    lower(p_name) LIKE '%ring%' AS is_ring, lower(p_name) LIKE '%small%' OR lower(p_name) LIKE '%mini%' AS is_small
    FROM part""",
)
def prj_12(t: Tables):
    patterns = {"is_coloured": ["red", "blue"], "is_ring": ["ring"], "is_small": ["small", "mini"]}
    return P.flag_by_patterns(t.part, "p_name", patterns).select("p_partkey", *patterns)


@query(
    "prj_13",
    """SELECT l_orderkey, max(CASE WHEN l_partkey % 50 IN (1, 2, 3) THEN 1 ELSE 0 END) AS has_fish,
    max(CASE WHEN l_partkey % 50 IN (10, 20, 30, 40) THEN 1 ELSE 0 END) AS has_veg,
    max(CASE WHEN l_partkey % 50 IN (7) THEN 1 ELSE 0 END) AS has_spice FROM lineitem GROUP BY l_orderkey""",
)
def prj_13(t: Tables):
    lines = t.lineitem.withColumn("category", F.col("l_partkey") % 50)
    groups = {"has_fish": [1, 2, 3], "has_veg": [10, 20, 30, 40], "has_spice": [7]}
    return P.flag_by_ids(lines, "l_orderkey", "category", groups)


@query(
    "prj_14",
    """SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS INTEGER), 0) AS k,
    coalesce(CAST(json_extract(props, '$.m') AS INTEGER), 0) AS m FROM events""",
)
def prj_14(t: Tables):
    parsed = t.events.select("event_id", parse_json(F.col("props"), "k INT, m INT").alias("s"))
    return parsed.select("event_id", *flatten_struct("s", ["k", "m"], 0))


@query(
    "prj_15",
    """SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS kept_qty,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned_qty FROM lineitem GROUP BY l_orderkey""",
)
def prj_15(t: Tables):
    kept = P.masked_measure(F.col("l_quantity"), F.col("l_returnflag") == "N")
    back = P.masked_measure(F.col("l_quantity"), F.col("l_returnflag") == "R")
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(kept).alias("kept_qty"), F.sum(back).alias("returned_qty"))


@query("prj_16", "SELECT page_id, url AS page_url, length(html) AS html_length FROM pages")
def prj_16(t: Tables):
    camel = t.pages.select("page_id", F.col("url").alias("pageUrl"), F.length("html").alias("Html Length"))
    return text.snake_columns(camel)
