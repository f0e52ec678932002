"""Scalar functions and generated dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.functions import dates, text, vectors
from larder.functions.arrays import drop_nulls, parse_json
from larder.operators import calendars

_ISO = "CAST(isoyear(o_orderdate) AS INTEGER) AS y, CAST(weekofyear(o_orderdate) AS INTEGER) AS w"


@query(
    "fn_01",
    "SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start FROM orders",
)
def fn_01(t: Tables):
    y, w = dates.iso_year("o_orderdate"), F.weekofyear("o_orderdate")
    return t.orders.select("o_orderkey", dates.iso_week_start(y, w).alias("week_start"))


@query("fn_02", "SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM orders")
def fn_02(t: Tables):
    return t.orders.select("o_orderkey", dates.monday_of("o_orderdate").alias("monday"))


@query(
    "fn_03",
    """WITH d AS (SELECT CAST(range AS DATE) AS day,
      CAST(date_trunc('week', range) AS DATE) AS monday FROM range(DATE '2023-12-25', DATE '2026-01-12', INTERVAL 1 DAY)),
    span AS (SELECT min(CAST(ts AS DATE)) AS lo FROM events),
    w AS (SELECT day, monday, CAST(weekofyear(day) AS INTEGER) AS wk, CAST(year(monday) AS INTEGER) AS fy FROM d, span
      WHERE day >= lo AND day < lo + 730),
    f AS (SELECT day, monday, fy, CASE WHEN month(monday) = 12 AND wk = 1 THEN 53 ELSE wk END AS fw,
      CASE WHEN fy = 2024 AND wk = 40 THEN 4 ELSE quarter(monday) END AS fq,
      CASE WHEN fy = 2024 AND wk = 40 THEN 10 ELSE month(monday) END AS fm FROM w)
    SELECT day, CASE WHEN monday = DATE '2024-09-30' THEN monday + 1 ELSE monday END AS financial_date,
    CAST(fy AS INTEGER) AS financial_year, CAST(fq AS INTEGER) AS financial_quarter,
    CAST(fm AS INTEGER) AS financial_month, CAST(fw AS INTEGER) AS financial_week,
    CAST(7 * (fw - 1) + isodow(day) AS INTEGER) AS day_of_financial_year FROM f""",
)
def fn_03(t: Tables):
    days = calendars.days_from(t.events.agg(F.min(F.to_date("ts")).alias("day")), 730)
    return calendars.financial_calendar(days).select(
        "day",
        "financial_date",
        "financial_year",
        "financial_quarter",
        "financial_month",
        "financial_week",
        "day_of_financial_year",
    )


@query(
    "fn_04",
    f"""SELECT o_orderkey, y, w, y * 100 + w AS yw, CAST(dayofyear(o_orderdate) AS INTEGER) AS doy,
    CAST(isodow(o_orderdate) AS INTEGER) AS dow, CAST(quarter(o_orderdate) AS INTEGER) AS q
    FROM (SELECT *, {_ISO} FROM orders)""",
)
def fn_04(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.iso_year(d).cast("int").alias("y"),
        F.weekofyear(d).alias("w"),
        dates.year_week(d).alias("yw"),
        F.dayofyear(d).alias("doy"),
        (F.weekday(d) + 1).alias("dow"),
        F.quarter(d).alias("q"),
    )


@query(
    "fn_05",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS days,
    CAST((CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) // 7 AS INTEGER) AS weeks,
    CAST(date_diff('hour', o_orderdate, l_shipdate) AS BIGINT) AS hours,
    CAST(o_orderdate + INTERVAL 2 WEEK AS DATE) AS two_weeks_on
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def fn_05(t: Tables):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.datediff("l_shipdate", "o_orderdate").cast("long").alias("days"),
        dates.weeks_between("l_shipdate", "o_orderdate").alias("weeks"),
        F.timestamp_diff("HOUR", F.col("o_orderdate"), F.col("l_shipdate")).alias("hours"),
        F.expr("cast(o_orderdate + interval 2 weeks as date)").alias("two_weeks_on"),
    )


@query(
    "fn_06",
    f"""WITH o AS (SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS m FROM orders)
    SELECT o_orderkey, CAST((DATE '2001-08-06' - m) // 7 AS INTEGER) AS weeks_ago,
    round(log2(greatest(12 - (DATE '2001-08-06' - m) // 7, 1)) / log2(12), 6) AS score FROM o""",
)
def fn_06(t: Tables):
    ago = dates.year_week_diff(F.lit(200132), dates.year_week("o_orderdate"))
    return t.orders.select(
        "o_orderkey", ago.alias("weeks_ago"), F.round(dates.recency_score(ago, 12), 6).alias("score")
    )


@query(
    "fn_07",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
    s AS (SELECT day, CAST(date_trunc('week', day) AS DATE) + CASE WHEN isodow(day) <= 2 THEN 7 ELSE 14 END AS m FROM d)
    SELECT day, monday, CAST(isoyear(monday) * 100 + weekofyear(monday) AS INTEGER) AS yw,
    weekofyear(make_date(year(day), 12, 28)) = 53 AS year_has_53
    FROM (SELECT day, m + 7 * CAST(i AS INTEGER) AS monday FROM s, range(0, 3) r(i))""",
)
def fn_07(t: Tables):
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        "day",
        F.explode(dates.forecast_weeks("day", 2, 3)).alias("monday"),
        dates.has_week_53(F.year("day")).alias("year_has_53"),
    ).withColumn("yw", dates.year_week("monday"))


@query(
    "fn_08",
    """SELECT c_custkey, CASE WHEN CAST(c_custkey AS VARCHAR) IN ('7', '77') THEN CAST(c_custkey AS VARCHAR)
    WHEN c_nationkey % 3 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0')
    WHEN c_nationkey % 3 = 1 THEN lpad(CAST(c_custkey AS VARCHAR), 2, '0')
    ELSE CAST(c_custkey AS VARCHAR) END AS postal FROM customer""",
)
def fn_08(t: Tables):
    code = F.col("c_custkey").cast("string")
    country = (F.col("c_nationkey") % 3).cast("string")
    return t.customer.select(
        "c_custkey", text.clean_postal(code, country, {"0": 4, "1": 2}, ["7", "77"]).alias("postal")
    )


@query(
    "fn_09",
    """SELECT p_partkey, upper(trim(p_name)) AS up, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS cap,
    CAST(length(p_name) AS INTEGER) AS n, substr(p_name, 2, 3) AS mid, left(p_name, 2) AS l2, right(p_name, 2) AS r2,
    replace(p_brand, '#', ' ') AS brand, split_part(p_name, ' ', 1) AS first_word,
    lpad(CAST(p_size AS VARCHAR), 3, '0') AS size3, p_type || '/' || p_size AS label FROM part""",
)
def fn_09(t: Tables):
    n = F.col("p_name")
    return t.part.select(
        "p_partkey",
        F.upper(F.trim(n)).alias("up"),
        F.initcap("p_type").alias("cap"),
        F.length(n).alias("n"),
        F.substring(n, 2, 3).alias("mid"),
        F.left(n, F.lit(2)).alias("l2"),
        F.right(n, F.lit(2)).alias("r2"),
        F.replace("p_brand", F.lit("#"), F.lit(" ")).alias("brand"),
        F.split(n, " ")[0].alias("first_word"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size3"),
        F.format_string("%s/%s", "p_type", "p_size").alias("label"),
    )


@query(
    "fn_10",
    """WITH c AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS code FROM part)
    SELECT p_partkey, CAST(CASE WHEN length(code) = 2 AND right(code, 1) = '1' THEN left(code, 1) ELSE code END
    AS INTEGER) AS portions, CASE WHEN length(code) = 2 AND right(code, 1) = '1' THEN left(code, 1) || '+'
    ELSE code END AS portion_name FROM c""",
)
def fn_10(t: Tables):
    number, name = text.parse_portion(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", number.alias("portions"), name.alias("portion_name"))


@query(
    "fn_11",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(ceil(l_quantity / 3) AS BIGINT) AS c,
    CAST(floor(l_quantity / 3) AS BIGINT) AS f, round(l_extendedprice, 0) AS r, abs(l_discount - 0.05) AS a,
    greatest(l_discount, l_tax) AS g, least(l_discount, l_tax) AS l,
    round(l_extendedprice / nullif(l_tax, 0), 4) AS ratio, l_partkey % 7 AS m, round(exp(l_discount), 8) AS e,
    round(ln(l_quantity), 8) AS n, round(log2(l_quantity), 8) AS n2, round(pow(l_quantity, 1.5), 6) AS p
    FROM lineitem""",
)
def fn_11(t: Tables):
    q, d, x = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.ceil(q / 3).alias("c"),
        F.floor(q / 3).alias("f"),
        F.round("l_extendedprice", 0).alias("r"),
        F.abs(d - 0.05).alias("a"),
        F.greatest(d, x).alias("g"),
        F.least(d, x).alias("l"),
        F.round(F.try_divide("l_extendedprice", x), 4).alias("ratio"),
        F.pmod("l_partkey", F.lit(7)).alias("m"),
        F.round(F.exp(d), 8).alias("e"),
        F.round(F.log(q), 8).alias("n"),
        F.round(F.log2(q), 8).alias("n2"),
        F.round(F.pow(q, F.lit(1.5)), 6).alias("p"),
    )


@query(
    "fn_12",
    """WITH e AS (SELECT strftime(ts, '%H%M') AS hm, count(*) AS n_events FROM events GROUP BY 1)
    SELECT lpad(CAST(h AS VARCHAR), 2, '0') || lpad(CAST(m AS VARCHAR), 2, '0') AS pk_time, CAST(h AS INTEGER) AS hour,
    CAST(m AS INTEGER) AS minute, coalesce(n_events, 0) AS n_events
    FROM range(0, 24) a(h), range(0, 60) b(m)
    LEFT JOIN e ON hm = lpad(CAST(h AS VARCHAR), 2, '0') || lpad(CAST(m AS VARCHAR), 2, '0')""",
)
def fn_12(t: Tables):
    used = t.events.groupBy(dates.time_key("ts").alias("pk_time")).agg(F.count("*").alias("n_events"))
    return calendars.dim_time(t.spark).join(used, "pk_time", "left").fillna(0, ["n_events"])


@query(
    "fn_12_periods",
    """SELECT o_orderkey, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INTEGER) AS days_since,
    CAST((DATE '2001-12-31' - CAST(o_orderdate AS DATE)) // 7 AS INTEGER) AS weeks_since,
    CAST((DATE '2001-12-31' - CAST(o_orderdate AS DATE)) // 30 AS INTEGER) AS months_since,
    CAST(floor((DATE '2001-12-31' - CAST(o_orderdate AS DATE)) / 365 * 4) AS INTEGER) AS quarters_since,
    CAST((DATE '2001-12-31' - CAST(o_orderdate AS DATE)) // 365 AS INTEGER) AS years_since FROM orders""",
)
def fn_12_periods(t: Tables):
    o = t.orders.select(
        "o_orderkey", F.datediff(F.lit("2001-12-31").cast("date"), F.to_date("o_orderdate")).alias("days_since")
    )
    return o.join(calendars.dim_periods(t.spark), "days_since")


@query(
    "fn_13",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    CAST(json_extract(props, '$.k') AS INTEGER) * 2 AS k2 FROM events""",
)
def fn_13(t: Tables):
    listed = t.events.select(
        "event_id", parse_json(F.concat(F.lit("["), "props", F.lit("]")), "array<struct<k:int>>").alias("a")
    )
    doubled = F.transform("a", lambda s: s["k"] * 2)
    return listed.select("event_id", F.col("a")[0]["k"].alias("k"), doubled[0].alias("k2"))


@query(
    "fn_14",
    """SELECT l_orderkey, '[' || string_agg('{"item":' || l_partkey || ',"qty":' || CAST(l_quantity AS BIGINT) || '}',
    ',' ORDER BY l_quantity DESC, l_partkey) || ']' AS lines
    FROM lineitem GROUP BY l_orderkey""",
)
def fn_14(t: Tables):
    line = F.struct(F.col("l_partkey").alias("item"), F.col("l_quantity").cast("long").alias("qty"))
    cmp = lambda a, b: (
        F.when(a["qty"] > b["qty"], -1).when(a["qty"] < b["qty"], 1)
        .when(a["item"] < b["item"], -1).when(a["item"] > b["item"], 1).otherwise(0)
    )
    return t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list(line), cmp)).alias("lines"))


@query(
    "fn_15",
    """WITH a AS (SELECT o_orderkey, list(l_partkey ORDER BY l_partkey) AS parts
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    SELECT o_orderkey, array_to_string([x + 1 for x in parts if x % 2 = 0], ',') AS evens,
    CAST(len([x for x in parts if x % 3 <> 0]) AS INTEGER) AS n_not_three FROM a""",
)
def fn_15(t: Tables):
    a = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list("l_partkey")).alias("parts")
    )
    evens = F.transform(F.filter("parts", lambda x: x % 2 == 0), lambda x: (x + 1).cast("string"))
    thirds = F.transform("parts", lambda x: F.when(x % 3 != 0, x))
    return a.select(
        "o_orderkey", F.array_join(evens, ",").alias("evens"), F.size(drop_nulls(thirds)).alias("n_not_three")
    )


@query(
    "fn_16",
    """SELECT conv_id, turn, word, count(*) AS n FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word
    FROM conversations) GROUP BY conv_id, turn, word""",
)
def fn_16(t: Tables):
    words = t.conversations.select("conv_id", "turn", F.explode_outer(F.split("text", " ")).alias("word"))
    return words.groupBy("conv_id", "turn", "word").agg(F.count("*").alias("n"))


def _stop_sql() -> str:
    lists = ["WHEN '%s' THEN [%s]" % (k, ", ".join(f"'{w}'" for w in v)) for k, v in text.STOPWORDS.items()]
    return "CASE lang " + " ".join(lists) + " ELSE CAST([] AS VARCHAR[]) END"


@query(
    "fn_18",
    f"""WITH t AS (SELECT doc_id, {_stop_sql()} AS stop,
      string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g')), ' ') AS words FROM documents)
    SELECT doc_id, array_to_string([w for w in words if w <> '' AND NOT list_contains(stop, w)], ' ') AS clean
    FROM t""",
)
def fn_18(t: Tables):
    return t.documents.select(
        "doc_id", F.array_join(text.clean_tokens_by_language("text", "lang"), " ").alias("clean")
    )


@query(
    "fn_19",
    """WITH e AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, range(1, 65) r(i)),
    c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY label, i),
    n AS (SELECT label, sqrt(sum(m * m)) AS len FROM c GROUP BY label),
    v AS (SELECT vec_id, sqrt(sum(x * x)) AS len FROM e GROUP BY vec_id)
    SELECT e.vec_id, e.label, round(sum(x * m) / (max(v.len) * max(n.len)), 6) AS cos_to_centroid
    FROM e JOIN c ON e.label = c.label AND e.i = c.i JOIN n ON n.label = e.label JOIN v ON v.vec_id = e.vec_id
    GROUP BY e.vec_id, e.label""",
)
def fn_19(t: Tables):
    centres = vectors.mean_vectors(t.embeddings, ["label"], "embedding", 64).withColumn(
        "centroid", vectors.normalised(F.col("centroid"))
    )
    return t.embeddings.join(centres, "label").select(
        "vec_id", "label", F.round(vectors.cosine(F.col("embedding"), F.col("centroid")), 6).alias("cos_to_centroid")
    )
