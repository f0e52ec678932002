"""Jobs: fact tables and churn features."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.functions.dates import monday_of, weeks_between, year_week
from larder.operators.chunked import neighbour
from larder.operators.joins import as_of
from larder.plans import churn, facts


def order_lines(t: Tables):
    """One row per order and item."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("order"), F.col("l_partkey").alias("item")).agg(
        F.sum("l_quantity").alias("quantity"),
        F.sum(F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("amount"),
    )


@query(
    "job_06",
    """WITH l AS (SELECT l_orderkey AS "order", l_partkey AS item, sum(l_quantity) AS quantity,
      sum(l_extendedprice * (l_discount - 0.05)) AS amount FROM lineitem GROUP BY 1, 2),
    o AS (SELECT o_orderkey AS "order", o_custkey AS customer, date_trunc('week', o_orderdate) AS menu_week, o_orderstatus <> 'P' AS sub,
      lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders),
    p AS (SELECT o."order", l.item, l.quantity AS planned_quantity FROM o JOIN l ON o.prev = l."order"),
    j AS (SELECT coalesce(l."order", p."order") AS "order", coalesce(l.item, p.item) AS item, quantity, planned_quantity,
      amount FROM l FULL JOIN p ON l."order" = p."order" AND l.item = p.item),
    f AS (SELECT j.*, customer, sub AND menu_week >= TIMESTAMP '1996-01-01' AS counts, menu_week, CASE WHEN quantity IS NOT NULL THEN 'ORDERED' ELSE 'GENERATED' END AS line_type,
      CASE WHEN sub AND menu_week >= TIMESTAMP '1996-01-01' THEN CAST(quantity IS NOT NULL AND planned_quantity IS NULL
        AS INTEGER) END AS added,
      CASE WHEN sub AND menu_week >= TIMESTAMP '1996-01-01' THEN CAST(quantity IS NULL AND planned_quantity IS NOT NULL
        AS INTEGER) END AS removed FROM j LEFT JOIN o ON j."order" = o."order"),
    s AS (SELECT "order", CASE WHEN NOT counts THEN NULL
        WHEN count(planned_quantity) = 0 AND menu_week >= TIMESTAMP '1998-01-01' THEN false
        ELSE coalesce(sum(added) + sum(removed) <> abs(count(quantity) - count(planned_quantity)), false) END AS has_swap,
      CASE WHEN counts THEN coalesce(sum(added) + sum(removed) <> 0 OR sum(quantity) <> sum(planned_quantity), false) END
        AS is_adjusted FROM f GROUP BY "order", counts, menu_week)
    SELECT f."order", customer, item, line_type, added, removed, quantity IS NOT NULL AND round(amount, 6) > 0 AS is_plus_price,
    quantity IS NOT NULL AND round(amount, 6) < 0 AS is_thrifty, md5(f."order" || '-' || item) AS pk_order_line,
    coalesce(md5(CAST(customer AS VARCHAR)), '0') AS fk_customer, has_swap, is_adjusted FROM f JOIN s ON f."order" = s."order\"""",
)
def job_06(t: Tables):
    lines = order_lines(t).withColumn("amount", F.round("amount", 6))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    o = neighbour(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"prev": "o_orderkey"})
    before = o.where("prev is not null").select(F.col("o_orderkey").alias("order"), "prev")
    plan = before.join(lines.select(F.col("order").alias("prev"), "item", F.col("quantity").alias("planned_quantity")), "prev")
    heads = t.orders.select(
        F.col("o_orderkey").alias("order"),
        F.col("o_custkey").alias("customer"),
        F.date_trunc("week", "o_orderdate").alias("menu_week"),
        (F.col("o_orderstatus") != "P").alias("is_subscription"),
    )
    fact = facts.order_fact(lines, plan.drop("prev"), heads, F.expr("timestamp_ntz'1996-01-01 00:00:00'"), F.expr("timestamp_ntz'1998-01-01 00:00:00'"))
    return fact.drop("quantity", "planned_quantity", "amount")


@query(
    "job_07",
    """WITH v AS (SELECT o_orderkey AS version, o_custkey AS customer, o_orderdate AS at,
      CAST(date_trunc('week', o_orderdate) AS DATE) + 7 AS monday FROM orders),
    d AS (SELECT l_orderkey AS output, p_partkey % 40 AS item, p_brand AS ingredient FROM lineitem JOIN part
      ON l_partkey = p_partkey),
    h AS (SELECT a.version AS output, b.monday, b.version, row_number() OVER (PARTITION BY a.version, b.monday
      ORDER BY b.at DESC, b.version DESC) AS rk FROM v a JOIN v b ON a.customer = b.customer
      AND b.monday >= a.monday - 42 AND b.monday < a.monday AND b.at <= a.at + INTERVAL 1 MINUTE),
    w AS (SELECT output, count(*) AS win FROM h WHERE rk = 1 GROUP BY 1),
    s AS (SELECT h.output, i.item, count(*) AS rep FROM h JOIN (SELECT DISTINCT output AS version, item FROM d) i
      USING (version) WHERE rk = 1 GROUP BY 1, 2),
    x AS (SELECT d.output, ingredient, coalesce(win, 0) AS win, coalesce(coalesce(rep, 0) / win, 0) AS share FROM d
      LEFT JOIN w ON w.output = d.output LEFT JOIN s ON s.output = d.output AND s.item = d.item),
    r AS (SELECT output, max(win) AS week_window, round(1 - avg(share), 9) AS rs, round(count(DISTINCT ingredient) / count(*), 9)
      AS vs FROM x GROUP BY 1)
    SELECT output, week_window, round(rs, 6) AS rotation_score, round(vs, 6) AS variation_score,
    CASE WHEN rs >= 1 THEN 'Very High' WHEN rs >= 0.9 THEN 'High' WHEN rs >= 0.8 THEN 'Medium' WHEN rs >= 0.6 THEN 'Low'
    ELSE 'Very Low' END AS rotation_group, CASE WHEN vs >= 1 THEN 1 WHEN vs >= 0.75 THEN 2 WHEN vs >= 0.6 THEN 3
    WHEN vs >= 0.5 THEN 4 ELSE 5 END AS variation_group_number FROM r""",
)
def job_07(t: Tables):
    v = t.orders.select(
        F.col("o_orderkey").alias("version"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("created_at"),
        F.date_add(monday_of("o_orderdate"), 7).alias("monday"),
    )
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("output"), (F.col("p_partkey") % 40).alias("item"), F.col("p_brand").alias("ingredient")
    )
    r = facts.rotation_scores(
        v.withColumnRenamed("version", "output"), d, v, d.select(F.col("output").alias("version"), "item")
    )
    return r.select(
        "output",
        "week_window",
        F.round("rotation_score", 6).alias("rotation_score"),
        F.round("variation_score", 6).alias("variation_score"),
        "rotation_group",
        "variation_group_number",
    )


# Menus: a company offers the part names of one brand whose colour word fits the week, so a menu has at most 8 items.
COLOURS = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]


def menus(t: Tables):
    items = t.part.groupBy(
        (F.split("p_brand", "#")[1].cast("int") - 1).alias("company"), F.col("p_name").alias("item")
    ).agg(F.max("p_type").alias("kind"))
    slot = F.array_position(F.array(*[F.lit(c) for c in COLOURS]), F.split("item", " ")[0]) - 1
    noun = F.split("item", " ")[1]
    return items.select(
        "company",
        slot.cast("int").alias("slot"),
        "item",
        F.array(noun).alias("allergens"),
        F.array(F.reverse(noun)).alias("tastes"),
        F.array("kind").alias("concepts"),
    )


MENUS = """menus AS (SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) - 1 AS company, p_name AS item,
  list_position(['blue','cold','hot','large','new','old','red','small'], split_part(p_name, ' ', 1)) - 1 AS slot,
  split_part(p_name, ' ', 2) AS noun, max(p_type) AS kind FROM part GROUP BY ALL)"""


def subscribers(t: Tables):
    """Customers with their preferences in the weeks they order."""
    weeks = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("customer"),
        F.col("c_nationkey").alias("company"),
        (F.floor(F.datediff(monday_of("o_orderdate"), F.lit("1995-01-02").cast("date")) / 7) % 8).cast("int").alias("slot"),
        year_week("o_orderdate").alias("yw"),
    ).distinct()
    k = F.col("customer")
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))
    nouns = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    return weeks.select(
        "*",
        F.when(k % 3 == 0, F.array(pick(nouns, k))).alias("allergens"),
        F.array(F.reverse(pick(nouns, k + 1)), F.lit(None).cast("string")).alias("tastes"),
        F.array(pick(kinds, k), pick(kinds, k + 1), pick(kinds, k + 2)).alias("concepts"),
    )


@query(
    "job_08",
    f"""WITH {MENUS}, c AS (SELECT DISTINCT o_custkey AS customer, c_nationkey AS company,
      CAST(((CAST(date_trunc('week', o_orderdate) AS DATE) - DATE '1995-01-02') // 7) % 8 AS INTEGER) AS slot,
      CAST(isoyear(o_orderdate) * 100 + weekofyear(o_orderdate) AS INTEGER) AS yw FROM orders JOIN customer
      ON o_custkey = c_custkey),
    n AS (SELECT ['anvil','bolt','gear','gizmo','plate','ring','rod','widget'] AS nouns,
      ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'] AS kinds)
    SELECT c.company, c.slot, yw, customer, item, CASE WHEN customer % 3 = 0 AND noun = nouns[customer % 8 + 1] THEN 1
      WHEN noun = nouns[(customer + 1) % 8 + 1] OR kind NOT IN (kinds[customer % 6 + 1], kinds[(customer + 1) % 6 + 1],
      kinds[(customer + 2) % 6 + 1]) THEN 2 ELSE 3 END AS compliancy
    FROM c JOIN menus ON c.company = menus.company AND c.slot = menus.slot, n""",
)
def job_08(t: Tables):
    subs = subscribers(t)
    out = facts.compliancy(subs.withColumn("customer", F.struct("customer", "yw")), menus(t), ["company", "slot"])
    return out.select("company", "slot", "customer.yw", "customer.customer", "item", "compliancy")


_SETS = """m AS (SELECT DISTINCT l_orderkey, split_part(p_name, ' ', 2) AS noun FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT DISTINCT md5(j) AS combination_id, j FROM (SELECT l_orderkey, string_agg(noun, ',' ORDER BY noun) AS j FROM m
  GROUP BY 1)),
b AS (SELECT combination_id, unnest(string_split(j, ',')) AS noun FROM c)"""


def _combos(t: Tables):
    sets = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", F.split("p_name", " ")[1].alias("noun")
    )
    noun = F.col("noun")
    kinds = F.when(noun.isin("bolt", "rod"), "allergen").when(noun.isin("ring", "gear"), "concept").otherwise("taste")
    types = t.part.select(F.split("p_name", " ")[1].alias("noun")).distinct()
    types = types.select("noun", F.upper("noun").alias("name"), kinds.alias("type"))
    return facts.combination_dim(sets, "l_orderkey", "noun", types)


@query(
    "job_09",
    f"""WITH {_SETS} SELECT combination_id,
    coalesce(string_agg(upper(noun), ', ' ORDER BY noun) FILTER (noun IN ('bolt', 'rod')), '') AS allergen_names,
    coalesce(string_agg(upper(noun), ', ' ORDER BY noun) FILTER (noun NOT IN ('bolt', 'rod', 'ring', 'gear')), '')
    AS taste_names,
    coalesce(string_agg(upper(noun), ', ' ORDER BY noun) FILTER (noun IN ('ring', 'gear')), '') AS concept_names,
    count(*) AS n_members, count(*) FILTER (noun IN ('bolt', 'rod')) AS n_allergens FROM b GROUP BY 1""",
)
def job_09(t: Tables):
    return _combos(t)[0]


@query("job_09_bridge", f"WITH {_SETS} SELECT combination_id, noun FROM b")
def job_09_bridge(t: Tables):
    return _combos(t)[1]


def _tree(t: Tables):
    """Brands below nations below regions below one root."""
    brand = t.part.select("p_brand").distinct()
    number = F.split("p_brand", "#")[1].cast("int") - 1
    rows = brand.select(F.col("p_brand").alias("category"), F.concat(F.lit("N"), number).alias("parent"))
    rows = rows.unionByName(
        t.nation.select(
            F.concat(F.lit("N"), "n_nationkey").alias("category"), F.concat(F.lit("R"), "n_regionkey").alias("parent")
        )
    )
    rows = rows.unionByName(
        t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("category"), F.lit("ALL").alias("parent"))
    )
    return rows.unionByName(t.spark.range(1).select(F.lit("ALL").alias("category"), F.lit(None).cast("string").alias("parent")))


_TREE = """tree AS (SELECT DISTINCT p_brand AS category, 'N' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) - 1) AS parent
  FROM part UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation UNION ALL SELECT 'R' || r_regionkey, 'ALL'
  FROM region UNION ALL SELECT 'ALL', NULL)"""


@query(
    "job_10",
    f"""WITH RECURSIVE {_TREE}, up AS (SELECT p_partkey, 0 AS level, category, parent FROM part JOIN tree ON p_brand = category
      UNION ALL SELECT p_partkey, level + 1, tree.category, tree.parent FROM up JOIN tree ON up.parent = tree.category)
    SELECT * FROM up""",
)
def job_10(t: Tables):
    return facts.flatten_hierarchy(t.part.select("p_partkey", "p_brand"), "p_partkey", "p_brand", _tree(t))


@query("job_10_roots", f"WITH {_TREE} SELECT category, 'ALL' AS root FROM tree")
def job_10_roots(t: Tables):
    return facts.hierarchy_roots(_tree(t), 8)


_SNAP = "DATE '2000-06-30'"


@query(
    "job_11",
    f"""WITH ev AS (SELECT user_id AS customer, CAST({_SNAP} AS TIMESTAMP) + (ts - TIMESTAMP '2024-01-25') * 7 AS ts, event_type
      FROM events),
    o AS (SELECT o_custkey AS customer, max(CAST(o_orderdate AS DATE)) AS last_delivery, count(*) AS n_orders FROM orders
      WHERE CAST(o_orderdate AS DATE) <= {_SNAP} GROUP BY 1),
    s AS (SELECT o_custkey AS customer, min(CAST(o_orderdate AS DATE)) AS started_on FROM orders GROUP BY 1),
    e AS (SELECT customer, count(*) FILTER (event_type IN ('signup', 'error')) AS total_account,
      count(*) FILTER (event_type IN ('signup', 'error') AND ts > {_SNAP} - 28) AS account_last_n_weeks,
      count(*) FILTER (event_type IN ('signup', 'error') AND ts > {_SNAP} - 7) AS account_last_week,
      round(count(*) FILTER (event_type IN ('signup', 'error') AND ts > {_SNAP} - 70) / 10, 4) AS account_weekly_average
      FROM ev WHERE ts <= {_SNAP} GROUP BY 1),
    c AS (SELECT customer, count(*) AS n_complaints, count(*) FILTER (d > {_SNAP} - 28) AS n_complaints_last_n,
      ({_SNAP} - max(d)) // 7 AS weeks_since_complaint, arg_max(cat, (d, cat)) AS last_category FROM
      (SELECT o_custkey AS customer, CAST(l_shipdate AS DATE) AS d, l_linestatus || l_linenumber AS cat FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') WHERE d <= {_SNAP} GROUP BY 1)
    SELECT s.customer, CAST(({_SNAP} - started_on) // 7 AS INTEGER) AS tenure_weeks, coalesce(n_orders, 0) AS n_orders,
    CAST(({_SNAP} - last_delivery) // 7 AS INTEGER) AS weeks_since_last_delivery, coalesce(total_account, 0) AS total_account,
    coalesce(account_last_n_weeks, 0) AS account_last_n_weeks, coalesce(account_last_week, 0) AS account_last_week,
    coalesce(account_weekly_average, 0) AS account_weekly_average, coalesce(n_complaints, 0) AS n_complaints,
    coalesce(n_complaints_last_n, 0) AS n_complaints_last_n, CAST(weeks_since_complaint AS INTEGER) AS weeks_since_complaint,
    last_category FROM s LEFT JOIN o USING (customer) LEFT JOIN e USING (customer) LEFT JOIN c USING (customer)
    WHERE started_on <= {_SNAP}""",
)
def job_11(t: Tables):
    snapshot = F.lit("2000-06-30").cast("date")
    placed = t.orders.select(F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("delivery_date"))
    customers = placed.groupBy("customer").agg(F.min("delivery_date").alias("started_on"))
    # The events cover January 2024: stretched onto the weeks before the snapshot.
    shift = F.expr("timestamp_ntz'2000-06-30 00:00:00' + (ts - timestamp_ntz'2024-01-25 00:00:00') * 7")
    events = t.events.select(F.col("user_id").alias("customer"), shift.alias("ts"), "event_type")
    complaints = (
        t.lineitem.where("l_returnflag = 'R'")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("customer"),
            F.to_date("l_shipdate").alias("complained_on"),
            F.concat("l_linestatus", "l_linenumber").alias("category"),
        )
    )
    kinds = {"account": F.col("event_type").isin("signup", "error"), "normal": F.col("event_type").isin("click", "view")}
    f = churn.churn_features(customers, placed, events, complaints, snapshot, kinds)
    return f.select(
        "customer",
        "tenure_weeks",
        "n_orders",
        "weeks_since_last_delivery",
        "total_account",
        "account_last_n_weeks",
        "account_last_week",
        F.round("account_weekly_average", 4).alias("account_weekly_average"),
        "n_complaints",
        "n_complaints_last_n",
        "weeks_since_complaint",
        "last_category",
    )


@query(
    "job_12",
    """WITH s AS (SELECT DISTINCT o_custkey AS customer, last_day(o_orderdate) AS snapshot_date FROM orders),
    l AS (SELECT s.*, CAST((snapshot_date - (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = customer
      AND CAST(o_orderdate AS DATE) <= snapshot_date - 10)) // 7 AS INTEGER) AS weeks FROM s),
    b AS (SELECT *, CASE WHEN last_value(weeks) OVER (PARTITION BY customer ORDER BY snapshot_date
      ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) > 2 THEN 'churned' ELSE 'active' END AS label,
      CAST(year(snapshot_date) * 100 + weekofyear(snapshot_date) AS INTEGER) AS year_week FROM l)
    SELECT customer, snapshot_date, label, CASE WHEN year_week >= (SELECT min(year_week) FROM (SELECT DISTINCT year_week FROM b
    WHERE year_week >= 199601 ORDER BY year_week DESC LIMIT 8)) THEN 'holdout' ELSE 'train' END AS part FROM b
    WHERE year_week >= 199601""",
)
def job_12(t: Tables):
    placed = t.orders.select(F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("day")).distinct()
    snaps = placed.select("customer", F.last_day("day").alias("snapshot_date")).distinct()
    snaps = snaps.withColumn("known", F.date_sub("snapshot_date", 10))
    hit = as_of(snaps, placed, ["customer"], "known", "day", "m")
    weekly = hit.select("customer", "snapshot_date", weeks_between(F.col("snapshot_date"), F.col("m.day")).alias("weeks"))
    out = churn.label_and_split(weekly, "customer", "snapshot_date", "weeks", 2, 199601, 8)
    return out.select("customer", "snapshot_date", "label", "part")
