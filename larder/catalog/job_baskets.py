"""Jobs: basket selection and menus."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.job_facts import MENUS, menus, subscribers
from larder.catalog.job_journey import menu_orders
from larder.catalog.job_recommend import BUY, DISHES, dishes, purchases
from larder.catalog.registry import Tables, query
from larder.functions.dates import year_week
from larder.operators.aggregates import contains_any, mean_of_bool
from larder.plans import baskets as B
from larder.plans import menus as M

SCALARS = ["size", "quantity", "discount"]
FLAGS = ["has_promo", "promo_share"]


def basket_features(t: Tables):
    """Features of a basket, scaled to 0..1; orders are the baskets."""
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    promo = F.col("p_type") == "PROMO"
    return j.groupBy(F.col("o_custkey").alias("customer"), "l_orderkey").agg(
        (F.avg("p_size") / 50).alias("size"),
        (F.avg("l_quantity") / 50).alias("quantity"),
        (F.avg("l_discount") * 10).alias("discount"),
        contains_any(promo).alias("has_promo"),
        mean_of_bool(promo).alias("promo_share"),
    )


BASKETS = """bf AS (SELECT o_custkey AS customer, l_orderkey, avg(p_size) / 50 AS size, avg(l_quantity) / 50 AS quantity,
  avg(l_discount) * 10 AS discount, max(CASE WHEN p_type = 'PROMO' THEN 1.0 ELSE 0.0 END)::DOUBLE AS has_promo,
  avg(CASE WHEN p_type = 'PROMO' THEN 1.0 ELSE 0.0 END) AS promo_share FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
tg AS (SELECT customer, avg(size) AS size, avg(quantity) AS quantity, avg(discount) AS discount, avg(has_promo) AS has_promo,
  avg(promo_share) AS promo_share FROM bf GROUP BY 1),
r0 AS (SELECT customer, 1 / greatest(stddev_samp(size), 0.005) AS size, 1 / greatest(stddev_samp(quantity), 0.005) AS quantity,
  1 / greatest(stddev_samp(discount), 0.005) AS discount, avg(CAST(has_promo > 0 AS INTEGER)) AS has_promo,
  avg(CAST(promo_share > 0 AS INTEGER)) AS promo_share FROM bf GROUP BY 1 HAVING count(*) > 1),
r1 AS (SELECT customer, exp(size) AS size, exp(quantity) AS quantity, exp(discount) AS discount,
  CASE WHEN has_promo < 0.3 THEN 1 / (1 + exp(-(has_promo + 0.15) / 0.015)) ELSE 1 / (1 + exp(-(has_promo - 0.65) / 0.035)) END
  AS has_promo, CASE WHEN promo_share < 0.3 THEN 1 / (1 + exp(-(promo_share + 0.15) / 0.015))
  ELSE 1 / (1 + exp(-(promo_share - 0.65) / 0.035)) END AS promo_share FROM r0),
im AS (SELECT customer, size / (size + quantity + discount) * 0.6 AS size, quantity / (size + quantity + discount) * 0.6 AS quantity,
  discount / (size + quantity + discount) * 0.6 AS discount, has_promo / nullif(has_promo + promo_share, 0) * 0.4 AS has_promo,
  promo_share / nullif(has_promo + promo_share, 0) * 0.4 AS promo_share FROM r1)"""


@query(
    "job_31",
    f"""WITH {BASKETS} SELECT tg.customer, round(tg.size, 10) AS t_size, round(tg.has_promo, 10) AS t_has_promo, round(im.size, 10) AS w_size,
    round(im.discount, 10) AS w_discount, round(im.has_promo, 10) AS w_has_promo, round(im.promo_share, 10) AS w_promo_share
    FROM tg LEFT JOIN im ON im.customer = tg.customer""",
)
def job_31(t: Tables):
    target, importance = B.user_vectors(basket_features(t), "customer", SCALARS, FLAGS)
    tt = target.select("customer", F.round("size", 10).alias("t_size"), F.round("has_promo", 10).alias("t_has_promo"))
    w = importance.select(
        "customer", *[F.round(c, 10).alias(f"w_{c}") for c in ("size", "discount", "has_promo", "promo_share")]
    )
    return tt.join(w, "customer", "left")


def menu_items(t: Tables):
    """Dish features of a company's menu."""
    return dishes(t).select(
        "company",
        "item",
        "kind",
        (F.col("size") / 50).alias("f_size"),
        (F.col("part") % 11 / 10).alias("f_cost"),
        (F.col("kind") == "PROMO").cast("double").alias("f_promo"),
    )


def basket_customers(t: Tables):
    k = F.col("c_custkey")
    d = lambda n, m: (k % n / F.lit(float(m)))
    return t.customer.select(
        k.alias("customer"),
        F.col("c_nationkey").alias("company"),
        F.array(d(50, 50), d(7, 7), d(2, 2)).alias("target"),
        F.array(F.lit(0.5), d(3, 3), F.lit(0.2)).alias("weight"),
    )


_ERR = """pow(10 * ((coalesce(c.s1, 0) + m.size / 50.0) / {n} - t1) * 0.5, 2)
  + pow(10 * ((coalesce(c.s2, 0) + m.part % 11 / 10.0) / {n} - t2) * w2, 2)
  + pow(10 * ((coalesce(c.s3, 0) + CASE WHEN m.kind = 'PROMO' THEN 1 ELSE 0 END) / {n} - t3) * 0.2, 2)"""


def _greedy_sql(rounds: int) -> str:
    sql = f"""WITH {DISHES}, c0 AS MATERIALIZED (SELECT c_custkey AS customer, c_nationkey AS company, c_custkey % 50 / 50.0 AS t1, c_custkey % 7 / 7.0
      AS t2, c_custkey % 2 / 2.0 AS t3, c_custkey % 3 / 3.0 AS w2, 0.0::DOUBLE AS s1, 0.0::DOUBLE AS s2, 0.0::DOUBLE AS s3, CAST([] AS VARCHAR[]) AS basket, 0.0::DOUBLE AS error
      FROM customer WHERE c_nationkey IN (SELECT company FROM dishes))"""
    for n in range(1, rounds + 1):
        # A menu with fewer items than rounds adds nothing: the basket stays shorter.
        sql += f""", c{n} AS MATERIALIZED (SELECT c.customer, c.company, t1, t2, t3, w2, s1 + coalesce(m.size / 50.0, 0) AS s1,
          s2 + coalesce(m.part % 11 / 10.0, 0) AS s2, s3 + CASE WHEN m.kind = 'PROMO' THEN 1 ELSE 0 END AS s3,
          CASE WHEN m.item IS NULL THEN basket ELSE list_append(basket, m.item) END AS basket,
          CASE WHEN m.item IS NULL THEN error ELSE {_ERR.format(n=float(n))} END AS error
          FROM c{n - 1} c LEFT JOIN dishes m ON m.company = c.company AND NOT list_contains(basket, m.item)
          QUALIFY row_number() OVER (PARTITION BY c.customer ORDER BY round({_ERR.format(n=float(n))}, 9), m.item) = 1)"""
    return sql + f""" SELECT customer, array_to_string(list_sort(basket), ',') AS basket, round(error, 6) AS error FROM c{rounds}"""


@query("job_32", _greedy_sql(4))
def job_32(t: Tables):
    arrays = B.menu_arrays(menu_items(t), ["company"], "item", ["f_size", "f_cost", "f_promo"], "kind")
    out = B.greedy_basket(basket_customers(t), arrays, ["company"], 4)
    return out.select(
        "customer", F.array_join(F.array_sort("basket"), ",").alias("basket"), F.round("error", 6).alias("error")
    )


# Importance and target of the features that every customer has.
STATIC = {
    "mean_cost_of_food": (0.1, 0),
    "mean_rank": (0.05, 0),
    "mean_ordered_ago": (0.3, 0),
    "intra_week_similarity": (0.05, 0),
    "repeated_proteins_percentage": (0.05, 0),
    "repeated_carbo_percentage": (0.05, 0),
    "mean_is_dislike": (0.1, 0),
    "mean_is_favorite": (0.1, 1),
    "suppress_score": (0.05, 0),
}
_STATIC = ", ".join(f"('{f}', {i}, {t})" for f, (i, t) in STATIC.items())


@query(
    "job_33",
    f"""WITH {BASKETS}, ft AS (SELECT * FROM (VALUES ('size'), ('quantity'), ('discount'), ('has_promo'), ('promo_share')) v(feature)),
    cc AS (SELECT c_custkey AS customer, s AS concept, feature, CASE WHEN (length(feature) + s) % 3 = 0 THEN 0 ELSE (length(feature) + s) % 5 + 1 END
      AS importance, ((length(feature) * s) % 4) / 4.0 AS target FROM customer, ft, (VALUES (1), (2)) q(s) WHERE s = 1 OR c_custkey % 2 = 0),
    n1 AS (SELECT *, importance / sum(importance) OVER (PARTITION BY customer, concept) AS i FROM cc),
    b0 AS (SELECT customer, feature, coalesce(avg(i) FILTER (i > 0), 0) AS i, coalesce(sum(i * target) / nullif(sum(i), 0), 0) AS t FROM n1 GROUP BY 1, 2),
    b AS (SELECT customer, feature, i / sum(i) OVER (PARTITION BY customer) AS i, t FROM b0),
    hi AS (SELECT customer, feature, value FROM im UNPIVOT INCLUDE NULLS (value FOR feature IN (size, quantity, discount, has_promo, promo_share))),
    ht AS (SELECT customer, feature, value FROM tg UNPIVOT (value FOR feature IN (size, quantity, discount, has_promo, promo_share))),
    h AS (SELECT hi.customer, hi.feature, hi.value AS hi, ht.value AS ht FROM hi JOIN ht ON ht.customer = hi.customer AND ht.feature = hi.feature),
    v AS (SELECT b.customer, b.feature, k.customer IS NOT NULL AS has_history, CASE WHEN k.customer IS NOT NULL THEN (i + 10 * coalesce(hi, 0)) / 11
      ELSE i END AS i, CASE WHEN k.customer IS NOT NULL AND i <= 0 THEN coalesce(ht, 0) ELSE t END AS t FROM b
      LEFT JOIN (SELECT DISTINCT customer FROM h) k ON k.customer = b.customer LEFT JOIN h ON h.customer = b.customer AND h.feature = b.feature),
    st AS (SELECT feature, si / (SELECT sum(si) FROM (VALUES {_STATIC}) z(f, si, tt)) * 0.65 AS si, tt FROM (VALUES {_STATIC}) w(feature, si, tt)),
    m AS (SELECT customer, feature, has_history, i * 0.35 AS i, t AS target FROM v UNION ALL
      SELECT customer, st.feature, has_history, si, tt FROM (SELECT DISTINCT customer, has_history FROM v), st)
    SELECT customer, feature, has_history, round(i / sum(i) OVER (PARTITION BY customer), 10) AS importance, round(target, 10) AS target FROM m""",
)
def job_33(t: Tables):
    both = [*SCALARS, *FLAGS]
    long = lambda df, name: df.select(
        "customer", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias(name)) for c in both])).alias("x")
    ).select("customer", "x.*")
    target, importance = B.user_vectors(basket_features(t), "customer", SCALARS, FLAGS)
    history = long(importance, "importance").join(long(target, "target"), ["customer", "feature"])
    s = F.explode(F.when(F.col("customer") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    c = t.customer.select(F.col("c_custkey").alias("customer")).select("customer", s.alias("concept"))
    c = c.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in both])))
    n = F.length("feature")
    concepts = c.withColumns(
        {
            "importance": F.when((n + F.col("concept")) % 3 == 0, 0).otherwise((n + F.col("concept")) % 5 + 1),
            "target": (n * F.col("concept")) % 4 / 4.0,
        }
    )
    out = B.blend_vectors(concepts, history, STATIC)
    return out.select(
        "customer", "feature", "has_history", F.round("importance", 10).alias("importance"), F.round("target", 10).alias("target")
    )


# Target of a group of features that nobody asked for.
VARIATION = {"protein": (1.0, ["size"]), "carbohydrate": (0.2, ["quantity", "discount"]), "quality": (0.9, ["has_promo", "promo_share"])}
_GROUPS = ", ".join(f"('{f}', '{g}', {v}, {len(fs)})" for g, (v, fs) in VARIATION.items() for f in fs)
_CALORIE = """CASE WHEN feature = 'is_low_calorie' AND alone THEN 1 WHEN feature = 'is_low_calorie' AND plain THEN 0.5
      WHEN feature = 'is_roede_percentage' AND NOT alone THEN 1 ELSE i END AS i, CASE WHEN feature = 'is_low_calorie' AND alone THEN 1
      WHEN feature = 'is_low_calorie' AND plain THEN 0 WHEN feature = 'is_roede_percentage' AND NOT alone THEN CAST(points AS INTEGER) ELSE t END AS t"""


@query(
    "job_33_steps",
    f"""WITH {BASKETS}, ft AS (SELECT * FROM (VALUES ('size'), ('quantity'), ('discount'), ('has_promo'), ('promo_share'), ('is_low_calorie'),
      ('is_roede_percentage')) v(feature)),
    cc AS (SELECT c_custkey AS customer, s AS concept, feature, CASE WHEN (length(feature) + s + c_custkey) % 3 = 0 THEN 0
      ELSE (length(feature) + s) % 5 + 1 END AS importance, ((length(feature) * s) % 4) / 4.0 AS target FROM customer, ft,
      (VALUES (1), (2), (3), (4)) q(s) WHERE CASE s WHEN 1 THEN c_custkey % 5 <> 0 WHEN 2 THEN c_custkey % 5 <= 1 WHEN 3 THEN c_custkey % 5 = 2
      ELSE c_custkey % 5 = 3 END),
    n1 AS (SELECT *, importance / sum(importance) OVER (PARTITION BY customer, concept) AS i FROM cc),
    b0 AS (SELECT customer, feature, coalesce(avg(i) FILTER (i > 0), 0) AS i, coalesce(sum(i * target) / nullif(sum(i), 0), 0) AS t FROM n1 GROUP BY 1, 2),
    b AS (SELECT customer, feature, i / sum(i) OVER (PARTITION BY customer) AS i, t FROM b0),
    role AS (SELECT customer, bool_and(concept = 2) AS alone, bool_or(concept = 4) AS points, bool_and(concept = 1) AS plain FROM cc GROUP BY 1),
    hi AS (SELECT customer, feature, value FROM im UNPIVOT INCLUDE NULLS (value FOR feature IN (size, quantity, discount, has_promo, promo_share))),
    ht AS (SELECT customer, feature, value FROM tg UNPIVOT (value FOR feature IN (size, quantity, discount, has_promo, promo_share))),
    h AS (SELECT hi.customer, hi.feature, hi.value AS hi, ht.value AS ht FROM hi JOIN ht ON ht.customer = hi.customer AND ht.feature = hi.feature
      WHERE hi.customer IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')),
    k AS (SELECT DISTINCT customer FROM h),
    v0 AS (SELECT b.customer, b.feature, k.customer IS NOT NULL AS has_history, CASE WHEN k.customer IS NOT NULL THEN (i + 10 * coalesce(hi, 0)) / 11
      ELSE i END AS i, CASE WHEN k.customer IS NOT NULL AND i <= 0 THEN coalesce(ht, 0) ELSE t END AS t FROM b
      LEFT JOIN k ON k.customer = b.customer LEFT JOIN h ON h.customer = b.customer AND h.feature = b.feature),
    g AS (SELECT * FROM (VALUES {_GROUPS}) y(feature, grp, value, size_of)),
    ms AS (SELECT customer, grp FROM v0 JOIN g USING (feature) WHERE NOT has_history GROUP BY 1, 2 HAVING max(i) = 0),
    nm AS (SELECT customer, count(*) AS n FROM ms GROUP BY 1),
    v1 AS (SELECT v0.customer, v0.feature, has_history, CASE WHEN ms.grp IS NULL THEN i ELSE 1.0 / n / size_of END AS i,
      CASE WHEN ms.grp IS NULL THEN t ELSE value END AS t FROM v0 LEFT JOIN g ON g.feature = v0.feature
      LEFT JOIN ms ON ms.customer = v0.customer AND ms.grp = g.grp LEFT JOIN nm ON nm.customer = v0.customer),
    v2 AS (SELECT customer, feature, has_history, CASE WHEN has_history THEN i ELSE i / sum(i) OVER (PARTITION BY customer) END AS i, t FROM v1),
    v AS (SELECT customer, feature, has_history, i, t FROM v2 WHERE has_history UNION ALL
      SELECT customer, feature, has_history, {_CALORIE} FROM v2 JOIN role USING (customer) WHERE NOT has_history),
    st AS (SELECT feature, si / (SELECT sum(si) FROM (VALUES {_STATIC}) z(f, si, tt)) * 0.65 AS si, tt FROM (VALUES {_STATIC}) w(feature, si, tt)),
    m AS (SELECT customer, feature, has_history, i * 0.35 AS i, t FROM v UNION ALL
      SELECT customer, st.feature, has_history, si, tt FROM (SELECT DISTINCT customer, has_history FROM v), st),
    m1 AS (SELECT customer, feature, has_history, i / sum(i) OVER (PARTITION BY customer) AS i, t FROM m),
    m2 AS (SELECT customer, feature, has_history, i, t FROM m1 WHERE NOT has_history UNION ALL
      SELECT customer, feature, has_history, {_CALORIE} FROM m1 JOIN role USING (customer) WHERE has_history)
    SELECT customer, feature, has_history, round(i, 10) AS importance, round(t, 10) AS target FROM m2""",
)
def job_33_steps(t: Tables):
    """Customer vectors with the variation and calorie steps; concepts 2, 3 and 4 are low-calorie, vegetarian and points.

    One market segment stands for customers who have not agreed to the use of their history.
    """
    target, importance = B.user_vectors(basket_features(t), "customer", SCALARS, FLAGS)
    long = lambda df, name: df.select(
        "customer", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias(name)) for c in [*SCALARS, *FLAGS]])).alias("x")
    ).select("customer", "x.*")
    consent = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("customer"))
    history = long(importance, "importance").join(long(target, "target"), ["customer", "feature"]).join(consent, "customer", "left_semi")
    rest = F.col("c_custkey") % 5
    chosen = [F.when(rest != 0, 1), F.when(rest <= 1, 2), F.when(rest == 2, 3), F.when(rest == 3, 4)]
    c = t.customer.select(F.col("c_custkey").alias("customer"), F.explode(F.array_compact(F.array(*chosen))).alias("concept"))
    features = [*SCALARS, *FLAGS, "is_low_calorie", "is_roede_percentage"]
    c = c.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    n = F.length("feature")
    concepts = c.withColumns(
        {
            "importance": F.when((n + F.col("concept") + F.col("customer")) % 3 == 0, 0).otherwise((n + F.col("concept")) % 5 + 1),
            "target": (n * F.col("concept")) % 4 / 4.0,
        }
    )
    out = B.blend_vectors(concepts, history, STATIC, variation=VARIATION, calorie=B.CalorieConcepts(2, 3, 4))
    return out.select(
        "customer", "feature", "has_history", F.round("importance", 10).alias("importance"), F.round("target", 10).alias("target")
    )


def _preference_menus(t: Tables):
    entry = F.struct("item", F.concat("allergens", "tastes").alias("preferences"))
    return menus(t).groupBy("company", "slot").agg(F.array_sort(F.collect_list(entry)).alias("menu"))


@query(
    "job_34",
    f"""WITH {MENUS}, c AS (SELECT DISTINCT o_custkey AS customer, c_nationkey AS company,
      CAST(((CAST(date_trunc('week', o_orderdate) AS DATE) - DATE '1995-01-02') // 7) % 8 AS INTEGER) AS slot,
      CAST(isoyear(o_orderdate) * 100 + weekofyear(o_orderdate) AS INTEGER) AS yw FROM orders JOIN customer ON o_custkey = c_custkey),
    n AS (SELECT ['anvil','bolt','gear','gizmo','plate','ring','rod','widget'] AS nouns),
    j AS (SELECT c.*, item, NOT (customer % 3 = 0 AND noun = nouns[customer % 8 + 1]) AS safe,
      NOT (customer % 3 = 0 AND noun = nouns[customer % 8 + 1]) AND noun <> nouns[(customer + 1) % 8 + 1] AS ok FROM c
      JOIN menus ON c.company = menus.company AND c.slot = menus.slot, n),
    s AS (SELECT *, count(*) FILTER (ok) OVER w AS n_ok, count(*) FILTER (safe) OVER w AS n_safe FROM j
      WINDOW w AS (PARTITION BY customer, yw)),
    l AS (SELECT *, CASE WHEN n_ok >= 4 THEN 3 WHEN n_safe >= 4 THEN 2 ELSE 1 END AS compliancy FROM s)
    SELECT customer, yw, compliancy, string_agg(item, ',' ORDER BY item) FILTER (CASE compliancy WHEN 3 THEN ok WHEN 2 THEN safe
    ELSE true END) AS items FROM l GROUP BY 1, 2, 3""",
)
def job_34(t: Tables):
    none = F.array().cast("array<string>")
    c = subscribers(t).select(
        "company",
        "slot",
        F.struct("customer", "yw").alias("customer"),
        F.coalesce("allergens", none).alias("allergies"),
        F.array_compact("tastes").alias("dislikes"),
    )
    out = B.filter_cascade(c, _preference_menus(t), ["company", "slot"], F.lit(4))
    return out.select("customer.customer", "customer.yw", "compliancy", F.array_join("items", ",").alias("items"))


@query(
    "job_35",
    f"""WITH {BUY}, w AS (SELECT "user" AS customer, name AS item, CAST(date_trunc('week', o_orderdate) AS DATE) AS m FROM buy),
    l AS (SELECT customer, item, max(m) AS m FROM w WHERE (DATE '2001-07-30' - m) // 7 BETWEEN 0 AND 26 AND m <= DATE '2001-07-30' GROUP BY 1, 2)
    SELECT customer, item, CAST(isoyear(m) * 100 + weekofyear(m) AS INTEGER) AS last_order_week,
    CAST((DATE '2001-07-30' - m) // 7 AS INTEGER) AS weeks_ago,
    round(log2(greatest(26 - (DATE '2001-07-30' - m) // 7, 1)) / log2(26), 6) AS ordered_ago FROM l""",
)
def job_35(t: Tables):
    orders = purchases(t).select(
        F.col("user").alias("customer"), F.col("name").alias("item"), year_week("o_orderdate").alias("year_week")
    )
    out = B.last_order_week(orders, 26, F.lit(200131))
    return out.withColumn("ordered_ago", F.round("ordered_ago", 6))


@query(
    "job_36",
    """WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END AS size, p_retailprice AS price,
      CAST(length(p_brand) AS DOUBLE) AS fixed FROM part),
    g AS (SELECT *, max(coalesce(size, 0)) OVER w AS hs, min(coalesce(size, 10000)) OVER w AS ls, max(price) OVER w AS hp,
      min(price) OVER w AS lp FROM p WINDOW w AS (PARTITION BY p_brand))
    SELECT p_partkey, round(coalesce((size - ls) / nullif(hs - ls, 0), 0), 8) AS size,
    round(coalesce((price - lp) / nullif(hp - lp, 0), 0), 8) AS price, 0.0::DOUBLE AS fixed FROM g""",
)
def job_36(t: Tables):
    p = t.part.select(
        "p_partkey",
        "p_brand",
        F.when(F.col("p_partkey") % 9 != 0, F.col("p_size")).alias("size"),
        F.col("p_retailprice").alias("price"),
        F.length("p_brand").cast("double").alias("fixed"),
    )
    out = B.minmax_by_group(p, ["p_brand"], ["size", "price", "fixed"])
    return out.select("p_partkey", *[F.round(c, 8).alias(c) for c in ("size", "price", "fixed")])


@query(
    "job_37",
    f"""WITH {DISHES}, it AS (SELECT company, split_part(name, ' ', 1) AS colour, split_part(name, ' ', 2) AS noun, kind FROM dishes),
    cur AS (SELECT * FROM it WHERE colour = 'small'),
    g AS (SELECT c_nationkey AS company, CAST(c_custkey % 8 AS INTEGER) AS a, count(*) AS n_users, round(sum(greatest(c_acctbal, 0)), 2) AS value FROM customer
      WHERE c_nationkey IN (SELECT company FROM cur) GROUP BY 1, 2),
    pr AS (SELECT *, ['anvil','bolt','gear','gizmo','plate','ring','rod','widget'][a + 1] AS p1, ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][a % 6 + 1] AS p2 FROM g),
    mt AS (SELECT pr.company, a, cur.noun, cur.kind, EXISTS (SELECT 1 FROM it o WHERE o.company = pr.company AND o.colour = 'red' AND o.noun = cur.noun) AS r,
      EXISTS (SELECT 1 FROM it o WHERE o.company = pr.company AND o.colour = 'old' AND o.noun = cur.noun) AS o
      FROM pr JOIN cur ON cur.company = pr.company AND noun <> p1 AND kind <> p2),
    kc AS (SELECT company, a, kind, count(*) AS c FROM mt GROUP BY 1, 2, 3),
    en AS (SELECT company, a, -sum(c / n * log2(c / n)) AS h, max(c) AS top, count(*) AS kinds, max(n) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY company, a) AS n FROM kc) GROUP BY 1, 2),
    ov AS (SELECT company, a, count(*) AS n_items, count(*) FILTER (r) AS o1, count(*) FILTER (r AND o) AS o2 FROM mt GROUP BY 1, 2)
    SELECT pr.company, a AS "group", n_users, coalesce(n_items, 0) AS n_items, coalesce(n_items, 0) < 3 AS is_critical,
    CASE coalesce(n_items, 0) // 3 WHEN 0 THEN coalesce(n_items, 0) WHEN 1 THEN o1 WHEN 2 THEN o2 ELSE 0 END AS n_overlap,
    round(coalesce(h, 0) / log2(5), 6) AS entropy_score, 5 - coalesce(kinds, 0) >= 2 AS misses_variety, coalesce(top / n, 0) >= 1.8 / 5 AS is_skewed,
    round(n_users / sum(n_users) OVER (PARTITION BY pr.company), 6) AS share_of_users,
    round(value / nullif(sum(value) OVER (PARTITION BY pr.company), 0), 6) AS share_of_value
    FROM pr LEFT JOIN en USING (company, a) LEFT JOIN ov USING (company, a)""",
)
def job_37(t: Tables):
    d = dishes(t).select("company", F.split("name", " ")[0].alias("colour"), F.split("name", " ")[1].alias("noun"), "kind")
    entry = F.struct(F.col("noun").alias("item"), F.col("kind").alias("ingredient"), F.array("noun", "kind").alias("preferences"))
    current = d.where("colour = 'small'").groupBy("company").agg(F.array_sort(F.collect_list(entry)).alias("menu"))
    week = lambda c: F.collect_set(F.when(F.col("colour") == c, F.col("noun")))
    previous = d.groupBy("company").agg(F.array(week("red"), week("old")).alias("weeks"))
    nouns = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    g = t.customer.groupBy(F.col("c_nationkey").alias("company"), (F.col("c_custkey") % 8).cast("int").alias("group")).agg(
        F.count("*").alias("n_users"), F.round(F.sum(F.greatest("c_acctbal", F.lit(0.0))), 2).alias("value")
    )
    at = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))
    g = g.withColumn("preferences", F.array(at(nouns, F.col("group")), at(kinds, F.col("group"))))
    out = B.menu_feedback(g, current, ["company"], previous, kinds, max_basket=3, max_weeks=2)
    return out.select(
        "company", "group", "n_users", "n_items", "is_critical", "n_overlap", F.round("entropy_score", 6).alias("entropy_score"),
        "misses_variety", "is_skewed", F.round("share_of_users", 6).alias("share_of_users"),
        F.round("share_of_value", 6).alias("share_of_value"),
    )


@query(
    "job_44",
    """WITH u AS (SELECT p_partkey AS item, [split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] AS tags, p_type, CAST(p_size % 5 AS VARCHAR) AS band FROM part),
    a AS (SELECT * FROM u WHERE item % 7 = 0),
    lu AS (SELECT item, tag, 'p_type' AS col, p_type AS k FROM (SELECT *, unnest(tags) AS tag FROM u) UNION ALL
      SELECT item, tag, 'band', band FROM (SELECT *, unnest(tags) AS tag FROM u)),
    ru AS (SELECT DISTINCT tag, col, k, CASE col WHEN 'band' THEN 9 ELSE 7 END AS req FROM lu WHERE tag IN ('red', 'ring', 'rod')),
    h AS (SELECT tag, col, k, count(*) AS n FROM lu WHERE item % 7 = 0 GROUP BY ALL),
    gp AS (SELECT ru.tag, ru.col, ru.k, req - coalesce(n, 0) AS gap FROM ru LEFT JOIN h ON h.tag = ru.tag AND h.col = ru.col AND h.k = ru.k
      WHERE req > coalesce(n, 0)),
    o AS (SELECT lu.item, gap, row_number() OVER (PARTITION BY lu.tag, lu.col, lu.k ORDER BY lu.item) AS rn FROM lu JOIN gp ON gp.tag = lu.tag AND gp.col = lu.col
      AND gp.k = lu.k JOIN u ON u.item = lu.item WHERE lu.item % 7 <> 0 AND NOT list_contains(tags, 'cold'))
    SELECT item, p_type, band FROM a UNION ALL SELECT item, p_type, band FROM u WHERE item IN (SELECT item FROM o WHERE rn <= 2 * gap)""",
)
def job_44(t: Tables):
    u = t.part.select(
        F.col("p_partkey").alias("item"), F.split("p_name", " ").alias("tags"), "p_type", (F.col("p_size") % 5).cast("string").alias("band")
    )
    required = F.when(F.col("column") == "band", 9).otherwise(7)
    rules = M.constraint_rows(u, ["p_type", "band"]).where(F.col("tag").isin("red", "ring", "rod"))
    rules = rules.select("tag", "column", "key").distinct().withColumn("required", required)
    return M.supplement_items(u.where("item % 7 = 0"), u, rules, ["p_type", "band"], ["cold"]).drop("tags")


@query(
    "job_45",
    """WITH l AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN 'carb' ELSE 'protein' END AS role, split_part(p_name, ' ', 1) AS mg,
      lower(p_type) AS cg, split_part(p_name, ' ', 2) AS pg FROM lineitem JOIN part ON l_partkey = p_partkey),
    n AS (SELECT DISTINCT l_orderkey, role, CASE WHEN role = 'carb' THEN CASE WHEN cg IN ('promo', 'small') THEN cg ELSE pg END
      ELSE CASE WHEN mg IN ('red', 'blue') THEN mg ELSE cg END END AS nm FROM l)
    SELECT l_orderkey, coalesce(string_agg(nm, ',' ORDER BY nm) FILTER (role = 'carb'), 'none') AS main_carbs,
    coalesce(string_agg(nm, ',' ORDER BY nm) FILTER (role = 'protein'), 'unknown') AS main_proteins FROM n GROUP BY 1""",
)
def job_45(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        F.when(F.col("l_linenumber") % 2 == 0, "carb").otherwise("protein").alias("role"),
        F.split("p_name", " ")[0].alias("main_group"),
        F.col("p_type").alias("category_group"),
        F.split("p_name", " ")[1].alias("product_group"),
    )
    fills = {"main_carbs": F.array(F.lit("none")), "main_proteins": F.array(F.lit("unknown"))}
    out = M.prepare_items(lines, "l_orderkey", ["promo", "small"], ["red", "blue"], fills)
    return out.select("l_orderkey", *[F.array_join(c, ",").alias(c) for c in ("main_carbs", "main_proteins")])


@query(
    "job_46",
    """WITH p AS (SELECT l_orderkey, l_partkey, sum(l_quantity * 0.25) AS q, max(p_retailprice) AS c, sum(l_tax) AS co2, max(p_type) AS cat,
      max(p_size) > 25 AS main FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
    SELECT l_orderkey, round(sum(q * c), 4) AS cost, round(sum(ceil(q) * c), 4) AS cost_whole_units, round(sum(co2), 4) AS co2,
    arg_max(cat, (q * c, l_partkey)) FILTER (main) AS main_category FROM p GROUP BY 1""",
)
def job_46(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        F.col("l_partkey").alias("ingredient"),
        (F.col("l_quantity") * 0.25).alias("quantity"),
        F.col("p_retailprice").alias("unit_cost"),
        F.col("l_tax").alias("co2"),
        F.col("p_type").alias("category"),
        (F.col("p_size") > 25).alias("is_main"),
    )
    out = M.item_costs(lines, "l_orderkey")
    return out.select(
        "l_orderkey", *[F.round(c, 4).alias(c) for c in ("cost", "cost_whole_units", "co2")], "main_category"
    )


@query(
    "job_47",
    """WITH i AS (SELECT l_orderkey, l_partkey FROM lineitem), a AS (SELECT p_partkey, p_type FROM part WHERE p_size % 4 = 0 AND p_size % 3 <> 0),
    pr AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS pref FROM orders WHERE o_orderkey % 2 = 0),
    r AS (SELECT l_orderkey AS k, p_type AS pref FROM i JOIN a ON l_partkey = p_partkey UNION SELECT o_orderkey, pref FROM pr WHERE pref IS NOT NULL
      UNION SELECT k, 'DEFAULT' FROM (SELECT l_orderkey AS k FROM i JOIN a ON l_partkey = p_partkey UNION SELECT o_orderkey FROM pr)
      WHERE k NOT IN (SELECT o_orderkey FROM pr WHERE pref IS NOT NULL))
    SELECT k AS "order", string_agg(pref, ',' ORDER BY pref) AS preferences FROM r GROUP BY 1""",
)
def job_47(t: Tables):
    ingredients = t.lineitem.select(F.col("l_orderkey").alias("order"), F.col("l_partkey").alias("ingredient"))
    allergies = t.part.where("p_size % 4 = 0").select(
        F.col("p_partkey").alias("ingredient"), F.col("p_type").alias("preference"), (F.col("p_size") % 3 == 0).alias("is_trace")
    )
    own = t.orders.where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").alias("order"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("preference")
    )
    out = M.item_preferences(ingredients, allergies, own, ["order"], "DEFAULT")
    return out.select("order", F.array_join("preferences", ",").alias("preferences"))


@query(
    "job_51",
    """WITH l AS (SELECT o_custkey, max(CAST(date_trunc('week', o_orderdate) AS DATE) + 7) AS last, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS k
      FROM orders GROUP BY 1),
    p AS (SELECT o_custkey, count(*) AS n_items, CAST(2 + o_custkey % 4 AS INTEGER) AS portions FROM l LEFT JOIN lineitem ON l_orderkey = k GROUP BY 1)
    SELECT c_custkey AS customer, c_nationkey AS company, n_items, portions, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE '' END
    AS concepts, CAST(DATE '2001-09-01' - last AS INTEGER) AS days_since_last_delivery, '200136,200137' AS weeks FROM customer
    JOIN p ON p.o_custkey = c_custkey JOIN l ON l.o_custkey = c_custkey WHERE portions IN (2, 4)""",
)
def job_51(t: Tables):
    newest = t.orders.groupBy(F.col("o_custkey").alias("customer")).agg(
        F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("l_orderkey")
    )
    products = newest.join(t.lineitem, "l_orderkey", "left").groupBy("customer").agg(F.count("*").alias("n_items"))
    products = products.withColumn("portions", (2 + F.col("customer") % 4).cast("int"))
    seg = F.col("c_mktsegment")
    customers = t.customer.select(F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("company"), seg.alias("combination"))
    prefs = t.customer.where(seg != "BUILDING").select(seg.alias("combination"), F.array(seg).alias("concepts"), F.array(seg).alias("tastes")).distinct()
    out = B.build_requests(
        customers, products, menu_orders(t), prefs, [200136, 200137], [2, 4], F.lit("2001-09-01").cast("date")
    )
    return out.select(
        "customer", "company", "n_items", "portions", F.array_join("concepts", ",").alias("concepts"),
        "days_since_last_delivery", F.array_join(F.col("weeks").cast("array<string>"), ",").alias("weeks"),
    )
