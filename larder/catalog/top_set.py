"""Top-k, de-duplication and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.jn import WEEKLY, weekly_orders
from larder.catalog.registry import Tables, query
from larder.catalog.scd import STATES, states
from larder.functions import vectors
from larder.operators import sets as S
from larder.operators import topk


@query(
    "top_01",
    "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def top_01(t: Tables):
    return topk.latest(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "top_02",
    """SELECT user_id, CAST(ts AS DATE) AS day, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
)
def top_02(t: Tables):
    ev = t.events.select("user_id", "event_id", "ts", "value")
    return topk.first_per_day(ev, ["user_id"], "ts", ["event_id"])


@query(
    "top_03",
    """WITH s AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
    SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY qty DESC, l_partkey) AS INTEGER) AS rank FROM s
    QUALIFY rank <= 5""",
)
def top_03(t: Tables):
    s = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return topk.top_k(s, ["l_suppkey"], [F.desc("qty"), F.col("l_partkey")], 5)


@query(
    "top_04",
    """SELECT o_custkey, o_orderstatus, o_orderkey, o_orderdate, 'last' AS kind FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    UNION ALL SELECT DISTINCT NULL, o_orderstatus, NULL, NULL, 'distinct' FROM orders""",
)
def top_04(t: Tables):
    o = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate")
    last = topk.dedupe(o, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"], "last")
    plain = topk.dedupe(t.orders.select("o_orderstatus"), ["o_orderstatus"])
    return last.withColumn("kind", F.lit("last")).unionByName(
        plain.withColumn("kind", F.lit("distinct")), allowMissingColumns=True
    )


@query(
    "top_05",
    """WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)),
    d AS (SELECT vec_id, label, sum((10 * (embedding[i]::DOUBLE - q.e[i]::DOUBLE)) ** 2) AS distance
      FROM embeddings, q, range(1, 65) r(i) WHERE vec_id > (SELECT min(vec_id) FROM embeddings) GROUP BY 1, 2)
    SELECT vec_id, label, round(distance, 6) AS distance FROM d ORDER BY distance, vec_id LIMIT 1""",
)
def top_05(t: Tables):
    first = t.embeddings.agg(F.min_by(F.transform("embedding", lambda x: x.cast("double")), "vec_id")).scalar()
    lowest = t.embeddings.agg(F.min("vec_id")).scalar()
    target = t.embeddings.where(F.col("vec_id") > lowest).withColumn("target", first)
    ones = F.transform("target", lambda x: F.lit(1.0))
    dist = vectors.weighted_distance(F.transform("embedding", lambda x: x.cast("double")), F.col("target"), ones)
    hit = topk.nearest(target.withColumn("d", dist).select("vec_id", "label", "d"), F.col("d"), "vec_id")
    return hit.select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query(
    "top_06",
    f"""WITH {WEEKLY}, y AS (SELECT *, year * 100 + week AS yw FROM weekly)
    SELECT company, yw, orders FROM y WHERE yw IN (SELECT DISTINCT yw FROM y ORDER BY yw DESC LIMIT 6)""",
)
def top_06(t: Tables):
    w = weekly_orders(t).select("company", (F.col("year") * 100 + F.col("week")).alias("yw"), "orders")
    return topk.last_n_periods(w, "yw", 6)


@query(
    "top_07",
    """WITH s AS (SELECT user_id, event_type, avg(value) AS score FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) AS rn FROM s WHERE score > 20)
    SELECT u.user_id, coalesce(string_agg(r.event_type, ',' ORDER BY rn), '') AS labels FROM (SELECT DISTINCT user_id FROM s) u
    LEFT JOIN r ON u.user_id = r.user_id AND rn <= 3 GROUP BY u.user_id""",
)
def top_07(t: Tables):
    s = t.events.groupBy("user_id", F.col("event_type").alias("label")).agg(F.avg("value").alias("score"))
    lists = s.groupBy("user_id").agg(F.collect_list(F.struct("score", "label")).alias("s"))
    best = topk.top_labels(F.col("s"), 20.0, 3)
    return lists.select("user_id", F.array_join(F.transform(best, lambda x: x["label"]), ",").alias("labels"))


@query(
    "set_01",
    """SELECT o_orderkey, o_orderstatus, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, 'X', o_totalprice FROM orders WHERE o_totalprice > 400000""",
)
def set_01(t: Tables):
    o = t.orders
    return S.union_all(
        o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("amount")),
        o.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus"),
        o.where("o_totalprice > 400000").select(
            "o_orderkey", F.lit("X").alias("o_orderstatus"), F.col("o_totalprice").alias("amount")
        ),
    )


@query(
    "set_02",
    f"""WITH {STATES} SELECT user_id, CAST(valid_from AS DATE) AS point FROM states
    UNION SELECT user_id, CAST(valid_to AS DATE) FROM states""",
)
def set_02(t: Tables):
    s = states(t)
    return S.union_distinct(
        s.select("user_id", F.to_date("valid_from").alias("point")),
        s.select("user_id", F.to_date("valid_to").alias("point")),
    )


@query("set_03", "SELECT event_id, user_id, 'shard_' || (user_id % 4) AS tenant FROM events")
def set_03(t: Tables):
    shards = {f"shard_{i}": t.events.where(F.col("user_id") % 4 == i).select("event_id", "user_id") for i in range(4)}
    return S.union_tenants(shards)


@query(
    "set_04",
    f"""WITH {STATES}, src AS (SELECT * FROM states WHERE valid_from >= TIMESTAMP '2024-01-15' AND user_id % 3 > 0),
    f AS (SELECT user_id, min(valid_from) AS first FROM src GROUP BY user_id)
    SELECT h.user_id, h.event_id, h.state, h.valid_from, CASE WHEN first < h.valid_to THEN first ELSE h.valid_to END AS valid_to
    FROM states h LEFT JOIN f ON h.user_id = f.user_id WHERE first IS NULL OR h.valid_from < first
    UNION ALL SELECT user_id, event_id, state, valid_from, valid_to FROM src""",
)
def set_04(t: Tables):
    s = states(t)
    cut = F.expr("timestamp_ntz'2024-01-15 00:00:00'")
    return S.stitch_history(s.where((F.col("valid_from") >= cut) & (F.col("user_id") % 3 > 0)), s, "user_id")


@query(
    "set_05",
    """WITH l AS (SELECT l_orderkey, list_sort(list_distinct(list(l_partkey))) AS p,
      list_sort(list_distinct(list(l_suppkey))) AS s FROM lineitem GROUP BY 1)
    SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_concat(p, s))), ',') AS united,
    array_to_string(list_sort(list_intersect(p, s)), ',') AS common,
    array_to_string([x for x in p if NOT list_contains(s, x)], ',') AS only_left,
    len(list_intersect(p, s)) > 0 AS overlap FROM l""",
)
def set_05(t: Tables):
    l = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_set("l_partkey").alias("p"), F.collect_set("l_suppkey").alias("s")
    )
    ops = S.array_ops(F.col("p"), F.col("s"))
    text = [F.array_join(ops[n].cast("array<string>"), ",").alias(n) for n in ("united", "common", "only_left")]
    return l.select("l_orderkey", *text, ops["overlap"].alias("overlap"))


@query(
    "set_06",
    """WITH d AS (SELECT c_nationkey, avg(c_acctbal) AS bal FROM customer GROUP BY 1)
    SELECT c_custkey, customer.c_nationkey, round(CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE bal END, 6) AS bal
    FROM customer JOIN d ON customer.c_nationkey = d.c_nationkey""",
)
def set_06(t: Tables):
    defaults = t.customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("bal"), F.lit(None).cast("long").alias("c_custkey"))
    own = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return S.fill_from_defaults(own, defaults, ["c_nationkey"]).withColumn("bal", F.round("bal", 6))


@query(
    "set_07",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN 'missing in b' ELSE 'differs' END AS kind,
    CASE WHEN o_orderkey % 50 = 1 THEN 'o_orderstatus,o_totalprice' WHEN o_orderkey % 20 = 0 AND o_orderstatus <> 'X'
    THEN 'o_orderstatus' || CASE WHEN o_orderkey % 30 = 0 THEN ',o_totalprice' ELSE '' END ELSE 'o_totalprice' END AS columns
    FROM orders WHERE o_orderkey % 50 = 1 OR o_orderkey % 20 = 0 OR o_orderkey % 30 = 0""",
)
def set_07(t: Tables):
    k = F.col("o_orderkey")
    other = t.orders.where(k % 50 != 1).select(
        "o_orderkey",
        F.when(k % 20 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 30 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )
    return S.reconcile(t.orders, other, "o_orderkey", ["o_orderstatus", "o_totalprice"])
