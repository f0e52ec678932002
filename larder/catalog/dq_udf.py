"""Data-quality checks and the user-function surface."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.catalog.scd import _SPANS, spans
from larder.functions.arrays import has_intersection
from larder.operators import quality as D
from larder.operators import scoring


@query(
    "dq_01",
    """SELECT 'unique' AS rule, CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS what, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'accepted', o_orderstatus, count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 2
    UNION ALL SELECT 'fk', CAST(o_custkey AS VARCHAR), count(*) FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) GROUP BY 2
    UNION ALL SELECT 'not_null', 'c_rich', count(*) FROM customer WHERE c_acctbal <= 0""",
)
def dq_01(t: Tables):
    u = D.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"]).select(
        F.lit("unique").alias("rule"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("what"), "n"
    )
    a = D.check_accepted(t.orders, "o_orderstatus", ["O", "F"]).select(
        F.lit("accepted").alias("rule"), F.col("o_orderstatus").alias("what"), "n"
    )
    k = D.check_fk(t.orders, "o_custkey", t.customer.where("c_nationkey < 20"), "c_custkey").select(
        F.lit("fk").alias("rule"), F.col("o_custkey").cast("string").alias("what"), "n"
    )
    rich = t.customer.withColumn("c_rich", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    n = D.check_not_null(rich, ["c_custkey", "c_name", "c_rich"]).select(
        F.lit("not_null").alias("rule"), F.col("column").alias("what"), F.col("n_null").alias("n")
    )
    return u.unionByName(a).unionByName(k).unionByName(n)


@query("dq_02", "SELECT * FROM (VALUES ('X'), ('F'), ('Y')) v(o_orderstatus) WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM orders)")
def dq_02(t: Tables):
    return D.check_required(t.orders, "o_orderstatus", ["X", "F", "Y"])


@query(
    "dq_03",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem
    WHERE l_returnflag = 'R' AND l_discount IS DISTINCT FROM l_tax""",
)
def dq_03(t: Tables):
    cols = ("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return D.check_equal(t.lineitem, "l_discount", "l_tax", "l_returnflag = 'R'").select(*cols)


@query(
    "dq_04",
    f"""WITH {_SPANS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_from, event_id) AS a,
      row_number() OVER (PARTITION BY user_id ORDER BY valid_to, event_id) AS b FROM spans)
    SELECT event_id, a AS rn_valid_from, b AS rn_valid_to FROM r WHERE a <> b""",
)
def dq_04(t: Tables):
    bad = D.check_rank_consistent(spans(t), ["user_id"], ["valid_from", "valid_to"], ["event_id"])
    return bad.select("event_id", "rn_valid_from", "rn_valid_to")


@query(
    "dq_05",
    """SELECT 'adjustment' AS rule, CAST(l_orderkey AS VARCHAR) AS what FROM lineitem WHERE l_returnflag = 'R'
      GROUP BY l_orderkey HAVING count(*) > 1
    UNION ALL SELECT 'no item', CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_partkey NOT IN
      (SELECT p_partkey FROM part WHERE p_size < 50) GROUP BY l_orderkey
    UNION ALL SELECT 'counts', x FROM (VALUES ('customers'), ('suppliers')) v(x)
      WHERE (SELECT count(*) FROM customer) <> (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'total', CAST(o_orderkey AS VARCHAR) FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      GROUP BY o_orderkey, o_totalprice HAVING abs(o_totalprice - sum(l_extendedprice)) > 200
    UNION ALL SELECT 'postal', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey < 5
      AND length(CAST(c_custkey AS VARCHAR)) <> 4
    UNION ALL SELECT 'coverage', n || '/' || y FROM (SELECT n_nationkey AS n, y FROM nation, range(1995, 2003) r(y)) e
      WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n
        AND year(o_orderdate) = y)""",
)
def dq_05(t: Tables):
    text = lambda df, rule, col: df.select(F.lit(rule).alias("rule"), F.col(col).cast("string").alias("what"))
    one = D.check_at_most_one(t.lineitem, "l_orderkey", F.col("l_returnflag") == "R")
    items = t.part.where("p_size < 50").select(F.col("p_partkey").alias("l_partkey"))
    orphan = t.lineitem.join(items, "l_partkey", "left_anti").select("l_orderkey").distinct()
    counts = D.check_row_counts(customers=t.customer, suppliers=t.supplier)
    totals = D.check_header_total(
        t.orders, t.lineitem, ("o_orderkey", "l_orderkey"), "o_totalprice", F.col("l_extendedprice"), 200.0
    )
    country = F.when(F.col("c_nationkey") < 5, "short").otherwise("free")
    postal = D.check_length(t.customer, F.col("c_custkey").cast("string"), {"short": 4}, country)
    expected = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.explode(F.sequence(F.lit(1995), F.lit(2002))).alias("y")
    )
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey", F.year("o_orderdate").alias("y")
    )
    gaps = D.check_coverage(placed, ["c_nationkey", "y"], expected).withColumn(
        "what", F.concat_ws("/", "c_nationkey", "y")
    )
    out = text(one, "adjustment", "l_orderkey")
    for part in (
        text(orphan, "no item", "l_orderkey"),
        text(counts, "counts", "frame"),
        text(totals, "total", "o_orderkey"),
        text(postal, "postal", "c_custkey"),
        text(gaps, "coverage", "what"),
    ):
        out = out.unionByName(part)
    return out


@query(
    "dq_06",
    """SELECT 'o_orderkey' AS "column", 'bigint' AS declared, false AS is_missing, CAST(0 AS BIGINT) AS n_bad
    UNION ALL SELECT 'o_orderstatus', 'int', false, count(*) FROM orders WHERE TRY_CAST(o_orderstatus AS INTEGER) IS NULL
    UNION ALL SELECT 'o_clerk', 'string', true, 0""",
)
def dq_06(t: Tables):
    return D.check_contract(t.orders, {"o_orderkey": "bigint", "o_orderstatus": "int", "o_clerk": "string"})


@query(
    "dq_07",
    """WITH l AS (SELECT l_orderkey, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
    r AS (SELECT l_orderkey, max(n) AS rep FROM (SELECT l_orderkey, p_type, count(*) AS n FROM l GROUP BY 1, 2) GROUP BY 1),
    b AS (SELECT l_orderkey, count(*) AS n_items, avg(l_discount) AS error, CASE WHEN max(l_tax) >= 0.08 THEN 1
      WHEN max(l_tax) >= 0.06 THEN 2 ELSE 3 END AS compliancy FROM lineitem GROUP BY 1),
    j AS (SELECT b.*, rep, o_orderpriority FROM b JOIN r USING (l_orderkey) JOIN orders ON l_orderkey = o_orderkey)
    SELECT o_orderpriority, count(*) AS total, count(*) FILTER (compliancy = 1) AS broken_allergen,
    round(count(*) FILTER (compliancy = 1) / count(*) * 100, 2) AS percentage_allergen,
    count(*) FILTER (compliancy = 2) AS broken_preference,
    round(count(*) FILTER (compliancy = 2) / count(*) * 100, 2) AS percentage_preference,
    count(*) FILTER (error > 0.0601) AS broken_error, round(count(*) FILTER (error > 0.0601) / count(*) * 100, 2)
    AS percentage_error, count(*) FILTER (rep / n_items > 0.6) AS broken_repetition,
    round(count(*) FILTER (rep / n_items > 0.6) / count(*) * 100, 2) AS percentage_repetition FROM j GROUP BY 1""",
)
def dq_07(t: Tables):
    worst = F.max("l_tax")
    b = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n_items"),
        F.avg("l_discount").alias("error"),
        F.when(worst >= 0.08, 1).when(worst >= 0.06, 2).otherwise(3).alias("compliancy"),
    )
    baskets = b.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*b.columns, "o_orderpriority")
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type")
    return D.validate_outputs(
        baskets, lines, "l_orderkey", ["o_orderpriority"], "p_type", {"error": 0.0601, "repetition": 0.6}
    )


@query(
    "dq_07_concept",
    """WITH b AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
    g AS (SELECT l_orderkey, max(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) AS hit FROM lineitem
      JOIN part ON l_partkey = p_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM b) GROUP BY 1)
    SELECT round(sum(hit) / count(*), 8) AS unwanted_share FROM g""",
)
def dq_07_concept(t: Tables):
    baskets = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type")
    out = D.unwanted_share(
        baskets, lines, "l_orderkey", F.col("o_orderstatus") == "P", F.col("p_type") == "PROMO"
    )
    return out.select(F.round("unwanted_share", 8).alias("unwanted_share"))


@query(
    "dq_08",
    """SELECT 'quality' AS "column", false AS is_missing, count(*) FILTER (quality IS NULL) AS n_null,
    count(*) FILTER (quality > 0) AS n_outside FROM labels
    UNION ALL SELECT 'toxic', false, count(*) FILTER (toxic IS NULL), 0 FROM labels
    UNION ALL SELECT 'score', true, 0, 0""",
)
def dq_08(t: Tables):
    return D.validate_features(t.labels, ["quality", "toxic", "score"], {"quality": (0, 0)})


@query(
    "udf_01",
    """WITH a AS (SELECT l_orderkey, list(l_partkey) AS p, list(l_suppkey) AS s FROM lineitem GROUP BY 1)
    SELECT l_orderkey, len(list_intersect(p, s)) > 0 AS shares FROM a""",
)
def udf_01(t: Tables):
    a = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("p"), F.collect_set("l_suppkey").alias("s"))
    return a.select("l_orderkey", has_intersection(F.col("p"), F.col("s")).alias("shares"))


@query(
    "udf_02",
    """SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS order_list FROM orders
    GROUP BY o_custkey""",
)
def udf_02(t: Tables):
    out = scoring.sorted_lists(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey", "l")
    return out.select("o_custkey", F.array_join(F.col("l").cast("array<string>"), ",").alias("order_list"))


@query(
    "udf_03",
    """WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents),
    c AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY 1, 2)
    SELECT doc_id, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy FROM c GROUP BY doc_id""",
)
def udf_03(t: Tables):
    words = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return scoring.entropy(words, ["doc_id"], "w").withColumn("entropy", F.round("entropy", 6))


@query(
    "udf_04",
    """SELECT vec_id, label, round(1 / (1 + exp(-sum(embedding[i]::DOUBLE * (i - 32) / 64))), 6) AS prediction
    FROM embeddings, range(1, 65) r(i) GROUP BY vec_id, label""",
)
def udf_04(t: Tables):
    weights = (np.arange(1, 65) - 32) / 64
    model = lambda x: 1 / (1 + np.exp(-(x @ weights)))
    out = scoring.infer_over(t.embeddings, ["vec_id", "label"], "embedding", model)
    return out.withColumn("prediction", F.round("prediction", 6))


@query(
    "udf_05",
    """SELECT l_orderkey, round(avg(l_discount), 8) AS mean_discount, max(l_quantity) AS top_quantity, count(*) AS n
    FROM lineitem GROUP BY l_orderkey""",
)
def udf_05(t: Tables):
    return scoring.aggregate_views(
        t.lineitem,
        ["l_orderkey"],
        {
            "mean_discount": F.round(F.avg("l_discount"), 8),
            "top_quantity": F.max("l_quantity"),
            "n": F.count("*"),
        },
    )
