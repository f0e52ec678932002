"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.session import shared_dir
from larder.sources import export, keyed, sinks, tables
from larder.sources.tables import Source


@query("src_01", "SELECT * FROM orders")
def src_01(t: Tables):
    out = shared_dir(t.spark, "src_01")
    sinks.load(tables.read(t.spark, Source("parquet", {"path": t.folder}), "orders"), out)
    return t.spark.read.parquet(out)


@query(
    "src_02",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1998-01-01'
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < DATE '1996-01-01'""",
)
def src_02(t: Tables):
    source = Source("parquet", {"path": t.folder})
    out = shared_dir(t.spark, "src_02")
    cols = ("o_orderkey", "o_custkey", "o_totalprice")
    sinks.load(tables.read_query(t.spark, source, "orders", "o_orderdate >= DATE'1998-01-01'", cols), out)
    sinks.load(
        tables.read_query(t.spark, source, "orders", "o_orderdate < DATE'1996-01-01'", cols), out, append_rows=True
    )
    return t.spark.read.parquet(out)


@query(
    "src_03",
    """WITH sink AS (SELECT * FROM orders WHERE o_orderdate < DATE '2001-01-01'),
    start AS (SELECT CAST(max(o_orderdate) AS DATE) - 45 AS d FROM sink),
    parents AS (SELECT o_orderkey FROM orders, start WHERE CAST(o_orderdate AS DATE) >= d)
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM parents)""",
)
def src_03(t: Tables):
    sink = t.orders.where(F.col("o_orderdate") < "2001-01-01")
    _, lines = tables.changed_since(t.orders, sink, "o_orderdate", 45, t.lineitem, ("o_orderkey", "l_orderkey"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("src_04", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def src_04(t: Tables):
    return tables.sql(
        t.spark, "SELECT n_name, r_name FROM {n} JOIN {r} ON n_regionkey = r_regionkey", n=t.nation, r=t.region
    )


@query(
    "src_05",
    """SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type = 'view'""",
)
def src_05(t: Tables):
    out = shared_dir(t.spark, "src_05")
    cols = ("event_id", "user_id", "event_type")
    sinks.overwrite(t.events.select(*cols), out)
    sinks.overwrite(t.events.where("event_type = 'click'").select(*cols), out)
    sinks.append(t.events.where("event_type = 'view'").select(*cols), out)
    return t.spark.read.parquet(out)


@query(
    "src_06",
    """SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders
    WHERE o_orderdate >= DATE '1999-01-01'
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < DATE '1999-01-01'""",
)
def src_06(t: Tables):
    out = shared_dir(t.spark, "src_06")
    cols = ("o_orderkey", "o_orderstatus", "o_totalprice")
    keyed.upsert(t.orders.where("o_orderdate < DATE'2000-01-01'").select(*cols), out, ["o_orderkey"])
    changed = t.orders.where("o_orderdate >= DATE'1999-01-01'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice")
    )
    keyed.upsert(changed, out, ["o_orderkey"])
    return keyed.read(t.spark, out)


@query("src_09", "SELECT p_partkey, p_name FROM part")
def src_09(t: Tables):
    return tables.read_columns(t.part, ["p_partkey", "p_name"])


@query(
    "src_10",
    """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem
    WHERE l_returnflag = 'R' GROUP BY l_returnflag""",
)
def src_10(t: Tables):
    out = shared_dir(t.spark, "src_10")
    sinks.write_partitioned(t.lineitem.select("l_returnflag", "l_orderkey", "l_quantity"), out, ["l_returnflag"], salt=8)
    back = t.spark.read.parquet(out).where("l_returnflag = 'R'")
    return back.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query(
    "src_11",
    """SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey""",
)
def src_11(t: Tables):
    out = shared_dir(t.spark, "src_11")
    feats = lambda df: df.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    first = feats(t.orders.where("o_orderdate < DATE'1998-01-01'"))
    keyed.save_feature_table(first.unionByName(first), out, ["o_custkey"])
    keyed.save_feature_table(feats(t.orders), out, ["o_custkey"])
    return keyed.read(t.spark, out)


@query("src_12", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src_12(t: Tables):
    out = shared_dir(t.spark, "src_12")
    t.nation.write.option("sep", ";").option("header", True).csv(out)
    return tables.load_seed(t.spark, out, t.nation.schema).select("n_nationkey", "n_name", "n_regionkey")


def _traits(t: Tables):
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("valid_from"))
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


_TRAITS = """traits AS (SELECT customer.*, valid_from FROM customer
    JOIN (SELECT o_custkey, max(o_orderdate) AS valid_from FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""
_STATUS = """status AS (SELECT c_custkey, TIMESTAMP '2000-06-01' AS last_sync_at, c_custkey % 7 <> 0 AS ok
    FROM customer WHERE c_custkey % 5 <> 0)"""


def _status(t: Tables):
    return t.customer.where("c_custkey % 5 <> 0").select(
        "c_custkey",
        F.expr("timestamp_ntz'2000-06-01 00:00:00'").alias("last_sync_at"),
        (F.col("c_custkey") % 7 != 0).alias("last_sync_succeeded"),
    )


@query(
    "src_14",
    f"""WITH {_TRAITS}, {_STATUS}
    SELECT t.c_custkey, t.c_name FROM traits t LEFT JOIN status s ON t.c_custkey = s.c_custkey
    WHERE valid_from >= last_sync_at OR valid_from >= TIMESTAMP '2001-03-01' OR last_sync_at IS NULL OR ok = false""",
)
def src_14(t: Tables):
    since = F.expr("timestamp_ntz'2001-03-01 00:00:00'")
    return export.rows_to_sync(_traits(t), _status(t), "c_custkey", since).select("c_custkey", "c_name")


@query(
    "src_15",
    f"""WITH {_TRAITS}
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '{{"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
    || ',"rich":"' || CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END
    || '","valid_from":' || CAST(epoch(valid_from) AS BIGINT) || '}}' AS attributes FROM traits""",
)
def src_15(t: Tables):
    df = _traits(t).select("c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") > 0).alias("rich"), "valid_from")
    return export.to_payload(df, "c_custkey")


@query(
    "src_16",
    f"""WITH {_STATUS}, run AS (SELECT c_custkey, c_mktsegment = 'BUILDING' AS failed FROM customer
      WHERE c_nationkey < 10)
    SELECT c_custkey, TIMESTAMP '2001-01-01' AS last_sync_at, NOT failed AS ok FROM run
    UNION ALL SELECT c_custkey, last_sync_at, ok FROM status WHERE c_custkey NOT IN (SELECT c_custkey FROM run)""",
)
def src_16(t: Tables):
    run = t.customer.where("c_nationkey < 10")
    out = export.update_sync_status(
        _status(t),
        run,
        run.where("c_mktsegment = 'BUILDING'"),
        "c_custkey",
        F.expr("timestamp_ntz'2001-01-01 00:00:00'"),
    )
    return out.withColumnRenamed("last_sync_succeeded", "ok")


@query(
    "src_17",
    """SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS snapshot_date FROM orders
    WHERE o_orderdate <= DATE '1999-12-31'""",
)
def src_17(t: Tables):
    cols = tables.read_columns(
        t.orders.where("o_orderdate <= DATE'1999-12-31'"), ["o_orderkey", "o_orderstatus", "o_orderdate"]
    )
    return cols.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("snapshot_date"))
