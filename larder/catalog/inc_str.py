"""Incremental state and streaming."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.operators import incremental as I
from larder.session import shared_dir
from larder.sources import keyed
from larder.streaming import queue as Q


@query(
    "inc_01",
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
    WHERE o_orderdate < DATE '1998-01-01' UNION ALL
    SELECT o_orderkey, o_totalprice + 1, o_orderpriority FROM orders WHERE o_orderdate >= DATE '1998-01-01'""",
)
def inc_01(t: Tables):
    old = t.orders.where("o_orderdate < DATE'1999-01-01'").select("o_orderkey", "o_totalprice")
    new = t.orders.where("o_orderdate >= DATE'1998-01-01'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderpriority"
    )
    out = shared_dir(t.spark, "inc_01")
    keyed.upsert(old, out, ["o_orderkey"])
    keyed.upsert(new, out, ["o_orderkey"])
    return keyed.read(t.spark, out)


@query(
    "inc_02",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-05-01' THEN o_totalprice ELSE -1 END AS o_totalprice
    FROM orders WHERE o_orderdate >= DATE '1995-06-01'""",
)
def inc_02(t: Tables):
    out = shared_dir(t.spark, "inc_02")
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    first = o.where("o_orderdate <= DATE'2000-06-15'").withColumn("o_totalprice", F.lit(-1.0))
    I.reprocess_window(first, out, "o_orderdate", 30, "1995-06-01")
    I.reprocess_window(o, out, "o_orderdate", 30)
    return t.spark.read.parquet(out).select("o_orderkey", "o_totalprice")


@query(
    "inc_03",
    """WITH l AS (SELECT user_id, event_type, value, 1 AS g FROM events WHERE ts < TIMESTAMP '2024-01-15' UNION ALL
      SELECT user_id, event_type, value, 2 FROM events WHERE user_id % 2 = 0)
    SELECT user_id, event_type, value FROM l JOIN (SELECT user_id, max(g) AS g FROM l GROUP BY 1) USING (user_id, g)""",
)
def inc_03(t: Tables):
    out = shared_dir(t.spark, "inc_03")
    rows = t.events.select("user_id", "event_type", "value", "ts")
    run = lambda d: F.expr(f"timestamp_ntz'2024-02-0{d} 00:00:00'")
    I.append_generation(rows.where("ts < timestamp_ntz'2024-01-15 00:00:00'").drop("ts"), out, run(1))
    I.append_generation(rows.where("user_id % 2 = 0").drop("ts"), out, run(2))
    return I.latest_generation(t.spark.read.parquet(out), ["user_id"]).drop("generated_at")


@query(
    "inc_04",
    """SELECT event_id, CASE WHEN ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')
    THEN value ELSE -1 END AS value FROM events WHERE ts <= TIMESTAMP '2024-01-25'""",
)
def inc_04(t: Tables):
    out = shared_dir(t.spark, "inc_04")
    ev = t.events.select("event_id", "ts", "value")
    day = timedelta(days=1)
    args = (["event_id"], "ts")
    I.refresh(
        ev.where("ts < timestamp_ntz'2024-01-20 00:00:00'").withColumn("value", F.lit(-1.0)),
        out, *args, day, datetime(2024, 1, 20),
    )
    assert I.refresh(ev, out, *args, day, datetime(2024, 1, 20, 0, 30)) == "skipped"
    assert I.refresh(ev, out, *args, day, datetime(2024, 1, 25)) == "upserted"
    return keyed.read(t.spark, out).select("event_id", "value")


@query(
    "inc_05",
    """SELECT event_id, ts = max(ts) OVER (PARTITION BY user_id, event_type) AS is_most_recent,
    CAST(ts AS DATE) = CAST(max(ts) OVER (PARTITION BY user_id) AS DATE) AS is_last_day FROM events""",
)
def inc_05(t: Tables):
    ev = t.events.select("event_id", "user_id", "event_type", "ts", F.to_date("ts").alias("day"))
    out = I.flag_most_recent(ev, ["user_id", "event_type"], "ts", ["event_id"])
    return I.flag_most_recent(out, ["user_id"], "day", out="is_last_day").select(
        "event_id", "is_most_recent", "is_last_day"
    )


@query(
    "inc_06",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id) AS version,
    CASE WHEN row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts DESC, event_id DESC) = 1
    THEN 1 ELSE 0 END AS is_most_recent FROM events""",
)
def inc_06(t: Tables):
    ev = t.events.select("event_id", "user_id", F.trunc(F.to_date("ts"), "week").alias("week"), "ts")
    return I.version_outputs(ev, ["user_id", "week"], "ts", ["event_id"]).select(
        "event_id", "version", "is_most_recent"
    )


@query(
    "inc_07",
    """SELECT doc_id, quality, doc_id % 3 <> 0 AS is_latest FROM labels
    UNION ALL SELECT doc_id, 1 - quality, true FROM labels WHERE doc_id % 3 = 0""",
)
def inc_07(t: Tables):
    old = t.labels.select("doc_id", "quality", F.lit(True).alias("is_latest"))
    new = t.labels.where("doc_id % 3 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"))
    return I.supersede(old, new, ["doc_id"])


_MESSAGE = "event_id long, user_id long, event_type string, value double, ts string"


def _topic(t: Tables, name: str) -> tuple[str, str]:
    """Events as JSON messages."""
    base = shared_dir(t.spark, name)
    ev = t.events.select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    Q.publish(ev, f"{base}/topic", files=4)  # four batches at one file per trigger
    return base, f"{base}/topic"


def _score(df):
    """Double the value; error events fail with a code."""
    req = F.col("request")
    code = F.coalesce(F.col("error_code"), F.when(req["event_type"] == "error", F.lit(500)))
    return df.select(
        "value", req["event_id"].alias("event_id"), F.round(req["value"] * 2, 4).alias("score"), code.alias("error_code")
    )


def _scored(t: Tables, name: str, per_trigger: int = 4):
    base, topic = _topic(t, name)
    stream = Q.parse(Q.messages(t.spark, topic, per_trigger), _MESSAGE)
    Q.score_stream(stream, _score, f"{base}/ok", f"{base}/bad", f"{base}/cp").awaitTermination()
    return base


@query("str_01", "SELECT event_id, round(value * 2, 4) AS score FROM events WHERE event_type <> 'error'")
def str_01(t: Tables):
    base = _scored(t, "str_01")
    return t.spark.read.parquet(f"{base}/ok").select("event_id", "score")


@query(
    "str_02",
    """SELECT count(*) AS n, round(sum(round(value * 2, 4)), 4) AS total, 4 AS n_batches FROM events
    WHERE event_type <> 'error'""",
)
def str_02(t: Tables):
    base = _scored(t, "str_02", per_trigger=1)
    return t.spark.read.parquet(f"{base}/ok").agg(
        F.count("*").alias("n"),
        F.round(F.sum("score"), 4).alias("total"),
        F.count_distinct("batch_id").cast("int").alias("n_batches"),
    )


@query(
    "str_03",
    """SELECT event_id, 500 AS error_code, round(value * 2, 4) AS replayed_score FROM events WHERE event_type = 'error'""",
)
def str_03(t: Tables):
    base = _scored(t, "str_03")
    ids = t.spark.read.parquet(f"{base}/bad").select(
        "error_code", F.from_json("value", _MESSAGE)["event_id"].alias("event_id")
    )
    again = Q.drain_dead_letters(t.spark, f"{base}/bad", _MESSAGE, _score)
    return ids.join(again.select("event_id", F.col("score").alias("replayed_score")), "event_id")


@query("str_04", "SELECT event_id, user_id FROM events")
def str_04(t: Tables):
    base, topic = _topic(t, "str_04")
    stream = Q.parse(Q.messages(t.spark, topic, 2), _MESSAGE).select("request.event_id", "request.user_id")
    for _ in range(2):  # A second drain finds nothing new.
        Q.drain(stream, f"{base}/table", f"{base}/cp").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").select("event_id", "user_id")


@query("str_05", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")
def str_05(t: Tables):
    base, topic = _topic(t, "str_05")
    stream = Q.parse(Q.messages(t.spark, topic, 4), _MESSAGE).select("request.event_id", "request.user_id")
    load = lambda: t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    Q.stream_static_join(stream, load, "user_id", f"{base}/table", f"{base}/cp").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").select("event_id", "c_mktsegment")


@query(
    "str_06",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'A1,A2' WHEN 'view' THEN 'A2' WHEN 'purchase' THEN 'A0'
    WHEN 'signup' THEN 'A1' ELSE '' END AS ids, CASE event_type WHEN 'view' THEN 'OWN,P1,P2' ELSE 'OWN' END AS prefs
    FROM events""",
)
def str_06(t: Tables):
    base, topic = _topic(t, "str_06")
    kind = F.col("request.event_type")
    ids = F.when(kind == "purchase", F.lit(None)).when(kind == "signup", F.array(F.lit("a1"))).otherwise(F.array(kind))
    stream = Q.parse(Q.messages(t.spark, topic, 4), _MESSAGE).select(
        "request.event_id", ids.alias("ids"), F.array(F.lit("own")).alias("prefs")
    )
    mapped = Q.map_ids(stream, "ids", {"click": ["a1", "a2"], "view": ["a2"]}, "a0", {"view": ["p1", "p2"]}, "prefs")
    Q.drain(mapped, f"{base}/table", f"{base}/cp").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").select(
        "event_id", F.array_join("ids", ",").alias("ids"), F.array_join("prefs", ",").alias("prefs")
    )


@query("str_07", "SELECT event_id, user_id FROM events")
def str_07(t: Tables):
    base, topic = _topic(t, "str_07")
    Q.publish(t.events.where("event_id % 3 = 0").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")), topic)
    stream = Q.parse(Q.messages(t.spark, topic, 4), _MESSAGE).select(
        "request.event_id", "request.user_id", F.to_timestamp("request.ts").alias("ts")
    )
    once = Q.dedupe_stream(stream, ["event_id"], "ts", "60 days")
    Q.append_stream(once, f"{base}/table", f"{base}/cp").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").select("event_id", "user_id")


@query("str_08", "SELECT event_id, user_id % 4 AS bucket FROM events WHERE user_id % 4 IN (1, 2)")
def str_08(t: Tables):
    base, topic = _topic(t, "str_08")
    stream = Q.parse(Q.messages(t.spark, topic, 4), _MESSAGE).select(
        "request.event_id", (F.col("request.user_id") % 4).alias("bucket")
    )
    Q.route(stream, "bucket", f"{base}/table", f"{base}/cp").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").where("bucket in (1, 2)").select(
        "event_id", F.col("bucket").cast("long").alias("bucket")
    )
