"""Timelines over the events table (event type as state) and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.functions import dates
from larder.operators import joins, scd

FUT = "TIMESTAMP '9999-12-31 00:00:00'"


def states(t: Tables):
    """Event types as consecutive states of a user."""
    ev = t.events.select("user_id", "event_id", F.col("ts").alias("valid_from"), F.col("event_type").alias("state"))
    return scd.with_valid_to(ev, ["user_id"], "valid_from", ["event_id"])


STATES = f"""states AS (SELECT user_id, event_id, ts AS valid_from, event_type AS state,
  coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), {FUT}) AS valid_to FROM events)"""

ISLANDS = f"""{STATES}, numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_from)
  - row_number() OVER (PARTITION BY user_id, state ORDER BY valid_from) AS g FROM states),
islands AS (SELECT user_id, state, min(valid_from) AS valid_from, max(valid_to) AS valid_to FROM numbered
  GROUP BY user_id, state, g)"""


def islands(t: Tables):
    ev = t.events.select("user_id", "event_id", "ts", F.col("event_type").alias("state"))
    return scd.state_islands(ev, ["user_id"], "ts", "state", ["event_id"])


@query(
    "entry",
    f"""WITH {ISLANDS}
    SELECT strftime(e.ts, '%Y-%m') AS month, i.state AS status, count(*) AS purchases, round(sum(e.value), 4) AS value
    FROM events e JOIN islands i ON e.user_id = i.user_id AND e.ts > i.valid_from AND e.ts <= i.valid_to
    WHERE e.event_type = 'purchase' GROUP BY 1, 2""",
)
def entry(t: Tables):
    """Purchases by month and the status their customer held right before."""
    facts = t.events.where("event_type = 'purchase'").select("user_id", "ts", "value")
    held = joins.as_of(
        facts, islands(t), ["user_id"], "ts", "valid_from", "m", strict=True
    ).where("m is not null and ts <= m.valid_to")
    return held.groupBy(F.date_format("ts", "yyyy-MM").alias("month"), F.col("m.state").alias("status")).agg(
        F.count("*").alias("purchases"), F.round(F.sum("value"), 4).alias("value")
    )


@query("scd_01", f"WITH {STATES} SELECT * FROM states")
def scd_01(t: Tables):
    return states(t)


def _three(t: Tables):
    ev = t.events
    out = {}
    for name, kind in (("a", "click"), ("b", "view"), ("c", "signup")):
        rows = ev.where(F.col("event_type") == kind).select(
            "user_id", F.col("ts").alias("valid_from"), F.col("value").alias(f"{name}_value")
        )
        out[name] = scd.with_valid_to(rows, ["user_id"], "valid_from")
    # Table c closes after two days at the latest, so that gaps occur.
    out["c"] = out["c"].withColumn(
        "valid_to", F.least("valid_to", F.expr("valid_from + interval 2 days"))
    )
    return out


def _one(name, kind, end):
    return f"""{name} AS (SELECT user_id, ts AS valid_from, {end} AS valid_to, value AS {name}_value FROM events
      WHERE event_type = '{kind}')"""


_LEAD = f"coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), {FUT})"
_THREE = ", ".join(
    [
        _one("a", "click", _LEAD),
        _one("b", "view", _LEAD),
        _one("c", "signup", f"least({_LEAD}, ts + INTERVAL 2 DAY)"),
    ]
)


@query(
    "scd_02",
    f"""WITH {_THREE}, p AS (SELECT user_id, valid_from FROM a UNION SELECT user_id, valid_from FROM b
      UNION SELECT user_id, valid_from FROM c),
    tl AS (SELECT user_id, valid_from, coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from), {FUT})
      AS valid_to FROM p)
    SELECT tl.user_id, tl.valid_from, tl.valid_to, tl.valid_to = {FUT} AS is_current, a_value, b_value, c_value FROM tl
    LEFT JOIN a ON tl.user_id = a.user_id AND tl.valid_from >= a.valid_from AND tl.valid_to <= a.valid_to
    LEFT JOIN b ON tl.user_id = b.user_id AND tl.valid_from >= b.valid_from AND tl.valid_to <= b.valid_to
    LEFT JOIN c ON tl.user_id = c.user_id AND tl.valid_from >= c.valid_from AND tl.valid_to <= c.valid_to""",
)
def scd_02(t: Tables):
    return scd.join_scd2("user_id", _three(t))


@query(
    "scd_03",
    f"""WITH {_THREE}, p AS (SELECT user_id, valid_from FROM a UNION SELECT user_id, valid_from FROM c),
    tl AS (SELECT user_id, valid_from, coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from), {FUT})
      AS valid_to FROM p)
    SELECT tl.user_id, tl.valid_from, tl.valid_to, a_value, c_value FROM tl
    LEFT JOIN a ON tl.user_id = a.user_id AND a.valid_from <= tl.valid_from AND a.valid_to >= tl.valid_to
    LEFT JOIN c ON tl.user_id = c.user_id AND c.valid_from <= tl.valid_from AND c.valid_to >= tl.valid_to""",
)
def scd_03(t: Tables):
    three = _three(t)
    return scd.join_snapshots(three["a"], three["c"], "user_id", "c_value")


@query("scd_04", f"WITH {ISLANDS} SELECT * FROM islands")
def scd_04(t: Tables):
    return scd.merge_islands(states(t), ["user_id"], ["state"], ["event_id"])


@query("scd_04_events", f"WITH {ISLANDS} SELECT * FROM islands")
def scd_04_events(t: Tables):
    return islands(t)


_LINKS = """links AS (SELECT user_id, CAST(floor(value / 20) AS INTEGER) AS state, ts AS valid_from,
  CASE WHEN value % 2 < 1 THEN lead(ts) OVER w ELSE ts + INTERVAL 1 MINUTE END AS valid_to FROM events
  WINDOW w AS (PARTITION BY user_id, CAST(floor(value / 20) AS INTEGER) ORDER BY ts, event_id))"""


def _links(t: Tables):
    ev = t.events.select(
        "user_id",
        F.floor(F.col("value") / 20).cast("int").alias("state"),
        F.col("ts").alias("valid_from"),
        "event_id",
        (F.col("value") % 2 < 1).alias("linked"),
    )
    nxt = scd.with_valid_to(ev, ["user_id", "state"], "valid_from", ["event_id"], out="next")
    return nxt.where(~F.col("linked") | (F.col("next") < F.expr("timestamp_ntz'9999-01-01 00:00:00'"))).select(
        "user_id",
        "state",
        "valid_from",
        F.when(F.col("linked"), F.col("next")).otherwise(F.expr("valid_from + interval 1 minute")).alias("valid_to"),
    )


@query(
    "scd_05",
    f"""WITH {_LINKS}, l AS (SELECT * FROM links WHERE valid_to IS NOT NULL),
    f AS (SELECT *, CASE WHEN lag(valid_to) OVER w = valid_from THEN 0 ELSE 1 END AS s FROM l
      WINDOW w AS (PARTITION BY user_id, state ORDER BY valid_from)),
    g AS (SELECT *, sum(s) OVER (PARTITION BY user_id, state ORDER BY valid_from) AS isl FROM f)
    SELECT user_id, state, min(valid_from) AS valid_from, max(valid_to) AS valid_to FROM g
    GROUP BY user_id, state, isl""",
)
def scd_05(t: Tables):
    return scd.merge_contiguous(_links(t), ["user_id"], ["state"])


@query(
    "scd_06",
    """SELECT user_id, event_id, ts, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id
    ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type""",
)
def scd_06(t: Tables):
    ev = t.events.select("user_id", "event_id", "ts", "event_type")
    return scd.changes_only(ev, ["user_id"], "event_type", "ts", ["event_id"])


@query(
    "scd_07",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, ts) AS state FROM events GROUP BY 1, 2),
    l AS (SELECT user_id, max(day) AS day FROM d GROUP BY user_id)
    SELECT user_id, day, state FROM d UNION ALL
    SELECT user_id, CAST(day + 1 AS DATE), 'deleted' FROM l WHERE day < (SELECT max(day) FROM d)""",
)
def scd_07(t: Tables):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max_by("event_type", "ts").alias("state"))
    out = scd.add_deletions(daily, "user_id", "day", "state", "deleted")
    return out.withColumn("day", F.to_date("day"))


@query(
    "scd_08",
    f"""WITH {STATES} SELECT user_id, event_id, state, greatest(valid_from, TIMESTAMP '2024-01-15') AS valid_from,
    valid_to FROM states WHERE valid_to > TIMESTAMP '2024-01-15'""",
)
def scd_08(t: Tables):
    return scd.clip_history(states(t), F.expr("timestamp_ntz'2024-01-15 00:00:00'"))


@query(
    "scd_09",
    """WITH e AS (SELECT user_id, event_id, ts, event_type AS product, CAST(floor(value) AS INTEGER) AS variation,
      event_id % 3 = 0 AS weak FROM events),
    h AS (SELECT *, last_value(CASE WHEN NOT weak THEN product END IGNORE NULLS) OVER w AS sp,
      last_value(CASE WHEN NOT weak THEN variation END IGNORE NULLS) OVER w AS sv FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT event_id, CASE WHEN weak AND sp = product THEN sv ELSE variation END AS resolved FROM h""",
)
def scd_09(t: Tables):
    ev = t.events.select(
        "user_id",
        "event_id",
        "ts",
        F.col("event_type").alias("product"),
        F.floor("value").cast("int").alias("variation"),
        (F.col("event_id") % 3 == 0).alias("weak"),
    )
    out = scd.resolve_weak_source(
        ev, ["user_id"], ["ts", "event_id"], "product", "variation", F.col("weak")
    )
    return out.select("event_id", "resolved")


@query(
    "scd_10",
    f"""WITH {STATES}, f AS (SELECT user_id, min(valid_from) AS first FROM states GROUP BY user_id)
    SELECT states.user_id, event_id, state, CASE WHEN valid_from = first THEN TIMESTAMP '2023-01-01' ELSE valid_from END
    AS valid_from, valid_to FROM states JOIN f ON states.user_id = f.user_id""",
)
def scd_10(t: Tables):
    return scd.backfill_start(states(t), ["user_id"], F.expr("timestamp_ntz'2023-01-01 00:00:00'"))


@query(
    "scd_11",
    f"""WITH {ISLANDS}, v AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY valid_from) AS previous_state,
    row_number() OVER (PARTITION BY user_id ORDER BY valid_from) AS rn FROM islands)
    SELECT user_id, valid_from, valid_to, state, previous_state, rn > 1 AND state <> previous_state AS state_changed
    FROM v""",
)
def scd_11(t: Tables):
    return scd.version_diff(islands(t), ["user_id"], ["state"])


_SNAP = f"""snap AS (SELECT c_custkey, c_mktsegment, c_acctbal, TIMESTAMP '2024-01-01' AS updated_at,
  TIMESTAMP '2024-01-01' AS valid_from, {FUT} AS valid_to FROM customer WHERE c_custkey % 10 <> 0),
src AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment, c_acctbal,
  CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS updated_at FROM customer
  WHERE c_custkey % 7 <> 0)"""
_DAY2, _NOW = "timestamp_ntz'2024-01-02 00:00:00'", "timestamp_ntz'2024-01-03 00:00:00'"


def _snap(t: Tables):
    day1 = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    cols = ("c_custkey", "c_mktsegment", "c_acctbal")
    snap = t.customer.where("c_custkey % 10 <> 0").select(
        *cols, day1.alias("updated_at"), day1.alias("valid_from"), dates.future().alias("valid_to")
    )
    hit = F.col("c_custkey") % 4 == 0
    src = t.customer.where("c_custkey % 7 <> 0").select(
        "c_custkey",
        F.when(hit, "CHANGED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_acctbal",
        F.when(hit, F.expr(_DAY2)).otherwise(day1).alias("updated_at"),
    )
    return src, snap


def _snapshot_sql(since: str, changed: str) -> str:
    return f"""WITH {_SNAP}
    SELECT s.c_custkey, s.c_mktsegment, s.c_acctbal, s.updated_at, s.valid_from,
      CASE WHEN n.c_custkey IS NULL THEN TIMESTAMP '2024-01-03' WHEN {changed} THEN {since} ELSE s.valid_to END AS valid_to
    FROM snap s LEFT JOIN src n ON s.c_custkey = n.c_custkey
    UNION ALL SELECT n.*, {since}, {FUT} FROM src n LEFT JOIN snap s ON s.c_custkey = n.c_custkey
    WHERE s.c_custkey IS NULL OR {changed}"""


@query("scd_12", _snapshot_sql("n.updated_at", "n.updated_at > s.updated_at"))
def scd_12(t: Tables):
    src, snap = _snap(t)
    return scd.snapshot_timestamp(src, snap, "c_custkey", "updated_at", F.expr(_NOW), hard_deletes=True)


@query("scd_13", _snapshot_sql("TIMESTAMP '2024-01-03'", "n.c_mktsegment <> s.c_mktsegment"))
def scd_13(t: Tables):
    src, snap = _snap(t)
    return scd.snapshot_check(src, snap, "c_custkey", ["c_mktsegment", "c_acctbal"], F.expr(_NOW), hard_deletes=True)


@query(
    "scd_14",
    f"""WITH {STATES} SELECT user_id, state, 'current' AS kind FROM states WHERE valid_to = {FUT}
    UNION ALL SELECT user_id, state, 'as of' FROM states
    WHERE valid_from <= TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-15' < valid_to""",
)
def scd_14(t: Tables):
    s = states(t)
    now = scd.current(s).select("user_id", "state", F.lit("current").alias("kind"))
    then = scd.as_of_date(s, F.expr("timestamp_ntz'2024-01-15 00:00:00'"))
    return now.unionByName(then.select("user_id", "state", F.lit("as of").alias("kind")))


@query(
    "scd_15",
    f"""WITH {ISLANDS}, cal AS (SELECT range AS d FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY))
    SELECT user_id, state, CAST(d AS DATE) AS day FROM islands JOIN cal ON d >= valid_from AND d < valid_to""",
)
def scd_15(t: Tables):
    return scd.expand_periods(
        islands(t), F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date")
    ).select("user_id", "state", "day")


@query(
    "scd_15_weekly",
    f"""WITH {ISLANDS}, cal AS (SELECT range AS d FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 7 DAY))
    SELECT user_id, state, CAST(d AS DATE) AS day FROM islands JOIN cal ON d >= valid_from AND d < valid_to""",
)
def scd_15_weekly(t: Tables):
    return scd.expand_periods(
        islands(t), F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date"), "1 week"
    ).select("user_id", "state", "day")


_SPANS = """spans AS (SELECT user_id, event_id, ts AS valid_from,
  ts + to_seconds(CAST(floor(value * 600) AS INTEGER)) AS valid_to FROM events)"""


def spans(t: Tables):
    """Event intervals of a length given by the value, which may overlap."""
    length = F.floor(F.col("value") * 600).cast("int")
    return t.events.select(
        "user_id",
        "event_id",
        F.col("ts").alias("valid_from"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), length)).alias("valid_to"),
    )


@query(
    "scd_16",
    f"""WITH {_SPANS} SELECT * FROM (SELECT *, max(valid_to) OVER (PARTITION BY user_id ORDER BY valid_from, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_end_before FROM spans)
    WHERE latest_end_before > valid_from""",
)
def scd_16(t: Tables):
    return scd.overlaps(spans(t), ["user_id"], ["event_id"])


@query(
    "scd_17",
    """WITH s AS (SELECT DISTINCT c_nationkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS valid_from
      FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT c_nationkey, year(valid_from) || ' S' || row_number() OVER (PARTITION BY c_nationkey, year(valid_from)
    ORDER BY valid_from) AS season, valid_from, coalesce(lead(valid_from) OVER (PARTITION BY c_nationkey
    ORDER BY valid_from), DATE '9999-12-31') AS valid_to FROM s""",
)
def scd_17(t: Tables):
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    quarter = placed.select("c_nationkey", F.trunc(F.to_date("o_orderdate"), "quarter").alias("q"))
    return scd.derive_seasons(quarter, "c_nationkey", "q")
