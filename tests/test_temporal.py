"""Validity joins and SCD2 timelines: boundaries, ties, gaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import joins as J
from larder.operators import scd

D = lambda d, h=0: dt.datetime(2024, 1, d, h)
FUTURE = dt.datetime(9999, 12, 31)


def frame(spark, data, cols):
    return spark.createDataFrame(data, cols)


def test_valid_to_ties_give_empty_rows(spark, rows):
    df = frame(spark, [(1, D(1), 1), (1, D(1), 2), (1, D(3), 3), (2, D(2), 4)], "k int, ts timestamp_ntz, id int")
    out = scd.with_valid_to(df, ["k"], "ts", ["id"])
    assert rows(out, "id", "valid_to") == [(1, D(1)), (2, D(3)), (3, FUTURE), (4, FUTURE)]


def test_validity_bounds(spark, rows):
    dim = frame(
        spark,
        [(1, "a", D(1), D(3)), (1, "b", D(3), D(5)), (1, "gap", D(7), D(9)), (1, "zero", D(3), D(3))],
        "k int, state string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    facts = frame(spark, [(1, 1, D(1)), (2, 1, D(3)), (3, 1, D(5)), (4, 1, D(6)), (5, 2, D(3))], "id int, k int, ts timestamp_ntz")
    left = J.as_of_validity(facts, dim, ["k"], "ts")
    assert rows(left, "id", "state") == [(1, "a"), (2, "b"), (3, None), (4, None), (5, None)]
    both = J.as_of_validity(facts, dim, ["k"], "ts", closed="both")
    assert rows(both, "id", "state") == [(1, "a"), (2, "a"), (2, "b"), (2, "zero"), (3, "b"), (4, None), (5, None)]
    assert rows(J.as_of_validity(facts, dim, ["k"], "ts", how="inner"), "id") == [(1,), (2,)]


def test_timeline_slot_needs_full_cover(spark, rows):
    t = "valid_from timestamp_ntz, valid_to timestamp_ntz"
    a = frame(spark, [(1, "a1", D(1), D(10)), (1, "a2", D(10), FUTURE)], f"k int, a string, {t}")
    # b closes on the 5th, inside the slot that runs from the 3rd to the 10th.
    b = frame(spark, [(1, "b1", D(3), D(5)), (1, "b2", D(12), FUTURE)], f"k int, b string, {t}")
    out = scd.join_scd2("k", {"a": a, "b": b})
    assert rows(out, "valid_from", "a", "b", "is_current") == [
        (D(1), "a1", None, False),
        (D(3), "a1", None, False),
        (D(10), "a2", None, False),
        (D(12), "a2", "b2", True),
    ]
    assert rows(scd.join_snapshots(a, b, "k", "b"), "valid_from", "b")[-1] == (D(12), "b2")


def test_islands_aba_and_null_state(spark, rows):
    data = [(1, s, D(i + 1), D(i + 2)) for i, s in enumerate(["A", "A", "B", "A", None, None, "A"])]
    df = frame(spark, data, "k int, state string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = scd.merge_islands(df, ["k"], ["state"])
    got = sorted((tuple(r) for r in out.select("valid_from", "valid_to", "state").collect()), key=lambda r: r[0])
    assert got == [(D(1), D(3), "A"), (D(3), D(4), "B"), (D(4), D(5), "A"), (D(5), D(7), None), (D(7), D(8), "A")]


def test_contiguous_rows_merge_only_when_they_touch(spark, rows):
    df = frame(
        spark,
        [(1, "p", D(1), D(2)), (1, "p", D(2), D(3)), (1, "p", D(5), D(6))],
        "k int, s string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    assert rows(scd.merge_contiguous(df, ["k"], ["s"]), "valid_from", "valid_to") == [(D(1), D(3)), (D(5), D(6))]


def test_changes_and_null_transitions(spark, rows):
    df = frame(spark, [(1, D(i), i, s) for i, s in enumerate(["x", "x", None, "y", "y"], 1)], "k int, ts timestamp_ntz, id int, s string")
    assert rows(scd.changes_only(df, ["k"], "s", "ts"), "id") == [(1,), (3,), (4,)]
    assert rows(scd.changes_only(df, ["k"], "s", "ts", null_safe=False), "id") == [(1,)]


def test_snapshot_applied_twice_is_stable(spark, rows):
    snap = frame(
        spark,
        [(1, "a", D(1), D(1), FUTURE), (2, "b", D(1), D(1), FUTURE), (3, "c", D(1), D(1), FUTURE)],
        "k int, v string, updated timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    src = frame(spark, [(1, "a2", D(2)), (2, "b", D(1)), (4, "d", D(2))], "k int, v string, updated timestamp_ntz")
    now = F.lit(D(3)).cast("timestamp_ntz")
    once = scd.snapshot_timestamp(src, snap, "k", "updated", now, hard_deletes=True)
    want = [(1, "a", D(2)), (1, "a2", FUTURE), (2, "b", FUTURE), (3, "c", D(3)), (4, "d", FUTURE)]
    assert rows(once, "k", "v", "valid_to") == want
    twice = scd.snapshot_timestamp(src, once, "k", "updated", now, hard_deletes=True)
    assert rows(twice, "k", "v", "valid_to") == want
    checked = scd.snapshot_check(src, snap, "k", ["v"], now)
    assert rows(checked.where("k = 3"), "v", "valid_to") == [("c", FUTURE)]


def test_expand_daily_and_weekly(spark, rows):
    df = frame(spark, [(1, D(1, 12), D(3, 12)), (2, D(2), D(3))], "k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    lo, hi = F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date")
    assert rows(scd.expand_periods(df, lo, hi), "k", "day") == [
        (1, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 2)),
    ]
    long = frame(spark, [(1, D(2), D(20))], "k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert rows(scd.expand_periods(long, lo, hi, "1 week"), "day") == [(dt.date(2024, 1, 8),), (dt.date(2024, 1, 15),)]


def test_point_in_time_lookback(spark, rows):
    e = frame(spark, [(1, 1, D(10)), (2, 1, D(20))], "id int, k int, ts timestamp_ntz")
    f = frame(spark, [(1, D(9), 0.5), (1, D(11), 0.7)], "k int, fts timestamp_ntz, v double")
    assert rows(J.point_in_time(e, f, ["k"], "ts", "fts", "7 days"), "id", "v") == [(1, 0.5), (2, None)]


def test_as_of_with_hot_key_matches_brute_force(spark):
    import random

    rnd = random.Random(1)
    key = lambda: "hot" if rnd.random() < 0.6 else rnd.choice("abc")
    left = [(i, key(), D(1) + dt.timedelta(hours=rnd.randrange(700))) for i in range(300)]
    right = list({(k, D(1) + dt.timedelta(hours=h)): (k, D(1) + dt.timedelta(hours=h), j) for j, (k, h) in enumerate((key(), rnd.randrange(700)) for _ in range(300))}.values())
    got = J.as_of(frame(spark, left, "id int, k string, ts timestamp_ntz"), frame(spark, right, "k string, rts timestamp_ntz, v int"), ["k"], "ts", "rts")
    want = {}
    for i, k, ts in left:
        ok = [(rts, v) for kk, rts, v in right if kk == k and rts <= ts]
        want[i] = max(ok)[1] if ok else None
    assert {r.id: (r.matched.v if r.matched else None) for r in got.collect()} == want


def test_overlaps_and_previous_version(spark, rows):
    t = "valid_from timestamp_ntz, valid_to timestamp_ntz"
    df = frame(spark, [(1, "a", D(1), D(9)), (1, "b", D(2), D(3)), (1, "c", D(4), D(5)), (1, "d", D(9), D(10))], f"k int, s string, {t}")
    assert rows(scd.overlaps(df, ["k"]), "s") == [("b",), ("c",)]
    chain = frame(spark, [(1, "a", D(1), D(2)), (1, "b", D(2), D(3)), (1, "c", D(4), D(5))], f"k int, s string, {t}")
    assert rows(J.previous_version(chain, ["k"], ["s"]), "s", "previous_s") == [("a", None), ("b", "a"), ("c", None)]


def test_state_islands_equal_the_two_step_form(spark, monkeypatch):
    import random

    from larder.operators import chunked

    monkeypatch.setattr(chunked, "SAMPLES", 4)

    rnd = random.Random(9)
    data = [
        ("hot" if rnd.random() < 0.7 else rnd.choice(["a", None]), D(1) + dt.timedelta(hours=rnd.randrange(900)), i, rnd.choice(["x", "x", "y", None]))
        for i in range(400)
    ]
    df = frame(spark, data, "k string, ts timestamp_ntz, id int, state string")
    two = df.withColumnRenamed("ts", "valid_from")
    two = scd.merge_islands(scd.with_valid_to(two, ["k"], "valid_from", ["id"]), ["k"], ["state"], ["id"])
    cols = ("k", "state", "valid_from", "valid_to")
    for least in (40, 50_000):
        monkeypatch.setattr(chunked, "LEAST_ROWS", least)
        one = scd.state_islands(df, ["k"], "ts", "state", ["id"])
        key = lambda r: str(r)
        assert sorted(map(tuple, one.select(*cols).collect()), key=key) == sorted(map(tuple, two.select(*cols).collect()), key=key)
