"""Chunked windows against brute force, with one key holding most rows, ties and NULL keys."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import chunked as C


@pytest.fixture
def small_cut(monkeypatch):
    monkeypatch.setattr(C, "LEAST_ROWS", 50)
    monkeypatch.setattr(C, "SAMPLES", 4)


def test_large_keys_are_cut_by_rows(spark, history, small_cut):
    df, chunk = C.cut(history[1], ["k"], ["ts", "id"])
    assert chunk is not C.WHOLE
    n = {r.k: (r.chunks, r.n) for r in df.groupBy("k").agg(F.count_distinct("__chunk").alias("chunks"), F.count("*").alias("n")).collect()}
    assert n["hot"][1] > 300 and 5 <= n["hot"][0] <= n["hot"][1] / 25
    assert all(c > 1 if rows > 100 else c == 1 for c, rows in n.values() if rows <= 50 or rows > 100)
    spans = sorted((r.c, r.lo, r.hi) for r in df.where("k = 'hot'").groupBy(F.col("__chunk").alias("c")).agg(F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi")).collect())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:])) and spans[0][0] == 1


def test_an_instant_is_split_by_the_tie_break(spark, small_cut):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("hot", now, i) for i in range(1000)] + [(f"k{i}", now, i) for i in range(300)], "k string, ts timestamp_ntz, id int")
    out, _ = C.cut(df, ["k"], ["ts", "id"])
    sizes = [r["count"] for r in out.where("k = 'hot'").groupBy("__chunk").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 400
    got = C.row_numbers(df, ["k"], ["ts", "id"])
    assert {(r.k, r.id, r.rn) for r in got.collect()} == {("hot", i, i + 1) for i in range(1000)} | {(f"k{i}", i, 1) for i in range(300)}


def test_small_keys_stay_whole_and_need_one_exchange(spark, history):
    df, chunk = C.cut(history[1], ["k"], ["ts", "id"])
    assert chunk is C.WHOLE and df.columns == history[1].columns
    out = C.fill_down(C.neighbour(history[1], ["k"], ["ts", "id"], {"n": "id"}, chunk), ["k"], ["ts", "id"], {"last": F.col("v")}, chunk)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 1


def test_chunks_are_bounded_by_the_partitions(spark):
    assert C.target_rows(spark.range(1), 10**12) == 10**12 // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert C.target_rows(spark.range(1), 1000) == C.LEAST_ROWS


@pytest.mark.parametrize("small", [True, False])
def test_without_a_key(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(C, "LEAST_ROWS", 50)
    df = spark.createDataFrame([(i, (i * 7919) % 1000) for i in range(1000)], "id int, x int")
    got = C.row_numbers(df, [], ["x", "id"])
    assert {(r.x, r.rn) for r in got.collect()} == {(x, x + 1) for x in range(1000)}
    assert C.row_numbers(df.limit(0), [], ["x", "id"]).collect() == []


@pytest.fixture(scope="module")
def history(spark):
    rnd = random.Random(3)
    keys = ["hot"] * 6 + ["a", "b", None]
    start = dt.datetime(2024, 1, 1)
    data = [
        (rnd.choice(keys), start + dt.timedelta(minutes=rnd.randrange(60 * 24 * 90)), i, rnd.choice([None, 1.0, 2.5, -3.0]))
        for i in range(600)
    ]
    return data, spark.createDataFrame(data, "k string, ts timestamp_ntz, id int, v double")


def groups(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.fixture(params=["whole", "cut"])
def size(request, monkeypatch):
    if request.param == "cut":
        monkeypatch.setattr(C, "LEAST_ROWS", 50)
        monkeypatch.setattr(C, "SAMPLES", 4)


@pytest.mark.parametrize("forward", [False, True])
def test_neighbour(history, size, forward):
    data, df = history
    got = C.neighbour(df, ["k"], ["ts", "id"], {"n": "id", "nv": "v"}, forward=forward)
    want = {}
    for g in groups(data).values():
        for i, r in enumerate(g):
            j = i + 1 if forward else i - 1
            want[r[2]] = (g[j][2], g[j][3]) if 0 <= j < len(g) else (None, None)
    assert {r.id: (r.n, r.nv) for r in got.collect()} == want


def test_running_and_fill(history, size):
    data, df = history
    got = C.running(df, ["k"], ["ts", "id"], {"n": F.lit(1).cast("long"), "s": F.col("v")}, {"m": F.col("v")})
    got = C.fill_down(got, ["k"], ["ts", "id"], {"last": F.col("v")})
    want = {}
    for g in groups(data).values():
        seen = []
        for i, r in enumerate(g):
            seen += [r[3]] if r[3] is not None else []
            want[r[2]] = (i + 1, sum(seen) if seen else None, max(seen) if seen else None, seen[-1] if seen else None)
    assert {r.id: (r.n, r.s, r.m, r.last) for r in got.collect()} == want


@pytest.mark.parametrize(("accuracy", "sent"), [(20, 100), (10_000, 2)])
def test_exact_quantiles(spark, size, monkeypatch, accuracy, sent):
    monkeypatch.setattr(C, "ACCURACY", accuracy)
    monkeypatch.setattr(C, "SENT_GROUPS", sent)
    rnd = random.Random(5)
    data = [("hot", rnd.choice([0.0, 1.0, rnd.random() * 1000])) for _ in range(901)] + [("skew", 10.0 ** rnd.randrange(12)) for _ in range(400)]
    data += [("even", float(x)) for x in (4, 1, 3, 2)] + [("one", 7.0), ("same", 2.0), ("same", 2.0), ("gap", None), ("gap", 5.0), (None, 3.0), (None, 4.0)]
    df = spark.createDataFrame(data, "k string, x double").repartition(7)
    keys = {k for k, _ in data}
    of = lambda k: [x for kk, x in data if kk == k and x is not None]
    assert {r.k: r.median for r in C.exact_median(df, ["k"], "x").collect()} == {k: statistics.median(of(k)) for k in keys}
    for q in (0.0, 0.05, 0.25, 0.9, 1.0):
        got = {r.k: r.quantile for r in C.exact_quantile(df, ["k"], "x", q).collect()}
        assert got == {k: pytest.approx(float(np.quantile(of(k), q)), rel=1e-9) for k in keys}


def test_totals_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, x int")
    got = sorted(((r.k, r.x, r.s) for r in C.with_totals(df, ["k"], s=F.sum("x")).collect()), key=str)
    assert got == sorted([("a", 1, 1), (None, 2, 5), (None, 3, 5)], key=str)
