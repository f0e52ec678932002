"""Exact values of dates, text, arrays and vectors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder.functions import arrays, dates, keys, text, vectors
from larder.operators import scoring, topk


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_iso_weeks(spark):
    assert one(spark, dates.iso_week_start(F.lit(2024), F.lit(35))) == (dt.date(2024, 8, 26),)
    years = spark.createDataFrame([(y,) for y in (2024, 2009, 2020, 2026)], "y int")
    assert [r[0] for r in years.select(dates.has_week_53("y")).collect()] == [False, True, True, True]


def test_year_week_difference(spark):
    df = spark.createDataFrame(zip([202444, 202451, 202501, 202510], [202443, 202501, 202447, 202510]), "last int, now int")
    assert [r[0] for r in df.select(dates.year_week_diff("now", "last")).collect()] == [-1, 2, -6, 0]


def test_forecast_start_and_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 8, 28),)], "d date")
    got = df.select(dates.year_week(dates.forecast_start("d", 2)), dates.forecast_weeks("d", 2, 3)).collect()
    assert [r[0] for r in got] == [202502, 202437]
    assert [r[1][-1] for r in got] == [dt.date(2025, 1, 20), dt.date(2024, 9, 23)]


def test_financial_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 9, 30),), (dt.date(2024, 10, 7),)], "d date")
    assert [r[0] for r in df.select(dates.financial_date("d")).collect()] == [dt.date(2024, 10, 1), dt.date(2024, 10, 7)]


def test_timezone_repair_over_summer_time(spark):
    ts = [dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 7, 15, 12), dt.datetime(2024, 7, 15), dt.datetime(2024, 9, 1, 12)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r[0] for r in df.select(dates.repair_timezone("ts", "Europe/Oslo", "2024-08-01 00:00:00")).collect()]
    assert got == [dt.datetime(2024, 1, 15, 11), dt.datetime(2024, 7, 15, 10), dt.datetime(2024, 7, 15), dt.datetime(2024, 9, 1, 12)]


def test_recency_score(spark):
    got = one(spark, *[dates.recency_score(F.lit(w), 8) for w in (0, 4, 7, 20)])
    assert got == (1.0, 2 / 3, 0.0, 0.0)


def test_keys(spark):
    none = F.lit(None).cast("string")
    a, b, c = one(spark, keys.surrogate_key(F.lit(1), none), keys.surrogate_key(F.lit(1), none, skip_nulls=True), F.md5(F.lit("1")))
    assert (a, b) == ("0", c)
    assert 0 <= one(spark, keys.hashed_uniform(F.lit(5), seed=3))[0] < 1


def test_text(spark):
    assert text.snake_case("menuYearWeek") == text.snake_case("Menu Year-Week") == "menu_year_week"
    got = one(spark, text.clean_tokens(F.lit("Été, 2 the-Fish!"), ["the"]), *text.parse_portion(F.lit("41")), *text.parse_portion(F.lit("4")))
    assert got == (["été", "fish"], 4, "4+", 4, "4")
    postal = text.clean_postal(F.lit("12345"), F.lit("NO"), {"NO": 4})
    assert one(spark, postal, text.clean_postal(F.lit("12"), F.lit("NO"), {"NO": 4})) == ("1234", "0012")


def test_arrays_with_nulls(spark):
    df = spark.createDataFrame([([1, None], [None, 2]), ([1], [1]), (None, [1]), ([], [])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(arrays.has_intersection(F.col("a"), F.col("b"))).collect()] == [False, True, False, False]
    rep = one(spark, arrays.max_repetition(F.array(*[F.lit(x) for x in (1, 2, 2, 2)])))
    assert rep == (3,)


def test_nearest_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 1.0]), (3, [0.0, 1.0, 0.0]), (4, [1.0, 1.0, 1.0])], "id int, v array<double>")
    arr = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    near = lambda w: topk.nearest(df, vectors.weighted_distance(F.col("v"), arr(0, 1, 1), w), "id").first()["id"]
    assert (near(arr(1, 1, 1)), near(arr(0, 1, 1))) == (2, 4)


def test_top_labels(spark):
    s = F.array(*[F.struct(F.lit(x).alias("score"), F.lit(n).alias("label")) for x, n in ((0.2, "c"), (0.5, "b"), (0.5, "a"), (0.9, "d"))])
    assert [r["label"] for r in one(spark, topk.top_labels(s, 0.3, 2))[0]] == ["d", "a"]


def test_partial_ratio():
    assert scoring._partial("chicken", "chicken thigh") == 100.0
    assert scoring._common("abcde", "ace") == 3
    # 'abd' against the stretches of 'xabcx': the best one, 'abc', shares two of three letters.
    assert round(scoring._partial("abd", "xabcx"), 4) == round(200 * 2 / 6, 4)
