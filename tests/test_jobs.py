"""Exact cases of the domain jobs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import quality as D
from larder.operators import windows as W
from larder.plans import baskets as B
from larder.plans import experiments as X
from larder.plans import facts
from larder.plans import forecasting as P
from larder.plans import menus as M
from larder.plans import recommend as R
from larder.plans import tagging as G


def test_rank_by_score_ties_keep_input_order(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([1, 3, 2, 2, 5, 9, 4])], "id int, score int").withColumn("u", F.lit(1))
    got = {r.id: r.order_rank for r in W.rank_by_score(df, ["u"], "score", "id").collect()}
    assert [got[i] for i in range(7)] == [7, 4, 5, 6, 2, 1, 3]


def test_content_based_order(spark):
    ratings = spark.createDataFrame([(1, 1, 2), (2, 1, 3), (2, 2, 1), (1, 2, 5), (2, 3, 5)], "user int, item int, rating int")
    tags = lambda d: spark.createDataFrame([(i, t) for i, ts in d.items() for t in ts], "item int, tag string")
    known = tags({1: ["t_rask", "t_laktosefri", "i_tomat", "i_laks"], 2: ["t_rask", "i_spagetti", "i_kjott"], 3: ["t_laktosefri", "i_kylling"]})
    new = tags({10: ["t_rask", "i_kjott"], 13: ["t_laktosefri", "i_laks", "i_spagetti"]}).withColumn("menu", F.lit(1))
    users = spark.createDataFrame([(1, 1), (2, 1)], "user int, menu int")
    scores = R.cb_score(R.cb_train(ratings, known), users, new, ["menu"])
    best = {u: [r.item for r in sorted(scores.where(F.col("user") == u).collect(), key=lambda r: -r.score)] for u in (1, 2)}
    assert best == {1: [10, 13], 2: [13, 10]}


def test_deviation_ratings(spark, rows):
    o = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "a")], "user int, week int, item string")
    d = spark.createDataFrame([(1, 1, "b"), (1, 1, "c"), (1, 2, "z")], "user int, week int, item string")
    assert rows(R.deviation_ratings(o, d), "user", "item", "rating") == [(1, "a", 4), (1, "c", 0), (2, "a", 4)]


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.91])
def test_similar_items_is_exact(spark, threshold):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 8))
    known = {i: base[i % 40] + (0.3 * rng.standard_normal(8) if i >= 60 else 0) for i in range(120)}
    new = {1000 + i: base[i] * 2 + 0.1 * rng.standard_normal(8) for i in range(30)}
    new[2000] = new[1000]
    frame = lambda d: spark.createDataFrame([(k, [float(x) for x in v]) for k, v in d.items()], "id long, v array<double>")
    got = {r.id: (r.similar_item, round(r.similarity, 9)) for r in R.similar_items(frame(new), frame(known), "id", "v", 8, threshold, pivots=4).collect()}
    unit = lambda v: v / np.linalg.norm(v)
    want = {}
    for i, v in new.items():
        s, k = max(((round(float(unit(v) @ unit(w)), 12), -j) for j, w in known.items()))
        if s > threshold:
            want[i] = (-k, round(s, 9))
    assert got == want


def test_user_vectors(spark):
    rows = [(1, 0.1, 1.0, 0.0), (1, 0.3, 1.0, 1.0), (2, 0.5, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "c int, time double, fish double, vegan double")
    target, imp = B.user_vectors(df, "c", ["time"], ["fish", "vegan"])
    t = {r.c: r for r in target.collect()}
    assert (round(t[1].time, 9), t[1].fish, t[1].vegan, t[2].time) == (0.2, 1.0, 0.5, 0.5)
    (w,) = imp.collect()
    assert w.c == 1 and math.isclose(w.time + w.fish + w.vegan, 1.0) and math.isclose(w.time, 1 / 3) and w.fish > w.vegan


def test_greedy_basket_matches_brute_force(spark):
    rnd = random.Random(4)
    items = [(1, f"i{n}", rnd.random(), rnd.random(), rnd.choice("pq")) for n in range(9)]
    menu = B.menu_arrays(spark.createDataFrame(items, "m int, id string, a double, b double, g string"), ["m"], "id", ["a", "b"], "g")
    target, weight = [0.4, 0.8], [0.5, 1.0]
    cust = spark.createDataFrame([(7, 1, target, weight)], "customer int, m int, target array<double>, weight array<double>")
    for repeat in (0.0, 0.7):
        got = B.greedy_basket(cust, menu, ["m"], 4, repeat_weight=repeat).first()
        chosen, left = [], list(items)
        for step in range(1, 5):
            def err(i):
                rows = chosen + [i]
                e = sum((10 * (sum(r[2 + d] for r in rows) / step - target[d]) * weight[d]) ** 2 for d in range(2))
                return e + ((10 * repeat / len({r[4] for r in rows})) ** 2 if repeat else 0)
            best = min(left, key=lambda i: (round(err(i), 9), i[1]))
            chosen.append(best)
            left.remove(best)
        assert got.basket == [i[1] for i in chosen]
    short = B.greedy_basket(cust, menu, ["m"], 12).first()
    assert sorted(short.basket) == sorted(i[1] for i in items)


def _concept_vectors(spark, chosen):
    values = {"fish": 2.0, "rice": 0.0, "pasta": 0.0, "is_low_calorie": 2.0, "is_roede_percentage": 0.0}
    rows = [(c, x, f, i, 0.5) for c, xs in chosen.items() for x in xs for f, i in values.items()]
    return spark.createDataFrame(rows, "customer int, concept string, feature string, importance double, target double")


def test_variation_and_calorie_steps(spark):
    chosen = {1: ["quick"], 2: ["low"], 3: ["points", "quick"], 4: ["quick", "veg"], 5: ["quick"], 6: ["low", "veg"]}
    history = spark.createDataFrame([(5, "fish", 1.0, 0.25)], "customer int, feature string, importance double, target double")
    groups = {"protein": (1.0, ["fish"]), "carbohydrate": (0.2, ["rice", "pasta"]), "nothing": (0.7, ["absent"])}
    out = B.blend_vectors(
        _concept_vectors(spark, chosen), history, {"mean_rank": (1.0, 0.0)}, variation=groups, calorie=B.CalorieConcepts("low", "veg", "points")
    )
    got = {c: {} for c in chosen}
    for r in out.collect():
        got[r.customer][r.feature] = (r.importance, r.target)
    # Only the carbohydrates are missing: 1 for their two features, 2 in all; then calories, then 0.65 for the fixed feature.
    vectors = {  # fish, rice, pasta, is_low_calorie, is_roede_percentage before the fixed feature
        1: [(0.25, 0.5), (0.25, 0.2), (0.25, 0.2), (0.5, 0.0), (1.0, 0.0)],
        2: [(0.25, 0.5), (0.25, 0.2), (0.25, 0.2), (1.0, 1.0), (0.0, 0.0)],
        3: [(0.25, 0.5), (0.25, 0.2), (0.25, 0.2), (0.25, 0.5), (1.0, 1.0)],
        4: [(0.25, 0.5), (0.25, 0.2), (0.25, 0.2), (0.25, 0.5), (1.0, 0.0)],
        6: [(0.25, 0.5), (0.25, 0.2), (0.25, 0.2), (0.25, 0.5), (1.0, 0.0)],
    }
    features = ["fish", "rice", "pasta", "is_low_calorie", "is_roede_percentage"]
    for customer, want in vectors.items():
        total = 0.35 * sum(i for i, _ in want) + 0.65
        for f, (i, target) in zip(features, want):
            assert got[customer][f] == (pytest.approx(0.35 * i / total), pytest.approx(target)), (customer, f)
        assert sum(i for i, _ in got[customer].values()) == pytest.approx(1)
    # With history: no variation, and the calorie features come on top of what sums to 1.
    assert got[5]["rice"] == (0.0, 0.0) and got[5]["is_low_calorie"] == (0.5, 0.0) and got[5]["is_roede_percentage"] == (1.0, 0.0)
    assert got[5]["fish"] == (pytest.approx(0.35 * (0.5 + 10) / 11), 0.5) and got[5]["mean_rank"] == (pytest.approx(0.65), 0.0)


def test_all_groups_missing_share_alike(spark):
    rows = [(c, f, 0.0, 0.3) for c in (1, 2) for f in ("a", "b", "c")] + [(2, "d", 1.0, 0.4)]
    v = spark.createDataFrame(rows, "customer int, feature string, i double, t double")
    groups = {"x": (1.0, ["a"]), "y": (0.5, ["b", "c"])}
    got = {(r.customer, r.feature): (r.i, r.t) for r in B.add_variation(v, groups, F.lit(True)).collect()}
    assert [got[1, f] for f in "abc"] == [(0.5, 1.0), (0.25, 0.5), (0.25, 0.5)]
    assert [got[2, f] for f in "abcd"] == [(0.25, 1.0), (0.125, 0.5), (0.125, 0.5), (0.5, 0.4)]
    assert B.add_variation(v.limit(0), groups, F.lit(True)).count() == 0


def test_filter_cascade_levels(spark):
    menu = spark.createDataFrame([(1, [("a", ["nut"]), ("b", ["fish"]), ("c", [])])], "m int, menu array<struct<item:string,preferences:array<string>>>")
    cust = spark.createDataFrame(
        [(1, 1, [], ["fish"]), (2, 1, ["nut"], ["fish"]), (3, 1, ["nut", "fish"], [])],
        "customer int, m int, allergies array<string>, dislikes array<string>",
    )
    got = {r.customer: (r.compliancy, r["items"]) for r in B.filter_cascade(cust, menu, ["m"], F.lit(2)).collect()}
    assert got == {1: (3, ["a", "c"]), 2: (2, ["b", "c"]), 3: (1, ["a", "b", "c"])}


def test_minmax_nulls_and_constants(spark):
    df = spark.createDataFrame([("g", 2.0, 5.0), ("g", 4.0, 5.0), ("g", None, 5.0), ("g", float("nan"), 5.0)], "k string, x double, c double")
    got = [(r.x, r.c) for r in B.minmax_by_group(df, ["k"], ["x", "c"]).collect()]
    assert sorted(got) == [(0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_item_preferences(spark):
    ing = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (2, 1, 12)], "recipe int, portion int, ingredient int")
    al = spark.createDataFrame([(10, "nut", False), (11, "egg", True), (12, None, False)], "ingredient int, preference string, is_trace boolean")
    pref = spark.createDataFrame([(1, 1, "spicy"), (1, 1, "nut"), (3, 1, None)], "recipe int, portion int, preference string")
    got = {r.recipe: r.preferences for r in M.item_preferences(ing, al, pref, ["recipe", "portion"], "none").collect()}
    assert got == {1: ["nut", "spicy"], 3: ["none"]}


def test_unwanted_share(spark):
    b = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "veg")], "b int, concept string")
    lines = spark.createDataFrame([(1, True), (1, False), (2, False), (3, False), (4, True)], "b int, veg boolean")
    got = D.unwanted_share(b, lines, "b", F.col("concept") == "veg", F.col("veg")).first()[0]
    assert math.isclose(got, 1 / 3)


def test_moving_average_needs_full_window(spark):
    df = spark.createDataFrame([(1, w, float(w)) for w in (1, 2, 3, 5)], "k int, week int, v double")
    got = {r.week: r.moving_avg_2 for r in W.moving_avg(df, ["k"], ["week"], "v", [2]).collect()}
    assert got == {1: None, 2: None, 3: 1.5, 5: 2.5}


def test_label_ahead_near_the_end(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([0, 1, 9, 0, 9])], "k int, t int, v int")
    got = {r.t: r.label for r in W.label_ahead(df, ["k"], "t", "v", 2).collect()}
    # Frames reach one to two rows ahead; the last row has nothing ahead and counts as active.
    assert got == {0: "churned", 1: "active", 2: "churned", 3: "churned", 4: "active"}


def test_student_t_tail():
    # Table values: t(0.975; 10) and t(0.95; 1).
    assert abs(X._upper_t(2.228138852, 10) - 0.025) < 1e-9
    assert abs(X._upper_t(6.313751515, 1) - 0.05) < 1e-9
    assert abs(X._upper_t(-1.0, 5) - (1 - X._upper_t(1.0, 5))) < 1e-12


def test_ab_test_p_values(spark):
    df = spark.createDataFrame([(True, x) for x in (1.0, 2.0, 3.0, 4.0)] + [(False, x) for x in (2.0, 4.0, 6.0, 8.0)], "g boolean, v double")
    r = X.ab_test(df, F.col("g"), "v").first()
    # Variance ratio exactly 4 is not below the limit: Welch.
    assert not r.equal_var and math.isclose(r.t_statistic, -2.5 / math.sqrt(5 / 12 + 5 / 3))
    assert 0.1 < r.p_value < 0.2 and r.effect_size == "large"
    greater = X.ab_test(df, F.col("g"), "v", "greater").first().p_value
    less = X.ab_test(df, F.col("g"), "v", "less").first().p_value
    assert math.isclose(greater + less, 1.0) and math.isclose(r.p_value, 2 * less)


def test_mann_whitney_counts_pairs(spark):
    a, b = [1.0, 4.0, 4.0, 9.0], [2.0, 4.0, 7.0]
    df = spark.createDataFrame([(True, x) for x in a] + [(False, x) for x in b], "g boolean, v double")
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert X.mann_whitney(df, F.col("g"), "v").first().u_statistic == u


def test_fuzzy_tags_with_penalty(spark, rows):
    tk = spark.createDataFrame([(1, "kyllingfilet"), (2, "kylling"), (3, "kyling"), (4, "svin")], "id int, token string")
    tags = {"chicken": ["kylling"], "pork": ["svinn"]}
    got = rows(G.fuzzy_tags(tk, "id", tags, 80.0, [("svin", "svinn")], 30.0), "id", "tag")
    assert got == [(1, "chicken"), (2, "chicken"), (3, "chicken")]


def test_holiday_features(spark):
    days = spark.sql("select explode(sequence(date'2024-04-29', date'2024-05-12')) as day")
    hol = spark.sql("select date'2024-05-09' as day, 'ascension' as holiday union all select date'2024-05-01', 'labour'")
    got = {str(r.day)[-5:]: r for r in P.holiday_days(days, hol).collect()}
    assert got["05-10"].is_squeeze_day and not got["05-02"].is_squeeze_day
    assert got["05-09"].is_holiday_on_thursday and not got["05-09"].is_long_weekend
    assert (got["05-01"].days_until_next_holiday, got["05-01"].days_since_last_holiday) == (8, 2)
    assert got["05-10"].days_until_next_holiday == 2


def test_training_features_by_target(spark):
    weekly = spark.createDataFrame([(1, 2024, w, 10 * w, 0.5) for w in range(1, 4)], "company int, year int, week int, a int, b double")
    est = [(1, 2024, 1, 0, 5, 2), (1, 2024, 2, 0, 10, None), (1, 2024, 3, 0, 0, 6), (1, 2024, 2, -1, 1, 1), (1, 2024, 2, 4, 7, None), (1, 2024, 9, 0, 1, 1)]
    est = spark.createDataFrame([(*r[:3], "2024-01-01", *r[3:]) for r in est],
        "company int, year int, week int, estimation_date string, days_to_cutoff int, t int, d int")
    holidays = spark.createDataFrame([(2024, 2, 1)], "year int, week int, easter int")
    out = P.training_features(weekly, est, holidays, ["a", "b"], "t", "d").orderBy("week").collect()
    # After the cutoff, without a week of orders, and 4 days ahead, where no row is whole: no rows.
    assert [(r.week, r.days_to_cutoff, r.easter) for r in out] == [(1, 0, 0), (2, 0, 1), (3, 0, 0)]
    assert {(r.a_rate_t, r.b_rate_t) for r in out} == {(2.0, 0.05)}  # medians of 2, 2, 0 and 0.1, 0.05, 0
    assert {r.a_rate_d for r in out} == {5.0} and out[0].b_rate_d == pytest.approx((0.25 + 0.5 / 6) / 2)  # of 5 and 5
    assert [r.a_projected_t for r in out] == [10.0, 20.0, 0.0] and [r.a_projected_d for r in out] == [10.0, None, 30.0]
    assert P.training_features(weekly.limit(0), est, holidays, ["a", "b"], "t", "d").count() == 0


def test_order_fact_knows_swaps_only_where_plans_exist(spark):
    lines = spark.createDataFrame([(o, i, 1.0, 5.0) for o in (1, 2, 3, 4) for i in (10, 11)], "order long, item long, quantity double, amount double")
    plan = spark.createDataFrame([(o, i, 1.0) for o in (1, 2, 3) for i in (10, 12)], "order long, item long, planned_quantity double")
    heads = [(1, 7, "2020-01-06", True), (2, 7, "2020-01-06", False), (3, 7, "2010-01-04", True), (4, 7, "2020-01-06", True)]
    orders = spark.createDataFrame(heads, "order long, customer long, menu_week string, is_subscription boolean").withColumn("menu_week", F.to_date("menu_week"))
    fact = facts.order_fact(lines, plan, orders, F.lit("2015-01-01").cast("date"), F.lit("2018-01-01").cast("date"))
    flags = {r.order: (r.has_swap, r.is_adjusted) for r in fact.select("order", "has_swap", "is_adjusted").distinct().collect()}
    # A swap and an adjustment; no subscription; before plans were kept; no plan after every order has one.
    assert flags == {1: (True, True), 2: (None, None), 3: (None, None), 4: (False, True)}


def test_hierarchy_of_seven_levels_and_too_deep(spark):
    tree = spark.createDataFrame([(f"c{i}", f"c{i + 1}" if i < 6 else None) for i in range(7)], "category string, parent string")
    leaves = spark.createDataFrame([(1, "c0")], "leaf long, start string")
    assert facts.flatten_hierarchy(leaves, "leaf", "start", tree).count() == 7
    with pytest.raises(Exception, match="deeper"):
        facts.flatten_hierarchy(leaves, "leaf", "start", tree, levels=6).collect()


def test_attribute_outside_the_stated_columns_is_an_error(spark):
    from larder.operators.aggregates import pivot_attributes

    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3)], "k long, attr string, v long")
    assert pivot_attributes(df, ["k"], "attr", F.max("v")).columns == ["k", "a", "b"]
    with pytest.raises(Exception, match="not among"):
        pivot_attributes(df, ["k"], "attr", F.max("v"), ["a"]).collect()


def test_text_labels_cover_every_document(spark):
    import __spark_entry__ as entry_points

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.lang: r for r in entry_points.queries()["job_39_labels"](spark, folder).collect()}
    want = {r.lang: (r["n"], r.held) for r in docs.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.expr("doc_id % 4 = 1")).alias("held")).collect()}
    assert {k: (r.n_docs, r.n_held_out) for k, r in got.items()} == want
    assert all(r.n_right > 0.8 * r.n_docs and r.held_out_accuracy >= 0.8 for r in got.values())


@pytest.mark.parametrize("n", [1, 3, 50])
def test_menu_top_n_is_the_pooled_cosine(spark, n):
    rnd = np.random.default_rng(4)
    vectors = np.concatenate([rnd.normal(size=(20, 5)), rnd.integers(-1, 2, (20, 5))])
    vectors[3], vectors[30] = vectors[4], 0
    history = [(u, int(i)) for u in range(6) for i in rnd.choice(40, 1 + 2 * u)] + [(0, 39), (0, 39), (None, 3), (9, 77)]
    menus = [(2024, w, int(i)) for w in (1, 2) for i in rnd.choice(40, 15, replace=False)] + [(2024, 1, 99), (2025, 1, 3), (2025, 1, 3)]
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(99, None)], "item int, embedding array<double>")
    got = R.menu_top_n(
        spark.createDataFrame(history, "user int, item int"), e, spark.createDataFrame(menus, "year int, week int, item int"), ["year", "week"], n
    )
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    units = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    want = set()
    for user in range(6):
        mine = sorted({i for u, i in history if u == user})
        for menu in {(y, w) for y, w, _ in menus}:
            sold = sorted({i for y, w, i in menus if (y, w) == menu and i < 40})
            pooled = np.round(units[mine] @ units[sold].T, 12).max(0)
            best = sorted(zip(-pooled, sold))[:n]
            want |= {(user, *menu, i, k, round(float(-s), 9)) for k, (s, i) in enumerate(best, 1)}
    assert {(r.user, r.year, r.week, r.item, r.rank, round(r.score, 9)) for r in got.collect()} == {(*w[:5], w[5] + 0.0) for w in want}


@pytest.mark.parametrize("k", [1, 4, 100])
def test_cb_top_equals_the_best_of_all_scores(spark, rows, k):
    rnd = random.Random(6)
    tags = [f"t{i}" for i in range(14)]
    profiles = [(u, tag, rnd.choice([rnd.expovariate(1) ** 3, -rnd.random(), 0.0, 0.5])) for u in range(12) for tag in rnd.sample(tags, rnd.randrange(1, 12))]
    profiles += [(20, "t1", -1.0), (21, "elsewhere", 5.0), (22, "t0", 1e-7)]
    users = [(u, "ab"[u % 2], w) for u in range(24) for w in (1, 2)]
    menu = [(m, w, f"i{i}", tag) for m in "ab" for w in (1, 2) for i in rnd.sample(range(60), 25) for tag in rnd.sample(tags, rnd.randrange(1, 5))]
    p = spark.createDataFrame(profiles, "user int, tag string, weight double")
    u = spark.createDataFrame(users, "user int, company string, week int")
    c = spark.createDataFrame(menu + menu[:9], "company string, week int, item string, tag string")
    on = ["company", "week"]
    every = R.cb_score(p, u, c, on).withColumn("score", F.round("score", 9))
    want = R.top_k(every, [*on, "user"], [F.desc("score"), F.col("item")], k)
    cols = ("company", "week", "user", "item", "rank", "score")
    assert rows(R.cb_top(p, u, c, on, k), *cols) == rows(want, *cols) and len(rows(want)) >= 12 * min(k, 25)


def test_lists_of_purchases_are_merged_where_the_user_is(spark):
    """A purchase was a row for every entry of its item's lists; now users meet the lists within their block."""
    rnd = np.random.default_rng(8)
    e = spark.createDataFrame([(i, rnd.normal(size=4).tolist()) for i in range(24)], "item int, embedding array<double>")
    menus = spark.createDataFrame([(i % 3, i) for i in range(24)], "week int, item int")
    history = [(u, int(i)) for u in range(50) for i in rnd.choice(24, 6, replace=False)]
    out = R.menu_top_n(spark.createDataFrame(history, "user int, item int"), e, menus, ["week"], 8)
    assert out.count() == 50 * 24
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()


def test_vectors_of_purchases_are_pooled_where_the_user_is(spark):
    """Each purchase carried its vector, or the sums of it, through the shuffle."""
    h = spark.createDataFrame([(u, u % 4, 202401, "a") for u in range(50)], "user int, item int, year_week int, concept string")
    e = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "item int, embedding array<double>")
    out = R.user_profile(h, spark.createDataFrame([(u, "a") for u in range(50)], "user int, concept string"), e, 2)
    assert out.count() == 50
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_users_whose_rows_go_on_in_the_next_batch(spark, batch):
    rnd = np.random.default_rng(5)
    vectors = {i: rnd.normal(size=3) for i in range(12)}
    vectors[4][1] = None
    history = [(u, int(i)) for u in (None, 1, 2, 2**60 + 1) for i in rnd.integers(0, 14, 40)] + [(7, 13)]
    e = spark.createDataFrame([(i, [None if math.isnan(x) else float(x) for x in v]) for i, v in [*vectors.items(), (3, vectors[3])]], "item int, embedding array<double>")
    h = spark.createDataFrame([(u, i, 202401, "a") for u, i in history], "user long, item int, year_week int, concept string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r.user: r for r in R.user_profile(h, spark.createDataFrame([(1, "a")], "user long, concept string"), e, 3).collect()}
        best = R.menu_top_n(h, e, spark.createDataFrame([(None, i) for i in range(12)], "week int, item int"), ["week"], 3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {None, 1, 2, 2**60 + 1}
    for u, r in got.items():
        mine = [vectors[i] for w, i in history if w == u and i < 12 for _ in range(1 + (i == 3))]
        assert r.n_items == len(mine)
        assert r.mean_vector == pytest.approx(np.nansum(mine, axis=0) / len(mine)) and r.max_vector == pytest.approx(np.nanmax(mine, axis=0))
    assert {r.user for r in best} == {1, 2, 2**60 + 1} and len(best) == 9


@pytest.fixture
def user_frames(spark):
    """Profiles, users, candidates and purchases, with joins that Spark does not turn into broadcasts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ratings = spark.createDataFrame([(u, f"d{(u * 7 + i) % 9}", i % 5 - 2) for u in range(40) for i in range(6)], "user int, item string, rating int")
    tags = spark.createDataFrame([(u % 3, f"d{i}", f"t{(i * k) % 4}") for u in range(3) for i in range(9) for k in (1, 2)], "menu int, item string, tag string")
    yield R.cb_train(ratings, tags), spark.createDataFrame([(u, u % 3) for u in range(40)], "user int, menu int"), tags, ratings
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")


def dealt_by_user_and_more(df):
    """The shuffles of a plan by the user and further columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "hashpartitioning(" in line and "user#" in line and line.split("hashpartitioning(")[1].count("#") > 1]


def test_scores_are_not_dealt_again(spark, user_frames):
    profiles, users, tags, ratings = user_frames
    items = tags.select("item", F.lit("x").alias("main_ingredient"), F.array(F.lit("a")).alias("allergens"), F.lit(1).alias("weeks_since_last")).distinct()
    likes = users.select("user", F.array(F.lit("b")).alias("allergens"), F.array(F.lit("x")).alias("unwanted"))
    final = R.adjust_scores(R.cb_score(profiles, users, tags, ["menu"]).drop("menu"), ratings, items, likes)
    assert dealt_by_user_and_more(final) == []
    assert final.count() == 40 * 9


def test_lists_and_their_precision_are_not_dealt_again(spark, user_frames):
    profiles, users, tags, ratings = user_frames
    best = R.recommendations(R.cb_score(profiles, users, tags, ["menu"]), ["user"], "score", 3)
    out = R.precision_at_k(best, ratings, ["user"])
    assert dealt_by_user_and_more(out) == []
    assert {(r.n_purchased, r.n_purchased_recommendations <= 3) for r in out.collect()} == {(6, True)}


@pytest.mark.parametrize("k", [2, 20])
def test_best_of_menus_are_not_dealt_again(spark, user_frames, k):
    profiles, users, tags, _ = user_frames
    out = R.cb_top(profiles, users, tags, ["menu"], k)
    assert dealt_by_user_and_more(out) == []
    assert out.count() == 40 * min(k, 9)


def test_only_tokens_that_bring_a_tag_are_shuffled(spark, rows):
    docs = spark.createDataFrame([(1, ["red", "ring"]), (1, ["red"]), (2, ["ring", "string"]), (3, ["sea"]), (None, ["red"])], "id int, words array<string>")
    tokens = docs.select("id", F.explode("words").alias("token")).distinct()
    mapping = {"colour": ["red", "blue"], "round": ["ring"], "warm": ["red"]}
    exact, part = G.exact_tags(tokens, "id", mapping), G.substring_tags(tokens, "id", mapping, ["st"])
    for df in (exact, part):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
        # Read upwards, the words are filtered before the first shuffle.
        assert "token" in plan.split("Exchange")[-1].split("Filter")[1]
    want = [(None, "colour"), (None, "warm"), (1, "colour"), (1, "round"), (1, "warm"), (2, "round")]
    assert rows(exact) == want and rows(part) == want
    assert rows(G.substring_tags(tokens, "id", mapping, [])) == want
    assert rows(G.missing_tags(tokens, docs, "id", {"calm": ["red", "ring"]})) == [(None, "calm"), (3, "calm")]


def test_blend_holds_no_step_twice(spark):
    history = spark.createDataFrame([(5, "fish", 1.0, 0.25), (6, "sea", 1.0, 0.5), (None, "fish", 1.0, 1.0)], "customer int, feature string, importance double, target double")
    chosen = _concept_vectors(spark, {2: ["low"], 5: ["quick"], 6: ["points"], None: ["quick"]})
    out = B.blend_vectors(
        chosen, history, {"mean_rank": (1.0, 0.0), "rice": (3.0, 1.0)}, variation={"x": (1.0, ["fish"])}, calorie=B.CalorieConcepts("low", "veg", "points")
    )
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 4  # concepts, history and twice the roles
    got = {(r.customer, r.feature): r for r in out.collect()}
    assert len(got) == out.count() - 1 == 4 * 6  # fixed features join the concepts', but a missing customer is no one customer
    assert [got[c, "fish"].has_history for c in (2, 5, 6, None)] == [False, True, True, False]
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
