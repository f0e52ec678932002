"""Threshold search against the full product of queries and rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import exact_search as S

SMALL = "/root/testdata/sf0.001"


def brute(rows, every, k, scale=S.SCALE):
    """rows: (id, vector); equal rows are candidates each and one query."""
    whole = lambda v: None if v is None or any(x is None or not math.isfinite(x) for x in v) else tuple(math.floor(scale * x) for x in v)
    good = [(i, w) for i, v in rows if (w := whole(v)) is not None]
    out = []
    for i, w in sorted(set((i, w) for i, w in good if i is not None and i % every == 0)):
        cand = [(-sum(a * b for a, b in zip(w, x)), j is None, j or 0) for j, x in good if j != i and len(x) == len(w)]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(cand)[:k], 1)]
    return sorted(out, key=str)


def answers(df, every, **more):
    return sorted((tuple(r) for r in S.top_k(df, F.col("id") % every == 0, **more).collect()), key=str)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in S.op13_topk(spark, SMALL).collect()), key=str)
    assert got == brute(rows, 100, 10)


@pytest.mark.parametrize("kind", ["ties", "sparse", "large", "copies"])
def test_kinds_of_vectors_in_many_blocks(spark, kind):
    rnd = np.random.default_rng(3)
    n, d = 400, 6
    if kind == "ties":
        values = rnd.integers(-1, 2, (n, d)).astype(float)
    elif kind == "sparse":
        values = rnd.exponential(1, (n, d)) ** 4 * (rnd.random((n, d)) < 0.3)
    elif kind == "large":
        values = rnd.normal(0, 2.0**18, (n, d))
    else:
        values = np.repeat(rnd.normal(0, 1, (n // 100, d)), 100, 0)
    ids = rnd.integers(0, 60, n) if kind == "copies" else rnd.permutation(n)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, values)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for size in (7, 1000):
        assert answers(df, 4, k=5, most=size, least=size) == brute(rows, 4, 5)


def test_edges_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [0.0, 0.0]), (0, [1.0, 2.0]), (0, [-1.0, 0.5])]
    rows += [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (10, [0.0, 0.0]), (20, []), (7, []), (30, [1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, block int")
    for size in (3, 1000):
        assert answers(df, 10, k=4, most=size, least=size) == brute(rows, 10, 4)
    assert answers(df.limit(0), 10) == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert answers(one, 10) == []


def test_reading_stops_before_the_lists_end():
    """A few long vectors decide the result: the others are not met."""
    rnd = np.random.default_rng(1)
    vectors = rnd.integers(0, 50, (20_000, 4))
    vectors[:20] += 1000
    block = S.Block(np.arange(20_000), np.zeros(20_000, bool), np.ones(20_000, np.int64), vectors)
    depth = []
    bounds = block.bounds
    block.bounds = lambda q, d: depth.append(d) or bounds(q, d)
    queries = rnd.integers(1, 9, (3, 4))
    for q, at, score in block.top(np.array([-1, -1, -1]), queries, 10):
        full = vectors @ queries[q]
        order = np.lexsort((np.arange(20_000), -full))[:10]
        assert at.tolist() == order.tolist() and score.tolist() == full[order].tolist()
    assert max(depth) < 2000


def test_scores_beyond_64_bits_are_refused():
    big = np.full((2, 4), 1 << 40)
    block = S.Block(np.arange(2), np.zeros(2, bool), np.ones(2, np.int64), big)
    with pytest.raises(ValueError):
        list(block.top(np.array([9]), big[:1], 1))
