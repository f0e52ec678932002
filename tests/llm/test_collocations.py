"""Collocations against counting every phrase in a dictionary."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from larder.llm import collocations as C

SMALL = "/root/testdata/sf0.001"


def pieces(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least=100, words=5, top=2000, share=100):
    langs = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for w in pieces(text):
            for k in range(1, words + 1):
                for i in range(len(w) - k + 1):
                    langs[lang or "und" if lang is None else lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in langs.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = collections.defaultdict(int)
        for p, c in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], c)
        found = []
        for p, a in cand.items():
            if 100 * inside[p] >= share * a:
                continue
            s, k, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def answers(df, **more):
    return sorted(tuple(r) for r in C.collocations(df, **more).collect())


@pytest.fixture(scope="module")
def corpus_rows():
    rnd = random.Random(4)
    common = ["of", "the", "Of", "THE", "a", "é", "É", "漢字"]
    rare = [f"w{i}" for i in range(40)]
    text = lambda: "".join(rnd.choice(common * 3 + rare) + rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "\x1f", "\xa0"]) for _ in range(rnd.randrange(60)))
    rows = [(rnd.choice(["en", "en", "fr", None, "und"]), text()) for _ in range(150)]
    rows += [("en", "Licensed under the terms of this license, as is")] * 40
    rows += [("en", "of the " + rnd.choice(rare) + " of the " + rnd.choice(rare)) for _ in range(400)]
    rows += [(None, None), ("en", None), ("xx", ""), ("fr", " \t.;"), ("en", "of the " * 3000)]
    return rows


@pytest.mark.parametrize(("least", "size", "hot"), [(3, 1 << 21, None), (3, 300, 2), (5, 1000, 8), (40, 100, 40)])
def test_against_counting(spark, corpus_rows, least, size, hot):
    df = spark.createDataFrame([(t, lang, "x", 7) for lang, t in corpus_rows], "text string, lang string, phrase string, n int").repartition(4)
    assert answers(df, least=least, size=size, hot=hot) == brute(corpus_rows, least)


def test_top_and_share(spark, corpus_rows):
    df = spark.createDataFrame(corpus_rows, "lang string, text string")
    assert answers(df, least=3, top=7, share=60) == brute(corpus_rows, 3, top=7, share=60)


def test_whole_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in C.op12_collocations(spark, SMALL).collect())
    assert got == brute(rows)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert answers(df, least=12) == brute(rows, 12)


def test_no_rows(spark):
    schema = "lang string, text string"
    assert answers(spark.createDataFrame([], schema)) == []
    assert answers(spark.createDataFrame([("en", "one two three")], schema)) == []


def test_large_counts_are_exact(spark):
    """1000 * a * n passes 64 bits."""
    big = 4_000_000_007
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    one, two = (1).to_bytes(8, "little"), (2).to_bytes(8, "little")
    frequent = frame([(bytearray(one), "en", bytearray(b"x"), big + 5), (bytearray(two), "en", bytearray(b"y"), 3 * big)], "symbol binary, lang string, word binary, f long")
    sizes = frame([("en", 10**13 + 1)], "lang string, n long")
    phrases = frame([(bytearray(one + two), 2, big)], "phrase binary, depth int, f long")
    (r,) = C.ranked(frequent, sizes, phrases, 5, 100).collect()
    assert r.score == 1000 * big * (10**13 + 1) // ((big + 5) * 3 * big) and r.phrase == "x y"


def test_partitions_against_prefix_counts():
    rnd = np.random.default_rng(2)
    rows = rnd.integers(0, 4, (3000, 5)) * (rnd.integers(0, 5, (3000, 5)) > 0)
    rows[(np.cumsum(rows == 0, 1) > 0)] = 0  # nothing behind the end of a suffix
    rows = rows[rows[:, 0] > 0].astype(np.uint64)
    n = rnd.integers(1, 4, len(rows))
    want = collections.Counter()
    for r, c in zip(rows.tolist(), n.tolist()):
        for d in range(1, 6):
            if r[d - 1]:
                want[tuple(r[:d])] += c
    for least, complete in ((1, 1), (30, 1), (30, 3)):
        got = {tuple(rows[p, :d].tolist()): c for d, p, c in zip(*(x.tolist() for x in C.partition_counts(list(rows.T.copy()), n, least, complete)))}
        assert got == {p: c for p, c in want.items() if c >= least or len(p) < complete}


def test_shared_symbols_take_another_seed(spark, monkeypatch):
    texts = spark.createDataFrame([("en", "aa bb aa bb aa bb cc")], "lang string, text string")
    real = C.symbol_of
    words, seed = C.proven_words(texts, 3)
    assert seed == 0 and words.count() == 3
    calls = []

    def counts(t, s):
        calls.append(s)
        frame = real_counts(t, s)
        return frame if s else frame.withColumn("symbol", C.F.lit(bytearray(b"12345678")))

    real_counts = C.word_counts
    monkeypatch.setattr(C, "word_counts", counts)
    assert C.proven_words(texts, 3)[1] == 1 and calls == [0, 1] and real is C.symbol_of
