"""Similarity join against all pairs compared in plain Python."""

import random
import re

import numpy as np
import pytest

from larder.llm import jaccard
from larder.llm.common import corpus
from larder.llm.components import components


def plain(rows):
    """doc_id -> (set size, component) by comparing all pairs of different sets."""
    sets = {}
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    distinct = sorted({s for s in sets.values() if s}, key=len)
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    inverted = {}
    for s in distinct:
        for t in {t for g in s for t in inverted.get(g, ())}:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                root[find(s)] = find(t)
        for g in s:
            inverted.setdefault(g, []).append(s)
    smallest = {}
    for d, s in sets.items():
        if s:
            smallest[find(s)] = min(d, smallest.get(find(s), d))
    return {d: (len(s), smallest[find(s)] if s else d) for d, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in corpus(spark, folder).collect()]
    assert got(jaccard.op6_jaccard(spark, folder)) == plain(rows)


@pytest.mark.parametrize("frequent", [1, 64])
def test_groups_of_edited_copies(spark, frequent, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "SHORT", 4)
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, "one two three")]
    for g in range(3):
        base = rng.choices(vocabulary, k=rng.randint(30, 80))
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) + 100 * g, " ".join(words)))
    shared = " ".join(rng.choices(vocabulary, k=40))
    rows += [(5000 + i, shared + " " + " ".join(rng.choices(vocabulary, k=40))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.similar_components(df)) == plain(rows)


def test_nulls_repeats_and_empty(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(7, text, 1), (7, text, 2), (None, text, 3), (9, text.upper(), 4), (None, "", 5)], "doc_id long, text string, n long")
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.similar_components(df).collect()) == [
        ("7", 3, 7), ("7", 3, 7), ("9", 3, 7), ("None", 0, None), ("None", 3, 7)]
    assert jaccard.similar_components(df.limit(0)).count() == 0


def test_links_through_documents_without_an_id(spark):
    words = [f"w{i}" for i in range(84)]
    changed = lambda at: [f"x{i}" if i in at else w for i, w in enumerate(words)]
    chain = [" ".join(changed(at)) for at in ({0, 10}, set(), {70, 83})]
    assert [c for _, c in plain(enumerate(chain)).values()] == [0, 0, 0]
    assert [c for _, c in plain([(0, chain[0]), (2, chain[2])]).values()] == [0, 2]
    # The copies without an id are two rows of one class; another text without an id links with nothing.
    rows = [(4, chain[0]), (None, chain[1]), (None, chain[1].upper()), (9, chain[2]), (None, "something else stands here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.similar_components(df).collect())
    assert found == [("4", 80, 4), ("9", 80, 4), ("None", 1, None), ("None", 80, 4), ("None", 80, 4)]


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(45)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert found == {x: find(x) for x in {y for p in links if p[0] != p[1] for y in p}}


def test_only_compared_texts_travel_and_only_hot_shingles_are_written(spark):
    """Before, every text went to the join and every packed count was written beside the documents."""
    words = [f"w{i}" for i in range(40)]
    pairs = [(i, " ".join([*words, f"x{i}"])) for i in range(2)] + [(None, " ".join([*words, "y"]))]
    rows = [*pairs, *[(100 + i, " ".join(f"z{i}_{k}" for k in range(30))) for i in range(300)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = df.selectExpr("doc_id is null as unnamed", "coalesce(doc_id, xxhash64(text)) as key", "text as t")
    left = {r.key for r in jaccard._likely(texts, texts.where("unnamed or key < 100")).collect()}
    assert {r.key for r in texts.where("unnamed or key < 100").collect()} <= left and len(left) < 20
    seen = jaccard.first_pass(spark.createDataFrame(rows + [(1000 + i, pairs[0][1]) for i in range(9)], df.schema), "doc_id", "text")
    assert seen.where("n is not null").count() == len(rows) + 9
    hot = seen.where("n is null").collect()
    assert 0 < len(hot) <= 12 and all(r.entries > jaccard.FREQUENT for r in hot)
    assert got(jaccard.similar_components(df.where("doc_id is not null"))) == plain([r for r in rows if r[0] is not None])


def test_links_that_connect_stay_fewer_than_the_members():
    """Before, members of long lists were written out as pairs, with the square of the list's size."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, np.uint64)
    sets = []
    for _ in range(120):  # below and above the limit of 0.75 from one another
        kept = rng.random(60) > rng.choice([0.05, 0.15])
        sets.append(np.unique(np.concatenate([base[kept], rng.integers(0, 1 << 63, rng.integers(0, 9), np.uint64)])))
    alike = lambda x, y: 4 * (both := len(np.intersect1d(x, y))) >= 3 * (len(x) + len(y) - both)

    def classes(links):
        root = list(range(len(sets)))
        for i, j in links:
            root = [root[i] if r == root[j] else r for r in root]
        return [root.index(r) for r in root]

    for first in (np.ones(120, bool), np.arange(120) < 50):
        second = first if first.all() else ~first
        every = [(i, j) for i in np.flatnonzero(first) for j in np.flatnonzero(second) if i != j and alike(sets[i], sets[j])]
        found = jaccard.spanning_links(sets, first, second)
        assert len(found) < len(sets) < len(every)
        assert set(found) <= set(every) and classes(found) == classes(every)


def test_long_lists_are_compared_in_tiles(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.candidates(df, "text", np.zeros(1, np.uint64)).collect()
    lists = [(r["list"], r["class"], r.n) for r in found if r.a is None]
    assert len(found) - len(lists) < 400 < len(lists)  # pairs of short lists only
    monkeypatch.setattr(jaccard, "TILE", 4096)
    members = spark.createDataFrame([(1, c, n) for c, n in {x[1:] for x in lists}], "list long, class long, n long")
    parts = members.selectExpr("class", "0 as fragment", "array(class) as shingles")
    tiles = jaccard.tiles(members, parts).groupBy("p", "q").count().collect()
    blocks = 1 + max(r.q for r in tiles)
    assert len(tiles) == blocks * (blocks + 1) // 2 > 30 and max(r["count"] for r in tiles) < members.count() / 3
    assert got(jaccard.similar_components(df)) == plain(rows)


def test_pairs_of_large_sets_are_told_apart_before_their_sets_travel(spark):
    """Before, 256 cells let every pair of sets with more than about 450 shingles pass, and all sets went to both sides."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    rows = []
    for g, n in enumerate([300, 900, 1700]):
        shared = words(f"s{g}x", n // 2)
        rows += [(len(rows) + k, " ".join(shared + words(f"u{g}x{k}x", n // 2))) for k in range(6)]  # similar by a third
        base = words(f"b{g}x", n)
        rows += [(len(rows) + k, " ".join(base[: n - 20 * k] + words(f"c{g}x{k}x", 20 * k))) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = jaccard.first_pass(df, "doc_id", "text").where("n is not null")
    classes = seen.select("id", "class", "n", "p0", "p1", "p2", "p3", "sketch")
    ids = {r["class"]: r.id for r in classes.collect()}
    group = {d: d // 9 for d in ids.values()}
    every = [(a, b) for a in ids for b in ids if a < b and group[ids[a]] == group[ids[b]]]
    pairs = spark.createDataFrame(every, "a long, b long")
    near = jaccard.plausible(pairs, classes)
    left = {tuple(sorted((ids[r.a], ids[r.b]))) for r in jaccard.sketched(near, classes).collect()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in rows for w in [t.split()]}
    linked = {(a, b) for a in sets for b in sets if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    assert linked and linked <= left and not any(a % 9 < 6 for a, _ in left) and near.count() > 2 * len(left)
    wanted = {r["class"]: r.use for r in jaccard.uses(pairs.where("false").union(spark.createDataFrame([(1, 2), (2, 3)], pairs.schema)), spark.createDataFrame([(9, 3, 5)], "list long, class long, n long")).collect()}
    assert wanted == {1: jaccard.LEFT, 2: jaccard.LEFT | jaccard.RIGHT, 3: jaccard.RIGHT | jaccard.LISTED}
    assert got(jaccard.similar_components(df)) == plain(rows)
