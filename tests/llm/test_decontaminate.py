"""Template windows against brute force and against re-parameterised questions."""

import random

import pytest

from larder.llm import decontaminate as dc
from larder.llm.common import corpus

ITEM = "If Anna buys 3 apples and 7 pears for 12 dollars in total, how much does Anna pay for 3 apples alone?"


def found(spark, texts, items, **more):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: (r["items"], r.coverage) for r in dc.decontaminate(docs, bench, **more).collect()}


def test_other_numbers_names_and_units(spark):
    texts = [
        "Intro words. " + ITEM + " More.",
        "x " + ITEM.replace("Anna", "Boris").replace("3", "5").replace("12 dollars", "40 euros") + " y",
        "x " + ITEM.replace("for 3 apples alone", "for 9 apples alone").replace("Anna pay", "Carl pay") + " y",
        "Nothing of the kind is said in this text about fruit and their price at all.",
        "",
        None,
    ]
    got = found(spark, texts, [ITEM, "", None])
    assert got[0] == ([0], 1.0) and got[1] == ([0], 1.0)
    assert got[2][1] < 1.0  # the second 3 and the second Anna changed alone: slots disagree
    assert got[3] == ([], 0.0) and got[4] == ([], 0.0) and got[5] == ([], 0.0)


def test_short_items_blocks_and_clashes(spark):
    items = ["the quick brown fox", "a lazy dog slept there", "unrelated words stand over here now"]
    texts = ["see the quick brown fox and a lazy dog slept there", "the quick red fox"]
    for size in (1, 2, 100):
        got = found(spark, texts, items, items_per_block=size)
        assert got[0] == ([0, 1], 1.0) and got[1] == ([], 0.0)
    docs = spark.createDataFrame([(1, texts[0], "a"), (1, texts[0], "b"), (None, texts[0], "c")], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(7, items[0]), (7, items[0])], "item_id long, text string")
    assert [r["items"] for r in dc.decontaminate(docs, bench).collect()] == [[7]] * 3
    assert dc.decontaminate(docs.limit(0), bench).count() == 0
    assert [r["items"] for r in dc.decontaminate(docs, bench.limit(0)).collect()] == [[]] * 3


def brute(text, item):
    """Covered share of an item: every pair of positions compared word by word."""
    t, i = (dc.Template(x, dc.TemplateHashes()) for x in (text, item))
    width, best = min(dc.WINDOW, len(i.hashes)), 0
    cover = set()
    for shift in range(-len(i.hashes), len(t.hashes)):
        agree = [k for k in range(len(i.hashes)) if 0 <= k + shift < len(t.hashes) and i.hashes[k] == t.hashes[k + shift]]
        windows = [k for k in range(len(i.hashes) - width + 1) if all(j in set(agree) for j in range(k, k + width)) and sum(not i.slot[j] for j in range(k, k + width)) >= min(dc.LITERALS, width)]
        words = sorted({j for k in windows for j in range(k, k + width)})
        if words:
            cover |= dc.BenchmarkBlock._consistent(i, t, shift, words)
    return len(cover) / len(i.hashes) if len(i.hashes) else best


def test_against_brute_force():
    rng = random.Random(4)
    vocabulary = ["red", "blue", "Anna", "Bob", "3", "9", "km", "goes", "far", "from", "home", "and", "then"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(3, 25)))) for i in range(30)]
    block, hashes = dc.BenchmarkBlock(items), dc.TemplateHashes()
    for _ in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=20)), rng.choice(items)[1], " ".join(rng.choices(vocabulary, k=9))]
        text = " ".join(parts)
        got = block.found(dc.Template(text, hashes))
        want = {i: brute(text, t) for i, t in items}
        assert got == pytest.approx({i: c for i, c in want.items() if c})
        assert block.suspects([text], hashes) == [0] * any(want.values())


def test_whole_passages_are_caught(spark):
    folder = "/root/testdata/sf0.01"
    items = {r.item_id: r.text for r in corpus(spark, folder, "benchmark").collect()}
    docs = {r.doc_id: r.text or "" for r in corpus(spark, folder).collect()}
    got = {r.doc_id: set(r["items"]) for r in dc.op10_decontaminate(spark, folder).collect()}
    assert len(got) == len(docs)
    for d, text in docs.items():
        assert {i for i, t in items.items() if t in text} <= got[d]


def test_copies_in_any_case_and_of_slots_alone(spark):
    items = [ITEM, "12 14 16 18 20 22 24 26 28 30", "Anna Boris Carl Dora Emil Frida Gustav Hanna Ivar", "Anna 3"]
    texts = [f"some words {case(t)} and more" for t in items[:3] for case in (str, str.lower, str.upper, str.title)]
    got = found(spark, [*texts, "Boris 5 times", "anna, 3"], items)
    assert [0 in got[i][0] and got[i][1] == 1.0 for i in range(4)] == [True] * 4
    assert [got[i][0] for i in range(4, 12)] == [[1]] * 4 + [[2]] * 4
    assert got[12] == ([], 0.0) and got[13] == ([3], 1.0)
    folder = "/root/testdata/sf0.1"
    texts = {r.item_id: r.text for r in corpus(spark, folder, "benchmark").collect()}
    block, hashes = dc.BenchmarkBlock(list(texts.items()), dc.PlainHashes), dc.PlainHashes()
    for i, t in texts.items():
        for case in (str, str.lower, str.upper, str.title):
            assert block.found(dc.Template(f"x {case(t)} y", hashes))[i] == 1.0


def test_one_id_with_several_texts_and_texts_without_id(spark):
    rows = [(0, "the quick brown fox"), (0, "a lazy dog slept there"), (None, "unrelated words stand over here now"), (None, "no id here either")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(t for _, t in rows), (4, " and ".join(t for _, t in rows))], "doc_id long, text string")
    for size in (1, 100):
        got = {r.doc_id: r["items"] for r in dc.decontaminate(docs, bench, items_per_block=size).collect()}
        assert got == {0: [0], 1: [0], 2: [None], 3: [None], 4: [0, None]}


def test_words_split_once_are_the_words_of_the_texts():
    rng = random.Random(9)
    texts = ["", " ", "a", "\x0b a\x0c b\t\r\n", " x y \x85 z \x1c q", "ß" * 3 + "\0 \0"]
    texts += ["".join(rng.choices("aZ9ß.,-$ \t\n\x0b\x0c\r\x1c\x85  _", k=rng.randint(0, 300))) for _ in range(400)]
    cases = ["kg", "KG.", "Kg", "anna", "Anna", "ANNA", "aNna", "Anna's", "A", "a", "Miles!", "5kg", "5", "(Anna)", "é", "Éa", "%", "a%", "--", "K", "ſ"]
    texts += [" ".join(w + rng.choice(["", ".", "?)", "'", "%"]) for w in rng.choices(cases, k=40)) for _ in range(100)]
    for limit in (1_000_000, 3):
        both = dc.BothHashes(limit)
        for part in (texts[:250], texts[250:], [], [""]):
            words = dc.Words(part, both)
            for kind in (dc.TemplateHashes, dc.PlainHashes):
                got, at = words.hashed(kind)
                hashes = kind()
                assert [got[at == i].tolist() for i in range(len(part))] == [dc.Template(t, hashes).hashes.tolist() for t in part]
