"""Repeated substrings against counting all substrings."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from larder.llm import suffix_dedup
from larder.llm.bwt import Collection
from larder.llm.common import corpus


def test_transform_and_common_prefixes():
    rng = random.Random(1)
    for t in range(120):
        strings = [bytes(rng.choices(b"ab" if t % 2 else b"abc", k=rng.randint(0, 14))) for _ in range(rng.randint(1, 8))]
        made = Collection(strings, in_memory=0 if t % 3 == 0 else 1 << 20)
        order = sorted(s[i:] for s in strings for i in range(len(s)))
        common = [0] + [len(os.path.commonprefix(p)) for p in zip(order, order[1:])]
        assert made.common[sum(map(bool, strings)) :].tolist() == common[: len(order)]
        length = rng.randint(1, 6)
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        assert [x.tolist() for x in made.shared(length)] == [[seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]
        made.close()
        wide = Collection(strings, 2, in_memory=0 if t % 3 == 0 else 1 << 20)
        seen = Counter(s[i : i + 4] for s in strings for i in range(len(s) - 3))
        assert [x.tolist() for x in wide.shared(4)] == [[seen[s[i : i + 4]] > 1 for i in range(len(s) - 3)] for s in strings]
        wide.close()


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        end = 0
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                for j in range(max(i, end), i + length):
                    gone[j] = 1
                end = i + length
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(r)))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def run(spark, texts, length):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    docs, lost = suffix_dedup.repeats(df, length=length)
    rows = {r.key: r for r in lost.collect()}
    out = {}
    for d in docs.collect():
        r = rows.get(d.key)
        out[d.doc_id] = (d.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) if r else (d.n_bytes, 0, 0, d.sha256)
    return [out[i] for i in range(len(texts))]


@pytest.mark.parametrize("large", [3, 1500])
def test_against_plain_counting(spark, monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(30))
    texts = [None, "", "short", "é" * 200, "ab" * 120, passage, passage, passage + " "]
    for _ in range(25):
        words = [word() for _ in range(60)]
        at = rng.randrange(60)
        texts.append(" ".join([*words[:at], rng.choice([passage, passage[11:90], ""]), *words[at:]]))
        copy = list(words)
        copy[rng.randrange(60)] = word()
        texts.append(" ".join(copy))
    assert run(spark, texts, 50) == plain(texts, 50)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = corpus(spark, folder).collect()
    want = dict(zip([r.doc_id for r in rows], plain([r.text for r in rows], 400)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op2_suffix_dedup(spark, folder).collect()}
    assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    docs, lost = suffix_dedup.repeats(empty)
    assert docs.count() == 0 and lost.count() == 0


def test_anchors_do_not_depend_on_stretches(monkeypatch):
    rng = random.Random(5)
    g = suffix_dedup.Grams(25)
    texts = [bytes(rng.choices(b"abcdefgh ", k=rng.randint(24, 1500))) for _ in range(60)]
    whole = [sorted(g.own_anchors(t).tolist()) for t in texts]
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    for text, want in zip(texts, whole):
        assert sorted(g.own_anchors(text).tolist()) == want
    # Strings across every border need each of their least grams counted, as pieces() demands them.
    for border in range(64, 640, 64):
        text = bytes(rng.choices(b"abcdefgh ", k=800))
        counted = set(g.own_anchors(text).tolist())
        for start in range(border - 24, border + 1):
            assert set(g.anchors(g.hashes(np.frombuffer(text, np.uint8, 25, start)))[0].tolist()) <= counted
