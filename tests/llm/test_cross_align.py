"""Alignment of two tokenizers against the libraries' own ids and a comparison of all token pairs."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import cross_align as X
from larder.llm.bpe import byte_letters
from larder.llm.common import corpus
from larder.llm.token_store import BYTE_BPE

A, B = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(X.PIECE_BPE)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, text):
    """Tokens of both sides as (id, bytes); nothing where the bytes differ."""
    a, b = libraries
    if not text:
        return [], []
    back = {c: x for x, c in byte_letters().items()}
    left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    raw = (" " + text).encode()
    if b"".join(t for _, t in left) != raw or b"".join(t for _, t in right) != raw:
        return [], []
    return left, right


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(libraries, texts):
    docs = []
    for t in texts:
        left, right = map(spans, plain(libraries, t))
        links, start = [], 0
        for i, lo, hi in left:
            while start < len(right) and right[start][2] <= lo:
                start += 1
            k = start
            while k < len(right) and right[k][1] < hi:
                links.append((i, right[k][0]))
                k += 1
        both = {hi for _, _, hi in left} & {hi for _, _, hi in right}
        groups, g = [], 0
        ids = lambda side, lo, hi: ",".join(str(i) for i, a, b in side if a >= lo and b <= hi)
        low = 0
        for e in sorted(both):
            groups.append((low, e))
            low = e
        text = ""
        if len(left) < 3000:
            text = ";".join(f"{ids(left, lo, hi)}|{ids(right, lo, hi)}" for lo, hi in groups)
        docs.append((len(left), len(right), len(groups), links, text))
    count = collections.Counter(p for d in docs for p in set(d[3]))
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    return [
        (na, nb, ng, len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "")
        for na, nb, ng, links, text in docs
    ]


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:6] == w[:6]
        assert g[6] == w[6] or (w[6] == "" and w[0] >= 3000)


def test_whole_table(spark, libraries):
    rows = corpus(spark, SMALL).select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in X.op11_alignment(spark, SMALL).collect()}
    same([got[r.doc_id] for r in rows], brute(libraries, [r.text for r in rows]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab 1.\n\t \u2581é漢🙂\u0301<|>\x00\u200b", "<|endoftext|>", "<s>", "the ", "  "]), max_size=30).map("".join))
def test_units_give_the_libraries_ids(libraries, text):
    known = X.vocabularies(A, B)
    left, right = plain(libraries, text)
    a, b = known.both(text)
    assert np.frombuffer(a, known.a.dtype).tolist() == [i for i, _ in left]
    assert np.frombuffer(b, known.b.dtype).tolist() == [i for i, _ in right]


@pytest.mark.parametrize("work", [1, 2, 3, 7, 50, 10_000])
def test_pieces_of_any_size_give_the_same(work):
    rnd = np.random.default_rng(5)
    for _ in range(30):
        last = int(rnd.integers(1, 120))
        a, b = (np.unique(np.append(rnd.integers(1, last + 1, rnd.integers(0, last)), last)) for _ in range(2))
        i, j = X.diagonals(a, b, work)
        assert np.all(np.diff(i + j)[:-1] == work) and i[-1] == len(a) and j[-1] == len(b)
        in_a, in_b, to_a, to_b = X.overlaps(a, b, work)
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if max(a[x - 1] if x else 0, b[y - 1] if y else 0) < min(a[x], b[y])}
        assert sorted(zip(in_a.tolist(), in_b.tolist())) == sorted(want)
        both = np.intersect1d(a, b)
        assert a[to_a - 1].tolist() == both.tolist() == b[to_b - 1].tolist()


def test_edges_slices_and_clashing_names(spark, libraries):
    texts = [None, "", " ", "a", "a", "▁", "x▁y", "  two  spaces  ", "line\nbreak\t", "<|endoftext|> <s>", "日本語 text", "a" * 5000, "naïve café " * 400]
    rnd = random.Random(2)
    texts += [" ".join(rnd.choice(["the", "of", "ndwhst", "ertion.", "a,b"]) for _ in range(30)) for _ in range(20)]
    data = [(None if k == 3 else k // 2, t, k, "x", k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, row int, a string, pairs int").repartition(3)
    want = sorted(zip([d[0] for d in data], brute(libraries, texts)), key=str)
    for in_slice in (X.SLICE, 40):
        got = sorted(((r.doc_id, tuple(r[c] for c in COLS)) for r in X.align(df, A, B, in_slice=in_slice).collect()), key=str)
        assert got == want


def test_spelled_groups_and_small_stores(spark, libraries):
    df = spark.createDataFrame([(1, "some words, more words"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in X.align(df, A, B, spell=True).collect()}
    assert got[2].groups == "" and got[2].n_links == 0
    assert hashlib.sha256(got[1].groups.encode()).hexdigest() == got[1].groups_sha256
    ids = [i for i, _ in plain(libraries, "some words, more words")[0]]
    assert [int(i) for g in got[1].groups.split(";") for i in g.split("|")[0].split(",")] == ids
    coded = X.encode_both(df, A, B)
    one = lambda held: sorted((p, n) for r in X.pair_counts(coded, A, B, held).collect() for p, n in zip(np.frombuffer(r.pairs, "<i8").tolist(), np.frombuffer(r.counts, "<i8").tolist()))
    assert one(0) == one(X.HELD)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert X.align(df, A, B).collect() == []
