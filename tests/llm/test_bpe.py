"""Forced-boundary BPE against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import bpe

PATH = public_tokenizers.path(bpe.WORD_BPE)
LIBRARY = Tokenizer.from_file(PATH)
CASES = [
    "", " \n\t", "It's we'll O'RE 12345 don't.", "Ünï ΣΑΣ İstanbul éa ﬁ ß", "a\x1cb\x85c\xa0d\u2003e", "日本語 テスト 🤖🏽",
    "x<|endoftext|>y <|startoftext|>", "<|EndOfText|> <|endoftext", "a" * 5000, "zqxj vvkq ½ ²①", "e\u0301 \u0301x",
]


def same(text):
    code, want = bpe.codec(PATH), LIBRARY.encode(text, add_special_tokens=False).ids
    packed = code.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == want
    assert code.decode(packed) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


def test_cuts_are_certain():
    code = bpe.codec(PATH)
    cut = code.fragments("zqxjvvkq")
    assert len(cut) > 1 and "".join(cut) == "zqxjvvkq"
    for left, right in zip(cut, cut[1:]):
        assert not any(left[-1] + right[0] in token for token in code.vocab)


def test_whole_table(spark):
    got = {r.doc_id: r for r in bpe.op1_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_repeats_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, None, None), (2, "", "z")], "doc_id long, text string, ids string")
    out = bpe.encode(df, PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r.ids)) for r in out) == [(False, 1, 8), (False, 1, 8), (False, 2, 0), (True, 0, 0)]
    back = {r.doc_id: r.decoded for r in bpe.decode(bpe.encode(df, PATH), PATH).collect()}
    assert back[1] == LIBRARY.decode(LIBRARY.encode("a b").ids, skip_special_tokens=False) and back[2] == ""
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_what_a_worker_keeps_is_packed_and_bounded():
    """A worker keeps these stores for all later stages of a pipeline."""
    from larder.llm import bpe

    code = bpe.ForcedBoundaryCodec(bpe.public_tokenizers.path(bpe.WORD_BPE))
    code.encode("the house, and the dog")
    assert code.kept <= 1 << 17 and all(isinstance(ids, bytes) for ids in code.pieces.values())


def test_texts_together_get_the_ids_of_each_alone(monkeypatch):
    path = public_tokenizers.path(bpe.WORD_BPE)
    texts = [
        "", " \t ", "The house, the HOUSE. don't 'stuff '' ''s x's's 'll'd 5's", "a\x0bb\x1cc d\u0085e\x00 ²¼ª", "Ⱥ Ⱦȿ İstanbul ÉÑ straße 漢字 ́e",
        "a" * 31 + " " + "a" * 33 + " " + "!" * 200 + " " + "éa" * 40, "<|endoftext|>x <|startoftext|> <|no|>", "12,345.67###$$$% -- word-word... word", "aaaaaaa abababab",
    ]
    alone, together = bpe.ForcedBoundaryCodec(path), bpe.ForcedBoundaryCodec(path, kept=12)
    assert together.encode_all(texts) == [alone.encode(t) for t in texts]
    assert [together.encode_all([t]) for t in texts] == [[alone.encode(t)] for t in texts]
    assert len(together.together) <= 40 and together.encode_all([]) == []
    monkeypatch.setattr(together, "_word", None)  # words of Latin letters are not merged one at a time
    assert together.encode_all(["Some neverseenwords, thatéare new2."]) == [alone.encode("Some neverseenwords, thatéare new2.")]


def test_every_piece_merges_as_the_library_does():
    rng = np.random.default_rng(5)
    code = bpe.ForcedBoundaryCodec(public_tokenizers.path(bpe.WORD_BPE))
    words = ["".join(rng.choice(list("aeinorst"), n)) for n in rng.integers(1, 40, 3000)]
    got = code.encode_all(words)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[t.id for t in code.final.tokenize(w)] for w in words]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abstrvemld'’.,!# 15\n\t\x1cÉéßȺİǅ²ª­́漢") | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=4))
def test_any_texts_together(texts):
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in bpe.codec(PATH).encode_all(texts)] == want


def test_cases_together():
    assert bpe.codec(PATH).encode_all(CASES) == [bpe.codec(PATH).encode(t) for t in CASES]
