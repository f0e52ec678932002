"""Language-model scores against plain counts, differences and a window-by-window calculation."""

import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from larder.llm import lm_score
from larder.llm.attention import STRIDE, AttentionModel
from larder.llm.common import corpus, lower_ascii, word_hashes


def model():
    m = AttentionModel(30, np.arange(30)[::-1].astype(float), head=6, tail=3, size=4, seed=2)
    m.params = {k: v.astype(np.float64) for k, v in m.params.items()}
    return m


def texts():
    rng = np.random.default_rng(0)
    return [rng.integers(0, 30, n) for n in (1, 5, 8, 9, 30, 16)]


def test_gradients_agree_with_differences():
    m = model()
    w = m.windows(texts())[:3]
    _, grads = m.gradients(*w)
    rng = np.random.default_rng(1)
    for name, value in m.params.items():
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in value.shape)
            base = value[at]
            value[at] = base + 1e-5
            up = m.gradients(*w)[0]
            value[at] = base - 1e-5
            down = m.gradients(*w)[0]
            value[at] = base
            assert (up - down) / 2e-5 == pytest.approx(grads[name][at], abs=1e-6)


def one_by_one(m, ids):
    """Each token's probability from its own window, without batches, masks or pads."""
    p, total = m.params, 0.0
    read = [m.start, *m.classes[ids[:-1]].tolist()]
    for i, token in enumerate(ids):
        first = max(0, i // STRIDE * STRIDE - STRIDE)
        x = p["e"][read[first : i + 1]]
        scores = (x @ p["k"]) @ (x[-1] @ p["q"]) / math.sqrt(p["q"].shape[0]) + p["r"][np.arange(len(x))[::-1]]
        weights = np.exp(scores) / np.exp(scores).sum()
        logits = np.concatenate([weights @ (x @ p["v"]), p["u"][read[i]]]) @ p["o"] + p["b"]
        total += logits[m.classes[token]] - np.log(np.exp(logits).sum()) + m.within[token]
    return total / math.log(10)


def test_windows_score_each_token_once():
    m, t = model(), texts()
    got = m.score(t, blocks_at_once=3)
    assert got == pytest.approx([one_by_one(m, x) for x in t], rel=1e-5)


def test_probabilities_sum_to_one():
    m = model()
    assert sum(10 ** one_by_one(m, np.array([i])) for i in range(30)) == pytest.approx(1)


def expect(rows, folds=7, held=2):
    cut = {i: [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")), None] for i, (_, t) in enumerate(rows)}
    out = [d is not None and zlib.crc32(str(d).encode()) % folds == held for d, _ in rows]
    counts = Counter(w for i, ws in cut.items() if not out[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda ws: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
    return {i: (out[i], len(ws), sum(counts[w] > 0 for w in ws), n, base(ws)) for i, ws in cut.items()}


@pytest.mark.parametrize("common", [1 << 20, 50])
def test_whole_table(spark, monkeypatch, common):
    monkeypatch.setattr(lm_score.common_words, "__defaults__", (common,))
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in corpus(spark, folder).collect()]
    want = {rows[i][0]: w for i, w in expect(rows).items()}
    got = lm_score.op8_lm_score(spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_training_lowers_held_out_loss():
    rng = np.random.default_rng(3)
    chain = lambda n: np.cumsum(rng.choice([1, 2], n, p=[0.9, 0.1])) % 30  # each id mostly follows the one before it
    train, apart = [chain(60) for _ in range(40)], [chain(60) for _ in range(20)]
    m = AttentionModel(30, np.bincount(np.concatenate(train), minlength=30).astype(float), head=30, tail=1, size=8)
    before = m.score(apart).sum()
    losses = m.fit(train, steps=200, blocks=128)
    assert losses[-1] < 0.5 * losses[0] and m.score(apart).sum() > 0.5 * before


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b a", 1), (1, "a b a", 2), (None, None, 3), (4, "", 4)], "doc_id long, text string, score int")
    got = lm_score.score(df, df).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 1, 10), (1, 1, 10), (4, 4, 10), (4, 4, 10)]
    untrained = lm_score.score(df, df.limit(0)).collect()
    assert [(r.n_known, r.train_tokens) for r in untrained] == [(0, 0)] * 4
    assert lm_score.score(df.limit(0), df.limit(0)).count() == 0
    assert all(np.isfinite(r.score) for r in got + untrained)


def test_rest_classes_go_by_frequency_and_none_is_empty():
    for counts in (np.arange(30)[::-1], np.zeros(30), np.array([1000] * 6 + [900] + [0] * 23), np.array([5] * 29 + [10**6])):
        m = AttentionModel(30, counts.astype(float), head=6, tail=3, size=4)
        assert sorted(set(m.classes.tolist())) == list(range(9))
        order = np.lexsort((np.arange(30), -counts))
        assert (np.diff(m.classes[order].astype(int)) >= 0).all()


def test_counts_and_weights_come_from_all_training_rows(spark, monkeypatch):
    common = [(i, "the house and the dog went over the hill") for i in range(300)]
    late = [(1000 + i, "zebra quartz zebra quartz") for i in range(300)]
    df = spark.createDataFrame(common + late, "doc_id long, text string")
    path = lm_score.public_tokenizers.path(lm_score.WORD_BPE)
    code = lm_score.codec(path)
    want = np.bincount(np.concatenate(lm_score._coded(code, [t for _, t in common + late])), minlength=len(code.tokens) + 1)
    texts = df.selectExpr("doc_id as id", "text as t")
    assert lm_score.id_counts(texts.select("t"), path).tolist() == want.tolist()
    # The driver starts from one text of one kind; the other kind is learned from the shards.
    worst = lambda training: min(r.score for r in lm_score.score(df.where("doc_id in (0, 1000)"), training, documents=1).collect())
    monkeypatch.setattr(lm_score, "SHARD", 16)
    monkeypatch.setattr(lm_score, "SHARE", 1 << 30)
    few = worst(df)
    monkeypatch.setattr(lm_score, "SHARE", 1)
    all_rows = worst(df)
    assert all_rows > few + 0.5
    assert worst(df.repartition(7, "text")) == pytest.approx(all_rows, rel=1e-6)


def test_every_training_text_is_passed_over_once(spark, monkeypatch):
    class Tally:
        """Its weights: how many texts and how many ids the shard had."""

        state = np.zeros(2)

        def with_state(self, state):
            other = type(self)()
            other.state = state.copy()
            return other

        def fit_once(self, texts):
            self.state += [len(texts), sum(map(len, texts))]
            return len(texts)

    # A class of this test travels inside the function, not by name as a broadcast does.
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: SimpleNamespace(value=value))
    rows = [(i if i % 5 else None, np.arange(1 + i % 9).astype("<u2").tobytes()) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, ids binary").repartition(3)
    assert lm_score.fit_further(Tally(), df, 900, 100).state.tolist() == [900, sum(1 + i % 9 for i in range(900))]
    assert lm_score.fit_further(Tally(), df.limit(0), 900, 100).state.tolist() == [0, 0]


def test_rows_that_train_and_a_table_of_them_score_alike(spark):
    words = "the house and dog went over a hill quartz zebra".split()
    df = spark.createDataFrame([(i, " ".join(words[i % 7 : 3 + i % 8])) for i in range(60)], "doc_id long, text string")
    got = [sorted(map(tuple, lm_score.score(df, t).collect())) for t in (lm_score.F.col("doc_id") % 3 > 0, df.where("doc_id % 3 > 0"))]
    assert [r[:4] for r in got[0]] == [r[:4] for r in got[1]]
    assert np.array([r[4:] for r in got[0]]) == pytest.approx(np.array([r[4:] for r in got[1]]), rel=1e-6)


def test_word_hashes_follow_the_split_words():
    words = ["", " ", "A\x0bb\x1cc\x00 a", "x" * 255 + " " + "X" * 256 + " " + "x" * 257 + " " + "x" * 257 + "y", "é E É 漢字漢字漢字 1234567 12345678 123456789", "\n\n tail ab ba \x00 \x00\x00"]
    keys, sizes = word_hashes(words)
    split = [lower_ascii(t).split() for t in words]
    assert sizes.tolist() == list(map(len, split))
    flat = [w for ws in split for w in ws]
    assert len(set(keys.tolist())) == len(set(flat)) == len(set(zip(keys.tolist(), flat)))
    assert keys.tolist() == [int(word_hashes([w.decode()])[0][0]) for w in flat]
    assert [len(x) for x in word_hashes([])] == [0, 0]


def test_places_of_hashes():
    rng = np.random.default_rng(0)
    many = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    for values in (many[:0], many[:1], many, np.array([0, 1, 2, 3, 2**64 - 1], np.uint64)):
        keys = np.concatenate([values, many, rng.integers(0, 2**64, 5000, dtype=np.uint64)])
        assert (lm_score.sorted_places(values)(keys) == np.searchsorted(values, keys)).all()


def whole_model():
    m = AttentionModel(30, np.arange(30)[::-1].astype(float), head=6, tail=3, size=4, seed=2, whole=True)
    m.params = {k: v.astype(np.float64) for k, v in m.params.items()}
    m.params["r"][:] = np.random.default_rng(4).normal(size=2 * STRIDE)
    m.params["f"][:] = -0.7
    return m


def whole_one_by_one(m, ids):
    """Each token's probability from all tokens before it; before the window they share one distance."""
    p, total = m.params, 0.0
    read = [m.start, *m.classes[ids[:-1]].tolist()]
    for i, token in enumerate(ids):
        near = max(0, i // STRIDE * STRIDE - STRIDE)
        x = p["e"][read[: i + 1]]
        place = np.append(np.full(near, p["f"][0]), p["r"][np.arange(i - near, -1, -1)])
        scores = (x @ p["k"]) @ (x[-1] @ p["q"]) / math.sqrt(p["q"].shape[0]) + place
        weights = np.exp(scores) / np.exp(scores).sum()
        logits = np.concatenate([weights @ (x @ p["v"]), p["u"][read[i]]]) @ p["o"] + p["b"]
        total += logits[m.classes[token]] - np.log(np.exp(logits).sum()) + m.within[token]
    return total / math.log(10)


def test_whole_texts_are_attended_to():
    m, t = whole_model(), [*texts(), np.random.default_rng(9).integers(0, 30, 200)]
    assert m.score(t, blocks_at_once=3) == pytest.approx([whole_one_by_one(m, x) for x in t], rel=1e-5)
    other = t[-1].copy()
    other[:8] = (other[:8] + 11) % 30
    late = lambda x: m.log_probs(*m.windows([x])[:3], m.earlier([x]))[10:]
    assert np.abs(late(t[-1]) - late(other)).max() > 1e-6


def test_gradients_over_whole_texts_agree_with_differences():
    m, t = whole_model(), texts()
    w = (*m.windows(t)[:3], m.earlier(t))
    _, grads = m.gradients(*w)
    rng = np.random.default_rng(1)
    for name, value in m.params.items():
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in value.shape)
            base = value[at]
            value[at] = base + 1e-5
            up = m.gradients(*w)[0]
            value[at] = base - 1e-5
            down = m.gradients(*w)[0]
            value[at] = base
            assert (up - down) / 2e-5 == pytest.approx(grads[name][at], abs=1e-6), name
