"""Toxicity scores from positive and unlabelled texts (non-negative risk).

Only confirmed toxic examples and text without a judgement are compared; which unlabelled texts are clean is not known.
With class prior p, loss l and classifier g the risk is  p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)]) :  the
negative part is what the unlabelled text has beyond its share of positives.  Where a step finds that part below zero
(the classifier has begun to learn single texts by heart), it walks back up instead.

``g`` is linear in the presence of words, trained in numpy on a bounded sample: the confirmed examples and the
unlabelled texts with the smallest hashes of their ids (``POSITIVES``, ``UNLABELLED``); words found in fewer than
``LEAST`` sample texts, or about as often on both sides, are left out.  The prior is the toxic share of all labelled training rows.

A NULL or empty text is scored by the bias alone.  Without a confirmed example every score is 0.  A document labelled
more than once is toxic if any of its labels says so; labels that are NULL say nothing; labels of unknown ids are unused.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from larder.llm.common import corpus, hashed_rows, held_out, in_training, lower_ascii, per_document

POSITIVES = 3000
UNLABELLED = 6000
LEAST = 5
STEPS = 400
DECAY = 1e-3
SCREEN = 4.5

_MARKS = bytes(32 if chr(b) in "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~" else b for b in range(256))


def words(text: str) -> set[bytes]:
    return set(lower_ascii(text).translate(_MARKS).split())


@dataclass
class ToxicityModel:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: str) -> float:
        found = map(self.weights.get, words(text))
        g = self.bias + math.fsum(w for w in found if w is not None)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, g))))


def _csr(texts: list[set[bytes]], columns: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Columns of all texts one after the other, and the text of each entry."""
    cols = [sorted(columns[w] for w in t if w in columns) for t in texts]
    return np.array([c for r in cols for c in r], np.int64), np.repeat(np.arange(len(cols)), [len(r) for r in cols])


def screened(pos: list[set[bytes]], unl: list[set[bytes]], errors: float = SCREEN) -> set[bytes]:
    """Words whose rate differs between the two sides by so many standard errors; the others would be noise."""
    there, rest = Counter(w for t in pos for w in t), Counter(w for t in unl for w in t)
    n, m, out = len(pos), max(1, len(unl)), set()
    for w in there.keys() | rest.keys():
        p = (there[w] + rest[w] + 1) / (n + m + 2)
        if abs(there[w] / n - rest[w] / m) >= errors * math.sqrt(p * (1 - p) * (1 / n + 1 / m)):
            out.add(w)
    return out


def fit(positive: list[str], unlabelled: list[str], prior: float, steps: int = STEPS, rate: float = 0.05,
        decay: float = DECAY, least: int = LEAST) -> ToxicityModel:
    if not positive:
        return ToxicityModel({}, -500.0)
    pos, unl = [words(t) for t in positive], [words(t) for t in unlabelled]
    seen = Counter(w for t in pos + unl for w in t)
    vocabulary = sorted(w for w in screened(pos, unl) if seen[w] >= least)
    columns = {w: i for i, w in enumerate(vocabulary)}
    sides = [(*_csr(t, columns), len(t)) for t in (pos, unl)]
    theta = np.zeros(len(vocabulary) + 1)
    theta[-1] = math.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        soft = []
        for cols, row, n in sides:
            g = theta[-1] + np.bincount(row, theta[cols], n)
            soft.append((g, n))
        # Logistic loss: l(-g) = log(1 + e^g) has the slope s(g); l(g) = log(1 + e^-g) has the slope s(g) - 1.
        (gp, np_), (gu, nu) = soft
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = (np.logaddexp(0, gu).mean() if nu else 0.0) - prior * np.logaddexp(0, gp).mean()
        if negative >= 0:
            slopes = (prior * ((sp - 1) - sp) / np_, su / max(nu, 1))
        else:  # raise the negative part again, leave the positive one
            slopes = (prior * sp / np_, -su / max(nu, 1))
        grad = np.zeros_like(theta)
        for (cols, row, _), slope in zip(sides, slopes):
            grad[:-1] += np.bincount(cols, slope[row], len(vocabulary))
            grad[-1] += slope.sum()
        grad[:-1] += decay * theta[:-1] * prior
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ToxicityModel(dict(zip(vocabulary, theta[:-1].tolist())), float(theta[-1]))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> ToxicityModel:
    """Fit on the given rows (leave out what is held out) and the labels of their ids."""
    known = df.select(F.col(id_col).alias("i")).where("i is not null").distinct()
    judged = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic")
    )
    tagged = known.join(judged, "i", "left")
    share = tagged.agg(F.count("*").alias("all"), F.count("toxic").alias("n"), F.sum("toxic").alias("k")).first()
    if not share["k"]:
        return ToxicityModel({}, -500.0)
    toxic = hashed_rows(tagged.where("toxic = 1"), positives, "i", share["k"])
    rest = hashed_rows(tagged.where("coalesce(toxic, 0) = 0"), unlabelled, "i", share["all"] - share["k"])
    # At most positives + unlabelled ids.
    picked = F.broadcast(toxic.unionAll(rest).select("i", F.coalesce("toxic", F.lit(0)).alias("t")))
    rows = df.join(picked, F.col(id_col) == F.col("i")).select("i", "t", F.coalesce(F.col(text_col), F.lit("")).alias("x"))
    sample = sorted(rows.limit(2 * (positives + unlabelled)).collect())
    prior = min(0.9, max(0.01, share["k"] / share["n"]))
    return fit([r.x for r in sample if r.t == 1], [r.x for r in sample if r.t == 0], prior)


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """Id and toxicity ``score`` between 0 and 1 of every document."""

    def work(texts):
        return {"score": [model.score(t) for t in texts]}

    return per_document(df, lambda: work, [StructField("score", DoubleType())], id_col, text_col, keep)


def op5_toxicity(spark, folder: str) -> DataFrame:
    docs = corpus(spark, folder)
    model = train(docs.where(in_training("doc_id", 5, 0)), corpus(spark, folder, "labels"))
    return score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
