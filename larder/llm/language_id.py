"""Language identification with a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads the bytes of a piece of text in both directions, labels every position with a probability for each
language and the document's probability is the mean over all its positions.  Pieces are words (longer runs without white
space are cut every ``PIECE`` bytes), so a task runs the network once for each different piece it meets and whole texts
of any length cost a look-up per word after that.

Training is backpropagation through time on a bounded sample of labelled documents: up to ``DOCUMENTS`` for each of the
``LANGUAGES`` most frequent languages, those with the smallest hash of their id.

A NULL text or one without a letter is ``und`` with score 0, and so is everything if there is no labelled row to learn
from (an empty table, or all languages NULL).  Equal texts get equal results; ties go to the first language by name.
"""

from __future__ import annotations

import re
import uuid
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StringType, StructField

from larder.llm.common import corpus, held_out, in_training, lower_ascii, per_document

PIECE = 24
HIDDEN = 8
LANGUAGES = 64
DOCUMENTS = 500
STEPS = 500
BATCH = 256
KEPT_PIECES = 800_000
BLOCK = 1024
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class GatedNetwork:
    """Two gated recurrent layers (one per direction) over bytes and a softmax over their joined states."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        # Of each direction: input table (bytes x reset, update, candidate), recurrent weights and bias.
        self.params = {}
        for d in ("f", "b"):
            self.params[f"x{d}"] = normal(256, 3 * hidden, scale=0.3)
            self.params[f"u{d}"] = normal(hidden, 3 * hidden, scale=hidden**-0.5)
            self.params[f"c{d}"] = np.zeros(3 * hidden, np.float32)
        self.params["o"] = normal(2 * hidden, classes, scale=(2 * hidden) ** -0.5)
        self.params["ob"] = np.zeros(classes, np.float32)

    def _scan(self, pieces: np.ndarray, d: str, keep: bool):
        """States after each byte, in reading order; with ``keep`` also what the way back needs."""
        h_size, p = self.hidden, self.params
        inputs = p[f"x{d}"][pieces] + p[f"c{d}"]
        h = np.zeros((len(pieces), h_size), np.float32)
        states, saved = np.empty((pieces.shape[1], len(pieces), h_size), np.float32), []
        for t in range(pieces.shape[1]):
            x, rec = inputs[:, t], h @ p[f"u{d}"]
            gates = _sigmoid(x[:, : 2 * h_size] + rec[:, : 2 * h_size])
            reset, update = gates[:, :h_size], gates[:, h_size:]
            cand = np.tanh(x[:, 2 * h_size :] + reset * rec[:, 2 * h_size :])
            if keep:
                saved.append((h, reset, update, cand, rec[:, 2 * h_size :]))
            h = cand + update * (h - cand)
            states[t] = h
        return states, saved

    def forward(self, pieces: np.ndarray, keep: bool = False):
        """Probabilities (position, piece, class) for equally long pieces of bytes."""
        ahead, saved_f = self._scan(pieces, "f", keep)
        back, saved_b = self._scan(pieces[:, ::-1], "b", keep)
        joined = np.concatenate([ahead, back[::-1]], axis=2)
        logits = joined @ self.params["o"] + self.params["ob"]
        logits -= logits.max(axis=2, keepdims=True)
        probs = np.exp(logits)
        probs /= probs.sum(axis=2, keepdims=True)
        return (probs, joined, saved_f, saved_b) if keep else probs

    def _back(self, pieces: np.ndarray, d: str, saved, grads: np.ndarray, out: dict) -> None:
        h_size, p = self.hidden, self.params
        dx = np.empty((len(pieces), pieces.shape[1], 3 * h_size), np.float32)
        carry, du = np.zeros((len(pieces), h_size), np.float32), np.zeros_like(p[f"u{d}"])
        for t in range(pieces.shape[1] - 1, -1, -1):
            h, reset, update, cand, rec = saved[t]
            dh = grads[t] + carry
            dcand = dh * (1 - update) * (1 - cand**2)
            dreset = dcand * rec * reset * (1 - reset)
            dupdate = dh * (h - cand) * update * (1 - update)
            drec = np.concatenate([dreset, dupdate, dcand * reset], axis=1)
            dx[:, t] = np.concatenate([dreset, dupdate, dcand], axis=1)
            du += h.T @ drec
            carry = dh * update + drec @ p[f"u{d}"].T
        table = np.zeros_like(p[f"x{d}"])
        np.add.at(table, pieces, dx)
        out[f"x{d}"], out[f"u{d}"], out[f"c{d}"] = table, du, dx.sum((0, 1))

    def gradients(self, pieces: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions and its gradients."""
        probs, joined, saved_f, saved_b = self.forward(pieces, keep=True)
        steps, n, _ = probs.shape
        loss = -float(np.log(probs[:, np.arange(n), labels] + 1e-9).mean())
        dlogits = probs
        dlogits[:, np.arange(n), labels] -= 1
        dlogits /= steps * n
        out = {"o": np.einsum("tnh,tnc->hc", joined, dlogits), "ob": dlogits.sum((0, 1))}
        dstates = dlogits @ self.params["o"].T
        self._back(pieces, "f", saved_f, dstates[:, :, : self.hidden], out)
        self._back(pieces[:, ::-1], "b", saved_b, dstates[::-1, :, self.hidden :], out)
        return loss, out

    def fit(self, pieces: list[bytes], labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.01, seed: int = 1) -> None:
        """Adam over batches of equally long pieces, the length drawn by how many bytes it has in all."""
        rng = np.random.default_rng(seed)
        lengths = np.array([len(p) for p in pieces])
        by_length = {n: np.flatnonzero(lengths == n) for n in np.unique(lengths)}
        sizes = np.array(list(by_length))
        weight = np.array([len(by_length[n]) for n in sizes], float)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        for step in range(1, steps + 1):
            n = int(rng.choice(sizes, p=weight / weight.sum()))
            pick = rng.choice(by_length[n], min(batch, len(by_length[n])))
            text = np.frombuffer(b"".join(pieces[i] for i in pick), np.uint8).reshape(len(pick), n)
            _, grads = self.gradients(text, labels[pick])
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                self.params[k] -= (now * m / (np.sqrt(v) + 1e-7)).astype(np.float32)


def pieces_of(text: str) -> list[bytes]:
    """The words and marks as bytes in lower case, longer ones cut; together they hold every byte but white space."""
    words = lower_ascii(text).replace(b".", b" .").replace(b",", b" ,").split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]


class LanguageModel:
    def __init__(self, languages: list[str], network: GatedNetwork | None):
        self.languages, self.network = languages, network

    def label_positions(self, piece: bytes) -> list[str]:
        """The likeliest language at every byte of a piece."""
        probs = self.network.forward(np.frombuffer(piece, np.uint8)[None])[:, 0]
        return [self.languages[i] for i in probs.argmax(1)]

    def piece_sums(self, pieces: list[bytes]) -> np.ndarray:
        """Probabilities of each piece summed over its positions."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = np.zeros((len(pieces), len(self.languages)), np.float32)
        for n in np.unique(lengths):
            where = np.flatnonzero(lengths == n)
            for lo in range(0, len(where), BLOCK):
                at = where[lo : lo + BLOCK]
                text = np.frombuffer(b"".join([pieces[i] for i in at]), np.uint8).reshape(len(at), n)
                out[at] = self.network.forward(text).sum(0)
        return out

    def worker(self):
        """A function from texts to document probabilities (None: no letter) that remembers the pieces it has met."""
        known: dict[bytes, int] = {}
        sums = np.zeros((1024, len(self.languages)), np.float32)

        def probabilities(texts: list[str]) -> list[np.ndarray | None]:
            nonlocal sums
            cut = [pieces_of(t) if _LETTER.search(t) else [] for t in texts]
            if self.network is None:
                return [None] * len(texts)
            if len(known) > KEPT_PIECES:
                known.clear()
            new = [p for p in set(chain.from_iterable(cut)) if p not in known]
            if new:
                base = len(known)
                if base + len(new) > len(sums):
                    sums = np.concatenate([sums[:base], np.zeros((base + 2 * len(new), sums.shape[1]), np.float32)])
                sums[base : base + len(new)] = self.piece_sums(new)
                known.update(zip(new, range(base, base + len(new))))
            out: list[np.ndarray | None] = []
            for pieces in cut:
                at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
                total = sums[at].sum(0, dtype=np.float64) if len(pieces) else None
                out.append(None if total is None else total / total.sum())
            return out

        return probabilities


def training_rows(df: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
                  languages: int = LANGUAGES, documents: int = DOCUMENTS) -> list:
    """Up to so many labelled documents of each of the most frequent languages."""
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    top = [r[0] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(languages).collect()]
    order = Window.partitionBy("l").orderBy(F.xxhash64(F.col("i").cast("string")), "i")
    ids = rows.where(F.col(lang_col).isin(top) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"))
    picked = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents).select("i").distinct()
    # At most languages x documents ids.
    return rows.join(F.broadcast(picked), F.col(id_col) == F.col("i"), "left_semi").select(lang_col, text_col).limit(languages * documents).collect()


def train(rows: list, seed: int = 0, words_each: int = 200) -> LanguageModel:
    """Fit on (language, text) rows; from each text up to so many of its pieces, drawn from its whole length."""
    languages = sorted({r[0] for r in rows if _LETTER.search(r[1])})
    if not languages:
        return LanguageModel([UNKNOWN], None)
    rng, pieces, labels = np.random.default_rng(seed), [], []
    for lang, text in sorted((r[0], r[1]) for r in rows):
        if _LETTER.search(text):
            cut = pieces_of(text)
            drawn = [cut[i] for i in rng.permutation(len(cut))[:words_each]]
            pieces += drawn
            labels += [languages.index(lang)] * len(drawn)
    network = GatedNetwork(len(languages), seed=seed)
    network.fit(pieces, np.array(labels))
    return LanguageModel(languages, network)


# The look-up of the model in use, kept between the tasks of a Python worker.
_WORKERS: dict = {}


def worker_of(name: str, model: LanguageModel):
    if name not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[name] = model.worker()
    return _WORKERS[name]


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """Id, ``lang_pred``, ``score`` and the ``probabilities`` of all languages of every document."""

    name = uuid.uuid4().hex

    def make():
        probabilities = worker_of(name, model)

        def work(texts):
            probs = probabilities(texts)
            best = [None if p is None else int(p.argmax()) for p in probs]
            return {
                "lang_pred": [UNKNOWN if b is None else model.languages[b] for b in best],
                "score": [0.0 if b is None else min(1.0, float(p[b])) for p, b in zip(probs, best)],
                "probabilities": [[] if p is None else p.tolist() for p in probs],
            }

        return work

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("probabilities", ArrayType(FloatType()))]
    return per_document(df, make, fields, id_col, text_col, keep)


def op4_language_id(spark, folder: str) -> DataFrame:
    docs = corpus(spark, folder)
    model = train(training_rows(docs.where(in_training("doc_id", 4, 2))))
    return identify(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
