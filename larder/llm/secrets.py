"""Secret scans: stated patterns, and character Markov models that tell random strings from ordinary identifiers.

Two first-order character models are trained from labelled samples: one on random strings (the values that the patterns
find in a bounded sample of documents, with strings drawn from the alphabets that keys use), one on the ordinary words
of the same documents.  The parts of a run of key characters that no pattern covers are secrets if the mean
log-likelihood ratio of their characters says so; else their stretches are where the sum of the ratio above the threshold
is largest, widened to the next of ``/ = _ -`` if they stay above it, of at least ``LEAST`` characters.  Pattern findings are never taken back.

Spans are in code points, ends exclusive.  NULL and empty texts have none; repeated rows give repeated rows; an empty
table trains on drawn strings and the alphabet alone and gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from larder.llm.common import bounded_sample, corpus, per_document

KINDS = ("assign", "access", "hex", "markov")
# Fixed patterns of the contract; a match shorter than stated is dropped.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more; runs are taken whole, so a shorter one never hides a longer
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LEAST = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
SAMPLE_DOCUMENTS = 2000
DRAWN_STRINGS = 4000
# Mean log-likelihood ratio per character (natural logarithm) from which a run counts as random.
THRESHOLD = 1.0
DIVIDERS = "/=_-"

SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


@dataclass
class CharacterModel:
    """Log probabilities of a character after another (index 0: the start), add-one smoothed."""

    logs: np.ndarray

    @classmethod
    def fit(cls, strings: list[str]) -> CharacterModel:
        counts = np.full((129, 128), 0.05)
        for s in strings:
            codes = np.frombuffer(s.encode("ascii"), np.uint8).astype(np.int64)
            np.add.at(counts, (np.concatenate([[0], codes[:-1] + 1]), codes), 1)
        return cls(np.log(counts / counts.sum(1, keepdims=True)))

    def scores(self, string: str) -> np.ndarray:
        codes = np.frombuffer(string.encode("ascii"), np.uint8).astype(np.int64)
        return self.logs[np.concatenate([[0], codes[:-1] + 1]), codes]


def best_stretches(sums: np.ndarray) -> list[tuple[int, int]]:
    """The stretch of the highest total, then the same to its left and right while totals are above 0; in one pass.

    ``sums`` holds the totals of all prefixes.  Open stretches are kept with the totals before and after them; each knows
    the nearest earlier one that begins lower, so that none is looked at again once it is passed over.
    """
    total, begins, ends, lower = sums.tolist(), [], [], []
    for i in np.flatnonzero(sums[1:] > sums[:-1]).tolist():
        begin, end = i, i + 1
        while True:
            j = len(begins) - 1
            while j >= 0 and total[begins[j]] >= total[begin]:
                j = lower[j]
            if j < 0 or total[ends[j]] >= total[end]:
                break
            begin = begins[j]
            del begins[j:], ends[j:], lower[j:]
        begins.append(begin)
        ends.append(end)
        lower.append(j)
    return list(zip(begins, ends))


@dataclass
class SecretModels:
    random: CharacterModel
    ordinary: CharacterModel
    threshold: float = THRESHOLD

    def random_parts(self, string: str) -> list[tuple[int, int]]:
        """Begin and end of the random stretches of a run of key characters."""
        if len(string) < LEAST:
            return []
        above = self.random.scores(string) - self.ordinary.scores(string) - self.threshold
        if above.mean() >= 0:
            return [(0, len(string))]
        sums = np.concatenate([[0.0], np.cumsum(above)])
        borders = [i for i, c in enumerate(string) if c in DIVIDERS]
        found: list[tuple[int, int]] = []
        for begin, end in best_stretches(sums):
            # A stretch takes in its whole words, unless the rest of them is ordinary.
            low, high = begin, end
            if string[begin] not in DIVIDERS:
                at = bisect_left(borders, begin)
                low = borders[at - 1] + 1 if at else 0
            if string[end - 1] not in DIVIDERS:
                at = bisect_left(borders, end)
                high = borders[at] if at < len(borders) else len(string)
            if sums[high] >= sums[low]:
                begin, end = low, high
            while found and begin < found[-1][1]:
                before = found.pop()
                begin, end = min(begin, before[0]), max(end, before[1])
            found.append((begin, end))
        return [(begin, end) for begin, end in found if end - begin >= LEAST]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans by start, then kind."""
        found = base_spans(text)
        covered = [(a, b) for _, a, b in found]
        for m in RUN.finditer(text):
            at, end = m.span()
            for x, y in [*sorted((x, y) for x, y in covered if x < end and at < y), (end, end)]:
                found += [("markov", at + a, at + b) for a, b in self.random_parts(text[at : max(at, x)])]
                at = max(at, y)
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def drawn_strings(n: int, seed: int = 7) -> list[str]:
    """Labelled samples of the random class: strings over the alphabets of common key formats."""
    rng = np.random.default_rng(seed)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = [letters + letters.lower() + "0123456789" + more for more in ("", "+/", "_-")] + [letters + "0123456789"]
    return ["".join(rng.choice(list(alphabets[i % len(alphabets)]), rng.integers(20, 48))) for i in range(n)]


def train(df: DataFrame, documents: int = SAMPLE_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> SecretModels:
    """Fit both models on a bounded sample of ``documents`` texts."""
    random, ordinary = drawn_strings(DRAWN_STRINGS), []
    for row in bounded_sample(df, documents, text_col, id_col=id_col):
        text = row[text_col] or ""
        spans = base_spans(text)
        for kind, a, b in spans:
            value = ASSIGN.match(text, a)[2] if kind == "assign" else text[a:b]
            random.append(value)
        for m in WORD.finditer(text):
            if not any(x < m.end() and m.start() < y for _, x, y in spans):
                ordinary.append(m[0])
    return SecretModels(CharacterModel.fit(random), CharacterModel.fit(ordinary))


def find_secrets(df: DataFrame, models: SecretModels, id_col: str = "doc_id", text_col: str = "text", redact: str | None = None, keep=()) -> DataFrame:
    """Id and ``spans`` (kind, start, end) of every document; with ``redact`` also its ``cleaned`` text."""

    def work(texts):
        spans = [models.spans(t) for t in texts]
        out = {"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]}
        if redact is not None:
            out["cleaned"] = [_without(t, s, redact) for t, s in zip(texts, spans)]
        return out

    fields = [StructField("spans", SPANS)] + [StructField("cleaned", StringType())] * (redact is not None)
    return per_document(df, lambda: work, fields, id_col, text_col, keep)


def _without(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op7_secrets(spark, folder: str) -> DataFrame:
    docs = corpus(spark, folder)
    found = find_secrets(docs, train(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "markov")).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
