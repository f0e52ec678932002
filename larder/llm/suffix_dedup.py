"""Removal of repeated substrings: every byte covered by a ``LENGTH``-byte string that also starts somewhere else.

1. Filter.  Every string of ``LENGTH`` bytes holds the same smallest gram hashes wherever it stands, so each of those
   must occur twice in the corpus.  The anchors of all texts (positions with the smallest hash of some window of grams)
   are counted; only strings whose windows all have a repeated anchor can repeat, and no other is looked at again.
2. Pieces.  Runs of such strings with the same smallest gram form a piece; equal strings always meet in the same group
   of pieces.  Equal pieces are one piece with a weight, equal texts one text: copies are never compared.
3. Suffixes.  The pieces of each group get their suffix order and common prefixes by column-wise insertion into the
   Burrows-Wheeler transform of the collection (:mod:`larder.llm.bwt`); strings that share ``LENGTH`` bytes with a
   neighbour repeat.  Groups with very many different pieces are cut again by further orders of the grams, which
   depend on the string alone too.
4. Positions go back to their texts, overlapping strings are united and their bytes removed.

Matches never cross documents and are judged on the input.  NULL texts are empty; texts shorter than ``LENGTH`` keep all
bytes; repeated rows remove each other's whole text if it is long enough; an empty table gives an empty one.  Texts,
grams and pieces are known by 64-bit hashes until the suffix order compares their bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.bwt import Collection, word_bytes
from larder.llm.common import corpus, mix, stored
from larder.llm.packed import by_bucket, gathered, how_many, split

LENGTH = 400
# Symbols that a task inserts into one collection, unless a single group has more.
SYMBOLS = 1 << 17
# Starts of a piece; longer runs with one smallest gram are several pieces of the same group.
STARTS = 400
# Different pieces from which a group is cut again, and by how many further orders.
LARGE, ORDERS = 1500, 3
# Texts are hashed in stretches of so many bytes.
STRETCH = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _least(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Least (or by ``pick``) value of every window."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


class Grams:
    """Hashes of all grams of a byte string; a gram is a third of the string length, and so is a window of grams."""

    def __init__(self, length: int):
        self.length = length
        self.gram = max(1, length * 8 // 25)  # 128 of 400
        self.window = max(1, min(self.gram, length - self.gram + 1))
        self.grams_in_string = length - self.gram + 1
        self.windows_in_string = self.grams_in_string - self.window + 1
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.up, self.down = _powers(_BASE, STRETCH + 4 * length), _powers(inverse, STRETCH + 4 * length)

    def hashes(self, text: np.ndarray) -> np.ndarray:
        n = len(text)
        if n < self.gram:
            return np.zeros(0, np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[:n], dtype=np.uint64)])
        return mix((sums[self.gram :] - sums[: -self.gram]) * self.down[: n - self.gram + 1])

    def anchors(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least hash of every window of grams, and which grams are the least of some window."""
        least = _least(hashes, self.window)
        wide = np.concatenate([np.zeros(self.window - 1, np.uint64), least, np.zeros(self.window - 1, np.uint64)])
        return least, hashes == _least(wide, self.window, np.maximum)

    def own_anchors(self, text: bytes) -> np.ndarray:
        """Hashes of all anchors of a text, each position once.

        A stretch is hashed from ``window - 1`` grams before its first start, so that all windows of its grams are seen.
        """
        found, n = [], len(text) - self.length + 1
        for lo in range(0, n, STRETCH):
            begin, end = max(0, lo - self.window + 1), min(lo + STRETCH, n)
            hashes = self.hashes(np.frombuffer(text, np.uint8, end + self.length - 1 - begin, begin))
            own = self.anchors(hashes)[1]
            own[: lo - begin] = False
            if end < n:
                own[end - begin :] = False  # the next stretch counts these
            found.append(hashes[own])
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def stretches(self, text: bytes):
        """Parts of a text, each with all that a string needs that starts in it: offset, bytes, starts."""
        n = len(text) - self.length + 1
        for lo in range(0, n, STRETCH):
            starts = min(STRETCH, n - lo)
            yield lo, np.frombuffer(text, np.uint8, starts + self.length - 1, lo), starts


_GRAMS: dict[int, Grams] = {}


def grams(length: int) -> Grams:
    if length not in _GRAMS:
        _GRAMS[length] = Grams(length)
    return _GRAMS[length]


def repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """For every text (``key``) the packed hashes of its anchors that occur at two or more places of the corpus."""
    buckets = how_many(texts)

    def emit(frames):
        g = grams(length)
        for f in frames:
            found, owner, key = [], [], f["key"].to_numpy(np.int64)
            for k, text in zip(key, f["text"]):
                found.append(g.own_anchors(text.encode("utf-8")))
                owner.append(np.full(len(found[-1]), k))
            if sum(map(len, found)):
                h, k = np.concatenate(found), np.concatenate(owner)
                order = np.lexsort((k, h))
                h, k = h[order], k[order]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])]))
                n = np.diff(np.append(first, len(h)))
                h, k = h[first], k[first]
                yield pd.DataFrame(split(buckets, h, h, k, n.astype("<u4")), columns=["bucket", "h", "k", "n"])

    def meet(frames):
        for _, f in by_bucket(frames):
            h, k, n = (np.frombuffer(b"".join(f[c]), t) for c, t in (("h", "<u8"), ("k", "<i8"), ("n", "<u4")))
            _, at = np.unique(h, return_inverse=True)
            twice = np.bincount(at, n)[at] >= 2
            order = np.lexsort((h[twice], k[twice]))
            h, k = h[twice][order], k[twice][order]
            if len(k):
                keys, first = np.unique(k, return_index=True)
                yield pd.DataFrame({"key": keys, "h": [x.tobytes() for x in np.split(h, first[1:])]})

    packed = texts.mapInPandas(emit, "bucket long, h binary, k binary, n binary")
    rows = gathered(packed).mapInPandas(meet, "key long, h binary")
    return rows.groupBy("key").agg(F.collect_list("h").alias("h"))


def _runs(values: np.ndarray, kept: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of the runs of equal values at kept positions."""
    edge = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (kept[1:] != kept[:-1]), [True]]))
    return [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()) if kept[a]]


def _short(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [(c, min(b, c + STARTS)) for a, b in runs for c in range(a, b, STARTS)]


PIECES = "route long, piece long, key long, start long, n long, weight long, inner boolean, body binary"


def pieces(texts: DataFrame, length: int) -> DataFrame:
    """Runs of strings that may repeat, of the different texts with their anchors: route, body, place and weight."""

    def cut(frames):
        g = grams(length)
        for f in frames:
            out = []
            for key, weight, text, packed in zip(f["key"], f["weight"], f["text"], f["h"]):
                text, known = text.encode("utf-8"), np.unique(np.frombuffer(b"".join(packed), "<u8"))
                for lo, part, starts in g.stretches(text):
                    hashes = g.hashes(part)
                    least = _least(hashes, g.window)
                    at = np.minimum(np.searchsorted(known, least), len(known) - 1)
                    bad = np.concatenate([[0], np.cumsum(known[at] != least)])
                    may = bad[g.windows_in_string :] == bad[: -g.windows_in_string]
                    if may.any():
                        route = _least(hashes, g.grams_in_string)
                        for a, b in _short(_runs(route, may)):
                            inner = int((hashes[a : b + g.grams_in_string - 1] == route[a]).sum()) > 1
                            out.append(_piece(part[a : b + length - 1].tobytes(), int(route[a]), key, lo + a, b - a, weight, inner))
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])

    return texts.mapInPandas(cut, PIECES)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _piece(body: bytes, route: int, key: int, start: int, n: int, weight: int, inner: bool) -> tuple:
    """``inner``: the smallest gram stands twice in the piece, so that it may hold a string twice."""
    return _signed(route), _signed(xxhash.xxh3_64_intdigest(body)), key, start, n, weight, inner, body


def cut_again(found: DataFrame, length: int) -> DataFrame:
    """Pieces cut where the least gram under one of further orders changes."""

    def cut(frames):
        g = grams(length)
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                hashes = g.hashes(np.frombuffer(r.body, np.uint8))
                route = np.full(r.n, np.uint64(r.route % (1 << 64)))
                for k in range(ORDERS):
                    route = mix(route ^ _least(mix(hashes + np.uint64(k + 1) * _BASE), g.grams_in_string))
                out += [
                    _piece(r.body[a : b + length - 1], int(route[a]), r.key, r.start + a, b - a, r.weight, r.inner)
                    for a, b in _runs(route, np.ones(r.n, bool))
                ]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])

    return found.mapInPandas(cut, PIECES)


def repeated_starts(kinds: DataFrame, length: int) -> DataFrame:
    """Runs of repeated starts within each kind of piece, by the suffix order of the pieces of its route."""
    parts = int(kinds.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def order(frames):
        rows, symbols = [], 0
        for f in frames:
            for route, piece, weight, body in zip(f["route"], f["piece"], f["weight"], f["body"]):
                if symbols >= SYMBOLS and rows[-1][0] != route:
                    yield _solve(rows, length)
                    rows, symbols = [], 0
                rows.append((route, piece, weight, body))
                symbols += len(body)
        if rows:
            yield _solve(rows, length)

    near = kinds.select("route", "piece", "weight", "body").repartition(parts, "route").sortWithinPartitions("route")
    return near.mapInPandas(order, "route long, piece long, begin long, n long")


def _solve(rows: list[tuple], length: int) -> pd.DataFrame:
    collection = Collection([r[3] for r in rows], word_bytes(length))
    out = []
    for (route, piece, weight, _), twice in zip(rows, collection.shared(length)):
        if weight > 1:
            twice[:] = True
        out += [(route, piece, a, b - a) for a, b in _runs(twice, twice)]
    collection.close()
    return pd.DataFrame(out, columns=["route", "piece", "begin", "n"])


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """All documents (id, key of the text, ``n_bytes``, digest of the text) and, for the texts that lose bytes, ``key``,
    ``n_removed``, ``spans`` (begin, end) and the ``kept`` bytes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col), F.xxhash64(text).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    long = docs.where(F.col("n_bytes") >= length).select("key", "text")
    anchors = stored(repeated_anchors(long, length), "suffix-anchors")
    once = long.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("weight"))
    # Only texts with a repeated anchor go on; they are kept for the last step too.
    suspects = stored(once.join(anchors.hint("shuffle_hash"), "key").select("key", "text", "weight", "h"), "suffix-texts")
    found = stored(pieces(suspects, length), "suffix-pieces")
    sizes = found.groupBy("route").agg(F.sum("weight").alias("all"), F.approx_count_distinct("piece").alias("kinds"))
    large = sizes.where(F.col("kinds") >= LARGE).select("route")
    if not large.isEmpty():
        again = cut_again(found.join(large, "route", "left_semi"), length)
        found = stored(found.join(large, "route", "left_anti").unionByName(again), "suffix-pieces")
    places = found.select("route", "piece", "key", "start", "n", "weight", "inner")
    kinds = places.groupBy("route", "piece").agg(F.sum("weight").alias("weight"), F.min(F.struct("key", "start")).alias("at"))
    # A route with one kind of piece has nothing to be compared with: its weight tells whether its strings repeat.
    groups = places.groupBy("route").agg(F.min("piece").alias("low"), F.max("piece").alias("high"), F.sum("weight").alias("all"), F.max("inner").alias("inner"))
    lone = groups.where("low = high and all >= 2").select("route")
    twice = groups.where("low <> high or (inner and all = 1)").select("route")
    chosen = kinds.join(twice, "route").select("route", "piece", "weight", F.col("at.key").alias("key"), F.col("at.start").alias("start"))
    bodies = found.select("route", "piece", "key", "start", "body")
    runs = stored(repeated_starts(bodies.join(chosen, ["route", "piece", "key", "start"]), length), "suffix-runs")
    whole = places.join(lone, "route").select("key", F.col("start").alias("begin"), "n")
    inside = places.drop("n").join(runs, ["route", "piece"]).select("key", (F.col("start") + F.col("begin")).alias("begin"), "n")
    spans = whole.unionAll(inside).select("key", F.col("begin").alias("a"), (F.col("begin") + F.col("n") + length - 1).alias("b"))
    marked = spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def remove(frames):
        for f in frames:
            out = []
            for key, text, spans in zip(f["key"], f["text"], f["spans"]):
                text, runs, at, kept = text.encode("utf-8"), [], 0, []
                for a, b in sorted((s["a"], s["b"]) for s in spans):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(b, runs[-1][1])
                    else:
                        runs.append([a, b])
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                out.append((key, sum(b - a for a, b in runs), [{"begin": a, "end": b} for a, b in runs], b"".join([*kept, text[at:]])))
            yield pd.DataFrame(out, columns=["key", "n_removed", "spans", "kept"])

    lost = suspects.select("key", "text").join(marked.hint("shuffle_hash"), "key").mapInPandas(
        remove, "key long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"
    )
    return docs.select(id_col, "key", "n_bytes", F.sha2(F.col("text").cast("binary"), 256).alias("sha256")), lost


def op2_suffix_dedup(spark, folder: str) -> DataFrame:
    docs, lost = repeats(corpus(spark, folder))
    results = lost.select("key", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return docs.join(results, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
