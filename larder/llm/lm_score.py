"""Language-model scores: a self-attention model's log probability of every text, next to a unigram base score.

Every text is cut into subword ids once; the ids are written and serve the counts, the fit and the scores.  The attention
model (:mod:`larder.llm.attention`) takes its classes and shares from the counts of all ids in all training texts.  Its
weights start from ``DOCUMENTS`` texts on the driver; then every training text, in shards of about ``SHARD`` texts, is
passed over from this start where it is, and the mean of the shards' weights, added up by Spark, is the model.
The base score needs the count of every word in all training texts.  Counts are summed by hash buckets.  The most
frequent words (at most ``COMMON``, 4 MB broadcast) are looked up where the texts are; occurrences of all other words
travel to the bucket of their word and come back as one partial sum for each document and bucket.

NULL texts are empty and consist of the end alone; NULL ids train; repeated rows count and are scored each time; without
training text every token is unknown (count 0) and the model scores by its start values; an empty table gives an empty
result.  Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from larder.llm.attention import AttentionModel
from larder.llm.bpe import WORD_BPE, codec
from larder.llm.common import bounded_sample, corpus, held_out, in_training, per_document, stored, word_hashes
from larder.llm.packed import by_bucket, gathered, how_many, split

DOCUMENTS = 400
COMMON = 1 << 18
# One of so many training texts is passed over by the fit (1: all), in shards of about so many texts; ids handled at once.
SHARE, SHARD, AT_ONCE = 1, 2048, 1 << 18


def word_counts(texts: DataFrame) -> DataFrame:
    """Counts of all words of column ``t``: one row per bucket with sorted packed hashes and counts."""
    buckets = how_many(texts)

    def emit(frames):
        for f in frames:
            texts = f["t"].tolist()
            words = np.concatenate([word_hashes(texts[lo : lo + 256])[0] for lo in range(0, len(texts), 256)] or [np.empty(0, np.uint64)])
            if len(words):
                keys, counts = np.unique(words, return_counts=True)
                yield pd.DataFrame(split(buckets, keys, keys, counts.astype("<u8")), columns=["bucket", "keys", "counts"])

    def add(frames):
        for bucket, f in by_bucket(frames):
            keys, counts = np.frombuffer(b"".join(f["keys"]), "<u8"), np.frombuffer(b"".join(f["counts"]), "<u8")
            found, at = np.unique(keys, return_inverse=True)
            total = np.zeros(len(found), np.uint64)
            np.add.at(total, at, counts)
            yield pd.DataFrame({"bucket": [bucket], "keys": [found.tobytes()], "counts": [total.tobytes()], "words": [len(found)], "tokens": [int(total.sum())]})

    packed = texts.mapInPandas(emit, "bucket long, keys binary, counts binary")
    return stored(gathered(packed).mapInPandas(add, "bucket long, keys binary, counts binary, words long, tokens long"), "word-counts")


def common_words(counts: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent words: the threshold doubles until they are at most so many."""

    def above(limit: int):
        def pick(frames):
            for f in frames:
                for keys, n in zip(f["keys"], f["counts"]):
                    n = np.frombuffer(n, "<u8")
                    hot = n >= limit
                    if hot.any():
                        yield pd.DataFrame({"k": np.frombuffer(keys, "<u8")[hot].view(np.int64), "c": n[hot].astype(np.int64)})

        return counts.select("keys", "counts").mapInPandas(pick, "k long, c long")

    limit = 1
    while above(limit).count() > most:
        limit *= 2
    rows = above(limit).toPandas()
    keys, n = rows["k"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)
    order = np.argsort(keys)
    return keys[order], n[order]


def sorted_places(values: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """What ``np.searchsorted`` gives for sorted hashes: their leading bits lead next to the place."""
    bits = max(1, len(values).bit_length())
    shift = np.uint64(64 - bits)
    first = np.searchsorted(values, np.arange(1 << bits, dtype=np.uint64) << shift)
    ended = np.append(values, np.uint64(2**64 - 1))

    def places(keys: np.ndarray) -> np.ndarray:
        at = first.take((keys >> shift).view(np.int64))
        behind = np.flatnonzero(ended.take(at) < keys)
        while len(behind):
            at[behind] += 1
            behind = behind[ended.take(at[behind]) < keys[behind]]
        return at

    return places


def _coded(code, texts: Sequence[str]) -> list[np.ndarray]:
    """Ids of texts by the tokenizer, the id behind its last one being the end of a text."""
    end = len(code.tokens)
    return [np.append(np.frombuffer(ids, "<u4"), end).astype(np.int64) for ids in code.encode_all(texts)]


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """The rows of ``texts`` with the packed ``ids`` of column ``t``."""

    def make():
        code = codec(path)
        return lambda part: {"ids": [ids.astype(_kind(len(code.tokens))).tobytes() for ids in _coded(code, part)]}

    first, *rest = texts.columns
    return per_document(texts, make, [StructField("ids", BinaryType())], first, "t", keep=rest)


def _kind(end: int) -> str:
    """How ids are packed: 16 bits where the end, the largest, fits."""
    return "<u2" if end < 1 << 16 else "<u4"


def _unpacked(packed: Iterable[bytes], end: int) -> list[np.ndarray]:
    return [np.frombuffer(ids, _kind(end)) for ids in packed]


def id_counts(texts: DataFrame, path: str) -> np.ndarray:
    """How often each id, the end included, stands in all texts of column ``t`` (``ids`` if they are encoded)."""
    rows = texts if "ids" in texts.columns else encoded(texts, path)
    end = len(codec(path).tokens)

    def count(frames):
        total = np.zeros(end + 1, np.int64)
        for f in frames:
            for lo in range(0, len(f), 64):
                total += np.bincount(np.frombuffer(b"".join(f["ids"][lo : lo + 64]), _kind(end)), minlength=end + 1)
        met = np.flatnonzero(total)
        yield pd.DataFrame({"id": met, "n": total[met]})

    found = rows.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(end + 1)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _portions(texts: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def fit_further(model: AttentionModel, texts: DataFrame, rows: int, end: int) -> AttentionModel:
    """The mean of the weights that the shards of ``texts`` (``id``, ``ids``) reach, by their numbers of blocks.

    A task adds up the weights of its shards, and Spark those of the tasks, weight by weight.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)
    mark, shards = F.xxhash64("id", "ids"), max(1, math.ceil(rows / SHARE / SHARD))
    share = texts.select("ids", mark.alias("h")).where(F.pmod("h", F.lit(SHARE)) == 0)
    share = share.select("ids", "h", F.pmod(F.shiftright("h", 8), F.lit(shards)).cast("int").alias("shard"))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def fit(frames):
        lines = ((s, ids) for f in frames for s, ids in zip(f["shard"].tolist(), _unpacked(f["ids"], end)))
        total = np.zeros(len(shared.value.state) + 1)
        for _, group in groupby(lines, lambda line: line[0]):
            own = shared.value.with_state(shared.value.state)
            blocks = sum(own.fit_once(portion) for portion in _portions(ids for _, ids in group))
            total += blocks * np.append(own.state.astype(float), 1)
        if total[-1]:
            yield pd.DataFrame({"total": [total]})

    near = share.repartitionById(parts, F.pmod("shard", F.lit(parts))).sortWithinPartitions("shard", "h", "ids").select("shard", "ids")
    sums = near.mapInPandas(fit, "total array<double>").select(F.posexplode("total").alias("at", "x"))
    found = sums.groupBy("at").agg(F.sum("x").alias("x")).toPandas().sort_values("at")["x"].to_numpy(float)
    return model.with_state(found[:-1] / found[-1]) if len(found) else model


def fit_model(training: DataFrame, documents: int, rows: int, path: str) -> AttentionModel:
    """An attention model over the ids of the tokenizer and the end of a text, from ``id`` and ``ids``."""
    counts = id_counts(training, path)
    model, end = AttentionModel(len(counts), counts, whole=True), len(counts) - 1
    if not rows:
        return model
    model.fit(_unpacked([r["ids"] for r in bounded_sample(training, documents, "ids", id_col="id")], end))
    return fit_further(model, training, rows, end)


def score(df: DataFrame, training: DataFrame | Column, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          documents: int = DOCUMENTS) -> DataFrame:
    """Id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every document of ``df``.

    ``training`` is a table of its own, or says which rows of ``df`` train; those are encoded once.
    """
    path = path or public_tokenizers.path(WORD_BPE)
    spark = df.sparkSession
    learn = training if isinstance(training, Column) else F.lit(False)
    read = lambda rows, learn: rows.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), learn.alias("learn")
    )
    docs = stored(encoded(read(df, learn), path), "lm-ids")
    training = docs.where("learn") if isinstance(training, Column) else stored(encoded(read(training, F.lit(True)), path), "lm-ids")
    counts = word_counts(training.select("t"))
    ends = training.count()
    total = counts.agg(F.sum("words").alias("v"), F.sum("tokens").alias("n")).first()
    train_tokens = (total["n"] or 0) + ends
    penalty = float(np.log10(train_tokens + (total["v"] or 0) + (ends > 0) + 1))
    model = fit_model(training.select("id", "ids"), documents, ends, path)
    shared = spark.sparkContext.broadcast((model, *common_words(counts)))
    end = len(codec(path).tokens)
    buckets, end_log, end_known = how_many(df), float(np.log10(ends + 1)), int(ends > 0)

    names = ["id", "row", "n", "known", "base", "score", "bucket", "keys", "rows"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.binary()]

    def look(batches):
        attention, common, common_counts = shared.value
        logs, places = np.log10(common_counts + 1.0), sorted_places(common)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                keys, lengths = word_hashes(part.column(1).to_pylist())
                owner = np.repeat(np.arange(len(lengths)), lengths)
                at = places(keys)
                hit = np.zeros(len(keys), bool)
                if len(common):
                    hit = common[np.minimum(at, len(common) - 1)] == keys
                base = np.bincount(owner[hit], logs[at[hit]], len(lengths))
                known = np.bincount(owner[hit], minlength=len(lengths))
                ids = _unpacked(part.column(2).to_pylist(), end)
                rows = row + np.arange(len(lengths))
                row += len(lengths)
                arrays = [part.column(0), rows, lengths + 1, known + end_known, base + end_log, attention.score(ids)]
                yield _batch(names, kinds, arrays, len(lengths))
                if not hit.all():
                    rare = list(zip(*split(buckets, keys[~hit], keys[~hit], rows[owner[~hit]])))
                    yield _batch(names, kinds, [*[None] * 6, *rare], len(rare[0]))

    schema = "id long, row long, n long, known long, base double, score double, bucket long, keys binary, rows binary"
    scored = stored(docs.select("id", "t", "ids").mapInArrow(look, schema), "lm-scores")

    def settle(frames):
        for _, f in by_bucket(frames):
            own = f["counts"].notna()
            keys = np.frombuffer(b"".join(f["keys"][own]), "<u8")
            n = np.frombuffer(b"".join(f["counts"][own]), "<u8")
            asked, rows = np.frombuffer(b"".join(f["keys"][~own]), "<u8"), np.frombuffer(b"".join(f["rows"][~own]), "<i8")
            if not len(asked) or not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            hit = keys[at] == asked
            found, place = np.unique(rows[hit], return_inverse=True)
            logs = np.log10(n[at[hit]].astype(float) + 1)
            yield pd.DataFrame({"row": found, "more": np.bincount(place, logs, len(found)), "seen": np.bincount(place, minlength=len(found))})

    rare = scored.where("row is null").select("bucket", "keys", F.lit(None).cast("binary").alias("counts"), "rows")
    both = rare.unionAll(counts.select("bucket", "keys", "counts", F.lit(None).cast("binary")))
    partial = gathered(both).mapInPandas(settle, "row long, more double, seen long")
    sums = partial.groupBy("row").agg(F.sum("more").alias("more"), F.sum("seen").alias("seen"))
    rest = scored.where("row is not null").join(sums, "row", "left")
    return rest.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n") * F.lit(penalty)).alias("base_score"),
        "score",
    )


def _batch(names: list[str], kinds: list, columns: list, n: int) -> pa.RecordBatch:
    arrays = [pa.nulls(n, k) if c is None else (c.cast(k) if isinstance(c, pa.Array) else pa.array(c, k)) for c, k in zip(columns, kinds)]
    arrays += [pa.nulls(n, k) for k in kinds[len(arrays) :]]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def op8_lm_score(spark, folder: str) -> DataFrame:
    docs = corpus(spark, folder)
    scored = score(docs, in_training("doc_id", 7, 2))
    return scored.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
