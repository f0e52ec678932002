"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes into tokens A and tokens B.  Their token ends are two sorted lists; merging them gives
everything: each distinct end closes one overlap of an A token with a B token, and an end in both lists closes a group.
The path of that merge is cut on every ``work``-th diagonal.  A binary search on each diagonal finds how many ends of
either list lie before it, so the pieces hold equal numbers of ends and are merged independently of each other.  A piece
emits its overlaps and the group ends it has met; a group that runs across pieces is stitched by numbering the group ends
of all pieces in order.

The lists of many documents are laid end to end (a document's end is in both lists, so no group crosses it); a long
document is many pieces.  Texts are encoded once and their ids written; links are made again from the ids, which is
cheaper than to move them.  Counts of id pairs are added up in a task, then by A id in the shuffle.  The table of pairs
goes to the tasks in slices of a bounded number of pairs; with more pairs than that the documents are read once per slice
and the sums of the slices added.

Input: id and text.  NULL and empty texts, and texts whose tokens do not give back their bytes, have no tokens: zeros and
an empty digest.  Repeated rows are documents of their own, a NULL id is passed through, an empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from larder.llm.common import STEP, corpus, per_document, stored
from larder.llm.packed import by_bucket, gathered, how_many, split
from larder.llm.token_store import BYTE_BPE, UnitEncoder

PIECE_BPE = "piece_bpe_32k.model"
# Ends in a piece of the merge path: its lists stay in the processor's cache.
WORK = 1 << 16
# Pairs of ids in a slice of the counts, 16 bytes each.
SLICE = 4_000_000
# Pairs that a task adds up before it passes them on.
HELD = 2_000_000
KEPT_UNITS = 700_000

SPACE = "▁"


class PieceEncoder:
    """Ids of a sentencepiece model for a space and the text, put together from units that are encoded once.

    No piece of the vocabulary has a space behind another character (this is checked), so a text may be cut there.
    """

    def __init__(self, path: str, kept: int = KEPT_UNITS):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.dtype = "<u2" if len(self.pieces) <= 1 << 16 else "<u4"
        self.by_unit = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.blank = np.array([self.model.piece_to_id(SPACE)], self.dtype).tobytes()
        self.kept, self.units = kept, {}

    def token_bytes(self) -> list[bytes]:
        """What each id stands for."""
        whole = lambda i, p: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
        return [whole(i, p) for i, p in enumerate(self.pieces)]

    def _unit(self, unit: str) -> bytes:
        ids = np.array(self.model.encode(unit), self.dtype).tobytes() if unit else self.blank
        if len(self.units) < self.kept:
            self.units[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.by_unit:
            return np.array(self.model.encode(text), self.dtype).tobytes()
        known = self.units
        return b"".join([known.get(u) or self._unit(u) for u in UnitEncoder.cut(" " + text)[1:]])


def byte_tokens(code: UnitEncoder) -> list[bytes]:
    """What each id of a byte-level vocabulary stands for."""
    back = {letter: raw for raw, letter in code.letters.items()}  # letter to byte
    tokens = [b""] * (1 + max(code.library.get_vocab().values()))
    for token, i in code.library.get_vocab().items():
        tokens[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return tokens


class Vocabularies:
    """Both encoders of a Python worker and what their ids stand for."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = UnitEncoder(a_path), PieceEncoder(b_path)
        self.a.library.encode_special_tokens = True  # their strings in a text are plain text
        self.a_bytes, self.b_bytes = byte_tokens(self.a), self.b.token_bytes()
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        # An id in decimal with each of the signs that may follow it: next token, end of the side.
        self.a_text = [f"{i}{s}" for s in ",|" for i in range(len(self.a_bytes))]
        self.b_text = [f"{i}{s}" for s in ",;" for i in range(len(self.b_bytes))]
        self.text = self.a_text + self.b_text

    def both(self, text: str) -> tuple[bytes, bytes]:
        """Ids of a space and the text; nothing where a side does not give back its bytes."""
        if not text:
            return b"", b""
        (a,), b = self.a.encode([" " + text]), self.b.encode(text)
        raw = (" " + text).encode("utf-8", "surrogatepass")
        for ids, dtype, tokens in ((a, self.a.dtype, self.a_bytes), (b, self.b.dtype, self.b_bytes)):
            if b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype).tolist())) != raw:
                return b"", b""
        return a, b


_KNOWN: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    if (a_path, b_path) not in _KNOWN:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _KNOWN[a_path, b_path] = Vocabularies(a_path, b_path)
    return _KNOWN[a_path, b_path]


def diagonals(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two sorted lists crosses every ``work``-th diagonal; of equal ends A comes first."""
    diag = np.arange(0, len(a) + len(b) + work, work).clip(max=len(a) + len(b))
    lo, hi = np.maximum(0, diag - len(b)), np.minimum(diag, len(a))
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        further = a[mid] <= b[diag[open_] - mid - 1]
        lo[open_[further]] = mid[further] + 1
        hi[open_[~further]] = mid[~further]
    return lo, diag - lo


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, ...]:
    """Overlaps (A token, B token) closed by the ends of one piece, and the group ends among them."""
    part_a, part_b = a[i0:i1], b[j0:j1]
    under_a = j0 + np.searchsorted(part_b, part_a, "left")  # the B token that holds the last byte of an A token
    under_b = i0 + np.searchsorted(part_a, part_b, "right")
    met = under_b > 0
    met[met] = a[under_b[met] - 1] == part_b[met]  # the A end just before, maybe in the piece before, is the same
    ends_b = np.arange(j0, j1)
    alone = ~met
    return (
        np.concatenate([np.arange(i0, i1), under_b[alone]]),
        np.concatenate([under_a, ends_b[alone]]),
        under_b[met],
        ends_b[met] + 1,
    )


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, ...]:
    """All overlaps of two lists of token ends with the same last end, and for each group the tokens up to its end."""
    i, j = diagonals(a, b, work)
    pieces = [piece_overlaps(a, b, *span) for span in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    return tuple(np.concatenate(x) for x in zip(*pieces)) if pieces else (np.zeros(0, np.int64),) * 4


class Aligned:
    """The alignment of some documents laid end to end."""

    def __init__(self, known: Vocabularies, a: Sequence[bytes], b: Sequence[bytes], work: int = WORK):
        self.known = known
        self.a = np.frombuffer(b"".join(a), known.a.dtype).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), known.b.dtype).astype(np.int64)
        size = lambda ids, dtype: np.array([len(x) for x in ids], np.int64) // np.dtype(dtype).itemsize
        self.n_a, self.n_b = size(a, known.a.dtype), size(b, known.b.dtype)
        self.in_a, self.in_b, self.to_a, self.to_b = overlaps(np.cumsum(known.a_len[self.a]), np.cumsum(known.b_len[self.b]), work)
        self.last_a = np.cumsum(self.n_a)
        # A document without tokens has no group; the groups of the others end at or before their last token.
        self.groups = np.diff(np.searchsorted(self.to_a, self.last_a, "right"), prepend=0)
        self.doc = np.repeat(np.arange(len(a)), self.n_a)[self.in_a]
        self.pair = self.a[self.in_a] * len(known.b_bytes) + self.b[self.in_b]

    def spelled(self) -> list[str]:
        """Groups as ``a1,a2|b1;a3|b2,b3`` per document."""
        shift = len(self.known.a_bytes), len(self.known.b_bytes)
        sign_a, sign_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        sign_a[self.to_a - 1], sign_b[self.to_b - 1] = True, True
        group_a, group_b = np.cumsum(sign_a) - sign_a, np.cumsum(sign_b) - sign_b
        item = np.empty(len(self.a) + len(self.b), np.int64)
        before_b = np.concatenate([[0], self.to_b])  # B tokens in the groups before
        item[np.arange(len(self.a)) + before_b[group_a]] = self.a + sign_a * shift[0]
        item[np.arange(len(self.b)) + self.to_a[group_b]] = 2 * shift[0] + self.b + sign_b * shift[1]
        out, lo, text = [], 0, self.known.text
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(map(text.__getitem__, item[lo : lo + n].tolist()))[:-1])
            lo += n
        return out


def encode_both(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row number, id and both packed lists of ids of every document, written below the shared folder."""

    def make():
        known = vocabularies(a_path, b_path)

        def work(texts):
            pairs = [known.both(t) for t in texts]
            return {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}

        return work

    coded = per_document(df, make, [StructField("a", BinaryType()), StructField("b", BinaryType())], id_col, text_col)
    return stored(coded.withColumn("row", F.monotonically_increasing_id()), "aligned-ids")


def _batches(batches: Iterator[pa.RecordBatch], known: Vocabularies) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, STEP):
            part = batch.slice(lo, STEP)
            a, b = (part.column(part.schema.get_field_index(c)).to_pylist() for c in "ab")
            yield part, Aligned(known, a, b)


def _added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys added up, in ascending order."""
    if len(key) == 0:
        return key, n
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def pair_counts(coded: DataFrame, a_path: str, b_path: str, held: int = HELD) -> DataFrame:
    """For each linked pair of ids how many documents hold it, packed by A id: ``pairs``, ``counts`` and ``best``.

    ``pairs`` are A id times the size of the B vocabulary plus B id, ascending; ``best`` is 1 where a count is the highest
    of its A id.  An A id has at most as many pairs as there are B ids, which bounds what comes together for it.
    """
    shards = how_many(coded)

    def local(batches):
        known = vocabularies(a_path, b_path)
        width = len(known.b_bytes)
        keys, counts, size = [], [], 0

        def passed(key, n):
            for row in split(shards, (key // width).astype(np.uint64), key, n):
                yield row

        def frame(rows):
            return pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(("bucket", "pairs", "counts"))}, _PACKED)

        for _, done in _batches(batches, known):
            docs = len(done.n_a)
            key = np.sort(done.pair * docs + done.doc)  # a pair's documents stand together
            key = key[np.concatenate([[True], key[1:] != key[:-1]])] // docs if len(key) else key
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
            keys.append(key[first])
            counts.append(np.diff(first, append=len(key)))
            size += len(first)
            if size > 2 * held:
                key, n = _added(np.concatenate(keys), np.concatenate(counts))
                if len(key) > held:
                    yield frame(list(passed(key, n)))
                    key, n = key[:0], n[:0]
                keys, counts, size = [key], [n], len(key)
        if size:
            yield frame(list(passed(*_added(np.concatenate(keys), np.concatenate(counts)))))

    def summed(frames):
        known = vocabularies(a_path, b_path)
        width = len(known.b_bytes)
        for shard, rows in by_bucket(frames):
            ints = lambda c: np.frombuffer(b"".join(rows[c]), np.int64)
            key, n = _added(ints("pairs"), ints("counts"))
            first = np.flatnonzero(np.concatenate([[True], key[1:] // width != key[:-1] // width]))
            top = np.repeat(np.maximum.reduceat(n, first), np.diff(first, append=len(key)))
            yield pd.DataFrame({"shard": [shard], "pairs": [key.tobytes()], "counts": [n.tobytes()], "best": [(n == top).tobytes()], "n": [len(key)]})

    packed = coded.select("a", "b").mapInArrow(local, "bucket long, pairs binary, counts binary")
    return stored(gathered(packed).mapInPandas(summed, "shard long, pairs binary, counts binary, best binary, n long"), "aligned-pairs")


_PACKED = pa.schema([("bucket", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])

_DIGESTS = [("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()), ("n_links", LongType()), ("groups_sha256", StringType())]
_SUMS = [("n_best", LongType()), ("count_sum", LongType())]


def align(
    df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", spell: bool = False, in_slice: int = SLICE
) -> DataFrame:
    """One row per document: tokens, groups and links, how many links are the best of their A id, and the sum of counts.

    With ``spell`` the groups are returned as ``groups`` text beside their digest.
    """
    spark = df.sparkSession
    coded = encode_both(df, a_path, b_path, id_col, text_col)
    pairs = pair_counts(coded, a_path, b_path)
    slices = _slices([(r.shard, r.n) for r in pairs.select("shard", "n").collect()], in_slice)
    fields = [*_DIGESTS, *([("groups", StringType())] if spell else []), *_SUMS]
    schema = StructType([coded.schema["row"], coded.schema[id_col], *[StructField(n, t) for n, t in fields]])

    def counted(number: int) -> DataFrame:
        rows = pairs.where(F.col("shard").isin(slices[number])).select("pairs", "counts", "best").toArrow()
        key = np.frombuffer(b"".join(rows["pairs"].to_pylist()), np.int64)
        value = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.int64) * 2 + np.frombuffer(b"".join(rows["best"].to_pylist()), np.uint8)
        order = np.argsort(key)
        table = spark.sparkContext.broadcast((key[order], value[order]))
        first = number == 0

        def run(batches):
            known = vocabularies(a_path, b_path)
            key, value = table.value
            for part, done in _batches(batches, known):
                docs = len(done.n_a)
                at = np.searchsorted(key, done.pair).clip(max=max(0, len(key) - 1))
                there = key[at] == done.pair if len(key) else np.zeros(len(done.pair), bool)
                found, doc = (value[at[there]] if len(key) else value[:0]), done.doc[there]
                cols = {"n_best": np.bincount(doc[(found & 1) == 1], minlength=docs), "count_sum": _sums(doc, found >> 1, docs)}
                if first:
                    spelled = done.spelled()
                    cols |= {
                        "n_a": done.n_a,
                        "n_b": done.n_b,
                        "n_groups": done.groups,
                        "n_links": np.bincount(done.doc, minlength=docs),
                        "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled],
                        "groups": spelled,
                    }
                of = lambda n, t: pa.array(cols[n], pa.string() if isinstance(t, StringType) else pa.int64()) if n in cols else pa.nulls(docs, pa.string() if isinstance(t, StringType) else pa.int64())
                same = [part.column(part.schema.get_field_index(c)) for c in ("row", id_col)]
                yield pa.RecordBatch.from_arrays([*same, *[of(n, t) for n, t in fields]], names=["row", id_col, *[n for n, _ in fields]])

        return coded.mapInArrow(run, schema)

    out = counted(0)
    if len(slices) > 1:
        for number in range(1, len(slices)):
            out = out.unionByName(counted(number))
        out = out.groupBy("row").agg(
            F.first(id_col, ignorenulls=True).alias(id_col),
            *[F.first(n, ignorenulls=True).alias(n) for n, _ in fields[: -len(_SUMS)]],
            *[F.sum(n).alias(n) for n, _ in _SUMS],
        )
    return out.select(id_col, *[n for n, _ in fields])


def _slices(shards: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Shards (their number follows the shuffle's partitions) put together up to so many pairs; a larger one stays alone."""
    out, size = [[]], 0
    for shard, n in sorted(shards):
        if out[-1] and size + n > most:
            out.append([])
            size = 0
        out[-1].append(shard)
        size += n
    return out


def _sums(doc: np.ndarray, n: np.ndarray, docs: int) -> np.ndarray:
    """Exact sums of whole numbers per document; links are not ordered by document, so they are added by halves of 32 bits."""
    low = np.bincount(doc, weights=n & 0xFFFFFF, minlength=docs)
    high = np.bincount(doc, weights=n >> 24, minlength=docs)
    return low.astype(np.int64) + (high.astype(np.int64) << 24)


def op11_alignment(spark, folder: str) -> DataFrame:
    return align(corpus(spark, folder), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
