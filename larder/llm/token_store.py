"""Token-id files with a minimal perfect hash index.

Layout below one folder that all executors share:

* ``ids-<shard>.bin``: the ids of a range of documents in ascending key order, one after the other, as raw little-endian
  integers (16 bits where the vocabulary allows, else 32), behind a 16-byte header and in front of the table of document
  starts (64 bits each, one more than documents) and a footer with both counts;
* ``index-<bucket>.bin``: for the keys that hash to this bucket a minimal perfect hash (levels of bit arrays, each key
  alone at its bit in one level; the rank of the bit is the slot) and for each slot a stored fingerprint, the shard, the
  position in the shard and the number of documents with this key.

A lookup reads one bit per level, one slot and one slice of a shard.  A key that was never stored fails the fingerprint
(up to 1 in 2**32).  Files are written under a temporary name and renamed, so a task that runs again leaves the same file.

NULL text is empty and stores only the end id; documents with equal ids are neighbours in one shard and share a slot;
documents with a NULL id come first in the files and are read by position, as no key names them.  An empty table gives
no files and no rows.
"""

from __future__ import annotations

import math
import os
import re
import struct
import uuid
from array import array

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm.bpe import byte_letters
from larder.llm.common import corpus, mix, shared_dir, stored

BYTE_BPE = "byte_bpe_50k.json"
END = 0
KEYS_PER_BUCKET = 200_000
# Units and pre-tokens whose ids a Python worker keeps.
KEPT_UNITS, KEPT_PIECES = 700_000, 300_000

_HEAD = 16  # bytes before the first id: a mark and the bytes of an id
_FOOT = "<QQ"  # documents, ids; behind the table of starts
_INDEX = "<4sIQ"  # mark, levels, keys
_SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("place", "<u4"), ("count", "<u4")])


# The pre-token pattern of a byte-level tokenizer, used on Latin letters only; other units go through the library whole.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LATIN = re.compile("[\t-\r -~\u00a1-\u024f]*")


_ENDS = (".", ",")


class UnitEncoder:
    """The library's ids of whole texts, put together from units that it encodes once.

    A space that stands before another character starts a pre-token of its own, whatever stands before it, so a text may
    be cut before a space that follows something else than a space.  Units repeat; a new one is cut into pre-tokens, which
    repeat more, and these are encoded by the library's model.
    """

    def __init__(self, path: str, kept: int = KEPT_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.model, self.code = self.library.model, "H" if self.dtype == "<u2" else "I"
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.kept, self.pieces, self.rest = kept, {}, _Following(self)

    @staticmethod
    def cut(text: str) -> list[str]:
        """Units; each but the first stands for itself with a space before it."""
        units = text.split(" ")
        if "  " not in text:
            return units
        joined, spaces = [units[0]], 0
        for i, u in enumerate(units[1:], 2):
            if u == "" and i < len(units):
                spaces += 1  # a run of spaces belongs to the unit behind it
            else:
                joined.append(" " * spaces + u)
                spaces = 0
        return joined

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(self.pieces) < KEPT_PIECES:
                self.pieces[piece] = ids
        return ids

    def _unit(self, unit: str) -> bytes:
        if _LATIN.fullmatch(unit) and "<|" not in unit:
            return b"".join(map(self._piece, _PIECES.findall(unit)))
        return array(self.code, self.library.encode(unit, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, without the end id."""
        follow, out = self.rest.__getitem__, []
        for t in texts:
            units = self.cut(t)
            out.append(self._unit(units[0]) + b"".join(map(follow, units[1:])))
        return out


class _Following(dict):
    """Ids of a unit behind a space; units beyond the limit are encoded each time."""

    def __init__(self, code: UnitEncoder):
        super().__init__()
        self.code = code

    def __missing__(self, unit: str) -> bytes:
        # A mark behind a letter or digit is a pre-token of its own.
        if unit[-1:] in _ENDS and unit[-2:-1].isalnum() and unit.isprintable():
            ids = self[unit[:-1]] + self.code._piece(unit[-1])
        else:
            ids = self.code._unit(" " + unit)
        if len(self) < self.code.kept:
            self[unit] = ids
        return ids


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class _Draft:
    """A file written under a name of this attempt and renamed at its end: readers never see a part of it."""

    def __init__(self, folder: str, name: str):
        self.system, path = _place(folder)
        self.system.create_dir(path, recursive=True)
        self.path, self.draft = f"{path}/{name}", f"{path}/.{name}-{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(self.draft)

    def publish(self) -> None:
        self.out.close()
        self.system.move(self.draft, self.path)


def write_shards(df: DataFrame, folder: str, path: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the id files.  One row per document: its key, shard, place in the shard, start there and count of ids."""
    keyed = df.select(
        F.col(id_col).cast("long").alias("key"), F.col(id_col).isNull().alias("unnamed"), F.col(text_col).cast("string").alias("text")
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(parts, F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())

    def run(frames):
        code = encoder(path)
        tail, width = np.array([end], code.dtype).tobytes(), np.dtype(code.dtype).itemsize
        shard, draft, places, total, starts = TaskContext.get().partitionId(), None, 0, 0, []
        for f in frames:
            for lo in range(0, len(f), 512):
                part = f.iloc[lo : lo + 512]
                if draft is None:
                    draft = _Draft(folder, f"ids-{shard}.bin")
                    draft.out.write(struct.pack("<8sQ", b"tokenids", width))
                coded = [c + tail for c in code.encode([t if isinstance(t, str) else "" for t in part["text"]])]
                draft.out.write(b"".join(coded))
                n = np.array([len(c) // width for c in coded], np.int64)
                begin = total + np.cumsum(n) - n
                starts.append(begin)
                yield pd.DataFrame(
                    {"key": part["key"], "unnamed": part["unnamed"], "shard": shard, "place": np.arange(places, places + len(n)), "begin": begin, "n_ids": n}
                )
                places, total = places + len(n), total + int(n.sum())
        if draft:
            draft.out.write(np.append(np.concatenate(starts), total).astype("<u8").tobytes() + struct.pack(_FOOT, places, total))
            draft.publish()

    named = ranged.select(F.coalesce("key", F.lit(0)).alias("key"), "unnamed", "text")
    return named.mapInPandas(run, "key long, unnamed boolean, shard int, place long, begin long, n_ids long")


def _hash(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit keys, so different keys never collide as a whole."""
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _bits(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(hashes ^ mix(np.array([level + 1], np.uint64))) % np.uint64(size)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes + np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Levels of bit arrays; a key belongs to the first level in which it is alone at its bit, its slot is the bit's rank."""

    def __init__(self, sizes: list[int], bits: list[np.ndarray]):
        self.sizes, self.bits = sizes, bits  # sizes in bits; bits as 64-bit words
        counts = [np.bitwise_count(b).astype(np.int64) for b in bits]
        before, self.ranks = 0, []
        for c in counts:
            self.ranks.append(before + np.cumsum(c) - c)
            before += int(c.sum())

    @classmethod
    def build(cls, hashes: np.ndarray, spare: float = 2.0) -> PerfectHash:
        sizes, bits, left = [], [], hashes
        while len(left):
            size = 64 * math.ceil(max(64, spare * len(left)) / 64)
            at = _bits(left, len(sizes), size)
            where, count = np.unique(at, return_counts=True)
            alone = where[count == 1]
            words = np.zeros(size // 64, np.uint64)
            np.bitwise_or.at(words, (alone >> np.uint64(6)).astype(np.int64), np.uint64(1) << (alone & np.uint64(63)))
            sizes.append(size)
            bits.append(words)
            left = left[~np.isin(at, alone)]
        return cls(sizes, bits)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has its bit set (such a key was never stored)."""
        out, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, (size, words, ranks) in enumerate(zip(self.sizes, self.bits, self.ranks)):
            at = _bits(hashes[left], level, size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (ranks[word] + below)[hit]
            left = left[~hit]
        return out

    def pack(self) -> bytes:
        return np.array(self.sizes, "<u8").tobytes() + b"".join(b.astype("<u8").tobytes() for b in self.bits)


def write_index(rows: DataFrame, folder: str, keys_per_bucket: int = KEYS_PER_BUCKET) -> int:
    """Write the index files from the rows of :func:`write_shards`; returns the number of buckets."""
    # Equal keys are neighbours in one shard: one slot for the first of them and their number.
    keys = rows.where(~F.col("unnamed")).groupBy("key").agg(
        F.min("shard").alias("shard"), F.min("place").alias("place"), F.count("*").alias("count")
    )
    buckets = max(1, math.ceil(rows.count() / keys_per_bucket))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = _hash(frame["key"].to_numpy())
        table = PerfectHash.build(hashes)
        slots = np.zeros(len(frame), _SLOT)
        at = table.slots(hashes)
        slots["print"][at], slots["shard"][at] = _prints(hashes), frame["shard"]
        slots["place"][at], slots["count"][at] = frame["place"], frame["count"]
        draft = _Draft(folder, f"index-{frame['bucket'].iloc[0]}.bin")
        draft.out.write(struct.pack(_INDEX, b"mphf", len(table.sizes), len(frame)) + table.pack() + slots.tobytes())
        draft.publish()
        return pd.DataFrame({"bucket": frame["bucket"].iloc[:1], "n": [len(frame)]})

    made = keys.select("*", bucket_of("key", buckets).alias("bucket")).groupBy("bucket").applyInPandas(build, "bucket long, n long")
    made.agg(F.sum("n")).collect()
    return buckets


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))


class Index:
    """One index file, read into memory (some 20 bytes a key)."""

    def __init__(self, folder: str, bucket: int):
        system, path = _place(folder)
        with system.open_input_file(f"{path}/index-{bucket}.bin") as file:
            raw = file.read()
        _, levels, keys = struct.unpack_from(_INDEX, raw)
        at = struct.calcsize(_INDEX)
        sizes = np.frombuffer(raw, "<u8", levels, at).astype(int).tolist()
        at, bits = at + 8 * levels, []
        for size in sizes:
            bits.append(np.frombuffer(raw, "<u8", size // 64, at).astype(np.uint64))
            at += size // 8
        self.table, self.entries = PerfectHash(sizes, bits), np.frombuffer(raw, _SLOT, keys, at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are stored, and the entries of these."""
        hashes = _hash(keys)
        at = self.table.slots(hashes)
        found = at >= 0
        found[found] = self.entries["print"][at[found]] == _prints(hashes[found])
        return found, self.entries[at[found]]


class Shard:
    """One id file, read by position."""

    def __init__(self, folder: str, shard: int):
        system, path = _place(folder)
        self.file = system.open_input_file(f"{path}/ids-{shard}.bin")
        size, foot = self.file.size(), struct.calcsize(_FOOT)
        self.width = struct.unpack("<8sQ", self.file.read_at(_HEAD, 0))[1]
        self.documents, self.ids = struct.unpack(_FOOT, self.file.read_at(foot, size - foot))
        self.starts_at = size - foot - 8 * (self.documents + 1)

    def starts(self, place: int, count: int) -> np.ndarray:
        """First ids of so many documents, and where the last one ends."""
        return np.frombuffer(self.file.read_at(8 * (count + 1), self.starts_at + 8 * place), "<u8").astype(np.int64)

    def slice(self, first: int, last: int) -> np.ndarray:
        raw = self.file.read_at(self.width * (last - first), _HEAD + self.width * first)
        return np.frombuffer(raw, f"<u{self.width}")


def lookup(keys: DataFrame, folder: str, buckets: int, key_col: str = "doc_id") -> DataFrame:
    """Shard, place and count of every stored key among distinct non-NULL ``keys``; unknown keys give no row."""

    def find(group, frame: pd.DataFrame) -> pd.DataFrame:
        wanted = frame["key"].to_numpy()
        found, entries = Index(folder, group[0]).find(wanted)
        return pd.DataFrame({"key": wanted[found], "shard": entries["shard"], "place": entries["place"], "count": entries["count"]})

    asked = keys.select(F.col(key_col).cast("long").alias("key")).where("key is not null")
    return asked.select("key", bucket_of("key", buckets).alias("bucket")).groupBy("bucket").applyInPandas(
        find, "key long, shard int, place long, count long"
    )


def read_documents(places: DataFrame, folder: str) -> DataFrame:
    """Read (key, shard, place, count) back from the files: key, shard, begin and the ids as packed 32-bit integers."""

    def read(batches):
        open_shards: dict[int, Shard] = {}
        for frame in batches:
            for number, group in frame.groupby("shard", sort=False):
                if number not in open_shards:
                    open_shards.clear()
                    open_shards[number] = Shard(folder, number)
                shard, out = open_shards[number], []
                for key, unnamed, place, count in zip(group["key"], group["unnamed"], group["place"], group["count"]):
                    starts = shard.starts(place, count)
                    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                        out.append((key, unnamed, number, a, shard.slice(a, b).astype("<u4").tobytes()))
                yield pd.DataFrame(out, columns=["key", "unnamed", "shard", "begin", "ids"])

    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = places.select("key", "unnamed", "shard", "place", "count").repartition(parts, "shard").sortWithinPartitions("shard", "place")
    return near.mapInPandas(read, "key long, unnamed boolean, shard int, begin long, ids binary")


def op9_token_store(spark, folder: str) -> DataFrame:
    docs = corpus(spark, folder)
    files = shared_dir(spark, "token-store")
    rows = stored(write_shards(docs, files, public_tokenizers.path(BYTE_BPE)), "token-rows")
    buckets = write_index(rows, files)
    by_key = lookup(docs.select("doc_id").distinct(), files, buckets).withColumn("unnamed", F.lit(False))
    by_place = rows.where("unnamed").select("key", "shard", "place", F.lit(1).cast("long").alias("count"), "unnamed")
    back = read_documents(by_key.unionByName(by_place), files)
    # One row per shard: the ids of all shards before it.
    totals = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return back.join(before, "shard").select(
        F.when(~F.col("unnamed"), F.col("key")).alias("doc_id"),
        (F.col("before") + F.col("begin")).alias("start"),
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
