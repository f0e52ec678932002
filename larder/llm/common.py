"""Helpers shared by the text operators.

Every operator reads two columns of its input (the id and the text) and returns a frame of its own, so extra columns,
whatever their names, cannot clash.  NULL ids are passed through; a NULL text counts as empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from larder.session import configure, shared_dir

# Documents handled at once in a task: bounds what a task holds beside its Arrow batch.
STEP = 512

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_WORD = 256


def corpus(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: a cut of the lineage that outlives executors.

    The write's shuffle files go with it, as nothing reads them again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def per_document(
    df: DataFrame,
    make: Callable[[], Callable[[list], dict[str, list]]],
    fields: list[StructField],
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Map whole texts, one task's share at a time, without a shuffle.

    ``make()`` runs once per task and returns a function from a list of texts to one list per output field.  The columns
    in ``keep`` are passed through.
    """
    passed = [id_col, *keep]
    schema = StructType([*[StructField(c, df.schema[c].dataType) for c in passed], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                part = batch.slice(lo, STEP)
                cols = work([t or "" for t in part.column(0).to_pylist()])
                arrays = [pa.array(cols[f.name], arrow.field(f.name).type) for f in fields]
                same = [part.column(i + 1).cast(arrow.field(i).type) for i in range(len(passed))]
                yield pa.RecordBatch.from_arrays([*same, *arrays], schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker lives on beside those of later stages

    return df.select(F.col(text_col).cast("string").alias("__input"), *[F.col(c) for c in passed]).mapInArrow(run, schema)


def hashed_rows(df: DataFrame, rows: int, id_col: str = "doc_id", total: int | None = None) -> DataFrame:
    """The rows with the smallest hashes of their id, up to so many: a fixed, bounded sample for fitting a model.

    A cut-off from the row count leaves about four times as many rows to be ordered, however large the table is.
    """
    total = df.count() if total is None else total
    low = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30))
    near = df.where(low < F.lit(math.ceil((1 << 30) * min(1.0, 4 * rows / max(1, total)))))
    return near.orderBy(low, id_col).limit(rows)


def bounded_sample(df: DataFrame, rows: int, *cols: str, id_col: str = "doc_id") -> list[Row]:
    """The same, brought to the driver."""
    return hashed_rows(df.select(id_col, *cols), rows, id_col).collect()


class WordHashes(dict):
    """64-bit hashes of words as a task's dictionary; a word beyond the limit is hashed each time it is met."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``lower_ascii(text).split()`` of all texts, and how many words each text has.

    Words are read eight bytes at a time, all words at once; words of more than ``LONG_WORD`` bytes are hashed singly.
    """
    parts = [lower_ascii(t) for t in texts]
    data = np.frombuffer(b" " + b" ".join(parts) + b" " * 9, np.uint8)
    blank = (data == 32) | (data - np.uint8(9) < 5)
    border = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, stop = border[0::2], border[1::2]
    length = stop - start
    eights = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))
    out = mix(length.astype(np.uint64) * _ODD)
    far = np.flatnonzero(length > LONG_WORD)
    at, left, which = start, np.where(length > LONG_WORD, 0, length), slice(None)
    while len(at):
        out[which] = mix((out[which] ^ (eights[at] & _FIRST_BYTES.take(np.minimum(left, 8)))) * _ODD)
        on = np.flatnonzero(left > 8)
        at, left, which = at[on] + 8, left[on] - 8, on if isinstance(which, slice) else which[on]
    for i in far.tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : stop[i]].data)
    edges = np.cumsum([1, *[len(p) + 1 for p in parts]])
    return out, np.diff(np.searchsorted(start, edges))


def lower_ascii(text: str) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and nothing else changed."""
    return text.encode("utf-8", "surrogatepass").lower()  # bytes.lower knows ASCII only


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all word windows of the given width; a shorter text is one window, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    w = min(width, n)
    out, mixed = np.full(n - w + 1, np.uint64(w)), mix(hashes)
    for i in range(w):
        out *= _ODD
        out += mixed[i : i + n - w + 1]
    return mix(out)


def in_training(doc_id: str, folds: int, held: int) -> Column:
    """True for rows whose crc32 of the id as text leaves another remainder than ``held``; NULL ids train too."""
    return ~F.coalesce(held_out(doc_id, folds, held), F.lit(False))


def held_out(doc_id: str, folds: int, held: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == held
