"""Exact top-k search by inner product with Fagin's threshold algorithm.

The candidates are dealt into blocks.  A block keeps, for each dimension, its vectors in ascending order of that component:
the sorted lists.  For a query every list is read from the end that its weight favours, all lists to the same depth; each
vector met is scored once by random access.  A vector not yet met has in every list at most the value at the next depth,
so the weighted sum of those values bounds its score, and reading stops when that bound is below the k-th score found.
Equal scores go to the smaller id, so reading goes on while the bound is equal.  A component with weight zero has no list.

Depths grow by a factor, the bounds of all queries at a depth are one product, and where the queries of a batch are about
to meet most of a block, its vectors are scored for all of them at once.  Queries are a share of the rows and are sent to
every block, as rows that stream past it; a block's best k per query are merged in the shuffle, each task passing on k.

Components become ``floor(scale * x)``; scores are exact whole numbers (products in 32- or 64-bit floats only where all
sums are whole numbers below 2**24 or 2**53, else 64-bit integers; vectors whose scores may pass 63 bits are refused with
an error).  Vectors that are NULL or hold a NULL or non-finite component take no part; vectors meet those of their own
length only, empty ones score 0.  Equal rows (id and vector) are stored once with their number and take as many ranks; as
queries they are asked once.  A row never is a result of its own id.  A NULL id is no query and comes last among ties.
Fewer candidates than k give fewer rows, an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import corpus, stored

SCALE = 1024
K = 10
# A block of this many vectors of 64 components takes some 100 MB with its lists.
MOST_IN_BLOCK, LEAST_IN_BLOCK = 65_536, 2_048
# Queries scored together; depth of the first reading and its growth.
TOGETHER, FIRST, GROWTH = 64, 16, 4


class Block:
    """Vectors of one length with their sorted lists."""

    def __init__(self, ids: np.ndarray, unnamed: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, unnamed))  # positions follow the order of ties: named ids ascending, then the others
        self.ids, self.unnamed, self.copies, self.vectors = ids[order], unnamed[order], copies[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.vectors, self.lists, 0)
        self.norm = float(np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1).max(initial=0)))
        self._as = {}

    def typed(self, queries: np.ndarray) -> type:
        """The fastest type in which all scores, and all sums on the way to them, are exact."""
        # By Cauchy and Schwarz no sum of absolute products is above the product of the norms.
        most = self.norm * float(np.sqrt((queries.astype(np.float64) ** 2).sum(1).max(initial=0))) * 1.0001
        if most >= 1 << 62:
            raise ValueError("scores of these vectors do not fit into 64 bits")
        return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64

    def as_type(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as = {kind: self.vectors.astype(kind)}
        return self._as[kind]

    def bounds(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """The most that a vector not met down to this depth can score, per query."""
        high, low = np.maximum(queries, 0), np.minimum(queries, 0)
        return high @ self.values[len(self.ids) - 1 - depth] + low @ self.values[depth]

    def met(self, query: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Positions that the lists of a query hold between two depths; repeated ones included."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        return np.concatenate([self.lists[n - hi : n - lo, up].ravel(), self.lists[lo:hi, down].ravel()])

    def top(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of the query, positions and scores of its k best rows, copies counted; ``own`` are the queries' ids."""
        for lo in range(0, len(queries), TOGETHER):
            for q, at, score in self._top(own[lo : lo + TOGETHER], queries[lo : lo + TOGETHER], k):
                yield lo + q, at, score

    def _top(self, own, queries, k):
        n, kind = len(self.ids), self.typed(queries)
        vectors, weights = self.as_type(kind), queries.astype(kind)
        scored = np.zeros((len(queries), n), bool)
        # Rows of the query's own id are no candidates.
        first, last = (np.searchsorted(self.ids[: n - self.unnamed.sum()], own, side) for side in ("left", "right"))
        for q in range(len(queries)):
            scored[q, first[q] : last[q]] = True
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        running = [q for q in range(len(queries)) if n]
        lo, hi = 0, min(FIRST, n)
        while running:
            new = []
            for q in running:
                seen = np.zeros(n, bool)
                seen[self.met(queries[q], lo, hi)] = True
                if hi == n:
                    seen[:] = True  # a query of zeros has no list
                seen &= ~scored[q]
                scored[q] |= seen
                new.append(np.flatnonzero(seen))
            if sum(map(len, new)) * 4 > n * len(running):
                union = np.flatnonzero(np.bincount(np.concatenate(new), minlength=n))
                table = weights[running] @ vectors[union].T
                found = [table[i, np.searchsorted(union, at)] for i, at in enumerate(new)]
            else:
                found = [vectors[at] @ weights[q] for q, at in zip(running, new)]
            for q, at, score in zip(running, new, found):
                best[q] = self._best(np.concatenate([best[q][0], at]), np.concatenate([best[q][1], score.astype(np.int64)]), k)
            if hi < n:
                limit = self.bounds(queries[running], hi)
                running = [q for q, most in zip(running, limit.tolist()) if self.copies[best[q][0]].sum() < k or most >= best[q][1][-1]]
            else:
                running = []
            lo, hi = hi, min(hi * GROWTH, n)
        for q, (at, score) in enumerate(best):
            yield q, at, score

    def _best(self, at, score, k):
        if len(at) > 4 * k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[score >= least], score[score >= least]
        order = np.lexsort((at, -score))[:k]  # each row counts once at least
        enough = int(np.searchsorted(np.cumsum(self.copies[at[order]]), k, "left")) + 1
        order = order[:enough]
        return at[order], score[order]


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Id, vector of ``floor(scale * x)`` and number of equal rows; without the vectors that take no part."""
    x = lambda c: F.lit(scale) * c.cast("double")
    usable = F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < F.lit(float("inf"))), F.lit(False))
    )
    rows = df.where(usable).select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda c: F.floor(x(c))).alias("vector"))
    return rows.groupBy("id", "vector").agg(F.count("*").alias("copies"))


def top_k(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    most: int = MOST_IN_BLOCK,
    least: int = LEAST_IN_BLOCK,
) -> DataFrame:
    """The k best rows of every query: ``query_id, rank, vec_id, score``.  ``is_query`` is a condition on the column ``id``."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = stored(whole_vectors(df, id_col, vector_col, scale), "search-vectors")
    total = vectors.count()
    blocks = max(1, -(-total // most), min(4 * parts, total // least))
    size = F.size("vector")
    hashed = F.xxhash64("id", "vector")
    rows = vectors.select(F.pmod(hashed, F.lit(blocks)).alias("block"), size.alias("size"), F.lit(0).alias("kind"), "id", "vector", "copies")
    asked = vectors.where(is_query & F.col("id").isNotNull()).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), size.alias("size"), F.lit(1).alias("kind"), "id", "vector", "copies"
    )
    met = rows.unionByName(asked).repartition(parts, "block", "size").sortWithinPartitions("block", "size", "kind")

    def search(batches):
        held: list[pa.RecordBatch] = []
        key, block = None, None
        for batch in batches:
            lo, n = 0, batch.num_rows
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], 1)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1 if n else []
            for hi in [*cuts, n]:
                if hi == lo:
                    continue
                part, mark = batch.slice(lo, hi - lo), tuple(marks[lo].tolist())
                lo = hi
                if mark[:2] != key:
                    key, block, held = mark[:2], None, []
                if mark[2] == 0:
                    held.append(part)
                    continue
                if block is None:
                    block, held = _block(held, key[1]), []
                yield from _answers(block, part, key[1], k)

    found = met.mapInArrow(search, "query_id long, asked string, vec_id long, score long, copies long")
    best = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    first = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")
    copies = first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(k).cast("long"), "copies"))))
    return copies.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _columns(parts: list[pa.RecordBatch], size: int) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches(parts) if parts else None
    if table is None:
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros((0, size), np.int64)
    ids = table.column("id").combine_chunks()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    unnamed = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(), unnamed, table.column("copies").to_numpy(), flat.reshape(len(unnamed), size)


def _block(parts: list[pa.RecordBatch], size: int) -> Block:
    return Block(*_columns(parts, size))


def _answers(block: Block, part: pa.RecordBatch, size: int, k: int) -> Iterator[pa.RecordBatch]:
    import hashlib

    ids, _, _, queries = _columns([part], size)
    out = [[], [], [], [], []]
    for q, at, score in block.top(ids, queries, k):
        named = hashlib.md5(queries[q].tobytes()).hexdigest()
        out[0] += [int(ids[q])] * len(at)
        out[1] += [named] * len(at)
        out[2] += [None if none else i for i, none in zip(block.ids[at].tolist(), block.unnamed[at].tolist())]
        out[3] += score.tolist()
        out[4] += block.copies[at].tolist()
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), *[pa.array(c, pa.int64()) for c in out[2:]]], names=["query_id", "asked", "vec_id", "score", "copies"])


def op13_topk(spark, folder: str) -> DataFrame:
    return top_k(corpus(spark, folder, "embeddings"), F.col("id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
  SELECT query_id, vec_id, CAST(score AS BIGINT) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
