"""Entries dealt out by a hash and shuffled as packed columns: a row per bucket and batch instead of a row per entry."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def how_many(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def split(buckets: int, key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Rows (bucket, packed columns) of entries dealt out by their shingle."""
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at, starts = np.unique(bucket[order], return_index=True)
    for b, lo, hi in zip(at.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]):
        yield (b, *[c[order[lo:hi]].tobytes() for c in columns])


def gathered(packed: DataFrame) -> DataFrame:
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(parts, "bucket").sortWithinPartitions("bucket")


def by_bucket(frames) -> Iterator[tuple[int, pd.DataFrame]]:
    """Whole buckets of a partition sorted by bucket."""
    held: list[pd.DataFrame] = []
    for f in frames:
        while len(f):
            now = f["bucket"].iloc[0]
            if held and held[0]["bucket"].iloc[0] != now:
                yield held[0]["bucket"].iloc[0], pd.concat(held)
                held = []
            same = f["bucket"] == now
            held.append(f[same])
            f = f[~same]
    if held:
        yield held[0]["bucket"].iloc[0], pd.concat(held)
