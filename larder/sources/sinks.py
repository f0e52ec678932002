"""Writing: append, overwrite, partitioned datasets, keyed upserts.

Tables are parquet folders.  A rewrite goes to a staging folder next to the
target first, so no plan reads the folder that it writes and a failed job
leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished staging folder in the target's place; the old one goes only after the new one is there."""
    fs, new = _fs(spark, staged)
    _, dst = _fs(spark, target)
    old = None
    if fs.exists(dst):
        _, old = _fs(spark, f"{target}__old-{uuid.uuid4().hex}")
        fs.rename(dst, old)
    if not fs.rename(new, dst):
        if old is not None:
            fs.rename(old, dst)
        raise OSError(f"could not move {staged} to {target}")
    if old is not None:
        fs.delete(old, True)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table, schema included."""
    staged = f"{path}__staging-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(staged)
    _swap_in(df.sparkSession, staged, path)


def load(df: DataFrame, path: str, append_rows: bool = False) -> None:
    """Land a loaded frame: append, or overwrite with schema replacement."""
    (append if append_rows else overwrite)(df, path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], salt: int = 1) -> None:
    """Hive-partitioned dataset; one shuffle on the keys keeps the file count low.

    ``salt`` > 1 spreads each partition value over that many tasks, for values that hold much of the table.
    """
    spread = [F.pmod(F.xxhash64(*df.columns), F.lit(salt))] if salt > 1 else []
    df.repartition(*keys, *spread).write.mode("overwrite").partitionBy(*keys).parquet(path)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a match, plus all source rows; new source columns are added."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True)


def _require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    repeated = source.groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"upsert source has repeated keys on {list(keys)}")


def upsert(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Keyed upsert: matched rows are replaced, others inserted, the table created when absent.

    With ``partition_by`` (columns that are part of the key) only the partitions
    that the source touches are read and rewritten, so the cost follows the
    batch and not the table.  Without, the whole table is rewritten; keyed
    tables (:mod:`larder.sources.keyed`) are the form for large ones.
    """
    spark = source.sparkSession
    _require_unique(source, keys)
    if not exists(spark, path):
        overwrite(source, path, partition_by)
        return
    if not partition_by:
        overwrite(merged(spark.read.parquet(path), source, keys), path)
        return
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key, or a row could change partition")
    touched = source.select(*partition_by).distinct()
    kept = spark.read.parquet(path).join(touched, list(partition_by), "left_semi")
    staged = f"{path}__staging-{uuid.uuid4().hex}"
    merged(kept, source, keys).write.partitionBy(*partition_by).parquet(staged)
    done = spark.read.parquet(staged)
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    fs, p = _fs(spark, staged)
    fs.delete(p, True)
