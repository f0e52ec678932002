"""Incremental state: merges, reprocess windows, generations and latest flags."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.chunked import row_numbers, with_totals
from larder.sources import keyed, sinks


def merge_incremental(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after merging a batch on its key; columns new in the batch are added."""
    return sinks.merged(target, new, keys)


def reprocess_window(df: DataFrame, path: str, date: str, days: int = 30, first: str = "2015-01-01") -> None:
    """Rewrite the trailing window of a month-partitioned table so that late rows are picked up.

    The window starts ``days`` before the newest date of the table, moved back to the start of its month, because
    whole partitions are replaced.  Without a table everything since ``first`` is built.
    """
    spark = df.sparkSession
    rows = df.withColumn("month", F.date_format(F.trunc(F.to_date(date), "month"), "yyyy-MM"))
    if not sinks.exists(spark, path):
        rows.where(F.to_date(date) >= F.lit(first).cast("date")).write.partitionBy("month").parquet(path)
        return
    newest = spark.read.parquet(path).agg(F.max(F.to_date(date))).scalar()
    start = F.trunc(F.date_sub(newest, days), "month")
    rows.where(F.to_date(date) >= start).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("month").parquet(path)


def append_generation(df: DataFrame, path: str, generated_at: Column) -> None:
    """Add a run's rows to a log, marked with the time of the run."""
    sinks.append(df.withColumn("generated_at", generated_at), path)


def latest_generation(log: DataFrame, keys: Sequence[str], ts: str = "generated_at") -> DataFrame:
    """Rows of the newest run per key."""
    newest = log.groupBy(*keys).agg(F.max(ts).alias(ts))
    return log.join(newest, [*keys, ts], "left_semi")


def refresh(
    source: DataFrame, path: str, keys: Sequence[str], ts: str, max_age: timedelta, now: datetime, incremental: bool = True
) -> str:
    """Bring one derived table up to date; returns what was done.

    Fresh enough: nothing.  Stale: rows between the table's newest event and ``now`` are upserted.  No table,
    or not an incremental one: rebuilt.
    """
    spark = source.sparkSession
    newest = keyed.read(spark, path).agg(F.max(ts)).first()[0] if keyed.is_table(spark, path) else None
    if newest is not None and now - newest < max_age:
        return "skipped"
    if newest is not None and incremental:
        changed = source.where((F.col(ts) >= F.lit(newest)) & (F.col(ts) <= F.lit(now)))
        keyed.upsert(changed, path, keys)
        return "upserted"
    keyed.overwrite(source, path, keys)
    return "overwritten"


def flag_most_recent(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = (), out: str = "is_most_recent"
) -> DataFrame:
    """Mark the newest row of each group; without ``tie`` every row of the newest instant is marked."""
    order = F.struct(ts, *tie)
    return with_totals(df, keys, __max=F.max(order)).withColumn(out, order == F.col("__max")).drop("__max")


def version_outputs(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str]) -> DataFrame:
    """Number the outputs of a key in time order and mark the newest."""
    numbered = row_numbers(df, keys, [ts, *tie], "version")
    flagged = flag_most_recent(numbered, keys, ts, tie, "__newest")
    return flagged.withColumn("is_most_recent", F.col("__newest").cast("int")).drop("__newest")


def supersede(target: DataFrame, new: DataFrame, keys: Sequence[str], flag: str = "is_latest") -> DataFrame:
    """Target with a batch appended as latest and older rows of the same keys switched off."""
    touched = new.select(*keys).distinct().withColumn("__hit", F.lit(True))
    old = target.join(touched, list(keys), "left")
    old = old.withColumn(flag, F.col(flag) & F.col("__hit").isNull()).select(*target.columns)
    return old.unionByName(new.withColumn(flag, F.lit(True)), allowMissingColumns=True)
