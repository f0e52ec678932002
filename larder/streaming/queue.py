"""Queue-style jobs as Structured Streaming.

A topic is a stream of JSON messages.  The checkpoint takes the place of
settling messages, and every micro-batch writes into its own ``batch_id``
partition, so replaying a batch replaces its rows instead of adding them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Batch = Callable[[DataFrame], DataFrame]


def messages(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Text messages arriving as files; on a cluster any source with a string ``value`` (a topic) does."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def parse(stream: DataFrame, schema: StructType | str) -> DataFrame:
    """Messages as (``value``, typed ``request``); malformed ones have ``error_code`` 400."""
    parsed = stream.withColumn("request", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    looks_json = F.try_parse_json("value").isNotNull()
    return parsed.withColumn("error_code", F.when(~looks_json | F.col("request").isNull(), F.lit(400)))


def split_bad(df: DataFrame, code: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows with an ``error_code``)."""
    coded = df.withColumn("error_code", code)
    return coded.where("error_code is null").drop("error_code"), coded.where("error_code is not null")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace one batch's partition of a table."""
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_id").parquet(path)


def _start(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(stream: DataFrame, fn: Batch, ok: str, bad: str, checkpoint: str) -> StreamingQuery:
    """Process parsed messages; results go to ``ok``, failures with code and payload to the dead letters.

    ``fn`` maps a batch of ``request`` rows to result columns plus ``error_code`` (NULL for success).
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        done = fn(batch).persist(StorageLevel.MEMORY_AND_DISK)
        good, failed = split_bad(done, F.col("error_code"))
        write_batch(good.drop("value", "request"), ok, batch_id)
        write_batch(failed.select("error_code", "value"), bad, batch_id)
        done.unpersist()

    return _start(stream, checkpoint, handle)


def drain(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Move what has arrived so far into a table, then stop."""
    return _start(stream, checkpoint, lambda batch, batch_id: write_batch(batch, table, batch_id))


def drain_dead_letters(spark: SparkSession, bad: str, schema: StructType | str, fn: Batch) -> DataFrame:
    """Process stored failures again, as a batch."""
    return fn(parse(spark.read.parquet(bad).select("value"), schema))


def stream_static_join(
    stream: DataFrame, load: Callable[[], DataFrame], on: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Join each micro-batch with a static side that is read anew for it."""
    return _start(
        stream, checkpoint, lambda batch, batch_id: write_batch(batch.join(load(), on, "left"), table, batch_id)
    )


def map_ids(
    df: DataFrame,
    ids: str,
    mapping: Mapping[str, Sequence[str]],
    default: str,
    implied: Mapping[str, Sequence[str]] | None = None,
    preferences: str | None = None,
) -> DataFrame:
    """Concept ids to attribute ids.

    Ids are compared in upper case.  No ids at all: the default attribute.  No id that maps: those that already are
    attribute ids; an empty result then means an unknown request.  Concepts may imply further preferences.
    """
    as_map = lambda m: F.create_map(
        *[x for k, v in m.items() for x in (F.lit(k.upper()), F.array(*[F.lit(i.upper()) for i in v]))]
    )
    given = F.transform(F.coalesce(ids, F.array().cast("array<string>")), lambda x: F.upper(x))
    lookup = lambda m: F.flatten(F.array_compact(F.transform(given, lambda x: F.try_element_at(as_map(m), x))))
    mapped = F.array_sort(F.array_distinct(lookup(mapping)))
    known = F.array(*[F.lit(i) for i in sorted({i.upper() for v in mapping.values() for i in v})])
    already = F.array_sort(F.array_intersect(given, known))
    result = F.when(F.size(given) == 0, F.array(F.lit(default.upper()))).when(F.size(mapped) > 0, mapped).otherwise(already)
    out = df
    if implied and preferences:
        prefs = F.transform(F.coalesce(preferences, F.array().cast("array<string>")), lambda x: F.upper(x))
        out = out.withColumn("__prefs", F.array_sort(F.array_union(prefs, lookup(implied))))
    out = out.withColumn(ids, result)
    return out.withColumn(preferences, F.col("__prefs")).drop("__prefs") if implied and preferences else out


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First message per key; keys are remembered for ``delay`` of event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet table with the file sink's exactly-once log."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def route(stream: DataFrame, key: str, path: str, checkpoint: str) -> StreamingQuery:
    """Partition a stream's rows by a routing key; a reader of one route prunes to its partition."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(key, "batch_id").parquet(path)

    return _start(stream, checkpoint, handle)


def publish(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write rows as JSON messages, a file for each partition or a stated number of files."""
    messages = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    (messages.repartition(files) if files else messages).write.mode("append").text(path)
