"""Keyed tables: rows dealt by a hash of their key into bucket folders, with a manifest that names the current ones.

Layout below the table's path::

    data/<generation>/key_bucket=<b>/...parquet    rows of a bucket, written once and never changed
    manifest/<version>.json                        key, schema, number of buckets, and the generation of each bucket

An upsert writes its batch once, reads only the buckets that the batch touches, writes these as a new generation and then
publishes a manifest.  The manifest is written under another name and renamed, so a table has one state or the next;
what fails before that leaves the table as it was.  A version that exists already is an error: of two writers that
started from one state the second must start again.

Folders of older generations stay for readers of the last manifests until :func:`vacuum`.  The cost of an upsert follows
the touched buckets; batches of scattered keys touch many, so the number of buckets should follow the table's size (some
hundred MB each).  Columns that a batch adds are NULL in older files: files are read with the manifest's schema.

NULL keys match nothing, as in SQL: such rows are only ever added.  A batch that repeats a key is an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.sources.sinks import _fs, exists, merged

BUCKETS = 64
_BUCKET = "key_bucket"


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, path: str, version: int) -> dict:
    fs, file = _fs(spark, f"{path}/manifest/{version:012d}.json")
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest, or None where there is no table."""
    versions = _versions(spark, path)
    return _manifest(spark, path, versions[-1]) if versions else None


def _publish(spark: SparkSession, path: str, state: dict) -> None:
    fs, draft = _fs(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    _, final = _fs(spark, f"{path}/manifest/{state['version']:012d}.json")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(state).encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise OSError(f"another writer published version {state['version']} of {path}")


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _write(df: DataFrame, folder: str) -> dict[str, int]:
    """Write rows by bucket; the buckets that hold rows, as text, with their rows."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(parts, _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    return {str(r[_BUCKET]): r["count"] for r in written.groupBy(_BUCKET).count().collect()}


def _folders(path: str, state: dict, only: Sequence[str] | None = None) -> list[str]:
    chosen = state["buckets"] if only is None else {b: state["buckets"][b] for b in only if b in state["buckets"]}
    return [f"{path}/data/{generation}/{_BUCKET}={b}" for b, generation in sorted(chosen.items())]


def _load(spark: SparkSession, path: str, state: dict, only: Sequence[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(state["schema"])
    folders = _folders(path, state, only)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its newest manifest; a plan made from it is not affected by later upserts."""
    state = current(spark, path)
    if state is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    return _load(spark, path, state)


def overwrite(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """A new state that holds these rows only; also the way to another key or number of buckets."""
    spark = df.sparkSession
    generation = uuid.uuid4().hex
    held = _write(_bucketed(df, keys, buckets), f"{path}/data/{generation}")
    versions = _versions(spark, path)
    state = {"version": (versions[-1] if versions else 0) + 1, "keys": list(keys), "n_buckets": buckets}
    _publish(spark, path, state | {"schema": df.schema.jsonValue(), "buckets": {b: generation for b in held}})


def upsert(source: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> list[str]:
    """Replace matched rows, insert the others, create the table when absent; returns the touched buckets."""
    spark = source.sparkSession
    state = current(spark, path)
    if state is not None and state["keys"] != list(keys):
        raise ValueError(f"the table's key is {state['keys']}, not {list(keys)}")
    number = state["n_buckets"] if state else buckets
    generation = uuid.uuid4().hex
    batch_folder = f"{path}/data/{generation}-batch"
    touched = _write(_bucketed(source, keys, number), batch_folder)
    folders = [f"{batch_folder}/{_BUCKET}={b}" for b in sorted(touched)]
    batch = spark.read.schema(source.schema).parquet(*folders) if folders else spark.createDataFrame([], source.schema)
    try:
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        if not batch.where(known).groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError(f"upsert source has repeated keys on {list(keys)}")
        if state is None:
            state = {"version": 0, "keys": list(keys), "n_buckets": number, "schema": source.schema.jsonValue(), "buckets": {}}
        rows = merged(_load(spark, path, state, list(touched)), batch, keys)
        held = _write(_bucketed(rows, keys, number), f"{path}/data/{generation}")
        kept = {b: g for b, g in state["buckets"].items() if b not in touched}
        new = {"version": state["version"] + 1, "schema": rows.schema.jsonValue(), "buckets": kept | {b: generation for b in held}}
        _publish(spark, path, state | new)
    finally:
        fs, folder = _fs(spark, batch_folder)
        fs.delete(folder, True)
    return sorted(touched, key=int)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete generations that none of the last ``keep`` manifests names, and older manifests; returns the generations."""
    versions = _versions(spark, path)
    used = {g for v in versions[-keep:] for g in _manifest(spark, path, v)["buckets"].values()}
    fs, data = _fs(spark, f"{path}/data")
    # A manifest goes before the files that it names.
    for v in versions[:-keep]:
        fs.delete(_fs(spark, f"{path}/manifest/{v:012d}.json")[1], False)
    gone = [f.getPath().getName() for f in fs.listStatus(data) if f.getPath().getName() not in used]
    for g in gone:
        fs.delete(_fs(spark, f"{path}/data/{g}")[1], True)
    return gone


def is_table(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/manifest") and bool(_versions(spark, path))


def save_feature_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Feature-table merge: full duplicates are dropped, a key with two different rows is an error."""
    upsert(df.dropDuplicates(), path, keys, buckets)
