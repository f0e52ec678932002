"""Sinks, exports and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from larder.operators import incremental as I
from larder.session import shared_dir
from larder.sources import sinks
from larder.streaming import queue as Q


def test_upsert(spark, rows):
    path = shared_dir(spark, "upsert")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B", 1), (3, "C", 2)], "k int, v string, extra int")
    sinks.upsert(a, path, ["k"])
    for _ in range(2):  # The same batch twice gives the same table.
        sinks.upsert(b, path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v", "extra") == [(1, "a", None), (2, "B", 1), (3, "C", 2)]
    with pytest.raises(ValueError):
        sinks.upsert(b.unionByName(b), path, ["k"])


def test_partitioned_upsert_leaves_other_partitions_alone(spark, rows):
    path = shared_dir(spark, "upsert-parts")
    sinks.upsert(spark.createDataFrame([("x", 1, 1), ("y", 1, 1)], "p string, k int, v int"), path, ["p", "k"], ["p"])
    before = {r[0] for r in spark.read.parquet(path).where("p = 'y'").select(F.input_file_name()).collect()}
    sinks.upsert(spark.createDataFrame([("x", 1, 5), ("x", 2, 6)], "p string, k int, v int"), path, ["p", "k"], ["p"])
    after = {r[0] for r in spark.read.parquet(path).where("p = 'y'").select(F.input_file_name()).collect()}
    assert before == after
    assert rows(spark.read.parquet(path), "p", "k", "v") == [("x", 1, 5), ("x", 2, 6), ("y", 1, 1)]
    with pytest.raises(ValueError):
        sinks.upsert(spark.createDataFrame([("x", 1, 5)], "p string, k int, v int"), path, ["k"], ["p"])


def test_two_batches_equal_one_run(spark, rows):
    one = spark.createDataFrame([(i, i % 3) for i in range(20)], "k int, v int")
    merged = I.merge_incremental(one.where("k < 12"), one.where("k >= 8"), ["k"])
    assert rows(merged) == rows(one)


SCHEMA = "id int, v double"


def _score(df):
    return df.select("value", "request", F.col("request.id").alias("id"), (F.col("request.v") * 2).alias("s"), "error_code")


def test_stream_dead_letters_and_replay(spark, rows):
    base = shared_dir(spark, "stream")
    msgs = ['{"id": 1, "v": 0.5}', "not json", '{"id": 2, "v": 1.5}']
    spark.createDataFrame([(m,) for m in msgs], "value string").repartition(1).write.text(f"{base}/in")
    stream = Q.parse(Q.messages(spark, f"{base}/in"), SCHEMA)
    Q.score_stream(stream, _score, f"{base}/ok", f"{base}/bad", f"{base}/cp").awaitTermination()
    assert rows(spark.read.parquet(f"{base}/ok"), "id", "s") == [(1, 1.0), (2, 3.0)]
    assert rows(spark.read.parquet(f"{base}/bad"), "error_code", "value") == [(400, "not json")]
    # The same batch written again, as after a lost acknowledgement, replaces its rows.
    Q.write_batch(spark.createDataFrame([(9, 9.0)], "id int, s double"), f"{base}/ok", 0)
    assert rows(spark.read.parquet(f"{base}/ok"), "id") == [(9,)]


def test_map_ids_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, ["c1"]), (3, ["A2"]), (4, ["zz"]), (5, ["C1", "c2"])], "k int, ids array<string>")
    got = {r.k: r.ids for r in Q.map_ids(df, "ids", {"c1": ["a1"], "C2": ["a2", "a1"]}, "a0").collect()}
    assert got == {1: ["A0"], 2: ["A1"], 3: ["A2"], 4: [], 5: ["A1", "A2"]}
