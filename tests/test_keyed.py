"""Keyed tables: what an upsert reads, what a failure leaves, and what readers see."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from larder.session import shared_dir
from larder.sources import keyed


def bucket_of(spark, key, n):
    return str(spark.range(1).select(F.pmod(F.xxhash64(F.lit(key).cast("long")), F.lit(n))).first()[0])


@pytest.fixture
def table(spark):
    path = shared_dir(spark, "keyed")
    keyed.upsert(spark.range(1000).select("id", (F.col("id") * 2).alias("v")), path, ["id"], buckets=50)
    return path


def test_only_touched_buckets_are_read_and_written(spark, table):
    before = keyed.current(spark, table)
    mine = bucket_of(spark, 7, 50)
    # Files of all other buckets become unreadable: the upsert does not see them.
    spoiled = [f for f in glob.glob(f"{table}/data/*/key_bucket=*/*.parquet") if f"key_bucket={mine}/" not in f]
    whole = {f: open(f, "rb").read() for f in spoiled}
    for f in spoiled:
        with open(f, "wb") as out:
            out.write(b"spoiled")
    assert keyed.upsert(spark.createDataFrame([(7, -1)], "id long, v long"), table, ["id"]) == [mine]
    for f, raw in whole.items():
        with open(f, "wb") as out:
            out.write(raw)
    after = keyed.current(spark, table)
    assert {b for b in after["buckets"] if after["buckets"][b] != before["buckets"][b]} == {mine}
    assert len(spoiled) >= 0.95 * len(keyed.read(spark, table).inputFiles())
    got = {r.id: r.v for r in keyed.read(spark, table).collect()}
    assert got == {i: -1 if i == 7 else 2 * i for i in range(1000)}


def test_new_rows_columns_and_the_same_batch_twice(spark, table):
    batch = spark.createDataFrame([(5, 50, "x"), (2000, 1, "y")], "id long, v long, extra string")
    for _ in range(2):
        keyed.upsert(batch, table, ["id"])
    got = keyed.read(spark, table)
    assert got.columns == ["id", "v", "extra"] and got.count() == 1001
    assert {tuple(r) for r in got.where("id in (4, 5, 2000)").collect()} == {(4, 8, None), (5, 50, "x"), (2000, 1, "y")}
    keyed.upsert(spark.createDataFrame([(6,)], "id long"), table, ["id"])
    assert tuple(keyed.read(spark, table).where("id = 6").first()) == (6, None, None)


@pytest.mark.parametrize("step", ["_publish", "merged"])
def test_a_failure_leaves_the_old_state(spark, table, monkeypatch, step):
    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(keyed, step, fail)
    with pytest.raises(OSError):
        keyed.upsert(spark.createDataFrame([(1, 0)], "id long, v long"), table, ["id"])
    monkeypatch.undo()
    assert keyed.read(spark, table).agg(F.sum("v")).first()[0] == sum(2 * i for i in range(1000))
    assert not glob.glob(f"{table}/data/*-batch")
    keyed.upsert(spark.createDataFrame([(1, 0)], "id long, v long"), table, ["id"])
    assert keyed.read(spark, table).where("id = 1").first().v == 0


def test_a_second_writer_of_one_state_fails(spark, table):
    state = keyed.current(spark, table)
    keyed.upsert(spark.createDataFrame([(1, 0)], "id long, v long"), table, ["id"])
    with pytest.raises(OSError):
        keyed._publish(spark, table, state | {"version": state["version"] + 1})
    assert keyed.read(spark, table).where("id = 1").first().v == 0


def test_errors_nulls_and_empty(spark, table):
    with pytest.raises(ValueError):
        keyed.upsert(spark.createDataFrame([(1, 0), (1, 1)], "id long, v long"), table, ["id"])
    with pytest.raises(ValueError):
        keyed.upsert(spark.createDataFrame([(1, 0)], "id long, v long"), table, ["v"])
    with pytest.raises(FileNotFoundError):
        keyed.read(spark, table + "-none")
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "id long, v long")
    keyed.upsert(nulls, table, ["id"])
    assert keyed.read(spark, table).where("id is null").count() == 2
    assert keyed.upsert(nulls.limit(0), table, ["id"]) == []
    path = shared_dir(spark, "keyed-empty")
    keyed.upsert(nulls.limit(0), path, ["id"])
    assert keyed.read(spark, path).collect() == [] and keyed.is_table(spark, path)


def test_readers_keep_their_state_until_vacuum(spark, table):
    old = keyed.read(spark, table)
    for v in (1, 2, 3):
        keyed.upsert(spark.range(1000).select("id", F.lit(v).cast("long").alias("v")), table, ["id"])
    assert old.agg(F.sum("v")).first()[0] == 999000
    assert len(keyed.vacuum(spark, table, keep=2)) == 2 and keyed.vacuum(spark, table, keep=2) == []
    assert keyed.read(spark, table).agg(F.sum("v")).first()[0] == 3000
    keyed.overwrite(keyed.read(spark, table), table, ["id"], buckets=3)
    assert keyed.current(spark, table)["n_buckets"] == 3 and keyed.read(spark, table).count() == 1000
