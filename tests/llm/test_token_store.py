"""Token-id files and their index against the library and a plain dictionary."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm import token_store as ts

PATH = public_tokenizers.path(ts.BYTE_BPE)
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\xa0aB'st1.é日<|>", max_size=30), max_size=4))
def test_units_give_the_ids_of_whole_texts(texts):
    code = ts.encoder(PATH)
    assert [np.frombuffer(c, code.dtype).tolist() for c in code.encode(texts)] == [
        LIBRARY.encode(t, add_special_tokens=False).ids for t in texts
    ]


@pytest.mark.parametrize("n", [1, 2, 1000, 30_000])
def test_perfect_hash_is_minimal_and_rejects_strangers(n):
    hashes = ts._hash(np.arange(n) * 7 - 3)
    table = ts.PerfectHash.build(hashes)
    assert sorted(table.slots(hashes).tolist()) == list(range(n))
    assert ts.PerfectHash.build(hashes[:0]).slots(hashes).tolist() == [-1] * n


def expect(docs):
    rows = sorted(((d.doc_id is not None, d.doc_id or 0), d.text or "") for d in docs)
    at, out = 0, []
    for (named, key), text in rows:
        ids = [*LIBRARY.encode(text, add_special_tokens=False).ids, ts.END]
        out.append((key if named else None, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_whole_table(spark):
    got = ts.op9_token_store(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert sorted(tuple(r) for r in got) == sorted(expect(docs))


def test_nulls_repeats_and_strangers(spark, tmp_path):
    data = [(5, "b  c", 1), (5, "b  c", 2), (None, "x", 3), (-7, None, 4), (9, "", 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, key int").repartition(3)
    folder = f"{tmp_path}/files"
    rows = spark.createDataFrame(ts.write_shards(df, folder, PATH).toPandas())
    buckets = ts.write_index(rows, folder, keys_per_bucket=2)
    asked = spark.createDataFrame([(5,), (-7,), (9,), (12345,)], "doc_id long")
    found = ts.lookup(asked, folder, buckets)
    assert {r.key: r["count"] for r in found.collect()} == {5: 2, -7: 1, 9: 1}
    back = ts.read_documents(found.withColumn("unnamed", F.lit(False)), folder)
    assert sorted((r.key, len(r.ids) // 4) for r in back.collect()) == [(-7, 1), (5, 4), (5, 4), (9, 1)]


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert ts.op9_token_store(spark, str(tmp_path)).count() == 0
