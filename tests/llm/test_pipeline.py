"""The pipeline's stages, each against plain Python on its own input."""

import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_jaccard import plain
from test_models import plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from larder.llm.common import corpus

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_table(spark):
    docs = corpus(spark, FOLDER)
    items = [r.text for r in corpus(spark, FOLDER, "benchmark").collect()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, columns = docs.collect(), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = spark.createDataFrame(before, docs.schema)
        rows = stage(spark, out, FOLDER).collect()
        ids = {r.doc_id for r in rows}
        if name == "language":
            assert ids >= {r.doc_id for r in before if r.text and len(r.text) > 200}
            assert ids <= {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
        elif name == "copies":
            assert ids == {c for _, c in plain([(r.doc_id, r.text) for r in before]).values()}
        elif name == "benchmark":
            assert not [r for r in rows if any(i in r.text for i in items)]
            assert len(ids) > 0.9 * len(before)
        elif name == "secrets":
            assert ids == {r.doc_id for r in before}
            assert not [r for r in rows if plain_spans(r.text)]
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in before}
            got = {r.doc_id: r.ids_sha256 for r in rows}
            assert got == {d: hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() for d, i in want.items()}
        if name != "bpe":
            assert list(rows[0].asDict()) == columns
            before = rows
    assert corpus_pipeline.run(spark, FOLDER).count() == len(before)


def test_edges(spark):
    text = "the house and the dog went over the hill"
    data = [(1, text, "en", "a"), (1, text, "en", "b"), (2, None, None, "c"), (None, text + " again", "en", "d"), (3, "..", "en", "e")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score string").withColumn("items", F.lit(1))
    for frame in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = spark.createDataFrame(stage(spark, frame, FOLDER).collect(), stage(spark, frame, FOLDER).schema)
            if name == "copies":
                assert frame.count() in (0, 2)
