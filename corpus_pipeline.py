"""Corpus pipeline: from raw documents to token ids.

Each stage takes the documents that its predecessor kept, as written, and returns the same columns; the last one returns
the digests of the encoded texts.

* language: documents without a recognised language go (no letter at all, or a probability at the level of chance);
* copies: of each group of similar documents the one with the smallest id stays;
* benchmark: documents that hold a benchmark item, also a re-parameterised one, go;
* secrets: found secrets are replaced by a mark in the text, all documents stay;
* bpe: the texts are encoded and decoded.

Documents with a NULL id cannot be named by a group and pass the second stage; repeated rows leave one there.  Empty and
NULL texts go in the first stage.  Empty tables pass through.  Further columns of the documents are kept as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, decontaminate, jaccard, language_id, secrets
from larder.llm.common import corpus, stored

# A document stays if its language is at least this much likelier than by chance.
OVER_CHANCE = 1.05
SECRET = "[SECRET]"
_ROW = "__row"


def _rows(docs: DataFrame) -> DataFrame:
    """Id, text and the whole row as one column, so no other column can clash."""
    return docs.select("doc_id", "text", F.struct(*[F.col(c) for c in docs.columns]).alias(_ROW))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(language_id.training_rows(docs))
    found = language_id.identify(_rows(docs), model, keep=[_ROW])
    least = OVER_CHANCE / len(model.languages) if len(model.languages) > 1 else 0.0
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least)).select(f"{_ROW}.*")


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = stored(jaccard.similar_components(docs), "pipeline-groups")
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(stay.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_rows(docs), corpus(spark, sf_dir, "benchmark"), keep=[_ROW])
    return found.where(F.size("items") == 0).select(f"{_ROW}.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_rows(docs), secrets.train(docs), redact=SECRET, keep=[_ROW])
    changed = F.size("spans") > 0
    new = {"text": F.when(changed, F.col("cleaned")).otherwise(F.col(f"{_ROW}.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("cleaned").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(f"{_ROW}.n_chars"))
    return found.select(*[new.get(c, F.col(f"{_ROW}.{c}")).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(bpe.WORD_BPE))


STAGES = [("language", language), ("copies", copies), ("benchmark", benchmark), ("secrets", secret_scan), ("bpe", encode)]

# Models and an iterative join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each on the written result of the one before."""
    docs = corpus(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
