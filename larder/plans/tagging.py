"""Keyword tags and text models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, PCA, CountVectorizer, IndexToString, Normalizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.keys import hashed_uniform
from larder.operators.scoring import partial_ratio
from larder.operators.topk import top_labels


def _keywords(mapping: Mapping[str, Sequence[str]]) -> Column:
    """The keyword list of a job as one literal array of (keyword, tag)."""
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(tag).alias("tag")) for tag, ks in mapping.items() for k in ks])


def _tag(tokens: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """Tags of rows from tags of words: words are matched once, however many rows hold them."""
    return tokens.join(vocabulary.select("token", "tag").distinct(), "token").select(key, "tag").distinct()


def _listed(tokens: DataFrame, key: str, mapping: Mapping[str, Sequence[str]], fits) -> DataFrame:
    """Tags of the job's fixed keywords that fit the tokens.

    Callers leave only tokens that fit some keyword: Spark takes such a filter below the distinct of the tokens, so the
    words of the rows are not shuffled.
    """
    hits = F.filter(_keywords(mapping), lambda k: fits(F.col("token"), k["keyword"]))
    return tokens.select(key, F.explode(hits).alias("k")).select(key, "k.tag").distinct()


def exact_tags(tokens: DataFrame, key: str, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Tags whose keyword is a token of the row.  ``tokens``: key, token (distinct)."""
    known = tokens.where(F.col("token").isin(sorted({k for ks in mapping.values() for k in ks})))
    return _listed(known, key, mapping, lambda token, keyword: token == keyword)


def substring_tags(tokens: DataFrame, key: str, mapping: Mapping[str, Sequence[str]], penalties: Sequence[str]) -> DataFrame:
    """Tags whose keyword is part of a token that holds none of the penalty words."""
    words = tokens
    for p in penalties:
        words = words.where(~F.col("token").contains(p))
    part = F.lit(False)
    for k in sorted({k for ks in mapping.values() for k in ks}):
        part = part | F.col("token").contains(k)
    return _listed(words.where(part), key, mapping, lambda token, keyword: token.contains(keyword))


def fuzzy_tags(
    tokens: DataFrame, key: str, mapping: Mapping[str, Sequence[str]], threshold: float,
    penalty_pairs: Sequence[tuple[str, str]] = (), penalty: float = 0.0,
) -> DataFrame:
    """Tags of the exact keyword, else of every keyword that resembles the token; some pairs lose points.

    Similarity is computed once per distinct token and keyword of the job's fixed list.
    """
    known = [k for ks in mapping.values() for k in ks]
    words = tokens.select("token").distinct()
    pairs = words.select("token", F.explode(_keywords(mapping)).alias("k")).select("token", "k.keyword", "k.tag")
    exact = pairs.where(F.col("token") == F.col("keyword"))
    rest = pairs.where(~F.col("token").isin(known))
    # No stretch can share more characters than the shorter text has in common with the longer one.
    token_first = F.length("token") <= F.length("keyword")
    short, long = F.when(token_first, F.col("token")).otherwise(F.col("keyword")), F.when(token_first, F.col("keyword")).otherwise(F.col("token"))
    rest = rest.withColumns({"__short": short, "__long": long})
    m, shared = F.length("__short"), F.length("__short") - F.length(F.expr("translate(__short, __long, '')"))
    rest = rest.where((m == 0) | (200 * shared > threshold * (m + shared))).drop("__short", "__long")
    score = partial_ratio("token", "keyword")
    bad = F.lit(False)
    for a, b in penalty_pairs:
        bad = bad | ((F.col("token") == a) & (F.col("keyword") == b)) | ((F.col("token") == b) & (F.col("keyword") == a))
    close = rest.withColumn("score", score - F.when(bad, penalty).otherwise(0.0)).where(F.col("score") > threshold)
    return _tag(tokens, exact.select("token", "tag").unionByName(close.select("token", "tag")), key)


def missing_tags(tokens: DataFrame, keys: DataFrame, key: str, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Tags of preferences that a row does not break: none of the tag's keywords is among its tokens."""
    every = keys.select(key, F.explode(F.array(*[F.lit(t) for t in mapping])).alias("tag"))
    return every.join(exact_tags(tokens, key, mapping), [key, "tag"], "left_anti")


def train_text_classifier(df: DataFrame, tokens: str, label: str, vocabulary: int = 1 << 18, reg: float = 0.01) -> PipelineModel:
    """TF-IDF over the counted vocabulary (its most frequent words, if it has more) and multinomial logistic regression.

    Every label weighs as much as any other, however many rows it has.
    """
    sizes = df.groupBy(F.col(label).alias("__l")).agg((1.0 / F.count("*")).alias("__w"))
    per_label = df.count() / max(1, sizes.count())
    weighted = df.join(sizes, F.col(label).eqNullSafe(F.col("__l"))).withColumn("__w", F.col("__w") * per_label)
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc", handleInvalid="keep"),
            CountVectorizer(inputCol=tokens, outputCol="__tf", vocabSize=vocabulary),
            IDF(inputCol="__tf", outputCol="__x"),
            LogisticRegression(featuresCol="__x", labelCol="__y", regParam=reg, maxIter=30, weightCol="__w", probabilityCol="__p"),
        ]
    ).fit(weighted)


def predict_labels(model: PipelineModel, df: DataFrame, keep: Sequence[str], threshold: float, k: int = 3) -> DataFrame:
    """Best k labels above a threshold, best first, as (score, label) structs."""
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    scored = model.transform(df).select(*keep, vector_to_array("__p").alias("__s"))
    pairs = F.zip_with("__s", names, lambda s, n: F.struct(s.alias("score"), n.alias("label")))
    return scored.select(*keep, top_labels(F.filter(pairs, lambda p: p["label"].isNotNull()), threshold, k).alias("labels"))


def stratified_sample(df: DataFrame, key: str, label: str, fraction: float, seed: int = 10) -> DataFrame:
    """The same share of every label, chosen by a hash of the key."""
    return df.where(F.col(label).isNotNull() & (hashed_uniform(key, label, seed=seed) < fraction))


def train_scores(df: DataFrame, features: Sequence[str], label: str, trees: int = 20, seed: int = 10) -> PipelineModel:
    """Random forest over numeric features, duplicates removed first."""
    rows = df.select(*features, label).dropna(subset=[label]).dropDuplicates()
    indexer = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").fit(rows)
    return Pipeline(
        stages=[
            indexer,
            VectorAssembler(inputCols=list(features), outputCol="__x", handleInvalid="keep"),
            RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=trees, seed=seed, probabilityCol="__p"),
            IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels),
        ]
    ).fit(rows)


def score_items(model: PipelineModel, df: DataFrame, keep: Sequence[str], label: str) -> DataFrame:
    """Score of the last label (the positive one of two) per row."""
    p = model.transform(df.withColumn(label, F.lit(model.stages[0].labels[0]))).select(*keep, vector_to_array("__p").alias("p"))
    return p.select(*keep, F.element_at("p", -1).alias("score"))


def cluster_items(df: DataFrame, key: str, vec: str, k: int = 4, dims: int = 2, seed: int = 0) -> DataFrame:
    """Clusters of cosine-normalised vectors in the plane of their first principal components."""
    x = df.select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("__v"))
    model = Pipeline(
        stages=[
            Normalizer(inputCol="__v", outputCol="__n"),
            PCA(k=dims, inputCol="__n", outputCol="__x"),
            KMeans(k=k, seed=seed, featuresCol="__x", predictionCol="cluster", maxIter=300),
        ]
    ).fit(x)
    return model.transform(x).select(key, "cluster")


def classification_metrics(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """Recall, precision, F1 and accuracy of a yes/no prediction."""
    c = df.agg(
        F.count(F.when(actual & predicted, 1)).alias("tp"),
        F.count(F.when(~actual & predicted, 1)).alias("fp"),
        F.count(F.when(actual & ~predicted, 1)).alias("fn"),
        F.count("*").alias("n"),
    )
    tp, fp, fn, n = (F.col(x) for x in ("tp", "fp", "fn", "n"))
    return c.select(
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(n - fp - fn, n).alias("accuracy"),
    )
