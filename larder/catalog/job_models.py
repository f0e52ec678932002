"""Jobs: tagging, text models, experiments."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.registry import Tables, query
from larder.functions.text import clean_tokens
from larder.operators.incremental import supersede
from larder.plans import experiments as X
from larder.plans import tagging as G


def tokens(t: Tables):
    return t.documents.select("doc_id", F.explode(clean_tokens("text")).alias("token")).distinct()


TOKENS = """tk AS (SELECT DISTINCT doc_id, unnest(string_split(trim(regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g')), ' ')) AS token
  FROM documents)"""


@query(
    "job_38",
    f"""WITH {TOKENS} SELECT DISTINCT doc_id, tag FROM tk JOIN (VALUES ('the', 'english'), ('and', 'english'), ('der', 'german'), ('und', 'german'),
    ('les', 'french'), ('una', 'spanish')) k(keyword, tag) ON token = keyword
    UNION SELECT doc_id, tag FROM tk JOIN (VALUES ('tion', 'latin'), ('sch', 'germanic')) k(keyword, tag) ON contains(token, keyword)
    WHERE NOT contains(token, 'en') AND NOT contains(token, 'ou')
    UNION SELECT doc_id, 'calm' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM tk WHERE token IN ('not', 'nicht', 'pas'))""",
)
def job_38(t: Tables):
    tk = tokens(t)
    exact = G.exact_tags(tk, "doc_id", {"english": ["the", "and"], "german": ["der", "und"], "french": ["les"], "spanish": ["una"]})
    part = G.substring_tags(tk, "doc_id", {"latin": ["tion"], "germanic": ["sch"]}, ["en", "ou"])
    calm = G.missing_tags(tk, t.documents, "doc_id", {"calm": ["not", "nicht", "pas"]})
    return exact.unionByName(part).unionByName(calm).distinct()


@query("job_38_fuzzy")
def job_38_fuzzy(t: Tables):
    mapping = {"national": ["nation"], "stressed": ["therone"]}
    return G.fuzzy_tags(tokens(t), "doc_id", mapping, 85.0, [("nationer", "nation")], 20.0)


@query(
    "job_39",
    """SELECT lang, count(*) AS n_docs, count(*) FILTER (doc_id % 4 = 1) AS n_held_out, true AS mostly_right, true AS held_out_right
    FROM documents GROUP BY lang""",
)
def job_39(t: Tables):
    """Three quarters of the documents train, all are predicted: the best label must be right for four fifths of a language.

    The same mark holds for the documents that were held out, so it is not met by learning the others by heart.
    """
    out = _predicted(t)
    return out.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.count_if("held").alias("n_held_out"),
        (F.avg("right") >= 0.8).alias("mostly_right"),
        F.coalesce(F.avg(F.when(F.col("held"), F.col("right"))) >= 0.8, F.lit(True)).alias("held_out_right"),
    )


def _predicted(t: Tables):
    """Every document's language, whether it was held out, and whether its best label is right (1 or 0)."""
    docs = t.documents.select("doc_id", "lang", clean_tokens("text").alias("tokens"))
    held = F.coalesce(F.expr("doc_id % 4 = 1"), F.lit(False))
    model = G.train_text_classifier(docs.where(~held), "tokens", "lang")
    out = G.predict_labels(model, docs, ["doc_id", "lang"], 0.2)
    right = F.coalesce((F.get("labels", F.lit(0))["label"] == F.col("lang")).cast("int"), F.lit(0))
    return out.select("lang", held.alias("held"), right.alias("right"))


@query("job_39_labels")
def job_39_labels(t: Tables):
    """Predictions of the same model for every document: documents of a language and right labels, held-out ones beside."""
    held, right = F.col("held"), F.col("right")
    return _predicted(t).groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.sum(right).alias("n_right"),
        F.count_if(held).alias("n_held_out"),
        F.avg(F.when(held, right)).alias("held_out_accuracy"),
    )


@query(
    "job_40_sample",
    """SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL
    AND ('0x' || substr(md5(doc_id || '-' || quality || '-10'), 1, 8))::BIGINT / 4294967296.0 < 0.6""",
)
def job_40_sample(t: Tables):
    return G.stratified_sample(t.labels, "doc_id", "quality", 0.6).select("doc_id", "quality")


@query("job_40")
def job_40(t: Tables):
    text = F.col("text")
    feats = t.documents.select(
        "doc_id",
        F.length(text).cast("double").alias("n_chars"),
        F.size(F.split(text, " ")).cast("double").alias("n_words"),
        F.size(F.array_distinct(F.split(text, " "))).cast("double").alias("n_distinct"),
        F.regexp_count(text, F.lit(r"[^\p{L}\s]")).cast("double").alias("n_marks"),
    )
    cols = ["n_chars", "n_words", "n_distinct", "n_marks"]
    labelled = G.stratified_sample(t.labels, "doc_id", "quality", 0.6).join(feats, "doc_id")
    labelled = labelled.withColumn("quality", F.col("quality").cast("string"))
    model = G.train_scores(labelled, cols, "quality")
    new = G.score_items(model, feats, ["doc_id"], "quality")
    old = t.documents.select("doc_id", F.lit(0.5).alias("score"), F.lit(True).alias("is_latest"))
    return supersede(old, new, ["doc_id"])


@query(
    "job_40_states",
    "SELECT doc_id, 1::BIGINT AS n_old, 1::BIGINT AS n_latest, true AS in_range FROM documents",
)
def job_40_states(t: Tables):
    """Every document keeps its old score, switched off, and has one new score between 0 and 1."""
    latest = F.col("is_latest")
    return job_40(t).groupBy("doc_id").agg(
        F.count(F.when(~latest, 1)).alias("n_old"),
        F.count(F.when(latest, 1)).alias("n_latest"),
        F.bool_and(F.col("score").between(0, 1)).alias("in_range"),
    )


@query("job_41")
def job_41(t: Tables):
    return G.cluster_items(t.embeddings, "vec_id", "embedding", k=4)


@query("job_41_sizes", "SELECT 4::BIGINT AS n_clusters, count(*) AS n_items, count(DISTINCT vec_id) AS n_ids, true AS none_empty FROM embeddings")
def job_41_sizes(t: Tables):
    """Every item is in one of the clusters and none of them is empty."""
    sizes = job_41(t).groupBy("cluster").agg(F.count("*").alias("n"), F.count_distinct("vec_id").alias("ids"))
    return sizes.agg(
        F.count("*").alias("n_clusters"), F.sum("n").alias("n_items"), F.sum("ids").alias("n_ids"), (F.min("n") > 0).alias("none_empty")
    )


_AB = """m AS (SELECT count(*) FILTER (g) AS n_t, count(*) FILTER (NOT g) AS n_c, avg(v) FILTER (g) AS mean_t, avg(v) FILTER (NOT g) AS mean_c,
  var_samp(v) FILTER (g) AS v_t, var_samp(v) FILTER (NOT g) AS v_c FROM d),
p AS (SELECT *, ((n_t - 1) * v_t + (n_c - 1) * v_c) / (n_t + n_c - 2) AS pooled FROM m)"""


@query(
    "job_42",
    f"""WITH d AS (SELECT user_id % 2 = 0 AS g, value AS v FROM events), {_AB}
    SELECT n_t, n_c, round(mean_t, 8) AS mean_t, round(mean_c, 8) AS mean_c, true AS equal_var, round((mean_t - mean_c)
    / sqrt(pooled * (1.0 / n_t + 1.0 / n_c)), 6) AS t_statistic, CAST(n_t + n_c - 2 AS DOUBLE) AS df, round((mean_t - mean_c) / sqrt(pooled), 6)
    AS cohen_d, 'negligible' AS effect_size FROM p""",
)
def job_42(t: Tables):
    out = X.ab_test(t.events, F.col("user_id") % 2 == 0, "value")
    return out.select(
        "n_t", "n_c", F.round("mean_t", 8).alias("mean_t"), F.round("mean_c", 8).alias("mean_c"), "equal_var",
        F.round("t_statistic", 6).alias("t_statistic"), "df", F.round("cohen_d", 6).alias("cohen_d"), "effect_size",
    )


@query(
    "job_42_welch",
    f"""WITH d AS (SELECT user_id % 2 = 0 AS g, CASE WHEN user_id % 2 = 0 THEN value * 3 ELSE value END AS v FROM events), {_AB}
    SELECT round((mean_t - mean_c) / sqrt(v_t / n_t + v_c / n_c), 6) AS t_statistic, round(pow(v_t / n_t + v_c / n_c, 2)
    / (pow(v_t / n_t, 2) / (n_t - 1) + pow(v_c / n_c, 2) / (n_c - 1)), 4) AS df, false AS equal_var FROM p""",
)
def job_42_welch(t: Tables):
    test = F.col("user_id") % 2 == 0
    ev = t.events.withColumn("value", F.when(test, F.col("value") * 3).otherwise(F.col("value")))
    out = X.ab_test(ev, test, "value")
    return out.select(F.round("t_statistic", 6).alias("t_statistic"), F.round("df", 4).alias("df"), "equal_var")


@query(
    "job_42_ranks",
    """WITH d AS (SELECT user_id % 2 = 0 AS g, value AS v FROM events), c AS (SELECT v, count(*) AS n, count(*) FILTER (g) AS t FROM d GROUP BY 1),
    r AS (SELECT *, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS rk FROM c),
    s AS (SELECT sum(t * rk) AS r, sum(t) AS n1, sum(n) AS n, sum(n * n * n - n) AS ties FROM r)
    SELECT round(r - n1 * (n1 + 1) / 2.0, 1)::DOUBLE AS u_statistic, round((abs(r - n1 * (n1 + 1) / 2.0 - n1 * (n - n1) / 2.0) - 0.5)
    / sqrt(n1 * (n - n1) / 12.0 * (n + 1 - ties / (n * (n - 1.0)))), 6)::DOUBLE AS z FROM s""",
)
def job_42_ranks(t: Tables):
    out = X.mann_whitney(t.events, F.col("user_id") % 2 == 0, "value")
    return out.select(F.round("u_statistic", 1).alias("u_statistic"), F.round("z", 6).alias("z"))


@query(
    "job_50",
    """WITH d AS (SELECT quality = 1 AS a, n_chars > 400 AS p FROM labels JOIN documents USING (doc_id)),
    c AS (SELECT count(*) FILTER (a AND p) AS tp, count(*) FILTER (NOT a AND p) AS fp, count(*) FILTER (a AND NOT p) AS fn, count(*) AS n FROM d)
    SELECT round(tp / (tp + fn), 8) AS recall, round(tp / (tp + fp), 8) AS precision, round(2 * tp / (2 * tp + fp + fn), 8) AS f1,
    round((n - fp - fn) / n, 8) AS accuracy FROM c""",
)
def job_50(t: Tables):
    d = t.labels.join(t.documents, "doc_id")
    out = G.classification_metrics(d, F.col("quality") == 1, F.col("n_chars") > 400)
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])
