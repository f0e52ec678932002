"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition under which a text is rejected.  Each rule's cost (time over a bounded sample) and selectivity
(share of the sample it rejects) are measured, the rules are ordered by rejections per cost and evaluated as one
``CASE WHEN`` chain: a text that one rule rejects is not looked at by the dearer ones behind it.  The order changes the
run time and which rule is named first, never the verdict.

NULL and empty texts have no words and are rejected by the base rule; repeated rows are judged alike; an empty table
gives an empty one (and rules keep the order given).  The input's own columns are not used besides id and text.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import corpus, hashed_rows, stored

BLANK = r"[\x20\x09-\x0D]+"
INKED = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WIDTH = 5
SAMPLE = 2000



def bound(value: Column, of) -> Column:
    """``of(value)`` with the value computed once, also where the optimizer moves the expression into a filter."""
    return F.element_at(F.transform(F.array(value), of), 1)


def repeated_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text.

    Hashes of the windows come first: a text in which all differ has no repeat.  Only the others sort their windows by
    their words, so equal ones become neighbours, and count the positions that these cover.
    """
    at = lambda w, i: [F.get(w, i + k) for k in range(WIDTH)]

    def exact(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WIDTH)
        windows = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *at(w, i)).alias("k"), i.alias("p")))
        return bound(F.array_sort(windows), covered)

    def covered(s: Column) -> Column:
        key = lambda j: F.get(s, j)["k"]
        twin = F.filter(s, lambda x, j: ((j > 0) & (key(j - 1) == x["k"])) | (key(j + 1) == x["k"]))
        places = F.array_sort(F.transform(twin, lambda x: x["p"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WIDTH).alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(WIDTH), p - a["last"])).cast("long").alias("n"), p.alias("last"))
        return F.reduce(places, start, step, lambda a: a["n"])

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*at(w, i)))
        twins = bound(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) < WIDTH, F.lit(0).cast("long")).when(twins, exact(w)).otherwise(F.lit(0).cast("long"))

    return bound(words, of)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, text, words, lines and the base measures of every document."""
    text = df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = text.select(
        "*",
        F.array_remove(F.split("text", BLANK), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(INKED)).alias("lines"),
    )
    return cut.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _share(part: Column, whole: Column, percent: int) -> Column:
    return 100 * part > percent * whole


#: Rules of the cascade over the columns of :func:`measured`; true rejects.
RULES: dict[str, Column | object] = {
    "symbols": lambda: _share(F.col("n_symbols"), F.col("n_words"), 10),
    "duplicate_lines": lambda: _share(F.col("n_dup_lines"), F.size("lines"), 30),
    "word_length": lambda: (2 * F.col("word_chars") < 5 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words")),
    "shouting": lambda: _share(F.regexp_count("text", F.lit(r"\p{Lu}")), F.col("word_chars"), 50),
    "stutter": lambda: _share(
        bound(F.col("words"), lambda ws: F.size(F.filter(ws, lambda w, i: w == F.get(ws, i - 1)))), F.size("words"), 30
    ),
}


def plan(sample: DataFrame, rules: Mapping[str, Column]) -> list[tuple[str, float, float]]:
    """Rules with their cost in seconds and selectivity over ``sample``, by rejections per cost."""
    n = max(1, sample.count())
    shares = sample.agg(*[F.count(F.when(rule, 1)).alias(name) for name, rule in rules.items()]).first()
    found = []
    for name, rule in rules.items():
        began = time.perf_counter()
        sample.select(rule.alias("r")).write.format("noop").mode("overwrite").save()
        found.append((name, time.perf_counter() - began, shares[name] / n))
    return sorted(found, key=lambda r: -(r[2] / r[1]))


def cascade(rules: Mapping[str, Column], order: Sequence[str]) -> Column:
    """Name of the first rule in this order that rejects the row, NULL if none does."""
    if not order:
        return F.lit(None).cast("string")
    first, *rest = order
    chain = reduce(lambda c, name: c.when(rules[name], name), rest, F.when(rules[first], first))
    return chain.otherwise(F.lit(None).cast("string"))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE) -> DataFrame:
    """The columns of :func:`measured` with ``failed``: the base rule or the first rule of the cascade that rejects."""
    rules = {name: rule() for name, rule in RULES.items()}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written before anything is measured: the measures would else be moved below the limit, to all rows.
    sample = stored(hashed_rows(df.select(id_col, text_col), sample_rows, id_col), "quality-sample")
    fitted = stored(measured(sample.repartition(min(8, parts)), id_col, text_col), "quality-measured")
    ranked = [name for name, _, _ in plan(fitted.where(~base_failed()), rules)]
    rows = measured(df, id_col, text_col)
    return rows.withColumn("failed", F.when(base_failed(), "base").otherwise(cascade(rules, ranked)))


def op3_quality(spark, folder: str) -> DataFrame:
    judged = judge(corpus(spark, folder))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.col("failed").isNull().alias("kept"),
    )


#: The same result in DuckDB's SQL.
OP3_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, i, words[i:i + 4] AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twins AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twins) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  len(lines) AS n_lines, len(regexp_extract_all(text, '\p{Lu}')) AS capitals,
  len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS stutters
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines OR 2 * word_chars < 5 * n_words
    OR word_chars > 12 * n_words OR 100 * capitals > 50 * word_chars OR 100 * stutters > 30 * n_words) AS kept FROM b"""
