"""Quality measures against a plain count, the cascade against its rules."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from larder.llm import quality
from larder.llm.common import corpus


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), base)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(df, texts):
    got = df.collect()
    assert len(got) == len(texts)
    for r in got:
        assert (*[r[c] for c in COLUMNS], r.base_failed) == plain(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.base_failed and r.kept)
    return got


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in corpus(spark, folder).collect()}
    got = check(quality.op3_quality(spark, folder), texts)
    kept = {r.doc_id: r.kept for r in got}
    labels = corpus(spark, folder, "labels").collect()
    good, bad = [kept[r.doc_id] for r in labels if r.quality == 1], [kept[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) > 0.93 * len(good) and sum(bad) < 0.1 * len(bad)


def test_random_and_odd_texts(spark):
    rng = random.Random(5)
    texts = {i: "".join(rng.choices("ab  \n\x1c\t#é日\xa0", k=rng.randint(0, 120))) for i in range(200)}
    texts |= {900: None, 901: "", 902: "\n \n", 903: "a b c d e " * 40, 904: "a " * 30, 905: " x\ny z\r\nx\n x", 906: "w" * 30_000, 907: "\n".join(["same line"] * 9)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"words": F.lit(1), "n_words": F.lit("x")})
    out = quality.judge(df).select("doc_id", *COLUMNS, quality.base_failed().alias("base_failed"), F.col("failed").isNull().alias("kept"))
    check(out, texts)
    assert quality.judge(df.limit(0)).count() == 0
    assert quality.judge(df.unionAll(df)).count() == 2 * len(texts)


def test_order_is_by_rejections_per_cost_and_does_not_change_the_verdict(spark):
    rows = quality.measured(corpus(spark, "/root/testdata/sf0.001")).cache()
    rules = {n: r() for n, r in quality.RULES.items()}
    ranked = quality.plan(rows, rules)
    assert [s / c for _, c, s in ranked] == sorted((s / c for _, c, s in ranked), reverse=True)
    names = [n for n, _, _ in ranked]
    one = rows.select("doc_id", quality.cascade(rules, names).isNull().alias("k"))
    other = rows.select("doc_id", quality.cascade(rules, names[::-1]).isNull().alias("k"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_no_python_in_the_plan(spark):
    plan = quality.op3_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
