"""Data-quality checks: each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.aggregates import repetition
from larder.operators.chunked import row_numbers


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with NULLs, from one pass over the table."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in cols]))
    return counts.select(pairs.alias("p")).select("p.*").where("n_null > 0")


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values)).groupBy(col).agg(F.count("*").alias("n"))


def check_fk(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Key values without a parent, with the number of rows that carry them."""
    used = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return used.join(parent.select(F.col(key).alias("__k")), F.col(col) == F.col("__k"), "left_anti")


def check_required(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Expected values that a column does not hold."""
    kind = df.schema[col].dataType
    wanted = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v).cast(kind) for v in values])).alias(col))
    return wanted.join(df.select(col).distinct(), col, "left_anti")


def check_equal(df: DataFrame, a: str, b: str, where: Column | str = "true") -> DataFrame:
    return df.where(where).where(~F.col(a).eqNullSafe(F.col(b)))


def check_rank_consistent(df: DataFrame, key: Sequence[str], cols: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Rows whose position in their group differs between the order columns."""
    out = df
    for c in cols:
        out = row_numbers(out, key, [c, *tie], f"rn_{c}")
    first, *rest = [f"rn_{c}" for c in cols]
    differs = F.lit(False)
    for r in rest:
        differs = differs | (F.col(r) != F.col(first))
    return out.where(differs)


def check_at_most_one(df: DataFrame, key: str, where: Column) -> DataFrame:
    """Keys with more than one row that meets a condition."""
    return df.where(where).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def check_row_counts(**frames: DataFrame) -> DataFrame:
    """Row counts of frames that should be equally long, if they are not."""
    parts = [df.agg(F.count("*").alias("n")).withColumn("frame", F.lit(name)) for name, df in frames.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    # One row per frame: collected into one short array to compare.
    rows = counts.agg(F.collect_list(F.struct("frame", "n")).alias("r"))
    differ = F.array_max(F.transform("r", lambda x: x["n"])) != F.array_min(F.transform("r", lambda x: x["n"]))
    return rows.where(differ).select(F.explode("r").alias("r")).select("r.*")


def check_header_total(
    headers: DataFrame, lines: DataFrame, on: tuple[str, str], amount: str, line_amount: Column, tolerance: float
) -> DataFrame:
    """Headers whose amount differs from the sum of their lines by more than a tolerance."""
    sums = lines.groupBy(F.col(on[1]).alias("__k")).agg(F.sum(line_amount).alias("line_total"))
    j = headers.join(sums, headers[on[0]] == F.col("__k"))
    diff = F.abs(F.col(amount) - F.col("line_total"))
    return j.withColumn("abs_diff", diff).where(F.col("abs_diff") > tolerance).drop("__k")


def check_length(df: DataFrame, col: Column, lengths: Mapping[str, int], country: Column) -> DataFrame:
    """Rows whose code does not have the length of its country."""
    bad = F.lit(False)
    for name, n in lengths.items():
        bad = bad | ((country == name) & (F.length(col) != n))
    return df.where(bad)


def check_coverage(df: DataFrame, cols: Sequence[str], expected: DataFrame) -> DataFrame:
    """Expected combinations that have no row."""
    return expected.join(df.select(*cols).distinct(), list(cols), "left_anti")


def check_contract(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Declared columns against a frame: missing ones, and how many values do not cast to the declared type.

    All casts are counted in one pass.
    """
    present = [c for c in declared if c in df.columns]
    bad = lambda c: F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(declared[c]).isNull(), 1))
    counts = df.agg(*[bad(c).alias(f"__{c}") for c in present]) if present else df.sparkSession.range(1)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("declared"),
            F.lit(c not in present).alias("is_missing"),
            (F.col(f"__{c}") if c in present else F.lit(0).cast("long")).alias("n_bad"),
        )
        for c, kind in declared.items()
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def unwanted_share(baskets: DataFrame, lines: DataFrame, basket: str, wants: Column, flag: Column) -> DataFrame:
    """Share of baskets that got an item they do not want.

    ``wants`` marks baskets that accept such items; ``flag`` marks the items among the lines.
    """
    asked = baskets.where(~wants).select(basket)
    got = lines.join(asked, basket, "left_semi").groupBy(basket).agg(F.max(flag.cast("int")).alias("hit"))
    return got.agg((F.sum("hit") / F.count("*")).alias("unwanted_share"))


def validate_outputs(
    baskets: DataFrame, lines: DataFrame, basket: str, groups: Sequence[str], item_col: str, cuts: Mapping[str, float]
) -> DataFrame:
    """Broken rules per group of baskets: compliancy levels, error limits and repeated main items.

    ``cuts``: ``error`` (mean-error limit) and ``repetition`` (share of the basket that one main item may take).
    """
    rep = repetition(lines, [basket], item_col).select(basket, "max_repetition")
    b = baskets.join(rep, basket, "left")
    allergen = F.col("compliancy") == 1
    preference = F.col("compliancy") == 2
    error = F.col("error") > cuts["error"]
    repeats = F.col("max_repetition") / F.col("n_items") > cuts["repetition"]
    rules = {"allergen": allergen, "preference": preference, "error": error, "repetition": repeats}
    n = F.count("*")
    aggs = [n.alias("total")]
    for name, cond in rules.items():
        hits = F.count(F.when(cond, 1))
        aggs += [hits.alias(f"broken_{name}"), F.round(hits / n * 100, 2).alias(f"percentage_{name}")]
    return b.groupBy(*groups).agg(*aggs)


def validate_features(
    df: DataFrame, required: Sequence[str], ranges: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """Scoring inputs per column: missing column, NULL count, out-of-range count, in one pass."""
    cols = list(dict.fromkeys([*required, *ranges]))
    present = [c for c in cols if c in df.columns]
    aggs = []
    for c in present:
        aggs.append(F.count(F.when(F.col(c).isNull(), 1)).alias(f"__null_{c}"))
        lo, hi = ranges.get(c, (None, None))
        outside = F.lit(False) if lo is None else ~F.col(c).between(lo, hi)
        aggs.append(F.count(F.when(outside, 1)).alias(f"__out_{c}"))
    counts = df.agg(*aggs)
    zero = F.lit(0).cast("long")
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c not in present).alias("is_missing"),
            (F.col(f"__null_{c}") if c in present else zero).alias("n_null"),
            (F.col(f"__out_{c}") if c in present else zero).alias("n_outside"),
        )
        for c in cols
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
