"""Projections and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Rename, cast and standardise: output name -> expression (Column or SQL text)."""
    return df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in mapping.items()])


def select_except(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def classify(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching rule wins."""
    out = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def band(col: Column, cuts: Sequence[float], labels: Sequence[str]) -> tuple[Column, Column]:
    """(label, sort key): ``labels[i]`` for values >= ``cuts[i]``, cuts in falling order, the last label below all."""
    rules = [(col >= c, i) for i, c in enumerate(cuts)]
    order = F.when(col.isNotNull(), classify(rules, len(cuts)))
    label = F.when(col.isNotNull(), classify([(c, labels[i]) for c, i in rules], labels[-1]))
    return label, order


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(*values))


def add_unknown_row(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add the unknown member of a dimension; columns without a default are NULL."""
    row = df.sparkSession.range(1).select(
        *[F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)


def null_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Add typed NULL columns so that frames line up in a union."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in names.items()})


def impute_from_reason(target: Column, reason: Column, rules: Mapping[str, str], fallback: Column | None = None) -> Column:
    """Fill a missing id from a free-text reason, then from a fallback."""
    guess = classify([(reason == text, value) for text, value in rules.items()], fallback)
    return F.coalesce(target, guess)


def flag_by_patterns(df: DataFrame, col: str, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """One boolean per name: the lower-cased text contains any of its patterns."""
    text = F.lower(F.col(col))
    flags = {}
    for name, parts in patterns.items():
        hit = F.lit(False)
        for p in parts:
            hit = hit | text.contains(p)
        flags[name] = hit
    return df.withColumns(flags)


def flag_by_ids(df: DataFrame, key: str, col: str, mapping: Mapping[str, Sequence]) -> DataFrame:
    """Per key, 0/1 columns: does any row carry an id of the list?"""
    return df.groupBy(key).agg(
        *[F.max(F.col(col).isin(*ids).cast("int")).alias(name) for name, ids in mapping.items()]
    )


def masked_measure(col: Column, cond: Column) -> Column:
    """A measure that only rows of its owning type carry."""
    return F.when(cond, col)
