"""Text expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short stopword lists per language code.
STOPWORDS = {
    "en": ["a", "an", "and", "as", "at", "by", "for", "in", "is", "it", "of", "on", "or", "that", "the", "to", "with"],
    "fr": ["au", "aux", "dans", "de", "des", "du", "elle", "en", "et", "il", "la", "le", "les", "par", "que", "qui", "un", "une"],
    "de": ["auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "und", "von", "zu"],
    "es": ["al", "con", "de", "del", "el", "en", "la", "las", "los", "por", "que", "un", "una", "y"],
}


def clean_tokens(col: Column | str, stopwords: Sequence[str] = ()) -> Column:
    """Lower-cased words of letters only, in order, without stopwords."""
    c = F.col(col) if isinstance(col, str) else col
    words = F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " ")), " ")
    words = F.filter(words, lambda w: w != "")
    if stopwords:
        stop = F.array(*[F.lit(s) for s in stopwords])
        words = F.filter(words, lambda w: ~F.array_contains(stop, w))
    return words


def clean_tokens_by_language(col: Column | str, lang: Column | str) -> Column:
    """``clean_tokens`` with the stopword list of the row's language."""
    code = F.col(lang) if isinstance(lang, str) else lang
    out = None
    for name, words in STOPWORDS.items():
        tokens = clean_tokens(col, words)
        out = F.when(code == name, tokens) if out is None else out.when(code == name, tokens)
    return out.otherwise(clean_tokens(col))


def snake_case(name: str) -> str:
    """``camelCase``, ``PascalCase``, ``kebab-case`` or ``With Blanks`` to ``snake_case``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub(r"[\s\-]+", "_", spaced).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to snake case."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def parse_portion(code: Column | str) -> tuple[Column, Column]:
    """(number, name) of a portion code; a two-character code ending in 1 is an ``N+`` portion."""
    c = F.col(code) if isinstance(code, str) else code
    plus = (F.length(c) == 2) & (F.right(c, F.lit(1)) == "1")
    first = F.left(c, F.lit(1))
    return F.when(plus, first).otherwise(c).cast("int"), F.when(plus, F.concat(first, F.lit("+"))).otherwise(c)


def clean_postal(code: Column, country: Column, lengths: Mapping[str, int], pickup_codes: Sequence[str] = ()) -> Column:
    """Left-pad (and, as ``lpad`` does, cut) a code to its country's length; pickup codes stay."""
    rules = list(lengths.items())
    out = F.when(code.isin(*pickup_codes), code) if pickup_codes else F.when(F.lit(False), code)
    for name, length in rules:
        out = out.when(country == name, F.lpad(code, length, "0"))
    return out.otherwise(code)
