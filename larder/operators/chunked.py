"""Window functions over groups of any size.

A plain ``Window.partitionBy(key)`` puts one whole key into one task, so a key holding a third of the table decides the
run time of the job.  :func:`cut` measures that first: keys are counted, and a key of more rows than a quarter of an
even partition is cut into consecutive chunks of about that many rows.  The cuts are rows of the key itself, every
64th of an ordered sample drawn by a hash of the ordering columns, so they follow the rows and not the calendar, and the
tie-break columns split what shares one instant.  Which chunk a row falls into is a binary search in the key's cuts,
an expression inside the scan's stage.

The row-level window then runs per ``(key, chunk)``.  What a chunk must know of the chunks before it is one *boundary*
row per chunk of a large key: an aggregate of those keys only, a window over its few rows, and a join back.  There are at
most eight boundary rows to a shuffle partition whatever the table holds, which bounds both the join's broadcast and
the cuts that the driver collects.  Where no key is large there are no boundaries, and the plan is one exchange and one
window; a following step over the same key needs no exchange of its own.

``order`` names columns that order a key; rows equal in all of them stay together.  NULL keys work as in any window.  A
chain of steps cuts once and passes ``chunk`` on; a step that gets none cuts by itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A column of chunk numbers, or WHOLE where no key is large.
Chunk = Column | str
WHOLE = "whole"

_CHUNK, _CARRY = "__chunk", "__carry"

# Keys of at most this many rows are never cut; larger tables take a quarter of an even partition.
LEAST_ROWS = 50_000
PARTS_PER_PARTITION = 4
# Sampled rows for each chunk: chunks then differ by some tenths from each other in size.
SAMPLES = 64


def _key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _same(part: Sequence[str], prefix: str) -> Column:
    """Equality of the key columns, NULL equal to NULL, with renamed ones of the other side."""
    same = F.lit(True)
    for i, p in enumerate(part):
        same = same & F.col(p).eqNullSafe(F.col(f"{prefix}{i}"))
    return same


def _renamed(part: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(p).alias(f"{prefix}{i}") for i, p in enumerate(part)]


def target_rows(df: DataFrame, total: int) -> int:
    """Rows of a chunk: a quarter of an even partition, so a table has at most eight chunks of large keys to a partition."""
    return max(LEAST_ROWS, -(-total // (PARTS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def large_keys(df: DataFrame, part: Sequence[str]) -> tuple[list, int]:
    """Keys that must be cut, with their rows, and the rows of a chunk."""
    counts = df.groupBy(*part).agg(F.count("*").alias("__n"))
    if not part:
        n = counts.first()["__n"]
        rows = target_rows(df, n)
        return ([(n,)] if n > rows else []), rows
    # The count decides what is large, so one pass brings the total and the candidates: no more than the least size allows.
    top = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), F.coalesce(F.max("__n"), F.lit(0)).alias("most")).first()
    rows = target_rows(df, top["n"])
    if top["most"] <= rows:
        return [], rows
    return [tuple(r) for r in counts.where(F.col("__n") > rows).collect()], rows


def cut(df: DataFrame, part: Sequence[str], order: Sequence[str], out: str = _CHUNK) -> tuple[DataFrame, Chunk]:
    """Add the chunk of every row as ``out`` where a key is large: 1, 2, ... along the order, and 0 for all other keys."""
    large, rows = large_keys(df, part)
    if not large:
        return df, WHOLE
    spark = df.sparkSession
    kinds = [df.schema[p].dataType.simpleString() for p in part]
    fields = ", ".join([*[f"`__p{i}` {k}" for i, k in enumerate(kinds)], "`__n` bigint"])
    hot = spark.createDataFrame(large, fields)
    ranges = 1 << 40
    drawn = F.pmod(F.xxhash64(*part, *order), F.lit(ranges)) < F.lit(min(ranges, -(-ranges * SAMPLES // rows)))
    sample = df.select(*part, *order).where(drawn).join(F.broadcast(hot), _same(part, "__p"), "left_semi")
    place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    chosen = sample.withColumn("__i", place).where(F.col("__i") % SAMPLES == 0).select(*_renamed(part, "__p"), _key(order).alias("__cut"))
    cuts = spark.createDataFrame(chosen.collect(), chosen.schema)
    by_key = cuts.groupBy(*[f"__p{i}" for i in range(len(part))]).agg(F.array_sort(F.collect_list("__cut")).alias("__cuts"))
    by_key = by_key.select(*[F.col(f"__p{i}").alias(f"__q{i}") for i in range(len(part))], "__cuts")
    known = hot.drop("__n").join(by_key, _same([f"__p{i}" for i in range(len(part))], "__q"), "left")
    known = known.select(*[f"__p{i}" for i in range(len(part))], "__cuts", F.lit(True).alias("__large"))
    steps = max(1, (sum(n for *_, n in large) // rows + len(large) + 1).bit_length())
    key = _key(order)
    search = F.aggregate(
        F.array(*[F.lit(1 << i) for i in reversed(range(steps))]),
        F.lit(0),
        lambda at, step: F.when(F.get(F.col("__cuts"), at + step - 1) <= key, at + step).otherwise(at),
    )
    number = F.when(F.col("__large"), F.lit(1) + F.coalesce(search, F.lit(0))).otherwise(F.lit(0))
    joined = df.join(F.broadcast(known), _same(part, "__p"), "left")
    return joined.select(*df.columns, number.cast("long").alias(out)), F.col(out)


def _prepared(df: DataFrame, part: Sequence[str], order: Sequence[str], chunk: Chunk | None) -> tuple[DataFrame, list[str]]:
    """The frame with its chunk column, and the columns that a row-level window is partitioned by."""
    df, chunk = cut(df, part, order) if chunk is None else (df, chunk)
    if isinstance(chunk, str):
        return df, list(part)
    return df.withColumn(_CHUNK, chunk), [*part, _CHUNK]


def _boundaries(base: DataFrame, part: Sequence[str], *aggs: Column) -> DataFrame:
    """One row for each chunk of the large keys."""
    return base.where(F.col(_CHUNK) > 0).groupBy(*part, _CHUNK).agg(*aggs)


def _carried(rows: DataFrame, part: Sequence[str], edges: DataFrame) -> DataFrame:
    """Attach a chunk's boundary to its rows; the number of boundaries is bounded (see the module's text)."""
    known = edges.select(*_renamed(part, "__e"), F.col(_CHUNK).alias("__at"), _CARRY)
    return rows.join(F.broadcast(known), (F.col(_CHUNK) == F.col("__at")) & _same(part, "__e"), "left")


def neighbour(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, str | Column],
    chunk: Chunk | None = None,
    forward: bool = False,
) -> DataFrame:
    """Add values of the previous (or, with ``forward``, next) row of the group.

    ``cols`` maps output names to expressions over the neighbouring row.
    ``order`` must name columns that order a group without ties.
    """
    values = F.struct(*[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in cols.items()])
    shift = F.lead if forward else F.lag
    base, by = _prepared(df, part, order, chunk)
    value = shift(values).over(Window.partitionBy(*by).orderBy(*order))
    if len(by) == len(part):
        return base.withColumn("__v", value).select(*df.columns, *[F.col(f"__v.{n}").alias(n) for n in cols])
    pick = F.min_by if forward else F.max_by
    edges = _boundaries(base, part, pick(values, _key(order)).alias("__b"))
    carry = edges.withColumn(_CARRY, shift("__b").over(Window.partitionBy(*part).orderBy(_CHUNK)))
    out = _carried(base.withColumn("__v", value), part, carry).withColumn("__v", F.coalesce("__v", _CARRY))
    return out.select(*df.columns, *[F.col(f"__v.{n}").alias(n) for n in cols])


def running(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    chunk: Chunk | None = None,
) -> DataFrame:
    """Add running sums and maxima from the start of the group to the current row."""
    sums, maxes = dict(sums or {}), dict(maxes or {})
    base, by = _prepared(df, part, order, chunk)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = base.withColumns({n: F.sum(e).over(w) for n, e in sums.items()} | {n: F.max(e).over(w) for n, e in maxes.items()})
    if len(by) == len(part):
        return rows.select(*df.columns, *sums, *maxes)
    edges = _boundaries(base, part, *[F.sum(e).alias(n) for n, e in sums.items()], *[F.max(e).alias(n) for n, e in maxes.items()])
    before = Window.partitionBy(*part).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before_all = F.struct(*[F.sum(n).over(before).alias(n) for n in sums], *[F.max(n).over(before).alias(n) for n in maxes])
    out = _carried(rows, part, edges.withColumn(_CARRY, before_all))
    of = lambda n: F.col(f"{_CARRY}.{n}")
    return out.select(
        *df.columns,
        *[F.coalesce(F.col(n) + of(n), F.col(n), of(n)).alias(n) for n in sums],
        *[F.coalesce(F.greatest(n, of(n)), F.col(n), of(n)).alias(n) for n in maxes],
    )


def fill_down(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, Column],
    chunk: Chunk | None = None,
) -> DataFrame:
    """Add the last non-NULL value of each expression up to and including the current row."""
    base, by = _prepared(df, part, order, chunk)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = base.withColumns({n: F.last(e, ignorenulls=True).over(w) for n, e in cols.items()})
    if len(by) == len(part):
        return rows.select(*df.columns, *cols)
    edges = _boundaries(base, part, *[F.max_by(e, F.when(e.isNotNull(), _key(order))).alias(n) for n, e in cols.items()])
    before = Window.partitionBy(*part).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.withColumn(_CARRY, F.struct(*[F.last(n, ignorenulls=True).over(before).alias(n) for n in cols]))
    return _carried(rows, part, carry).select(*df.columns, *[F.coalesce(F.col(n), F.col(f"{_CARRY}.{n}")).alias(n) for n in cols])


def row_numbers(df: DataFrame, part: Sequence[str], order: Sequence[str], out: str = "rn", chunk: Chunk | None = None) -> DataFrame:
    """Position of every row in its group, counted from 1."""
    return running(df, part, order, sums={out: F.lit(1).cast("long")}, chunk=chunk)


def with_totals(df: DataFrame, part: Sequence[str], **aggs: Column) -> DataFrame:
    """Attach group totals: a partial aggregate joined back, never a whole-group window."""
    totals = df.groupBy(*part).agg(*[e.alias(n) for n, e in aggs.items()])
    same = [F.col(f"l.{p}").eqNullSafe(F.col(f"r.{p}")) for p in part]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return df.alias("l").join(totals.alias("r"), cond, "left").select(
        *[F.col(f"l.{c}") for c in df.columns], *[F.col(f"r.{n}") for n in aggs]
    )


# Relative rank error of the summaries that bracket a quantile.
ACCURACY = 10_000
# Groups whose brackets are sent to the rows; with more groups rows and brackets meet in a shuffle.
SENT_GROUPS = 100_000


def sent_if_small(small: DataFrame, most: int) -> DataFrame:
    """A frame of at most so many rows, brought here once and marked for broadcast; a larger one as it is."""
    rows = small.limit(most + 1).collect()
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema)) if len(rows) <= most else small


def exact_quantile(df: DataFrame, part: Sequence[str], col: str, q: float = 0.5, out: str = "quantile") -> DataFrame:
    """Exact quantile per group, with linear interpolation between neighbouring positions.

    A mergeable summary of each group bounds the wanted positions from below and above; then one pass counts the values
    between these bounds, and all values on either side of them as one: a wanted position may be the last one below or
    the first one above.  What is left to order is some ten-thousandths of a group.
    """
    x = F.col(col).cast("double")
    rows = df.where(F.col(col).isNotNull()).select(*part, x.alias("__x"))
    slack = 4 / ACCURACY
    bounds = F.percentile_approx("__x", F.array(F.lit(max(0.0, q - slack)), F.lit(min(1.0, q + slack))), F.lit(ACCURACY))
    brackets = rows.groupBy(*part).agg(bounds.alias("__b"), F.count("*").alias("__all"))
    brackets = brackets.select(*_renamed(part, "__p"), F.col("__b")[0].alias("__lo"), F.col("__b")[1].alias("__hi"), "__all")
    brackets = sent_if_small(brackets, SENT_GROUPS)
    side = F.when(F.col("__x") < F.col("__lo"), 0).when(F.col("__x") <= F.col("__hi"), 1).otherwise(2)
    near = rows.join(brackets, _same(part, "__p")).withColumn("__side", side)
    counts = near.groupBy(*part, "__side", F.when(F.col("__side") == 1, F.col("__x")).alias("__value")).agg(
        F.count("*").alias("__n"), F.max("__all").alias("__all"), F.max("__x").alias("__max"), F.min("__x").alias("__min")
    )
    upto = running(counts, part, ["__side", "__value"], {"__end": F.col("__n")})
    upto = upto.withColumn("__value", F.when(F.col("__side") == 0, F.col("__max")).otherwise(F.col("__min")))
    at = (F.col("__all") - 1) * F.lit(float(q)) + 1
    ranked = upto.withColumns({"__p": F.floor(at), "__f": at - F.floor(at), "__q": F.least(F.floor(at) + 1, "__all")})
    covers = lambda p: (F.col("__end") - F.col("__n") < F.col(p)) & (F.col(p) <= F.col("__end"))
    of = lambda p: F.max(F.when(covers(p), F.col("__value")))
    found = ranked.groupBy(*part).agg(of("__p").alias("__lo"), of("__q").alias("__hi"), F.max("__f").alias("__f"))
    return found.select(*part, (F.col("__lo") * (1 - F.col("__f")) + F.col("__hi") * F.col("__f")).alias(out))


def exact_median(df: DataFrame, part: Sequence[str], col: str, out: str = "median") -> DataFrame:
    """Exact median per group without holding a group in one task."""
    return exact_quantile(df, part, col, 0.5, out)
