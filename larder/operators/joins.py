"""Joins.

Plain equi joins are left to the DataFrame API: the planner broadcasts a side
when its size is known to be small and AQE splits skewed partitions.  What is
here are joins that would otherwise pair every row of a key with every other
row of it: validity, as-of and trailing joins run in one ordered pass or on an
expanded equi key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.chunked import fill_down, neighbour


def left_join(a: DataFrame, b: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Left join on (left column, right column) pairs."""
    cond = a[on[0][0]] == b[on[0][1]]
    for x, y in on[1:]:
        cond = cond & (a[x] == b[y])
    return a.join(b, cond, "left")


def full_join_coalesce(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join whose keys come from either side."""
    return a.join(b, list(keys), "full")


def cross_small(a: DataFrame, b: DataFrame, max_rows: int) -> DataFrame:
    """All pairs with a dimension whose size the caller states.

    ``b`` becomes one array value; more than ``max_rows`` rows in it is an error, so nothing large is ever replicated.
    """
    packed = b.limit(max_rows + 1).agg(F.collect_list(F.struct(*b.columns)).alias("x"))
    checked = packed.select(
        F.when(F.size("x") <= max_rows, F.col("x")).otherwise(
            F.raise_error(F.lit(f"cross_small: more than {max_rows} rows"))
        )
    )
    return a.withColumn("__b", F.explode(checked.scalar())).select(*a.columns, "__b.*")


def anti_join(a: DataFrame, b: DataFrame, on: tuple[str, str]) -> DataFrame:
    return a.join(b, a[on[0]] == b[on[1]], "left_anti")


def semi_join(a: DataFrame, b: DataFrame, on: tuple[str, str]) -> DataFrame:
    return a.join(b, a[on[0]] == b[on[1]], "left_semi")


def union_missing(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Primary rows, plus fallback rows of keys the primary source does not have."""
    return primary.unionByName(fallback.join(primary.select(key), key, "left_anti"))


def match_key(primary: Column, fallback: Column) -> Column:
    """Key to match on: the fallback id where the primary id is missing."""
    return F.coalesce(primary, fallback)


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    left_ts: str,
    right_ts: str,
    out: str = "matched",
    tie: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Attach the newest right row with ``right_ts <= left_ts`` as a struct (NULL if there is none).

    Both sides are unioned in time order and the last right row is carried
    forward: cost is one ordered pass over the rows of both
    sides, however they spread over the keys.  ``strict`` asks for ``<``.
    ``tie`` orders right rows of one instant.
    """
    ts_type = left.schema[left_ts].dataType
    lrow = left.select(
        *key,
        F.col(left_ts).alias("__ts"),
        F.lit(0 if strict else 2).alias("__side"),
        F.struct(*left.columns).alias("__left"),
        F.xxhash64(*left.columns).alias("__spread"),
        F.lit(True).alias("__is_left"),
    )
    cols = [c for c in right.columns if c not in key]
    rrow = right.where(F.col(right_ts).isNotNull()).select(
        *key,
        F.col(right_ts).cast(ts_type).alias("__ts"),
        F.lit(1).alias("__side"),
        *([F.col(tie).alias("__tie")] if tie else []),
        F.struct(*cols).alias("__right"),
        F.lit(False).alias("__is_left"),
    )
    both = lrow.unionByName(rrow, allowMissingColumns=True)
    # Left rows of one instant may be parted anywhere: all of them see the same right row.
    order = ["__ts", "__side"] + (["__tie"] if tie else []) + ["__spread"]
    filled = fill_down(both, key, order, {"__m": F.col("__right")}).where("__is_left")
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    return filled.select("__left.*", F.when(known, F.col("__m")).alias(out))


def as_of_validity(
    fact: DataFrame,
    dim: DataFrame,
    key: Sequence[str],
    ts: str,
    from_: str = "valid_from",
    to: str = "valid_to",
    closed: str = "left",
    how: str = "left",
) -> DataFrame:
    """Attach the dimension version that is valid at ``ts``.

    The versions of one key must not overlap.  ``closed="left"`` matches
    ``from <= ts < to``; ``closed="both"`` also matches ``ts = to``, so a fact
    on a boundary gets both versions.
    """
    cols = [c for c in dim.columns if c not in key]
    versions = dim.where(F.col(from_) < F.col(to))
    hit = as_of(fact, versions, key, ts, from_, "__d")
    hit = hit.withColumn("__d", F.when(F.col(ts) < F.col(f"__d.{to}"), F.col("__d")))
    if closed == "both":
        ends = dim.groupBy(*key, F.col(to).cast(fact.schema[ts].dataType).alias("__end")).agg(
            F.collect_list(F.struct(*cols)).alias("__ending")
        )
        ends = ends.select(*[F.col(k).alias(f"__{k}") for k in key], "__end", "__ending")
        cond = F.col(ts) == F.col("__end")
        for k in key:
            cond = cond & (F.col(k) == F.col(f"__{k}"))
        hit = hit.join(ends, cond, "left")
        hits = F.concat(F.array_compact(F.array("__d")), F.coalesce("__ending", F.array()))
        hit = hit.withColumn("__hits", hits).select(*fact.columns, F.explode_outer("__hits").alias("__d"))
    if how == "inner":
        hit = hit.where(F.col("__d").isNotNull())
    return hit.select(*fact.columns, *[F.col(f"__d.{c}").alias(c) for c in cols])


def band_join(
    fact: DataFrame,
    bands: DataFrame,
    keys: Sequence[str],
    value: str,
    ts: str,
    width: float,
    lo: str = "min_value",
    hi: str = "max_value",
    from_: str = "valid_from",
    to: str = "valid_to",
    how: str = "left",
) -> DataFrame:
    """Attach the band with ``lo <= value < hi`` that is valid at ``ts``.

    Bands are repeated for every ``width``-wide bucket that they touch, so the join is an equi join on the bucket.
    """
    b = bands.withColumn(
        "__bucket", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)))
    ).alias("b")
    f = fact.withColumn("__bucket", F.floor(F.col(value) / width)).alias("f")
    cond = F.col("f.__bucket") == F.col("b.__bucket")
    for k in keys:
        cond = cond & (F.col(f"f.{k}") == F.col(f"b.{k}"))
    cond = cond & (F.col(f"f.{value}") >= F.col(f"b.{lo}")) & (F.col(f"f.{value}") < F.col(f"b.{hi}"))
    cond = cond & (F.col(f"f.{ts}") >= F.col(f"b.{from_}")) & (F.col(f"f.{ts}") < F.col(f"b.{to}"))
    extra = [c for c in bands.columns if c not in keys]
    return f.join(b, cond, how).select(*[F.col(f"f.{c}") for c in fact.columns], *[F.col(f"b.{c}") for c in extra])


def point_in_time(
    entities: DataFrame,
    feats: DataFrame,
    keys: Sequence[str],
    entity_ts: str,
    feature_ts: str,
    lookback: str | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Newest feature row at or before the entity time, at most ``lookback`` old (e.g. ``"7 days"``)."""
    cols = [c for c in feats.columns if c not in keys and c != tie]
    hit = as_of(entities, feats, keys, entity_ts, feature_ts, "__f", tie)
    fresh = F.lit(True)
    if lookback:
        fresh = F.col(f"__f.{feature_ts}") >= F.col(entity_ts) - F.expr(f"interval {lookback}")
    return hit.select(*entities.columns, *[F.when(fresh, F.col(f"__f.{c}")).alias(c) for c in cols])


def trailing_days(targets: DataFrame, history: DataFrame, key: str, day: str, days: int) -> DataFrame:
    """Pair each target day of a key with that key's history days of the ``days`` before it.

    Both frames hold one row per (key, day).  Each history day is repeated for the ISO weeks that it can serve and
    joined on the week, so a (key, week) meets at most seven days with seven.  Days of the target's own ISO week do not
    count as history.
    """
    weeks = days // 7 + 1
    served = history.withColumnRenamed(day, "__hist_day").withColumn(
        "__week",
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(weeks)), lambda i: F.date_add(F.trunc("__hist_day", "week"), (i * 7).cast("int")))),
    )
    t = targets.withColumn("__week", F.trunc(day, "week")).alias("t")
    cond = (F.col(f"t.{key}") == F.col(f"h.{key}")) & (F.col("t.__week") == F.col("h.__week"))
    cond = cond & (F.datediff(F.col(f"t.{day}"), F.col("h.__hist_day")) <= days)
    cols = [F.col(f"h.{c}") for c in served.columns if c not in (key, "__week")]
    return t.join(served.alias("h"), cond, "left").select(*[F.col(f"t.{c}") for c in targets.columns], *cols)


def trailing_periods(targets: DataFrame, history: DataFrame, keys: Sequence[str], seq: str, n: int) -> DataFrame:
    """Pair each target period with the key's history of the ``n`` periods up to and including it.

    History is one row per (keys, period number).
    """
    served = history.withColumn("__hist_seq", F.col(seq)).withColumn(
        seq, F.explode(F.sequence(F.col(seq), F.col(seq) + n - 1))
    )
    return targets.join(served, [*keys, seq], "left")


def previous_version(scd: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Values of the version that ends where this one starts, as ``previous_<col>``."""
    look = {f"previous_{c}": c for c in cols} | {"__prev_to": "valid_to"}
    out = neighbour(scd, key, ["valid_from"], look)
    touches = F.col("__prev_to") == F.col("valid_from")
    for c in cols:
        out = out.withColumn(f"previous_{c}", F.when(touches, F.col(f"previous_{c}")))
    return out.drop("__prev_to")


def next_row(df: DataFrame, part: Sequence[str], seq: str, cols: Sequence[str]) -> DataFrame:
    """Values of the row numbered one higher, as ``next_<col>``."""
    look = {f"next_{c}": c for c in cols} | {"__next_seq": seq}
    out = neighbour(df, part, [seq], look, forward=True)
    adjacent = F.col("__next_seq") == F.col(seq) + 1
    for c in cols:
        out = out.withColumn(f"next_{c}", F.when(adjacent, F.col(f"next_{c}")))
    return out.drop("__next_seq")


def level_mismatch(bands: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    """Bands whose lower bound differs from the upper bound of the level below, where both are valid together.

    The pairing key holds the level, so a pair only forms between versions of two adjacent levels.
    """
    cur, low = bands.alias("c"), bands.alias("p")
    cond = F.col(f"c.{level}") == F.col(f"p.{level}") + 1
    for k in keys:
        cond = cond & (F.col(f"c.{k}") == F.col(f"p.{k}"))
    cond = cond & (F.col("c.valid_from") < F.col("p.valid_to")) & (F.col("p.valid_from") < F.col("c.valid_to"))
    return (
        cur.join(low, cond)
        .where(F.col("c.min_value") != F.col("p.max_value"))
        .select("c.*", F.col("p.max_value").alias("max_value_below"))
    )


def prev_year_join(df: DataFrame, part: Sequence[str], target: str, years: int) -> DataFrame:
    """The value of the same ISO week ``years`` earlier; gaps take the previous, then the next known value.

    ``df`` has one row per (part, year, week), so a window holds the weeks of one part only.
    """
    name = f"{target}_prev_year_{years}"
    prev = df.select(*part, (F.col("year") + years).alias("year"), "week", F.col(target).alias("__v"))
    out = df.join(prev, [*part, "year", "week"], "left")
    w = Window.partitionBy(*part).orderBy("year", "week")
    back = F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("__v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return out.withColumn(name, F.coalesce(back, ahead)).drop("__v")


def map_comparable_weeks(
    weeks: DataFrame, years_back: int, named_holidays: Sequence[str], neighbours: Sequence[int] = (-1, 1, -2, 2)
) -> DataFrame:
    """Map every week to the comparable week ``years_back`` years earlier.

    ``weeks``: one row per (year, week) with ``orders``, ``weeks_since_easter``
    (NULL away from Easter), ``n_holidays``, ``n_holidays_effective`` and one
    0/1 column per named holiday.  A week maps by its distance from Easter,
    else by the first of the named holidays that it starts, else to the same
    week number.  A week without holidays that lands on a week with some takes
    last year's same week if that is free of holidays, else the mapping of the
    nearest week without holidays.
    """
    base = weeks.withColumn("mapped_year", F.col("year") - years_back)
    past = weeks.select(
        F.col("year").alias("mapped_year"),
        F.col("week").alias("p_week"),
        F.col("orders").alias("p_orders"),
        F.col("weeks_since_easter").alias("p_easter"),
        *[F.col(h).alias(f"p_{h}") for h in named_holidays],
    )
    easter = past.where("p_easter is not null").select(
        "mapped_year",
        F.col("p_easter").alias("weeks_since_easter"),
        F.col("p_week").alias("e_week"),
        F.col("p_orders").alias("e_orders"),
    )
    m = base.join(easter, ["mapped_year", "weeks_since_easter"], "left")
    picks = [F.struct(F.col("e_week").alias("w"), F.col("e_orders").alias("o"))]
    for i, h in enumerate(named_holidays):
        first_now = weeks.where(F.col(h) == 1).groupBy("year").agg(F.min("week").alias("week"))
        first_past = past.where(F.col(f"p_{h}") == 1).groupBy("mapped_year").agg(
            F.min_by(F.struct(F.col("p_week").alias("w"), F.col("p_orders").alias("o")), "p_week").alias(f"h{i}")
        )
        starts = first_now.withColumn("mapped_year", F.col("year") - years_back).join(first_past, "mapped_year")
        m = m.join(starts.drop("mapped_year"), ["year", "week"], "left")
        picks.append(F.col(f"h{i}"))
    same = past.select("mapped_year", F.col("p_week").alias("week"), F.col("p_orders").alias("s_orders"))
    m = m.join(same, ["mapped_year", "week"], "left")
    picked = F.coalesce(*[F.when(p["w"].isNotNull(), p) for p in picks])
    m = m.select(
        *weeks.columns,
        "mapped_year",
        F.coalesce(picked["w"], F.col("week")).alias("mapped_week"),
        F.coalesce(picked["o"], F.col("s_orders")).alias("mapped_orders"),
    )
    # Only years with a counterpart are mapped.
    m = m.where(F.col("year") >= weeks.agg(F.min("year") + years_back).scalar())
    eff = weeks.select(
        F.col("year").alias("mapped_year"),
        F.col("week").alias("mapped_week"),
        F.col("n_holidays_effective").alias("n_holidays_mapped"),
    )
    m = m.join(eff, ["mapped_year", "mapped_week"], "left").withColumn(
        "needs_attention", ~F.col("n_holidays_effective").eqNullSafe(F.col("n_holidays_mapped"))
    )
    last_year = weeks.where("n_holidays_effective = 0").select(
        (F.col("year") + 1).alias("year"), "week", F.col("orders").alias("ly_orders"), F.lit(True).alias("ly_free")
    )
    m = m.join(last_year, ["year", "week"], "left")
    # One row per week of the calendar: a single small ordered window.
    w = Window.partitionBy(F.lit(1)).orderBy("year", "week")
    here = F.struct("mapped_year", "mapped_week", "mapped_orders")
    near = [F.when(F.lag("n_holidays", -i).over(w) == 0, F.lag(here, -i).over(w)) for i in neighbours]
    m = m.withColumn("__near", F.coalesce(*near))
    fix = F.col("needs_attention") & (F.col("n_holidays_effective") == 0)
    own = F.struct(
        (F.col("year") - 1).alias("mapped_year"),
        F.col("week").alias("mapped_week"),
        F.col("ly_orders").alias("mapped_orders"),
    )
    best = F.when(fix & F.col("ly_free"), own).when(fix & F.col("__near").isNotNull(), F.col("__near")).otherwise(here)
    return m.withColumn("__best", best).select(
        *weeks.columns, "needs_attention", "__best.mapped_year", "__best.mapped_week", "__best.mapped_orders"
    )
