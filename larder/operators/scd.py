"""Slowly-changing timelines: rows of an entity valid in ``[valid_from, valid_to)``.

All per-entity ordering goes through :mod:`larder.operators.chunked`, so an
entity with a very long history is spread over chunks of measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import future
from larder.operators.chunked import Chunk, cut, fill_down, neighbour, running


def with_valid_to(
    df: DataFrame, key: Sequence[str], ts: str, tie: Sequence[str] = (), chunk: Chunk | None = None, out: str = "valid_to"
) -> DataFrame:
    """End each row where the key's next row starts; the last one is open.

    Rows of one instant give zero-length rows, in the order of ``tie``.
    """
    nxt = neighbour(df, key, [ts, *tie], {out: ts}, chunk, forward=True)
    return nxt.withColumn(out, F.coalesce(out, future().cast(df.schema[ts].dataType)))


def join_scd2(key: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """N-way timeline join.

    The slots are cut at every ``valid_from`` of any table.  A table gives its
    columns to a slot if one of its rows covers the whole slot; a row that
    closes inside a slot without a successor gives NULL for that slot.
    """
    parts = []
    for name, df in tables.items():
        cols = [c for c in df.columns if c != key]
        parts.append(
            df.where("valid_from < valid_to").select(key, "valid_from", F.struct(*cols).alias(f"__{name}"))
        )
    points = parts[0]
    for p in parts[1:]:
        points = points.unionByName(p, allowMissingColumns=True)
    structs = [f"__{n}" for n in tables]
    slots = points.groupBy(key, "valid_from").agg(*[F.max(s).alias(s) for s in structs])
    slots, at = cut(slots, [key], ["valid_from"], "__cut")
    timeline = with_valid_to(slots, [key], "valid_from", chunk=at)
    filled = fill_down(timeline, [key], ["valid_from"], {f"{s}_f": F.col(s) for s in structs}, at)
    out = [key, "valid_from", "valid_to", (F.col("valid_to") == future()).alias("is_current")]
    for name, df in tables.items():
        held = F.col(f"__{name}_f")
        covers = held["valid_to"] >= F.col("valid_to")
        out += [F.when(covers, held[c]).alias(c) for c in df.columns if c not in (key, "valid_from", "valid_to")]
    return filled.select(*out)


def join_snapshots(t1: DataFrame, t2: DataFrame, key: str, col: str) -> DataFrame:
    """Two-table timeline join that takes one column of the second table."""
    return join_scd2(key, {"a": t1, "b": t2.select(key, "valid_from", "valid_to", col)}).drop("is_current")


def _islands(df: DataFrame, key: Sequence[str], order: Sequence[str], starts: Column, look: dict):
    cols = df.columns
    df, at = cut(df, key, order, "__cut")
    prev = neighbour(df, key, order, {**look, "__has_prev": F.lit(True)}, at)
    flagged = prev.withColumn("__start", F.when(F.col("__has_prev").isNull() | starts, 1).otherwise(0))
    numbered = running(flagged, key, order, sums={"__island": F.col("__start").cast("long")}, chunk=at)
    return numbered.select(*cols, "__island")


def merge_islands(
    df: DataFrame, key: Sequence[str], state: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """Merge neighbouring rows of equal state into one row from the first start to the last end."""
    differs = F.lit(False)
    for s in state:
        differs = differs | ~F.col(s).eqNullSafe(F.col(f"__prev_{s}"))
    look = {f"__prev_{s}": s for s in state}
    rows = _islands(df, key, ["valid_from", *tie], differs, look)
    return (
        rows.groupBy(*key, *state, "__island")
        .agg(F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
        .drop("__island")
    )


def state_islands(df: DataFrame, key: Sequence[str], ts: str, state: str, tie: Sequence[str] = ()) -> DataFrame:
    """Events with a state to validity rows: one row per run of equal states, ended by the next run.

    Equal to :func:`with_valid_to` followed by :func:`merge_islands`, in one pass: the rows that open a run are kept, and
    each ends where the next of them starts.
    """
    order = [ts, *tie]
    rows, at = cut(df.select(*key, *order, F.col(state).alias("__s")), key, order, "__cut")
    prev = neighbour(rows, key, order, {"__prev": "__s", "__has_prev": F.lit(True)}, at)
    opens = prev.where(F.col("__has_prev").isNull() | ~F.col("__s").eqNullSafe(F.col("__prev"))).drop("__prev", "__has_prev")
    ended = neighbour(opens, key, order, {"valid_to": ts}, at, forward=True)
    end = F.coalesce("valid_to", future().cast(df.schema[ts].dataType))
    return ended.select(*key, F.col("__s").alias(state), F.col(ts).alias("valid_from"), end.alias("valid_to"))


def merge_contiguous(df: DataFrame, key: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Merge rows of equal state (part of the key) that touch: the next starts where the last ended."""
    gap = F.col("__prev_to") != F.col("valid_from")
    rows = _islands(df, [*key, *state], ["valid_from"], gap, {"__prev_to": "valid_to"})
    return (
        rows.groupBy(*key, *state, "__island")
        .agg(F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
        .drop("__island")
    )


def changes_only(
    df: DataFrame,
    key: Sequence[str],
    state: str,
    ts: str,
    tie: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """Rows whose state differs from the row before; first rows always stay.

    Without ``null_safe`` a change from or to NULL is not seen as a change.
    """
    prev = neighbour(df, key, [ts, *tie], {"__prev": state, "__has_prev": F.lit(True)})
    same = F.col(state).eqNullSafe(F.col("__prev")) if null_safe else F.coalesce(F.col(state) == F.col("__prev"), F.lit(True))
    return prev.where(F.col("__has_prev").isNull() | ~same).drop("__prev", "__has_prev")


def add_deletions(df: DataFrame, key: str, ts: str, state: str, deleted) -> DataFrame:
    """Add a terminal row one day after the last sight of entities missing from the latest snapshot."""
    last = df.groupBy(key).agg(F.max(ts).alias(ts))
    newest = df.agg(F.max(ts)).scalar()
    gone = last.where(F.col(ts) < newest).select(
        key,
        (F.col(ts) + F.expr("interval 1 day")).alias(ts),
        F.lit(deleted).cast(df.schema[state].dataType).alias(state),
    )
    return df.select(key, ts, state).unionByName(gone)


def clip_history(df: DataFrame, start: Column) -> DataFrame:
    """Drop intervals that end before ``start`` and let the others begin there at the earliest."""
    return df.where(F.col("valid_to") > start).withColumn("valid_from", F.greatest("valid_from", start))


def resolve_weak_source(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    product: str,
    variation: str,
    is_weak: Column,
) -> DataFrame:
    """A weak source that repeats the product of the last strong source takes that source's variation."""
    strong = F.when(~is_weak, F.struct(F.col(product).alias("p"), F.col(variation).alias("v")))
    held = fill_down(df, key, order, {"__strong": strong})
    repeats = is_weak & (F.col("__strong.p") == F.col(product))
    return held.withColumn("resolved", F.when(repeats, F.col("__strong.v")).otherwise(F.col(variation))).drop(
        "__strong"
    )


def backfill_start(df: DataFrame, key: Sequence[str], start: Column) -> DataFrame:
    """Let the earliest known row of each entity begin at the start of history, if that is earlier."""
    firsts = df.groupBy(*key).agg(F.min("valid_from").alias("__first"))
    return (
        df.join(firsts, list(key))
        .withColumn(
            "valid_from",
            F.when(F.col("valid_from") == F.col("__first"), F.least("valid_from", start)).otherwise(F.col("valid_from")),
        )
        .drop("__first")
    )


def version_diff(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per version, which columns differ from the version before (first versions: no change)."""
    look = {f"previous_{c}": c for c in cols} | {"__has_prev": F.lit(True)}
    prev = neighbour(df, key, ["valid_from"], look)
    flags = {
        f"{c}_changed": F.col("__has_prev").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"previous_{c}")) for c in cols
    }
    return prev.withColumns(flags).drop("__has_prev")


def _apply_snapshot(
    src: DataFrame, snap: DataFrame, key: str, changed: Column, since: Column, now: Column, hard_deletes: bool
) -> DataFrame:
    """One full join of the open rows with the source; each pair becomes the rows that it leaves behind."""
    cols = [c for c in src.columns if c != key]
    ts_type = snap.schema["valid_from"].dataType
    open_ = snap.where(F.col("valid_to") == future())
    closed = snap.where(F.col("valid_to") != future())
    old = open_.select(F.col(key).alias("__ok"), F.struct(*cols, "valid_from").alias("o"))
    new = src.select(F.col(key).alias("__nk"), F.struct(*cols).alias("n"))
    j = old.join(new, F.col("__ok") == F.col("__nk"), "full")
    row = lambda s, start, end: F.struct(
        *[F.col(f"{s}.{c}").alias(c) for c in cols],
        start.cast(ts_type).alias("valid_from"),
        end.cast(ts_type).alias("valid_to"),
    )
    kept = row("o", F.col("o.valid_from"), future())
    fresh = row("n", since, future())
    versions = (
        F.when(F.col("o").isNull(), F.array(fresh))
        .when(
            F.col("n").isNull(),
            F.array(row("o", F.col("o.valid_from"), now)) if hard_deletes else F.array(kept),
        )
        .when(changed, F.array(row("o", F.col("o.valid_from"), since), fresh))
        .otherwise(F.array(kept))
    )
    out = j.select(F.coalesce("__ok", "__nk").alias(key), F.explode(versions).alias("v")).select(key, "v.*")
    return closed.select(out.columns).unionByName(out)


def snapshot_timestamp(
    src: DataFrame, snap: DataFrame, key: str, ts: str, now: Column, hard_deletes: bool = False
) -> DataFrame:
    """Next state of a snapshot table: a source row with a newer timestamp closes the open row and opens one."""
    return _apply_snapshot(src, snap, key, F.col(f"n.{ts}") > F.col(f"o.{ts}"), F.col(f"n.{ts}"), now, hard_deletes)


def snapshot_check(
    src: DataFrame, snap: DataFrame, key: str, cols: Sequence[str], now: Column, hard_deletes: bool = False
) -> DataFrame:
    """Next state of a snapshot table: a change in any of ``cols`` opens a new version at ``now``."""
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    return _apply_snapshot(src, snap, key, differs, now, now, hard_deletes)


def current(df: DataFrame) -> DataFrame:
    return df.where(F.col("valid_to") == future())


def as_of_date(df: DataFrame, ts: Column) -> DataFrame:
    return df.where((F.col("valid_from") <= ts) & (ts < F.col("valid_to")))


def expand_periods(df: DataFrame, start: Column, end: Column, step: str = "1 day", out: str = "day") -> DataFrame:
    """One row per entity and period start in ``[start, end]`` at which the interval is valid.

    Each interval makes its own periods; history is never crossed with a calendar.
    ``start`` must itself be a period start.
    """
    days = 7 if "week" in step else 1
    # First period start that is not before valid_from.
    midnight = F.to_date("valid_from").cast(df.schema["valid_from"].dataType)
    lo = F.greatest(F.date_add(F.to_date("valid_from"), F.when(F.col("valid_from") > midnight, 1).otherwise(0)), start)
    ahead = F.pmod(-F.datediff(lo, start), F.lit(days))
    first = F.date_add(lo, ahead)
    end_midnight = F.to_date("valid_to").cast(df.schema["valid_to"].dataType)
    last_valid = F.date_sub(F.to_date("valid_to"), F.when(F.col("valid_to") > end_midnight, 0).otherwise(1))
    last = F.least(last_valid, end)
    grid = F.when(first <= last, F.sequence(first, last, F.expr(f"interval {days} days")))
    return df.withColumn(out, F.explode(grid))


def overlaps(df: DataFrame, key: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Rows that start before an earlier row of the same key has ended.

    The latest end seen so far is carried along, so rows are never paired.
    """
    order = ["valid_from", *tie]
    rows, at = cut(df, key, order, "__cut")
    upto = running(rows, key, order, maxes={"__max_to": F.col("valid_to")}, chunk=at)
    prev = neighbour(upto, key, order, {"latest_end_before": "__max_to"}, at)
    return prev.where(F.col("latest_end_before") > F.col("valid_from")).drop("__max_to", "__cut")


def derive_seasons(starts: DataFrame, key: str, start: str) -> DataFrame:
    """Seasons from start dates: numbered within the year, named ``YYYY Sn``, ended by the next start.

    A key has a handful of seasons per year, so plain windows are enough after the distinct.
    """
    distinct = starts.select(key, F.to_date(start).alias("valid_from")).distinct()
    in_year = Window.partitionBy(key, F.year("valid_from")).orderBy("valid_from")
    w = Window.partitionBy(key).orderBy("valid_from")
    return distinct.select(
        key,
        F.concat(F.year("valid_from"), F.lit(" S"), F.row_number().over(in_year)).alias("season"),
        "valid_from",
        F.coalesce(F.lead("valid_from").over(w), future().cast("date")).alias("valid_to"),
    )
