"""Changed-row export to an outside system and its sync bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, TimestampNTZType, TimestampType

from larder.functions.dates import epoch_seconds


def rows_to_sync(traits: DataFrame, status: DataFrame, key: str, since: Column) -> DataFrame:
    """Rows changed since their last sync or since ``since``, never synced, or whose last sync failed."""
    s = status.select(
        F.col(key).alias("__k"), F.col("last_sync_at").alias("__at"), F.col("last_sync_succeeded").alias("__ok")
    )
    joined = traits.join(s, traits[key] == F.col("__k"), "left")
    due = (
        (F.col("valid_from") >= F.col("__at"))
        | (F.col("valid_from") >= since)
        | F.col("__at").isNull()
        | (F.col("__ok") == F.lit(False))
    )
    return joined.where(due).select(*traits.columns)


def to_payload(df: DataFrame, id_col: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows as (id text, JSON attributes): timestamps as epoch seconds, booleans as text."""
    fields = []
    for f in df.schema.fields:
        if f.name == id_col or f.name in exclude:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = epoch_seconds(c)
        elif isinstance(f.dataType, BooleanType):
            c = F.initcap(c.cast("string"))
        fields.append(c.alias(f.name))
    return df.select(
        F.col(id_col).cast("string").alias(id_col),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("attributes"),
    )


def update_sync_status(status: DataFrame, synced: DataFrame, failed: DataFrame, key: str, at: Column) -> DataFrame:
    """Status table after a run: every key of the run at ``at``, failed keys with success off."""
    bad = failed.select(F.col(key).alias("__k")).distinct()
    run = synced.select(key).distinct()
    fresh = run.join(bad, run[key] == F.col("__k"), "left").select(
        key, at.alias("last_sync_at"), F.col("__k").isNull().alias("last_sync_succeeded")
    )
    return status.join(run, key, "left_anti").unionByName(fresh)
