"""Reading: full, projected, query-pushed and incremental loads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Source:
    """A system to load from: any Spark data source plus its options.

    ``Source("parquet", {"path": ...})`` in tests, ``Source("jdbc", {"url": ..., ...})`` on a cluster.
    For a large JDBC table pass ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` so
    that executors read it in parallel.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)


def read(spark: SparkSession, source: Source, table: str) -> DataFrame:
    options = dict(source.options)
    if source.format == "jdbc":
        return spark.read.format("jdbc").options(**options, dbtable=table).load()
    folder = options.pop("path").rstrip("/")
    return spark.read.format(source.format).options(**options).load(f"{folder}/{table}.{source.format}")


def read_query(spark: SparkSession, source: Source, table: str, where: str, cols: Sequence[str] = ("*",)) -> DataFrame:
    """Rows and columns selected in the source system; Spark pushes both into JDBC and parquet scans."""
    return read(spark, source, table).where(where).select(*cols)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL; DataFrames passed by name are visible as ``{name}``."""
    return spark.sql(query, **tables)


def read_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Column-projected read; the projection reaches the scan."""
    return df.select(*cols) if cols else df


def load_seed(spark: SparkSession, path: str, schema: StructType | str, sep: str = ";") -> DataFrame:
    """Reference table kept as a delimited text file with a header."""
    return spark.read.option("sep", sep).option("header", True).schema(schema).csv(path)


def lookback_start(sink: DataFrame | None, date_col: str, days: int = 45, first: str = "2015-01-01") -> Column:
    """Newest date in the sink minus ``days``; a fixed first date when there is no sink yet."""
    start = F.lit(first).cast("date")
    if sink is None:
        return start
    newest = sink.agg(F.date_sub(F.max(F.to_date(date_col)), days)).scalar()
    return F.coalesce(newest, start)


def changed_since(
    source: DataFrame,
    sink: DataFrame | None,
    date_col: str,
    days: int = 45,
    child: DataFrame | None = None,
    on: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Parent rows from the lookback date on, and the child rows that belong to them."""
    parents = source.where(F.to_date(date_col) >= lookback_start(sink, date_col, days))
    if child is None:
        return parents, None
    parent_key, child_key = on
    keys = parents.select(F.col(parent_key).alias("__key"))
    # Parent keys are unique, so the inner join of the source query is a semi join.
    return parents, child.join(keys, child[child_key] == F.col("__key"), "left_semi")
