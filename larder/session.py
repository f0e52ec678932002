"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that every plan in this package relies on.  All of them can
# be changed on a live session, so they also apply to a session made elsewhere.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A sort-merge join whose sides turn out to fit one partition each becomes a hash join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # As Spark has it: a join deals its sides by all of its keys, unless a job asks for ``join_where_dealt``.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("larder")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def join_where_dealt(spark: SparkSession) -> None:
    """Joins leave sides in place that are dealt alike by some of their keys, in plans run before the next ``configure``.

    For jobs whose frames are all dealt by one even key, such as the user.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by the keys over all shuffle partitions, whatever their size: what a key's rows grow into stays there."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``.  A session in one process
    may leave that unset and gets a local temporary folder; on a cluster, whose
    executors would each write to a disk of their own, that is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="larder-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame as written below the shared folder, for plans that read it more than once.

    The write's shuffle files go with it, as nothing reads them again.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)
