"""Session settings, the shared checkpoint folder, and scratch paths under it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark removes the shuffle files of a query when the query ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mercata")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it would be
    invisible to the other machines, so there the setting is required.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="mercata-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once as parquet in the shared folder and read back (column pruning stays possible)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, label: str) -> DataFrame:
    """``stored`` for tables that take much disk: packed tightly, and the shuffle files of the run are removed as soon as
    the table is written, not whenever the driver happens to collect its garbage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
