"""Incremental customer counts and city KPIs on Structured Streaming.

Each micro-batch writes the absolute totals of the keys it touched under its own batch number,
replacing any earlier attempt of the same batch. Replays are therefore harmless, and the newest
row of every key is its current total. Nothing is written in place and no increment is applied
twice. The state is one row per key, kept on disk by RocksDB; there is no event time, hence no watermark.

Every ``FOLD_EVERY`` batches the totals so far are written as one version, and a pointer row names it once it is
whole. Readers take the newest version that a pointer names and the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

#: Batches between two versions. A reader looks into one version and fewer batches than this.
FOLD_EVERY = 50

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over a folder of part files, or over what a path with wildcards finds."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def customer_counts(orders: DataFrame) -> DataFrame:
    """Orders per customer; the same plan serves a stream and a batch."""
    return orders.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("TotalOrders"))


def city_sums(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Additive parts of the city KPIs; the static restaurants are joined to the stream."""
    located = orders.join(restaurants.select("RestaurantID", "City"), "RestaurantID")
    return located.groupBy("City").agg(
        F.count(F.lit(1)).alias("TotalOrders"), F.sum("FinalAmount").alias("_revenue"),
        F.sum("DeliveryTimeMinutes").alias("_minutes"), F.count("DeliveryTimeMinutes").alias("_timed"),
    )


def _sink(path: str, key: str | None = None, every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if key is not None and (batch_id + 1) % every == 0:
            fold(batch.sparkSession, path, key, batch.schema, batch_id)

    return write


def start(totals: DataFrame, path: str, checkpoint: str, key: str | None = None, every: int = FOLD_EVERY) -> StreamingQuery:
    """Processes what is available and stops; run it again to pick up newer files.

    With ``key``, the column that names a total, versions are written as the batches come.
    """
    spark = totals.sparkSession
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ON_DISK)  # a query keeps the settings that it starts with
    try:
        return (
            totals.writeStream.outputMode("update")
            .foreachBatch(_sink(path, key, every))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}_versions"


def folded(spark: SparkSession, path: str) -> int:
    """The last batch in the newest whole version; -1 without one."""
    try:
        pointers = spark.read.schema("upto long").parquet(f"{_versions(path)}/pointers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    newest = pointers.agg(F.max("upto")).first()[0]
    return -1 if newest is None else newest


def fold(spark: SparkSession, path: str, key: str, schema: T.StructType, upto: int) -> None:
    """Writes the totals after batch ``upto`` as a version, then its pointer; a version that exists is left alone."""
    if folded(spark, path) >= upto:
        return
    current(spark, path, key, schema, upto).write.mode("overwrite").parquet(f"{_versions(path)}/upto={upto}")
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{_versions(path)}/pointers")


def current(spark: SparkSession, path: str, key: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """The newest total of every key, or the one after batch ``upto``, which no version may have passed."""
    values = [f.name for f in schema.fields if f.name != key]
    versioned = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    last = folded(spark, path)
    if upto is not None and last > upto:
        raise ValueError(f"batch {upto} is already part of the version after batch {last}")
    versions = spark.read.schema(versioned).parquet(path).where(F.col("batch") > last)
    if upto is not None:
        versions = versions.where(F.col("batch") <= upto)
    if last >= 0:
        whole = spark.read.schema(schema).parquet(f"{_versions(path)}/upto={last}")
        versions = versions.unionByName(whole.withColumn("batch", F.lit(last).cast("long")))
    newest = versions.groupBy(key).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return newest.select(key, *[F.col(f"_v.{v}").alias(v) for v in values])


def compact(spark: SparkSession, path: str, key: str, schema: T.StructType, target: str) -> None:
    """Rewrites the current totals as one version, for a sink that has seen many batches."""
    current(spark, path, key, schema).write.mode("overwrite").parquet(f"{target}/batch=0")
