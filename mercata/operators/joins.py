"""Size-checked broadcast, and lookups that spread rows without a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000
NULL_SALTS = 1024


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side whose counted ``rows`` stay within the limit for broadcast.

    Spark's own size estimate multiplies the sides of a join, so a small table that is itself a
    join looks huge to it. Beyond the limit the frame is left alone: Spark then shuffles both
    sides and AQE splits skewed partitions.
    """
    return F.broadcast(df) if rows <= limit else df


def lookup(df: DataFrame, side: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left join on equally named keys; ``side`` has at most one row per key.

    Rows with a missing key match nothing, yet a plain join sends all of them to one task. Here
    they are spread by a hash of the whole row, which a retried task reproduces.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = F.col(keys[0]).isNull()
    for key in keys[1:]:
        missing = missing | F.col(key).isNull()
    spread = F.when(missing, F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SALTS))).otherwise(F.lit(0).cast("long"))
    salted = df.withColumn("_salt", spread)
    return salted.join(side.withColumn("_salt", F.lit(0).cast("long")), [*keys, "_salt"], "left").drop("_salt")
