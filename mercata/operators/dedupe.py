"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order; missing keys count as one key.

    ``row_number() == 1`` lets Catalyst place a group limit before the shuffle, so a key that
    holds a third of all rows sends one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_nth", F.row_number().over(window)).filter(F.col("_nth") == 1).drop("_nth")
    )


def keep_first_counted(df: DataFrame, keys: Sequence[str], order: Column, copies: str) -> DataFrame:
    """``keep_first`` that also adds how many rows shared the key, so that one pass over the input
    serves both the clean rows and the audit. ``order`` must never be null."""
    name = df.select(order).columns[0]
    others = [c for c in df.columns if c != name and c not in keys]
    # The order leads the row and is held once, as are the keys: rows of equal order are told apart by their columns.
    first = F.min(F.struct(order.alias("_order"), *others))
    named = {k: F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)}
    grouped = df.groupBy(*named.values()).agg(first.alias("_row"), F.count(F.lit(1)).alias(copies))
    held = {name: F.col("_row._order")} | {k: F.col(f"_key{i}") for i, k in enumerate(keys)}
    whole = [held.get(c, F.col("_row").getField(c)).alias(c) for c in df.columns]
    return grouped.select(*whole, copies)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
