"""Null-out rules, swaps, lookups and money rebuilds, each leaving a flag or the old value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import is_close, out_of_range


@dataclass(frozen=True)
class RangeRule:
    """A present value outside [low, high] becomes null and is counted as ``metric``.

    ``positive`` makes the lower bound exclusive.
    """

    column: str
    low: float | None = None
    high: float | None = None
    metric: str | None = None
    positive: bool = False

    def broken(self) -> Column:
        value = F.col(self.column)
        bad = out_of_range(value, self.low, self.high)
        return bad | (value.isNotNull() & (value <= 0)) if self.positive else bad

    @property
    def flag(self) -> str:
        return f"_bad_{self.column}"


def flag_ranges(df: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    return df.select("*", *[rule.broken().alias(rule.flag) for rule in rules])


def null_out(df: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """Applies all rules in one projection and drops their flags."""
    broken = {rule.column: rule for rule in rules}
    flags = {rule.flag for rule in rules}
    return df.select(
        *[
            F.when(~F.col(broken[c].flag), F.col(c)).alias(c) if c in broken else F.col(c)
            for c in df.columns
            if c not in flags
        ]
    )


def swap_reversed(df: DataFrame, start: str, end: str, flag: str) -> DataFrame:
    """Ranges that end before they start are turned round and flagged."""
    swap = F.coalesce(F.col(end) < F.col(start), F.lit(False))
    return (
        df.withColumn("_swap", swap)
        .withColumns(
            {
                start: F.when(F.col("_swap"), F.col(end)).otherwise(F.col(start)),
                end: F.when(F.col("_swap"), F.col(start)).otherwise(F.col(end)),
                flag: F.col("_swap").cast("int"),
            }
        )
        .drop("_swap")
    )


def repair_from_lookup(
    df: DataFrame, column: str, key: str, lookup: DataFrame, value: str, flag: str
) -> DataFrame:
    """A missing or negative value takes the looked-up one where that is not negative."""
    side = lookup.select(key, F.col(value).alias("_found"))
    bad = F.col(column).isNull() | (F.col(column) < 0)
    usable = F.coalesce(bad & (F.col("_found") >= 0), F.lit(False))
    return (
        df.join(side, key, "left")
        .withColumn(flag, usable.cast("int"))
        .withColumn(column, F.when(F.col(flag) == 1, F.col("_found")).otherwise(F.col(column)))
        .select(*df.columns, flag)
    )


def recompute_product(
    df: DataFrame, total: str, left: str, right: str, original: str, flag: str
) -> DataFrame:
    """total := round(left * right, 2); flags rows whose old total was missing or not close."""
    expected = F.col(left) * F.col(right)
    return df.withColumns(
        {
            original: F.col(total),
            flag: (~is_close(F.col(total), expected)).cast("int"),
            total: F.round(expected, 2),
        }
    )


def rebuild_from_children(
    df: DataFrame, key: str, column: str, sums: DataFrame, child_sum: str, original: str, flag: str,
    authoritative: bool = True,
) -> DataFrame:
    """Parent amount := sum over its children where it has any; keeps the old amount.

    ``sums`` holds one row per key, so the join cannot multiply rows.
    """
    joined = df.join(sums, key, "left").withColumn(original, F.col(column))
    if not authoritative:
        return joined.withColumn(flag, F.lit(0))
    return joined.withColumn(flag, F.col(child_sum).isNotNull().cast("int")).withColumn(
        column, F.coalesce(F.col(child_sum), F.col(column))
    )


def rebuild_amount(
    df: DataFrame, amount: str, plus: Sequence[str], minus: Sequence[str], original: str, flag: str
) -> DataFrame:
    """amount := plus - minus when all parts are present and the result is not negative.

    A negative result empties the amount; rows with a missing part keep theirs. Adds booleans
    ``_mismatch`` and ``_impossible`` for the audit.
    """
    parts = [*plus, *minus]
    complete = F.lit(True)
    for part in parts:
        complete = complete & F.col(part).isNotNull()
    value = F.lit(0)
    for part in plus:
        value = value + F.col(part)
    for part in minus:
        value = value - F.col(part)
    expected, source = F.col("_expected"), F.col(original)
    return (
        df.withColumn("_expected", F.when(complete, value))
        .withColumn(original, F.col(amount))
        .withColumns(
            {
                flag: F.coalesce(expected >= 0, F.lit(False)).cast("int"),
                "_impossible": F.coalesce(expected < 0, F.lit(False)),
                "_mismatch": F.coalesce((expected >= 0) & ~is_close(source, expected), F.lit(False)),
                amount: F.when(expected >= 0, F.round(expected, 2))
                .when(expected < 0, F.lit(None))
                .otherwise(source),
            }
        )
        .drop("_expected")
    )


def recount_children(
    df: DataFrame, key: str, child: DataFrame, child_id: str, column: str, actual: str, original: str
) -> DataFrame:
    """column := number of distinct children (0 if none); ``_recount`` marks a changed value."""
    counts = child.groupBy(key).agg(F.count_distinct(child_id).alias(actual))
    joined = df.join(counts, key, "left")
    total = F.coalesce(F.col(actual), F.lit(0))
    return joined.withColumns(
        {
            actual: total,
            original: F.col(column),
            "_recount": F.coalesce(F.col(column), F.lit(-1)) != total,
            column: total,
        }
    )
