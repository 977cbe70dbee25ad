"""Flags and buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed import COMPLETED


def is_completed(status: Column, statuses=COMPLETED) -> Column:
    return status.isin(*statuses)


def present(c: Column) -> Column:
    """1 where a value exists."""
    return c.isNotNull().cast("int")


def mismatch_null_counts(a: Column, b: Column) -> Column:
    """1 where the sides differ or one of them is missing."""
    return F.coalesce(a != b, F.lit(True)).cast("int")


def mismatch_null_ignored(a: Column, b: Column) -> Column:
    """1 only where two present values differ."""
    return F.coalesce(a != b, F.lit(False)).cast("int")


def geo_bounds_flag(lat: Column, lon: Column) -> Column:
    """1 inside latitude 6..38 and longitude 68..98; missing coordinates give 0."""
    return F.coalesce(lat.between(6, 38) & lon.between(68, 98), F.lit(False)).cast("int")


def delivery_tier(minutes: Column) -> Column:
    return (
        F.when(minutes.isNull(), "Unknown")
        .when(minutes <= 20, "Fast")
        .when(minutes <= 40, "On Time")
        .when(minutes <= 60, "Delayed")
        .otherwise("Severely Delayed")
    )
