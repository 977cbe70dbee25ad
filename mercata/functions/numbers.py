"""Numeric helpers: parsing, tolerance, ratios with exact rounding, distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed import EARTH_RADIUS_KM, MONEY_TOLERANCE, RELATIVE_TOLERANCE

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def coerce_numeric(c: Column) -> Column:
    """Text to double; anything that is not a plain finite number becomes null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def coerce_whole(c: Column) -> Column:
    """Text to a whole number, exact over the whole range of long; fractions and other text become null.

    The digits go through decimal(38,10), never through double, which merges neighbours beyond 2^53.
    """
    near, exact = coerce_numeric(c), F.trim(c.cast("string")).try_cast("decimal(38,10)")
    return F.when((near == F.floor(near)) & (exact == F.floor(exact)), exact.try_cast("long"))


def coerce_decimal(c: Column, kind: str) -> Column:
    """Text to an exact decimal of type ``kind``, straight from its digits; other text, and numbers too large for it,
    become null."""
    return F.when(coerce_numeric(c).isNotNull(), F.trim(c.cast("string")).try_cast(kind))


def out_of_range(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """True where a present value lies outside the closed range."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return c.isNotNull() & bad


def is_close(actual: Column, expected: Column) -> Column:
    """|a-b| <= 0.01 + 1e-5*|b|; a missing side is never close."""
    gap = F.abs(actual.cast("double") - expected.cast("double"))
    allowed = F.lit(MONEY_TOLERANCE) + F.lit(RELATIVE_TOLERANCE) * F.abs(expected.cast("double"))
    return F.coalesce(gap <= allowed, F.lit(False))


def ratio(x: Column, y: Column) -> Column:
    """x / y as double, null where y is zero or missing."""
    return F.try_divide(x.cast("double"), y.cast("double"))


def ratio2(x: Column, y: Column) -> Column:
    """x / y rounded half up to 2 places in decimals, then shown as double.

    decimal(24,2) over decimal(13,0) keeps 16 fractional digits, so the rounding is exact for
    up to 10^13 rows and sums up to 10^22.
    """
    den = F.nullif(y, F.lit(0)).cast("decimal(13,0)")
    return F.round(x.cast("decimal(24,2)") / den, 2).cast("double")


def pct2(part: Column, whole: Column) -> Column:
    """Percentage with two places; null for an empty whole."""
    return ratio2(part.cast("decimal(20,0)") * 100, whole)


def average(c: Column) -> Column:
    """Mean as sum / count in double: the sum itself stays exact for integers and decimals."""
    return ratio(F.sum(c), F.count(c))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = (phi2 - phi1) / 2
    half_lon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_lon), 2)
    return 2 * F.lit(EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def change_pct2(new: Column, old: Column) -> Column:
    """Growth from old to new in percent with two places; null where old is zero or missing."""
    gain = ((new - old) * 100).cast("decimal(24,2)")
    return F.round(gain / F.nullif(old, F.lit(0)).cast("decimal(20,2)"), 2).cast("double")


def round2(c: Column) -> Column:
    """A non-negative double rounded half up to two places."""
    return F.floor(c * 100 + F.lit(0.5)).cast("double") / 100


def as_money(c: Column) -> Column:
    """An exact decimal sum shown as double."""
    return c.cast("decimal(28,2)").cast("double")
