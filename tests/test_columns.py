from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercata.functions import (
    clean_label, coerce_numeric, combine_date_time, day_micros, distance_km, epoch_micros, geo_bounds_flag, is_close,
    mismatch_null_counts, mismatch_null_ignored, normalize_city, parse_mixed_date, parse_time, pct2, ratio2, tenure_days, textual_date,
)

DATES = [
    ("18/03/2024", True, date(2024, 3, 18), False, False, "dmy"),
    ("03/18/2024", True, date(2024, 3, 18), False, False, "mdy"),
    ("03/04/2024", True, date(2024, 4, 3), True, False, "ambiguous_dmy_assumed"),
    ("03/04/2024", False, date(2024, 3, 4), True, False, "ambiguous_mdy_assumed"),
    ("2024.3-5", True, date(2024, 3, 5), False, False, "ymd"),
    (" 2024/12/31 ", True, date(2024, 12, 31), False, False, "ymd"),
    ("2024-13-45", True, None, False, True, "ymd"),
    ("31/02/2024", True, None, False, True, "dmy"),
    ("02/31/2024", True, None, False, True, "mdy"),
    ("13/13/2024", True, None, False, True, "failed"),
    ("abc", True, None, False, True, "failed"),
    ("18 March 2024", True, date(2024, 3, 18), False, False, "fallback"),
    ("Mar 5, 2024", True, date(2024, 3, 5), False, False, "fallback"),
    (None, True, None, False, False, "missing"),
    ("   ", True, None, False, False, "missing"),
    ("12-11-2023", True, date(2023, 11, 12), True, False, "ambiguous_dmy_assumed"),
    ("06/28/2023", True, date(2023, 6, 28), False, False, "mdy"),
]


TEXTUAL = [
    "18 March 2024", "18 Mar 2024", "18-Mar-2024", "18/Mar/24", "18mar2024", "March 18, 2024", "March 18 2024", "Mar 18, 24", "2024-Mar-18",
    "2024 March 18", "Monday, 18 March 2024", "Mon 18 Mar 2024", "Mon, Mar 18, 2024", "18th March 2024", "March 3rd, 2024", "1st of May", "Sept 9, 2024",
    "20240318", "20240318T101112", "2024-03-18 10:11", "2024-03-18T10:11:12", "2024-03-18T10:11:12.345678", "2024-03-18T23:30:00Z",
    "2024-03-18 23:30:00+05:30", "2024-03-18T23:30:00.5-0800", "2024/03/18 10:11:12", "18 March 2024 10:30 PM", "March 18, 2024 5 pm",
    "10:30 18 March 2024", "10:30 PM March 18, 2024", "03/18/24", "18/03/24", "03/04/24", "99/03/18", "03/04/2024 10:30", "18/03/2024 10:30",
    "03/18/2024 1:05 PM", "12/31/75", "12/31/80", "March 2024", "2024-03", "18 March 2024 25:00", "18 March 2024 10:61", "31 Feb 2024", "32 March 2024",
    "Foo 18, 2024", "18 Marsh 2024", "hello 2024-03-18", "2024-02-30 10:00", "August 5 2024 10:00", "29 Feb 2023", "29 Feb 2024", "Sunday", "10:30",
]
# Text without a year or a day's name means "today" to pandas, and words are left over in others; both name no day here.
NO_DAY = {"1st of May", "Sunday", "10:30", "hello 2024-03-18"}


def test_textual_dates_agree_with_pandas(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTUAL)], "i int, v string")
    got = [r["d"] for r in df.select("i", textual_date(F.col("v")).alias("d")).orderBy("i").collect()]

    def want(text):
        if text in NO_DAY:
            return None
        try:
            return pd.to_datetime(text).normalize().date()
        except ValueError:
            return None

    assert dict(zip(TEXTUAL, got)) == {t: want(t) for t in TEXTUAL}


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


def test_mixed_dates(spark):
    for day_first in (True, False):
        cases = [c for c in DATES if c[1] is day_first]
        df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v string")
        rows = df.select("i", parse_mixed_date(F.col("v"), day_first).alias("p")).orderBy("i").collect()
        assert [tuple(r["p"]) for r in rows] == [c[2:] for c in cases]


@pytest.mark.parametrize(
    "text, want",
    [
        ("  new   delhi ", "Delhi"), ("BOMBAY", "Mumbai"), ("Bangalore", "Bengaluru"), ("McLeod Ganj", "McLeod Ganj"),
        ("   ", None), (None, None), ("new-delhi", "New-Delhi"), ("o'brien\tnagar", "O'Brien Nagar"), ("123", "123"),
    ],
)
def test_cities(spark, text, want):
    assert one(spark, text, normalize_city) == want


@pytest.mark.parametrize(
    "text, want",
    [(" 12.5 ", 12.5), ("-3", -3.0), ("1e3", 1000.0), ("1,234", None), ("nan", None), ("", None), (None, None), ("5d", None), (".5", 0.5)],
)
def test_numbers(spark, text, want):
    assert one(spark, text, coerce_numeric) == want


@pytest.mark.parametrize(
    "text, want",
    [("10:30", 37800), ("9:05 PM", 75900), ("9:05 pm", 75900), ("25:00", None), ("07:08:09", 25689), ("", None), ("noon", None)],
)
def test_times(spark, text, want):
    assert one(spark, text, parse_time) == want


def test_labels(spark):
    assert one(spark, "  delivered LATE ", lambda c: clean_label(c, title=True)) == "Delivered Late"
    assert one(spark, "  Gold ", clean_label) == "Gold"


def test_tolerance_has_a_relative_part(spark):
    df = spark.createDataFrame(
        [(1000.0, 1000.015), (1000.0, 1000.03), (0.0, 0.009), (0.0, 0.011), (None, 1.0)], "a double, b double"
    )
    assert [r[0] for r in df.select(is_close(F.col("a"), F.col("b"))).collect()] == [True, False, True, False, False]


def test_rounding_is_half_up_and_safe(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (5, 0), (201, 200)], "a long, b long")
    assert [r[0] for r in df.select(pct2(F.col("a"), F.col("b"))).collect()] == [0.13, 33.33, None, 100.5]
    assert [r[0] for r in df.select(ratio2(F.col("a"), F.col("b"))).collect()] == [0.0, 0.33, None, 1.01]


def test_mismatch_variants(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", None), (None, None)], "x string, y string")
    pair = F.col("x"), F.col("y")
    rows = df.select(mismatch_null_counts(*pair), mismatch_null_ignored(*pair)).collect()
    assert [tuple(r) for r in rows] == [(1, 1), (0, 0), (1, 0), (1, 0)]


def test_bounds_distance_tenure(spark):
    df = spark.createDataFrame([(20.0, 77.0), (5.9, 77.0), (None, 77.0)], "a double, b double")
    assert [r[0] for r in df.select(geo_bounds_flag(F.col("a"), F.col("b"))).collect()] == [1, 0, 0]
    km = df.limit(1).select(distance_km(F.lit(19.0760), F.lit(72.8777), F.lit(28.7041), F.lit(77.1025))).first()[0]
    assert 1150 < km < 1166
    days = spark.createDataFrame([(date(2024, 1, 5), date(2024, 1, 1)), (date(2024, 1, 1), date(2024, 1, 5)), (None, date(2024, 1, 1))], "x date, y date")
    assert [r[0] for r in days.select(tenure_days(F.col("x"), F.col("y"))).collect()] == [4, 0, None]


def test_time_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame([(date(2024, 3, 31), 9000), (date(1969, 12, 31), 1), (date(2024, 3, 31), None)], "d date, s int")
        ts = combine_date_time(F.col("d"), F.col("s"))
        rows = df.select(ts.alias("t"), epoch_micros(ts).alias("m"), day_micros(F.col("d"), F.col("s")).alias("k")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows[0]["t"] == datetime(2024, 3, 31, 2, 30)
    base = datetime(1970, 1, 1)
    for row in rows[:2]:
        assert row["m"] == row["k"] == round((row["t"] - base).total_seconds() * 1e6)
    assert rows[2]["t"] is None and rows[2]["m"] is None and rows[2]["k"] is None
