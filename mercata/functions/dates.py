"""Dates and times of day from mixed text, and calendar parts.

A time of day is an integer number of seconds since midnight; timestamps carry no zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import stripped

_SEP = r"[-./]"
_NUMERIC = rf"^(?:\d{{4}}{_SEP}\d{{1,2}}{_SEP}\d{{1,2}}|\d{{1,2}}{_SEP}\d{{1,2}}{_SEP}\d{{4}})$"

# Textual dates are brought to year-month-day by these replacements, each over what the one before it left.
_MONTHS = (
    "jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?", "sept?(?:ember)?",
    "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?",
)
_WEEKDAY = r"(?<![a-z])(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?(?![a-z])[.,]?\s*"
_HALF, _FULL = r"(?:0?[1-9]|1[0-2])", r"(?:[01]?\d|2[0-3])"
_TAIL = r":[0-5]\d(?::[0-5]\d(?:[.,]\d{1,9})?)?"
_CLOCK = rf"(?:{_HALF}(?:{_TAIL})?\s*[ap]m|{_FULL}{_TAIL})"
_ZONE = r"(?:\s*(?:z|utc|gmt|[+-]\d{2}(?::?\d{2})?))?"
_GAP, _SPLIT, _YEAR = r"[\s,./-]*", r"[\s./-]", r"(\d{4}|\d{2})"
_TO_YEAR_FIRST = (
    (r"(?<![a-z])([ap])\.m\.?", "$1m"),
    (r"(\d)(?:st|nd|rd|th)(?![a-z])", "$1"),
    (_WEEKDAY, ""),
    (rf"^({_CLOCK})[\s,]+(.+)$", "$2 $1"),
    (rf"(?:(?<=\d)t|[\s,]+){_CLOCK}{_ZONE}$", ""),
    (rf"^(\d{{8}})t?{_FULL}[0-5]\d(?:[0-5]\d)?{_ZONE}$", "$1"),
    *((rf"(?<![a-z]){name}(?![a-z])\.?", f"#{i:02d}") for i, name in enumerate(_MONTHS, 1)),
    (r"[\s,]+$", ""),
    # "=" marks what is in its final order, so that no later line takes it for another
    (rf"^(\d{{1,2}}){_GAP}#(\d\d){_GAP}{_YEAR}$", "=$3-$2-$1"),
    (rf"^#(\d\d){_GAP}(\d{{1,2}})[\s,./-]+{_YEAR}$", "=$3-$1-$2"),
    (rf"^(\d{{4}}){_GAP}#(\d\d){_GAP}(\d{{1,2}})$", "=$1-$2-$3"),
    (r"^#(\d\d)[\s,./-]+(\d{4})$", "=$2-$1-1"),
    (r"^(\d{4})[\s,./-]+#(\d\d)$", "=$1-$2-1"),
    (r"^(\d{4})(\d{2})(\d{2})$", "=$1-$2-$3"),
    (r"^(\d{4})[-/](\d{1,2})$", "=$1-$2-1"),
    (rf"^(\d{{4}}|3[2-9]|[4-9]\d){_SPLIT}(\d{{1,2}}){_SPLIT}(\d{{1,2}})$", "=$1-$2-$3"),
    (rf"^({_HALF}){_SPLIT}(\d{{1,2}}){_SPLIT}{_YEAR}$", "=$3-$1-$2"),
    (rf"^([12]\d|3[01]){_SPLIT}({_HALF}){_SPLIT}{_YEAR}$", "=$3-$2-$1"),
    # two-digit years up to 75 are of this century: a fixed bound, so that reruns agree in later years
    (r"^=([0-6]\d|7[0-5])-(\d{1,2}-\d{1,2})$", "=20$1-$2"),
    (r"^=(\d\d)-(\d{1,2}-\d{1,2})$", "=19$1-$2"),
)
TIME_FORMATS = ("H:mm", "H:mm:ss", "h:mm a", "h:mm:ss a", "h:mma", "h a", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")


def _built(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def textual_date(c: Column) -> Column:
    """The day named by free text, null where it names none.

    Read are: day, month name and year in any of their usual orders, with weekday, ordinals ("3rd") and commas; a month
    with its year (its first day); year-first numbers, plain or compact; and numbers with the year last, two digits
    included, month first unless only the other order is a date. A time of day may stand on either side, with fraction,
    AM or PM, and zone; it must exist on a clock but does not shift the day. Text without a year names no day.
    """
    text = F.lower(stripped(c.cast("string")))
    for pattern, form in _TO_YEAR_FIRST:
        text = F.regexp_replace(text, pattern, form)
    return F.try_to_date(F.regexp_extract(text, r"^=(\d{4}-\d{1,2}-\d{1,2})$", 1), "yyyy-M-d")


def parse_mixed_date(c: Column, day_first: bool = True) -> Column:
    """Struct ``(date, ambiguous, failed, format)`` of a text date of unknown layout.

    Year-first text is unambiguous. Year-last text is day-month when the first part exceeds 12,
    month-day when the second does, and otherwise follows the policy and is flagged. All other text is for
    ``textual_date``.
    """
    s = stripped(c.cast("string"))
    blank = s.isNull() | (s == "")
    numeric = s.rlike(_NUMERIC)
    parts = F.split(s, _SEP)
    one, two, three = (F.get(parts, i) for i in range(3))
    iso = numeric & (F.length(one) == 4)
    tail = numeric & ~iso
    a, b = one.try_cast("int"), two.try_cast("int")
    day_month, month_day = tail & (a > 12) & (b <= 12), tail & (b > 12) & (a <= 12)
    unclear = tail & (a <= 12) & (b <= 12)

    dmy, mdy, ymd = _built(three, two, one), _built(three, one, two), _built(one, two, three)
    other = textual_date(s)

    date = (
        F.when(blank, F.lit(None).cast("date"))
        .when(iso, ymd)
        .when(day_month, dmy)
        .when(month_day, mdy)
        .when(unclear, dmy if day_first else mdy)
        .otherwise(other)
    )
    label = (
        F.when(blank, "missing")
        .when(iso, "ymd")
        .when(day_month, "dmy")
        .when(month_day, "mdy")
        .when(unclear, "ambiguous_dmy_assumed" if day_first else "ambiguous_mdy_assumed")
        .when(other.isNotNull(), "fallback")
        .otherwise("failed")
    )
    return F.struct(
        date.alias("date"),
        F.coalesce(~blank & unclear, F.lit(False)).alias("ambiguous"),
        (~blank & date.isNull()).alias("failed"),
        label.alias("format"),
    )


def parse_time(c: Column) -> Column:
    """Mixed time-of-day text to seconds since midnight, null where it does not parse."""
    s = F.upper(stripped(c.cast("string")))
    s = F.when(s.rlike(":|[AP]M"), s)  # every format has one of them; trying them all on other text is slow
    ts = F.coalesce(*(F.try_to_timestamp(s, F.lit(f)) for f in TIME_FORMATS))
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def combine_date_time(date: Column, seconds: Column) -> Column:
    """Date plus seconds since midnight as a zone-free timestamp, null if either is missing."""
    return F.timestamp_add("SECOND", seconds, date.cast("timestamp_ntz"))


def time_part_columns(ts: Column) -> dict[str, Column]:
    """Hour, minute, day name, month, weekend and meal-time flags."""
    hour = F.hour(ts)
    return {
        "OrderHour": hour,
        "OrderMinute": F.minute(ts),
        "DayOfWeek": F.date_format(ts, "EEEE"),
        "Month": F.month(ts),
        "IsWeekend": F.weekday(ts).isin(5, 6).cast("int"),
        "IsLunch": hour.between(11, 14).cast("int"),
        "IsDinner": hour.between(18, 22).cast("int"),
    }


def tenure_days(later: Column, earlier: Column) -> Column:
    """Whole days between two dates, never below zero; null if a date is missing."""
    days = F.datediff(later, earlier)
    return F.when(days < 0, 0).otherwise(days)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, independent of the session zone."""
    since = ts - F.lit("1970-01-01").cast("timestamp_ntz")

    def part(name: str) -> Column:
        return F.extract(F.lit(name), since)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + F.round(part("SECOND").cast("double") * 1_000_000).cast("long")


def day_micros(date: Column, seconds: Column) -> Column:
    """``epoch_micros(combine_date_time(date, seconds))`` in plain integer arithmetic."""
    days = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86_400 + seconds) * 1_000_000
