"""Projections, scalar expressions and predicates (B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed import CITY_ALIASES
from ..functions import (
    clean_label, coerce_numeric, combine_date_time, delivery_tier, distance_km, geo_bounds_flag, is_completed,
    mismatch_null_counts, mismatch_null_ignored, month_start, normalize_city, parse_mixed_date, parse_time, present,
    ratio, tenure_days, time_part_columns,
)
from ..operators.repair import RangeRule, flag_ranges, null_out, swap_reversed
from .registry import DONE, money, query, ratio as sql_ratio
from .roles import Roles

_TITLE = (
    "array_to_string(list_transform(regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+'), "
    "lambda w: upper(w[1]) || lower(w[2:])), '')"
)
_ALIASES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CITY_ALIASES.items())


@query(
    "normalize_city",
    f"""WITH squeezed AS (SELECT CustomerID, nullif(trim(regexp_replace(CityText, '\\s+', ' ', 'g')), '') AS s FROM m_dirty_cities),
        titled AS (SELECT CustomerID, CASE WHEN s = lower(s) OR s = upper(s) THEN {_TITLE.format('s')} ELSE s END AS s FROM squeezed)
        SELECT CustomerID, CASE s {_ALIASES} ELSE s END AS City FROM titled""",
)
def q_normalize_city(t: Roles) -> DataFrame:
    return t.dirty_cities.select("CustomerID", normalize_city(F.col("CityText")).alias("City"))


@query("coerce_numeric", "SELECT OrderID, TRY_CAST(trim(NumberText) AS DOUBLE) AS value FROM m_dirty")
def q_coerce_numeric(t: Roles) -> DataFrame:
    return t.dirty.select("OrderID", coerce_numeric(F.col("NumberText")).alias("value"))


@query(
    "parse_mixed_dates",
    """WITH p AS (
         SELECT OrderID, trim(DateText) AS s, regexp_matches(trim(DateText), '^\\d{4}') AS iso,
                string_split_regex(trim(DateText), '[-./]') AS x FROM m_dirty),
       q AS (SELECT *, CAST(x[1] AS INT) AS a, CAST(x[2] AS INT) AS b, CAST(x[3] AS INT) AS c FROM p),
       k AS (SELECT *, CASE WHEN iso THEN 'ymd' WHEN a > 12 AND b <= 12 THEN 'dmy' WHEN b > 12 AND a <= 12 THEN 'mdy'
                            WHEN a <= 12 AND b <= 12 THEN 'ambiguous_dmy_assumed' ELSE 'failed' END AS label FROM q),
       d AS (SELECT *, CASE WHEN label = 'ymd' THEN TRY_CAST(printf('%04d-%02d-%02d', a, b, c) AS DATE)
                            WHEN label = 'mdy' THEN TRY_CAST(printf('%04d-%02d-%02d', c, a, b) AS DATE)
                            WHEN label <> 'failed' THEN TRY_CAST(printf('%04d-%02d-%02d', c, b, a) AS DATE) END AS day FROM k)
       SELECT OrderID, day AS parsed, label LIKE 'ambiguous%' AS ambiguous, day IS NULL AS failed, label AS format FROM d""",
)
def q_parse_mixed_dates(t: Roles) -> DataFrame:
    p = t.dirty.select("OrderID", parse_mixed_date(F.col("DateText")).alias("p"))
    return p.select("OrderID", F.col("p.date").alias("parsed"), "p.ambiguous", "p.failed", "p.format")


@query(
    "parse_times",
    """WITH x AS (SELECT OrderID, TimeText, string_split_regex(replace(TimeText, ' PM', ''), ':') AS p FROM m_dirty),
       y AS (SELECT *, TRY_CAST(p[1] AS BIGINT) AS h, TRY_CAST(p[2] AS BIGINT) AS m, coalesce(TRY_CAST(p[3] AS BIGINT), 0) AS s FROM x)
       SELECT OrderID, CASE WHEN TimeText LIKE '% PM' THEN ((h % 12 + 12) * 60 + m) * 60
                            WHEN h < 24 THEN (h * 60 + m) * 60 + s END AS seconds FROM y""",
)
def q_parse_times(t: Roles) -> DataFrame:
    return t.dirty.select("OrderID", parse_time(F.col("TimeText")).alias("seconds"))


@query(
    "clean_labels",
    f"SELECT OrderID, trim(LabelText) AS trimmed, {_TITLE.format('trim(LabelText)')} AS titled FROM m_dirty",
)
def q_clean_labels(t: Roles) -> DataFrame:
    label = F.col("LabelText")
    return t.dirty.select("OrderID", clean_label(label).alias("trimmed"), clean_label(label, title=True).alias("titled"))


_RULES = [RangeRule("Balance", low=0, metric="negative"), RangeRule("Age", 16, 70, "age")]


@query(
    "null_out_rules",
    """SELECT CustomerID, CASE WHEN Balance >= 0 THEN Balance END AS Balance,
              CASE WHEN Age BETWEEN 16 AND 70 THEN Age END AS Age FROM m_customers""",
)
def q_null_out(t: Roles) -> DataFrame:
    return null_out(flag_ranges(t.customers.select("CustomerID", "Balance", "Age"), _RULES), _RULES)


@query(
    "geo_bounds_flag",
    """SELECT c_custkey AS CustomerID, CAST(c_acctbal / 100 BETWEEN 6 AND 38 AND c_nationkey * 4 BETWEEN 68 AND 98 AS BIGINT)
       AS inside FROM customer""",
)
def q_geo(t: Roles) -> DataFrame:
    flag = geo_bounds_flag(F.col("c_acctbal") / 100, F.col("c_nationkey") * 4)
    return t.table("customer").select(F.col("c_custkey").alias("CustomerID"), flag.alias("inside"))


_LINE_DATES = """SELECT l_orderkey * 10 + l_linenumber AS id, CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b
                 FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


@query(
    "swap_reversed_ranges",
    f"""WITH d AS ({_LINE_DATES})
        SELECT id, least(a, b) AS StartDate, greatest(a, b) AS EndDate, CAST(b < a AS BIGINT) AS swapped FROM d""",
)
def q_swap(t: Roles) -> DataFrame:
    o = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("StartDate"))
    d = t.table("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "StartDate", F.col("l_shipdate").cast("date").alias("EndDate")
    )
    return swap_reversed(d, "StartDate", "EndDate", "swapped")


@query(
    "combine_date_time",
    """SELECT OrderID, CAST(OrderDate AS TIMESTAMP) + to_seconds(CAST(OrderTime AS BIGINT)) AS OrderTimestamp FROM m_order_heads""",
)
def q_combine(t: Roles) -> DataFrame:
    return t.order_heads.select("OrderID", combine_date_time(F.col("OrderDate"), F.col("OrderTime")).alias("OrderTimestamp"))


@query(
    "distance_km",
    """WITH p AS (SELECT c_custkey AS CustomerID, radians(c_acctbal / 200) AS a, radians(c_nationkey * 7.0) AS b,
                         radians(20.0) AS c, radians(77.0) AS d FROM customer),
       h AS (SELECT CustomerID, power(sin((c - a) / 2), 2) + cos(a) * cos(c) * power(sin((d - b) / 2), 2) AS h FROM p)
       SELECT CustomerID, round(2 * 6371.0088 * asin(sqrt(h)), 6) AS km FROM h""",
)
def q_distance(t: Roles) -> DataFrame:
    km = distance_km(F.col("c_acctbal") / 200, F.col("c_nationkey") * F.lit(7.0), F.lit(20.0), F.lit(77.0))
    return t.table("customer").select(F.col("c_custkey").alias("CustomerID"), F.round(km, 6).alias("km"))


@query(
    "time_parts",
    """WITH e AS (SELECT event_id, ts, hour(ts) AS h FROM events)
       SELECT event_id, h AS OrderHour, minute(ts) AS OrderMinute, dayname(ts) AS DayOfWeek, month(ts) AS Month,
              CAST(isodow(ts) IN (6, 7) AS BIGINT) AS IsWeekend, CAST(h BETWEEN 11 AND 14 AS BIGINT) AS IsLunch,
              CAST(h BETWEEN 18 AND 22 AS BIGINT) AS IsDinner FROM e""",
)
def q_time_parts(t: Roles) -> DataFrame:
    return t.table("events").select("event_id", *[c.alias(n) for n, c in time_part_columns(F.col("ts")).items()])


@query(
    "tenure_days",
    f"""WITH d AS ({_LINE_DATES}) SELECT id, greatest(datediff('day', a, b), 0) AS tenure FROM d""",
)
def q_tenure(t: Roles) -> DataFrame:
    o = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("a"))
    return t.table("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        tenure_days(F.col("l_shipdate").cast("date"), F.col("a")).alias("tenure"),
    )


@query(
    "safe_ratio",
    f"""SELECT OrderID, {sql_ratio('Discount * 100', 'FoodCost')} AS discount_pct,
               {sql_ratio('FoodCost', 'Discount')} AS per_discount, {sql_ratio('30 * DeliveryFee', 'DeliveryTimeRaw')} AS per_30
        FROM m_orders""",
)
def q_safe_ratio(t: Roles) -> DataFrame:
    return t.orders.select(
        "OrderID", ratio(F.col("Discount") * 100, F.col("FoodCost")).alias("discount_pct"),
        ratio(F.col("FoodCost"), F.col("Discount")).alias("per_discount"),
        ratio(F.col("DeliveryFee") * 30, F.col("DeliveryTimeRaw")).alias("per_30"),
    )


@query(
    "presence_flags",
    """WITH n AS (SELECT CustomerID, count(*) FILTER (WHERE OrderStatus <> 'Cancelled') AS n FROM m_order_heads GROUP BY CustomerID)
       SELECT c.CustomerID, CAST(n.n IS NOT NULL AS BIGINT) AS HasOrdered, CAST(coalesce(n.n, 0) >= 1 AS BIGINT) AS Eligible
       FROM m_customers c LEFT JOIN n ON n.CustomerID = c.CustomerID""",
)
def q_presence(t: Roles) -> DataFrame:
    n = t.order_heads.groupBy("CustomerID").agg(F.count_if(F.col("OrderStatus") != "Cancelled").alias("n"))
    return t.customers.select("CustomerID").join(n, "CustomerID", "left").select(
        "CustomerID", present(F.col("n")).alias("HasOrdered"), (F.coalesce("n", F.lit(0)) >= 1).cast("int").alias("Eligible")
    )


_CITY_PAIRS = """SELECT o.OrderID, r.City AS a, p.City AS b FROM m_orders o
                 LEFT JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID
                 LEFT JOIN m_partners p ON p.DeliveryPartnerID = o.DeliveryPartnerID"""


@query(
    "city_mismatch_flags",
    f"""WITH x AS ({_CITY_PAIRS})
        SELECT OrderID, CAST(coalesce(a <> b, TRUE) AS BIGINT) AS null_counts, CAST(coalesce(a <> b, FALSE) AS BIGINT) AS null_ignored
        FROM x""",
)
def q_mismatch(t: Roles) -> DataFrame:
    a = t.restaurants.select("RestaurantID", F.col("City").alias("a"))
    b = t.partners.select("DeliveryPartnerID", F.col("City").alias("b"))
    x = t.orders.select("OrderID", "RestaurantID", "DeliveryPartnerID").join(a, "RestaurantID", "left").join(b, "DeliveryPartnerID", "left")
    pair = F.col("a"), F.col("b")
    return x.select("OrderID", mismatch_null_counts(*pair).alias("null_counts"), mismatch_null_ignored(*pair).alias("null_ignored"))


@query(
    "delivery_tier",
    """SELECT OrderID, DeliveryTimeMinutes, CASE WHEN DeliveryTimeMinutes IS NULL THEN 'Unknown'
         WHEN DeliveryTimeMinutes > 60 THEN 'Severely Delayed' WHEN DeliveryTimeMinutes > 40 THEN 'Delayed'
         WHEN DeliveryTimeMinutes > 20 THEN 'On Time' ELSE 'Fast' END AS delivery_tier FROM m_orders""",
)
def q_tier(t: Roles) -> DataFrame:
    minutes = F.col("DeliveryTimeMinutes")
    return t.orders.select("OrderID", "DeliveryTimeMinutes", delivery_tier(minutes).alias("delivery_tier"))


@query(
    "status_flags",
    f"""SELECT OrderID, CAST({DONE} AS BIGINT) AS is_completed, CAST(OrderStatus = 'Delivered Late' AS BIGINT) AS is_late,
               CAST(OrderStatus = 'Cancelled' AS BIGINT) AS is_cancelled FROM m_order_heads""",
)
def q_status(t: Roles) -> DataFrame:
    s = F.col("OrderStatus")
    return t.order_heads.select(
        "OrderID", is_completed(s).cast("int").alias("is_completed"), (s == "Delivered Late").cast("int").alias("is_late"),
        (s == "Cancelled").cast("int").alias("is_cancelled"),
    )


@query(
    "date_functions",
    """SELECT OrderID, CAST(date_trunc('month', OrderDate) AS DATE) AS month_start, year(OrderDate) AS year_no,
              quarter(OrderDate) AS quarter_no, isodow(OrderDate) AS iso_day, dayname(OrderDate) AS day_name,
              datediff('day', OrderDate, DATE '2002-01-01') AS days_before, CAST(OrderDate - INTERVAL 6 MONTH AS DATE) AS half_year_ago
       FROM m_order_heads""",
)
def q_dates(t: Roles) -> DataFrame:
    d = F.col("OrderDate")
    return t.order_heads.select(
        "OrderID", month_start(d).alias("month_start"), F.year(d).alias("year_no"), F.quarter(d).alias("quarter_no"),
        (F.weekday(d) + 1).alias("iso_day"), F.date_format(d, "EEEE").alias("day_name"),
        F.datediff(F.lit("2002-01-01").cast("date"), d).alias("days_before"), F.add_months(d, -6).alias("half_year_ago"),
    )


@query(
    "numeric_null_functions",
    f"""SELECT CustomerID, floor(abs(Balance) * 100 + 0.5) / 100 AS rounded, least(Balance, 5000.0) AS capped,
               coalesce(nullif(Age, 0), -1) AS age_or_minus_one, CAST(CAST(Balance AS DECIMAL(12, 1)) AS DOUBLE) AS tenths,
               CAST(trunc(Balance) AS BIGINT) AS whole FROM m_customers""",
)
def q_numeric(t: Roles) -> DataFrame:
    b = F.col("Balance")
    return t.customers.select(
        "CustomerID", (F.floor(F.abs(b) * 100 + 0.5) / 100).alias("rounded"), F.least(b, F.lit(5000.0)).alias("capped"),
        F.coalesce(F.nullif(F.col("Age"), F.lit(0)), F.lit(-1)).alias("age_or_minus_one"),
        b.cast("decimal(12,1)").cast("double").alias("tenths"), b.cast("long").alias("whole"),
    )


@query(
    "predicates",
    f"""SELECT OrderID, OrderDate, {money('FinalAmount')} AS FinalAmount FROM m_orders
        WHERE OrderDate BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' AND OrderStatus IN ('Delivered', 'Cancelled')
          AND (FinalAmount >= 100000 OR CouponCode IS NULL) AND NOT PaymentMethod = '5-LOW'
          AND DeliveryTimeMinutes IS NOT NULL AND FinalAmount <> 0""",
)
def q_predicates(t: Roles) -> DataFrame:
    day, amount = F.col("OrderDate"), F.col("FinalAmount")
    start, end = (F.lit(x).cast("date") for x in ("1996-01-01", "1998-06-30"))
    return t.orders.filter(
        day.between(start, end) & F.col("OrderStatus").isin("Delivered", "Cancelled")
        & ((amount >= 100000) | F.col("CouponCode").isNull()) & ~(F.col("PaymentMethod") == "5-LOW")
        & F.col("DeliveryTimeMinutes").isNotNull() & (amount != 0)
    ).select("OrderID", "OrderDate", "FinalAmount")


@query(
    "project_rename",
    """SELECT RestaurantID AS entity_id, City AS RestaurantCity, 'Restaurant' AS entity_type, CAST(RestaurantID AS VARCHAR) AS id_text
       FROM m_restaurants""",
)
def q_project(t: Roles) -> DataFrame:
    return (
        t.restaurants.withColumnsRenamed({"RestaurantID": "entity_id", "City": "RestaurantCity"})
        .withColumns({"entity_type": F.lit("Restaurant"), "id_text": F.col("entity_id").cast("string")})
        .drop("Rating", "AverageCost", "Cuisine", "RestaurantName")
    )


@query(
    "fill_nulls",
    """SELECT OrderID, coalesce(CouponCode, 'none') AS CouponCode, coalesce(DeliveryTimeMinutes, -1) AS DeliveryTimeMinutes,
              coalesce(OrderTime, 0) AS OrderTime FROM m_orders""",
)
def q_fill(t: Roles) -> DataFrame:
    filled = t.orders.na.fill({"CouponCode": "none", "DeliveryTimeMinutes": -1, "OrderTime": 0})
    return filled.select("OrderID", "CouponCode", "DeliveryTimeMinutes", "OrderTime")
