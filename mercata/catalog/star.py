"""The twelve tables of the star, whole, from the role tables, with their SQL; and the rule lists as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.cleaning import dated
from ..plans.domain import _BETWEEN, _NOT_NEGATIVE, _REQUIRED, CODE_REFERENCES, KEYS, LOAD_ORDER, REFERENCES, UNIQUE
from .registry import pct2
from .roles import Roles

#: Columns that rules ask for and the data lacks, null in both engines.
_LACKING = {
    "cities": {"Population": "bigint"}, "customers": {"TotalOrders": "double"}, "delivery_partners": {"Age": "double"},
    "promotions": {"StartDate": "date", "EndDate": "date"}, "customer_feedback": {"FoodRating": "double"},
}

_AMBIGUOUS = "length(x[1]) <= 2 AND CAST(x[1] AS INT) <= 12 AND CAST(x[2] AS INT) <= 12"

_ROLE_OF = {
    "cities": "m_cities", "customers": "m_customers", "restaurants": "m_restaurants", "delivery_partners": "m_partners", "promotions": "m_promotions",
    "menu": "m_menu", "orders": "m_orders", "order_items": "m_items", "payments": "m_payments", "traffic": "m_traffic",
    "customer_feedback": "(SELECT OrderID * 10 + DeliveryRating AS FeedbackID, * FROM m_feedback)",
    "weather": """(SELECT l_orderkey * 10 + l_linenumber AS WeatherID, n_name AS City, CAST(l_shipdate AS DATE) AS Date,
                   CAST(l_linenumber AS BIGINT) AS Humidity, l_returnflag AS WeatherCondition
                   FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)""",
}

#: The twelve tables as common table expressions ``s_<table>``.
STAR_SQL = ", ".join(
    f"s_{name} AS (SELECT *{''.join(f', CAST(NULL AS {kind}) AS {c}' for c, kind in _LACKING.get(name, {}).items())} FROM {_ROLE_OF[name]})"
    for name in LOAD_ORDER
)


def star(t: Roles) -> dict[str, DataFrame]:
    """The twelve tables with every key and every column that a rule asks for."""
    weather = t._shipped.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("WeatherID"), F.col("n_name").alias("City"),
        F.col("l_shipdate").cast("date").alias("Date"), F.col("l_linenumber").cast("long").alias("Humidity"), F.col("l_returnflag").alias("WeatherCondition"),
    )
    tables = {
        "cities": t.cities, "customers": t.customers, "restaurants": t.restaurants, "delivery_partners": t.partners, "promotions": t.promotions,
        "menu": t.menu, "orders": t.orders, "order_items": t.items, "payments": t.payments, "weather": weather, "traffic": t.traffic,
        "customer_feedback": t.feedback.withColumn("FeedbackID", F.col("OrderID") * 10 + F.col("DeliveryRating")),
    }
    return {
        name: tables[name].withColumns({c: F.lit(None).cast(kind) for c, kind in _LACKING.get(name, {}).items()}) if name in _LACKING else tables[name]
        for name in LOAD_ORDER
    }


def flagged_star(t: Roles) -> dict[str, DataFrame]:
    """The star whose orders carry the flag of an ambiguous date text."""
    tables = star(t)
    flags = dated(t.dirty, "DateText", "OrderDate").select("OrderID", "OrderDateAmbiguousFlag")
    return {**tables, "orders": tables["orders"].join(flags, "OrderID", "left")}


def rows_sql(rows: list[tuple[str, str, str]]) -> str:
    """(check, SQL of the number of bad rows with its FROM, words) as rows of check, passed, detail."""
    counts = " UNION ALL ".join(f"""SELECT '{name}' AS "check", '{words}' AS words, {bad}""" for name, bad, words in rows)
    return f"""SELECT "check", bad = 0 AS passed, words || CAST(bad AS VARCHAR) AS detail FROM ({counts})"""


def _lost(child: str, column: str, parent: str, key: str, and_: str = "") -> str:
    return f"count(*) FILTER (WHERE p.k IS NULL{and_}) AS bad FROM s_{child} c LEFT JOIN (SELECT DISTINCT {key} AS k FROM s_{parent}) p ON p.k = c.{column}"


KEY_ROWS = [(f"{n}.pk_unique", f"count(*) - count(DISTINCT {KEYS[n]}) AS bad FROM s_{n}", f"duplicate {KEYS[n]} rows=") for n in LOAD_ORDER]
REFERENCE_ROWS = [(f"fk.{c}.{col}", _lost(c, col, parent, key), "orphan rows=") for c, col, parent, key in REFERENCES]


def _rules(table: str) -> dict[str, str]:
    rules = {f"{c}_present": f"{c} IS NOT NULL" for c in _REQUIRED.get(table, "").split()}
    rules |= {f"{c}_not_negative": f"{c} >= 0" for c in _NOT_NEGATIVE.get(table, "").split()}
    rules |= {f"{c}_in_range": f"{c} BETWEEN {low} AND {high}" for c, (low, high) in _BETWEEN.get(table, {}).items()}
    extra = {"cities": ("Population_positive", "Population > 0"), "order_items": ("Quantity_positive", "Quantity > 0"),
             "promotions": ("EndDate_not_before_start", "EndDate >= StartDate")}
    return rules | dict([extra[table]] if table in extra else [])


SCHEMA_ROWS = [
    *[(f"{n}.{name}", f"count(*) FILTER (WHERE NOT ({rule})) AS bad FROM s_{n}", "broken rows=") for n in LOAD_ORDER for name, rule in _rules(n).items()],
    *[(f"{n}.{c}_unique", f"count({c}) - count(DISTINCT {c}) AS bad FROM s_{n}", "duplicate rows=") for n, (c,) in UNIQUE.items()],
    *[(f"fk.{c}.{col}", _lost(c, col, parent, key, f" AND c.{col} IS NOT NULL"), "orphan rows=") for c, col, parent, key in CODE_REFERENCES],
]

WARNINGS_SQL = f"""
    SELECT 'cross_city_order_relationships' AS name, {pct2("count(*) FILTER (WHERE coalesce(a <> b, TRUE) OR coalesce(b <> d, TRUE))", "count(*)")} AS value
    FROM (SELECT c.City AS a, r.City AS b, p.City AS d FROM s_orders o LEFT JOIN s_customers c ON c.CustomerID = o.CustomerID
          LEFT JOIN s_restaurants r ON r.RestaurantID = o.RestaurantID LEFT JOIN s_delivery_partners p ON p.DeliveryPartnerID = o.DeliveryPartnerID)
    UNION ALL SELECT 'ambiguous_order_dates', CAST(count(*) FILTER (WHERE {_AMBIGUOUS}) AS DOUBLE)
    FROM (SELECT string_split_regex(trim(DateText), '[-./]') AS x FROM m_dirty)"""


def checks_sql(rows: list[tuple[str, str, str]]) -> str:
    return f"WITH {STAR_SQL} {rows_sql(rows)}"



#: What the published star shows of each table: a name and an amount beside the key.
SHOWN = {
    "cities": ("City", None), "customers": ("City", "Age"), "restaurants": ("Cuisine", "AverageCost"), "delivery_partners": ("VehicleType", "Rating"),
    "promotions": ("CouponCode", "DiscountPercentage"), "menu": ("FoodName", "Price"), "orders": ("OrderStatus", "FinalAmount"),
    "order_items": (None, "TotalPrice"), "payments": ("PaymentStatus", None), "customer_feedback": (None, "CustomerRating"),
    "weather": ("WeatherCondition", "Humidity"), "traffic": ("TrafficLevel", "AverageSpeed"),
}

SHOWN_SQL = f"WITH {STAR_SQL} " + " UNION ALL ".join(
    f"""SELECT '{n}' AS "table", {KEYS[n]} AS id, {label or 'CAST(NULL AS VARCHAR)'} AS label, CAST({amount or 'NULL'} AS DOUBLE) AS amount FROM s_{n}"""
    for n, (label, amount) in SHOWN.items()
)


def shown(name: str, df: DataFrame) -> DataFrame:
    label, amount = SHOWN[name]
    return df.select(
        F.lit(name).alias("table"), F.col(KEYS[name]).cast("long").alias("id"), (F.col(label) if label else F.lit(None)).cast("string").alias("label"),
        (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"),
    )

