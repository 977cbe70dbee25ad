"""Joins, sets, aggregates, windows, sorts (D to G) that no business query already covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import average, is_completed, ratio
from ..operators.aggregates import basket, daily_conditions, histogram, value_counts
from ..operators.asof import asof_nearest
from ..operators.integrity import children, orphans
from ..operators.ordering import by_range, global_position
from ..plans import kpis
from ..plans.features import delivered_orders, prior_history
from .cleaning_queries import _FIRST_ITEMS, first_items
from .registry import DONE, money, query, ratio as sql_ratio
from .roles import Roles


@query(
    "join_inner",
    f"""SELECT o.OrderID, c.Name, r.RestaurantName, {money('o.FinalAmount')} AS FinalAmount FROM m_orders o
        JOIN m_customers c ON c.CustomerID = o.CustomerID JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID""",
)
def q_inner(t: Roles) -> DataFrame:
    joined = t.orders.join(t.customers.select("CustomerID", "Name"), "CustomerID").join(
        t.restaurants.select("RestaurantID", "RestaurantName"), "RestaurantID"
    )
    return joined.select("OrderID", "Name", "RestaurantName", "FinalAmount")


@query(
    "join_left",
    f"""SELECT c.CustomerID, count(o.OrderID) AS orders, {money('sum(o.FinalAmount)')} AS spend FROM m_customers c
        LEFT JOIN m_order_heads o ON o.CustomerID = c.CustomerID AND o.OrderStatus = 'Cancelled' GROUP BY c.CustomerID""",
)
def q_left(t: Roles) -> DataFrame:
    sums = t.order_heads.filter(F.col("OrderStatus") == "Cancelled").groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("n"), F.sum("FinalAmount").alias("spend")
    )
    return t.customers.select("CustomerID").join(sums, "CustomerID", "left").select(
        "CustomerID", F.coalesce("n", F.lit(0)).alias("orders"), "spend"
    )


@query(
    "join_right",
    f"""SELECT p.PaymentID, p.OrderID, p.PaymentStatus, {money('o.FinalAmount')} AS FinalAmount, o.OrderStatus
        FROM (SELECT * FROM m_order_heads WHERE OrderStatus <> 'Cancelled') o RIGHT JOIN m_payments p ON p.OrderID = o.OrderID""",
)
def q_right(t: Roles) -> DataFrame:
    return kpis.payments_with_orders(t.order_heads.filter(F.col("OrderStatus") != "Cancelled"), t.payments)


@query(
    "join_composite",
    """WITH w AS (SELECT City, Date, count(*) AS n, count(*) FILTER (WHERE WeatherCondition = 'R') AS r FROM m_weather GROUP BY City, Date)
       SELECT o.OrderID, w.n AS readings, w.r AS returned FROM m_orders o JOIN m_restaurants s ON s.RestaurantID = o.RestaurantID
       JOIN w ON w.City = s.City AND w.Date = o.OrderDate""",
)
def q_composite(t: Roles) -> DataFrame:
    days = t.weather.groupBy("City", "Date").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("WeatherCondition") == "R").alias("returned")
    )
    located = t.orders.join(t.restaurants.select("RestaurantID", "City"), "RestaurantID")
    return located.join(days.withColumnRenamed("Date", "OrderDate"), ["City", "OrderDate"]).select("OrderID", "readings", "returned")


@query(
    "join_semi_anti",
    """SELECT CustomerID, CASE WHEN CustomerID IN (SELECT CustomerID FROM m_order_heads WHERE OrderDate >= DATE '2001-01-01')
                               THEN 'active' ELSE 'idle' END AS side FROM m_customers""",
)
def q_semi_anti(t: Roles) -> DataFrame:
    recent = t.order_heads.filter(F.col("OrderDate") >= F.lit("2001-01-01").cast("date"))
    ids = t.customers.select("CustomerID")
    active = children(ids, "CustomerID", recent, "CustomerID").withColumn("side", F.lit("active"))
    return active.union(orphans(ids, "CustomerID", recent, "CustomerID").withColumn("side", F.lit("idle")))


_ASOF = """
    WITH l AS (SELECT event_id, user_id % 10 AS city, ts, value FROM events WHERE event_type = 'purchase'),
    r AS (SELECT event_id AS rid, user_id % 10 AS city, ts, value FROM events WHERE event_type = 'view'),
    p AS (SELECT l.event_id, r.value AS seen, r.rid, abs(date_diff('microsecond', r.ts, l.ts)) AS gap, r.ts > l.ts AS later
          FROM l JOIN r ON r.city = l.city AND r.ts BETWEEN l.ts - INTERVAL 90 MINUTE AND l.ts + INTERVAL 90 MINUTE{extra}),
    k AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap, later, CASE WHEN later THEN rid ELSE -rid END) AS n FROM p)
    SELECT l.event_id, l.city, k.seen, k.rid, CAST(k.gap AS DOUBLE) / 60000000.0 AS TimeDeltaMinutes
    FROM l LEFT JOIN k ON k.event_id = l.event_id AND k.n = 1"""


def _asof(t: Roles, direction: str) -> DataFrame:
    e = t.table("events").withColumn("city", F.col("user_id") % 10)
    left = e.filter(F.col("event_type") == "purchase").select("event_id", "city", F.col("ts").alias("at"))
    right = e.filter(F.col("event_type") == "view").select(F.col("event_id").alias("rid"), "city", F.col("ts").alias("seen_at"), F.col("value").alias("seen"))
    return asof_nearest(left, right, "city", "at", "seen_at", ["seen", "rid"], "rid", 5400, direction).drop("at")


@query("asof_nearest", _ASOF.format(extra=""))
def q_asof(t: Roles) -> DataFrame:
    return _asof(t, "nearest")


@query("asof_backward", _ASOF.format(extra=" AND r.ts <= l.ts"))
def q_asof_backward(t: Roles) -> DataFrame:
    return _asof(t, "backward")


_DAILY = f"""SELECT City, Date, {sql_ratio('sum(Temperature)', 'count(Temperature)')} AS Temperature,
                    {sql_ratio('sum(Rainfall)', 'count(Rainfall)')} AS Rainfall, {sql_ratio('sum(Humidity)', 'count(Humidity)')} AS Humidity
             FROM m_weather GROUP BY City, Date"""
_LABEL = """SELECT City, Date, WeatherCondition FROM (
              SELECT City, Date, WeatherCondition, row_number() OVER (PARTITION BY City, Date ORDER BY count(*) DESC, WeatherCondition) AS n
              FROM m_weather GROUP BY City, Date, WeatherCondition) WHERE n = 1"""


def daily(t: Roles) -> DataFrame:
    return daily_conditions(t.weather, ["City", "Date"], ["Temperature", "Rainfall", "Humidity"], "WeatherCondition")


@query("daily_conditions", f"WITH d AS ({_DAILY}), k AS ({_LABEL}) SELECT * FROM d JOIN k USING (City, Date)")
def q_daily(t: Roles) -> DataFrame:
    return daily(t)


@query(
    "join_daily_lookup",
    f"""WITH d AS ({_DAILY}), k AS ({_LABEL})
        SELECT o.OrderID, d.Temperature, d.Rainfall, d.Humidity, k.WeatherCondition FROM m_orders o
        LEFT JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID LEFT JOIN d ON d.City = r.City AND d.Date = o.OrderDate
        LEFT JOIN k ON k.City = r.City AND k.Date = o.OrderDate""",
)
def q_daily_lookup(t: Roles) -> DataFrame:
    located = t.orders.select("OrderID", "RestaurantID", F.col("OrderDate").alias("Date")).join(
        t.restaurants.select("RestaurantID", "City"), "RestaurantID", "left"
    )
    return located.join(daily(t), ["City", "Date"], "left").select("OrderID", "Temperature", "Rainfall", "Humidity", "WeatherCondition")


@query(
    "union_all_frames",
    f"""SELECT OrderID, {money('FinalAmount')} AS amount, OrderStatus AS kind FROM m_order_heads
        UNION ALL SELECT OrderID, CAST(DeliveryRating AS DOUBLE), 'feedback' FROM m_feedback""",
)
def q_union_all(t: Roles) -> DataFrame:
    a = t.order_heads.select("OrderID", F.col("FinalAmount").cast("double").alias("amount"), F.col("OrderStatus").alias("kind"))
    b = t.feedback.select(F.lit("feedback").alias("kind"), "OrderID", F.col("DeliveryRating").cast("double").alias("amount"))
    return a.unionByName(b)


@query(
    "agg_basic",
    f"""SELECT OrderStatus, PaymentMethod, count(*) AS n, count(OrderTime) AS timed, {money('sum(FinalAmount)')} AS total,
               {sql_ratio('sum(FinalAmount)', 'count(FinalAmount)')} AS mean, {money('min(FinalAmount)')} AS low,
               {money('max(FinalAmount)')} AS high, min(OrderDate) AS first_day FROM m_order_heads GROUP BY ALL""",
)
def q_agg_basic(t: Roles) -> DataFrame:
    amount = F.col("FinalAmount")
    return t.order_heads.groupBy("OrderStatus", "PaymentMethod").agg(
        F.count(F.lit(1)).alias("n"), F.count("OrderTime").alias("timed"), F.sum(amount).alias("total"),
        average(amount).alias("mean"), F.min(amount).alias("low"), F.max(amount).alias("high"), F.min("OrderDate").alias("first_day"),
    )


@query(
    "agg_filter",
    f"""SELECT PaymentMethod, count(*) FILTER (WHERE {DONE}) AS done, {money("sum(FinalAmount) FILTER (WHERE OrderStatus = 'Cancelled')")} AS lost,
               {sql_ratio("sum(OrderTime) FILTER (WHERE OrderDate >= DATE '2000-01-01')", "count(OrderTime) FILTER (WHERE OrderDate >= DATE '2000-01-01')")} AS late_time
        FROM m_order_heads GROUP BY PaymentMethod""",
)
def q_agg_filter(t: Roles) -> DataFrame:
    status, late = F.col("OrderStatus"), F.col("OrderDate") >= F.lit("2000-01-01").cast("date")
    return t.order_heads.groupBy("PaymentMethod").agg(
        F.count_if(is_completed(status)).alias("done"), F.sum(F.when(status == "Cancelled", F.col("FinalAmount"))).alias("lost"),
        average(F.when(late, F.col("OrderTime"))).alias("late_time"),
    )


@query(
    "agg_distinct",
    f"""SELECT RestaurantID, count(DISTINCT CustomerID) AS customers, count(DISTINCT CouponCode) AS coupons,
               count(DISTINCT CustomerID) FILTER (WHERE {DONE}) AS served FROM m_orders GROUP BY RestaurantID""",
)
def q_agg_distinct(t: Roles) -> DataFrame:
    return t.orders.groupBy("RestaurantID").agg(
        F.count_distinct("CustomerID").alias("customers"), F.count_distinct("CouponCode").alias("coupons"),
        F.count_distinct(F.when(is_completed(F.col("OrderStatus")), F.col("CustomerID"))).alias("served"),
    )


@query(
    "basket_features",
    f"""WITH f AS ({_FIRST_ITEMS}), x AS (SELECT f.*, m.PreparationTime AS p, m.Category, m.Calories AS c FROM f LEFT JOIN m_menu m ON m.FoodItemID = f.FoodItemID)
        SELECT OrderID, count(*) AS ItemLines, CAST(sum(Quantity) AS BIGINT) AS TotalQuantity, {money('sum(TotalPrice)')} AS BasketItemValue,
               {sql_ratio('sum(UnitPrice)', 'count(UnitPrice)')} AS AvgUnitPrice, max(p) AS MaxPrepTime, {sql_ratio('sum(p)', 'count(p)')} AS MeanPrepTime,
               CAST(coalesce(sum(Quantity * c), 0) AS BIGINT) AS WeightedCalories, count(DISTINCT Category) AS MenuCategoryCount,
               {sql_ratio('coalesce(sum(Quantity * p), 0)', 'sum(Quantity)')} AS WeightedPrepTime FROM x GROUP BY OrderID""",
)
def q_basket(t: Roles) -> DataFrame:
    return basket(first_items(t), t.menu)


@query(
    "rate_by_group",
    f"""SELECT CustomerID, {sql_ratio("count(*) FILTER (WHERE OrderStatus = 'Cancelled')", "count(*)")} AS cancel_rate,
               {sql_ratio("count(*) FILTER (WHERE OrderStatus = 'Delivered Late')", "count(*)")} AS late_rate FROM m_order_heads GROUP BY CustomerID""",
)
def q_rate(t: Roles) -> DataFrame:
    n, status = F.count(F.lit(1)), F.col("OrderStatus")
    return t.order_heads.groupBy("CustomerID").agg(
        ratio(F.count_if(status == "Cancelled"), n).alias("cancel_rate"), ratio(F.count_if(status == "Delivered Late"), n).alias("late_rate")
    )


@query("value_counts", "SELECT PaymentMethod, count(*) AS rows FROM m_order_heads GROUP BY PaymentMethod")
def q_value_counts(t: Roles) -> DataFrame:
    return value_counts(t.order_heads, "PaymentMethod")


def histogram_sql(table: str, column: str, bins: int, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""WITH s AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {table}),
        b AS (SELECT {lead}lo, (hi - lo) / {bins} AS w, least(CAST(floor(({column} - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS bin
              FROM {table} JOIN s ON TRUE WHERE {column} IS NOT NULL)
        SELECT {lead}bin, lo + bin * w AS bin_start, count(*) AS rows FROM b GROUP BY ALL"""


@query("histogram", histogram_sql("m_orders", "DeliveryTimeMinutes", 45, "OrderStatus"))
def q_histogram(t: Roles) -> DataFrame:
    return histogram(t.orders, "DeliveryTimeMinutes", 45, ["OrderStatus"])


FACTS_SQL = f"""SELECT *, CAST(OrderDate AS TIMESTAMP) + to_seconds(CAST(OrderTime AS BIGINT)) AS ts FROM m_orders
                WHERE {DONE} AND OrderTime IS NOT NULL AND DeliveryTimeMinutes IS NOT NULL"""


def _history_sql(key: str, column: str, expr: str) -> str:
    return f"""WITH f AS ({FACTS_SQL})
        SELECT OrderID, {expr} AS {column} FROM f
        WINDOW w AS (PARTITION BY {key} ORDER BY ts, OrderID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query("prior_count", _history_sql("RestaurantID", "RestaurantPriorOrderCount", "count(*) OVER w"))
def q_prior_count(t: Roles) -> DataFrame:
    return prior_history(delivered_orders(t.orders), "RestaurantID", "Restaurant").select("OrderID", "RestaurantPriorOrderCount")


@query(
    "prior_mean",
    _history_sql(
        "DeliveryPartnerID", "PartnerPriorAvgDelivery", sql_ratio("sum(DeliveryTimeMinutes) OVER w", "count(DeliveryTimeMinutes) OVER w")
    ),
)
def q_prior_mean(t: Roles) -> DataFrame:
    return prior_history(delivered_orders(t.orders), "DeliveryPartnerID", "Partner").select("OrderID", "PartnerPriorAvgDelivery")


@query("prior_sum", _history_sql("CustomerID", "CustomerPriorSpend", money("coalesce(sum(coalesce(FinalAmount, 0)) OVER w, 0)")))
def q_prior_sum(t: Roles) -> DataFrame:
    return prior_history(delivered_orders(t.orders), "CustomerID", "Customer", spend=True).select("OrderID", "CustomerPriorSpend")


@query("top_n", f"SELECT OrderID, {money('FinalAmount')} AS FinalAmount FROM m_order_heads ORDER BY FinalAmount DESC, OrderID LIMIT 25")
def q_top_n(t: Roles) -> DataFrame:
    return t.order_heads.select("OrderID", "FinalAmount").orderBy(F.col("FinalAmount").desc_nulls_last(), "OrderID").limit(25)


@query(
    "sort_nulls",
    """SELECT OrderID, DeliveryTimeMinutes, row_number() OVER (ORDER BY DeliveryTimeMinutes DESC NULLS LAST, CouponCode ASC NULLS FIRST, OrderID) AS position
       FROM m_orders""",
)
def q_sort_nulls(t: Roles) -> DataFrame:
    order = [F.col("DeliveryTimeMinutes").desc_nulls_last(), F.col("CouponCode").asc_nulls_first(), F.col("OrderID").asc()]
    placed = global_position(t.orders.select("OrderID", "DeliveryTimeMinutes", "CouponCode"), order, by_range(F.col("DeliveryTimeMinutes"), "desc_nulls_last"))
    return placed.drop("CouponCode")


@query("sample_fixed")
def q_sample(t: Roles) -> DataFrame:
    return kpis.sample_fixed(t.order_heads.select("OrderID", "FinalAmount"), "OrderID")
