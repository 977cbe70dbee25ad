"""Leakage-safe feature tables for delivery time and churn."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed import CANCELLED, CHURN_HORIZON_DAYS, LATE, TRAFFIC_TOLERANCE_MINUTES
from ..functions import (
    combine_date_time, day_micros, distance_km, is_completed, mismatch_null_counts, pct2, present, ratio, tenure_days,
    time_part_columns,
)
from ..operators.aggregates import basket, daily_conditions
from ..operators.asof import asof_nearest
from ..operators.dedupe import keep_first
from ..operators.joins import broadcast_if_small, lookup
from ..operators.ordering import HOT_ROWS, Running, by_month, running_by_key
from ..session import settled

HISTORY_KEYS = (("CustomerID", "Customer"), ("RestaurantID", "Restaurant"), ("DeliveryPartnerID", "Partner"))

#: Tells rows of the delivered orders apart, also where an order is repeated.
ROW = "_row"


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Completed orders whose timestamp and target exist."""
    stamped = orders.withColumn("OrderTimestamp", combine_date_time(F.col("OrderDate"), F.col("OrderTime")))
    return stamped.filter(
        is_completed(F.col("OrderStatus")) & F.col("OrderTimestamp").isNotNull() & F.col("DeliveryTimeMinutes").isNotNull()
    )


def prior_history(
    facts: DataFrame, key: str, prefix: str, spend: bool = False, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Per order: count, mean minutes (and spend) of strictly earlier orders of the same key."""
    measures = {
        f"{prefix}PriorOrderCount": Running("count"),
        f"{prefix}PriorAvgDelivery": Running("mean", "DeliveryTimeMinutes"),
    }
    columns = ["OrderID", key, "OrderTimestamp", "DeliveryTimeMinutes"]
    if spend:
        measures[f"{prefix}PriorSpend"] = Running("sum", "FinalAmount")
        columns.append("FinalAmount")
    order = [F.col("OrderTimestamp").asc(), F.col("OrderID").asc()]
    return running_by_key(facts.select(*columns), [key], order, measures, hot_rows, by_month(F.col("OrderTimestamp"))).select("OrderID", *measures)


def with_history(facts: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All history features. The windows move narrow rows; the wide row is shuffled once, by order id."""
    out = facts
    for key, prefix in HISTORY_KEYS:
        out = out.join(prior_history(facts, key, prefix, key == "CustomerID", hot_rows), "OrderID")
    return out


def nearest_traffic(
    facts: DataFrame, traffic: DataFrame, tolerance_minutes: int = TRAFFIC_TOLERANCE_MINUTES, key: str | None = None,
    asked: DataFrame | None = None, keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Per order the traffic reading of the restaurant city nearest in time.

    With ``key``, a column that names each row of ``facts``, only narrow rows take part in the search and the wide
    row is joined once, by ``key``. Without it ``asked`` may hold the city, date and time of every row of ``facts``, so
    that the search need not build ``facts`` a second time. ``keep`` is handed to ``asof_nearest``.
    """
    readings = traffic.select(
        F.col("City").alias("RestaurantCity"), day_micros(F.col("Date"), F.col("Time")).alias("_read"),
        "TrafficID", "TrafficLevel", "AverageSpeed",
    )
    at = day_micros(F.col("OrderDate"), F.col("OrderTime"))
    placed = facts.withColumn("_placed", at)
    found = asof_nearest(
        placed if key is None else placed.select(key, "RestaurantCity", "_placed"), readings, "RestaurantCity", "_placed", "_read", ["TrafficLevel", "AverageSpeed"],
        "TrafficID", tolerance_minutes * 60, delta="TrafficTimeDeltaMinutes",
        asked=None if asked is None else asked.select("RestaurantCity", at.alias("_placed")), keep=keep,
    ).drop("_placed")
    return found if key is None else facts.join(found.drop("RestaurantCity"), key, "left")


def beside(wide: DataFrame, side: DataFrame) -> DataFrame:
    """Each row of ``wide`` with the rows of ``side`` for the same row of the delivered orders, or nulls.

    Both have OrderID and ``ROW``. The rows' numbers are compared beside the join's key and not as a part of it, so that
    every such join finds ``wide`` where the first one put it.
    """
    named = side.withColumnsRenamed({"OrderID": "_order", ROW: "_of"})
    return wide.join(named, (F.col("OrderID") == F.col("_order")) & (F.col(ROW) - F.col("_of") == 0), "left").drop("_order", "_of")


def delivery_features(t: Mapping[str, DataFrame], strict_city: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row per delivered order with everything known when it was placed.

    Written once to the shared folder, each by a run of its own whose shuffle files go when it ends: the delivered orders,
    which the histories and all look-ups read, their baskets, the weather of the days, and the answers of the traffic
    search. Customers, places, partners and coupons are looked up for narrow rows; whole rows are moved once, by order.
    """
    orders = t["orders"].drop("ItemLines", "TotalQuantity")  # the basket brings both
    delivered = settled(delivered_orders(orders).withColumn(ROW, F.monotonically_increasing_id()), "delivered-orders")
    baskets = settled(basket(t["order_items"], t["menu"], settled), "baskets")
    facts = with_history(delivered, hot_rows)

    customers = t["customers"].select(
        "CustomerID", F.col("Age").alias("CustomerAge"), F.col("Gender").alias("CustomerGender"),
        F.col("City").alias("CustomerCity"), "Membership", "PreferredCuisine", "RegistrationDate",
    )
    restaurants = t["restaurants"].select(
        "RestaurantID", F.col("Cuisine").alias("RestaurantCuisine"), F.col("City").alias("RestaurantCity"), "Area",
        F.col("Rating").alias("RestaurantRating"), F.col("AverageCost").alias("RestaurantAverageCost"),
        "RestaurantType", F.col("Latitude").alias("RestaurantLatitude"), F.col("Longitude").alias("RestaurantLongitude"),
    )
    partners = t["delivery_partners"].select(
        "DeliveryPartnerID", F.col("Age").alias("PartnerAge"), F.col("Gender").alias("PartnerGender"), "VehicleType",
        "JoiningDate", F.col("City").alias("PartnerCity"), F.col("Rating").alias("PartnerRating"),
        "CompletedDeliveries", F.col("AverageDeliveryTime").alias("PartnerHistoricalAvgDelivery"),
    )
    coupons = keep_first(
        t["promotions"].select("PromotionID", "CouponCode", "DiscountPercentage", "CampaignName"),
        ["CouponCode"], [F.col("PromotionID").asc()],
    ).drop("PromotionID")
    weather = daily_conditions(t["weather"], ["City", "Date"], ["Temperature", "Rainfall", "Humidity"], "WeatherCondition")
    weather = settled(weather.withColumnsRenamed({"City": "RestaurantCity", "Date": "OrderDate"}), "daily-weather")
    weather = broadcast_if_small(weather, weather.count())  # a row per city and day; the count is in the file footers

    def of(side: DataFrame, key: str, *more: str) -> DataFrame:
        return delivered.select("OrderID", ROW, key, *more).join(side, key)

    places = lookup(of(restaurants, "RestaurantID", "OrderDate", "OrderTime"), weather, ["RestaurantCity", "OrderDate"])
    asked = of(restaurants.select("RestaurantID", "RestaurantCity"), "RestaurantID", "OrderDate", "OrderTime")
    places = nearest_traffic(places, t["traffic"], asked=asked, keep=settled).drop("RestaurantID", "OrderDate", "OrderTime")

    x = facts.join(baskets, "OrderID", "left")
    for side in (
        of(customers, "CustomerID").drop("CustomerID"), places, of(partners, "DeliveryPartnerID").drop("DeliveryPartnerID"),
        of(coupons, "CouponCode").drop("CouponCode"),
    ):
        x = beside(x, side)
    x = x.drop(ROW)
    day, food = F.col("OrderTimestamp").cast("date"), F.col("FoodCost")
    x = x.withColumns(
        {
            **time_part_columns(F.col("OrderTimestamp")),
            "CustomerTenureDays": tenure_days(day, F.col("RegistrationDate")),
            "PartnerTenureDays": tenure_days(day, F.col("JoiningDate")),
            "DiscountPctOfFood": ratio(F.col("Discount") * 100, food),
            "DeliveryFeePctOfFood": ratio(F.col("DeliveryFee") * 100, food),
            "HasCoupon": present(F.col("CouponCode")),
            "CustomerRestaurantCityMismatch": mismatch_null_counts(F.col("CustomerCity"), F.col("RestaurantCity")),
            "RestaurantPartnerCityMismatch": mismatch_null_counts(F.col("RestaurantCity"), F.col("PartnerCity")),
            **_distance(x),
        }
    )
    if strict_city:
        x = x.filter((F.col("CustomerRestaurantCityMismatch") == 0) & (F.col("RestaurantPartnerCityMismatch") == 0))
    return x


def _distance(x: DataFrame) -> dict[str, Column]:
    """Active only if the orders carry delivery coordinates."""
    if not {"DeliveryLatitude", "DeliveryLongitude"} <= set(x.columns):
        return {"DistanceKm": F.lit(None).cast("double"), "DistanceFeatureAvailable": F.lit(0)}
    ends = [F.col(c) for c in ("RestaurantLatitude", "RestaurantLongitude", "DeliveryLatitude", "DeliveryLongitude")]
    return {"DistanceKm": distance_km(*ends), "DistanceFeatureAvailable": F.lit(1)}


def delivery_manifest(features: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return features.agg(
        rows.alias("rows"),
        F.count("DeliveryTimeMinutes").alias("target_non_null"),
        pct2(F.sum("CustomerRestaurantCityMismatch"), rows).alias("cross_city_customer_restaurant_pct"),
        pct2(F.sum("RestaurantPartnerCityMismatch"), rows).alias("cross_city_restaurant_partner_pct"),
        (F.max("DistanceFeatureAvailable") == 1).alias("distance_feature_available"),
    )


def churn_snapshot(orders: DataFrame, horizon: int = CHURN_HORIZON_DAYS) -> DataFrame:
    """One row: snapshot date and end of the outcome window."""
    last = F.max("OrderDate")
    return orders.agg(F.date_sub(last, horizon).alias("snapshot_date"), last.alias("outcome_end_date"))


def churn_history(orders: DataFrame, snapshot: Column, horizon: int = CHURN_HORIZON_DAYS) -> DataFrame:
    """All history measures and the outcome flag of every customer with orders.

    Orders are first summed per customer, restaurant and method, so that a customer who holds a third of all orders
    arrives as few rows. One row of every restaurant, and one of every method, is marked; their sums are the distinct
    counts. ``_later`` counts the orders of the outcome window, whatever their status.
    """
    past = F.col("OrderDate") <= snapshot
    done = past & is_completed(F.col("OrderStatus"))

    def of(cond: Column, c: str) -> Column:
        return F.when(cond, F.col(c))

    means = {
        "AvgOrderValue": of(done, "FinalAmount"),
        "AvgDeliveryMinutes": of(done, "DeliveryTimeMinutes"),
        "AvgDiscount": of(past, "Discount"),
    }
    counts = {
        "_past": past,
        "_done": done,
        "_cancelled": past & (F.col("OrderStatus") == CANCELLED),
        "_late": past & (F.col("OrderStatus") == LATE),
        "_later": (F.col("OrderDate") > snapshot) & (F.col("OrderDate") <= F.date_add(snapshot, horizon)),
    }
    parts = orders.groupBy("CustomerID", "RestaurantID", "PaymentMethod").agg(
        F.max(of(past, "OrderDate")).alias("LastOrderDate"),
        *[F.count_if(c).alias(name) for name, c in counts.items()],
        *[F.sum(c).alias(f"{name}_sum") for name, c in means.items()],
        *[F.count(c).alias(f"{name}_n") for name, c in means.items()],
    )

    def one_of_each(column: str, other: str) -> Column:
        seen = F.col("_past") > 0
        nth = F.row_number().over(Window.partitionBy("CustomerID", column).orderBy(seen.desc(), other))
        return seen & F.col(column).isNotNull() & (nth == 1)

    parts = parts.withColumn("_new_place", one_of_each("RestaurantID", "PaymentMethod"))
    parts = parts.withColumn("_new_method", one_of_each("PaymentMethod", "RestaurantID"))
    return parts.groupBy("CustomerID").agg(
        F.max("LastOrderDate").alias("LastOrderDate"),
        *[F.sum(name).alias(name) for name in ("_past", "_done", "_later")],
        F.sum("AvgOrderValue_sum").alias("_spend"),
        *[ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in means],
        ratio(F.sum("_cancelled"), F.sum("_past")).alias("CancellationRate"),
        ratio(F.sum("_late"), F.sum("_past")).alias("LateRate"),
        F.count_if("_new_place").alias("_variety"),
        F.count_if("_new_method").alias("_methods"),
    )


def churn_features_all(
    orders: DataFrame, customers: DataFrame, horizon: int = CHURN_HORIZON_DAYS, snapshot: Column | None = None
) -> DataFrame:
    """One row per customer registered by the snapshot, cold starts included.

    Measures of customers without history stay null, as does their spend; completed counts and
    spend are null too when no historical order was completed.
    """
    if snapshot is None:
        snapshot = churn_snapshot(orders, horizon).select("snapshot_date").scalar()
    history = churn_history(orders, snapshot, horizon)
    base = customers.select(
        "CustomerID", "Age", "Gender", "City", "RegistrationDate", "Membership", "PreferredCuisine"
    ).filter(F.col("RegistrationDate") <= snapshot)
    x = base.join(history, "CustomerID", "left").withColumn("_snapshot", snapshot)
    seen, finished = F.col("_past") > 0, F.col("_done") > 0
    x = x.withColumns(
        {
            "HistoricalOrders": F.when(seen, F.col("_past")),
            "CompletedOrders": F.when(finished, F.col("_done")),
            "HistoricalSpend": F.when(finished, F.coalesce(F.col("_spend").cast("double"), F.lit(0.0))),
            "RestaurantVariety": F.when(seen, F.col("_variety")),
            "PaymentMethodVariety": F.when(seen, F.col("_methods")),
            "RecencyDays": F.datediff("_snapshot", "LastOrderDate"),
            "CustomerTenureDays": tenure_days(F.col("_snapshot"), F.col("RegistrationDate")),
        }
    )
    x = x.withColumns(
        {
            "OrdersPer30Days": ratio(F.col("HistoricalOrders") * 30, F.col("CustomerTenureDays")),
            "SpendPerOrder": ratio(F.col("HistoricalSpend"), F.col("CompletedOrders")),
            "HasOrderedHistorically": F.coalesce(seen, F.lit(False)).cast("int"),
            "Churn60d": (F.coalesce("_later", F.lit(0)) == 0).cast("int"),
            "EligibleForChurnModel": F.coalesce(seen, F.lit(False)).cast("int"),
        }
    )
    return x.drop("_past", "_done", "_spend", "_variety", "_methods", "_later", "_snapshot")


def churn_features(all_customers: DataFrame) -> DataFrame:
    """Customers with at least one historical order."""
    return all_customers.filter(F.col("EligibleForChurnModel") == 1)


def churn_manifest(orders: DataFrame, eligible: DataFrame, horizon: int = CHURN_HORIZON_DAYS) -> DataFrame:
    span = churn_snapshot(orders, horizon)
    return eligible.agg(
        F.count(F.lit(1)).alias("eligible_customers"),
        F.round(ratio(F.sum("Churn60d"), F.count("Churn60d")), 4).alias("churn_rate"),
    ).select(
        span.select("snapshot_date").scalar().alias("snapshot_date"),
        span.select("outcome_end_date").scalar().alias("outcome_end_date"),
        F.lit(horizon).cast("long").alias("horizon_days"), "eligible_customers", "churn_rate",
    )
