"""Named business queries on the clean tables.

Facts are reduced to one row per join key before they meet a dimension, so a key that holds a
third of all orders reaches the join as one row and no join multiplies rows. Order ids are unique
(a hard check), so counting rows counts orders. Joins carry no broadcast hint: Spark broadcasts a
side only while its measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed import CANCELLED, COMPLETED, DELIVERED, LATE
from ..functions import (
    as_money, average, change_pct2, is_completed, mismatch_null_ignored, month_start, pct2, ratio, ratio2, round2,
)
from ..operators.aggregates import rank_by_date, value_counts
from ..operators.ordering import HOT_ROWS, Running, by_month, by_range, ntile, rank_within, running_by_key, top_within
from ..operators.pairs import first_distant_pairs

def rows() -> Column:
    return F.count(F.lit(1))


def _done() -> Column:
    return is_completed(F.col("OrderStatus"), COMPLETED)


def sums_by(orders: DataFrame, *by: str) -> DataFrame:
    """The additive parts of every order KPI, one row per key."""
    done, status = _done(), F.col("OrderStatus")
    minutes = F.when(done, F.col("DeliveryTimeMinutes"))
    return orders.groupBy(*by).agg(
        rows().alias("n"),
        F.count_if(done).alias("done"),
        F.sum(F.when(done, F.col("FinalAmount"))).alias("revenue"),
        F.count(F.when(done, F.col("FinalAmount"))).alias("priced"),
        F.count_if(status == CANCELLED).alias("cancelled"),
        F.count_if(status == LATE).alias("late"),
        F.sum(minutes).alias("minutes"),
        F.count(minutes).alias("timed"),
    )


def sums_again(df: DataFrame, *by: str) -> DataFrame:
    """Rolls rows of ``sums_by`` up to a coarser key."""
    parts = ("n", "done", "revenue", "priced", "cancelled", "late", "minutes", "timed")
    return df.groupBy(*by).agg(*[F.sum(p).alias(p) for p in parts])


def _late_pct() -> Column:
    return pct2(F.col("late"), F.col("done"))


# Corrected bank -------------------------------------------------------------------------------


def executive_kpis(orders: DataFrame) -> DataFrame:
    return orders_kpi_row(orders).select(
        "all_orders", "completed_orders", "completed_revenue", "average_order_value", "cancellation_rate_pct",
        "late_rate_pct",
    )


def orders_kpi_row(orders: DataFrame) -> DataFrame:
    done, amount = _done(), F.col("FinalAmount")
    paid = F.when(done, amount)
    return orders.agg(
        rows().alias("all_orders"),
        F.count_if(done).alias("completed_orders"),
        F.sum(paid).alias("_revenue"),
        F.count(paid).alias("_priced"),
        F.count_if(F.col("OrderStatus") == CANCELLED).alias("_cancelled"),
        F.count_if(F.col("OrderStatus") == LATE).alias("_late"),
    ).select(
        "*",
        as_money(F.col("_revenue")).alias("completed_revenue"),
        ratio2(F.col("_revenue"), F.col("_priced")).alias("average_order_value"),
        pct2(F.col("_cancelled"), F.col("all_orders")).alias("cancellation_rate_pct"),
        pct2(F.col("_late"), F.col("completed_orders")).alias("late_rate_pct"),
    )


def last_months(orders: DataFrame, months: int = 6) -> DataFrame:
    """Orders of the last months before the newest order date."""
    return orders.filter(F.col("OrderDate") >= F.add_months(newest(orders), -months))


def newest(orders: DataFrame) -> Column:
    """The newest order date as a scalar subquery."""
    return orders.agg(F.max("OrderDate")).scalar()


def monthly_revenue_mom(orders: DataFrame) -> DataFrame:
    monthly = (
        orders.filter(_done())
        .groupBy(month_start(F.col("OrderDate")).alias("month"))
        .agg(F.sum("FinalAmount").alias("r"), rows().alias("orders"))
    )
    # One row per calendar month, so a single ordered window is bounded.
    with_prev = monthly.withColumn("p", F.lag("r").over(Window.orderBy(F.col("month").asc_nulls_last())))
    return with_prev.select(
        "month", as_money(F.col("r")).alias("revenue"), "orders", as_money(F.col("p")).alias("prev_revenue"),
        change_pct2(F.col("r"), F.col("p")).alias("mom_growth_pct"),
    ).orderBy("month")


def _by_restaurant(orders: DataFrame, restaurants: DataFrame, *columns: str) -> DataFrame:
    return sums_by(orders, "RestaurantID").join(restaurants.select("RestaurantID", *columns), "RestaurantID")


def city_performance(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    return (
        sums_again(_by_restaurant(orders, restaurants, "City"), "City")
        .select(
            "City", F.col("done").alias("completed_orders"), as_money(F.col("revenue")).alias("revenue"),
            ratio2(F.col("minutes"), F.col("timed")).alias("avg_delivery_minutes"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "City")
    )


def restaurant_revenue(orders: DataFrame, restaurants: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Revenue per restaurant over orders in the given statuses."""
    sums = (
        orders.filter(F.col("OrderStatus").isin(*statuses)).groupBy("RestaurantID").agg(F.sum("FinalAmount").alias("r"))
    )
    return sums.join(restaurants.select("RestaurantID", "RestaurantName", "City"), "RestaurantID").select(
        "City", "RestaurantID", "RestaurantName", as_money(F.col("r")).alias("revenue")
    )


def top_restaurants_per_city(orders: DataFrame, restaurants: DataFrame, limit: int = 3) -> DataFrame:
    ranked = top_within(restaurant_revenue(orders, restaurants, COMPLETED), ["City"], "revenue", limit, dense=True)
    return ranked.orderBy("City", "city_rank", "RestaurantID")


def restaurant_scorecard(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    sums = sums_by(orders, "RestaurantID")
    base = restaurants.select("RestaurantID", "RestaurantName", "City", "Cuisine", "Rating").join(
        sums, "RestaurantID", "left"
    )
    zero = F.lit(0)
    base = base.select(
        "RestaurantID", "RestaurantName", "City", "Cuisine", "Rating",
        F.coalesce("n", zero).alias("total_orders"),
        F.coalesce("done", zero).alias("completed_orders"),
        as_money(F.col("revenue")).alias("revenue"),
        ratio(F.col("minutes"), F.col("timed")).alias("avg_delivery_minutes"),
        ratio(F.col("cancelled") * 100, F.col("n")).alias("cancellation_rate_pct"),
        ratio(F.col("late") * 100, F.col("done")).alias("late_rate_pct"),
    )

    def kept_share(rate: str) -> Column:
        return 1 - F.least(F.coalesce(rate, F.lit(0.0)), F.lit(100.0)) / 100

    score = (
        F.coalesce(F.col("Rating").cast("double"), F.lit(3.0)) / 5 * 35
        + kept_share("cancellation_rate_pct") * 20
        + kept_share("late_rate_pct") * 20
        + F.least(F.col("completed_orders") / F.lit(50.0), F.lit(1.0)) * 10
        + F.least(F.coalesce("revenue", F.lit(0.0)) / 50000, F.lit(1.0)) * 15
    )
    return base.select("*", round2(score).alias("composite_performance_score")).orderBy(
        F.col("composite_performance_score").desc_nulls_last(), "RestaurantID"
    )


def restaurant_scorecard_simple(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """The older view: counts, cancel rate, mean minutes over any status."""
    sums = orders.groupBy("RestaurantID").agg(
        rows().alias("n"), F.count_if(F.col("OrderStatus") == CANCELLED).alias("c"),
        F.sum("DeliveryTimeMinutes").alias("m"), F.count("DeliveryTimeMinutes").alias("t"),
    )
    base = restaurants.select("RestaurantID", "RestaurantName", "City", "Rating").join(sums, "RestaurantID", "left")
    return base.select(
        "RestaurantID", "RestaurantName", "City", "Rating",
        F.coalesce("n", F.lit(0)).alias("total_orders"), F.coalesce("c", F.lit(0)).alias("cancelled_orders"),
        pct2(F.col("c"), F.col("n")).alias("cancellation_rate_pct"),
        ratio2(F.col("m"), F.col("t")).alias("avg_delivery_time"),
    )


def cuisine_rates(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    return (
        sums_again(_by_restaurant(orders, restaurants, "Cuisine"), "Cuisine")
        .select(
            "Cuisine", F.col("n").alias("total_orders"), F.col("cancelled").alias("cancelled_orders"),
            pct2(F.col("cancelled"), F.col("n")).alias("cancellation_rate_pct"), _late_pct().alias("late_rate_pct"),
        )
        .orderBy(F.col("late_rate_pct").desc_nulls_last(), "Cuisine")
    )


def customer_value(orders: DataFrame, customers: DataFrame) -> DataFrame:
    done = _done()
    sums = orders.groupBy("CustomerID").agg(
        F.count_if(done).alias("d"), F.sum(F.when(done, F.col("FinalAmount"))).alias("s"),
        F.max("OrderDate").alias("last_order_date"),
    )
    return customers.select("CustomerID", "Name", "Membership").join(sums, "CustomerID", "left").select(
        "CustomerID", "Name", "Membership", F.coalesce("d", F.lit(0)).alias("completed_orders"),
        F.coalesce(as_money(F.col("s")), F.lit(0.0)).alias("lifetime_spend"), "last_order_date",
    )


def customer_mom_spend(orders: DataFrame) -> DataFrame:
    """Spend per customer and month against the previous active month."""
    monthly = (
        orders.filter(_done())
        .groupBy("CustomerID", month_start(F.col("OrderDate")).alias("month"))
        .agg(F.sum("FinalAmount").alias("s"))
    )
    # At most one row per customer and calendar month, so each window group is bounded.
    prior = F.lag("s").over(Window.partitionBy("CustomerID").orderBy("month"))
    return monthly.withColumn("p", prior).select(
        "CustomerID", "month", as_money(F.col("s")).alias("spend"), as_money(F.col("p")).alias("prior_month_spend"),
        as_money(F.col("s") - F.col("p")).alias("change_vs_prior_month"),
    )


def promotion_effectiveness(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Uses, cost and revenue per coupon; unused coupons stay."""
    paid = F.when(_done(), F.col("FinalAmount"))
    used = (
        orders.filter(F.col("CouponCode").isNotNull())
        .groupBy("CouponCode")
        .agg(rows().alias("n"), F.sum("Discount").alias("d"), F.sum(paid).alias("r"), F.count(paid).alias("k"))
    )
    return promotions.select("CampaignName", "CouponCode", "DiscountPercentage").join(used, "CouponCode", "left").select(
        "CampaignName", "CouponCode", "DiscountPercentage", F.coalesce("n", F.lit(0)).alias("uses"),
        as_money(F.col("d")).alias("discount_cost"), as_money(F.col("r")).alias("completed_revenue"),
        ratio2(F.col("r"), F.col("k")).alias("avg_completed_order_value"),
    )


def coupon_performance(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """The older form: used coupons only, all statuses."""
    used = (
        orders.filter(F.col("CouponCode").isNotNull())
        .groupBy("CouponCode")
        .agg(rows().alias("n"), F.sum("Discount").alias("d"), F.sum("FinalAmount").alias("r"))
    )
    return promotions.select("CampaignName", "CouponCode").join(used, "CouponCode").select(
        "CampaignName", "CouponCode", F.col("n").alias("orders_using_coupon"),
        as_money(F.col("d")).alias("total_discount_value"), as_money(F.col("r")).alias("revenue_from_coupon_orders"),
    )


def payment_success(payments: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("PaymentStatus") == "Success")
    return payments.groupBy("PaymentMethod").agg(rows().alias("payments"), pct2(ok, rows()).alias("success_rate_pct"))


def partner_performance(orders: DataFrame, partners: DataFrame) -> DataFrame:
    sums = sums_by(orders, "DeliveryPartnerID")
    return partners.select("DeliveryPartnerID", "Name", "VehicleType", "City").join(
        sums, "DeliveryPartnerID", "left"
    ).select(
        "DeliveryPartnerID", "Name", "VehicleType", "City", F.coalesce("done", F.lit(0)).alias("completed_orders"),
        ratio2(F.col("minutes"), F.col("timed")).alias("avg_delivery_minutes"), _late_pct().alias("late_rate_pct"),
    )


def _city_day(orders: DataFrame, restaurants: DataFrame, *extra: Column) -> DataFrame:
    """Order counts and minutes per restaurant city and day (and hour)."""
    located = orders.join(restaurants.select("RestaurantID", "City"), "RestaurantID")
    return located.groupBy("City", F.col("OrderDate").alias("Date"), *extra).agg(
        rows().alias("n"), F.sum("DeliveryTimeMinutes").alias("m"), F.count("DeliveryTimeMinutes").alias("k")
    )


def _hour(seconds: str) -> Column:
    return F.floor(F.col(seconds) / 3600).cast("int").alias("hour")


def traffic_effect(orders: DataFrame, restaurants: DataFrame, traffic: DataFrame, hourly: bool = True) -> DataFrame:
    """Mean minutes per traffic level, matched by city and date, and by hour for completed orders.

    Both sides are counted per match key first; multiplying the counts equals joining the rows.
    """
    facts = orders.filter(_done()) if hourly else orders
    left = _city_day(facts, restaurants, *([_hour("OrderTime")] if hourly else []))
    right = traffic.groupBy("City", "Date", *([_hour("Time")] if hourly else []), "TrafficLevel").agg(rows().alias("c"))
    keys = ["City", "Date", *(["hour"] if hourly else [])]
    c = F.col("c")
    return left.join(right, keys).groupBy("TrafficLevel").agg(
        ratio2(F.sum(F.col("m") * c), F.sum(F.col("k") * c)).alias("avg_delivery_minutes"),
        F.sum(F.col("n") * c).alias("matched_orders"),
    )


def weather_effect(orders: DataFrame, restaurants: DataFrame, weather: DataFrame, corrected: bool = True) -> DataFrame:
    """Mean minutes (and rainfall) per weather condition, matched by city and date."""
    left = _city_day(orders.filter(_done()) if corrected else orders, restaurants)
    right = weather.groupBy("City", "Date", "WeatherCondition").agg(
        rows().alias("c"), F.sum("Rainfall").alias("w"), F.count("Rainfall").alias("wn")
    )
    n, c = F.col("n"), F.col("c")
    out = left.join(right, ["City", "Date"]).groupBy("WeatherCondition").agg(
        ratio2(F.sum(F.col("m") * c), F.sum(F.col("k") * c)).alias("avg_delivery_minutes"),
        ratio2(F.sum(F.col("w") * n), F.sum(F.col("wn") * n)).alias("avg_rainfall"),
        F.sum(n * c).alias("orders"),
    )
    return out if corrected else out.drop("avg_rainfall")


def order_base(orders: DataFrame, customers: DataFrame, restaurants: DataFrame, partners: DataFrame) -> DataFrame:
    """Orders with customer, restaurant and partner attributes and status flags."""
    c = customers.select("CustomerID", F.col("City").alias("customer_city"), "Membership", "PreferredCuisine")
    r = restaurants.select(
        "RestaurantID", "RestaurantName", F.col("City").alias("restaurant_city"), "Cuisine",
        F.col("Rating").alias("restaurant_rating"),
    )
    p = partners.select(
        "DeliveryPartnerID", F.col("City").alias("partner_city"), "VehicleType", F.col("Rating").alias("partner_rating")
    )
    status = F.col("OrderStatus")
    joined = orders.join(c, "CustomerID").join(r, "RestaurantID").join(p, "DeliveryPartnerID")
    return joined.withColumns(
        {
            "customer_restaurant_city_mismatch": mismatch_null_ignored(F.col("customer_city"), F.col("restaurant_city")),
            "restaurant_partner_city_mismatch": mismatch_null_ignored(F.col("restaurant_city"), F.col("partner_city")),
            "is_completed": F.when(_done(), 1).otherwise(0),
            "is_late": F.when(status == LATE, 1).otherwise(0),
            "is_cancelled": F.when(status == CANCELLED, 1).otherwise(0),
        }
    )


def city_mismatch_audit(base: DataFrame) -> DataFrame:
    """Percentage of differing city pairs; pairs with a missing side do not count."""

    def share(a: str, b: str) -> Column:
        differs = F.col(a) != F.col(b)
        return pct2(F.count_if(differs), F.count(differs))

    return base.agg(
        share("customer_city", "restaurant_city").alias("customer_restaurant_mismatch_pct"),
        share("restaurant_city", "partner_city").alias("restaurant_partner_mismatch_pct"),
    )


def customer_rfm(orders: DataFrame, customers: DataFrame) -> DataFrame:
    done = orders.filter(_done()).groupBy("CustomerID").agg(
        F.max("OrderDate").alias("last_order_date"), rows().alias("f"), F.sum("FinalAmount").alias("m")
    )
    return customers.select("CustomerID", "Name", "City", "Membership").join(done, "CustomerID", "left").select(
        "CustomerID", "Name", "City", "Membership", "last_order_date", F.coalesce("f", F.lit(0)).alias("frequency"),
        F.coalesce(as_money(F.col("m")), F.lit(0.0)).alias("monetary"),
        F.datediff(newest(orders), F.col("last_order_date")).cast("long").alias("recency_days"),
    )


# Earlier bank: only status "Delivered" counts as delivered ---------------------------------------


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("OrderStatus") == DELIVERED)


def top10_restaurants_6m(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    recent = orders.filter(F.col("OrderDate") >= F.add_months(newest(orders), -6))
    sums = _delivered(recent).groupBy("RestaurantID").agg(F.sum("FinalAmount").alias("r"), rows().alias("total_orders"))
    named = sums.join(restaurants.select("RestaurantID", "RestaurantName", "City"), "RestaurantID")
    return (
        named.select("RestaurantID", "RestaurantName", "City", as_money(F.col("r")).alias("total_revenue"), "total_orders")
        .orderBy(F.col("total_revenue").desc_nulls_first(), "RestaurantID")
        .limit(10)
    )


def avg_delivery_by_city(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    timed = orders.filter(F.col("DeliveryTimeMinutes").isNotNull()).groupBy("RestaurantID").agg(
        F.sum("DeliveryTimeMinutes").alias("m"), rows().alias("n")
    )
    return (
        timed.join(restaurants.select("RestaurantID", "City"), "RestaurantID")
        .groupBy("City")
        .agg(ratio2(F.sum("m"), F.sum("n")).alias("avg_delivery_time"), F.sum("n").alias("order_count"))
    )


def cuisines_having(
    orders: DataFrame, restaurants: DataFrame, min_orders: int = 500, min_rating: float = 4.0
) -> DataFrame:
    sums = _delivered(orders).groupBy("RestaurantID").agg(rows().alias("n"))
    rating = F.col("Rating").cast("decimal(10,2)")
    rated = sums.join(restaurants.select("RestaurantID", "Cuisine", rating.alias("q")), "RestaurantID")
    return (
        rated.groupBy("Cuisine")
        .agg(
            F.sum("n").alias("delivered_orders"), F.sum(F.col("q") * F.col("n")).alias("_q"),
            F.sum(F.when(F.col("q").isNotNull(), F.col("n"))).alias("_k"),
        )
        .filter((F.col("delivered_orders") > min_orders) & (ratio(F.col("_q"), F.col("_k")) > min_rating))
        .select("Cuisine", "delivered_orders", ratio2(F.col("_q"), F.col("_k")).alias("avg_cuisine_rating"))
    )


def restaurant_feedback(orders: DataFrame, restaurants: DataFrame, feedback: DataFrame) -> DataFrame:
    """Feedback per restaurant, restaurants without any included."""
    per_order = feedback.groupBy("OrderID").agg(
        rows().alias("n"), F.sum("CustomerRating").alias("s"), F.count("CustomerRating").alias("k")
    )
    per_restaurant = (
        orders.select("OrderID", "RestaurantID")
        .join(per_order, "OrderID")
        .groupBy("RestaurantID")
        .agg(*[F.sum(c).alias(c) for c in "nsk"])
    )
    return restaurants.select("RestaurantID", "RestaurantName").join(per_restaurant, "RestaurantID", "left").select(
        "RestaurantID", "RestaurantName", F.coalesce("n", F.lit(0)).alias("feedback_count"),
        ratio2(F.col("s"), F.col("k")).alias("avg_customer_rating"),
    )


def payments_with_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every payment with its order, orders missing or not."""
    facts = orders.select("OrderID", "FinalAmount", "OrderStatus")
    return facts.join(payments.select("PaymentID", "OrderID", "PaymentStatus"), "OrderID", "right").select(
        "PaymentID", "OrderID", "PaymentStatus", as_money(F.col("FinalAmount")).alias("FinalAmount"), "OrderStatus"
    )


def customer_segments(orders: DataFrame, customers: DataFrame) -> DataFrame:
    spend = orders.groupBy("CustomerID").agg(F.sum("FinalAmount").alias("s"))
    s = F.col("s")
    tier = F.when(s >= 20000, "Platinum").when(s >= 10000, "Gold").when(s >= 3000, "Silver").otherwise("Bronze")
    return customers.select("CustomerID", "Name").join(spend, "CustomerID").select(
        "CustomerID", "Name", as_money(s).alias("lifetime_spend"), tier.alias("value_segment")
    )


def repeat_vs_onetime(orders: DataFrame) -> DataFrame:
    per_customer = orders.groupBy("CustomerID").agg(rows().alias("n"))
    segment = F.when(F.col("n") == 1, "One-Time").otherwise("Repeat")
    return per_customer.groupBy(segment.alias("segment")).agg(rows().alias("num_customers"))


def rank_three_ways(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    return rank_within(restaurant_revenue(orders, restaurants, [DELIVERED]), ["City"], "revenue", "RestaurantID")


def topk_rank(orders: DataFrame, restaurants: DataFrame, limit: int = 3) -> DataFrame:
    return top_within(restaurant_revenue(orders, restaurants, [DELIVERED]), ["City"], "revenue", limit)


def lag_lead(orders: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Previous and next delivered amount of the same customer by date."""
    base = _delivered(orders).select("OrderID", "CustomerID", "OrderDate", "FinalAmount")
    moved = running_by_key(
        base, ["CustomerID"], [F.col("OrderDate").asc_nulls_last(), F.col("OrderID").asc()],
        {"p": Running("previous", "FinalAmount"), "q": Running("next", "FinalAmount")}, hot_rows,
        by_month(F.col("OrderDate"), "asc_nulls_last"),
    )
    return moved.select(
        "OrderID", "CustomerID", "OrderDate", as_money(F.col("FinalAmount")).alias("FinalAmount"),
        as_money(F.col("p")).alias("previous_order_amount"), as_money(F.col("q")).alias("next_order_amount"),
        as_money(F.col("FinalAmount") - F.col("p")).alias("change_vs_previous"),
    )


def recency_rank(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    today = newest(orders) if as_of is None else as_of
    return rank_by_date(orders, "CustomerID", "OrderDate").select(
        "CustomerID", "last_order_date",
        F.datediff(today, F.col("last_order_date")).cast("long").alias("days_since_last_order"), "recency_rank",
    )


def month_city_trend(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    month = month_start(F.col("OrderDate")).alias("order_month")
    per_key = _delivered(orders).groupBy("RestaurantID", month).agg(F.sum("FinalAmount").alias("s"))
    monthly = (
        per_key.join(restaurants.select("RestaurantID", "City"), "RestaurantID")
        .groupBy("City", "order_month")
        .agg(F.sum("s").alias("s"))
    )
    prev = F.lag("s").over(Window.partitionBy("City").orderBy(F.col("order_month").asc_nulls_last()))
    return monthly.withColumn("p", prev).select(
        "City", "order_month", as_money(F.col("s")).alias("revenue"), as_money(F.col("p")).alias("prev_month_revenue")
    )


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    day = F.col("OrderDate")
    return (
        orders.groupBy(F.date_format(day, "EEEE").alias("day_of_week"), (F.weekday(day) + 1).cast("long").alias("iso_day"))
        .agg(rows().alias("order_count"), as_money(F.sum("FinalAmount")).alias("total_revenue"))
        .orderBy("iso_day")
    )


def revenue_by_quarter(orders: DataFrame) -> DataFrame:
    day = F.col("OrderDate")
    return (
        _delivered(orders)
        .groupBy(F.year(day).cast("long").alias("order_year"), F.quarter(day).cast("long").alias("order_quarter"))
        .agg(as_money(F.sum("FinalAmount")).alias("revenue"))
        .orderBy("order_year", "order_quarter")
    )


def customer_tenure(customers: DataFrame, as_of: Column) -> DataFrame:
    days = F.datediff(as_of, F.col("RegistrationDate")).cast("long")
    return customers.select("CustomerID", "RegistrationDate", days.alias("tenure_days"))


def partner_pairs(partners: DataFrame, gap: float = 20, limit: int = 100) -> DataFrame:
    return first_distant_pairs(partners, "City", "DeliveryPartnerID", "AverageDeliveryTime", gap, limit).select(
        F.col("a").alias("partner_a"), F.col("b").alias("partner_b"), "City", F.col("value_a").alias("a_avg_time"),
        F.col("value_b").alias("b_avg_time"),
    )


def attention_list(restaurants: DataFrame, partners: DataFrame, below: float = 3.0) -> DataFrame:
    """Low-rated restaurants and partners in one typed list without repeats."""

    def low(df: DataFrame, id_: str, name: str, kind: str) -> DataFrame:
        return df.filter(F.col("Rating") < below).select(
            F.col(id_).alias("entity_id"), F.col(name).alias("entity_name"), F.lit(kind).alias("entity_type"), "Rating"
        )

    return (
        low(restaurants, "RestaurantID", "RestaurantName", "Restaurant")
        .union(low(partners, "DeliveryPartnerID", "Name", "DeliveryPartner"))
        .distinct()
    )


def above_avg_cost(restaurants: DataFrame) -> DataFrame:
    mean = restaurants.agg(average(F.col("AverageCost"))).scalar()
    return restaurants.filter(F.col("AverageCost").cast("double") > mean).select(
        "RestaurantID", "RestaurantName", F.col("AverageCost").cast("double").alias("AverageCost")
    )


def last_order_cancelled(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers whose newest order (by date, time, id) was cancelled.

    A missing time counts as the newest of its day, as descending order puts nulls first.
    """
    when = F.struct("OrderDate", F.col("OrderTime").isNull(), "OrderTime", "OrderID")
    last = orders.groupBy("CustomerID").agg(F.max_by("OrderStatus", when).alias("status"))
    bad = last.filter(F.col("status") == CANCELLED)
    return customers.select("CustomerID", "Name").join(bad.select("CustomerID"), "CustomerID", "left_semi")


def partner_top_decile(partners: DataFrame) -> DataFrame:
    order = [F.col("CompletedDeliveries").desc_nulls_first(), F.col("Rating").desc_nulls_first(), F.col("DeliveryPartnerID").asc()]
    base = partners.select("DeliveryPartnerID", "Name", "City", "Rating", "CompletedDeliveries")
    return ntile(base, 10, order, by_range(F.col("CompletedDeliveries"), "desc_nulls_first"), "decile").filter(F.col("decile") == 1)


def order_list(orders: DataFrame, customers: DataFrame, restaurants: DataFrame, limit: int = 100) -> DataFrame:
    """The first orders by id with customer and restaurant names."""
    named = orders.join(customers.select("CustomerID", F.col("Name").alias("customer_name")), "CustomerID").join(
        restaurants.select("RestaurantID", "RestaurantName"), "RestaurantID"
    )
    return (
        named.select("OrderID", "customer_name", "RestaurantName", as_money(F.col("FinalAmount")).alias("FinalAmount"), "OrderStatus")
        .orderBy("OrderID")
        .limit(limit)
    )


def city_kpi_refresh(orders: DataFrame, restaurants: DataFrame, refreshed: Column) -> DataFrame:
    """The city KPI table as of one refresh; write it with ``write_table`` to replace the old one."""
    sums = orders.groupBy("RestaurantID").agg(
        rows().alias("n"), F.sum("FinalAmount").alias("r"), F.sum("DeliveryTimeMinutes").alias("m"),
        F.count("DeliveryTimeMinutes").alias("k"),
    )
    return (
        sums.join(restaurants.select("RestaurantID", "City"), "RestaurantID")
        .groupBy("City")
        .agg(
            F.sum("n").alias("TotalOrders"), as_money(F.sum("r")).alias("TotalRevenue"),
            ratio2(F.sum("m"), F.sum("k")).alias("AvgDeliveryTime"),
        )
        .withColumn("LastRefreshed", refreshed)
    )


# Measures, charts, dashboard ---------------------------------------------------------------------


def measures(
    orders: DataFrame, feedback: DataFrame, by: Sequence[str] = (), month: str | None = None, repeated: bool = False
) -> DataFrame:
    """Fourteen measures over any grouping columns of the orders.

    Orders are counted once each: rows of the orders table are distinct orders already, and a frame
    in which a join ``repeated`` them is counted by distinct id.

    With ``month`` (a month-start column, also part of ``by``) the previous calendar month is
    joined: a month without data has no previous revenue, and growth is then 0.
    """
    by = list(by)
    done, status, order = _done(), F.col("OrderStatus"), F.col("OrderID")
    minutes = F.when(done, F.col("DeliveryTimeMinutes"))
    tally = F.count_distinct if repeated else F.count
    base = orders.groupBy(*by).agg(
        tally(order).alias("total_orders"),
        tally(F.when(done, order)).alias("completed_orders"),
        tally(F.when(status == CANCELLED, order)).alias("cancelled_orders"),
        tally(F.when(status == LATE, order)).alias("late_orders"),
        tally(F.when(F.col("CouponCode").isNotNull(), order)).alias("coupon_orders"),
        F.sum(F.when(done, F.col("FinalAmount"))).alias("_revenue"),
        average(minutes).alias("average_delivery_minutes"),
    )
    rating = (
        feedback.groupBy("OrderID")
        .agg(F.sum("CustomerRating").alias("s"), F.count("CustomerRating").alias("k"))
        .join(orders.select("OrderID", *by), "OrderID")
        .groupBy(*[F.col(c).alias(f"_g_{c}") for c in by])
        .agg(ratio(F.sum("s"), F.sum("k")).alias("average_customer_rating"))
    )
    previous = F.lit(None).cast("double")
    if by:
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        base = base.join(rating, same, "left").drop(*[f"_g_{c}" for c in by])
    else:
        base = base.withColumn("average_customer_rating", rating.scalar())
    if month:
        shifted = base.select(
            *[(F.add_months(F.col(c), 1) if c == month else F.col(c)).alias(f"_p_{c}") for c in by],
            F.col("_revenue").alias("_previous"),
        )
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
        base = base.join(shifted, same, "left")
        previous = as_money(F.col("_previous"))

    def rate(part: str, whole: str) -> Column:
        return F.coalesce(ratio(F.col(part), F.col(whole)), F.lit(0.0)) * 100

    revenue = as_money(F.col("_revenue"))
    growth = F.coalesce(F.try_divide(revenue - previous, previous), F.lit(0.0)) * 100
    return base.select(
        *by, "total_orders", "completed_orders", "cancelled_orders", "late_orders",
        revenue.alias("completed_revenue"),
        ratio(revenue, F.col("completed_orders")).alias("average_order_value"),
        rate("cancelled_orders", "total_orders").alias("cancellation_rate_pct"),
        rate("late_orders", "completed_orders").alias("late_delivery_rate_pct"),
        "average_delivery_minutes", "average_customer_rating",
        previous.alias("revenue_previous_month"), growth.alias("mom_revenue_growth_pct"),
        "coupon_orders", rate("coupon_orders", "total_orders").alias("coupon_usage_rate_pct"),
    )


def calendar_dim(orders: DataFrame) -> DataFrame:
    """Every day of the order date range with its calendar parts."""
    span = orders.agg(F.min("OrderDate").alias("a"), F.max("OrderDate").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    return days.select(
        "date", F.year(d).cast("long").alias("year"), F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"), month_start(d).alias("month_start"),
        F.date_format(d, "EEEE").alias("day_name"), (F.weekday(d) + 1).cast("long").alias("iso_day"),
    )


def in_dates(orders: DataFrame, start: Column, end: Column) -> DataFrame:
    return orders.filter(F.col("OrderDate").between(start, end))


def monthly_chart(orders: DataFrame) -> DataFrame:
    month = F.date_format("OrderDate", "yyyy-MM").alias("Month")
    return orders.filter(_done()).groupBy(month).agg(rows().alias("Orders"), as_money(F.sum("FinalAmount")).alias("Revenue"))


def status_chart(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "OrderStatus", "Orders")


def top_cities(orders: DataFrame, restaurants: DataFrame, limit: int = 15) -> DataFrame:
    """Cities by completed revenue; unknown restaurants fall under a missing city."""
    sums = orders.filter(_done()).groupBy("RestaurantID").agg(rows().alias("n"), F.sum("FinalAmount").alias("r"))
    return (
        sums.join(restaurants.select("RestaurantID", "City"), "RestaurantID", "left")
        .filter(F.col("City").isNotNull())
        .groupBy("City")
        .agg(F.sum("n").alias("Orders"), as_money(F.sum("r")).alias("Revenue"))
        .orderBy(F.col("Revenue").desc_nulls_last(), "City")
        .limit(limit)
    )


def dash_kpis(orders: DataFrame) -> DataFrame:
    done = F.count_if(_done())
    late = F.count_if(F.col("OrderStatus") == LATE)
    cancelled = F.count_if(F.col("OrderStatus") == CANCELLED)
    return orders.agg(
        rows().alias("orders"), done.alias("completed"),
        F.coalesce(as_money(F.sum(F.when(_done(), F.col("FinalAmount")))), F.lit(0.0)).alias("completed_revenue"),
        (F.coalesce(ratio(late, done), F.lit(0.0)) * 100).alias("late_rate_pct"),
        (F.coalesce(ratio(cancelled, rows()), F.lit(0.0)) * 100).alias("cancellation_rate_pct"),
    )


def eda_kpis(
    orders: DataFrame, customers: DataFrame, restaurants: DataFrame, delivery: DataFrame, churn: DataFrame
) -> DataFrame:
    return orders_kpi_row(orders).select(
        F.col("all_orders").alias("clean_orders"), "completed_orders", "completed_revenue",
        customers.agg(F.count_distinct("CustomerID")).scalar().alias("customers"),
        restaurants.agg(F.count_distinct("RestaurantID")).scalar().alias("restaurants"),
        delivery.agg(ratio2(F.sum("DeliveryTimeMinutes"), F.count("DeliveryTimeMinutes"))).scalar().alias("avg_delivery_minutes"),
        "late_rate_pct",
        churn.agg(pct2(F.sum("Churn60d"), F.count("Churn60d"))).scalar().alias("churn_rate_pct"),
    )


def sample_fixed(df: DataFrame, key: str, limit: int = 4000, seed: int = 42) -> DataFrame:
    """A repeatable sample: the rows with the smallest seeded hashes of their key."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(limit)


def recency_top(churn: DataFrame, limit: int = 100) -> DataFrame:
    """The customers without orders for the longest time."""
    return (
        churn.select("CustomerID", "HistoricalOrders", "HistoricalSpend", "RecencyDays", "Churn60d")
        .orderBy(F.col("RecencyDays").desc_nulls_last(), F.col("CustomerID"))
        .limit(limit)
    )
