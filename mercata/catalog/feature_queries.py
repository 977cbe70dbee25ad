"""Feature tables (I) and the charts drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.aggregates import histogram
from ..operators.repair import RangeRule, flag_ranges, null_out
from ..plans import features, kpis
from .cleaning_queries import _FIRST_ITEMS, first_items
from .registry import DONE, money, pct2, query, ratio
from .kpi_queries import KPI_ROW
from .relational_queries import _DAILY, _LABEL, FACTS_SQL, histogram_sql
from .roles import Roles


def _with_nulls(df: DataFrame, **kinds: str) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()})


def domain_tables(t: Roles) -> dict[str, DataFrame]:
    """The role tables under their domain names; attributes the data lacks are null."""
    age = [RangeRule("Age", 0, 100)]
    return {
        "orders": t.orders,
        "customers": null_out(flag_ranges(t.registered_customers, age), age),
        "restaurants": _with_nulls(t.restaurants, Area="string", RestaurantType="string", Latitude="double", Longitude="double"),
        "delivery_partners": _with_nulls(t.partners, Age="double", Gender="string", JoiningDate="date"),
        "promotions": t.promotions,
        "order_items": first_items(t),
        "menu": t.menu,
        "weather": t.weather,
        "traffic": t.traffic,
    }


_SHOWN = (
    "OrderID OrderHour DayOfWeek IsDinner CustomerTenureDays DiscountPctOfFood HasCoupon DiscountPercentage CampaignName "
    "CustomerRestaurantCityMismatch RestaurantPartnerCityMismatch ItemLines BasketItemValue WeightedPrepTime Temperature "
    "WeatherCondition TrafficLevel AverageSpeed TrafficTimeDeltaMinutes CustomerPriorOrderCount CustomerPriorAvgDelivery "
    "CustomerPriorSpend RestaurantPriorOrderCount PartnerPriorAvgDelivery"
).split()


def _before(key: str) -> str:
    return f"(PARTITION BY {key} ORDER BY ts, OrderID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _mean(window: str) -> str:
    return ratio(f"sum(DeliveryTimeMinutes) OVER {window}", f"count(DeliveryTimeMinutes) OVER {window}")


_NEAREST = """
    p AS (SELECT f.OrderID, x.TrafficLevel, x.AverageSpeed, x.TrafficID, abs(date_diff('second', x.at, f.ts)) AS gap, x.at > f.ts AS later
          FROM f JOIN m_restaurants r ON r.RestaurantID = f.RestaurantID
          JOIN (SELECT *, CAST(Date AS TIMESTAMP) + to_seconds(CAST(Time AS BIGINT)) AS at FROM m_traffic) x
            ON x.City = r.City AND x.at BETWEEN f.ts - INTERVAL 90 MINUTE AND f.ts + INTERVAL 90 MINUTE),
    near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY OrderID ORDER BY gap, later,
                            CASE WHEN later THEN TrafficID ELSE -TrafficID END) AS n FROM p) WHERE n = 1)"""


@query(
    "nearest_traffic",
    f"""WITH f AS ({FACTS_SQL}), {_NEAREST}
        SELECT f.OrderID, near.TrafficLevel, near.AverageSpeed, CAST(near.gap AS DOUBLE) / 60 AS TrafficTimeDeltaMinutes
        FROM f LEFT JOIN near ON near.OrderID = f.OrderID""",
)
def nearest_traffic(t: Roles) -> DataFrame:
    located = features.delivered_orders(t.orders).join(
        t.restaurants.select("RestaurantID", F.col("City").alias("RestaurantCity")), "RestaurantID", "left"
    )
    return features.nearest_traffic(located, t.traffic).select("OrderID", "TrafficLevel", "AverageSpeed", "TrafficTimeDeltaMinutes")


@query(
    "delivery_features",
    f"""WITH f AS ({FACTS_SQL}), {_NEAREST}, d AS ({_DAILY}), k AS ({_LABEL}), i AS ({_FIRST_ITEMS}),
        b AS (SELECT i.OrderID, count(*) AS ItemLines, {money('sum(TotalPrice)')} AS BasketItemValue,
                     {ratio('coalesce(sum(Quantity * m.PreparationTime), 0)', 'sum(Quantity)')} AS WeightedPrepTime
              FROM i LEFT JOIN m_menu m ON m.FoodItemID = i.FoodItemID GROUP BY i.OrderID),
        h AS (SELECT *, count(*) OVER {_before('CustomerID')} AS n1, {_mean(_before('CustomerID'))} AS a1,
                     {money(f"coalesce(sum(FinalAmount) OVER {_before('CustomerID')}, 0)")} AS s1,
                     count(*) OVER {_before('RestaurantID')} AS n2, {_mean(_before('DeliveryPartnerID'))} AS a3 FROM f)
        SELECT h.OrderID, hour(h.ts) AS OrderHour, dayname(h.ts) AS DayOfWeek, CAST(hour(h.ts) BETWEEN 18 AND 22 AS BIGINT) AS IsDinner,
               greatest(h.OrderDate - g.RegistrationDate, 0) AS CustomerTenureDays, {ratio('h.Discount * 100', 'h.FoodCost')} AS DiscountPctOfFood,
               CAST(h.CouponCode IS NOT NULL AS BIGINT) AS HasCoupon, o.DiscountPercentage, o.CampaignName,
               CAST(coalesce(c.City <> r.City, TRUE) AS BIGINT) AS CustomerRestaurantCityMismatch,
               CAST(coalesce(r.City <> q.City, TRUE) AS BIGINT) AS RestaurantPartnerCityMismatch, b.ItemLines, b.BasketItemValue,
               b.WeightedPrepTime, d.Temperature, k.WeatherCondition, near.TrafficLevel, near.AverageSpeed,
               CAST(near.gap AS DOUBLE) / 60 AS TrafficTimeDeltaMinutes, h.n1 AS CustomerPriorOrderCount, h.a1 AS CustomerPriorAvgDelivery,
               h.s1 AS CustomerPriorSpend, h.n2 AS RestaurantPriorOrderCount, h.a3 AS PartnerPriorAvgDelivery
        FROM h LEFT JOIN m_customers c ON c.CustomerID = h.CustomerID LEFT JOIN m_registrations g ON g.CustomerID = h.CustomerID
        LEFT JOIN m_restaurants r ON r.RestaurantID = h.RestaurantID LEFT JOIN m_partners q ON q.DeliveryPartnerID = h.DeliveryPartnerID
        LEFT JOIN m_promotions o ON o.CouponCode = h.CouponCode LEFT JOIN b ON b.OrderID = h.OrderID
        LEFT JOIN d ON d.City = r.City AND d.Date = h.OrderDate LEFT JOIN k ON k.City = r.City AND k.Date = h.OrderDate
        LEFT JOIN near ON near.OrderID = h.OrderID""",
)
def delivery_features(t: Roles) -> DataFrame:
    return features.delivery_features(domain_tables(t)).select(*_SHOWN)


_CITIES = f"""f AS ({FACTS_SQL}),
    x AS (SELECT f.OrderID, f.DeliveryTimeMinutes, coalesce(c.City <> r.City, TRUE) AS m1, coalesce(r.City <> q.City, TRUE) AS m2 FROM f
          LEFT JOIN m_customers c ON c.CustomerID = f.CustomerID LEFT JOIN m_restaurants r ON r.RestaurantID = f.RestaurantID
          LEFT JOIN m_partners q ON q.DeliveryPartnerID = f.DeliveryPartnerID)"""


@query(
    "delivery_manifest",
    f"""WITH {_CITIES} SELECT count(*) AS rows, count(DeliveryTimeMinutes) AS target_non_null,
               {pct2('count(*) FILTER (WHERE m1)', 'count(*)')} AS cross_city_customer_restaurant_pct,
               {pct2('count(*) FILTER (WHERE m2)', 'count(*)')} AS cross_city_restaurant_partner_pct, FALSE AS distance_feature_available FROM x""",
)
def delivery_manifest(t: Roles) -> DataFrame:
    return features.delivery_manifest(features.delivery_features(domain_tables(t)))


@query(
    "delivery_features_same_city",
    f"WITH {_CITIES} SELECT OrderID FROM x WHERE NOT m1 AND NOT m2",
)
def delivery_features_same_city(t: Roles) -> DataFrame:
    return features.delivery_features(domain_tables(t), strict_city=True).select("OrderID")


_SNAP = "(SELECT CAST(max(OrderDate) - INTERVAL 60 DAY AS DATE) FROM m_order_heads)"


@query("churn_snapshot", f"SELECT {_SNAP} AS snapshot_date, max(OrderDate) AS outcome_end_date FROM m_order_heads")
def churn_snapshot(t: Roles) -> DataFrame:
    return features.churn_snapshot(t.order_heads)


_PAST = "past"
_PD = f"past AND {DONE}"
CHURN_SQL = f"""
    snap AS (SELECT {_SNAP} AS s),
    o AS (SELECT *, OrderDate <= s AS past FROM m_orders JOIN snap ON TRUE),
    h AS (SELECT CustomerID, max(OrderDate) FILTER (WHERE past) AS LastOrderDate, count(*) FILTER (WHERE past) AS n,
                 count(*) FILTER (WHERE {_PD}) AS d, sum(FinalAmount) FILTER (WHERE {_PD}) AS spend,
                 {ratio(f'sum(FinalAmount) FILTER (WHERE {_PD})', f'count(FinalAmount) FILTER (WHERE {_PD})')} AS AvgOrderValue,
                 {ratio(f'sum(DeliveryTimeMinutes) FILTER (WHERE {_PD})', f'count(DeliveryTimeMinutes) FILTER (WHERE {_PD})')} AS AvgDeliveryMinutes,
                 {ratio("count(*) FILTER (WHERE past AND OrderStatus = 'Cancelled')", 'count(*) FILTER (WHERE past)')} AS CancellationRate,
                 {ratio("count(*) FILTER (WHERE past AND OrderStatus = 'Delivered Late')", 'count(*) FILTER (WHERE past)')} AS LateRate,
                 count(DISTINCT RestaurantID) FILTER (WHERE past) AS v, count(DISTINCT PaymentMethod) FILTER (WHERE past) AS pm,
                 {ratio('sum(Discount) FILTER (WHERE past)', 'count(Discount) FILTER (WHERE past)')} AS AvgDiscount,
                 count(*) FILTER (WHERE NOT past) AS later FROM o GROUP BY CustomerID),
    a AS (SELECT c.CustomerID, CASE WHEN c.Age BETWEEN 0 AND 100 THEN c.Age END AS Age, c.City, g.RegistrationDate, c.Membership,
                 c.PreferredCuisine, h.LastOrderDate, CASE WHEN h.n > 0 THEN h.n END AS HistoricalOrders,
                 CASE WHEN h.d > 0 THEN h.d END AS CompletedOrders, CASE WHEN h.d > 0 THEN coalesce({money('h.spend')}, 0) END AS HistoricalSpend,
                 h.AvgOrderValue, h.AvgDeliveryMinutes, h.CancellationRate, h.LateRate, CASE WHEN h.n > 0 THEN h.v END AS RestaurantVariety,
                 CASE WHEN h.n > 0 THEN h.pm END AS PaymentMethodVariety, h.AvgDiscount, s - h.LastOrderDate AS RecencyDays,
                 greatest(s - g.RegistrationDate, 0) AS CustomerTenureDays, CAST(coalesce(h.later, 0) = 0 AS BIGINT) AS Churn60d,
                 CAST(coalesce(h.n, 0) > 0 AS BIGINT) AS EligibleForChurnModel
          FROM m_customers c JOIN m_registrations g ON g.CustomerID = c.CustomerID JOIN snap ON g.RegistrationDate <= s
          LEFT JOIN h ON h.CustomerID = c.CustomerID),
    churn AS (SELECT *, {ratio('HistoricalOrders * 30', 'CustomerTenureDays')} AS OrdersPer30Days,
                     {ratio('HistoricalSpend', 'CompletedOrders')} AS SpendPerOrder, EligibleForChurnModel AS HasOrderedHistorically FROM a)"""


def churn_all(t: Roles) -> DataFrame:
    d = domain_tables(t)
    return features.churn_features_all(d["orders"], d["customers"])


@query("churn_features_all", f"WITH {CHURN_SQL} SELECT * FROM churn")
def churn_features_all(t: Roles) -> DataFrame:
    return churn_all(t).drop("Gender")


@query("churn_label", f"WITH {CHURN_SQL} SELECT CustomerID, Churn60d FROM churn")
def churn_label(t: Roles) -> DataFrame:
    return churn_all(t).select("CustomerID", "Churn60d")


@query("churn_features", f"WITH {CHURN_SQL} SELECT * FROM churn WHERE EligibleForChurnModel = 1")
def churn_features(t: Roles) -> DataFrame:
    return features.churn_features(churn_all(t)).drop("Gender")


@query(
    "churn_manifest",
    f"""WITH {CHURN_SQL} SELECT {_SNAP} AS snapshot_date, (SELECT max(OrderDate) FROM m_order_heads) AS outcome_end_date,
        CAST(60 AS BIGINT) AS horizon_days, count(*) AS eligible_customers, round(avg(Churn60d), 4) AS churn_rate
        FROM churn WHERE EligibleForChurnModel = 1""",
)
def churn_manifest(t: Roles) -> DataFrame:
    return features.churn_manifest(t.order_heads, features.churn_features(churn_all(t)))


@query(
    "eda_kpis",
    f"""WITH {CHURN_SQL}, f AS ({FACTS_SQL}), e AS ({KPI_ROW})
        SELECT e.all_orders AS clean_orders, e.completed_orders, e.completed_revenue, (SELECT count(*) FROM m_customers) AS customers,
               (SELECT count(*) FROM m_restaurants) AS restaurants,
               (SELECT floor(avg(DeliveryTimeMinutes) * 100 + 0.5) / 100 FROM f) AS avg_delivery_minutes, e.late_rate_pct,
               (SELECT {pct2('sum(Churn60d)', 'count(*)')} FROM churn WHERE EligibleForChurnModel = 1) AS churn_rate_pct FROM e""",
)
def eda_kpis(t: Roles) -> DataFrame:
    delivered = features.delivered_orders(t.orders)
    return kpis.eda_kpis(t.order_heads, t.customers, t.restaurants, delivered, features.churn_features(churn_all(t)))


@query(
    "eda_recency_hist",
    "WITH " + CHURN_SQL + ", q AS (SELECT RecencyDays, Churn60d FROM churn WHERE EligibleForChurnModel = 1), "
    + histogram_sql("q", "RecencyDays", 40, "Churn60d").removeprefix("WITH "),
)
def eda_recency_hist(t: Roles) -> DataFrame:
    return histogram(features.churn_features(churn_all(t)), "RecencyDays", 40, ["Churn60d"])


@query("eda_prep_scatter")
def eda_prep_scatter(t: Roles) -> DataFrame:
    table = features.delivery_features(domain_tables(t))
    return kpis.sample_fixed(table.select("OrderID", "WeightedPrepTime", "DeliveryTimeMinutes"), "OrderID")


@query("dash_prep_scatter")
def dash_prep_scatter(t: Roles) -> DataFrame:
    table = features.delivery_features(domain_tables(t))
    return kpis.sample_fixed(table.select("OrderID", "WeightedPrepTime", "DeliveryTimeMinutes", "TrafficLevel"), "OrderID")


@query(
    "dash_recency_top100",
    f"""WITH {CHURN_SQL} SELECT CustomerID, HistoricalOrders, HistoricalSpend, RecencyDays, Churn60d FROM churn
        WHERE EligibleForChurnModel = 1 ORDER BY RecencyDays DESC NULLS LAST, CustomerID LIMIT 100""",
)
def dash_recency_top100(t: Roles) -> DataFrame:
    return kpis.recency_top(features.churn_features(churn_all(t)))
