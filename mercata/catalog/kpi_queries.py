"""Named business queries (H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import month_start
from ..operators.aggregates import histogram
from ..plans import features, kpis, validation
from .registry import DONE, cents, mean_int2, mean_money2, money, pct2, query, r2, ratio
from .relational_queries import FACTS_SQL, histogram_sql
from .cleaning_queries import _AUDIT, _CLOSE, q_dq_report
from .roles import Roles
from .star import KEY_ROWS, REFERENCE_ROWS, STAR_SQL, WARNINGS_SQL, flagged_star, rows_sql

_N = "count(*)"
_D = f"count(*) FILTER (WHERE {DONE})"
_L = "count(*) FILTER (WHERE OrderStatus = 'Delivered Late')"
_C = "count(*) FILTER (WHERE OrderStatus = 'Cancelled')"
_PAID = f"CASE WHEN {DONE} THEN FinalAmount END"
_MIN = f"CASE WHEN {DONE} THEN DeliveryTimeMinutes END"
_REST = "m_orders o JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID"

KPI_ROW = f"""SELECT {_N} AS all_orders, {_D} AS completed_orders, {money(f'sum({_PAID})')} AS completed_revenue,
    {mean_money2(_PAID)} AS average_order_value, {pct2(_C, _N)} AS cancellation_rate_pct, {pct2(_L, _D)} AS late_rate_pct
    FROM m_order_heads"""


@query("executive_kpis", KPI_ROW)
def executive_kpis(t: Roles) -> DataFrame:
    return kpis.executive_kpis(t.order_heads)


@query(
    "last_six_months",
    f"""SELECT OrderID, CustomerID, OrderDate, OrderTime, {money('FinalAmount')} AS FinalAmount, OrderStatus, PaymentMethod FROM m_order_heads
        WHERE OrderDate >= (SELECT max(OrderDate) FROM m_order_heads) - INTERVAL 6 MONTH""",
)
def last_six_months(t: Roles) -> DataFrame:
    return kpis.last_months(t.order_heads)


@query(
    "monthly_revenue_mom",
    f"""WITH m AS (SELECT CAST(date_trunc('month', OrderDate) AS DATE) AS month, sum(FinalAmount) AS r, count(*) AS orders
                   FROM m_order_heads WHERE {DONE} GROUP BY 1), x AS (SELECT *, lag(r) OVER (ORDER BY month) AS p FROM m)
        SELECT month, {money('r')} AS revenue, orders, {money('p')} AS prev_revenue,
               {r2(f'100 * ({cents("r")} - {cents("p")})', cents('p'))} AS mom_growth_pct FROM x""",
)
def monthly_revenue_mom(t: Roles) -> DataFrame:
    return kpis.monthly_revenue_mom(t.order_heads)


@query(
    "city_performance",
    f"""SELECT r.City, {_D} AS completed_orders, {money(f'sum({_PAID})')} AS revenue, {mean_int2(_MIN)} AS avg_delivery_minutes
        FROM {_REST} GROUP BY r.City""",
)
def city_performance(t: Roles) -> DataFrame:
    return kpis.city_performance(t.orders, t.restaurants)


def _ranked(rank: str, statuses: str) -> str:
    return f"""WITH s AS (SELECT r.City, r.RestaurantID, r.RestaurantName, {money('sum(FinalAmount)')} AS revenue
                  FROM {_REST} WHERE {statuses} GROUP BY ALL), k AS (SELECT *, {rank} AS city_rank FROM s)
        SELECT * FROM k WHERE city_rank <= 3"""


_W = "OVER (PARTITION BY City ORDER BY revenue DESC NULLS FIRST)"


@query("top_restaurants_per_city", _ranked(f"dense_rank() {_W}", DONE))
def top_restaurants(t: Roles) -> DataFrame:
    return kpis.top_restaurants_per_city(t.orders, t.restaurants)


@query("topk_rank", _ranked(f"rank() {_W}", "OrderStatus = 'Delivered'"))
def topk_rank(t: Roles) -> DataFrame:
    return kpis.topk_rank(t.orders, t.restaurants)


@query(
    "rank_three_ways",
    f"""WITH s AS (SELECT r.City, r.RestaurantID, r.RestaurantName, {money('sum(FinalAmount)')} AS revenue
                   FROM {_REST} WHERE OrderStatus = 'Delivered' GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY City ORDER BY revenue DESC NULLS FIRST, RestaurantID) AS row_num,
               rank() {_W} AS rank_num, dense_rank() {_W} AS dense_rank_num FROM s""",
)
def rank_three_ways(t: Roles) -> DataFrame:
    return kpis.rank_three_ways(t.orders, t.restaurants)


def _share(rate: str) -> str:
    return f"(1 - least(coalesce({rate}, CAST(0 AS DOUBLE)), CAST(100 AS DOUBLE)) / 100)"


@query(
    "restaurant_scorecard",
    f"""WITH s AS (SELECT r.RestaurantID, r.RestaurantName, r.City, r.Cuisine, r.Rating, count(o.OrderID) AS total_orders,
                 count(o.OrderID) FILTER (WHERE {DONE}) AS completed_orders, {money(f'sum({_PAID})')} AS revenue,
                 {ratio(f'sum({_MIN})', f'count({_MIN})')} AS avg_delivery_minutes,
                 {ratio(f'100 * {_C}', 'count(o.OrderID)')} AS cancellation_rate_pct, {ratio(f'100 * {_L}', _D)} AS late_rate_pct
               FROM m_restaurants r LEFT JOIN m_orders o ON r.RestaurantID = o.RestaurantID GROUP BY ALL),
        k AS (SELECT *, coalesce(Rating, CAST(3 AS DOUBLE)) / 5 * 35 + {_share('cancellation_rate_pct')} * 20 + {_share('late_rate_pct')} * 20
                 + least(CAST(completed_orders AS DOUBLE) / 50, CAST(1 AS DOUBLE)) * 10
                 + least(coalesce(revenue, CAST(0 AS DOUBLE)) / 50000, CAST(1 AS DOUBLE)) * 15 AS score FROM s)
        SELECT * EXCLUDE (score), floor(score * 100 + CAST(0.5 AS DOUBLE)) / 100 AS composite_performance_score FROM k""",
)
def restaurant_scorecard(t: Roles) -> DataFrame:
    return kpis.restaurant_scorecard(t.orders, t.restaurants)


@query(
    "restaurant_scorecard_simple",
    f"""SELECT r.RestaurantID, r.RestaurantName, r.City, r.Rating, count(o.OrderID) AS total_orders, {_C} AS cancelled_orders,
               {pct2(_C, 'count(o.OrderID)')} AS cancellation_rate_pct, {mean_int2('DeliveryTimeMinutes')} AS avg_delivery_time
        FROM m_restaurants r LEFT JOIN m_orders o ON r.RestaurantID = o.RestaurantID GROUP BY ALL""",
)
def scorecard_simple(t: Roles) -> DataFrame:
    return kpis.restaurant_scorecard_simple(t.orders, t.restaurants)


@query(
    "cuisine_rates",
    f"""SELECT r.Cuisine, {_N} AS total_orders, {_C} AS cancelled_orders, {pct2(_C, _N)} AS cancellation_rate_pct,
               {pct2(_L, _D)} AS late_rate_pct FROM {_REST} GROUP BY r.Cuisine""",
)
def cuisine_rates(t: Roles) -> DataFrame:
    return kpis.cuisine_rates(t.orders, t.restaurants)


@query(
    "customer_value",
    f"""SELECT c.CustomerID, c.Name, c.Membership, count(DISTINCT o.OrderID) FILTER (WHERE {DONE}) AS completed_orders,
               coalesce({money(f'sum({_PAID})')}, 0) AS lifetime_spend, max(o.OrderDate) AS last_order_date
        FROM m_customers c LEFT JOIN m_order_heads o ON o.CustomerID = c.CustomerID GROUP BY ALL""",
)
def customer_value(t: Roles) -> DataFrame:
    return kpis.customer_value(t.order_heads, t.customers)


@query(
    "customer_mom_spend",
    f"""WITH m AS (SELECT CustomerID, CAST(date_trunc('month', OrderDate) AS DATE) AS month, sum(FinalAmount) AS s
                   FROM m_order_heads WHERE {DONE} GROUP BY ALL),
        x AS (SELECT *, lag(s) OVER (PARTITION BY CustomerID ORDER BY month) AS p FROM m)
        SELECT CustomerID, month, {money('s')} AS spend, {money('p')} AS prior_month_spend, {money('s - p')} AS change_vs_prior_month FROM x""",
)
def customer_mom_spend(t: Roles) -> DataFrame:
    return kpis.customer_mom_spend(t.order_heads)


@query(
    "promotion_effectiveness",
    f"""SELECT p.CampaignName, p.CouponCode, p.DiscountPercentage, count(o.OrderID) AS uses, {money('sum(o.Discount)')} AS discount_cost,
               {money(f'sum({_PAID})')} AS completed_revenue, {mean_money2(_PAID)} AS avg_completed_order_value
        FROM m_promotions p LEFT JOIN m_orders o ON o.CouponCode = p.CouponCode GROUP BY ALL""",
)
def promotion_effectiveness(t: Roles) -> DataFrame:
    return kpis.promotion_effectiveness(t.orders, t.promotions)


@query(
    "coupon_performance",
    f"""SELECT p.CampaignName, p.CouponCode, count(*) AS orders_using_coupon, {money('sum(o.Discount)')} AS total_discount_value,
               {money('sum(o.FinalAmount)')} AS revenue_from_coupon_orders
        FROM m_promotions p JOIN m_orders o ON o.CouponCode = p.CouponCode GROUP BY ALL""",
)
def coupon_performance(t: Roles) -> DataFrame:
    return kpis.coupon_performance(t.orders, t.promotions)


@query(
    "payment_success",
    f"""SELECT PaymentMethod, count(*) AS payments, {pct2("count(*) FILTER (WHERE PaymentStatus = 'Success')", _N)} AS success_rate_pct
        FROM m_payments GROUP BY PaymentMethod""",
)
def payment_success(t: Roles) -> DataFrame:
    return kpis.payment_success(t.payments)


@query(
    "partner_performance",
    f"""SELECT p.DeliveryPartnerID, p.Name, p.VehicleType, p.City, {_D} AS completed_orders, {mean_int2(_MIN)} AS avg_delivery_minutes,
               {pct2(_L, _D)} AS late_rate_pct
        FROM m_partners p LEFT JOIN m_orders o ON o.DeliveryPartnerID = p.DeliveryPartnerID GROUP BY ALL""",
)
def partner_performance(t: Roles) -> DataFrame:
    return kpis.partner_performance(t.orders, t.partners)


_TRAFFIC = """SELECT x.TrafficLevel, {avg} AS avg_delivery_minutes, count(*) AS matched_orders
              FROM {rest} JOIN m_traffic x ON x.City = r.City AND x.Date = o.OrderDate{hour} {where} GROUP BY x.TrafficLevel"""


@query(
    "traffic_effect_hourly",
    _TRAFFIC.format(avg=mean_int2("DeliveryTimeMinutes"), rest=_REST, hour=" AND x.Time // 3600 = o.OrderTime // 3600", where=f"WHERE {DONE}"),
)
def traffic_hourly(t: Roles) -> DataFrame:
    return kpis.traffic_effect(t.orders, t.restaurants, t.traffic)


@query("traffic_effect_daily", _TRAFFIC.format(avg=mean_int2("DeliveryTimeMinutes"), rest=_REST, hour="", where=""))
def traffic_daily(t: Roles) -> DataFrame:
    return kpis.traffic_effect(t.orders, t.restaurants, t.traffic, hourly=False)


_WEATHER = """SELECT x.WeatherCondition, {avg} AS avg_delivery_minutes, {rain} count(*) AS orders
              FROM {rest} JOIN m_weather x ON x.City = r.City AND x.Date = o.OrderDate {where} GROUP BY x.WeatherCondition"""


@query(
    "weather_effect",
    _WEATHER.format(
        avg=mean_int2("DeliveryTimeMinutes"), rain=mean_int2("x.Rainfall") + " AS avg_rainfall,", rest=_REST, where=f"WHERE {DONE}"
    ),
)
def weather_effect(t: Roles) -> DataFrame:
    return kpis.weather_effect(t.orders, t.restaurants, t.weather)


@query("weather_effect_all", _WEATHER.format(avg=mean_int2("DeliveryTimeMinutes"), rain="", rest=_REST, where=""))
def weather_effect_all(t: Roles) -> DataFrame:
    return kpis.weather_effect(t.orders, t.restaurants, t.weather, corrected=False)


_BASE = """m_orders o JOIN m_customers c ON c.CustomerID = o.CustomerID JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID
           JOIN m_partners p ON p.DeliveryPartnerID = o.DeliveryPartnerID"""


@query(
    "city_mismatch_audit",
    f"""SELECT {pct2("count(*) FILTER (WHERE c.City <> r.City)", "count(c.City <> r.City)")} AS customer_restaurant_mismatch_pct,
               {pct2("count(*) FILTER (WHERE r.City <> p.City)", "count(r.City <> p.City)")} AS restaurant_partner_mismatch_pct FROM {_BASE}""",
)
def city_mismatch_audit(t: Roles) -> DataFrame:
    return kpis.city_mismatch_audit(kpis.order_base(t.orders, t.customers, t.restaurants, t.partners))


_BASE_COLUMNS = ["OrderID", "OrderDate", "OrderStatus", "DeliveryTimeMinutes", "customer_city", "Membership", "PreferredCuisine",
                 "RestaurantName", "restaurant_city", "Cuisine", "restaurant_rating", "partner_city", "VehicleType", "partner_rating",
                 "customer_restaurant_city_mismatch", "restaurant_partner_city_mismatch", "is_completed", "is_late", "is_cancelled",
                 "FinalAmount", "FoodCost", "DeliveryFee", "Discount", "GST"]


@query(
    "order_base",
    f"""SELECT o.OrderID, o.OrderDate, o.OrderStatus, o.DeliveryTimeMinutes, c.City AS customer_city, c.Membership, c.PreferredCuisine,
               r.RestaurantName, r.City AS restaurant_city, r.Cuisine, r.Rating AS restaurant_rating, p.City AS partner_city, p.VehicleType,
               p.Rating AS partner_rating, CAST(c.City <> r.City AS BIGINT) AS customer_restaurant_city_mismatch,
               CAST(r.City <> p.City AS BIGINT) AS restaurant_partner_city_mismatch, CAST({DONE} AS BIGINT) AS is_completed,
               CAST(OrderStatus = 'Delivered Late' AS BIGINT) AS is_late, CAST(OrderStatus = 'Cancelled' AS BIGINT) AS is_cancelled,
               {money('o.FinalAmount')} AS FinalAmount, {money('o.FoodCost')} AS FoodCost, {money('o.DeliveryFee')} AS DeliveryFee,
               {money('o.Discount')} AS Discount, {money('o.GST')} AS GST FROM {_BASE}""",
)
def order_base(t: Roles) -> DataFrame:
    return kpis.order_base(t.orders, t.customers, t.restaurants, t.partners).select(*_BASE_COLUMNS)


@query(
    "customer_rfm",
    f"""WITH f AS (SELECT CustomerID, max(OrderDate) AS last_order_date, count(DISTINCT OrderID) AS n, sum(FinalAmount) AS m
                   FROM m_order_heads WHERE {DONE} GROUP BY CustomerID)
        SELECT c.CustomerID, c.Name, c.City, c.Membership, f.last_order_date, coalesce(f.n, 0) AS frequency,
               coalesce({money('f.m')}, 0) AS monetary, (SELECT max(OrderDate) FROM m_order_heads) - f.last_order_date AS recency_days
        FROM m_customers c LEFT JOIN f ON f.CustomerID = c.CustomerID""",
)
def customer_rfm(t: Roles) -> DataFrame:
    return kpis.customer_rfm(t.order_heads, t.customers)


@query(
    "top10_restaurants_6m",
    f"""SELECT r.RestaurantID, r.RestaurantName, r.City, {money('sum(FinalAmount)')} AS total_revenue, count(*) AS total_orders
        FROM {_REST} WHERE OrderStatus = 'Delivered' AND OrderDate >= (SELECT max(OrderDate) FROM m_order_heads) - INTERVAL 6 MONTH
        GROUP BY ALL ORDER BY total_revenue DESC NULLS FIRST, r.RestaurantID LIMIT 10""",
)
def top10_restaurants(t: Roles) -> DataFrame:
    return kpis.top10_restaurants_6m(t.orders, t.restaurants)


@query(
    "avg_delivery_by_city",
    f"""SELECT r.City, {mean_int2('DeliveryTimeMinutes')} AS avg_delivery_time, count(*) AS order_count FROM {_REST}
        WHERE DeliveryTimeMinutes IS NOT NULL GROUP BY r.City""",
)
def avg_delivery_by_city(t: Roles) -> DataFrame:
    return kpis.avg_delivery_by_city(t.orders, t.restaurants)


@query(
    "cuisines_having",
    f"""SELECT r.Cuisine, count(*) AS delivered_orders, {mean_money2('CAST(r.Rating AS DECIMAL(10, 2))')} AS avg_cuisine_rating
        FROM {_REST} WHERE OrderStatus = 'Delivered' GROUP BY r.Cuisine HAVING count(*) > 500 AND avg(r.Rating) > 2.5""",
)
def cuisines_having(t: Roles) -> DataFrame:
    return kpis.cuisines_having(t.orders, t.restaurants, 500, 2.5)


@query(
    "restaurant_feedback",
    f"""SELECT r.RestaurantID, r.RestaurantName, count(f.OrderID) AS feedback_count, {mean_int2('f.CustomerRating')} AS avg_customer_rating
        FROM m_restaurants r LEFT JOIN m_orders o ON o.RestaurantID = r.RestaurantID
        LEFT JOIN m_feedback f ON f.OrderID = o.OrderID GROUP BY ALL""",
)
def restaurant_feedback(t: Roles) -> DataFrame:
    return kpis.restaurant_feedback(t.orders, t.restaurants, t.feedback)


@query(
    "customer_segments",
    f"""WITH s AS (SELECT c.CustomerID, c.Name, sum(FinalAmount) AS s FROM m_customers c JOIN m_order_heads o ON o.CustomerID = c.CustomerID GROUP BY ALL)
        SELECT CustomerID, Name, {money('s')} AS lifetime_spend, CASE WHEN s < 3000 THEN 'Bronze' WHEN s < 10000 THEN 'Silver'
               WHEN s < 20000 THEN 'Gold' ELSE 'Platinum' END AS value_segment FROM s""",
)
def customer_segments(t: Roles) -> DataFrame:
    return kpis.customer_segments(t.order_heads, t.customers)


@query(
    "repeat_vs_onetime",
    """WITH n AS (SELECT CustomerID, count(*) AS n FROM m_order_heads GROUP BY CustomerID)
       SELECT CASE WHEN n > 1 THEN 'Repeat' ELSE 'One-Time' END AS segment, count(*) AS num_customers FROM n GROUP BY 1""",
)
def repeat_vs_onetime(t: Roles) -> DataFrame:
    return kpis.repeat_vs_onetime(t.order_heads)


_SEQ = "OVER (PARTITION BY CustomerID ORDER BY OrderDate, OrderID)"


@query(
    "lag_lead",
    f"""SELECT OrderID, CustomerID, OrderDate, {money('FinalAmount')} AS FinalAmount, {money(f'lag(FinalAmount) {_SEQ}')} AS previous_order_amount,
               {money(f'lead(FinalAmount) {_SEQ}')} AS next_order_amount, {money(f'FinalAmount - lag(FinalAmount) {_SEQ}')} AS change_vs_previous
        FROM m_order_heads WHERE OrderStatus = 'Delivered'""",
)
def lag_lead(t: Roles) -> DataFrame:
    return kpis.lag_lead(t.order_heads)


@query(
    "recency_rank",
    """WITH l AS (SELECT CustomerID, max(OrderDate) AS last_order_date FROM m_order_heads GROUP BY CustomerID)
       SELECT CustomerID, last_order_date, (SELECT max(OrderDate) FROM m_order_heads) - last_order_date AS days_since_last_order,
              rank() OVER (ORDER BY last_order_date) AS recency_rank FROM l""",
)
def recency_rank(t: Roles) -> DataFrame:
    return kpis.recency_rank(t.order_heads)


@query(
    "month_city_trend",
    f"""WITH m AS (SELECT r.City, CAST(date_trunc('month', OrderDate) AS DATE) AS order_month, sum(FinalAmount) AS s
                   FROM {_REST} WHERE OrderStatus = 'Delivered' GROUP BY ALL)
        SELECT City, order_month, {money('s')} AS revenue, {money('lag(s) OVER (PARTITION BY City ORDER BY order_month)')} AS prev_month_revenue FROM m""",
)
def month_city_trend(t: Roles) -> DataFrame:
    return kpis.month_city_trend(t.orders, t.restaurants)


@query(
    "orders_by_weekday",
    f"""SELECT dayname(OrderDate) AS day_of_week, isodow(OrderDate) AS iso_day, count(*) AS order_count, {money('sum(FinalAmount)')} AS total_revenue
        FROM m_order_heads GROUP BY ALL""",
)
def orders_by_weekday(t: Roles) -> DataFrame:
    return kpis.orders_by_weekday(t.order_heads)


@query(
    "revenue_by_quarter",
    f"""SELECT year(OrderDate) AS order_year, quarter(OrderDate) AS order_quarter, {money('sum(FinalAmount)')} AS revenue
        FROM m_order_heads WHERE OrderStatus = 'Delivered' GROUP BY ALL""",
)
def revenue_by_quarter(t: Roles) -> DataFrame:
    return kpis.revenue_by_quarter(t.order_heads)


@query(
    "customer_tenure",
    """SELECT c.CustomerID, g.RegistrationDate, (SELECT max(OrderDate) FROM m_order_heads) - g.RegistrationDate AS tenure_days
       FROM m_customers c LEFT JOIN m_registrations g ON g.CustomerID = c.CustomerID""",
)
def customer_tenure(t: Roles) -> DataFrame:
    return kpis.customer_tenure(t.registered_customers, kpis.newest(t.order_heads))


@query(
    "partner_pairs",
    """SELECT a.DeliveryPartnerID AS partner_a, b.DeliveryPartnerID AS partner_b, a.City, a.AverageDeliveryTime AS a_avg_time,
              b.AverageDeliveryTime AS b_avg_time
       FROM m_partners a JOIN m_partners b ON b.City = a.City AND b.DeliveryPartnerID > a.DeliveryPartnerID
       WHERE abs(a.AverageDeliveryTime - b.AverageDeliveryTime) > 20 ORDER BY partner_a, partner_b LIMIT 100""",
)
def partner_pairs(t: Roles) -> DataFrame:
    return kpis.partner_pairs(t.partners)


@query(
    "attention_list",
    """SELECT RestaurantID AS entity_id, RestaurantName AS entity_name, 'Restaurant' AS entity_type, Rating FROM m_restaurants WHERE Rating < 3
       UNION SELECT DeliveryPartnerID, Name, 'DeliveryPartner', Rating FROM m_partners WHERE Rating < 3""",
)
def attention_list(t: Roles) -> DataFrame:
    return kpis.attention_list(t.restaurants, t.partners)


@query(
    "above_avg_cost",
    f"""SELECT RestaurantID, RestaurantName, {money('AverageCost')} AS AverageCost FROM m_restaurants
        WHERE CAST(AverageCost AS DOUBLE) > (SELECT {ratio('sum(AverageCost)', 'count(AverageCost)')} FROM m_restaurants)""",
)
def above_avg_cost(t: Roles) -> DataFrame:
    return kpis.above_avg_cost(t.restaurants)


@query(
    "last_order_cancelled",
    """WITH k AS (SELECT CustomerID, OrderStatus, row_number() OVER (PARTITION BY CustomerID
                    ORDER BY OrderDate DESC, OrderTime DESC NULLS FIRST, OrderID DESC) AS n FROM m_order_heads)
       SELECT c.CustomerID, c.Name FROM m_customers c JOIN k ON k.CustomerID = c.CustomerID WHERE k.n = 1 AND k.OrderStatus = 'Cancelled'""",
)
def last_order_cancelled(t: Roles) -> DataFrame:
    return kpis.last_order_cancelled(t.order_heads, t.customers)


@query(
    "partner_top_decile",
    """WITH k AS (SELECT DeliveryPartnerID, Name, City, Rating, CompletedDeliveries,
                    ntile(10) OVER (ORDER BY CompletedDeliveries DESC NULLS FIRST, Rating DESC NULLS FIRST, DeliveryPartnerID) AS decile FROM m_partners)
       SELECT * FROM k WHERE decile = 1""",
)
def partner_top_decile(t: Roles) -> DataFrame:
    return kpis.partner_top_decile(t.partners)


_MONTHS = "(SELECT *, CAST(date_trunc('month', OrderDate) AS DATE) AS month FROM m_orders)"


def _measures_sql(by: str, month: bool) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    same = " AND ".join(f"g.{c} IS NOT DISTINCT FROM b.{c}" for c in by.split(", ")) if by else "TRUE"
    shifted = " AND ".join(
        f"b.{c} = CAST(v.{c} + INTERVAL 1 MONTH AS DATE)" if c == "month" else f"v.{c} IS NOT DISTINCT FROM b.{c}"
        for c in by.split(", ")
    ) if month else "FALSE"
    rev, prev = money("b.revenue"), money("v.revenue")
    return f"""WITH o AS (SELECT * FROM {_MONTHS}),
        b AS (SELECT {keys}count(DISTINCT OrderID) AS n, count(DISTINCT OrderID) FILTER (WHERE {DONE}) AS d,
                     count(DISTINCT OrderID) FILTER (WHERE OrderStatus = 'Cancelled') AS c,
                     count(DISTINCT OrderID) FILTER (WHERE OrderStatus = 'Delivered Late') AS l,
                     count(DISTINCT OrderID) FILTER (WHERE CouponCode IS NOT NULL) AS k, sum({_PAID}) AS revenue,
                     {ratio(f'sum({_MIN})', f'count({_MIN})')} AS minutes FROM o {group}),
        g AS (SELECT {keys}{ratio('sum(f.CustomerRating)', 'count(f.CustomerRating)')} AS rating FROM o JOIN m_feedback f ON f.OrderID = o.OrderID {group})
        SELECT {''.join(f'b.{c}, ' for c in by.split(', ')) if by else ''}b.n AS total_orders, b.d AS completed_orders, b.c AS cancelled_orders,
               b.l AS late_orders, {rev} AS completed_revenue, {ratio('b.revenue', 'b.d')} AS average_order_value,
               coalesce({ratio('b.c', 'b.n')}, 0) * 100 AS cancellation_rate_pct, coalesce({ratio('b.l', 'b.d')}, 0) * 100 AS late_delivery_rate_pct,
               b.minutes AS average_delivery_minutes, g.rating AS average_customer_rating, {prev} AS revenue_previous_month,
               coalesce(({rev} - {prev}) / nullif({prev}, 0), 0) * 100 AS mom_revenue_growth_pct, b.k AS coupon_orders,
               coalesce({ratio('b.k', 'b.n')}, 0) * 100 AS coupon_usage_rate_pct
        FROM b LEFT JOIN g ON {same} LEFT JOIN b v ON {shifted}"""


def _with_month(t: Roles) -> DataFrame:
    return t.orders.withColumn("month", month_start(F.col("OrderDate")))


@query("measures", _measures_sql("", False))
def measures_total(t: Roles) -> DataFrame:
    return kpis.measures(t.orders, t.feedback)


@query("measures_by_month", _measures_sql("month", True))
def measures_by_month(t: Roles) -> DataFrame:
    return kpis.measures(_with_month(t), t.feedback, ["month"], "month")


@query("measures_by_method_month", _measures_sql("PaymentMethod, month", True))
def measures_by_method_month(t: Roles) -> DataFrame:
    return kpis.measures(_with_month(t), t.feedback, ["PaymentMethod", "month"], "month")


@query(
    "eda_monthly",
    f"""SELECT strftime(OrderDate, '%Y-%m') AS "Month", count(DISTINCT OrderID) AS Orders, {money('sum(FinalAmount)')} AS Revenue
        FROM m_order_heads WHERE {DONE} GROUP BY 1""",
)
def eda_monthly(t: Roles) -> DataFrame:
    return kpis.monthly_chart(t.order_heads)


@query("eda_status", "SELECT OrderStatus, count(DISTINCT OrderID) AS Orders FROM m_order_heads GROUP BY OrderStatus")
def eda_status(t: Roles) -> DataFrame:
    return kpis.status_chart(t.order_heads)


_CITIES = f"""SELECT r.City, count(DISTINCT o.OrderID) AS Orders, {money('sum(FinalAmount)')} AS Revenue
              FROM {_REST} WHERE {DONE} {{more}} GROUP BY r.City ORDER BY Revenue DESC NULLS LAST, r.City LIMIT 15"""


@query("eda_top_cities", _CITIES.format(more=""))
def eda_top_cities(t: Roles) -> DataFrame:
    return kpis.top_cities(t.orders, t.restaurants)


@query("eda_delivery_hist", histogram_sql(f"({FACTS_SQL})", "DeliveryTimeMinutes", 45))
def eda_delivery_hist(t: Roles) -> DataFrame:
    return histogram(features.delivered_orders(t.orders), "DeliveryTimeMinutes", 45)


_RANGE = "OrderDate BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"


def _ranged(df: DataFrame) -> DataFrame:
    return kpis.in_dates(df, *(F.lit(d).cast("date") for d in ("1997-01-01", "1999-12-31")))


@query(
    "dash_executive",
    f"""SELECT {_N} AS orders, {_D} AS completed, coalesce({money(f'sum({_PAID})')}, 0) AS completed_revenue,
               coalesce({ratio(_L, _D)}, 0) * 100 AS late_rate_pct, coalesce({ratio(_C, _N)}, 0) * 100 AS cancellation_rate_pct
        FROM m_order_heads WHERE {_RANGE}""",
)
def dash_executive(t: Roles) -> DataFrame:
    return kpis.dash_kpis(_ranged(t.order_heads))


@query(
    "dash_monthly",
    f"""SELECT strftime(OrderDate, '%Y-%m') AS "Month", count(*) AS Orders, {money('sum(FinalAmount)')} AS Revenue
        FROM m_order_heads WHERE {DONE} AND {_RANGE} GROUP BY 1""",
)
def dash_monthly(t: Roles) -> DataFrame:
    return kpis.monthly_chart(_ranged(t.order_heads))


@query("dash_top_cities", _CITIES.format(more=f"AND {_RANGE}"))
def dash_top_cities(t: Roles) -> DataFrame:
    return kpis.top_cities(_ranged(t.orders), t.restaurants)


@query("dash_status", f"SELECT OrderStatus, count(*) AS Orders FROM m_order_heads WHERE {_RANGE} GROUP BY OrderStatus")
def dash_status(t: Roles) -> DataFrame:
    return kpis.status_chart(_ranged(t.order_heads))


@query("dash_delivery_hist", histogram_sql(f"({FACTS_SQL})", "DeliveryTimeMinutes", 40))
def dash_delivery_hist(t: Roles) -> DataFrame:
    return histogram(features.delivered_orders(t.orders), "DeliveryTimeMinutes", 40)


@query(
    "city_kpi_refresh",
    f"""SELECT r.City, count(o.OrderID) AS TotalOrders, {money('sum(FinalAmount)')} AS TotalRevenue,
               {mean_int2('DeliveryTimeMinutes')} AS AvgDeliveryTime, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS LastRefreshed
        FROM {_REST} GROUP BY r.City""",
)
def city_kpi_refresh(t: Roles) -> DataFrame:
    return kpis.city_kpi_refresh(t.orders, t.restaurants, kpis.newest(t.order_heads))


@query(
    "order_list",
    f"""SELECT o.OrderID, c.Name AS customer_name, r.RestaurantName, {money('FinalAmount')} AS FinalAmount, OrderStatus
        FROM {_REST} JOIN m_customers c ON c.CustomerID = o.CustomerID ORDER BY o.OrderID LIMIT 100""",
)
def order_list(t: Roles) -> DataFrame:
    return kpis.order_list(t.orders, t.customers, t.restaurants)


_HARD_SQL = " UNION ALL ".join(
    [rows_sql([*KEY_ROWS, *REFERENCE_ROWS]), f"""SELECT 'orders.financial_equation', count(*) FILTER (WHERE NOT ({_CLOSE.format(
        a='FoodCost + DeliveryFee + GST - Discount', b='FinalAmount')})) = 0, '' FROM s_orders"""]
)


@query(
    "dash_quality",
    f"""WITH {STAR_SQL}, a AS ({_AUDIT}), n AS ({_HARD_SQL}), w AS ({WARNINGS_SQL})
        SELECT 'audit' AS section, "table" || '.' || metric AS name, CAST(value AS DOUBLE) AS value FROM a
        UNION ALL SELECT 'check', "check", CAST(passed AS DOUBLE) FROM n
        UNION ALL SELECT 'checks', 'passed', CAST(count(*) FILTER (WHERE passed) AS DOUBLE) FROM n
        UNION ALL SELECT 'checks', 'total', CAST(count(*) AS DOUBLE) FROM n
        UNION ALL SELECT 'warnings', name, value FROM w""",
)
def dash_quality(t: Roles) -> DataFrame:
    """Audit counters, all hard checks and the warnings in one table."""
    return validation.quality_board(flagged_star(t), q_dq_report(t))


@query(
    "calendar_dim",
    """WITH d AS (SELECT CAST(unnest(generate_series((SELECT min(OrderDate) FROM m_order_heads), (SELECT max(OrderDate) FROM m_order_heads),
                                                     INTERVAL 1 DAY)) AS DATE) AS date)
       SELECT date, year(date) AS year, quarter(date) AS quarter, month(date) AS month, CAST(date_trunc('month', date) AS DATE) AS month_start,
              dayname(date) AS day_name, isodow(date) AS iso_day FROM d""",
)
def calendar_dim(t: Roles) -> DataFrame:
    return kpis.calendar_dim(t.order_heads)
