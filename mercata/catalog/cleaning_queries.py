"""Dedupe, repair, integrity and audit (C)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import audit
from ..operators.aggregates import item_sums
from ..operators.checks import check_equation
from ..operators.dedupe import keep_first
from ..operators.integrity import Parent, children, flag_orphans, unknown_code_to_null, without_orphans
from ..operators.repair import (
    rebuild_amount, rebuild_from_children, recompute_product, recount_children, repair_from_lookup,
)
from ..plans import validation
from ..plans.cleaning import clean_all, dated
from ..plans.domain import AUDIT_METRICS, COLUMNS, KEYS, LOAD_ORDER
from ..sources.tables import ORDER
from .registry import DONE, money, pct2, query
from .roles import Roles
from .star import KEY_ROWS, REFERENCE_ROWS, SCHEMA_ROWS, checks_sql, star

_CLOSE = "abs(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) <= 0.01 + 1e-5 * abs(CAST({b} AS DOUBLE))"
_ITEM_ORDER = "FoodItemID, Quantity, TotalPrice"
_FIRST_ITEMS = f"""SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY OrderItemID ORDER BY {_ITEM_ORDER}) AS n FROM m_items) WHERE n = 1"""


def first_items(t: Roles) -> DataFrame:
    return keep_first(t.items, ["OrderItemID"], [F.col(c) for c in _ITEM_ORDER.split(", ")])


@query(
    "dedupe_keep_first",
    f"WITH f AS ({_FIRST_ITEMS}) SELECT OrderItemID, OrderID, FoodItemID, Quantity, {money('TotalPrice')} AS TotalPrice FROM f",
)
def q_dedupe(t: Roles) -> DataFrame:
    return first_items(t).drop("UnitPrice")


@query(
    "dedupe_secondary",
    """WITH k AS (SELECT *, row_number() OVER (PARTITION BY FoodName ORDER BY FoodItemID) AS n FROM m_menu
                  WHERE FoodName IS NOT NULL AND FoodItemID IS NOT NULL)
       SELECT FoodItemID, FoodName, Category FROM k WHERE n = 1""",
)
def q_dedupe_secondary(t: Roles) -> DataFrame:
    known = t.menu.filter(F.col("FoodItemID").isNotNull() & F.col("FoodName").isNotNull())
    return keep_first(known, ["FoodName"], [F.col("FoodItemID")]).select("FoodItemID", "FoodName", "Category")


@query(
    "fk_filter",
    """SELECT OrderID, CustomerRating, DeliveryRating FROM m_feedback
       WHERE OrderID IN (SELECT OrderID FROM m_order_heads WHERE OrderStatus <> 'Cancelled')""",
)
def q_fk_filter(t: Roles) -> DataFrame:
    return children(t.feedback, "OrderID", t.order_heads.filter(F.col("OrderStatus") != "Cancelled"), "OrderID")


_MULTI = """
    WITH f AS (SELECT o.OrderID, c.CustomerID IS NULL AS no_customer, r.RestaurantID IS NULL AS no_restaurant,
                      p.DeliveryPartnerID IS NULL AS no_partner
               FROM m_orders o
               LEFT JOIN (SELECT CustomerID FROM m_customers WHERE Balance >= 0) c ON c.CustomerID = o.CustomerID
               LEFT JOIN (SELECT RestaurantID FROM m_restaurants WHERE Rating >= 1.5) r ON r.RestaurantID = o.RestaurantID
               LEFT JOIN (SELECT DeliveryPartnerID FROM m_partners WHERE Rating < 4.8) p
                      ON p.DeliveryPartnerID = o.DeliveryPartnerID)"""


def _flagged(t: Roles) -> DataFrame:
    return flag_orphans(
        t.orders.select("OrderID", "CustomerID", "RestaurantID", "DeliveryPartnerID"),
        [
            Parent("CustomerID", t.customers.filter(F.col("Balance") >= 0), "CustomerID", "no_customer"),
            Parent("RestaurantID", t.restaurants.filter(F.col("Rating") >= 1.5), "RestaurantID", "no_restaurant"),
            Parent("DeliveryPartnerID", t.partners.filter(F.col("Rating") < 4.8), "DeliveryPartnerID", "no_partner"),
        ],
    )


@query("fk_filter_multi", _MULTI + "SELECT OrderID FROM f WHERE NOT (no_customer OR no_restaurant OR no_partner)")
def q_fk_multi(t: Roles) -> DataFrame:
    return without_orphans(_flagged(t), ["no_customer", "no_restaurant", "no_partner"]).select("OrderID")


@query(
    "fk_orphan_counts",
    _MULTI + """SELECT count(*) FILTER (WHERE no_customer) AS customer, count(*) FILTER (WHERE no_restaurant) AS restaurant,
                count(*) FILTER (WHERE no_partner) AS partner FROM f""",
)
def q_fk_counts(t: Roles) -> DataFrame:
    return _flagged(t).agg(*[F.count_if(f"no_{x}").alias(x) for x in ("customer", "restaurant", "partner")])


@query(
    "invalid_code_to_null",
    """WITH good AS (SELECT CouponCode FROM m_promotions WHERE DiscountPercentage <= 25)
       SELECT OrderID, CASE WHEN CouponCode IN (SELECT CouponCode FROM good) THEN CouponCode END AS CouponCode,
              CouponCode IS NOT NULL AND CouponCode NOT IN (SELECT CouponCode FROM good) AS emptied FROM m_orders""",
)
def q_code(t: Roles) -> DataFrame:
    good = t.promotions.filter(F.col("DiscountPercentage") <= 25)
    return unknown_code_to_null(t.orders.select("OrderID", "CouponCode"), "CouponCode", good, "CouponCode", "emptied")


# Lines on a large discount count as having no unit price of their own.
_HOLES = "SELECT OrderItemID, FoodItemID, Quantity, CASE WHEN Quantity < 45 THEN UnitPrice WHEN Quantity < 48 THEN -UnitPrice END AS UnitPrice, TotalPrice FROM m_items"
_REPAIRED = f"""
    WITH h AS ({_HOLES}),
    r AS (SELECT h.OrderItemID, h.FoodItemID, h.Quantity, h.TotalPrice,
                 (h.UnitPrice IS NULL OR h.UnitPrice < 0) AND coalesce(m.Price >= 0, FALSE) AS fixed,
                 CASE WHEN (h.UnitPrice IS NULL OR h.UnitPrice < 0) AND m.Price >= 0 THEN m.Price ELSE h.UnitPrice END AS UnitPrice
          FROM h LEFT JOIN m_menu m ON m.FoodItemID = h.FoodItemID),
    s AS (SELECT * FROM r WHERE UnitPrice >= 0 AND Quantity > 0)"""


def _repaired(t: Roles) -> DataFrame:
    q, u = F.col("Quantity"), F.col("UnitPrice")
    holes = t.items.select("OrderItemID", "FoodItemID", "Quantity", F.when(q < 45, u).when(q < 48, -u).alias("UnitPrice"), "TotalPrice")
    fixed = repair_from_lookup(holes, "UnitPrice", "FoodItemID", t.menu, "Price", "fixed")
    return fixed.filter((F.col("UnitPrice") >= 0) & (q > 0))


@query(
    "repair_from_lookup",
    _REPAIRED + f"""SELECT OrderItemID, FoodItemID, Quantity, {money('UnitPrice')} AS UnitPrice, {money('TotalPrice')} AS TotalPrice,
                           CAST(fixed AS BIGINT) AS fixed FROM s""",
)
def q_repair(t: Roles) -> DataFrame:
    return _repaired(t)


@query(
    "recompute_line_total",
    _REPAIRED + f"""SELECT OrderItemID, FoodItemID, Quantity, {money('Quantity * UnitPrice')} AS TotalPrice,
                           {money('TotalPrice')} AS OriginalTotalPrice,
                           CAST(NOT ({_CLOSE.format(a='TotalPrice', b='Quantity * UnitPrice')}) AS BIGINT) AS recomputed FROM s""",
)
def q_line_total(t: Roles) -> DataFrame:
    return recompute_product(_repaired(t), "TotalPrice", "Quantity", "UnitPrice", "OriginalTotalPrice", "recomputed").drop("UnitPrice", "fixed")


_REBUILT = f"""
    WITH f AS ({_FIRST_ITEMS}),
    s AS (SELECT OrderID, sum(TotalPrice) AS ItemFoodCost, count(*) AS ItemLines, sum(Quantity) AS TotalQuantity FROM f GROUP BY OrderID),
    b AS (SELECT o.OrderID, o.FoodCost AS OriginalFoodCost, coalesce(s.ItemFoodCost, o.FoodCost) AS FoodCost,
                 s.ItemFoodCost, s.ItemLines, s.TotalQuantity, o.DeliveryFee, o.Discount, o.GST, o.FinalAmount AS Source
          FROM m_orders o LEFT JOIN s ON s.OrderID = o.OrderID)"""


def _rebuilt(t: Roles) -> DataFrame:
    sums = item_sums(first_items(t))
    return rebuild_from_children(t.orders, "OrderID", "FoodCost", sums, "ItemFoodCost", "OriginalFoodCost", "rebuilt")


@query(
    "rebuild_from_children",
    _REBUILT + f"""SELECT OrderID, {money('OriginalFoodCost')} AS OriginalFoodCost, {money('FoodCost')} AS FoodCost, ItemLines,
                          CAST(TotalQuantity AS BIGINT) AS TotalQuantity, CAST(ItemFoodCost IS NOT NULL AS BIGINT) AS rebuilt FROM b""",
)
def q_rebuild(t: Roles) -> DataFrame:
    return _rebuilt(t).select("OrderID", "OriginalFoodCost", "FoodCost", "ItemLines", "TotalQuantity", "rebuilt")


# A large part of the discount makes some totals impossible.
_EXPECTED = "FoodCost + DeliveryFee + GST - 12 * Discount"


@query(
    "financial_rebuild",
    _REBUILT + f"""
    , e AS (SELECT OrderID, Source, {_EXPECTED} AS expected FROM b)
    SELECT OrderID, {money('CASE WHEN expected >= 0 THEN expected WHEN expected < 0 THEN NULL ELSE Source END')} AS FinalAmount,
           {money('Source')} AS OriginalFinalAmount, CAST(coalesce(expected >= 0, FALSE) AS BIGINT) AS rebuilt,
           coalesce(expected < 0, FALSE) AS impossible,
           coalesce(expected >= 0 AND NOT coalesce({_CLOSE.format(a='Source', b='expected')}, FALSE), FALSE) AS mismatch FROM e""",
)
def q_financial(t: Roles) -> DataFrame:
    base = _rebuilt(t).drop("rebuilt").withColumn("Discount", F.col("Discount") * 12)
    done = rebuild_amount(base, "FinalAmount", ["FoodCost", "DeliveryFee", "GST"], ["Discount"], "OriginalFinalAmount", "rebuilt")
    return done.select(
        "OrderID", "FinalAmount", "OriginalFinalAmount", "rebuilt", F.col("_impossible").alias("impossible"),
        F.col("_mismatch").alias("mismatch"),
    )


@query(
    "recount_children",
    """WITH n AS (SELECT CustomerID, count(DISTINCT OrderID) AS n FROM m_order_heads WHERE OrderStatus <> 'Cancelled' GROUP BY CustomerID)
       SELECT c.CustomerID, c.Age AS OriginalTotalOrders, coalesce(n.n, 0) AS TotalOrders, coalesce(c.Age, -1) <> coalesce(n.n, 0) AS changed
       FROM m_customers c LEFT JOIN n ON n.CustomerID = c.CustomerID""",
)
def q_recount(t: Roles) -> DataFrame:
    base = t.customers.select("CustomerID", F.col("Age").alias("TotalOrders"))
    live = t.order_heads.filter(F.col("OrderStatus") != "Cancelled")
    done = recount_children(base, "CustomerID", live, "OrderID", "TotalOrders", "Actual", "OriginalTotalOrders")
    return done.select("CustomerID", "OriginalTotalOrders", "TotalOrders", F.col("_recount").alias("changed"))


_AUDIT = f"""
    WITH f AS ({_FIRST_ITEMS}),
    g AS (SELECT f.*, f.Quantity > 48 AS bad, h.OrderID IS NULL AS orphan FROM f
          LEFT JOIN (SELECT OrderID FROM m_order_heads WHERE OrderStatus <> 'Cancelled') h ON h.OrderID = f.OrderID)
    SELECT 'order_items' AS "table", 'raw_rows' AS metric, count(*) AS value FROM m_items
    UNION ALL SELECT 'order_items', 'duplicate_key_rows', (SELECT count(*) FROM m_items) - count(*) FROM f
    UNION ALL SELECT 'order_items', 'invalid_quantity_rows', count(*) FILTER (WHERE bad) FROM g
    UNION ALL SELECT 'order_items', 'orphan_order_rows', count(*) FILTER (WHERE NOT bad AND orphan) FROM g
    UNION ALL SELECT 'order_items', 'clean_rows', count(*) FILTER (WHERE NOT bad AND NOT orphan) FROM g
    UNION ALL SELECT 'order_items', 'rows_removed',
                     (SELECT count(*) FROM m_items) - count(*) FILTER (WHERE NOT bad AND NOT orphan) FROM g"""


@query("dq_report", _AUDIT)
def q_dq_report(t: Roles) -> DataFrame:
    """Staged counters: each one sees only the rows that earlier steps left."""
    first = first_items(t).withColumn("bad", F.col("Quantity") > 48)
    live = t.order_heads.filter(F.col("OrderStatus") != "Cancelled")
    flagged = flag_orphans(first, [Parent("OrderID", live, "OrderID", "orphan")])
    keep = ~F.col("bad") & ~F.col("orphan")
    one_pass: dict[str, Column] = {
        "invalid_quantity_rows": F.col("bad"), "orphan_order_rows": ~F.col("bad") & F.col("orphan"), "clean_rows": keep,
    }
    name = "order_items"
    return audit.report(
        [
            audit.rows(t.items, name, ["raw_rows", "duplicate_key_rows", "rows_removed"]),
            audit.counters(flagged, name, one_pass, {"duplicate_key_rows": F.lit(-1), "rows_removed": -keep.cast("int")}),
        ]
    )


@query("check_pk", checks_sql(KEY_ROWS))
def q_check_pk(t: Roles) -> DataFrame:
    return validation.key_checks(star(t))


@query("check_fk", checks_sql(REFERENCE_ROWS))
def q_check_fk(t: Roles) -> DataFrame:
    return validation.reference_checks(star(t))


@query(
    "check_equation",
    f"""WITH n AS (SELECT count(*) FILTER (WHERE NOT ({_CLOSE.format(a='FoodCost + DeliveryFee + GST - Discount', b='FinalAmount')}))
                   AS bad FROM m_orders)
        SELECT 'orders.financial_equation' AS "check", bad = 0 AS passed, 'mismatched rows=' || CAST(bad AS VARCHAR) AS detail FROM n""",
)
def q_check_equation(t: Roles) -> DataFrame:
    return check_equation(t.orders, "orders.financial_equation", "FinalAmount", ["FoodCost", "DeliveryFee", "GST"], ["Discount"])


@query("check_constraints", checks_sql(SCHEMA_ROWS))
def q_check_constraints(t: Roles) -> DataFrame:
    return validation.schema_checks(star(t))


def _named(t: Roles) -> dict[str, DataFrame]:
    return {"orders": t.orders, "customers": t.customers, "restaurants": t.restaurants, "delivery_partners": t.partners}


@query(
    "warn_cross_city",
    f"""WITH x AS (SELECT o.OrderID, c.City AS a, r.City AS b, p.City AS d FROM m_orders o
                   LEFT JOIN m_customers c ON c.CustomerID = o.CustomerID
                   LEFT JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID
                   LEFT JOIN m_partners p ON p.DeliveryPartnerID = o.DeliveryPartnerID)
        SELECT 'cross_city_order_relationships' AS name,
               {pct2("count(*) FILTER (WHERE coalesce(a <> b, TRUE) OR coalesce(b <> d, TRUE))", "count(*)")} AS value FROM x""",
)
def q_warn_city(t: Roles) -> DataFrame:
    return validation.cross_city_warning(_named(t))


@query(
    "warn_ambiguous_dates",
    """WITH p AS (SELECT string_split_regex(trim(DateText), '[-./]') AS x FROM m_dirty)
       SELECT 'ambiguous_order_dates' AS name,
              CAST(count(*) FILTER (WHERE length(x[1]) <= 2 AND CAST(x[1] AS INT) <= 12 AND CAST(x[2] AS INT) <= 12) AS DOUBLE) AS value FROM p""",
)
def q_warn_dates(t: Roles) -> DataFrame:


    return validation.ambiguous_date_warning(dated(t.dirty, "DateText", "OrderDate"))


@query(
    "dq_summary_kpis",
    f"""SELECT count(*) AS orders, count(*) FILTER (WHERE {DONE}) AS completed_orders,
               {money(f"sum(FinalAmount) FILTER (WHERE {DONE})")} AS completed_revenue, min(OrderDate) AS date_min, max(OrderDate) AS date_max
        FROM m_order_heads""",
)
def q_summary(t: Roles) -> DataFrame:
    return validation.headline(t.order_heads)


def raw_tables(t: Roles) -> dict[str, DataFrame]:
    """The role tables as untidy text, in the columns of the raw files."""
    roles = {
        "cities": t.cities,
        "customers": t.registered_customers.join(t.dirty_cities, "CustomerID").drop("City").withColumnRenamed("CityText", "City"),
        "restaurants": t.restaurants,
        "menu": t.menu,
        "delivery_partners": t.partners,
        "promotions": t.promotions,
        "orders": t.orders.join(t.dirty, "OrderID").drop("OrderDate", "OrderTime").withColumnsRenamed(
            {"DateText": "OrderDate", "TimeText": "OrderTime"}
        ).drop("DeliveryTimeMinutes").withColumnRenamed("DeliveryTimeRaw", "DeliveryTimeMinutes"),
        "order_items": t.items,
        "payments": t.payments,
        "customer_feedback": t.feedback.withColumn("FeedbackID", F.xxhash64("OrderID", "DeliveryRating")),
        "weather": t.weather.withColumn("WeatherID", F.xxhash64("City", "Date", "Rainfall")),
        "traffic": t.traffic,
    }
    out = {}
    for name in LOAD_ORDER:
        df = roles[name]
        text = [
            (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in COLUMNS[name]
        ]
        # The source position of these rows is the row itself: the key leads, ties are told apart by the other columns in
        # their order, and equal rows are interchangeable.
        out[name] = df.select(*text).withColumn(ORDER, F.struct(KEYS[name]))
    return out


@query("cleaning_run")
def q_cleaning_run(t: Roles) -> DataFrame:
    """The whole cleaning of twelve tables; its audit as one row per table."""
    return audit.wide_summary(clean_all(raw_tables(t)).report(), AUDIT_METRICS)


@query("quality_gate")
def q_gate(t: Roles) -> DataFrame:
    """Cleans, runs the 21 hard checks, and stops with an error if one fails."""
    return validation.gate(clean_all(raw_tables(t)).tables)
