"""The shared test tables in the roles of the marketplace tables.

Every role is a DataFrame over the whole table, and ``ROLE_SQL`` holds the same definition in SQL.
Values a role needs but the tables lack (times of day, ratings, coupons) are arithmetic on columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.joins import broadcast_if_small

ROLE_SQL = {
    "m_cities": """
        SELECT CAST(n_nationkey AS BIGINT) AS CityID, n_name AS City, r_name AS Region
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "m_registrations": """
        SELECT o_custkey AS CustomerID, CAST(min(o_orderdate) AS DATE) AS RegistrationDate
        FROM orders GROUP BY o_custkey""",
    "m_customers": """
        SELECT c_custkey AS CustomerID, c_name AS Name, CAST(floor(c_acctbal / 100) AS BIGINT) AS Age,
               n_name AS City, c_mktsegment AS Membership, r_name AS PreferredCuisine, c_acctbal AS Balance
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "m_restaurants": """
        SELECT s_suppkey AS RestaurantID, s_name AS RestaurantName, r_name AS Cuisine, n_name AS City,
               CAST((10 + (40 * (CAST(round(s_acctbal * 100) AS BIGINT) + 100000) + 550000) // 1100000) AS DOUBLE) / 10
                 AS Rating,
               CAST(s_acctbal AS DECIMAL(12, 2)) AS AverageCost
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "m_partners": """
        SELECT s_suppkey AS DeliveryPartnerID, s_name AS Name, r_name AS VehicleType, n_name AS City,
               CAST((10 + (40 * (CAST(round(s_acctbal * 100) AS BIGINT) + 100000) + 550000) // 1100000) AS DOUBLE) / 10
                 AS Rating,
               abs(CAST(round(s_acctbal * 100) AS BIGINT)) // 10000 AS CompletedDeliveries,
               CAST(abs(CAST(round(s_acctbal * 100) AS BIGINT)) % 9000 AS DOUBLE) / 100 AS AverageDeliveryTime
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "m_menu": """
        SELECT p_partkey AS FoodItemID, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS RestaurantID,
               p_name AS FoodName, p_type AS Category, CAST(p_retailprice AS DECIMAL(12, 2)) AS Price,
               CAST(p_size AS BIGINT) AS PreparationTime, CAST(p_size AS BIGINT) * 12 AS Calories
        FROM part""",
    "m_promotions": """
        SELECT p_partkey AS PromotionID, 'C' || CAST(p_partkey AS VARCHAR) AS CouponCode, p_type AS CampaignName,
               CAST(p_size AS BIGINT) AS DiscountPercentage
        FROM part""",
    "m_order_heads": """
        SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, CAST(o_orderdate AS DATE) AS OrderDate,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN (o_orderkey * 7919) % 86400 END AS OrderTime,
               CAST(o_totalprice AS DECIMAL(12, 2)) AS FinalAmount,
               CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Delivered Late' ELSE 'Cancelled' END
                 AS OrderStatus,
               o_orderpriority AS PaymentMethod
        FROM orders""",
    "m_order_sums": """
        SELECT l_orderkey AS OrderID, min(l_suppkey) AS RestaurantID, max(l_suppkey) AS DeliveryPartnerID,
               CAST(sum(l_quantity) AS BIGINT) AS DeliveryTimeRaw,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DECIMAL(18, 2)) AS FoodCost,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(4, 2))) AS DECIMAL(18, 2))
                 AS Discount,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_tax AS DECIMAL(4, 2))) AS DECIMAL(18, 2)) AS GST,
               CAST(count(*) AS DECIMAL(18, 2)) AS DeliveryFee,
               CASE WHEN min(l_discount) = 0 THEN 'C' || CAST(min(l_partkey) AS VARCHAR) END AS CouponCode
        FROM lineitem GROUP BY l_orderkey""",
    "m_orders": """
        SELECT h.*, s.* EXCLUDE (OrderID),
               CASE WHEN s.DeliveryTimeRaw BETWEEN 5 AND 180 THEN s.DeliveryTimeRaw END AS DeliveryTimeMinutes
        FROM m_order_heads h LEFT JOIN m_order_sums s ON s.OrderID = h.OrderID""",
    "m_items": """
        SELECT l_orderkey * 10 + l_linenumber AS OrderItemID, l_orderkey AS OrderID, l_partkey AS FoodItemID,
               CAST(l_quantity AS BIGINT) AS Quantity,
               CAST(CAST((200 * CAST(round(l_extendedprice) AS BIGINT) + CAST(l_quantity AS BIGINT))
                 // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(18, 0)) / 100 AS DECIMAL(12, 2)) AS UnitPrice,
               CAST(l_extendedprice AS DECIMAL(12, 2)) AS TotalPrice
        FROM lineitem""",
    "m_payments": """
        SELECT o_orderkey AS PaymentID, o_orderkey AS OrderID, o_orderpriority AS PaymentMethod,
               CASE WHEN o_orderstatus = 'F' THEN 'Success' ELSE 'Failed' END AS PaymentStatus
        FROM orders""",
    "m_feedback": """
        SELECT l_orderkey AS OrderID, CAST(1 + l_linenumber % 5 AS BIGINT) AS CustomerRating,
               CAST(l_linenumber AS BIGINT) AS DeliveryRating
        FROM lineitem WHERE l_returnflag = 'R'""",
    "m_weather": """
        SELECT n_name AS City, CAST(l_shipdate AS DATE) AS Date, CAST(l_quantity AS BIGINT) AS Temperature,
               CAST(round(l_extendedprice) AS BIGINT) AS Rainfall, CAST(l_linenumber AS BIGINT) AS Humidity,
               l_returnflag AS WeatherCondition
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "m_traffic": """
        SELECT (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) AS TrafficID, n_name AS City,
               CAST(l_shipdate AS DATE) AS Date, (l_partkey % 24) * 3600 AS Time, l_linestatus AS TrafficLevel,
               l_quantity AS AverageSpeed
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "m_dirty": """
        SELECT o_orderkey AS OrderID,
               CASE o_orderkey % 7
                 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
                 WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%d-%m-%Y')
                 WHEN 4 THEN strftime(o_orderdate, '%Y.%m.%d') WHEN 5 THEN ' ' || strftime(o_orderdate, '%d.%m.%Y') || ' '
                 ELSE strftime(o_orderdate, '%m') || '/31/' || strftime(o_orderdate, '%Y') END AS DateText,
               CASE o_orderkey % 5
                 WHEN 0 THEN strftime(o_orderdate, '%d') || ':' || substr(CAST(10 + o_orderkey % 50 AS VARCHAR), 1, 2)
                 WHEN 1 THEN CAST(1 + o_orderkey % 12 AS VARCHAR) || ':' || CAST(10 + o_orderkey % 50 AS VARCHAR) || ' PM'
                 WHEN 2 THEN '0' || CAST(o_orderkey % 10 AS VARCHAR) || ':15:' || CAST(10 + o_orderkey % 50 AS VARCHAR)
                 WHEN 3 THEN '' ELSE 'noon' END AS TimeText,
               CASE o_orderkey % 4
                 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR)
                 WHEN 1 THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) || ' '
                 WHEN 2 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) ELSE '1,234' END AS NumberText,
               CASE o_orderkey % 3 WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN ' ' || o_orderpriority
                 ELSE o_orderpriority || '  ' END AS LabelText
        FROM orders""",
    "m_dirty_cities": """
        SELECT c_custkey AS CustomerID,
               CASE c_custkey % 8
                 WHEN 0 THEN '  new   delhi ' WHEN 1 THEN 'BOMBAY' WHEN 2 THEN lower(n_name)
                 WHEN 3 THEN 'McLeod Ganj' WHEN 4 THEN '   ' WHEN 5 THEN lower(n_name) || '-east o''side'
                 WHEN 6 THEN '  ' || n_name ELSE n_name END AS CityText
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
}


def dec(c: str, kind: str = "decimal(12,2)") -> Column:
    return F.col(c).cast(kind)


def hundredths(c: str) -> Column:
    """A two-place double as a whole number of hundredths: sums stay exact and cheap."""
    return F.round(F.col(c) * 100).cast("long")


def from_units(total: Column, places: int) -> Column:
    """A whole number of 10^-places units as money."""
    return (total.cast("decimal(20,0)") / F.lit(10**places).cast("decimal(5,0)")).cast("decimal(18,2)")


_SCHEMAS: dict[str, StructType] = {}
_ROWS: dict[str, int] = {}


class Roles:
    """Role tables of one data folder; nothing is read before it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """One table; its schema is read from the file footer once per process."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def _dimension(self, df: DataFrame, name: str) -> DataFrame:
        """A role with one row per row of a base table; broadcast only if that table is small.

        The count comes from the file footers.
        """
        path = f"{self.folder}/{name}.parquet"
        if path not in _ROWS:
            _ROWS[path] = self.table(name).count()
        return broadcast_if_small(df, _ROWS[path])

    @cached_property
    def _places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        named = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
        return self._dimension(named, "nation")

    @cached_property
    def cities(self) -> DataFrame:
        return self._places.select(
            F.col("n_nationkey").cast("long").alias("CityID"), F.col("n_name").alias("City"), F.col("r_name").alias("Region")
        )

    @cached_property
    def registrations(self) -> DataFrame:
        return self.table("orders").groupBy(F.col("o_custkey").alias("CustomerID")).agg(
            F.min("o_orderdate").cast("date").alias("RegistrationDate")
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        named = c.join(self._places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("Name"),
            F.floor(F.col("c_acctbal") / 100).cast("long").alias("Age"), F.col("n_name").alias("City"),
            F.col("c_mktsegment").alias("Membership"), F.col("r_name").alias("PreferredCuisine"),
            F.col("c_acctbal").alias("Balance"),
        )
        return self._dimension(named, "customer")

    @cached_property
    def registered_customers(self) -> DataFrame:
        return self.customers.join(self.registrations, "CustomerID", "left").withColumn("Gender", F.lit(None).cast("string"))

    @cached_property
    def _suppliers(self) -> DataFrame:
        s = self.table("supplier").join(self._places, F.col("s_nationkey") == F.col("n_nationkey"))
        return s.withColumn("_cents", F.round(F.col("s_acctbal") * 100).cast("long"))

    @staticmethod
    def _rating() -> Column:
        return (F.floor((40 * (F.col("_cents") + 100000) + 550000) / 1100000) + 10).cast("double") / 10

    @cached_property
    def restaurants(self) -> DataFrame:
        rated = self._suppliers.select(
            F.col("s_suppkey").alias("RestaurantID"), F.col("s_name").alias("RestaurantName"),
            F.col("r_name").alias("Cuisine"), F.col("n_name").alias("City"), self._rating().alias("Rating"),
            dec("s_acctbal").alias("AverageCost"),
        )
        return self._dimension(rated, "supplier")

    @cached_property
    def partners(self) -> DataFrame:
        size = F.abs(F.col("_cents"))
        rated = self._suppliers.select(
            F.col("s_suppkey").alias("DeliveryPartnerID"), F.col("s_name").alias("Name"),
            F.col("r_name").alias("VehicleType"), F.col("n_name").alias("City"), self._rating().alias("Rating"),
            F.floor(size / 10000).cast("long").alias("CompletedDeliveries"),
            ((size % 9000).cast("double") / 100).alias("AverageDeliveryTime"),
        )
        return self._dimension(rated, "supplier")

    @cached_property
    def menu(self) -> DataFrame:
        size = F.col("p_size").cast("long")
        return self.table("part").select(
            F.col("p_partkey").alias("FoodItemID"),
            F.regexp_replace("p_brand", "Brand#", "").cast("long").alias("RestaurantID"),
            F.col("p_name").alias("FoodName"), F.col("p_type").alias("Category"),
            dec("p_retailprice").alias("Price"), size.alias("PreparationTime"), (size * 12).alias("Calories"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("PromotionID"),
            F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("CouponCode"),
            F.col("p_type").alias("CampaignName"), F.col("p_size").cast("long").alias("DiscountPercentage"),
        )

    @staticmethod
    def heads_of(orders: DataFrame) -> DataFrame:
        status = F.col("o_orderstatus")
        return orders.select(
            F.col("o_orderkey").alias("OrderID"), F.col("o_custkey").alias("CustomerID"),
            F.col("o_orderdate").cast("date").alias("OrderDate"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", (F.col("o_orderkey") * 7919) % 86400).alias("OrderTime"),
            dec("o_totalprice").alias("FinalAmount"),
            F.when(status == "F", "Delivered").when(status == "O", "Delivered Late").otherwise("Cancelled").alias("OrderStatus"),
            F.col("o_orderpriority").alias("PaymentMethod"),
        )

    @cached_property
    def order_heads(self) -> DataFrame:
        """Orders without the columns that come from their lines."""
        return self.heads_of(self.table("orders"))

    @cached_property
    def order_sums(self) -> DataFrame:
        price = hundredths("l_extendedprice")
        code = F.concat(F.lit("C"), F.min("l_partkey").cast("string"))
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("OrderID")).agg(
            F.min("l_suppkey").alias("RestaurantID"), F.max("l_suppkey").alias("DeliveryPartnerID"),
            F.sum("l_quantity").cast("long").alias("DeliveryTimeRaw"),
            from_units(F.sum(price), 2).alias("FoodCost"),
            from_units(F.sum(price * hundredths("l_discount")), 4).alias("Discount"),
            from_units(F.sum(price * hundredths("l_tax")), 4).alias("GST"),
            F.count(F.lit(1)).cast("decimal(18,2)").alias("DeliveryFee"),
            F.when(F.min("l_discount") == 0, code).alias("CouponCode"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        minutes = F.col("DeliveryTimeRaw")
        return self.order_heads.join(self.order_sums, "OrderID", "left").withColumn(
            "DeliveryTimeMinutes", F.when(minutes.between(5, 180), minutes)
        )

    @cached_property
    def items(self) -> DataFrame:
        quantity = F.col("l_quantity").cast("long")
        unit = F.floor((200 * F.round("l_extendedprice").cast("long") + quantity) / (2 * quantity)).cast("decimal(18,0)") / 100
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("OrderItemID"), F.col("l_orderkey").alias("OrderID"),
            F.col("l_partkey").alias("FoodItemID"), quantity.alias("Quantity"), unit.cast("decimal(12,2)").alias("UnitPrice"),
            dec("l_extendedprice").alias("TotalPrice"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("PaymentID"), F.col("o_orderkey").alias("OrderID"),
            F.col("o_orderpriority").alias("PaymentMethod"),
            F.when(F.col("o_orderstatus") == "F", "Success").otherwise("Failed").alias("PaymentStatus"),
        )

    @cached_property
    def feedback(self) -> DataFrame:
        line = F.col("l_linenumber")
        return self.table("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("OrderID"), (line % 5 + 1).cast("long").alias("CustomerRating"),
            line.cast("long").alias("DeliveryRating"),
        )

    @cached_property
    def _shipped(self) -> DataFrame:
        towns = self.table("supplier").join(self._places, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
        return self.table("lineitem").join(self._dimension(towns, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))

    @cached_property
    def weather(self) -> DataFrame:
        return self._shipped.select(
            F.col("n_name").alias("City"), F.col("l_shipdate").cast("date").alias("Date"),
            F.col("l_quantity").cast("long").alias("Temperature"), F.round("l_extendedprice").cast("long").alias("Rainfall"),
            F.col("l_linenumber").cast("long").alias("Humidity"), F.col("l_returnflag").alias("WeatherCondition"),
        )

    @cached_property
    def traffic(self) -> DataFrame:
        return self._shipped.select(
            (
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10000000 + F.col("l_partkey") * 100
                + F.col("l_quantity").cast("long")
            ).alias("TrafficID"),
            F.col("n_name").alias("City"), F.col("l_shipdate").cast("date").alias("Date"),
            (F.col("l_partkey") % 24 * 3600).alias("Time"), F.col("l_linestatus").alias("TrafficLevel"),
            F.col("l_quantity").alias("AverageSpeed"),
        )

    @cached_property
    def dirty(self) -> DataFrame:
        """Order dates, times, amounts and labels as untidy text."""
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        amount, label = dec("o_totalprice").cast("string"), F.col("o_orderpriority")

        def shown(pattern: str) -> Column:
            return F.date_format(day, pattern)

        def text(c: Column) -> Column:
            return c.cast("string")

        minute = text(key % 50 + 10)
        date_text = (
            F.when(key % 7 == 0, shown("yyyy-MM-dd")).when(key % 7 == 1, shown("dd/MM/yyyy"))
            .when(key % 7 == 2, shown("MM/dd/yyyy")).when(key % 7 == 3, shown("dd-MM-yyyy"))
            .when(key % 7 == 4, shown("yyyy.MM.dd")).when(key % 7 == 5, F.concat(F.lit(" "), shown("dd.MM.yyyy"), F.lit(" ")))
            .otherwise(F.concat(shown("MM"), F.lit("/31/"), shown("yyyy")))
        )
        time_text = (
            F.when(key % 5 == 0, F.concat(shown("dd"), F.lit(":"), minute))
            .when(key % 5 == 1, F.concat(text(key % 12 + 1), F.lit(":"), minute, F.lit(" PM")))
            .when(key % 5 == 2, F.concat(F.lit("0"), text(key % 10), F.lit(":15:"), minute))
            .when(key % 5 == 3, "").otherwise("noon")
        )
        number_text = (
            F.when(key % 4 == 0, amount).when(key % 4 == 1, F.concat(F.lit(" "), amount, F.lit(" ")))
            .when(key % 4 == 2, F.concat(F.lit("-"), amount)).otherwise("1,234")
        )
        label_text = F.when(key % 3 == 0, F.lower(label)).when(key % 3 == 1, F.concat(F.lit(" "), label)).otherwise(
            F.concat(label, F.lit("  "))
        )
        return self.table("orders").select(
            key.alias("OrderID"), date_text.alias("DateText"), time_text.alias("TimeText"),
            number_text.alias("NumberText"), label_text.alias("LabelText"),
        )

    @cached_property
    def dirty_cities(self) -> DataFrame:
        key = F.col("c_custkey")
        named = self.table("customer").join(self._places, F.col("c_nationkey") == F.col("n_nationkey"))
        city = (
            F.when(key % 8 == 0, "  new   delhi ").when(key % 8 == 1, "BOMBAY").when(key % 8 == 2, F.lower("n_name"))
            .when(key % 8 == 3, "McLeod Ganj").when(key % 8 == 4, "   ")
            .when(key % 8 == 5, F.concat(F.lower("n_name"), F.lit("-east o'side")))
            .when(key % 8 == 6, F.concat(F.lit("  "), "n_name")).otherwise(F.col("n_name"))
        )
        return named.select(key.alias("CustomerID"), city.alias("CityText"))
