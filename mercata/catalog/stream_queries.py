"""Incremental counters (K), checked against their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import as_money, ratio2
from ..session import scratch_path, stored
from ..streaming import counters
from .registry import mean_int2, money, query
from .roles import Roles


#: A backlog is worked off in batches of so many files.
FILES_PER_TRIGGER = 64


def _orders_stream(t: Roles) -> DataFrame:
    """The orders table, be it one file or a folder of part files; the pattern finds this name only."""
    schema = t.table("orders").schema
    return t.heads_of(counters.read_stream(t.spark, f"{t.folder}/orders.parque[t]", schema, FILES_PER_TRIGGER))


def _run(t: Roles, totals: DataFrame, key: str) -> DataFrame:
    base = scratch_path(t.spark, "stream")
    counters.start(totals, f"{base}/totals", f"{base}/state", key).awaitTermination()
    return counters.current(t.spark, f"{base}/totals", key, totals.schema)


@query("stream_customer_counts", "SELECT CustomerID, count(*) AS TotalOrders FROM m_order_heads GROUP BY CustomerID")
def stream_customer_counts(t: Roles) -> DataFrame:
    return _run(t, counters.customer_counts(_orders_stream(t)), "CustomerID")


@query(
    "stream_city_kpis",
    f"""SELECT r.City, count(*) AS TotalOrders, {money('sum(FinalAmount)')} AS TotalRevenue, {mean_int2('DeliveryTimeMinutes')} AS AvgDeliveryTime
        FROM m_orders o JOIN m_restaurants r ON r.RestaurantID = o.RestaurantID GROUP BY r.City""",
)
def stream_city_kpis(t: Roles) -> DataFrame:
    lines = stored(t.order_sums.select("OrderID", "RestaurantID", "DeliveryTimeRaw"), "stream-lines")  # read by every batch
    minutes = F.col("DeliveryTimeRaw")
    stream = _orders_stream(t).join(lines, "OrderID").withColumn("DeliveryTimeMinutes", F.when(minutes.between(5, 180), minutes))
    current = _run(t, counters.city_sums(stream, t.restaurants), "City")
    return current.select(
        "City", "TotalOrders", as_money(F.col("_revenue")).alias("TotalRevenue"),
        ratio2(F.col("_minutes"), F.col("_timed")).alias("AvgDeliveryTime"),
    )
