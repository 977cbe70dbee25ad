"""Scans and sinks (A)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import coerce_numeric, coerce_whole
from ..operators import audit
from ..plans.domain import COLUMNS, LOAD_ORDER
from ..session import scratch_path
from ..sources import publish_staged, read_raw, read_star, write_report, write_table
from .registry import money, query
from .roles import Roles
from .star import SHOWN_SQL, shown, star


@query(
    "scan_csv",
    """SELECT OrderID, CustomerID, CAST(OrderDate AS VARCHAR) AS OrderDate, CAST(FinalAmount AS DOUBLE) AS FinalAmount,
              OrderStatus FROM m_order_heads""",
)
def scan_csv(t: Roles) -> DataFrame:
    columns = ["OrderID", "CustomerID", "OrderDate", "FinalAmount", "OrderStatus"]
    path = scratch_path(t.spark, "csv")
    write_table(t.order_heads.select(*columns), path, "csv")
    raw = read_raw(t.spark, path, columns)
    return raw.select(*columns).withColumns(
        {"OrderID": coerce_whole(F.col("OrderID")), "CustomerID": coerce_whole(F.col("CustomerID")), "FinalAmount": coerce_numeric(F.col("FinalAmount"))}
    )


@query("scan_processed", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_processed(t: Roles) -> DataFrame:
    return t.table("customer")


@query(
    "sink_table",
    f"""SELECT 'csv' AS format, RestaurantID, City, {money('AverageCost')} AS AverageCost FROM m_restaurants
        UNION ALL SELECT 'parquet', RestaurantID, City, {money('AverageCost')} FROM m_restaurants""",
)
def sink_table(t: Roles) -> DataFrame:
    out = t.restaurants.select("RestaurantID", "City", F.col("AverageCost").cast("double").alias("AverageCost"))
    base = scratch_path(t.spark, "sink")
    write_table(out, f"{base}/csv", "csv")
    write_table(out, f"{base}/parquet")
    csv = t.spark.read.schema(out.schema).option("header", True).csv(f"{base}/csv")
    parquet = t.spark.read.schema(out.schema).parquet(f"{base}/parquet")
    tag = F.lit("csv").alias("format"), F.lit("parquet").alias("format")
    return csv.select(tag[0], "*").union(parquet.select(tag[1], "*"))


_COUNTERS_SQL = """
    SELECT 'order_items' AS "table", 'raw_rows' AS metric, count(*) AS value FROM m_items
    UNION ALL SELECT 'order_items', 'duplicate_key_rows', count(*) - count(DISTINCT OrderItemID) FROM m_items
    UNION ALL SELECT 'customers', 'raw_rows', count(*) FROM m_customers
    UNION ALL SELECT 'customers', 'invalid_age_rows', count(*) FILTER (WHERE Age NOT BETWEEN 0 AND 100) FROM m_customers"""


def _counters(t: Roles) -> DataFrame:
    items, customers = t.items, t.customers
    keys = items.select("OrderItemID").distinct()
    return audit.report(
        [
            audit.rows(items, "order_items", ["raw_rows", "duplicate_key_rows"]),
            audit.rows(keys, "order_items", ["duplicate_key_rows"], sign=-1),
            audit.counters(
                customers, "customers", {"raw_rows": F.lit(True), "invalid_age_rows": ~F.col("Age").between(0, 100)}
            ),
        ]
    )


@query("sink_report", _COUNTERS_SQL)
def sink_report(t: Roles) -> DataFrame:
    path = scratch_path(t.spark, "report")
    write_report(_counters(t), path)
    schema = T.StructType(
        [T.StructField("table", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("value", T.LongType())]
    )
    return t.spark.read.schema(schema).json(path)


@query(
    "dq_summary_wide",
    f"""WITH counted AS ({_COUNTERS_SQL})
        SELECT "table", max(value) FILTER (WHERE metric = 'raw_rows') AS raw_rows,
               max(value) FILTER (WHERE metric = 'duplicate_key_rows') AS duplicate_key_rows,
               max(value) FILTER (WHERE metric = 'invalid_age_rows') AS invalid_age_rows
        FROM counted GROUP BY "table" """,
)
def dq_summary_wide(t: Roles) -> DataFrame:
    return audit.wide_summary(_counters(t), ["raw_rows", "duplicate_key_rows", "invalid_age_rows"])


@query("publish_star", SHOWN_SQL)
def publish_star(t: Roles) -> DataFrame:
    """All twelve tables, published as a version and read back through its manifest."""
    base = scratch_path(t.spark, "star")
    tables = star(t)
    publish_staged(tables, COLUMNS, LOAD_ORDER, base)
    back = read_star(t.spark, base)
    return reduce(DataFrame.unionByName, [shown(name, back[name]) for name in LOAD_ORDER])
