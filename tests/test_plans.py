"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from mercata.catalog import QUERIES
from mercata.catalog.feature_queries import domain_tables
from mercata.catalog.roles import Roles
from mercata.operators.ordering import top_within
from mercata.plans import features, kpis

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "executive_kpis", "city_performance", "restaurant_scorecard", "customer_rfm", "traffic_effect_hourly", "weather_effect",
    "measures_by_month", "asof_nearest", "daily_conditions", "churn_features_all", "parse_mixed_dates", "normalize_city",
    "fk_filter_multi", "financial_rebuild", "last_order_cancelled", "recency_rank", "lag_lead", "prior_mean", "partner_pairs",
    "order_base", "nearest_traffic", "basket_features", "tune_threshold", "histogram", "last_six_months", "above_avg_cost",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


@pytest.mark.parametrize(
    "build",
    [
        lambda t: kpis.lag_lead(t.order_heads), lambda t: kpis.rank_three_ways(t.orders, t.restaurants),
        lambda t: kpis.partner_top_decile(t.partners), lambda t: features.prior_history(features.delivered_orders(t.orders), "CustomerID", "Customer", True),
        lambda t: features.nearest_traffic(features.delivered_orders(t.orders).withColumn("RestaurantCity", F.lit("x")), t.traffic, key="OrderID"),
    ],
)
def test_no_job_while_planning(spark, build):
    t = Roles(spark, SF)
    build(t)  # schemas and role sizes are read once
    spark.sparkContext.setJobGroup("planning", "")
    try:
        build(t)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setJobGroup("after", "")


def test_delivery_features_build_the_orders_and_the_wide_rows_once(spark):
    """The histories and the traffic search read written orders; neither builds the wide rows again."""
    table = features.delivery_features(domain_tables(Roles(spark, SF)))
    text = table._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[o_orderkey", text)) == 1  # the registration dates of the customers


def test_hot_keys_do_not_change_the_plan(spark):
    """The one plan holds windows inside (key, bucket) only; no window holds a whole customer."""
    text = plan(QUERIES["lag_lead"](spark, SF))
    assert "_part" in text and not re.search(r"Window \[[^\]]*\], \[CustomerID", text)


def test_churn_history_does_not_multiply_orders(spark):
    """Distinct counts come from marked rows of a first aggregate, not from copies of every order."""
    assert "Expand" not in plan(QUERIES["churn_features_all"](spark, SF))


def test_group_limits_before_the_shuffle(spark):
    t = Roles(spark, SF)
    text = plan(top_within(t.items, ["FoodItemID"], "TotalPrice", 3))
    assert text.count("WindowGroupLimit") == 2
    from mercata.operators.dedupe import keep_first

    assert plan(keep_first(t.items, ["OrderItemID"], ["TotalPrice"])).count("WindowGroupLimit") == 2


def test_top_n_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_n"](spark, SF))


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").selectExpr(
        "o_orderkey OrderID", "o_custkey CustomerID", "o_orderstatus OrderStatus", "o_totalprice FinalAmount",
        "cast(o_orderdate as date) OrderDate", "o_orderpriority PaymentMethod",
    )
    text = plan(o.filter("OrderStatus in ('F', 'O')").groupBy("CustomerID").sum("FinalAmount"))
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in text
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>", text)
    assert "o_orderpriority" not in plan(kpis.monthly_revenue_mom(Roles(spark, SF).order_heads)).split("ReadSchema")[1]


def test_facts_are_reduced_before_the_dimension_join(spark):
    text = plan(QUERIES["restaurant_scorecard"](spark, SF))
    join = min(text.find(k) for k in ("BroadcastHashJoin [RestaurantID", "SortMergeJoin [RestaurantID", "ShuffledHashJoin [RestaurantID") if k in text)
    assert "HashAggregate(keys=[RestaurantID" in text[join:]


def test_texts_are_read_once(spark):
    from mercata.catalog.cleaning_queries import raw_tables
    from mercata.functions import normalize_city
    from mercata.plans.cleaning import numeric
    from mercata.plans.domain import NUMBERS

    def expressions(df) -> str:
        return df._jdf.queryExecution().optimizedPlan().toString()

    t = Roles(spark, SF)
    assert expressions(t.dirty_cities.select(normalize_city(F.col("CityText")).alias("city"))).count("regexp_replace(") == 1
    menu = raw_tables(t)["menu"]
    kinds = [kind for column, kind in NUMBERS["menu"].items() if column in menu.columns]
    assert expressions(numeric(menu, "menu")).count("RLIKE") == sum(2 if kind == "id" else 1 for kind in kinds)
