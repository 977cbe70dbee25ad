"""Grouped summaries that reduce before they shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import average, ratio


def value_counts(df: DataFrame, column: str, name: str = "rows") -> DataFrame:
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.col(name).desc(), F.col(column).asc())


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum belongs to the last bin. Empty bins are absent."""
    present = df.filter(F.col(column).isNotNull())
    ends = present.agg(F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")).alias("ends")).scalar()
    low = ends["low"]
    width = (ends["high"] - low) / bins
    place = F.when(width > 0, F.floor((F.col(column) - low) / width)).otherwise(0)
    binned = present.select(*by, F.least(place, F.lit(bins - 1)).cast("long").alias("bin"))
    counted = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(*by, "bin", (low + F.col("bin") * width).alias("bin_start"), "rows")


def daily_conditions(df: DataFrame, keys: Sequence[str], measures: Sequence[str], label: str) -> DataFrame:
    """One row per key: mean of each measure and the most common label (smallest of equals).

    Rows are first summed per key and label, so both steps are plain hash aggregates over sums.
    """
    sums = [F.sum(m).alias(f"_s_{m}") for m in measures] + [F.count(m).alias(f"_n_{m}") for m in measures]
    per_label = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_rows"), *sums)
    vote = F.when(F.col(label).isNotNull(), F.struct(-F.col("_rows"), F.col(label)))
    return per_label.groupBy(*keys).agg(
        *[ratio(F.sum(f"_s_{m}"), F.sum(f"_n_{m}")).alias(m) for m in measures], F.min_by(label, vote).alias(label)
    )


def basket(items: DataFrame, menu: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Per order: lines, quantity, value, prices, preparation and calories; empty sums are 0.

    The lines of an order are brought together once, as they are, and then summed per category and per order in place.
    ``keep`` may write the lines with their dishes under a label and read them back.
    """
    dishes = menu.select("FoodItemID", "PreparationTime", "Category", "Calories")
    lines = items.join(dishes, "FoodItemID", "left").select(
        "OrderID", "Category", "Quantity", "TotalPrice", "UnitPrice", "PreparationTime", "Calories", F.col("OrderItemID").isNotNull().alias("_line")
    )
    lines = (keep(lines, "basket-lines") if keep else lines).withColumns(
        {
            "_prep": F.col("Quantity") * F.col("PreparationTime"),
            "_cal": F.col("Quantity") * F.col("Calories"),
        }
    )

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    sums = {"TotalQuantity": "Quantity", "BasketItemValue": "TotalPrice", "_unit": "UnitPrice", "_minutes": "PreparationTime", "_prep": "_prep", "WeightedCalories": "_cal"}
    counts = {"ItemLines": "OrderItemID", "_units": "UnitPrice", "_minutes_n": "PreparationTime"}
    together = lines.select("OrderID", "Category", *dict.fromkeys(sums.values()), "_line").repartition("OrderID")
    counted = {"OrderItemID": F.when(F.col("_line"), F.lit(1))}
    per_category = together.groupBy("OrderID", "Category").agg(
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[F.count(counted.get(c, F.col(c))).alias(name) for name, c in counts.items()],
        F.max("PreparationTime").alias("MaxPrepTime"),
    )
    kinds = dict(per_category.dtypes)  # a sum of sums would widen a decimal once more
    grouped = per_category.groupBy("OrderID").agg(
        F.sum("ItemLines").alias("ItemLines"),
        *[total(c).cast(kinds[c]).alias(c) for c in ("TotalQuantity", "BasketItemValue")],
        ratio(F.sum("_unit"), F.sum("_units")).alias("AvgUnitPrice"),
        F.max("MaxPrepTime").alias("MaxPrepTime"),
        ratio(F.sum("_minutes"), F.sum("_minutes_n")).alias("MeanPrepTime"),
        *[total(c).cast(kinds[c]).alias(c) for c in ("_prep", "WeightedCalories")],
        F.count("Category").alias("MenuCategoryCount"),
    )
    weighted = ratio(F.col("_prep"), F.col("TotalQuantity")).alias("WeightedPrepTime")
    return grouped.select("*", weighted).drop("_prep")


def item_sums(items: DataFrame) -> DataFrame:
    """Per order: item cost, lines and quantity, ready to join without fan-out."""
    return items.groupBy("OrderID").agg(
        F.sum("TotalPrice").alias("ItemFoodCost"),
        F.count("OrderItemID").alias("ItemLines"),
        F.sum("Quantity").alias("TotalQuantity"),
    )


def rank_by_date(df: DataFrame, key: str, date: str) -> DataFrame:
    """Per key its last date, and RANK over all keys by that date, oldest first.

    Keys are counted per date first, so the ordered step sees one row per calendar day.
    """
    last = df.groupBy(key).agg(F.max(date).alias("last_order_date"))
    per_day = last.groupBy("last_order_date").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(F.col("last_order_date").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_day.select(
        F.col("last_order_date").alias("_day"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1).cast("long").alias("recency_rank"),
    )
    return last.join(ranks, F.col("last_order_date").eqNullSafe(F.col("_day"))).drop("_day")
