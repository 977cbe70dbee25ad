"""Pairs of rows of one group whose values lie far apart: the first pairs by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordering import HOT_ROWS, Running, by_range, running_by_key


def first_distant_pairs(
    df: DataFrame, group: str, id_: str, value: str, gap: float, limit: int, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """The ``limit`` smallest pairs (a, b), a < b, of one group with |value_a - value_b| > gap.

    A row opens some pair exactly if the largest or smallest value among later ids of its group is
    more than ``gap`` away. At most ``limit`` openers can appear in the answer, so only those
    (a bounded broadcast) meet the table: work is linear, never all pairs of a group.
    """
    rows = df.select(group, id_, value).filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    later = running_by_key(
        rows, [group], [F.col(id_).desc()], {"_hi": Running("max", value), "_lo": Running("min", value)}, hot_rows,
        by_range(F.col(id_), "desc"),
    )
    opens = (F.col("_hi") - F.col(value) > gap) | (F.col(value) - F.col("_lo") > gap)
    openers = (
        later.filter(opens)
        .orderBy(id_)
        .limit(limit)
        .select(group, F.col(id_).alias("a"), F.col(value).alias("value_a"))
    )
    others = rows.select(group, F.col(id_).alias("b"), F.col(value).alias("value_b"))
    return (
        others.join(F.broadcast(openers), group)
        .filter((F.col("a") < F.col("b")) & (F.abs(F.col("value_a") - F.col("value_b")) > gap))
        .select("a", "b", group, "value_a", "value_b")
        .orderBy("a", "b")
        .limit(limit)
    )
