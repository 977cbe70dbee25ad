"""Positions, ranks and running values without ever sorting a large key in one task, as one lazy plan.

A key with many rows is cut into buckets: literal ranges of the order column, such as months or value ranges, that
the caller names. Windows run inside (key, bucket); one row per hot key and bucket carries totals and edge values
along. Which keys are hot is found inside the plan, by one narrow aggregate: nothing is counted while the plan is
built, nothing is checkpointed, and the plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import ratio

HOT_ROWS = 2_000_000

#: Range expressions in the order of the rows, each with the name of its sort method (``asc``, ``desc_nulls_first``).
Bucket = Sequence[tuple[Column, str]]


def by_month(when: Column, direction: str = "asc") -> Bucket:
    return [(F.trunc(when, "month"), direction)]


def by_range(value: Column, direction: str = "asc", steps: int = 1024) -> Bucket:
    """Ranges of a number, ``steps`` to each doubling of its size; equal numbers share one, missing ones too."""
    value = value.cast("double")
    size = F.floor((F.log2(F.abs(value)) + 1100) * steps)  # positive for every double
    return [(F.when(value == 0, F.lit(0).cast("long")).otherwise(F.signum(value).cast("long") * size), direction)]


@dataclass(frozen=True)
class Running:
    """What to carry along a key: count, sum, mean, max, min (strictly before the row), the previous or next value,
    or size (the rows of the key)."""

    kind: str
    column: Column | str | None = None


def _local(measures: dict[str, Running], parts: Sequence[str], order: Sequence[Column]) -> dict[str, Column]:
    at = Window.partitionBy(*parts).orderBy(*order)
    before = at.rowsBetween(Window.unboundedPreceding, -1)
    out: dict[str, Column] = {}
    for name, m in measures.items():
        if m.kind == "count":
            out[name] = F.count(F.lit(1)).over(before)
        elif m.kind == "sum":
            out[name] = F.coalesce(F.sum(m.column).over(before), F.lit(0))
        elif m.kind == "size":
            out[name] = F.count(F.lit(1)).over(Window.partitionBy(*parts))
        elif m.kind == "mean":
            out[f"{name}_s"] = F.sum(m.column).over(before)
            out[f"{name}_n"] = F.count(m.column).over(before)
        elif m.kind in ("max", "min"):
            out[name] = getattr(F, m.kind)(m.column).over(before)
        elif m.kind == "previous":
            out[name] = F.lag(m.column).over(at)
        elif m.kind == "next":
            out[name] = F.lead(m.column).over(at)
        else:
            raise ValueError(f"unknown running measure {m.kind!r}")
    return out


def _finish(measures: dict[str, Running]) -> list[Column]:
    return [
        ratio(F.col(f"{n}_s"), F.col(f"{n}_n")).alias(n) if m.kind == "mean" else F.col(n)
        for n, m in measures.items()
    ]


def _widest(df: DataFrame, column: Column | str) -> Column:
    """A decimal with all digits there are, so that the type of its sums does not depend on how they are formed."""
    column = F.col(column) if isinstance(column, str) else column
    kind = df.select(column.alias("c")).schema["c"].dataType
    return column.cast(T.DecimalType(38, kind.scale)) if isinstance(kind, T.DecimalType) else column


def _cut(df: DataFrame, keys: Sequence[str], bucket: Bucket, hot_rows: int | None) -> DataFrame:
    """Adds ``_part`` (keys and, for hot keys, the bucket; never null) and ``_hot``.

    At most rows / hot_rows keys are hot, which bounds the broadcast. ``hot_rows`` None: all rows are cut.
    """
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    if hot_rows is None:
        cells = [c.alias(f"b{i}") for i, (c, _) in enumerate(bucket)]
        return df.withColumn("_part", F.struct(*named, *cells)).withColumn("_hot", F.lit(True))
    sizes = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(sizes.filter(F.col("_n") > hot_rows).select(*[f"_k{i}" for i in range(len(keys))], F.lit(True).alias("_hot")))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    cells = [F.when(F.col("_hot"), c).alias(f"b{i}") for i, (c, _) in enumerate(bucket)]
    marked = df.join(hot, same, "left")
    return marked.select(*df.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"), F.struct(*named, *cells).alias("_part"))


def _along(keys: Sequence[str], bucket: Bucket):
    """The order of the buckets of one key."""
    return Window.partitionBy(*[f"_part.k{i}" for i in range(len(keys))]).orderBy(
        *[getattr(F.col(f"_part.b{i}"), direction)() for i, (_, direction) in enumerate(bucket)]
    )


def running_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: dict[str, Running],
    hot_rows: int | None = HOT_ROWS, bucket: Bucket = (),
) -> DataFrame:
    """Running measures per key, in a total order.

    ``bucket`` names ranges along ``order`` (its first columns, or ranges of the first column); keys of more than
    ``hot_rows`` rows are cut there. Without buckets every key is one window, for keys known to be small. ``hot_rows``
    None cuts every key. A sum of decimals is decimal(38, scale).
    """
    columns = df.columns
    measures = {n: Running(m.kind, _widest(df, m.column)) if m.kind == "sum" else m for n, m in measures.items()}
    if not bucket:
        return df.select("*", *[c.alias(n) for n, c in _local(measures, keys, order).items()]).select(*columns, *_finish(measures))
    cut = _cut(df, keys, bucket, hot_rows)
    at = Window.partitionBy("_part").orderBy(*order)
    moves = any(m.kind in ("previous", "next") for m in measures.values())
    place = [F.row_number().over(at).alias("_nth"), F.lead(F.lit(1)).over(at).isNull().alias("_ends")] if moves else []
    inner = cut.select("*", *place, *[c.alias(n) for n, c in _local(measures, ["_part"], order).items()])

    # One row per hot key and bucket: totals and edge values.
    edge: list[Column] = []
    for n, m in measures.items():
        if m.kind in ("count", "size"):
            edge.append(F.count(F.lit(1)).alias(f"_e_{n}"))
        elif m.kind == "sum":
            edge.append(F.sum(m.column).alias(f"_e_{n}"))
        elif m.kind == "mean":
            edge += [F.sum(m.column).alias(f"_e_{n}_s"), F.count(m.column).alias(f"_e_{n}_n")]
        elif m.kind in ("max", "min"):
            edge.append(getattr(F, m.kind)(m.column).alias(f"_e_{n}"))
        elif m.kind == "previous":
            edge.append(F.max_by(m.column, "_nth").alias(f"_e_{n}"))
        else:
            edge.append(F.min_by(m.column, "_nth").alias(f"_e_{n}"))
    edges = (inner if moves else cut).filter("_hot").groupBy("_part").agg(*edge)
    along = _along(keys, bucket)
    earlier, all_ = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry: list[Column] = []
    for n, m in measures.items():
        if m.kind in ("count", "sum"):
            carry.append(F.sum(f"_e_{n}").over(earlier).alias(f"_c_{n}"))
        elif m.kind == "size":
            carry.append(F.sum(f"_e_{n}").over(all_).alias(f"_c_{n}"))
        elif m.kind == "mean":
            carry += [F.sum(f"_e_{n}_{x}").over(earlier).alias(f"_c_{n}_{x}") for x in "sn"]
        elif m.kind in ("max", "min"):
            carry.append(getattr(F, m.kind)(f"_e_{n}").over(earlier).alias(f"_c_{n}"))
        else:
            step = F.lag if m.kind == "previous" else F.lead
            carry.append(step(f"_e_{n}").over(along).alias(f"_c_{n}"))
    joined = inner.join(edges.select("_part", *carry), "_part", "left")
    whole: list[Column] = []
    for n, m in measures.items():
        if m.kind in ("count", "sum"):
            whole.append((F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n))
        elif m.kind == "size":
            whole.append(F.coalesce(f"_c_{n}", n).alias(n))
        elif m.kind == "mean":
            total, seen = (F.coalesce(F.col(f"{n}_{x}"), F.lit(0)) + F.coalesce(F.col(f"_c_{n}_{x}"), F.lit(0)) for x in "sn")
            whole.append(ratio(total, seen).alias(n))
        elif m.kind == "max":
            whole.append(F.greatest(n, f"_c_{n}").alias(n))
        elif m.kind == "min":
            whole.append(F.least(n, f"_c_{n}").alias(n))
        elif m.kind == "previous":
            whole.append(F.when(F.col("_hot") & (F.col("_nth") == 1), F.col(f"_c_{n}")).otherwise(F.col(n)).alias(n))
        else:
            whole.append(F.when(F.col("_hot") & F.col("_ends"), F.col(f"_c_{n}")).otherwise(F.col(n)).alias(n))
    return joined.select(*columns, *whole)


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column], bucket: Bucket) -> DataFrame:
    """Adds, per row, totals over all rows strictly before it. ``order`` must be a total order."""
    return running_by_key(df, [], order, {n: Running("sum", c) for n, c in totals.items()}, None, bucket)


def global_position(df: DataFrame, order: Sequence[Column], bucket: Bucket, name: str = "position") -> DataFrame:
    """1-based row number over the whole table."""
    placed = running_by_key(df, [], order, {name: Running("count")}, None, bucket)
    return placed.withColumn(name, F.col(name) + 1)


def ntile(df: DataFrame, buckets: int, order: Sequence[Column], bucket: Bucket, name: str = "tile") -> DataFrame:
    """NTILE over the whole table: the first n mod k buckets hold one row more."""
    placed = running_by_key(df, [], order, {"_pos": Running("count"), "_rows": Running("size")}, None, bucket)
    at, extra = F.col("_pos"), F.col("_rows") % buckets
    size = F.floor(F.col("_rows") / buckets)
    wide = extra * (size + 1)
    tile = F.when(at < wide, F.floor(at / (size + 1))).otherwise(extra + F.floor((at - wide) / F.greatest(size, F.lit(1))))
    return placed.withColumn(name, (tile + 1).cast("long")).drop("_pos", "_rows")


def nth_smallest(df: DataFrame, value: str, positions: Column, keys: Sequence[str] = (), cell: Column | None = None) -> DataFrame:
    """keys, value, position, before: per key the values at the 0-based ``positions`` and the rows smaller than them.

    ``positions`` is an array over the keys and ``n``, the key's rows with a value. ``cell`` is a range of the value,
    by default ``by_range`` of it.

    Counting narrows the search: rows per range first, then only the ranges that hold a wanted position are looked
    into, by distinct value. Nothing is sorted but the distinct values of those ranges.
    """
    cells = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), (by_range(F.col(value))[0][0] if cell is None else cell).alias("_cell"))
    per_value = cells.groupBy(*keys, "_cell", "_v").agg(F.count(F.lit(1)).alias("_n"))
    per_cell = cells.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    every, before = Window.partitionBy(*keys), (Window.unboundedPreceding, -1)
    placed = per_cell.select(
        *keys, "_cell", "_n", F.sum("_n").over(every).alias("n"),
        F.coalesce(F.sum("_n").over(every.orderBy("_cell").rowsBetween(*before)), F.lit(0)).alias("_from"),
    )
    wanted = placed.withColumn("_at", F.explode(F.array_distinct(positions))).filter((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_from") + F.col("_n")))
    same = F.col("c._cell") == F.col("w._cell")
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}"))
    inside = per_value.alias("c").join(wanted.alias("w"), same).select(*[F.col(f"c.{k}") for k in keys], "w._cell", "_at", "w._from", "c._v", F.col("c._n").alias("_n"))
    up = Window.partitionBy(*keys, "_cell", "_at").orderBy("_v").rowsBetween(*before)
    found = inside.withColumn("_start", F.col("_from") + F.coalesce(F.sum("_n").over(up), F.lit(0)))
    return found.filter((F.col("_at") >= F.col("_start")) & (F.col("_at") < F.col("_start") + F.col("_n"))).select(
        *keys, F.col("_v").alias(value), F.col("_at").alias("position"), F.col("_start").alias("before")
    )


def nth_pair(df: DataFrame, first: str, second: str, positions: Column, keys: Sequence[str] = (), cell: Column | None = None) -> DataFrame:
    """keys, first, second, position: per key the pairs at the 0-based ``positions`` in the order of (first, second).

    Both columns hold numbers; (first, second) is unique within a key. Only rows that share a found ``first`` are looked at
    again. There are as many rows as keys times positions, which must be few.
    """
    at = nth_smallest(df.select(*keys, first), first, positions, keys, cell)
    same = F.col("r.first") == F.col("a.first")
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"a.{k}"))
    rows = df.select(*keys, F.col(first).alias("first"), F.col(second).alias("second")).alias("r")
    tied = rows.join(F.broadcast(at.withColumnRenamed(first, "first")).alias("a"), same).select(
        *[F.col(f"r.{k}").alias(k) for k in keys], "r.first", "r.second", (F.col("a.position") - F.col("a.before")).alias("step"), F.col("a.position").alias("place")
    )
    found = nth_smallest(tied, "second", F.array("step"), [*keys, "first", "step", "place"])
    return found.select(*keys, F.col("first").alias(first), F.col("second").alias(second), F.col("place").alias("position"))


def exact_median(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, median: the middle value, or the mean of the two middle ones, as double; no row where there is no value."""
    middle = F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))
    return nth_smallest(df, value, middle, keys).groupBy(*keys).agg(F.avg(F.col(value).cast("double")).alias("median"))


def rank_within(df: DataFrame, keys: Sequence[str], value: str, tie: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Adds row_num, rank_num and dense_rank_num by descending value (missing values first); ``tie`` is a number.

    Keys of more than ``hot_rows`` rows are cut by ranges of the value, and their rows without a value by ranges of
    ``tie``. Equal values share a range, so ranks inside it need only the counts of the ranges before.
    """
    down, missing = F.col(value).desc_nulls_first(), F.col(value).isNull()
    of_tie = F.when(missing, by_range(F.col(tie))[0][0])
    bucket = [*by_range(F.col(value), "desc_nulls_first"), (of_tie, "asc")]
    cut = _cut(df, keys, bucket, hot_rows)
    by_row, by_value = Window.partitionBy("_part").orderBy(down, F.col(tie).asc()), Window.partitionBy("_part").orderBy(down)
    inner = cut.select(
        "*", F.row_number().over(by_row).alias("_row"), F.rank().over(by_value).alias("_rank"), F.dense_rank().over(by_value).alias("_dense")
    )
    edges = cut.filter("_hot").groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.count_distinct(value).alias("_values"), F.max(missing.cast("int")).alias("_none")
    )
    earlier = _along(keys, bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        "_part", F.sum("_n").over(earlier).alias("_before"),
        (F.sum("_values").over(earlier) + F.max("_none").over(earlier)).alias("_values_before"),
    )
    joined = inner.join(carried, "_part", "left")
    rows, values = F.coalesce("_before", F.lit(0)), F.coalesce("_values_before", F.lit(0))
    first = F.lit(1).cast("long")  # rows without a value tie for the first place
    return joined.select(
        *df.columns, (F.col("_row") + rows).cast("long").alias("row_num"),
        F.when(missing, first).otherwise(F.col("_rank") + rows).cast("long").alias("rank_num"),
        F.when(missing, first).otherwise(F.col("_dense") + values).cast("long").alias("dense_rank_num"),
    )


def top_within(
    df: DataFrame, keys: Sequence[str], value: str, limit: int, dense: bool = False, name: str = "city_rank"
) -> DataFrame:
    """Rows of rank <= limit per key; the rank filter becomes a group limit before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_first())
    rank = F.dense_rank() if dense else F.rank()
    return df.withColumn(name, rank.over(window).cast("long")).filter(F.col(name) <= limit)
