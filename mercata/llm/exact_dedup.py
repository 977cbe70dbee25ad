"""Exact deduplication by content sort, in DataFrame operations only.

Sampled splitters range-partition the rows on (first characters, 64-bit mark of the whole text, slice), so the sampled
keys stay short however long the texts are. Inside a partition an external sort by text places equal texts next to each
other, and each row's text is compared in full with its predecessor's: where they differ, a run begins. The run's first
row carries its best identifier, because equal texts are ordered by identifier.

A text has one slice, hence one run, unless more than ``hot_rows`` rows share its first characters and mark. Those rows
are dealt over slices by identifier and row number, so no task holds a large group, and the heads of their runs, one
per slice, are joined by comparing their whole texts. A digest is returned, but decides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .common import null_safe, shuffle_width, spare_name

HOT_ROWS = 100_000
LEAD = 16

_RUN = ["_lead", "_mark", "_slice", "_run"]


def _order(keep: str, of: str = "_id") -> Column:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    return F.col(of).asc_nulls_last() if keep == "smallest" else F.col(of).desc_nulls_last()


def _runs(rows: DataFrame, keep: str, hot_rows: int) -> DataFrame:
    """rows: _id, _body (no null), others. Adds the run's names, _new on its first row, and _best, its best identifier.

    ``_slice`` is -1 for texts that are not hot. At most rows / hot_rows (lead, mark) are hot, which bounds the broadcast.
    """
    keyed = rows.withColumns({"_lead": F.substring("_body", 1, LEAD), "_mark": F.xxhash64("_body"), "_row": F.monotonically_increasing_id()})
    sizes = keyed.groupBy(F.col("_lead").alias("_l"), F.col("_mark").alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > hot_rows).select("_l", "_m", F.ceil(F.col("_n") / hot_rows).alias("_slices"))
    dealt = F.pmod(F.xxhash64("_id", "_row"), F.col("_slices"))
    sliced = keyed.join(F.broadcast(hot), (F.col("_lead") == F.col("_l")) & (F.col("_mark") == F.col("_m")), "left").withColumn(
        "_slice", F.when(F.col("_slices").isNotNull(), dealt).otherwise(F.lit(-1).cast("long"))
    )
    ranged = sliced.drop("_l", "_m", "_slices", "_row").repartitionByRange(shuffle_width(rows.sparkSession), "_lead", "_mark", "_slice")
    sorted_ = Window.partitionBy("_lead", "_mark", "_slice").orderBy("_body", _order(keep))
    so_far = sorted_.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = ranged.withColumn("_new", ~F.lag("_body").over(sorted_).eqNullSafe(F.col("_body")))
    head = F.last(F.when(F.col("_new"), F.struct("_id")), ignorenulls=True).over(so_far)
    return marked.withColumns({"_run": F.sum(F.col("_new").cast("long")).over(so_far), "_best": head["_id"]})


def content_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text counts as empty. ``keep`` names the identifier that stays.
    Null identifiers lose against any other. Of rows that repeat identifier and text, one is kept. No rows: no
    rows. Other columns are not read, so their names can't clash.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_body"))
    hot_head = F.when((F.col("_slice") >= 0) & F.col("_new"), F.col("_body")).alias("_head")
    runs = stored(
        _runs(rows, keep, hot_rows).select("_id", *_RUN, "_new", "_best", F.sha2("_body", 256).alias("text_sha256"), hot_head), "content-runs"
    )
    counted = runs.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*_RUN)))
    shown = [F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"]
    cold = counted.where("_slice < 0").withColumns({"keep_id": F.col("_best"), "group_size": F.col("_rows"), "kept": F.col("_new")})

    # the runs of a hot text: as many as it has slices
    same = Window.partitionBy("_head")
    heads = runs.where("_slice >= 0").groupBy(*_RUN).agg(F.count(F.lit(1)).alias("_rows"), F.max("_head").alias("_head"), F.first("_best").alias("_best"))
    verdicts = heads.select(
        *_RUN, F.sum("_rows").over(same).alias("group_size"),
        F.first(F.struct("_best", "_slice")).over(same.orderBy(_order(keep, "_best"), "_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_top"),
    )
    hot = runs.where("_slice >= 0").alias("r").join(verdicts.alias("v"), null_safe("r", "v", _RUN)).select(
        "r._id", F.col("_top._best").alias("keep_id"), "group_size", (F.col("_new") & (F.col("r._slice") == F.col("_top._slice"))).alias("kept"), "text_sha256"
    )
    return cold.select(*shown).unionByName(hot.select(*shown))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were; rules as in content_groups."""
    rest, empty = spare_name(docs, "_rest"), spare_name(docs, "_empty")
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_body"),
        F.isnull(text_col).alias(empty), F.struct(*[c for c in docs.columns if c != text_col]).alias(rest),
    )
    heads = stored(_runs(rows, keep, hot_rows).where("_new"), "content-heads")
    first = Window.partitionBy("_body").orderBy(_order(keep, "_best"), "_slice")
    hot = heads.where("_slice >= 0").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    text = F.when(~F.col(empty), F.col("_body")).alias(text_col)
    return heads.where("_slice < 0").unionByName(hot).select(*[text if c == text_col else F.col(f"{rest}.`{c}`").alias(c) for c in docs.columns])
