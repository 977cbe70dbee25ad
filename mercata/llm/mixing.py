"""Mixing sources to target weights by subset-sum budget fitting.

Targets are filled like connected vessels: every source's level rises with its weight until it reaches its limit. Of a
source, whole passes over all documents are taken first. For what remains of its budget, documents are counted by
exact length: most of it is taken evenly over all lengths, and a bounded-knapsack dynamic programme over the counts
that are left hits the last part exactly, if any set of documents can. Which documents of a length are taken is
decided by a seeded hash, whose buckets are counted before rows are ranked, so no length of any source is ranked in
one task. The programme sees one row per source and length, never documents.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import stored
from .common import WORD, null_safe, spare_name

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
#: Hash buckets in which the documents of one source and length are counted and ranked.
BUCKETS = 1024
#: Bits of the knapsack programme's table: it decides about half as many words, as sums up to twice those are looked at.
EXACT_WORDS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Iterable[float] = WEIGHTS, share: float = 1.0, passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, target for rows (source, size). Sources by code point, null last; weights repeat.

    Targets share ``share`` of all sizes by weight; none is above ``passes`` times its source's size, and what is cut
    off goes to the others by weight. The windows run over one row per source.
    """
    weights = list(weights)
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    every = Window.partitionBy(F.lit(1))
    listed = totals.withColumn("at", F.row_number().over(order) - 1).withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights)).cast("int") + 1),
        "cap": F.lit(float(passes)) * F.col("source_size"),
        "budget": F.lit(float(share)) * F.sum("source_size").over(every),
    })
    first = Window.orderBy(F.col("cap") / F.col("weight"), "at")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    rest = first.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    # the level rises while sources reach their limits and falls from the first that does not
    leveled = listed.withColumn("level", level).withColumn("common", F.max("level").over(every))
    target = F.least("cap", F.col("weight") * F.col("common"))
    return leveled.select("source", "source_size", target.alias("target"))


def exact_fill(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each length to take, at most ``counts``, so that the sum is as near ``budget`` as any (the smaller of equals).

    Bounded knapsack: a length taken up to c times is split into parts of 1, 2, 4, ... copies; bit s of ``reach`` says
    that sum s can be made of the parts so far, and ``via`` keeps the part that made s first, which leads back.
    """
    sizes = sorted((n for n, c in counts.items() if n > 0 and c > 0), reverse=True)
    most = budget + min(budget, sizes[0] if sizes else 0)  # 0 is always reached, so no sum above twice the budget is nearer
    parts, reach, via, mask = [], 1, {}, (1 << (most + 1)) - 1
    for n in sizes:
        left, copies = min(counts[n], most // n), 1
        while left > 0 and not reach >> budget & 1:
            k = min(copies, left)
            fresh = (reach << n * k) & mask & ~reach
            reach |= fresh
            while fresh:
                low = fresh & -fresh
                via[low.bit_length() - 1] = len(parts)
                fresh ^= low
            parts.append((n, k))
            left, copies = left - k, copies * 2
    best = min((s for s in (*via, 0)), key=lambda s: (abs(s - budget), s))
    taken: dict[int, int] = {}
    while best:
        n, k = parts[via[best]]
        taken[n] = taken.get(n, 0) + k
        best -= n * k
    return taken


def fit_budget(counts: dict[int, int], budget: int, exact_words: int = EXACT_WORDS) -> dict[int, int]:
    """Counts per length whose sum meets ``budget``: evenly over the lengths first, the last ``exact_words // 2`` or a little more exactly."""
    total = sum(n * c for n, c in counts.items())
    budget = max(0, min(budget, total))
    even, carry, taken = max(0, budget - exact_words // 2), 0, {}
    for n in sorted((n for n in counts if n > 0), reverse=True):
        carry += n * counts[n] * even  # in units of 1 / total, so that nothing is lost to rounding
        taken[n] = min(counts[n], carry // (n * total)) if total else 0
        carry -= n * taken[n] * total
    left = budget - sum(n * k for n, k in taken.items())
    for n, k in exact_fill({n: counts[n] - k for n, k in taken.items()}, left).items():
        taken[n] += k
    return taken


def row_prints(docs: DataFrame) -> list[Column]:
    """128 bits that tell whole rows apart, as two hashes. Hashes pass over nulls, so it is told which columns are null;
    columns that hold others go in as JSON, which also serves maps."""
    parts = []
    for field in docs.schema:
        c = F.col(f"`{field.name}`")
        holds_others = isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType)
        parts += [c.isNull(), F.to_json(F.struct(c)) if holds_others else c]
    return [F.xxhash64(F.lit(start), *parts) for start in (1, 2)]


def mix_counts(
    docs: DataFrame, weights: Iterable[float] = WEIGHTS, share: float = 1.0, passes: int = MAX_PASSES, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", prints: Iterable[Column] = (),
) -> DataFrame:
    """id, source, size, source_size, target, copies, taken (copies x size), one row per row of ``docs``.

    A null text has no words. A null source is a source of its own, the last. No document is taken more than
    ``passes`` times; documents without words are taken in whole passes only. Rows that repeat an identifier are
    documents of their own, ranked by ``prints``, which follow as print0, print1, ...; texts are not carried.
    """
    told = {f"print{i}": c for i, c in enumerate(prints)}
    rank = told or {"print0": F.lit(0)}
    picked = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        *[c.alias(name) for name, c in rank.items()],
    )
    draw = F.xxhash64(F.lit(seed), F.col("id"))
    sized = stored(picked.withColumns({"draw": draw, "bucket": F.pmod(F.shiftright(draw, 20), F.lit(BUCKETS))}), "mix-sizes")
    targets = stored(source_targets(sized.select("source", "size"), weights, share, passes), "mix-targets")
    per_bucket = sized.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    per_size = per_bucket.groupBy("source", "size").agg(F.sum("n").alias("n"))
    p, t = per_size.alias("p"), targets.alias("t")
    counted = p.join(t, null_safe("p", "t", ["source"])).select("p.source", "size", "n", "source_size", "target")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        whole, target = int(frame["source_size"].iloc[0]), int(frame["target"].iloc[0] + 0.5)
        done = min(target // whole, passes) if whole else 0
        extra = fit_budget(dict(zip(frame["size"].tolist(), frame["n"].tolist())), target - done * whole) if done < passes else {}
        return pd.DataFrame({
            "source": frame["source"], "size": frame["size"], "done": done, "extra": [extra.get(n, 0) for n in frame["size"].tolist()],
        })

    fitted = counted.groupBy("source").applyInPandas(fit, "source string, size long, done int, extra long")
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    o, f = offsets.alias("o"), fitted.alias("f")
    plan = o.join(f, null_safe("o", "f", ["source", "size"])).select("o.source", "o.size", "bucket", "before", "done", "extra")
    pl, t2 = plan.alias("pl"), targets.alias("t2")
    plan = pl.join(t2, null_safe("pl", "t2", ["source"])).select("pl.*", "source_size", "target")
    in_bucket = Window.partitionBy("source", "size", "bucket").orderBy("draw", "id", *rank)
    ranked = sized.withColumn("place", F.row_number().over(in_bucket)).alias("r")
    copies = F.col("done") + F.when(F.col("before") + F.col("place") <= F.col("extra"), 1).otherwise(0)
    out = ranked.join(plan.alias("q"), null_safe("r", "q", ["source", "size", "bucket"]))
    return out.select(
        F.col("r.id").alias("id"), F.col("r.source").alias("source"), F.col("r.size").alias("size"), "source_size", "target",
        copies.cast("long").alias("copies"), (copies * F.col("r.size")).cast("long").alias("taken"), *[f"r.{name}" for name in told],
    )


def mix(
    docs: DataFrame, weights: Iterable[float] = WEIGHTS, share: float = 1.0, passes: int = MAX_PASSES, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them (0 to ``passes`` times), all columns as they were.

    It is decided on identifiers, lengths and hashes of the rows; whole rows meet the decision once. Equal rows are
    interchangeable: their copies are added up and made of one of them. ``docs`` is read more than once and must
    give the same rows each time, as a table does.
    """
    one, two, copies, row = (spare_name(docs, wish) for wish in ("print_one", "print_two", "copies", "whole_row"))
    decided = mix_counts(docs, weights, share, passes, seed, id_col, text_col, source_col, row_prints(docs))
    added_up = decided.groupBy(F.col("print0").alias(one), F.col("print1").alias(two)).agg(
        F.sum("copies").alias(copies), F.count(F.lit(1)).alias("rows")
    )
    taken = stored(added_up.where(F.col(copies) > 0), "mix-taken")
    # a table of its own, so that Spark knows beforehand how small it is: mostly nothing
    repeated = stored(taken.where("rows > 1").drop("rows"), "mix-repeated")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumns(dict(zip((one, two), row_prints(docs))))
    alone = marked.join(taken.where("rows = 1").drop("rows"), [one, two]).select(*columns, copies)
    equals = marked.join(repeated, [one, two]).groupBy(one, two, copies).agg(F.first(F.struct(*columns)).alias(row))
    equals = equals.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns], copies)
    many = alone.unionByName(equals).withColumn(one, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return many.select(*columns)
