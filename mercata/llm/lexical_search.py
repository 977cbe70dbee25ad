"""Ranked lexical search with K2-treaps over term-document grids.

The documents of a task, in pieces of bounded size, form shards. A shard's grid has a row per term and a column per
document (ascending by identifier); a cell holds the document's impact for the term. The grid is a K2-treap: a quadtree
of 4-bit child masks, compressed by leaving out empty quarters, in which every node also keeps the largest impact below
it, stored as the difference from its parent's.

A query follows one row path per term. All its paths go down together: a state is a range of documents with the node of
each term over it, and its bound is the weighted sum of the nodes' maxima. The states of highest bound are split first,
in batches; at a single document the bound is the score. Ranges whose bound cannot enter the best ``top`` are
dropped, and what a task knows of the best carries over from shard to shard, so the result is exact.

Scores: with N documents that have a term, L terms in them, n in a document, df documents with a term and tf of it
in a document, w = floor(1000 ln((2N+2)/(2df+1))), m = 10 + (90 n N) div L, and a document's score is the sum of
w * ((10^9 tf) div (1000 tf + 8 m)).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import stored

SHARD_DOCS = 4096
SHARD_CELLS = 1 << 20
BLOCK_BYTES = 8 << 20
BATCH = 512

#: Fixed value: a term is a run of characters other than these, that is, of 0-9, A-Z, a-z and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The same on bytes: A-Z to a-z, other bytes of terms kept, the rest to spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLD).split()


def spread(x: np.ndarray) -> np.ndarray:
    """Moves bit i to bit 2i."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def treap(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, height: int) -> bytes:
    """A K2-treap of the cells: masks of all levels, and every node's maximum as the difference from its parent's."""
    code = (spread(rows) << np.uint64(1)) | spread(cols)
    order = np.argsort(code)
    code, peak = code[order], values[order].astype(np.int32)
    masks, drops = [], []
    for _ in range(height):
        above = code >> np.uint64(2)
        starts = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        masks.append(np.bitwise_or.reduceat((1 << (code & np.uint64(3)).astype(np.int64)), starts).astype(np.uint8))
        top = np.maximum.reduceat(peak, starts)
        drops.append(np.repeat(top, np.diff(np.r_[starts, len(code)])) - peak)
        code, peak = above[starts], top
    body = np.concatenate(masks[::-1]).tobytes() + peak.tobytes() + np.concatenate(drops[::-1]).astype(np.int32).tobytes()
    return zstandard.compress(body, 1)


class Treap:
    """A loaded K2-treap. Nodes are numbered level by level; number -1 is the empty node."""

    def __init__(self, blob: bytes, height: int):
        body = np.frombuffer(zstandard.decompress(blob), np.uint8)
        self.height = height
        sizes, at = [1], 0
        for _ in range(height):
            sizes.append(int(_BITS[body[at : at + sizes[-1]]].sum()))
            at += sizes[-2]
        self.masks = np.zeros(sum(sizes) + 1, np.uint8)  # the last one is the empty node; documents have no children
        self.masks[:at] = body[:at]
        count = _BITS[self.masks[:at]]
        self.first = np.zeros(len(self.masks), np.int32)
        self.first[:at] = 1 + np.cumsum(count) - count
        drops = np.frombuffer(body[at:].tobytes(), np.int32)
        peaks = np.zeros(len(self.masks), np.int64)
        peaks[0], start = drops[0], 0
        for level in range(height):
            size, below = sizes[level], sizes[level + 1]
            inside = np.repeat(peaks[start : start + size], count[start : start + size])
            peaks[start + size : start + size + below] = inside - drops[start + size : start + size + below]
            start += size
        self.peaks = peaks

    def best(self, rows: np.ndarray, weights: np.ndarray, top: int, floor: int, before: int) -> list[tuple[int, int]]:
        """(score, column) of the ``top`` columns by weighted sum over ``rows``, equal sums by ascending column.

        Only sums above ``floor``, or equal to it in a column under ``before``, are wanted.
        """
        height = self.height
        nodes, level, col = np.zeros((1, len(rows)), np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = np.array([(weights * self.peaks[0]).sum()])
        found: list[tuple[int, int]] = []
        while len(bound):
            keep = (bound > floor) | ((bound == floor) & ((col << (height - level)) < before))
            if not keep.all():
                nodes, level, col, bound = nodes[keep], level[keep], col[keep], bound[keep]
                if not len(bound):
                    break
            if len(bound) > BATCH:
                order = np.argpartition(-bound, BATCH)
                take, rest = order[:BATCH], order[BATCH:]
            else:
                take, rest = slice(None), slice(0)
            here, at = nodes[take], level[take]
            mask, first = self.masks[here], self.first[here]
            upper = ((rows >> (height - 1 - at)[:, None]) & 1) << 1
            parts = [(nodes[rest], level[rest], col[rest], bound[rest])]
            for half in (0, 1):
                quarter = upper + half
                child = np.where((mask >> quarter) & 1, first + _BITS[mask & ((1 << quarter) - 1)], -1)
                sums = (self.peaks[child] * weights).sum(axis=1)
                alive = sums > 0
                parts.append((child[alive], at[alive] + 1, 2 * col[take][alive] + half, sums[alive]))
            nodes, level, col, bound = (np.concatenate(x) for x in zip(*parts))
            done = level == height
            if done.any():
                found += zip(bound[done].tolist(), col[done].tolist())
                found.sort(key=lambda x: (-x[0], x[1]))
                del found[top:]
                if len(found) == top and (found[-1][0] > floor or (found[-1][0] == floor and found[-1][1] < before)):
                    floor, before = found[-1]
                nodes, level, col, bound = nodes[~done], level[~done], col[~done], bound[~done]
        return [x for x in found if x[0] > floor or (x[0] == floor and x[1] <= before)]


@dataclass
class Index:
    """``shards``: ids, terms, height, treap; ``lexicon``: term, df; the corpus' documents and terms."""

    shards: DataFrame
    lexicon: DataFrame
    n_docs: int
    n_terms: int


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_cells: int = SHARD_CELLS) -> Index:
    """Index of whole texts. A null text, or one without a term, is in no shard and does not count.

    Rows with equal or null identifiers are documents of their own. No rows: an index that finds nothing. Other
    columns are not read. A shard ends with the document that reaches ``shard_docs`` or ``shard_cells``.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = T.StructType([
        T.StructField("ids", T.ArrayType(kind)), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("df", T.ArrayType(T.LongType())), T.StructField("cells", T.BinaryType()), T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()),
    ])

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = None

        def flush() -> pa.RecordBatch:
            by_id = sorted(range(len(held)), key=lambda i: (held[i][0] is None, held[i][0]))
            row = np.fromiter((r for i in by_id for r in held[i][2]), np.int32)
            tf = np.fromiter((t for i in by_id for t in held[i][3]), np.int32)
            df = np.bincount(row, minlength=len(names))
            order = np.argsort(-df, kind="stable")  # frequent terms together, which keeps the grid's full part small
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            words = [w.decode("utf-8") for w in names]
            n = [held[i][1] for i in by_id]
            cells = zstandard.compress(np.array([len(held[i][2]) for i in by_id], np.int32).tobytes() + place[row].tobytes() + tf.tobytes(), 1)
            row_out = [[held[i][0] for i in by_id], n, [words[i] for i in order], df[order].tolist(), cells, len(n), sum(n)]
            return pa.RecordBatch.from_arrays([pa.array([value], type=field) for value, field in zip(row_out, shape)], names=counted.names)

        def empty() -> None:
            nonlocal held, names, cells
            held, names, cells = [], defaultdict(), 0
            names.default_factory = names.__len__

        held, names, cells = [], defaultdict(), 0
        empty()
        for frame in frames:
            shape = [pa.list_(frame.schema.field("id").type), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64()]
            for id_, text in zip(frame.column("id").to_pylist(), frame.column("text")):
                tf = Counter(terms_of(text.as_py()))
                if not tf:
                    continue
                held.append((id_, tf.total(), np.fromiter(map(names.__getitem__, tf), np.int32, len(tf)), np.fromiter(tf.values(), np.int32, len(tf))))
                cells += len(tf)
                if len(held) >= shard_docs or cells >= shard_cells:
                    yield flush()
                    empty()
        if held:
            yield flush()

    raw = stored(rows.mapInArrow(count, counted), "term-counts")
    pairs = raw.select(F.explode(F.arrays_zip("terms", "df")).alias("p"))
    lexicon = stored(pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.df").alias("df")), "lexicon")
    n_docs, n_terms = raw.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    shape = T.StructType([counted["ids"], counted["terms"], T.StructField("height", T.IntegerType()), T.StructField("treap", T.BinaryType())])

    def grow(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                n = np.array(frame.column("n")[i].as_py(), np.int64)
                width = len(frame.column("terms")[i])
                body = np.frombuffer(zstandard.decompress(frame.column("cells")[i].as_py()), np.int32)
                sizes, (row, tf) = body[: len(n)], body[len(n) :].reshape(2, -1)
                col = np.repeat(np.arange(len(n)), sizes)
                m = 10 + (90 * n * n_docs) // n_terms
                tf = tf.astype(np.int64)
                height = max(1, (max(width, len(n)) - 1).bit_length())
                blob = treap(row, col, (1_000_000_000 * tf) // (1000 * tf + 8 * m[col]), height)
                yield pa.RecordBatch.from_arrays(
                    [frame.column("ids").slice(i, 1), frame.column("terms").slice(i, 1), pa.array([height], pa.int32()), pa.array([blob], pa.binary())],
                    names=shape.names,
                )

    return Index(stored(raw.select("ids", "n", "terms", "cells").mapInArrow(grow, shape), "treaps"), lexicon, n_docs, n_terms)


def weight(df: str, n_docs: int) -> Column:
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col(df) + F.lit(1.0)))).cast("long")


def search(index: Index, items: DataFrame, top: int = 10, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item, item_id, rank, doc_id, score: the ``top`` documents of score above 0 of each row of ``items``, best first.

    Equal scores go by ascending document identifier, null last. Every row of ``items`` is an item of its own, ``item``
    its number; an item without a known term (or with a null text) has no rows. Items are asked in blocks of about
    ``block_bytes`` of terms, and only one block at a time is held by the driver and sent to the tasks.
    """
    spark = items.sparkSession
    kind = index.shards.schema["ids"].dataType.elementType
    folded = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("terms"))
    numbered = stored(numbered, "items")
    asked = numbered.select("item", F.explode("terms").alias("term")).join(index.lexicon, "term")
    asked = asked.withColumn("w", weight("df", index.n_docs)).filter("w > 0")
    size = asked.agg(F.sum(F.length(F.encode("term", "utf-8")) + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    lists = asked.groupBy("item").agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("w"))
    lists = stored(lists.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "asked")
    shape = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def ask(block):
        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = {term for _, terms, _ in block.value for term in terms}
            best: dict[int, list] = {}
            kind_ = None
            for frame in frames:
                kind_ = frame.schema.field("ids").type.value_type
                for i in range(frame.num_rows):
                    rows = {term: at for at, term in enumerate(frame.column("terms")[i].as_py()) if term in wanted}
                    ids = frame.column("ids")[i].as_py()
                    keys = [(x is None, x) for x in ids]
                    grid = Treap(frame.column("treap")[i].as_py(), frame.column("height")[i].as_py())
                    for item, terms, weights in block.value:
                        mine = [(rows[t], w) for t, w in zip(terms, weights) if t in rows]
                        if not mine:
                            continue
                        held = best.get(item, [])
                        full = len(held) == top
                        floor, before = (held[-1][0], bisect_left(keys, held[-1][1])) if full else (0, 0)
                        row, w = np.array(mine, np.int64).T
                        new = grid.best(row, w, top, floor, before)
                        if new:
                            held = held + [(score, keys[col]) for score, col in new]
                            held.sort(key=lambda x: (-x[0], x[1]))
                            best[item] = held[:top]
            out = [(item, key[1], score) for item, held in best.items() for score, key in held]
            if out:
                items_, ids_, scores = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(items_, pa.int64()), pa.array(ids_, kind_), pa.array(scores, pa.int64())], names=shape.names)

        return run

    found = spark.createDataFrame([], shape)
    for number in range(blocks):
        block = [tuple(r) for r in lists.filter(F.col("block") == number).select("item", "terms", "w").collect()]
        if block:
            found = found.unionByName(index.shards.mapInArrow(ask(spark.sparkContext.broadcast(block)), shape))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item", "item_id", "rank", "doc_id", "score")
