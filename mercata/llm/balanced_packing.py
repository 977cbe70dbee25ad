"""Cost-balanced packing of documents into sequences of a fixed length.

A piece of n tokens costs ``6 * width * n + n * n``: the layers' matrix work grows with its tokens, attention inside
the piece with their square. Pieces are taken in descending length, which is descending cost, and each goes to the
sequence of lowest cost that still has room for it. So sequences end with about equal work, not only equal length.

A group of documents opens exactly as many sequences as its tokens fill: whole ones, and for the remainder one for
each binary digit, whose length is a power of two and needs no padding. Room and tokens are equal in sum, so nothing is
padded; a piece that fits nowhere is cut at the widest room left, and its rest waits for its turn by length.

Rows are dealt to tasks by row number, never by content, so copies spread and every task sees the same mix of lengths.
A task packs ``group_pieces`` pieces or ``group_bytes`` of ids at a time, whichever comes first.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .chunks import encoder

CAPACITY = 2048
WIDTH = 4096
GROUP_PIECES = 50_000
GROUP_BYTES = 64 << 20

_NONE = np.iinfo(np.int64).max


def piece_cost(length, width: int = WIDTH):
    """Linear plus quadratic cost of a piece, in units that cancel out between sequences."""
    return 6 * width * length + length * length


def room_for(total: int, capacity: int) -> list[int]:
    """Lengths of the sequences that ``total`` tokens fill: whole ones, then the powers of two of the remainder."""
    full, rest = divmod(total, capacity)
    return [capacity] * full + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def balance(lengths: list[int], capacity: int = CAPACITY, width: int = WIDTH) -> list[tuple[int, int, int, int, int]]:
    """(piece, start within it, length, sequence, offset) of every part; pieces are at most ``capacity`` long."""
    rooms = room_for(sum(lengths), capacity)
    cost, used = [0] * len(rooms), [0] * len(rooms)
    heaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # open sequences by room left, cheapest first
    cheapest = np.full(capacity + 1, _NONE)
    for sequence, room in enumerate(rooms):
        heaps[room].append((0, sequence))
        cheapest[room] = 0
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for piece, length in enumerate(lengths):
        waiting[length].append((piece, 0))
    placed = []
    for length in range(capacity, 0, -1):
        for piece, start in waiting[length]:
            room = length + int(np.argmin(cheapest[length:]))
            size = length
            if cheapest[room] == _NONE:
                size = room = int(np.flatnonzero(cheapest[:length] != _NONE)[-1])
                waiting[length - size].append((piece, start + size))
            heap = heaps[room]
            _, sequence = heappop(heap)
            cheapest[room] = heap[0][0] if heap else _NONE
            placed.append((piece, start, size, sequence, used[sequence]))
            used[sequence] += size
            cost[sequence] += piece_cost(size, width)
            left = room - size
            if left:
                heappush(heaps[left], (cost[sequence], sequence))
                cheapest[left] = heaps[left][0][0]
    return placed


def pack_balanced(
    docs: DataFrame, path: str, end_id: int | None, capacity: int = CAPACITY, width: int = WIDTH,
    group_pieces: int = GROUP_PIECES, group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids: every id of every row, in exactly one piece.

    A document is its ids and ``end_id``; a null text is empty. Without ``end_id`` an empty document has no piece. Rows
    with equal or null identifiers are documents of their own. Sequences are filled from 0 without gaps, hold ``capacity``
    ids or a power of two, and are numbered arbitrarily. ``ids`` (little-endian unsigned 32 bits) is null unless
    ``with_ids``. No rows: no rows. Other columns, whatever their names, are not read.
    """
    end = array("I", [end_id]).tobytes() if end_id is not None else b""
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def place(held: list[tuple[str, bytes]], first: int) -> tuple[pd.DataFrame, int]:
        pieces = [(doc, at, min(capacity, len(ids) // 4 - at)) for doc, (_, ids) in enumerate(held) for at in range(0, len(ids) // 4, capacity)]
        out, last = [], first - 1
        for piece, skip, size, sequence, offset in balance([p[2] for p in pieces], capacity, width):
            doc, at, _ = pieces[piece]
            name, ids = held[doc]
            body = ids[4 * (at + skip) : 4 * (at + skip + size)]
            out.append((name, at + skip, size, zlib.crc32(body), len(ids) // 4, first + sequence, offset, body if with_ids else None))
            last = max(last, first + sequence)
        return pd.DataFrame(out, columns=names), last + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, next_sequence = encoder(path), TaskContext.get().partitionId() << 40
        held, pieces, size = [], 0, 0
        for frame in frames:
            texts = [text if isinstance(text, str) else "" for text in frame["text"]]
            for name, ids in zip(frame["id"], own.many(texts)):
                ids += end
                held.append((name, ids))
                pieces, size = pieces + len(ids) // 4 // capacity + 1, size + len(ids)
                if pieces >= group_pieces or size >= group_bytes:
                    out, next_sequence = place(held, next_sequence)
                    yield out
                    held, pieces, size = [], 0, 0
        if held:
            yield place(held, next_sequence)[0]

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    out = rows.repartition("row").select("id", "text").mapInPandas(
        run, "id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def sequence_costs(packed: DataFrame, width: int = WIDTH) -> DataFrame:
    """sequence_id, length, cost: what each sequence of ``pack_balanced`` holds and costs."""
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sum(piece_cost(F.col("length"), width)).alias("cost"))
