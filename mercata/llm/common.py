"""Helpers shared by the training-data operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of other characters than space, \t, \n, \v, \f and \r, in Java's and Python's syntax.
WORD = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z on bytes; letters outside ASCII keep their case.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spare_name(df: DataFrame, wish: str) -> str:
    """``wish``, made longer until no column of ``df`` has that name (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions that the session's owner chose for the cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def null_safe(left: str, right: str, keys: list[str]) -> Column:
    """Join condition on ``keys`` of two aliased frames; null equals null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a text as UTF-8. bytes.split() parts at exactly the six characters outside WORD."""
    raw = (text or "").encode("utf-8")
    return (raw.translate(LOWER) if lower else raw).split()


class WordHash(dict):
    """64-bit hashes of words, remembered up to ``limit`` words and then forgotten."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_digest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=">u8").astype(np.uint64)


#: Odd 64-bit multipliers for mixing, made by rule: odd multiples of the golden ratio's fraction.
def multiplier(i: int) -> np.uint64:
    return np.uint64(((2 * i + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; order counts. Fewer than ``n`` words: none."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    width = len(words) - n + 1
    out = np.zeros(width, np.uint64)
    for i in range(n):
        out = mix(out * multiplier(i + 1) + words[i : i + width])
    return out


def batches(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of at most ``size`` rows."""
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="code-")  # on the driver, whose file server hands the archive to executors
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}-code", "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)
