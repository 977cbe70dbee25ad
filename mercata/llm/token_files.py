"""Token ids in binary shards: one shared zstandard dictionary, one frame per document, an offset index.

A shard file is
    8 bytes   magic
    32 bytes  SHA-256 of the dictionary with which its frames were made
    frames    one zstandard frame per document: its ids as little-endian unsigned 32-bit integers
    index     one zstandard frame (no dictionary) of an array (documents, 3) of signed 64-bit integers: place of the
              document's frame in the file, its length in bytes, number of ids
    16 bytes  place of the index, number of documents
The identifiers stand beside the index as text lines of JSON values, so that any type, and null, comes back. A short
document is read with three ranges: the tail, the index and its own frame.

Shards hold documents in ascending order of identifier. A task writes each file under a name of its own attempt and
returns one manifest row; only files named in the stored manifest belong to the data set, so a task that runs again
after an executor is lost leaves an unused file behind and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path, stored
from .chunks import encoder
from .common import shuffle_width

MAGIC = b"TOKSHRD1"
TAIL = struct.Struct("<QQ")
SHARD_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on about so many documents, drawn by hash over the whole table, and at most so many
#: characters of each, from a place drawn by hash. It changes file sizes only and never shows in results.
TRAINING_DOCUMENTS, TRAINING_CHARS = 2048, 4096

_MANIFEST = "part long, shard long, path string, n_docs long, n_ids long, n_bytes long, dictionary string"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it; executors reach what Spark's URI names."""
    return fs.FileSystem.from_uri(uri)


def train_dictionary(docs: DataFrame, path: str, id_col: str, text_col: str) -> bytes:
    """A dictionary from the id arrays of a bounded sample; empty when there is too little to train on.

    Only drawn rows leave their tasks, so what the driver gets is the same at every size.
    """
    text, mark = F.col(text_col).cast("string"), F.xxhash64(id_col, text_col)
    share = min(1.0, TRAINING_DOCUMENTS / max(1, docs.count()))
    spot = 1 + F.pmod(F.xxhash64(mark), F.greatest(F.char_length(text) - TRAINING_CHARS + 1, F.lit(1)))
    sample = (
        docs.where((F.length(text) > 0) & (F.pmod(mark, F.lit(1 << 40)) < int(share * (1 << 40))))
        .select(F.substring(text, spot.cast("int"), F.lit(TRAINING_CHARS)).alias("text")).limit(TRAINING_DOCUMENTS).collect()
    )
    own = encoder(path)
    arrays = [a for a in (own.ids(r["text"]) for r in sample) if len(a) >= 8]
    if len(arrays) < 16 or sum(map(len, arrays)) < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, arrays)) // 8), arrays).as_bytes()
    except zstandard.ZstdError:  # samples too much alike to train on
        return b""


class ShardWriter:
    def __init__(self, folder: str, dictionary: bytes):
        self.folder, self.hash = folder, hashlib.sha256(dictionary).digest()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True).compress
        self.plain = zstandard.ZstdCompressor(level=3).compress
        self.file = None

    def open(self) -> None:
        system, folder = place(self.folder)
        self.path = f"{folder}/tokens-{uuid.uuid4().hex}.bin"
        self.file = system.open_output_stream(self.path)
        self.file.write(MAGIC + self.hash)
        self.at, self.index, self.names, self.n_ids = len(MAGIC) + 32, [], [], 0

    def add(self, name: str | None, ids: bytes) -> None:
        if self.file is None:
            self.open()
        frame = self.compress(ids)
        self.file.write(frame)
        self.index.append((self.at, len(frame), len(ids) // 4))
        self.names.append(json.dumps(name))
        self.at, self.n_ids = self.at + len(frame), self.n_ids + len(ids) // 4

    def close(self) -> tuple[str, int, int, int, str]:
        """path, documents, ids, bytes, dictionary hash"""
        index = self.plain(np.asarray(self.index, "<i8").tobytes())
        names = self.plain("\n".join(self.names).encode())
        self.file.write(struct.pack("<Q", len(index)) + index + names + TAIL.pack(self.at, len(self.index)))
        size = self.at + 8 + len(index) + len(names) + TAIL.size
        self.file.close()
        self.file = None
        return self.path, len(self.index), self.n_ids, size, self.hash.hex()


class ShardReader:
    def __init__(self, folder: str, path: str, dictionary: bytes):
        self.file = place(folder)[0].open_input_file(path)
        head, size = self.file.read_at(len(MAGIC) + 32, 0), self.file.size()
        if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no shard of this dictionary")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.unpack = zstandard.ZstdDecompressor(dict_data=shared).decompress
        at, self.n_docs = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        block = self.file.read_at(size - TAIL.size - at, at)
        (n,) = struct.unpack_from("<Q", block)
        plain = zstandard.ZstdDecompressor()
        self.index = np.frombuffer(plain.decompress(block[8 : 8 + n]), "<i8").reshape(-1, 3)
        self.names = [json.loads(x) for x in plain.decompress(block[8 + n :]).decode().split("\n")] if self.n_docs else []

    def ids(self, i: int) -> bytes:
        """Little-endian ids of the i-th document, by one range read."""
        at, size, n = (int(x) for x in self.index[i])
        ids = self.unpack(self.file.read_at(size, at))
        if len(ids) != 4 * n:
            raise ValueError("a frame does not hold the ids that the index promises")
        return ids

    def __iter__(self) -> Iterator[tuple[str | None, bytes]]:
        for i in range(self.n_docs):
            yield self.names[i], self.ids(i)

    def close(self) -> None:
        self.file.close()


def write_tokens(
    docs: DataFrame, path: str, end_id: int | None, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, bytes, str]:
    """Writes the shards; returns the stored manifest, the dictionary and the folder.

    Null texts are empty documents, which hold only ``end_id`` (nothing if that is None). Null identifiers come first;
    rows with equal identifiers follow in the order of their texts. Texts are encoded whole. No rows: no files.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    dictionary = train_dictionary(docs, path, id_col, text_col)
    end = array("I", [end_id]).tobytes() if end_id is not None else b""
    system, inner = place(folder)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, done, own, writer = TaskContext.get().partitionId(), 0, encoder(path), ShardWriter(folder, dictionary)

        def closed() -> pd.DataFrame:
            file, n_docs, n_ids, n_bytes, used = writer.close()
            return pd.DataFrame([(part, done, file, n_docs, n_ids, n_bytes, used)], columns=[c.split()[0] for c in _MANIFEST.split(", ")])

        for frame in frames:
            for name, ids in zip(frame["id"], own.many(frame["text"].tolist())):
                writer.add(name, ids + end)
                if writer.at >= shard_bytes:
                    yield closed()
                    done += 1
        if writer.file is not None:
            yield closed()

    rows = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranged = rows.withColumn("mark", F.xxhash64("text")).repartitionByRange(shuffle_width(spark), F.asc_nulls_first("key"), "mark")
    ordered = ranged.sortWithinPartitions(F.asc_nulls_first("key"), "mark", "text")
    manifest = ordered.select(F.col("key").cast("string").alias("id"), "text").mapInPandas(write, _MANIFEST)
    return stored(manifest, "token-manifest"), dictionary, folder


def read_tokens(
    manifest: DataFrame, dictionary: bytes, folder: str, kind: str = "long", id_col: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """id, shard path, place in the shard, start (ids of all documents before it), n_tokens, ids (little-endian bytes;
    null unless ``with_ids``), ids_crc32.

    ``manifest`` has a row per shard file; the sum before each is taken over those rows alone.
    """
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    width = shuffle_width(manifest.sparkSession)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, start in zip(frame["path"], frame["before"]):
                shard = ShardReader(folder, path, dictionary)
                out, held = [], 0
                for i, (name, ids) in enumerate(shard):
                    out.append((name, path, i, start, len(ids) // 4, ids if with_ids else None, zlib.crc32(ids)))
                    start, held = start + len(ids) // 4, held + len(ids)
                    if held > 8 << 20 or len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=_READ)
                        out, held = [], 0
                if out:
                    yield pd.DataFrame(out, columns=_READ)
                shard.close()

    files = placed.select("path", "before").repartition(width, "path")
    out = files.mapInPandas(read, "id string, shard string, place long, start long, n_tokens long, ids binary, ids_crc32 long")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


_READ = ["id", "shard", "place", "start", "n_tokens", "ids", "ids_crc32"]


def read_document(spark: SparkSession, folder: str, path: str, i: int, dictionary: bytes) -> list[int]:
    """The ids of one document, with three range reads."""
    shard = ShardReader(folder, path, dictionary)
    try:
        return np.frombuffer(shard.ids(i), "<u4").tolist()
    finally:
        shard.close()
