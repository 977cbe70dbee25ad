"""WARC archives of pages, and a two-level capture index over them.

Writing: each payload is stored once, in the response record of the smallest page identifier that has it; other pages
get a revisit record that refers to it. Records are gzip members of their own, so one can be read alone.

Index: one line per record under the key "reversed host) path page", range-partitioned and sorted; a file holds
compressed blocks of lines and, at its end, a sparse directory with the first key of each block. A lookup finds the
file among the files' first keys, the block in the file's directory and the line in the block, each by binary search,
and then reads the record's byte range from its archive.

Files are written under a name of the task attempt's own and exist only through the stored manifest rows that name
them, so tasks that run again after an executor is lost do no harm.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path, stored
from .common import shuffle_width

ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000
SALTS = 4096
DATE = "2024-01-01T00:00:00Z"
_TAIL, _TAIL_BYTES = "<QQ", 16
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_ENTRY = "key string, file string, offset long, length long"


def system_of(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def clean_url(url: str | None) -> str:
    """A URL without white space and control characters, which would break a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url) if isinstance(url, str) else ""


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels in reverse, then path and query. No URL: the empty key."""
    url = clean_url(url)
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # not a URL: it sorts as it is
        return url
    if not host:
        return url
    default = {"http": 80, "https": 443}.get(parts.scheme)
    shown = f":{port}" if port and port != default else ""
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + query


def capture_key(url: str | None, page: str | None) -> str:
    return f"{surt(url)} {page if isinstance(page, str) else ''}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, name: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record; a revisit has the HTTP head, and so the payload's length, without the payload."""
    http = _HTTP.format(len(payload)).encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {clean_url(url)}"] if clean_url(url) else []
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of a record."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    lines = top.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def page_name(page: str | None, digest: str, copy: int) -> str:
    """Record identifier that carries the page identifier (none: empty)."""
    return f"urn:page:{'' if page is None else quote(page, safe='')}:{digest}" + (f":{copy}" if copy else "")


def page_of(name: str) -> str | None:
    return unquote(name.strip("<>").split(":")[2]) or None


def _roles(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page, url, payload, same (hash of the payload), salt, first (the page whose record has the payload), shared."""
    rows = pages.withColumns({"same": F.sha2("payload", 256), "salt": F.pmod(F.xxhash64("page"), F.lit(SALTS))})
    parts = rows.select("page", "same", "salt").groupBy("same", "salt").agg(F.min("page").alias("least"))
    total = parts.groupBy("same").agg(F.min("least").alias("first"))
    named = parts.select("same", "salt").join(total, "same")
    dealt = rows.repartition(shuffle_width(pages.sparkSession), "same", "salt")  # the payloads' one shuffle; the join keeps it
    return dealt.join(named, ["same", "salt"]).select(
        "page", "url", "payload", "same", "salt", "first", (F.octet_length("payload") >= min_bytes).alias("shared")
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page, url, payload) and returns the stored entries (key, file, offset, length).

    Rows that repeat page and payload: the first is the record, the others revisit it. A null page counts as the
    largest. Payloads under ``min_bytes`` are always responses.
    """
    system, inner = system_of(folder)
    system.create_dir(inner, recursive=True)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inner = system_of(folder)
        out, path, at, before, copy = None, "", 0, None, 0
        for frame in frames:
            entries = []
            for page, url, payload, first, shared in zip(*(frame[c] for c in ("page", "url", "payload", "first", "shared"))):
                page, first = (x if isinstance(x, str) else None for x in (page, first))
                payload = bytes(payload)
                digest = payload_digest(payload)
                copy = copy + 1 if (page, digest) == before else 0
                before = (page, digest)
                kind = "response" if not shared or (page == first and not copy) else "revisit"
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    path, at = f"{inner}/pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(path, compression=None)
                member = gzip.compress(record(kind, page_name(page, digest, copy), url, payload, page_name(first, digest, 0)), 6, mtime=0)
                out.write(member)
                entries.append((capture_key(url, page), path, at, len(member)))
                at += len(member)
            yield pd.DataFrame(entries, columns=["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    order = ["same", "salt", F.asc_nulls_last("page"), "url"]
    ranked = _roles(pages, min_bytes).sortWithinPartitions(*order)
    rows = ranked.select(F.col("page").cast("string").alias("page"), "url", "payload", F.col("first").cast("string").alias("first"), "shared")
    return stored(rows.mapInPandas(write, _ENTRY), "warc-entries")


def write_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the sorted index files; returns the stored manifest (first, path), one row per file."""
    system, inner = system_of(folder)
    system.create_dir(inner, recursive=True)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inner = system_of(folder)
        out, path, at, directory, held = None, "", 0, [], []

        def flush() -> None:
            nonlocal at
            packed = zlib.compress("\n".join(json.dumps(e) for e in held).encode(), 6)
            directory.append((held[0][0], at, len(packed)))
            out.write(packed)
            at += len(packed)
            held.clear()

        for frame in frames:
            for entry in frame.itertuples(index=False):
                if out is None:
                    path = f"{inner}/index-{uuid.uuid4().hex}.cdxb"
                    out = system.open_output_stream(path, compression=None)
                held.append(tuple(entry))
                if len(held) >= block_lines:
                    flush()
        if out is not None:
            if held:
                flush()
            top = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(top + struct.pack(_TAIL, at, len(top)))
            out.close()
            yield pd.DataFrame([(directory[0][0], path)], columns=["first", "path"])

    width = shuffle_width(entries.sparkSession)
    ordered = entries.repartitionByRange(width, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return stored(ordered.mapInPandas(write, "first string, path string"), "warc-index")


class IndexFile:
    """One index file: its directory is read once, a block when a key may lie in it."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        at, length = struct.unpack(_TAIL, self.file.read_at(_TAIL_BYTES, size - _TAIL_BYTES))
        self.directory = [tuple(x) for x in json.loads(zlib.decompress(self.file.read_at(length, at)))]
        self.firsts = [x[0] for x in self.directory]
        self.loaded, self.lines = -1, []

    def block(self, i: int) -> list:
        if i != self.loaded:
            _, at, length = self.directory[i]
            self.lines = [json.loads(x) for x in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")]
            self.loaded = i
        return self.lines

    def find(self, key: str) -> Iterator[list]:
        """All entries of a key, also where they go on in the next block."""
        i = max(0, bisect_left(self.firsts, key) - 1)
        while i < len(self.directory) and self.firsts[i] <= key:
            lines = self.block(i)
            at = bisect_left(lines, key, key=lambda e: e[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1
            i += 1


def lookup(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """The entries (key, file, offset, length) of the distinct ``keys`` (key), through the two-level index.

    The list of files has one row per index partition and goes to every task. A key whose entries lie in several
    files is asked of each of them.
    """
    files = sorted((r["first"], r["path"]) for r in index.collect())
    firsts, paths = [f for f, _ in files], [p for _, p in files]

    @F.pandas_udf("array<int>")
    def where(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: list(range(max(0, bisect_left(firsts, k) - 1), bisect_right(firsts, k))))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at, file = system_of(folder)[0], -1, None
        for frame in frames:
            out = []
            for number, key in zip(frame["at"], frame["key"]):
                if number != at:
                    at, file = number, IndexFile(system, paths[number])
                out += [tuple(e) for e in file.find(key)]
            yield pd.DataFrame(out, columns=["key", "file", "offset", "length"])

    asked = keys.select("key").distinct().withColumn("at", F.explode(where("key")))
    dealt = asked.repartition(shuffle_width(keys.sparkSession), "at", F.pmod(F.xxhash64("key"), F.lit(4)))
    return dealt.sortWithinPartitions("at", "key").select("at", "key").mapInPandas(search, _ENTRY)


def read_records(entries: DataFrame, folder: str) -> DataFrame:
    """page, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits): by byte ranges.

    Ranges of one archive are read in the order of their places. A payload that does not match its digest is an error.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path, file = system_of(folder)[0], None, None
        for frame in frames:
            out = []
            for name, offset, length in zip(frame["file"], frame["offset"], frame["length"]):
                if name != path:
                    path, file = name, system.open_input_file(name)
                headers, http, payload = parse(gzip.decompress(file.read_at(length, offset)))
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and payload_digest(payload) != digest:
                    raise ValueError(f"{name} at {offset}: the payload is not what its digest says")
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                refers = page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None
                out.append((page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, size, digest, refers, payload if kind == "response" else None))
            yield pd.DataFrame(out, columns=_COLUMNS)

    ordered = entries.repartition(shuffle_width(entries.sparkSession), "file", F.floor(F.col("offset") / (16 << 20)))
    rows = ordered.sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return rows.mapInPandas(read, "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary")


_COLUMNS = ["page", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]


def key_column(url: Column, page: Column) -> Column:
    @F.pandas_udf("string")
    def keys(urls: pd.Series, pages: pd.Series) -> pd.Series:
        return pd.Series([capture_key(u, p) for u, p in zip(urls, pages)], dtype=object)

    return keys(url.cast("string"), page.cast("string"))


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Archives every row, indexes the archives, and looks every page up again: what the records say, one row per row.

    A null html is an empty payload, a null URL the empty key; other columns are not read. No rows: no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    index = write_index(write_archives(rows, f"{folder}/archives", min_bytes), f"{folder}/index")
    keys = rows.select(key_column(F.col("url"), F.col("page")).alias("key"))
    kind = pages.schema[id_col].dataType.simpleString()
    out = read_records(lookup(keys, index, folder), folder)
    return out.select(
        F.col("page").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url"
    )
