"""Exact token counts at every prefix of a text, by dynamic programming over a tokenizer's merges.

The encoding of a prefix is the encoding of a shorter prefix plus one last token: for each end position exactly one
token that ends there stands next to the last token of the text before it as the merges would leave them. So one
pass over a piece finds the last token at every position, and count(end) = count(end - last token) + 1. A token that
closes a word carries the end-of-word mark, so the pass keeps the open form (more letters may follow) and asks for
the closed form at every character.

The table of a text is the change of the count from each character prefix to the next. It answers how long a text
may be under a budget, and what any cut of it costs, without encoding again. Prefixes are those of the normalised
text (composed, white-space runs as one space, lower case), which is what the tokenizer sees.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .chunks import RARE_SPACE, UNUSUAL, Bounded, _style, letters_of

LIMIT = 2048
_SPACE_STEP = array("h", [0]).tobytes()
#: Contractions are pieces of their own only when complete.
_CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))


class PrefixCounter:
    """Count tables for a byte-level pair tokenizer with an end-of-word mark that drops white space."""

    def __init__(self, path: str, limit: int = 96 << 20, nodes: int = 600_000):
        """``limit``: bytes of each cache; ``nodes``: word beginnings that are kept."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        style, pattern = _style(spec)
        self.mark = spec["model"].get("end_of_word_suffix")
        if style != "words" or not self.mark:
            raise ValueError("prefix counts need a tokenizer that drops white space and marks the ends of words")
        self.tok = Tokenizer.from_file(path)
        self.pattern = regex.compile(pattern)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.made_of = {a + b: (a, b, i) for i, (a, b) in reversed(list(enumerate(merges)))}
        self.vocabulary = spec["model"]["vocab"]
        self.open_tails, self.closed_tails = self._tails(False), self._tails(True)
        self.is_whole = Bounded(lambda t: self.merged(self.symbols(t)) == [t], limit)
        self.left_edge = Bounded(lambda t: self._edge(t, 0), limit)
        self.right_edge = Bounded(lambda t: self._edge(t, 1), limit)
        self.stands = Bounded(self._stands, limit)
        self.pieces = Bounded(self._piece, limit)
        self.chunks = Bounded(self._chunk, limit)
        self.most_nodes = nodes
        self._forget()

    def _tails(self, closed: bool) -> dict[str, str]:
        """Every end of a token's letters; the value is the token itself where the end is the whole of it, or empty."""
        tails: dict[str, str] = {}
        for token in self.vocabulary:
            if token == self.mark or token.endswith(self.mark) != closed:
                continue
            body = token[: -len(self.mark)] if closed else token
            for start in range(1, len(body)):
                tails.setdefault(body[start:], "")
            tails[body] = token
        return tails

    def _forget(self) -> None:
        """An empty tree of word beginnings, which words share: node 0 is the beginning without letters."""
        self.child: dict[int, int] = {}  # by node * 512 + letter; letters stand for bytes and lie below 512
        self.last: list[str | None] = [""]  # last token of the open form, once asked for
        self.opened: list[int] = [0]  # count of the open form
        self.closed: list[int] = [0]  # count of the closed form; -1 until asked for

    def symbols(self, token: str) -> list[str]:
        """Letters of a token; the end mark belongs to the last letter."""
        if token.endswith(self.mark) and token != self.mark:
            body = token[: -len(self.mark)]
            return [*body[:-1], body[-1] + self.mark]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """What the merges leave of ``parts``: always the pair of lowest rank, the leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            found = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if found[0] == 1 << 60:
                break
            i = found[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at one edge of a token while it grows from letters, each with the rank of the merge that ends it."""
        edge, ends = [], 1 << 60
        while True:
            edge.append((token, ends))
            if token not in self.made_of:
                return edge[::-1]
            ends = self.made_of[token][2]
            token = self.made_of[token][side]

    def _stands(self, pair: tuple[str, str]) -> bool:
        """Whether two tokens side by side stay as they are.

        Both grow by their own merges; what stands at the seam at one time must not merge first. Of merges of equal
        rank the left one happens first: the seam's merge loses to an equal one on its left and wins on its right.
        """
        left, right = self.right_edge[pair[0]], self.left_edge[pair[1]]
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = left[i], right[j]
            seam = self.rank.get((a, b))
            if seam is not None and seam < a_ends and seam <= b_ends:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def _last(self, letters: str, end: int, closed: bool, path: list[int]) -> tuple[str, int]:
        """The last token of letters[:end] and the count of tokens. ``path``: the nodes of the shorter beginnings."""
        tails, found = self.closed_tails if closed else self.open_tails, []
        for start in range(end - 1, -1, -1):
            token = tails.get(letters[start:end])
            if token is None:
                break
            if token:
                found.append((start, token))
        while found:
            start, token = found.pop()
            if self.is_whole[token] and (not start or self.stands[self.last[path[start]], token]):
                return token, self.opened[path[start]] + 1
        raise ValueError("the vocabulary lacks a byte")

    def _piece(self, piece: str) -> bytes:
        """Change of the count at every character of one piece of the tokenizer's cut, as 16-bit integers."""
        if len(self.child) >= self.most_nodes:
            self._forget()
        child, last, opened, closed = self.child, self.last, self.opened, self.closed
        letters, ends, at = letters_of(piece), None, 0
        if len(letters) > len(piece):
            ends = set()
            for c in piece:
                at += len(c.encode("utf-8"))
                ends.add(at)
        node, path, before, out = 0, [0], 0, array("h")
        for end, letter in enumerate(letters, 1):
            key = node << 9 | ord(letter)
            node = child.get(key, 0)
            if not node:
                node = child[key] = len(last)
                last.append(None)
                opened.append(0)
                closed.append(-1)
            if ends is None or end in ends:
                count = closed[node]
                if count < 0:
                    count = closed[node] = self._last(letters, end, True, path)[1]
                out.append(count - before)  # raises beyond 16 bits
                before = count
            if end < len(letters) and last[node] is None:
                last[node], opened[node] = self._last(letters, end, False, path)
            path.append(node)
        return out.tobytes()

    def _contraction(self, piece: str) -> bytes:
        """A part of a contraction is cut otherwise than the whole: the apostrophe, then letters."""
        counts = [0, *(1 + sum(array("h", self.pieces[piece[1:i]])) if i > 1 else 1 for i in range(1, len(piece)))]
        counts.append(sum(array("h", self.pieces[piece])))
        return array("h", map(sub, counts[1:], counts)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Changes of the count along a run without white space, as 16-bit integers."""
        out = b"".join([self._contraction(p) if p in _CONTRACTIONS else self.pieces[p] for p in self.pattern.findall(chunk)])
        if len(out) != 2 * len(chunk):
            raise ValueError("a character belongs to no piece")
        return out

    def _segment(self, text: str) -> bytes:
        """Steps of a text without special tokens."""
        if not text:
            return b""
        if UNUSUAL.search(text) or RARE_SPACE.search(text):
            text = self.tok.normalizer.normalize_str(text)
            return _SPACE_STEP.join(map(self.chunks.__getitem__, text.split(" ")))
        inner = _SPACE_STEP.join(map(self.chunks.__getitem__, text.lower().split()))
        before = _SPACE_STEP if text[0].isspace() else b""
        after = _SPACE_STEP if inner and text[-1].isspace() else b""
        return before + inner + after

    def _special(self, token: str) -> bytes:
        """A special token is one token when complete and plain text before."""
        part = np.frombuffer(self._segment(token[:-1]), np.int16)
        return part.tobytes() + np.array([1 - int(part.sum())], np.int16).tobytes()

    def steps(self, text: str | None) -> bytes:
        """16-bit change of the token count at each character of the normalised text; their sum is the count."""
        if not text:
            return b""
        if self.cut and any(s in text for s in self.specials):
            parts = self.cut.split(text)
            return b"".join(self._special(p) if p in self.specials else self._segment(p) for p in parts)
        return self._segment(text)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def unpack(table: bytes) -> np.ndarray:
    """Counts at every prefix of 1, 2, ... characters, from a stored table."""
    return np.cumsum(np.frombuffer(zlib.decompress(table), np.int16).astype(np.int64))


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (UTF-8), n_chars (normalised), n_tokens, prefix_steps (the packed table). One row per row.

    Null and empty texts have no bytes and no tokens; texts of any length are counted whole; ids may be null or
    repeated; other columns are not read.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(path)
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            steps = [own.steps(t) for t in texts]
            yield pd.DataFrame({
                "id": frame["id"],
                "n_bytes": [len(t.encode("utf-8")) for t in texts],
                "n_chars": [len(s) // 2 for s in steps],
                "n_tokens": [int(np.frombuffer(s, np.int16).sum(dtype=np.int64)) for s in steps],
                "prefix_steps": [zlib.compress(s, 1) for s in steps],
            })

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInPandas(count, "id string, n_bytes long, n_chars long, n_tokens long, prefix_steps binary")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_bytes", "n_chars", "n_tokens", "prefix_steps")


def cut_for_budget(tables: DataFrame, budget: int) -> DataFrame:
    """Adds ``cut_chars``: the longest prefix of the normalised text that costs at most ``budget`` tokens.

    Only the tables of texts over the budget are unpacked; any other text fits whole.
    """
    if budget < 0:
        raise ValueError("a budget is not negative")

    @F.pandas_udf("long")
    def longest(tables: pd.Series) -> pd.Series:
        def one(table: bytes) -> int:
            if table is None:
                return 0
            fits = np.nonzero(unpack(table) <= budget)[0]
            return int(fits[-1]) + 1 if len(fits) else 0

        return tables.map(one).astype("int64")

    over = F.col("n_tokens") > budget
    cut = longest(F.when(over, F.col("prefix_steps")))
    return tables.withColumn("cut_chars", F.when(over, cut).otherwise(F.col("n_chars")))


def cost_of_prefix(tables: DataFrame, chars_col: str) -> DataFrame:
    """Adds ``prefix_tokens``: the count at the number of characters in ``chars_col`` (null: null; beyond the end: all)."""

    @F.pandas_udf("long")
    def cost(tables: pd.Series, chars: pd.Series) -> pd.Series:
        def one(table: bytes, n: float) -> int | None:
            if pd.isna(n):
                return None
            counts = unpack(table)
            n = min(int(n), len(counts))
            return int(counts[n - 1]) if n > 0 else 0

        return pd.Series([one(t, n) for t, n in zip(tables, chars)], dtype="Int64")

    return tables.withColumn("prefix_tokens", cost("prefix_steps", F.col(chars_col).cast("long")))
