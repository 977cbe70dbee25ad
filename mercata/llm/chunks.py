"""Encoding whole texts with a public tokenizer, chunk by chunk.

Both tokenizer kinds here cut a text at white space before any merge, so the ids of a text are the ids of its
chunks in order. Chunks repeat, so their ids are remembered in a bounded cache; the merges themselves are always
the library's. A chunk with characters beyond plain Latin text goes to the library as it is, and so does a whole text
with rare white space or with the string of a special token, where the cutting rules of this module may not hold.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: The byte-to-character table of byte-level vocabularies keeps these ranges and moves the rest up.
_KEPT_BYTES = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))

#: White space, or what some library may take for it, outside space and \\t to \\r.
RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")

#: Characters beyond plain Latin text, for which case and composition are left to the library.
UNUSUAL = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0İɐ-\U0010ffff]")


def byte_letters() -> list[str]:
    """The printable stand-in for each byte value."""
    kept = {b for r in _KEPT_BYTES for b in r}
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


BYTE_LETTERS = byte_letters()


def letters_of(piece: str) -> str:
    if piece.isascii() and piece.isalnum():  # these stand for themselves
        return piece
    return "".join([BYTE_LETTERS[b] for b in piece.encode("utf-8")])


#: Text whose words are looked up together.
MANY_BYTES = 16 << 20

#: What an entry of a cache takes beside its text and ids, and the longest text that is kept.
ENTRY_BYTES, LONGEST_KEPT = 220, 256


class Bounded(dict):
    """A cache of at most ``limit`` bytes that calls ``make`` for what it lacks.

    When half of the limit is full, the entries become the older half, and what was in it and has not been asked for
    since goes. Long keys are made each time.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.half, self.size, self.older = make, limit // 2, 0, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_KEPT:
                return value
        if self.size >= self.half:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self.size += ENTRY_BYTES + len(key) + (len(value) if hasattr(value, "__len__") else 0)
        self[key] = value
        return value


class ChunkEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to ``Tokenizer.encode(..., add_special_tokens=False)``.

    ``style`` is found from the file: "words" drops white space, "spaced" keeps one space before a word, and any
    other file is "whole": every text goes to the library as it is.
    """

    def __init__(self, path: str, limit: int = 96 << 20):
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.style, pattern = _style(spec)
        self.pattern = regex.compile(pattern) if pattern else None
        self.model = self.tok.model
        self.pieces = Bounded(self._piece, limit)
        self.chunks = Bounded(self._chunk, limit)
        self.after_space = Bounded(lambda word: self._chunk(" " + word), limit)  # spares a string per word
        self.line_end = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(letters_of(piece))]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and UNUSUAL.search(chunk):
            return self.whole(chunk)
        if self.style == "words":
            chunk = chunk.lower()
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha():
            return self._piece(chunk) if self.style == "words" else self.pieces[chunk]
        if word[-1:] in _STOPS and word[:-1].isalpha():
            return self.pieces[chunk[:-1]] + self.pieces[word[-1]]
        if UNUSUAL.search(chunk):
            return self.whole(chunk)
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk)))

    def plain(self, text: str) -> bool:
        """Whether the cutting rules here hold for this text."""
        if self.style == "whole" or any(s in text for s in self.specials):
            return False
        shown = text.replace("\n", " ")
        return (shown.isascii() and shown.isprintable()) or not RARE_SPACE.search(text)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.plain(text):
            return self.whole(text)
        if self.style == "words":
            if text.isascii() or not UNUSUAL.search(text):
                text = _loose(_loose(text.lower(), "."), ",")
            return b"".join(map(self.chunks.__getitem__, text.split()))
        if any(run in text for run in WIDE_SPACE):
            return b"".join(map(self.chunks.__getitem__, SPACED.findall(text)))
        return self.line_end.join(map(self._line, text.split("\n")))

    def many(self, texts: list[str | None]) -> Iterator[bytes]:
        """``ids`` of each text in turn. Words of several texts are looked up once, about ``MANY_BYTES`` of text at a time."""
        if self.style != "words":
            yield from map(self.ids, texts)
            return
        held: list[str | bytes] = []  # texts ready for cutting, and ids of those that the library encoded
        size = 0
        for text in texts:
            if not text or not self.plain(text):
                held.append(self.ids(text))
                continue
            held.append(_loose(_loose(text.lower(), "."), ",") if text.isascii() or not UNUSUAL.search(text) else text)
            size += len(text)
            if size >= MANY_BYTES:
                yield from self._cut(held)
                held, size = [], 0
        yield from self._cut(held)

    def _cut(self, held: list[str | bytes]) -> Iterator[bytes]:
        lists = pc.ascii_split_whitespace(pa.array([x for x in held if isinstance(x, str)], pa.large_string()))
        words = lists.flatten().dictionary_encode()
        known = [self.chunks[w] if w else b"" for w in words.dictionary.to_pylist()]
        flat, sizes = np.frombuffer(b"".join(known), np.uint32), np.fromiter(map(len, known), np.int64, len(known)) // 4
        codes = words.indices.to_numpy()
        n = sizes[codes]
        ends = np.cumsum(n)
        from_ = (np.cumsum(sizes) - sizes)[codes] - (ends - n)  # first id of each word, less its place in the result
        ids = flat[np.repeat(from_, n) + np.arange(len(n) and ends[-1])].tobytes()
        cuts = np.r_[0, ends][lists.offsets.to_numpy() - lists.offsets[0].as_py()] * 4
        text = 0
        for x in held:
            if isinstance(x, bytes):
                yield x
            else:
                yield ids[cuts[text] : cuts[text + 1]]
                text += 1

    def _line(self, line: str) -> bytes:
        """A line of words with single spaces: its first word has none before it."""
        first, *words = line.split(" ")
        return (self.chunks[first] if first else b"") + b"".join(map(self.after_space.__getitem__, words))


#: Punctuation that ends a word and is a piece of its own when alone after letters.
_STOPS = (".", ",", ";", ":", "!", "?")


def _loose(text: str, stop: str) -> str:
    """Puts a space before each ``stop`` between a letter or digit and a space, where a "words" tokenizer cuts anyway.

    So a word is one chunk whether or not a sentence ends with it. A text with other uses stays as it is.
    """
    parts = text.split(stop + " ")
    if len(parts) > 1 and all([part[-1:].isalnum() for part in parts[:-1]]):
        return f" {stop} ".join(parts)
    return text


#: White space in which a "spaced" tokenizer's cut depends on what stands around.
WIDE_SPACE = ("  ", "\n\n", "\n ", " \n", "\t", "\r", "\v", "\f")

#: A chunk of a "spaced" tokenizer: white space and the word after it. A word followed by white space ends a chunk.
SPACED = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

#: Fixed value: the pattern by which byte-level tokenizers of this kind cut a text.
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _style(spec: dict) -> tuple[str, str | None]:
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    plain_model = spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and not any(
        t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]
    )
    if not plain_model:
        return "whole", None
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
        return "spaced", SPACED_PATTERN
    steps = before.get("pretokenizers") or []
    if [s.get("type") for s in steps] == ["Split", "ByteLevel"] and [n.get("type") for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
        cut = steps[0]
        if cut["behavior"] == "Removed" and cut["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
            return "words", cut["pattern"]["Regex"]
    return "whole", None


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
