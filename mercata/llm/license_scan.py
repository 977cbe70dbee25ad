"""Licence notices in texts, paragraph by paragraph, by a trained classifier and a comparison with templates.

A paragraph is a line with a word. It is scored as a whole and in overlapping windows of ``WINDOWS`` words, so that a
notice counts the same in a long line as in a short one. The features of a window are its words, pairs and triples of words, hashed to ``BUCKETS`` and
scaled by the root of their number; a multinomial logistic regression gives a probability to every licence family
and to "unknown". It is trained on the templates below in many damaged forms and on ordinary paragraphs: sentences of
no licence, and paragraphs of the corpus that share little with any template. A temperature found on held-out
paragraphs makes the probabilities honest, and a family is named only if it is likelier than ``threshold``. A named
family is confirmed if the words around the window and one of the family's sentences share most of their word triples.
Every family of a paragraph is reported, but the same words speak for one family only, the one they fit best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import WordHash, mix, ngram_hashes

BUCKETS = 1 << 12
UNKNOWN = "unknown"
THRESHOLD, CONFIRM = 0.5, 0.6
#: Words in a window and from one window to the next, words compared on either side, and words scored at a time.
WINDOWS, AROUND, BLOCK = ((8, 4), (24, 12), (64, 32)), 64, 1 << 16
#: Ordinary paragraphs come from about so many documents, drawn by hash over the whole table, and at most so many
#: characters of each, from a place drawn by hash.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 400, 4000
#: Of their lines, drawn by hash, so many are training examples, and so many give the words around damaged templates.
TRAINING_LINES, FILLER_LINES = 1500, 200
#: Bytes of lines whose findings are remembered, and the longest such line.
REMEMBERED, LONGEST_REMEMBERED = 16 << 20, 2048

#: Sentences by which texts declare public licences, as commonly published.
TEMPLATES = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License version 3.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
#: Sentences that talk like licences and are none.
OTHERS = [
    "He has a driving license and a license to practise law.", "The software is released under the moon every version of spring.",
    "This work is about the general public and the terms of free trade.", "Permission to leave the room is hereby granted to any person.",
    "You may not use this door except in case of fire.", "The public domain of knowledge belongs to all contributors.",
    "Version 2.0 of the report was distributed to the members of the board.", "The commons is a public place under the old trees.",
    "Neither the name nor the address of the author is known.", "The foundation published a free book about software.",
    "All rights reserved.", "Conditions of any kind may apply, with or without notice.", "Copyright law is a matter for courts.",
]

_PUNCTUATION = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))


def plain_words(line: bytes) -> list[bytes]:
    """Lower-case words of a line without ASCII punctuation."""
    return line.lower().translate(_PUNCTUATION).split()


def grams(words: list[bytes], hashes: WordHash) -> np.ndarray:
    seen = hashes.of(words)
    return np.concatenate([mix(seen), ngram_hashes(seen, 2), ngram_hashes(seen, 3)])


def triples(words: list[bytes], hashes: WordHash) -> set[int]:
    return set(ngram_hashes(hashes.of(words), min(3, len(words))).tolist()) if words else set()


@dataclass(frozen=True)
class Model:
    families: list[str]  # the last is UNKNOWN
    weights: np.ndarray  # (buckets, families)
    bias: np.ndarray
    temperature: float
    held_out_accuracy: float


def windows(size: int) -> np.ndarray:
    """(window, 2): first word and end of the whole and of every window of a paragraph of ``size`` words."""
    out = [np.array([[0, size]])]
    for width, step in WINDOWS:
        if size > width:
            first = np.minimum(np.arange(0, size - width + step, step), size - width)
            out.append(np.stack([first, first + width], axis=1))
    return np.concatenate(out)


def probabilities(model: Model, paragraphs: list[list[bytes]], hashes: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(paragraph, first word, end) of every window, and its (window, family) probabilities; every paragraph has a word."""
    found = [(grams(words, hashes) & np.uint64(BUCKETS - 1)).astype(np.int64) for words in paragraphs]
    cuts = [windows(len(words)) for words in paragraphs]
    of = np.repeat(np.arange(len(paragraphs)), [len(c) for c in cuts])
    first, end = np.concatenate(cuts).T
    size = np.array([len(words) for words in paragraphs])[of]
    start = np.concatenate([[0], np.cumsum([len(f) for f in found])[:-1]]).astype(np.int64)[of]
    so_far = np.zeros((sum(len(f) for f in found) + 1, len(model.families)))
    np.cumsum(model.weights[np.concatenate(found)], axis=0, out=so_far[1:])
    sums, counts = np.zeros((len(of), len(model.families))), np.zeros(len(of))
    for n in (1, 2, 3):  # a paragraph's words, pairs and triples follow one another
        low, high = start + first, start + np.maximum(end - n + 1, first)
        sums, counts = sums + so_far[high] - so_far[low], counts + high - low
        start = start + np.maximum(size - n + 1, 0)
    logits = (sums / np.sqrt(counts)[:, None] + model.bias) / model.temperature
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    return of, np.stack([first, end], axis=1), odds / odds.sum(axis=1, keepdims=True)


def blocks(lines: list[tuple[int, bytes]]) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """Lists of (line, first word, words) of at most about ``BLOCK`` words; parts of a longer line overlap."""
    out, held = [], 0
    for i, line in lines:
        words = plain_words(line)
        for at in range(0, max(len(words) - AROUND, 1) if words else 0, BLOCK - AROUND):
            part = words[at : at + BLOCK]
            out.append((i, at, part))
            held += len(part)
            if held >= BLOCK:
                yield out
                out, held = [], 0
    if out:
        yield out


Finding = tuple[str, float, float]


class Seen(dict):
    """Findings of lines by their text, which do not depend on the lines around. Starts over when ``REMEMBERED`` is full."""

    size = 0

    def keep(self, line: bytes, found: list[Finding]) -> None:
        if len(line) > LONGEST_REMEMBERED:
            return
        if self.size > REMEMBERED:
            self.clear()
            self.size = 0
        self.size += len(line) + 150
        self[line] = found


def findings(
    model: Model, text: bytes, known: dict[str, list[set[int]]], hashes: WordHash, threshold: float, seen: Seen | None = None
) -> list[tuple[int, str, float, float]]:
    """line, family, probability, overlap: the families of every line, each once.

    Equal lines have equal findings: with ``seen``, each is judged once as long as it is remembered.
    """
    seen = Seen() if seen is None else seen
    lines = text.split(b"\n")
    new: dict[bytes, int] = {}
    for i, line in enumerate(lines):
        if line not in seen:
            new.setdefault(line, i)
    found = judged(model, [(i, line) for line, i in new.items()], known, hashes, threshold)
    by_line = {line: found.get(i, []) for line, i in new.items()}
    out = [(i, *f) for i, line in enumerate(lines) for f in (by_line[line] if line in by_line else seen[line])]
    for line, got in by_line.items():
        seen.keep(line, got)
    return out


def judged(
    model: Model, lines: list[tuple[int, bytes]], known: dict[str, list[set[int]]], hashes: WordHash, threshold: float
) -> dict[int, list[Finding]]:
    """family, probability, overlap of each numbered line that has a finding."""
    named: dict[int, list[tuple[float, float, int, str, set[int], bool]]] = {}
    for block in blocks(lines):
        of, spans, chances = probabilities(model, [words for _, _, words in block], hashes)
        best = chances.argmax(axis=1)
        for w in np.flatnonzero((best != len(model.families) - 1) & (chances.max(axis=1) >= threshold)):
            (line, at, words), (first, end), family = block[of[w]], spans[w].tolist(), model.families[best[w]]
            low = max(0, first - AROUND)
            near = words[low : end + AROUND]
            size = min(3, len(near))
            have = ngram_hashes(hashes.of(near), size).tolist()
            own = set(have)
            overlap, k = max(((len(own & k) / min(len(k), max(len(own), 1)), k) for k in known[family]), key=lambda x: x[0])
            fits = {at + low + j + m for j, h in enumerate(have) if h in k for m in range(size)}
            named.setdefault(line, []).append((overlap, float(chances[w, best[w]]), end - first, family, fits or set(range(at + first, at + end)), bool(fits)))
    out: dict[int, list[Finding]] = {}
    for line, found in named.items():
        taken: set[int] = set()
        given: set[str] = set()
        for overlap, chance, _, family, covers, fits in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[3])):
            if family in given or len(covers & taken) > (len(covers) // 2 if fits else 0):
                continue
            given.add(family)
            taken |= covers
            out.setdefault(line, []).append((family, chance, overlap))
    return out


def ordinary_paragraphs(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Lines of a bounded sample of the corpus, some of which may be licence notices."""
    text, mark = F.col(text_col).cast("string"), F.xxhash64(id_col, text_col)
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))
    spot = 1 + F.pmod(F.xxhash64(mark), F.greatest(F.char_length(text) - SAMPLE_CHARS + 1, F.lit(1)))
    drawn = docs.where((F.length(text) > 0) & (F.pmod(mark, F.lit(1 << 40)) < int(share * (1 << 40))))
    rows = drawn.select(F.substring(text, spot.cast("int"), F.lit(SAMPLE_CHARS)).alias("t")).limit(SAMPLE_DOCUMENTS).collect()
    lines = {line for r in rows for line in r["t"].split("\n")}
    return sorted(lines, key=lambda line: (xxhash.xxh3_64_intdigest(line.encode("utf-8")), line))


def train(corpus: list[str], seed: int = 4, forms: int = 24, steps: int = 150) -> Model:
    """Fits the classifier on damaged templates and ordinary lines; a fifth is held out for the temperature."""
    rng, hashes = np.random.default_rng(seed), WordHash()
    families = [*TEMPLATES, UNKNOWN]
    known = [triples(plain_words(t.encode()), hashes) for ts in TEMPLATES.values() for t in ts]
    lines = [plain_words(line.encode()) for line in corpus]
    ordinary = [w for w in lines if w and all(len(triples(w, hashes) & k) < 0.3 * len(k) for k in known)]
    filler = [w for words in ordinary[:FILLER_LINES] for w in words] or [b"of", b"and", b"to"]
    examples: list[tuple[list[bytes], int]] = [(w, len(families) - 1) for w in ordinary[:TRAINING_LINES]]
    for words in ordinary[:TRAINING_LINES]:
        for width, _ in WINDOWS:
            if len(words) > width:
                at = int(rng.integers(len(words) - width + 1))
                examples.append((words[at : at + width], len(families) - 1))
    for label, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            words = plain_words(template.encode())
            for k in range(forms):
                kept = [w for w in words if k < 3 or rng.random() > 0.08]
                around = [[filler[int(i)] for i in rng.integers(len(filler), size=rng.integers(0, (1, 6, AROUND // 2)[k % 3]))] for _ in range(2)]
                examples.append((around[0] + (kept or words) + around[1], label))
    for other in OTHERS:
        words = plain_words(other.encode())
        examples += [([w for w in words if k < 2 or rng.random() > 0.1] or words, len(families) - 1) for k in range(forms)]
    x = np.zeros((len(examples), BUCKETS), np.float32)
    y = np.array([label for _, label in examples])
    for i, (words, _) in enumerate(examples):
        at = (grams(words, hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)
        np.add.at(x[i], at, 1 / np.sqrt(len(at)))
    held = rng.random(len(y)) < 0.2
    weights, bias = np.zeros((BUCKETS, len(families)), np.float32), np.zeros(len(families), np.float32)
    speed_w, speed_b, truth = np.zeros_like(weights), np.zeros_like(bias), np.eye(len(families), dtype=np.float32)[y[~held]]
    share = truth.mean(axis=0)
    cost = (truth / (share * len(families))).sum(axis=1, keepdims=True)  # families count alike, however many examples
    for _ in range(steps):
        logits = x[~held] @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = cost * (odds / odds.sum(axis=1, keepdims=True) - truth) / len(truth)
        speed_w = 0.9 * speed_w - 2 * (x[~held].T @ error + 1e-5 * weights)
        speed_b = 0.9 * speed_b - 2 * error.sum(axis=0)
        weights, bias = weights + speed_w, bias + speed_b
    logits, right = x[held] @ weights + bias, y[held]

    def surprise(t: float) -> float:
        z = logits / t - (logits / t).max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(right)), right]))

    temperature = min(np.geomspace(0.1, 10, 41).tolist(), key=surprise)
    return Model(families, weights, bias, temperature, float((logits.argmax(axis=1) == right).mean()))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, confirm: float = CONFIRM) -> DataFrame:
    """id, line (from 0), family, probability, overlap, confirmed: one row per paragraph and family given to it.

    Null and empty texts have no paragraph; texts are read whole; repeated rows give repeated findings.
    """
    hashes = WordHash()
    known = {f: [triples(plain_words(t.encode()), hashes) for t in ts] for f, ts in TEMPLATES.items()}

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, seen = WordHash(), Seen()
        for frame in frames:
            out = [
                (name, *found, found[-1] >= confirm)
                for name, text in zip(frame["id"], frame["text"]) for found in findings(model, (text or "").encode("utf-8"), known, own, threshold, seen)
            ]
            yield pd.DataFrame(out, columns=["id", "line", "family", "probability", "overlap", "confirmed"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInPandas(find, "id string, line long, family string, probability double, overlap double, confirmed boolean")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
