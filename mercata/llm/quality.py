"""Quality rules: base rules, then a log-likelihood ratio between a trusted multinomial and the raw corpus's.

Single words and pairs of words are hashed into ``BUCKETS`` counts, over every document for the raw corpus and over
trusted ones for the target. A document's score is the mean of log P(target) - log P(raw) over its n-grams, so length
does not move it, and every document is kept or dropped by one threshold. The labelled rows are used in halves, told
apart by hash: one half gives the target counts, the other sets the threshold, so no document is judged by a count
that it set itself during calibration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import WordHash, batches, byte_words, mix, ngram_hashes, spare_name

BUCKETS = 1 << 16
#: Labelled rows used at most, those of smallest hash. Raw counts always cover every document.
LABELLED = 100_000
#: Share of good calibration documents that the threshold must keep.
KEEP_GOOD = 0.995
MIN_WORDS = 50
#: Fixed values of the contract: symbols, and white space as code points.
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"

_RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


@dataclass(frozen=True)
class Model:
    """``weights``: log ratio per bucket; ``threshold``: documents scoring below it go."""

    weights: np.ndarray
    threshold: float


def repeated_words(words: np.ndarray) -> int:
    """Words inside any 3-word window that is found twice or more."""
    if len(words) < 4:
        return 0
    windows = ngram_hashes(words, 3)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.searchsorted(twice, windows)
    found[found == len(twice)] = 0
    hit = twice[found] == windows
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def buckets_of(words: np.ndarray) -> np.ndarray:
    grams = np.concatenate([mix(words), ngram_hashes(words, 2)])
    return (grams & np.uint64(BUCKETS - 1)).astype(np.int64)


def measure(text: str | None, hashes: WordHash, weights: np.ndarray) -> tuple:
    text = text or ""
    words = hashes.of(byte_words(text))
    lines = [line for line in text.encode("utf-8").split(b"\n") if line.strip()]
    grams = buckets_of(words)
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words), float(weights[grams].mean()) if len(grams) else 0.0,
    )


def measures(text: Column, weights: np.ndarray) -> Column:
    """Struct of the base counts and the score of a text column; null counts as empty."""

    @F.pandas_udf(_RESULT)
    def judge(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for texts in series:
            yield pd.DataFrame([measure(t if isinstance(t, str) else "", hashes, weights) for t in texts], columns=_COLUMNS)

    return judge(text.cast("string"))


_COLUMNS = [c.split()[0] for c in _RESULT.split(", ")]


def base_failed(m: str) -> Column:
    """The base rules on the struct column ``m``: too short, or half of its words repeat."""
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > 50 * F.col(f"{m}.n_words"))


def labelled_sample(labels: DataFrame, id_col: str, limit: int) -> DataFrame:
    """id, role of at most ``limit`` labelled documents: 1 gives target counts, 2 and 3 are good and bad for calibration.

    Good: quality 1 and not toxic; bad: quality 0. A document labelled several times counts by its worst labels; rows
    without id or quality, and toxic ones of good quality, are left out.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    draw = F.xxhash64(F.lit(10), F.col("id"))
    role = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.when(F.shiftright(draw, 8) % 2 == 0, 1).otherwise(2)).when(F.col("quality") == 0, 3)
    return one.select("id", role.alias("role"), draw.alias("draw")).where("role is not null").orderBy("draw", "id").limit(limit).select("id", "role")


def corpus_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all rows (text, role), and over those of role 1. Each task sends one row per bucket."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, raw, target = WordHash(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for frame in frames:
            for trusted, texts in frame.dropna(subset=["text"]).groupby("trusted")["text"]:
                for some in batches(texts, 200):
                    grams = [buckets_of(hashes.of(byte_words(text))) for text in some]
                    own = np.bincount(np.concatenate(grams), minlength=BUCKETS)
                    raw += own
                    if trusted:
                        target += own
        seen = np.nonzero(raw)[0]
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})

    parts = rows.select(F.col("text"), (F.coalesce("role", F.lit(0)) == 1).alias("trusted")).mapInPandas(count, "bucket long, raw long, target long")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():  # at most BUCKETS rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def best_threshold(good: np.ndarray, bad: np.ndarray, keep_good: float) -> float:
    """Between two neighbouring scores: best mean of kept good and dropped bad, the lowest of equals, with ``keep_good``
    of the good kept. Nothing to tell apart: no document is dropped."""
    if not len(good) or not len(bad):
        return float("-inf")
    good, bad = np.sort(good), np.sort(bad)
    scores = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[-np.inf], (scores[1:] + scores[:-1]) / 2])
    kept = 1 - np.searchsorted(good, cuts) / len(good)
    dropped = np.searchsorted(bad, cuts) / len(bad)
    value = np.where(kept >= keep_good, kept + dropped, -1)
    return float(cuts[int(np.argmax(value))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED, keep_good: float = KEEP_GOOD) -> Model:
    """Counts every document, then calibrates on the labelled ones that pass the base rules. No labels: all pass."""
    sample = F.broadcast(labelled_sample(labels, id_col, labelled))  # at most ``labelled`` rows of two numbers
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(sample, "id", "left")
    raw, target = corpus_counts(rows)
    if not target.sum():
        return Model(np.zeros(BUCKETS), float("-inf"))
    weights = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    judged = rows.where("role > 1").select("role", measures(F.col("text"), weights).alias("m")).where(~base_failed("m"))
    scores = judged.select("role", "m.score").collect()  # of the labelled sample
    by_role = {k: np.array([r["score"] for r in scores if r["role"] == k]) for k in (2, 3)}
    return Model(weights, best_threshold(by_role[2], by_role[3], keep_good))


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the base counts, base_failed, score, kept: one row per row. Null texts have no words and fail."""
    rows = docs.select(F.col(id_col), measures(F.col(text_col), model.weights).alias("m"))
    return rows.select(
        id_col, "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        base_failed("m").alias("base_failed"), "m.score", (~base_failed("m") & (F.col("m.score") >= model.threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that pass, all columns as they were."""
    m = spare_name(docs, "m")
    judged = docs.withColumn(m, measures(F.col(text_col), model.weights))
    return judged.where(~base_failed(m) & (F.col(f"{m}.score") >= model.threshold)).select(*[F.col(f"`{c}`") for c in docs.columns])
