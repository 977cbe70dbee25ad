"""Near-duplicate classes by minhash with tensored banding, confirmed on full shingle sets.

Two small collections of ``BANDS`` keys each are computed, a key being ``ROWS`` minhashes of the set of word shingles.
A table key is a pair (one of the first collection, one of the second), so BANDS x BANDS tables cost only 2 x BANDS
keys, and two sets with Jaccard similarity s meet in some table with probability (1 - (1 - s^ROWS)^BANDS)^2: with 16
bands of 3 all but 2 in 100,000 pairs at the threshold 0.8. Pairs are formed only of keys that at least two sets share;
the others can't put two sets together.

Sets are taken once per distinct set (a class), however many documents have it. Classes that meet in tables form
groups; inside a group every two classes are compared exactly, on their whole sets, so no candidate pair is ever a
row. Weakly similar sets meet now and then too, and in a large corpus chains of such meetings make large groups. A group
of more than ``BLOCK`` classes is therefore parted by ``FINE_BANDS`` keys of ``FINE_ROWS`` fresh minhashes of its sets,
which similar sets miss with probability 2e-6, and weak ones mostly do. What is still larger than ``BLOCK`` is cut by
set size (sets of very different size can't be similar) and by hash, and its blocks are compared two by two in tasks
of their own. The confirmed links join classes to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .common import WordHash, byte_words, mix, multiplier, ngram_hashes, spare_name

SHINGLE_WORDS, SIMILARITY = 5, 80  # similarity in per cent
BANDS, ROWS = 16, 3
#: Keys that part large groups: two sets of similarity s meet with probability 1 - (1 - s^FINE_ROWS)^FINE_BANDS.
FINE_BANDS, FINE_ROWS = 72, 8
#: Classes compared in one task. A group's work grows with the square of this, its memory with this.
BLOCK = 1000


def shingle_set(text: str | None, hashes: WordHash, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words, A-Z in lower case; a shorter text is one run."""
    seen = hashes.of(byte_words(text, lower=True))
    if not len(seen):
        return seen
    return np.unique(ngram_hashes(seen, min(words, len(seen))))


class Sketcher:
    """Keys of a set, each made of ``rows`` minhashes."""

    def __init__(self, count: int, rows: int, first: int = 0):
        self.count, self.rows = count, rows
        many = range(first, first + count * rows)
        self.times = np.array([multiplier(1000 + i) for i in many], np.uint64)[:, None]
        self.plus = mix(np.array([multiplier(5000 + i) for i in many], np.uint64))[:, None]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 2048):  # bounded memory for long texts
            low = np.minimum(low, (shingles[None, at : at + 2048] * self.times + self.plus).min(axis=1))
        low = (low >> np.uint64(16)).reshape(self.count, self.rows)  # high bits are the well mixed ones
        out = np.arange(self.count, dtype=np.uint64)
        for k in range(self.rows):
            out = mix(out * multiplier(k + 1) + low[:, k])
        return out.view(np.int64)


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, mark (hash of the text), n_shingles, digest (of the set; null if empty), first, second (the two collections)."""

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, own = WordHash(), Sketcher(2 * bands, rows)
        for frame in frames:
            sizes, digests, first, second = [], [], [], []
            for text in frame["text"]:
                found = shingle_set(text, hashes, words)
                keys = own.keys(found) if len(found) else np.empty(0, np.int64)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                first.append(keys[:bands])
                second.append(keys[bands:])
            yield pd.DataFrame({"id": frame["id"], "mark": frame["mark"], "n_shingles": sizes, "digest": digests, "first": first, "second": second})

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    picked = docs.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = picked.mapInPandas(sketch, "id string, mark long, n_shingles long, digest binary, first array<long>, second array<long>")
    return out.withColumn("id", F.col("id").cast(kind))


def table_rows(classes: DataFrame) -> DataFrame:
    """(key, node) for every table in which a class may meet another: pairs of shared keys of the two collections."""

    def shared(side: str) -> DataFrame:
        keys = classes.select("digest", F.explode(side).alias("key"))
        met = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        return keys.join(met, "key").groupBy("digest").agg(F.collect_list("key").alias(side))  # at most one per band

    both = shared("first").join(shared("second"), "digest")
    return both.select("digest", F.explode("first").alias("a"), "second").select("digest", "a", F.explode("second").alias("b")).select(
        F.xxhash64("a", "b").alias("key"), F.col("digest").alias("node")
    )


def components(members: DataFrame, label: str) -> DataFrame:
    """(node, root) for rows (key, node): nodes with a common key are connected, and a root is its component's least node.

    Each round hooks every node to the least node it shares a key with, shortens the paths to their ends by doubling,
    and puts the ends in place of the nodes; keys with one node left are done. Every table is written once and read
    back, so lost executors cost a task, not a round. Only nodes that share a key appear in the result.
    """
    alive, roots = stored(members.distinct(), f"{label}-members"), None
    while True:
        ends = alive.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
        hooks = stored(alive.join(ends.select("key", "low"), "key").groupBy("node").agg(F.min("low").alias("root")), f"{label}-hooks")
        if hooks.isEmpty():
            break
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            longer = stored(hooks.join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), f"{label}-paths")
            hooks = longer.select("node", "root")
            if longer.where("moved").isEmpty():
                break
        step = hooks.select(F.col("node").alias("from"), F.col("root").alias("to"))
        if roots is None:
            roots = hooks
        else:
            old = roots.join(step, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"))
            roots = stored(old, f"{label}-roots")
        moved = alive.join(ends.select("key"), "key", "left_semi").join(step, F.col("node") == F.col("from")).select("key", F.col("to").alias("node"))
        alive = stored(moved.distinct(), f"{label}-members")
    return roots if roots is not None else members.select("node", F.col("node").alias("root")).limit(0)


def compare_all(sets: list[np.ndarray], of_left: np.ndarray, similarity: int) -> np.ndarray:
    """Component number of each set, linking sets of similarity (in per cent) or more, all compared exactly.

    ``of_left``: the side of the cut on which a set lies; only sets of different sides are compared, unless all lie
    on the left, when every two are.
    """
    n = len(sets)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    by_size = [ids[starts[i] : starts[i + 1]] for i in order]
    flat, sizes = np.concatenate(by_size), sizes[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    left, flag = of_left[order], np.zeros(len(values), np.int32)
    both = left.all()
    for i in range(n - 1):
        stop = int(np.searchsorted(sizes, sizes[i] * 100 // similarity, side="right"))  # larger ones can't be similar
        if stop <= i + 1:
            continue
        flag[by_size[i]] = 1
        common = np.add.reduceat(flag[flat[starts[i + 1] : starts[stop]]], starts[i + 1 : stop] - starts[i + 1])
        flag[by_size[i]] = 0
        linked = 100 * common >= similarity * (sizes[i] + sizes[i + 1 : stop] - common)
        if not both:
            linked &= left[i + 1 : stop] != left[i]
        for j in np.nonzero(linked)[0]:
            a, b = find(int(order[i])), find(int(order[i + 1 + j]))
            parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def finer_groups(
    grouped: DataFrame, texts: DataFrame, words: int, block: int, bands: int = FINE_BANDS, rows: int = FINE_ROWS,
) -> DataFrame:
    """``grouped`` with the groups of more than ``block`` classes parted. Rows: digest, root, n_shingles.

    Classes of one group that share a fine key stay together. A class that shares none leaves: it is similar to no
    other. Smaller groups stay as they are, unread.
    """
    total = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("total"))
    large = total.where(F.col("total") > block).select("root")
    small = grouped.join(large, "root", "left_anti")
    coarse = stored(grouped.join(large, "root"), "large-groups")

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, own = WordHash(), Sketcher(bands, rows, 2 * BANDS * ROWS)
        for frame in frames:
            yield pd.DataFrame({"digest": frame["digest"], "keys": [own.keys(shingle_set(t, hashes, words)) for t in frame["text"]]})

    # one row per class, whatever number of rows has its text
    one = texts.join(coarse.select("digest"), "digest", "left_semi").mapInPandas(sketch, "digest binary, keys array<long>")
    keyed = one.dropDuplicates(["digest"]).join(coarse, "digest").select("root", "digest", F.explode("keys").alias("band"))
    rows_of = keyed.select(F.xxhash64("root", "band").alias("key"), F.col("digest").alias("node"))
    parted = components(rows_of, "finer").select(F.col("node").alias("digest"), F.col("root").alias("part"))
    fine = coarse.join(parted, "digest").select("digest", F.col("part").alias("root"), "n_shingles")
    return small.select("digest", "root", "n_shingles").unionByName(fine)


def _blocks(grouped: DataFrame, similarity: int, block: int) -> DataFrame:
    """Adds task, left: the tasks in which a class is compared. Rows: digest, root, n_shingles.

    A group of at most ``block`` classes is one task. A larger one is cut into size bands so wide that similar sets lie
    in one band or in neighbours, and a band by hash into parts of about ``block`` / 2; a task compares two parts.
    """
    total = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("total"))
    small = grouped.join(total.where(F.col("total") <= block), "root")
    whole = small.select("digest", F.hex("root").alias("task"), F.lit(True).alias("left"))
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100.0 / similarity) * 1.000001)).cast("long")
    large = grouped.join(total.where(F.col("total") > block).select("root"), "root").withColumn("band", band)
    parts = large.groupBy("root", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(block / 2)).alias("parts"))
    near = parts.select("root", (F.col("band") - 1).alias("band"), F.col("parts").alias("above")).unionByName(
        parts.select("root", "band", F.lit(0).alias("above"))
    ).groupBy("root", "band").agg(F.max("above").alias("above"))
    far = parts.select("root", (F.col("band") + 1).alias("band"), F.col("parts").alias("below"))
    cut = large.join(parts, ["root", "band"]).join(near, ["root", "band"]).join(far, ["root", "band"], "left")
    part = F.pmod(F.xxhash64("digest"), F.col("parts"))
    placed = cut.withColumn("part", part).withColumn("below", F.coalesce("below", F.lit(0)))

    def others(count: str, build) -> Column:
        return F.transform(F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count).cast("long") - 1)).otherwise(F.array().cast("array<long>")), build)

    def name(b1, p1, b2, p2):
        return F.concat_ws(":", F.hex("root"), b1.cast("string"), p1.cast("string"), b2.cast("string"), p2.cast("string"))

    me, mine = F.col("band"), F.col("part")
    same = others("parts", lambda q: F.struct(name(me, F.least(mine, q), me, F.greatest(mine, q)).alias("task"), (mine <= q).alias("left")))
    up = others("above", lambda q: F.struct(name(me, mine, me + 1, q).alias("task"), F.lit(True).alias("left")))
    down = others("below", lambda q: F.struct(name(me - 1, q, me, mine).alias("task"), F.lit(False).alias("left")))
    cut_rows = placed.select("digest", F.explode(F.concat(same, up, down)).alias("t")).select("digest", "t.task", "t.left")
    return whole.unionByName(cut_rows)


def near_classes(
    docs: DataFrame, words: int = SHINGLE_WORDS, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
    bands: int = BANDS, rows: int = ROWS, block: int = BLOCK,
) -> DataFrame:
    """id, mark (hash of the text), n_shingles, component_id, kept: one row per row of ``docs``.

    ``component_id`` is the smallest identifier that links lead to, the row's own included; null texts and texts
    without words link with nothing. Rows with equal sets are linked. A null identifier counts only where a component
    has no other. ``kept``: the identifier is the component's. Other columns are not read. No rows: no rows.
    """
    own = stored(sketches(docs, words, id_col, text_col, bands, rows), "sketches")
    # one narrow row per class; the copies of a text meet as partial minima before the shuffle
    classes = stored(own.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct(F.isnull("id"), "id", "mark")).alias("least"), F.first("n_shingles").alias("n_shingles"),
        F.first("first").alias("first"), F.first("second").alias("second"),
    ).select("digest", "least.id", "least.mark", "n_shingles", "first", "second"), "classes")
    groups = components(table_rows(classes), "groups").select(F.col("node").alias("digest"), "root")
    grouped = stored(groups.join(classes.select("digest", "id", "mark", "n_shingles"), "digest"), "grouped")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text")).alias("t")
    # the wanted side grows with the corpus: one plan at every size, and never a broadcast of it
    wanted = grouped.select("digest", "id", "mark").hint("merge").alias("w")
    found = texts.join(wanted, F.col("t.id").eqNullSafe(F.col("w.id")) & (F.col("t.mark") == F.col("w.mark"))).select("digest", "text")
    found = stored(found, "group-texts")
    parted = stored(finer_groups(grouped, found, words, block), "parted")
    tasks = _blocks(parted, similarity, block).join(found, "digest")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHash()
        frame = frame.drop_duplicates("digest").reset_index(drop=True)
        sets = [shingle_set(t, hashes, words) for t in frame["text"]]
        label = compare_all(sets, frame["left"].to_numpy(bool), similarity)
        linked = np.bincount(label, minlength=len(label))[label] > 1
        return pd.DataFrame({"task": frame["task"], "at": label, "node": frame["digest"]})[linked]

    linked = tasks.groupBy("task").applyInPandas(compare, "task string, at long, node binary")
    joined = components(linked.select(F.xxhash64("task", "at").alias("key"), "node"), "links")
    rooted = classes.select("digest", "id").join(joined.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "root", F.coalesce("root", "digest")
    )
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("digest", "component_id")
    out = own.select("id", "mark", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), "mark", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were: of each component the one of smallest identifier."""
    gone = stored(near_classes(docs, words, similarity, id_col, text_col).where("not kept").select(
        F.col(id_col).alias("gone_id"), F.col("mark").alias("gone_mark")
    ).distinct(), "near-copies")
    d, mark = docs, spare_name(docs, "mark")
    d = d.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    stays = d.join(gone, d[id_col].eqNullSafe(gone["gone_id"]) & (d[mark] == gone["gone_mark"]), "left_anti")
    return stays.select(*[F.col(f"`{c}`") for c in docs.columns])
