"""Prefix trie of conversations in minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Its digest is the exclusive or of position-bound hashes of its turns, so
the digests of all prefixes of a conversation are one running fold, and the fold up to any depth can be handed on.

1. ``shared_turns`` puts each conversation in order and lets it begin with turns of another one.
2. Conversations are dealt to shards by identifier block, and long ones are cut into bands of ``band`` turns. A shard
   enumerates its distinct prefix digests and gives each a slot by a minimal perfect hash; every slot keeps its
   digest, its parent's digest and its turn's check value, and each occurrence must agree with them, so no two
   sequences can pass for one (a disagreement ends the run, another ``seed`` takes new hashes). Counts are scattered
   into flat arrays by slot and added up through the parent-slot array from the deepest level to the top.
3. Nodes that several shards share are added together by digest, which gives each node's members and its owner, the
   smallest member. A node's own weight is counted only in its owner's shard, so the second pass up the same
   tables (leaves, saved tokens, children) can again be added over shards. Every prefix of an owned node's owner runs
   through that shard, hence every ancestor receives the weight exactly once.
4. What a long conversation owns in later bands enters an earlier band at the slot where it leaves that band.

No group grows with the table: a shard's band holds a bounded number of turns, a hot node is one row per shard, and a
node's member list is hashed in order, from chunks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .common import mix, multiplier, shuffle_width

BAND = 2048
SHARD_TURNS = 200_000
CHUNK_IDS = 8192

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits that exactly one key sets; the slot is the bit's rank.

    A key that shares its bit on one level goes on to the next. Keys left after the last level keep a sorted list.
    A key that was not among the given ones gets any slot or -1; callers compare what the slot stores.
    """

    GAMMA, LEVELS = 2, 24

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, left = 0, keys
        for level in range(self.LEVELS):
            if not len(left):
                break
            width = max(64, self.GAMMA * len(left))
            places = self._place(left, level, width)
            alone = np.bincount(places, minlength=width) == 1
            self.levels.append((alone, self.size + np.cumsum(alone) - 1))
            self.size += int(alone.sum())
            left = left[~alone[places]]
        self.rest = np.sort(left)
        self.size += len(self.rest)

    @staticmethod
    def _place(keys: np.ndarray, level: int, width: int) -> np.ndarray:
        return (mix(keys ^ multiplier(level + 7)) % np.uint64(width)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            places = self._place(keys[open_], level, len(alone))
            hit = alone[places]
            out[open_[hit]] = rank[places[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            found = self.rest[at] == keys[open_]
            out[open_[found]] = self.size - len(self.rest) + at[found]
        return out


class NodeTable:
    """Slots of distinct nodes, each a 128-bit digest in two lanes, with verified look-up."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        pairs = np.unique(np.stack([low, high], axis=1), axis=0)
        keys = self._key(pairs[:, 0], pairs[:, 1])
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two prefix digests share a key; choose another seed")
        self.hash = PerfectHash(keys)
        at = self.hash.slots(keys)
        self.low, self.high = np.empty(len(keys), np.uint64), np.empty(len(keys), np.uint64)
        self.low[at], self.high[at] = pairs[:, 0], pairs[:, 1]

    def __len__(self) -> int:
        return len(self.low)

    @staticmethod
    def _key(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return low ^ mix(high)

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 where the table does not hold it."""
        at = self.hash.slots(self._key(low, high))
        if len(self):
            at[(self.low[at] != low) | (self.high[at] != high)] = -1
        return at

    def keep(self, at: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
        """One value per slot of each column; all occurrences of a slot must agree."""
        kept = []
        for column in columns:
            flat = np.zeros(len(self), column.dtype)
            flat[at] = column
            if (flat[at] != column).any():
                raise ValueError("two prefixes share a digest; choose another seed")
            kept.append(flat)
        return kept


def climb(depth: np.ndarray, parent: np.ndarray, step: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """``step(slots, their parents)`` for each level from the deepest up; slots without a parent are left out."""
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in reversed(np.split(order, cuts)):
        level = level[parent[level] >= 0]
        if len(level):
            step(level, parent[level])


def shared_turns(
    turns: DataFrame, heads: Column, leader: Column, most: int, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """conv, depth, key, chars: the turns of every conversation, its first ``heads`` ones replaced by those of ``leader``.

    ``heads`` (at most ``most``) and ``leader`` are expressions over a column ``conv`` (long). The first ``heads`` turns of
    the leader come first (all it has, if fewer; none if it is absent), then the conversation's own turns after its first
    ``heads``. Turns are ordered by ``turn`` (null first) and, where equal, by digest; null role and text are empty. ``key`` is the
    SHA-256 of (role, text), ``chars`` the text's code points. Depth 0, without key, is there for every conversation.
    Rows without a conversation identifier belong to none and are left out. Other columns are not read.

    Rows are range-partitioned by conversation, turn and digest, so that one conversation may span many tasks;
    its positions continue from part to part.
    """
    spark = turns.sparkSession
    role_, text_ = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256))
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), key.alias("key"), F.char_length(text_).cast("long").alias("chars"))
    rows = rows.filter(F.col("conv").isNotNull()).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")]
    ranged = rows.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for frame in frames:
            if not len(frame):
                continue
            convs = frame["conv"].to_numpy()
            starts = np.flatnonzero(np.r_[True, convs[1:] != convs[:-1]])
            counts = np.diff(np.r_[starts, len(convs)])
            place = np.arange(1, len(convs) + 1) - np.repeat(starts, counts)
            if convs[0] == last:
                place[: counts[0]] += seen
            last, seen = convs[-1], int(place[-1])
            yield frame.assign(place=place, part=part)

    numbered = stored(ranged.select("conv", "key", "chars").mapInPandas(number, "conv long, key binary, chars long, place long, part int"), "turns")
    parts = numbered.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a part continues at most one conversation, so this is at most one row per part
    offsets = parts.withColumn("skip", F.sum("n").over(before)).filter("skip > 0").select(F.col("conv").alias("c_"), F.col("part").alias("p_"), "skip")
    own = numbered.join(F.broadcast(offsets), (F.col("conv") == F.col("c_")) & (F.col("part") == F.col("p_")), "left")
    own = own.select("conv", "key", "chars", (F.col("place") + F.coalesce("skip", F.lit(0))).alias("place"))

    convs = parts.groupBy("conv").agg(F.sum("n").alias("own")).withColumn("heads", heads).withColumn("leader", leader)
    lead = (
        own.filter(F.col("place") <= most).groupBy(F.col("conv").alias("leader"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "key", "chars"))).alias("first"))
    )
    convs = convs.join(lead, "leader", "left").select(
        "conv", "heads", "own", F.slice(F.coalesce("first", F.array().cast(lead.schema["first"].dataType)), F.lit(1), F.greatest("heads", F.lit(0))).alias("first")
    ).withColumn("shift", F.size("first") - F.col("heads"))
    inherited = convs.select("conv", F.explode("first").alias("t")).select("conv", F.col("t.place").alias("depth"), "t.key", "t.chars")
    tail = own.join(convs.select("conv", "heads", "shift"), "conv").filter("place > heads").select("conv", (F.col("place") + F.col("shift")).alias("depth"), "key", "chars")
    roots = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("chars"))
    return roots.unionByName(inherited).unionByName(tail)


_NODE = "d1 long, d2 long, depth long, p1 long, p2 long, chk long, chars long, n long, owner long, ends long, ended array<long>, shard long, band long"


def _lanes(frame: pd.DataFrame, *names: str) -> list[np.ndarray]:
    return [frame[name].to_numpy(np.int64).view(np.uint64) for name in names]


def _runs(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Digest and parent digest of every turn row of a shard's band, sorted by (conv, depth)."""
    t1, t2, c1, c2 = _lanes(frame, "t1", "t2", "c1", "c2")
    convs = frame["conv"].to_numpy(np.int64)
    starts = np.flatnonzero(np.r_[True, convs[1:] != convs[:-1]])
    of = np.repeat(starts, np.diff(np.r_[starts, len(convs)]))
    out = []
    for t, c in ((t1, c1), (t2, c2)):
        fold = np.bitwise_xor.accumulate(t)
        digest = fold ^ fold[of] ^ t[of] ^ c  # the fold from the conversation's first row here, and what came before
        out += [digest, digest ^ t]
    return tuple(out)


def _count(frame: pd.DataFrame) -> pd.DataFrame:
    """First pass of one shard's band: members, smallest member and ends of each node."""
    frame = frame.sort_values(["conv", "depth"], kind="stable", ignore_index=True)
    d1, p1, d2, p2 = _runs(frame)
    depth, convs = frame["depth"].to_numpy(np.int64), frame["conv"].to_numpy(np.int64)
    top = depth == depth.min()  # the root, or the first level of a later band: parents are not in this table
    table = NodeTable(d1, d2)
    at = table.slots(d1, d2)
    flat_depth, q1, q2, chk, chars = table.keep(at, depth, p1, p2, frame["chk"].to_numpy(np.int64), frame["chars"].to_numpy(np.int64))
    parent = table.slots(q1, q2)
    parent[at[top]] = -1
    lost = (parent < 0) & (flat_depth > depth.min())
    if lost.any():
        raise ValueError("depths of a conversation must be contiguous from 0")
    leaves_here = np.r_[convs[1:] != convs[:-1], True]  # the last row of each conversation in this band
    members, owner = np.zeros(len(table), np.int64), np.full(len(table), np.iinfo(np.int64).max)
    np.add.at(members, at[leaves_here], 1)
    np.minimum.at(owner, at[leaves_here], convs[leaves_here])

    def up(slots: np.ndarray, parents: np.ndarray) -> None:
        np.add.at(members, parents, members[slots])
        np.minimum.at(owner, parents, owner[slots])

    climb(flat_depth, parent, up)
    ended = leaves_here & (frame["last"].to_numpy(np.int64) == depth)
    ends = np.bincount(at[ended], minlength=len(table))
    order = np.lexsort((convs[ended], at[ended]))
    lists = np.split(convs[ended][order], np.cumsum(ends)[:-1]) if len(table) else []
    signed = [x.view(np.int64) for x in (table.low, table.high, q1, q2)]
    return pd.DataFrame({
        "d1": signed[0], "d2": signed[1], "depth": flat_depth, "p1": signed[2], "p2": signed[3], "chk": chk, "chars": chars,
        "n": members, "owner": owner, "ends": ends, "ended": lists, "shard": frame["shard"].iloc[0], "band": frame["band"].iloc[0],
    })


_SUMS = "owner long, depth long, parent_conv long, n long, children long, leaves long, saved long"


def _sum(frame: pd.DataFrame) -> pd.DataFrame:
    """Second pass of one shard's band: children, leaves and saved tokens below each node, of weights owned here."""
    nodes = frame[~frame["carry"]].reset_index(drop=True)
    low, high = _lanes(nodes, "d1", "d2")
    table = NodeTable(low, high)
    at = table.slots(low, high)
    depth, owner, n, ghost, mine = table.keep(at, *(nodes[c].to_numpy() for c in ("depth", "owner", "n", "ghost", "mine")))
    q1, q2 = table.keep(at, *_lanes(nodes, "p1", "p2"))
    ends, chars = table.keep(at, nodes["ends"].to_numpy(), nodes["chars"].to_numpy())
    parent = table.slots(q1, q2)
    parent[(depth == 0) | ghost] = -1
    weight = mine & ~ghost
    leaves = np.where(weight & (ends == n), 1, 0)
    saved = np.where(weight, (n - 1) * chars, 0)
    children = np.zeros(len(table), np.int64)
    has = weight & (parent >= 0)
    np.add.at(children, parent[has], 1)
    carried = frame[frame["carry"]]
    into = table.slots(*_lanes(carried, "d1", "d2"))
    np.add.at(leaves, into, carried["leaves"].to_numpy(np.int64))
    np.add.at(saved, into, carried["saved"].to_numpy(np.int64))

    def up(slots: np.ndarray, parents: np.ndarray) -> None:
        np.add.at(leaves, parents, leaves[slots])
        np.add.at(saved, parents, saved[slots])

    climb(depth, parent, up)
    out = pd.DataFrame({
        "owner": owner, "depth": depth, "parent_conv": pd.array(owner[parent], dtype="Int64"), "n": n, "children": children,
        "leaves": np.where(ghost, 0, leaves), "saved": np.where(ghost, 0, saved),
    })
    out.loc[parent < 0, "parent_conv"] = pd.NA
    return out[(children > 0) | ~ghost]


def _end_hashes(ends: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of the comma-joined ids ``conv`` of each (owner, depth), ascending.

    A hash must be fed in order; what a single task reads of a hot node is ready text in chunks of ``CHUNK_IDS`` ids.
    """
    node = ["owner", "depth"]
    ranged = ends.repartitionByRange(shuffle_width(ends.sparkSession), *node, "conv").sortWithinPartitions(*node, "conv")

    def chunk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            owner, depth, conv = (frame[c].to_numpy() for c in ("owner", "depth", "conv"))
            new = np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1
            cuts = np.unique(np.r_[0, new, np.arange(0, len(conv), CHUNK_IDS), len(conv)])
            yield pd.DataFrame({
                "owner": owner[cuts[:-1]], "depth": depth[cuts[:-1]], "first": conv[cuts[:-1]],
                "ids": [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:])],
            })

    chunks = ranged.mapInPandas(chunk, "owner long, depth long, first long, ids string")

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, running = None, hashlib.sha256()
        for frame in frames:
            done = []
            for owner, depth, ids in zip(frame["owner"].tolist(), frame["depth"].tolist(), frame["ids"]):
                if (owner, depth) == last:
                    running.update(b"," + ids.encode())
                    continue
                if last is not None:
                    done.append((*last, running.hexdigest()))
                last, running = (owner, depth), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["owner", "depth", "ends_sha256"])
        if last is not None:
            yield pd.DataFrame([(*last, running.hexdigest())], columns=["owner", "depth", "ends_sha256"])

    ordered = chunks.repartition(*node).sortWithinPartitions(*node, "first")
    return ordered.mapInPandas(digest, "owner long, depth long, ends_sha256 string")


def trie(turns: DataFrame, block: int = 100, band: int = BAND, shard_turns: int = SHARD_TURNS, seed: int = 1) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    ``turns`` holds conv (long), depth (contiguous from 0, where the key is null), key (binary) and chars, each
    (conv, depth) once, as ``shared_turns`` gives them. conv_id is the smallest member, so (conv_id, depth) names a node.
    Conversations of equal ``conv div block`` meet in one shard, which only saves work. No conversations: no rows.
    """
    rows = stored(turns, "rebuilt")
    count = rows.count()
    shards = max(1, -(-count // shard_turns))
    lengths = rows.groupBy("conv").agg(F.max("depth").alias("last"))

    def shard_of(conv: str) -> Column:
        return F.pmod(F.xxhash64((F.col(conv) - F.pmod(F.col(conv), F.lit(block))).cast("long")), F.lit(shards).cast("long"))

    def tag(lane: int) -> Column:
        return F.xxhash64(F.lit(seed * 4 + lane), "depth", "key")

    rows = rows.join(lengths, "conv").select(
        "conv", "depth", "chars", "last", tag(0).alias("t1"), tag(1).alias("t2"), F.coalesce(F.xxhash64(F.lit(seed * 4 + 2), "key"), F.lit(0)).alias("chk"),
        shard_of("conv").alias("shard"), F.greatest(F.floor((F.col("depth") - 1) / band), F.lit(0)).cast("long").alias("band"),
    )
    # digests with which long conversations leave each band
    done = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    folds = rows.filter(F.col("last") > band).groupBy("conv", "band").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    carry = stored(folds.select("conv", "band", F.bit_xor("x1").over(done).alias("c1"), F.bit_xor("x2").over(done).alias("c2")).filter("band > 0"), "carry")
    late = rows.filter("band > 0").join(carry, ["conv", "band"])
    rows = rows.filter("band = 0").withColumns({"c1": F.lit(0).cast("long"), "c2": F.lit(0).cast("long")}).unionByName(late)

    partial = stored(rows.groupBy("shard", "band").applyInPandas(_count, _NODE), "nodes")
    same = ["p1", "p2", "chk", "chars"]
    merged = partial.groupBy("d1", "d2", "depth").agg(
        *(F.min(c).alias(c) for c in same), F.sum("n").alias("n"), F.min("owner").alias("owner"), F.sum("ends").alias("ends"),
        F.collect_list("shard").alias("shards"),
        F.max(F.struct(*same)).alias("most"), F.min(F.struct(*same)).alias("least"),
    )
    clash = F.raise_error(F.lit("two prefixes share a digest; choose another seed"))
    merged = stored(
        merged.withColumn("n", F.when(F.col("most").eqNullSafe(F.col("least")), F.col("n")).otherwise(clash.cast("long"))).drop("most", "least")
        .withColumn("band", F.greatest(F.floor((F.col("depth") - 1) / band), F.lit(0)).cast("long")).withColumn("home", shard_of("owner")),
        "merged",
    )
    # a band's last level is also the next band's entry: there it only collects its children
    twice = (F.col("depth") > 0) & (F.col("depth") % band == 0)
    entry = F.when(twice, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    placed = merged.withColumn("shard", F.explode("shards")).withColumn("ghost", F.explode(entry))
    none = F.lit(0).cast("long")
    body = ["d1", "d2", "depth", "p1", "p2", "chars", "n", "owner", "ends"]
    placed = placed.select(
        *body, "shard", (F.col("band") + F.col("ghost").cast("long")).alias("band"), "ghost",
        (F.col("home") == F.col("shard")).alias("mine"), F.lit(False).alias("carry"), none.alias("leaves"), none.alias("saved"),
    )
    owned = merged.filter("band > 0").groupBy(F.col("owner").alias("conv"), "band").agg(
        F.sum((F.col("ends") == F.col("n")).cast("long")).alias("leaves"), F.sum((F.col("n") - 1) * F.col("chars")).alias("saved")
    )
    onward = Window.partitionBy("conv").orderBy("band").rowsBetween(0, Window.unboundedFollowing)
    entering = carry.join(owned, ["conv", "band"], "left").select(
        F.col("c1").alias("d1"), F.col("c2").alias("d2"), *(none.alias(c) for c in body[2:]), shard_of("conv").alias("shard"),
        (F.col("band") - 1).alias("band"), F.lit(False).alias("ghost"), F.lit(False).alias("mine"), F.lit(True).alias("carry"),
        *(F.sum(F.coalesce(c, none)).over(onward).alias(c) for c in ("leaves", "saved")),
    )
    sums = placed.unionByName(entering.filter("leaves > 0 or saved > 0")).groupBy("shard", "band").applyInPandas(_sum, _SUMS)
    nodes = sums.groupBy("owner", "depth").agg(
        F.max("parent_conv").alias("parent_conv_id"), F.max("n").alias("n_convs"), F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    ended = partial.filter("ends > 0").select("d1", "d2", "depth", "ended").join(merged.select("d1", "d2", "depth", "owner"), ["d1", "d2", "depth"])
    hashes = _end_hashes(ended.select("owner", "depth", F.explode("ended").alias("conv")))
    return nodes.join(hashes, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
