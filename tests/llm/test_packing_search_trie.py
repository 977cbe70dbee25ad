"""Cost-balanced packing, ranked lexical search and the conversation trie against brute force and edge cases."""

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mercata.llm import balanced_packing, lexical_search, prefix_trie
from mercata.llm.common import ship

SF = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, row string, item int, rank int, start long, ids string, score long"
ROWS = [
    (1, "Tie one"), (2, "tie ONE"), (2, "tie ONE"), (3, None), (4, ""), (None, "tie one"), (5, " \n\t.,;"), (6, "é日本 x9y tie_one one"),
    (7, "long word " * 30_000), (8, "<|endoftext|> don't WE'RE a b \x1c"), (None, None), (9, "rare " + "filler " * 50),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame([(*r, "r", 1, 2, 3, "i", 4) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


# cost-balanced packing ----------------------------------------------------------------------------


def plain_balance(lengths, capacity, width):
    """The same rule by looking at every sequence for every piece."""
    rooms = balanced_packing.room_for(sum(lengths), capacity)
    left, cost = list(rooms), [0] * len(rooms)
    waiting = sorted(((n, -i, 0) for i, n in enumerate(lengths)), reverse=True)
    costs = []
    while waiting:
        n, i, start = waiting.pop(0)
        fits = [s for s in range(len(rooms)) if left[s] >= n]
        size, among = (n, fits) if fits else (max(left), [s for s in range(len(rooms)) if left[s] == max(left)])
        best = min(among, key=lambda s: (cost[s], left[s]))
        cost[best] += balanced_packing.piece_cost(size, width)
        left[best] -= size
        if size < n:
            waiting.append((n - size, i, start + size))
            waiting.sort(reverse=True)
    return sorted(cost)


@pytest.mark.parametrize("seed", range(4))
def test_balance_takes_the_cheapest_sequence_with_room(seed):
    draw = np.random.default_rng(seed)
    capacity, width = 64, 8
    lengths = [int(x) for x in np.clip(draw.lognormal(2.5, 1, 300), 1, capacity)]
    placed = balanced_packing.balance(lengths, capacity, width)
    costs, filled = Counter(), defaultdict(list)
    for piece, start, size, sequence, offset in placed:
        costs[sequence] += balanced_packing.piece_cost(size, width)
        filled[sequence].append((offset, size))
    assert sorted(costs.values()) == pytest.approx(plain_balance(lengths, capacity, width), rel=0.02)
    for parts in filled.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == capacity or at & (at - 1) == 0


def test_room_for():
    for total in range(0, 300):
        rooms = balanced_packing.room_for(total, 64)
        assert sum(rooms) == total and all(r == 64 or r & (r - 1) == 0 for r in rooms)


def check_packed(rows, texts, capacity):
    """Every id of every document once, sequences gapless and without padding."""
    own = Tokenizer.from_file(WORD)
    expected = Counter()
    ids_of = {}
    for doc_id, text in texts:
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        ids_of.setdefault(doc_id, []).append(ids)
        expected[(doc_id, len(ids))] += len(ids)
    got, sequences = Counter(), defaultdict(list)
    for r in rows:
        assert r["length"] >= 1
        parts = {zlib.crc32(array("I", ids[r["start"] : r["start"] + r["length"]]).tobytes()) for ids in ids_of[r["doc_id"]] if len(ids) == r["doc_tokens"]}
        assert r["ids_crc32"] in parts
        got[(r["doc_id"], r["doc_tokens"])] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == expected
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)


@pytest.mark.parametrize("pieces", [50_000, 20])
def test_pack_balanced(corpus, docs, empty, pieces):
    texts = [tuple(r) for r in corpus.select("doc_id", "text").collect()]
    check_packed(balanced_packing.pack_balanced(corpus, WORD, 1, group_pieces=pieces).collect(), texts, 2048)
    check_packed(balanced_packing.pack_balanced(docs, WORD, 1, capacity=64, group_pieces=pieces).collect(), ROWS, 64)
    assert balanced_packing.pack_balanced(empty, WORD, 1).count() == 0
    assert balanced_packing.pack_balanced(docs.filter("text = ''"), WORD, None).count() == 0


def test_pack_balanced_covers_every_position_once(corpus):
    packed = balanced_packing.pack_balanced(corpus, WORD, 1)
    ends = defaultdict(list)
    for r in packed.collect():
        ends[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    for parts in ends.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at
            at += length
        assert at == total
    costs = [r["cost"] for r in balanced_packing.sequence_costs(packed).filter("length = 2048").collect()]
    assert max(costs) <= balanced_packing.piece_cost(2048)


# ranked lexical search ----------------------------------------------------------------------------


def plain_search(texts, items, top):
    fold = lambda text: re.findall(lexical_search.TERM, re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))
    bags = [(doc_id, Counter(fold(text))) for doc_id, text in texts]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = Counter()
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            m = 10 + (90 * bag.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in set(fold(text)) if t in bag
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            out[(item_id, rank, doc_id, -score)] += 1
    return out


def searched(index, items, **how):
    return Counter(tuple(r) for r in lexical_search.search(index, items, **how).select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("shard_docs, block_bytes", [(4096, 8 << 20), (7, 300)])
def test_search_against_every_document(spark, corpus, shard_docs, block_bytes):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [tuple(r) for r in corpus.select("doc_id", "text").collect()]
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    index = lexical_search.build(corpus, shard_docs=shard_docs)
    for top in (1, 10):
        assert searched(index, items, top=top, block_bytes=block_bytes) == plain_search(texts, asked, top)


def test_search_edges(spark, docs, empty):
    items = [(1, "tie one"), (1, "tie one"), (2, None), (3, ""), (4, "unknown"), (None, "x9Y 日本"), (5, "tie tie tie rare filler 日本 long")]
    table = spark.createDataFrame([(*i, 7, "t") for i in items], "item_id long, text string, doc_id int, terms string")
    index = lexical_search.build(docs, shard_docs=2)
    assert searched(index, table, top=3) == plain_search(ROWS, items, 3)
    assert searched(lexical_search.build(empty), table) == Counter()
    assert searched(index, table.limit(0)) == Counter()


def test_ties_in_many_copies(spark):
    ship(spark)
    texts = [(i, "copy of one text") for i in range(3000, 0, -1)] + [(9000 + i, f"other {i} text") for i in range(500)]
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    items = [(0, "copy text"), (1, "other text")]
    index = lexical_search.build(table, shard_docs=100)
    assert searched(index, spark.createDataFrame(items, "item_id long, text string")) == plain_search(texts, items, 10)


def test_treap_keeps_cells():
    draw = np.random.default_rng(3)
    cells = {(int(r), int(c)): int(v) for r, c, v in zip(draw.integers(0, 50, 400), draw.integers(0, 20, 400), draw.integers(1, 10**6, 400))}
    rows, cols = (np.array(x) for x in zip(*cells))
    grid = lexical_search.Treap(lexical_search.treap(rows, cols, np.array(list(cells.values())), 6), 6)
    assert grid.peaks[0] == max(cells.values())
    for row in range(50):
        expected = sorted(((v, c) for (r, c), v in cells.items() if r == row), key=lambda x: (-x[0], x[1]))
        assert grid.best(np.array([row]), np.array([1]), 100, 0, 0) == expected


# conversation trie --------------------------------------------------------------------------------


def plain_trie(turns):
    """Nodes from {conv: [(role, text), ...]}."""
    members = defaultdict(list)
    for conv, path in sorted(turns.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        ends = ",".join(str(c) for c in convs if len(turns[c]) == len(node))
        out.add((
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children), len(leaves),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def plain_rebuild(rows, most=5):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(path)] for c, path in own.items()}
    out = {}
    for conv, path in own.items():
        heads = zlib.crc32(str(conv).encode()) % 6
        out[conv] = own.get(conv - conv % 100, [])[:heads] + path[heads:]
    return out


def heads():
    return F.crc32(F.col("conv").cast("string")) % 6


def leader():
    return F.col("conv") - F.col("conv") % 100


@pytest.mark.parametrize("band, shard_turns, block", [(2048, 200_000, 100), (3, 40, 100), (1, 15, 2), (2, 10, 1)])
def test_trie_against_plain_sets(spark, band, shard_turns, block):
    ship(spark)
    draw = np.random.default_rng(band)
    rows = []
    for conv in [*range(100, 130), *range(205, 225), 300, 401, 9999]:
        shape = int(draw.integers(0, 4))
        for turn in range(int(draw.integers(1, 14))):
            rows.append((conv, turn, "user" if turn % 2 else "assistant", f"é{turn}" if shape < 2 else f"{shape} {turn} {int(draw.integers(0, 2))}"))
    rows += [(500 + i, t, "user", f"same {t}") for i in range(60) for t in range(6)]  # a large group of copies
    rows += [(777, t, "user", f"deep {t % 3}") for t in range(60)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    turns = prefix_trie.shared_turns(table, heads(), leader(), 5)
    got = [tuple(r) for r in prefix_trie.trie(turns, block=block, band=band, shard_turns=shard_turns).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(plain_rebuild(rows))


def test_trie_edges(spark):
    ship(spark)
    rows = [
        (0, 1, "user", "a"), (0, None, None, None), (0, 3, "user", ""), (None, 1, "user", "lost"), (1, 5, None, "a"), (1, 2, "user", None),
        (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "a"), (150, 7, "user", "x" * 300_000), (151, 1, "user", "𝔘 two code points"),
        (200, 1, "user", "only"), (201, 1, "user", "only"), (202, 1, "user", "only"),
    ]
    schema = "conv_id long, turn long, role string, text string, conv int, depth int, key string, place int, shard int"
    table = spark.createDataFrame([(*r, 1, 2, "k", 3, 4) for r in rows], schema).repartition(4)
    turns = prefix_trie.shared_turns(table, heads(), leader(), 5)
    got = {tuple(r) for r in prefix_trie.trie(turns).collect()}
    assert got == plain_trie(plain_rebuild(rows))
    nothing = prefix_trie.shared_turns(table.limit(0), heads(), leader(), 5)
    assert prefix_trie.trie(nothing).count() == 0


def test_equal_turns_of_one_conversation_are_ordered_alike(spark):
    ship(spark)
    rows = [(c, 1, "user", f"t{i}") for c in (7, 8) for i in range(9)]
    ends = []
    for parts in (1, 5):
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
        turns = prefix_trie.shared_turns(table, F.lit(0), F.col("conv"), 0)
        ends.append({tuple(r) for r in prefix_trie.trie(turns).collect()})
    assert ends[0] == ends[1] and len(ends[0]) == 10


def test_perfect_hash_is_minimal_and_refuses_strangers():
    draw = np.random.default_rng(5)
    low, high = draw.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    table = prefix_trie.NodeTable(low, high)
    assert sorted(table.slots(low, high).tolist()) == list(range(5000))
    assert (table.slots(low, high ^ np.uint64(1)) == -1).all()
    few = prefix_trie.PerfectHash(np.array([1], np.uint64))
    assert few.size == 1 and few.slots(np.array([1], np.uint64)).tolist() == [0]


def test_a_shared_digest_is_noticed():
    table = prefix_trie.NodeTable(np.array([1, 2], np.uint64), np.array([3, 4], np.uint64))
    with pytest.raises(ValueError):
        table.keep(np.array([0, 0, 1]), np.array([5, 6, 7]))


def test_end_hashes_of_a_hot_node(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 64)
    ends = spark.range(5000).select(F.lit(1).cast("long").alias("owner"), (F.col("id") % 2).alias("depth"), F.col("id").alias("conv")).repartition(7)
    got = {r["depth"]: r["ends_sha256"] for r in prefix_trie._end_hashes(ends).collect()}
    assert got == {d: hashlib.sha256(",".join(str(i) for i in range(d, 5000, 2)).encode()).hexdigest() for d in (0, 1)}
