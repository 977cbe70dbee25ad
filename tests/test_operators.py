"""Order, history, as-of and pair operators against brute force, with hot keys forced."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercata.operators.asof import asof_nearest
from mercata.operators.dedupe import duplicate_rows, keep_first
from mercata.operators.integrity import Parent, children, flag_orphans, orphans, unknown_code_to_null
from mercata.operators.joins import broadcast_if_small, lookup
from mercata.operators.metrics import best_threshold, classification_metrics, ranking_metrics, threshold_grid, threshold_table
from mercata.operators.ordering import Running, by_range, exact_median, global_position, nth_smallest, ntile, rank_within, running_by_key, running_totals
from mercata.operators.pairs import first_distant_pairs


@pytest.fixture(scope="module")
def facts():
    rng = random.Random(7)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else (None if i % 41 == 0 else f"k{rng.randint(0, 30)}")
        value = None if rng.random() < 0.1 else float(rng.randint(0, 50))
        rows.append((i, key, rng.randint(0, 60), value))
    return rows


def brute_history(rows):
    out = {}
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r[2], r[0]))
        for i, (id_, *_rest) in enumerate(members):
            seen = [m[3] for m in members[:i] if m[3] is not None]
            out[id_] = (
                i, sum(seen) if seen else 0, sum(seen) / len(seen) if seen else None, max(seen, default=None), min(seen, default=None),
                members[i - 1][3] if i else None, members[i + 1][3] if i + 1 < len(members) else None,
            )
    return out


@pytest.mark.parametrize("hot_rows", [10_000, 40, 5, None])
def test_running_by_key_matches_brute_force(spark, facts, hot_rows):
    df = spark.createDataFrame(facts, "id long, k string, t int, v double").repartition(5)
    kinds = {
        "n": Running("count"), "s": Running("sum", "v"), "m": Running("mean", "v"), "hi": Running("max", "v"),
        "lo": Running("min", "v"), "p": Running("previous", "v"), "q": Running("next", "v"),
    }
    got = running_by_key(df, ["k"], [F.col("t").asc(), F.col("id").asc()], kinds, hot_rows, by_range(F.col("t"), steps=4)).collect()
    assert len(got) == len(facts)
    assert {r["id"]: tuple(r[c] for c in kinds) for r in got} == brute_history(facts)


@pytest.mark.parametrize("hot_rows", [10_000, 30, None])
def test_rank_within_matches_pandas(spark, facts, hot_rows):
    rows = [(i, k or "none", v or 0.0) for i, k, _, v in facts]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = {r["id"]: (r["row_num"], r["rank_num"], r["dense_rank_num"]) for r in rank_within(df, ["k"], "v", "id", hot_rows).collect()}
    p = pd.DataFrame(rows, columns=["id", "k", "v"])
    p["rank"] = p.groupby("k").v.rank(method="min", ascending=False).astype(int)
    p["dense"] = p.groupby("k").v.rank(method="dense", ascending=False).astype(int)
    p = p.sort_values(["k", "v", "id"], ascending=[True, False, True])
    p["row"] = p.groupby("k").cumcount() + 1
    assert got == {int(r.id): (r.row, r.rank, r.dense) for r in p.itertuples()}


@pytest.mark.parametrize("steps", [1, 1024])
def test_global_order(spark, facts, steps):
    df = spark.createDataFrame([(i, t) for i, _, t, _ in facts], "id long, t int")
    order = [F.col("t").desc(), F.col("id").asc()]
    want = [i for i, *_ in sorted(((i, t) for i, _, t, _ in facts), key=lambda r: (-r[1], r[0]))]
    placed = {r["position"]: r["id"] for r in global_position(df, order, by_range(F.col("t"), "desc", steps)).collect()}
    assert [placed[i + 1] for i in range(len(want))] == want
    totals = running_totals(df, order, {"before": F.col("t")}, by_range(F.col("t"), "desc", steps)).collect()
    running, expected, by_id = 0, {}, {i: t for i, _, t, _ in facts}
    for i in want:
        expected[i] = running
        running += by_id[i]
    assert {r["id"]: r["before"] for r in totals} == expected
    for k in (7, 10, 601):
        tiles = {r["id"]: r["tile"] for r in ntile(df, k, order, by_range(F.col("t"), "desc", steps)).collect()}
        size, extra = divmod(len(want), k)
        flat = [b + 1 for b in range(k) for _ in range(size + (b < extra))]
        assert [tiles[i] for i in want] == flat


def test_rank_within_with_missing_values(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 2 else "k", None if i % 3 == 0 else float(rng.randint(-40, 40))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, v double").repartition(4)
    df.createOrReplaceTempView("ranked_rows")
    want = spark.sql("""SELECT id, row_number() OVER (PARTITION BY k ORDER BY v DESC NULLS FIRST, id) AS row_num,
        rank() OVER (PARTITION BY k ORDER BY v DESC NULLS FIRST) AS rank_num, dense_rank() OVER (PARTITION BY k ORDER BY v DESC NULLS FIRST) AS dense_rank_num
        FROM ranked_rows""").collect()
    for hot_rows in (10, None, 10_000):
        got = rank_within(df, ["k"], "v", "id", hot_rows).select("id", "row_num", "rank_num", "dense_rank_num").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("n", [1, 2, 5, 6, 401])
def test_exact_median_and_positions(spark, n):
    rng = random.Random(n)
    rows = [("a" if i % 2 else None, None if i % 7 == 3 else rng.choice([-2.5, 0.0, 1e-9, 3.0, 3.0, 1e12, rng.random()])) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    values = sorted(v for _, v in rows if v is not None)
    got = exact_median(df, "v").collect()
    assert [r["median"] for r in got] == [pytest.approx(pd.Series(values).median(), rel=1e-15)]
    for k in ("a", None):
        own = [v for x, v in rows if x == k and v is not None]
        mine = [r["median"] for r in exact_median(df, "v", ["k"]).collect() if r["k"] == k]
        assert mine == ([pytest.approx(pd.Series(own).median(), rel=1e-15)] if own else [])
    at = nth_smallest(df, "v", F.sequence(F.lit(0), F.col("n") - 1)).collect()
    assert [r["v"] for r in sorted(at, key=lambda r: r["position"])] == values


def test_ranges_keep_the_order(spark):
    values = sorted({0.0, 1.0, -1.0, 1e-300, -1e-300, 5e-324, 1e308, -1e308, 2.0**53, 0.5, 3.0, 3.0000001, -3.0000001, 7.0, 1e6, 1e6 + 1})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cells = [r["c"] for r in df.select("v", by_range(F.col("v"))[0][0].alias("c")).orderBy("v").collect()]
    assert cells == sorted(cells) and len(set(cells)) > 10


def brute_asof(left, right, tolerance, direction):
    out = {}
    for lid, by, at in left:
        best = None
        for rid, rby, rat, value in right:
            if by is None or rby != by:
                continue
            gap = abs((rat - at).total_seconds())
            later = rat > at
            if gap > tolerance or (direction == "backward" and later) or (direction == "forward" and rat < at):
                continue
            rank = (gap, later, rid if later or (direction == "forward" and rat != at) else -rid)
            if direction == "forward":
                rank = (gap, rid)
            if best is None or rank < best[0]:
                best = (rank, value, gap / 60)
        out[lid] = best[1:] if best else (None, None)
    return out


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("slice_seconds, hot_rows", [(None, 10**6), (60, 10**6), (10**9, 10**6), (None, 10), (10**6, 100)])
def test_asof_matches_brute_force(spark, direction, slice_seconds, hot_rows):
    rng = random.Random(11)
    base = datetime(2024, 1, 1)

    def instant():
        return base + timedelta(minutes=rng.choice([rng.randint(0, 3000), rng.randint(0, 300)]))

    left = [(i, rng.choice(["a", "a", "b", "c", None]), instant()) for i in range(300)]
    right = [(i, rng.choice(["a", "a", "a", "b"]), instant(), f"v{i}") for i in range(200)]
    l = spark.createDataFrame(left, "lid long, city string, at timestamp_ntz")
    r = spark.createDataFrame(right, "rid long, city string, seen timestamp_ntz, value string")
    got = asof_nearest(l, r, "city", "at", "seen", ["value"], "rid", 90 * 60, direction, slice_seconds, hot_rows=hot_rows).collect()
    assert len(got) == len(left)
    assert {x["lid"]: (x["value"], x["TimeDeltaMinutes"]) for x in got} == brute_asof(left, right, 5400, direction)


def test_asof_boundary_and_empty_side(spark):
    t0 = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, "a", t0), (2, "a", None)], "lid long, city string, at timestamp_ntz")
    right = [(1, "a", t0 + timedelta(minutes=90), "edge")]
    schema = "rid long, city string, seen timestamp_ntz, value string"
    r = spark.createDataFrame(right, schema)
    hit = asof_nearest(left, r, "city", "at", "seen", ["value"], "rid", 5400).orderBy("lid").collect()
    assert [(x["value"], x["TimeDeltaMinutes"]) for x in hit] == [("edge", 90.0), (None, None)]
    r = spark.createDataFrame([(1, "a", t0 + timedelta(minutes=91), "far")], schema)
    assert [x["value"] for x in asof_nearest(left, r, "city", "at", "seen", ["value"], "rid", 5400).collect()] == [None, None]
    assert asof_nearest(left, r.limit(0), "city", "at", "seen", ["value"], "rid", 5400).count() == 2


@pytest.mark.parametrize("hot_rows", [10_000, 20])
def test_distant_pairs(spark, hot_rows):
    rng = random.Random(3)
    rows = [(i, rng.choice(["x", "x", "y", "z"]), float(rng.randint(0, 60))) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, city string, v double")
    want = sorted(
        (a[0], b[0], a[1], a[2], b[2]) for a in rows for b in rows if a[1] == b[1] and a[0] < b[0] and abs(a[2] - b[2]) > 20
    )[:50]
    got = first_distant_pairs(df, "city", "id", "v", 20, 50, hot_rows).collect()
    assert [tuple(r) for r in got] == want


def test_dedupe_and_keys(spark):
    df = spark.createDataFrame([("1", "a", 1), ("1", "b", 0), (None, "c", 2), (None, "d", 3), ("2", "e", 4)], "k string, v string, o int")
    assert {(r["k"], r["v"]) for r in keep_first(df, ["k"], ["o"]).collect()} == {("1", "b"), (None, "c"), ("2", "e")}
    assert duplicate_rows(df, ["k"]).first()[0] == 2


def test_references(spark):
    child = spark.createDataFrame([(1, 10, "A"), (2, None, "B"), (3, 99, None)], "id int, p int, code string")
    parent = spark.createDataFrame([(10,), (10,), (None,)], "p int")
    assert [r["id"] for r in children(child, "p", parent, "p").collect()] == [1]
    assert sorted(r["id"] for r in orphans(child, "p", parent, "p").collect()) == [2, 3]
    flagged = flag_orphans(child, [Parent("p", parent, "p", "miss")]).orderBy("id").collect()
    assert [r["miss"] for r in flagged] == [False, True, True]
    codes = spark.createDataFrame([("A",)], "code string")
    done = unknown_code_to_null(child, "code", codes, "code", "emptied").orderBy("id").collect()
    assert [(r["code"], r["emptied"]) for r in done] == [("A", False), (None, True), (None, False)]


def test_metrics_match_direct_computation(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < 0.6), round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int, p double")
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, hits, seen = 0.0, 0, 0
    for s in sorted({p for _, _, p in rows}, reverse=True):
        fresh = sum(1 for p in pos if p == s)
        hits += fresh
        seen += sum(1 for _, _, p in rows if p == s)
        ap += fresh / len(pos) * hits / seen
    got = ranking_metrics(df, "y", "p").first()
    assert got["roc_auc"] == pytest.approx(round(auc, 4), abs=1e-4) and got["pr_auc"] == pytest.approx(round(ap, 4), abs=1e-4)

    table = {round(r["threshold"], 6): (r["tp"], r["fp"], r["fn"]) for r in threshold_table(df, "y", "p").collect()}
    assert len(table) == 81
    f1 = {}
    for t in threshold_grid():
        want = sum(y and p >= t for _, y, p in rows), sum((not y) and p >= t for _, y, p in rows), sum(y and p < t for _, y, p in rows)
        assert table[round(t, 6)] == want
        f1[t] = 2 * want[0] / (2 * want[0] + want[1] + want[2])
    best = best_threshold(threshold_table(df, "y", "p")).first()
    assert best["threshold"] == max(sorted(f1), key=lambda t: f1[t])
    m = classification_metrics(df, "y", "p", 0.5).first()
    assert m["tp"] + m["fn"] == len(pos) and m["accuracy"] == round(sum((p >= 0.5) == bool(y) for _, y, p in rows) / 400, 4)


def test_ranking_metrics_need_both_classes(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, p double")
    got = ranking_metrics(df, "y", "p").first()
    assert got["roc_auc"] is None and got["pr_auc"] is None


def test_lookup_spreads_rows_without_a_key(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "a", i) for i in range(300)], "id int, k string, j int")
    side = spark.createDataFrame([("a", 0, "x"), (None, 1, "y")], "k string, j int, v string")
    got = lookup(df, side.select("k", "v"), "k")
    assert got.columns == ["k", "id", "j", "v"] and got.count() == 300
    assert got.filter("v = 'x'").count() == 100 and got.filter("v is not null and k is null").count() == 0
    both = lookup(df, side, ["k", "j"])
    assert [r["id"] for r in both.filter("v is not null").collect()] == [0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup(df, side.select("k", "v"), "k")._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and got.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_only_within_the_limit(spark):
    df = spark.range(10)
    assert "broadcast" in broadcast_if_small(df, 10, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(df, 11, 10)._jdf.queryExecution().logical().toString()
