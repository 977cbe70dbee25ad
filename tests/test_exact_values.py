"""Values at the edges of the number types: large identifiers, large counts, and types that must not depend on size."""

from decimal import Decimal

from pyspark.sql import functions as F

from mercata.functions import coerce_whole
from mercata.operators.metrics import ranking_metrics
from mercata.operators.ordering import Running, by_range, running_by_key
from mercata.plans.cleaning import _deduped, clean_all, numeric, read_all_raw
from mercata.plans.domain import COLUMNS, LOAD_ORDER
from mercata.session import scratch_path
from mercata.sources.tables import ORDER
from mercata.streaming import counters


def test_whole_numbers_are_exact(spark):
    texts = ["9007199254740993", "9223372036854775807", "9223372036854775808", " 007 ", "7.0", "1e3", "2.5", "1.00000000001", "x", "", None, "inf"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", coerce_whole(F.col("t")).alias("n"))
    want = [9007199254740993, 9223372036854775807, None, 7, 7, 1000, None, None, None, None, None, None]
    assert [r["n"] for r in got.orderBy("i").collect()] == want


def test_one_number_written_in_several_ways_is_one_key(spark):
    texts = ["7", "007", "7.0", "9007199254740993", "9007199254740992", "seven", None]
    raw = spark.createDataFrame([(t, "c", i) for i, t in enumerate(texts)], "CustomerID string, Name string, n int")
    raw = raw.withColumn(ORDER, F.struct(F.col("n").alias("at")))
    rows = numeric(_deduped(raw, "customers"), "customers").collect()
    assert sorted((r["n"], r["CustomerID"]) for r in rows) == [
        (0, 7), (3, 9007199254740993), (4, 9007199254740992), (5, None), (6, None)
    ]
    assert {r["n"]: r["_copies"] for r in rows}[0] == 3


def test_running_sum_has_one_type(spark):
    rows = spark.range(40).select((F.col("id") % 2).alias("k"), "id", (F.col("id") / 4).cast("decimal(12,2)").alias("v"))
    measures = {"s": Running("sum", "v")}
    plain = running_by_key(rows, ["k"], [F.col("id").asc()], measures)
    cut = running_by_key(rows, ["k"], [F.col("id").asc()], measures, 5, by_range(F.col("id"), steps=2))
    assert plain.schema["s"].dataType == cut.schema["s"].dataType
    assert sorted(plain.collect()) == sorted(cut.collect())


def test_ranking_of_billions(spark):
    """Four billion rows of each class on two scores, as counts: the product of counts passes 64 bits."""
    per = 4_000_000_000
    wide = "decimal(19,0)"
    out = spark.range(1).select((F.lit(per).cast(wide) * F.lit(3 * per).cast(wide)).cast("decimal(38,0)").alias("x")).first()["x"]
    assert int(out) == 3 * per * per
    some = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.1, 0), (0.1, 1), (0.5, 1)], "s double, y int")
    assert ranking_metrics(some, "y", "s").first()["roc_auc"] == 0.5


def test_stream_reads_files_and_folders(spark):
    base = scratch_path(spark, "stream-layout")
    orders = spark.range(30).select("id", (F.col("id") % 4).alias("CustomerID"))
    orders.repartition(3).write.parquet(f"{base}/orders.parquet")
    stream = counters.customer_counts(counters.read_stream(spark, f"{base}/orders.parquet*", orders.schema, 2))
    counters.start(stream, f"{base}/totals", f"{base}/state").awaitTermination()
    got = counters.current(spark, f"{base}/totals", "CustomerID", stream.schema)
    assert sorted(got.collect()) == sorted(counters.customer_counts(orders).collect())


def test_money_and_quantities_keep_their_digits(spark, tmp_path):
    """Amounts of 10^13, six decimal places, half portions; what no column can hold is counted, and nothing else is."""
    raw = {
        "cities": "1,Mumbai,2.5,West,10000000000000.000001\n2,Delhi,7,North,99999999999999999999",
        "customers": "1,Ann,30,F,,,Mumbai,,,2024-01-01,Gold,2,Thai",
        "restaurants": "1,R,Thai,Mumbai,A,10:00,22:00,4.5,12.345678,O,Cafe,,",
        "delivery_partners": "1,P,abc,M,Bike,2020-01-01,Mumbai,4,10,30",
        "promotions": "1,SAVE,10,Camp,2024-02-09,2024-02-13",
        "menu": "1,1,Rice,Main,0.123456,10,200,yes",
        "orders": "1,1,1,1,2024-05-01,10:30,30,5,1e1,0.5,SAVE,3,1,Delivered,Card\n2,1,1,1,2024-05-02,10:30,30,10000000000000.25,0,0,,0,9,Delivered,Card\n"
        "x,1,1,1,2024-05-02,10:30,30,1,0,0,,0,1,Delivered,Card",
        "order_items": "1,1,1,2.5,10.123457,5\n2,1,1,0.0001,1,1\n3,1,1,1.5,,1\n4,1,1,-0.5,3,1",
        "payments": "", "customer_feedback": "", "weather": "", "traffic": "",
    }
    for name in LOAD_ORDER:
        (tmp_path / f"{name}.csv").write_text(",".join(COLUMNS[name]) + "\n" + raw[name] + "\n")
    cleaned = clean_all(read_all_raw(spark, {n: str(tmp_path / f"{n}.csv") for n in LOAD_ORDER}))
    t = cleaned.tables
    assert [(r["Population"], r["AverageIncome"]) for r in t["cities"].orderBy("CityID").collect()] == [
        (Decimal("2.5"), Decimal("10000000000000.000001")), (7, None)
    ]
    assert t["restaurants"].first()["AverageCost"] == Decimal("12.345678")
    lines = {r["OrderItemID"]: (r["Quantity"], r["UnitPrice"], r["TotalPrice"]) for r in t["order_items"].collect()}
    assert lines == {
        1: (Decimal("2.5"), Decimal("10.123457"), Decimal("25.31")), 2: (Decimal("0.0001"), 1, 0),
        3: (Decimal("1.5"), Decimal("0.123456"), Decimal("0.19")),
    }
    orders = {r["OrderID"]: (r["FoodCost"], r["FinalAmount"]) for r in t["orders"].collect() if r["OrderID"]}
    assert orders == {1: (Decimal("25.50"), Decimal("38.00")), 2: (Decimal("10000000000000.25"), Decimal("10000000000000.25"))}
    counts = {(r["table"], r["column"]): r["value"] for r in cleaned.unread_numbers().collect()}
    assert counts == {("cities", "AverageIncome"): 1, ("delivery_partners", "Age"): 1, ("orders", "OrderID"): 1}
