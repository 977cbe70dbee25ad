from pyspark.sql import functions as F

from mercata.streaming import counters


def test_totals_follow_new_files_and_survive_replay(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "OrderID long, CustomerID long, RestaurantID long, FinalAmount double, DeliveryTimeMinutes int"

    def add(ids):
        rows = [(i, i % 3, i % 2, 1.5 * i, i) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    add(range(10))
    shape = spark.read.parquet(source).schema
    restaurants = spark.createDataFrame([(0, "A"), (1, "B")], "RestaurantID long, City string")

    def run():
        stream = counters.read_stream(spark, source, shape, files_per_trigger=1)
        totals = counters.customer_counts(stream)
        counters.start(totals, f"{sink}/c", f"{state}/c").awaitTermination()
        cities = counters.city_sums(stream, restaurants)
        counters.start(cities, f"{sink}/k", f"{state}/k").awaitTermination()
        return totals.schema, cities.schema

    run()
    add(range(10, 25))
    add(range(25, 31))
    one, two = run()

    def equal(a, b):
        return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

    batch = spark.read.parquet(source)
    assert equal(counters.current(spark, f"{sink}/c", "CustomerID", one), counters.customer_counts(batch))
    assert equal(counters.current(spark, f"{sink}/k", "City", two), counters.city_sums(batch, restaurants))

    # A replayed batch writes the same absolute totals under the same number.
    last = spark.read.parquet(f"{sink}/c").agg(F.max("batch")).first()[0]
    again = spark.createDataFrame(spark.read.schema(one).parquet(f"{sink}/c/batch={last}").collect(), one)
    counters._sink(f"{sink}/c")(again, last)
    assert equal(counters.current(spark, f"{sink}/c", "CustomerID", one), counters.customer_counts(batch))
    counters.compact(spark, f"{sink}/c", "CustomerID", one, f"{sink}/c2")
    assert equal(counters.current(spark, f"{sink}/c2", "CustomerID", one), counters.customer_counts(batch))


def test_versions_over_many_batches(spark, tmp_path):
    """Readers take the newest whole version and the batches after it; a replay changes nothing."""
    path, schema = str(tmp_path / "totals"), spark.createDataFrame([], "k long, n long").schema
    write, want = counters._sink(path, "k", every=20), {}
    for i in range(90):
        want |= {i % 7: i, 100 + i % 2: 10 * i}
        write(spark.createDataFrame([(i % 7, i), (100 + i % 2, 10 * i)], schema).coalesce(1), i)

    def totals():
        return {r["k"]: r["n"] for r in counters.current(spark, path, "k", schema).collect()}

    assert counters.folded(spark, path) == 79 and totals() == want
    write(spark.createDataFrame([(89 % 7, 89), (101, 890)], schema), 89)
    counters.fold(spark, path, "k", schema, 79)
    assert counters.folded(spark, path) == 79 and totals() == want
    # What a version holds is no longer read from its batches, and a version without pointer is not read at all.
    spark.createDataFrame([(5, -1)], schema).write.mode("overwrite").parquet(f"{path}/batch=40")
    spark.createDataFrame([(5, -1)], schema).write.parquet(f"{path}_versions/upto=85")
    assert totals() == want
    counters.fold(spark, path, "k", schema, 89)
    assert counters.folded(spark, path) == 89 and totals() == want


def test_a_stream_writes_versions(spark, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(60).select("id", (F.col("id") % 4).alias("CustomerID")).repartition(6).write.parquet(source)
    stream = counters.customer_counts(counters.read_stream(spark, source, spark.read.parquet(source).schema, 1))
    counters.start(stream, path, state, "CustomerID", every=2).awaitTermination()
    assert counters.folded(spark, path) == 5
    got = counters.current(spark, path, "CustomerID", stream.schema)
    assert sorted(map(tuple, got.collect())) == [(c, 15) for c in range(4)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
