"""Feature tables and models on small tables: leakage, splits, saved bundles, scoring."""

import time
from datetime import date, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from mercata.catalog.feature_queries import churn_all, domain_tables
from mercata.catalog.roles import Roles
from mercata.operators.metrics import regression_metrics
from mercata.plans import features, models
from mercata.session import RELEASE, settled, stored

SF = "/root/testdata/sf0.001"
SMALL = models.Settings(trees=5, depth=4, boosting_rounds=3, boosting_depth=3, max_iter=30)


@pytest.fixture(scope="module")
def delivery(spark):
    return stored(features.delivery_features(domain_tables(Roles(spark, SF))), "test-delivery")


@pytest.fixture(scope="module")
def churn(spark):
    return stored(features.churn_features(churn_all(Roles(spark, SF))), "test-churn")


def test_churn_window_edges(spark):
    last = date(2024, 12, 31)
    snap = last - timedelta(days=60)
    orders = [
        (1, 1, snap, "Delivered"), (2, 2, snap + timedelta(days=1), "Cancelled"), (3, 2, snap - timedelta(days=9), "Delivered Late"),
        (4, 3, last, "Cancelled"), (5, 3, snap - timedelta(days=3), "Cancelled"), (6, 5, last, "Delivered"),
    ]
    o = spark.createDataFrame([(i, c, d, s, 1, "Card", 10.0, 1.0, 20) for i, c, d, s in orders],
                              "OrderID int, CustomerID int, OrderDate date, OrderStatus string, RestaurantID int, PaymentMethod string, FinalAmount double, Discount double, DeliveryTimeMinutes int")
    c = spark.createDataFrame(
        [(i, snap if i != 6 else snap + timedelta(days=1)) for i in (1, 2, 3, 4, 5, 6)] + [(7, None)], "CustomerID int, RegistrationDate date"
    ).selectExpr("CustomerID", "30 as Age", "'F' as Gender", "'X' as City", "RegistrationDate", "'Gold' as Membership", "'Thai' as PreferredCuisine")
    got = {r["CustomerID"]: r for r in features.churn_features_all(o, c).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]  # registered after the snapshot, or never: left out
    assert [got[i]["Churn60d"] for i in (1, 2, 3, 4, 5)] == [1, 0, 0, 1, 0]
    assert [got[i]["EligibleForChurnModel"] for i in (1, 2, 3, 4, 5)] == [1, 1, 1, 0, 0]
    assert (got[1]["RecencyDays"], got[1]["OrdersPer30Days"], got[1]["SpendPerOrder"]) == (0, None, 10.0)
    assert (got[3]["CompletedOrders"], got[3]["HistoricalSpend"], got[3]["CancellationRate"]) == (None, None, 1.0)
    assert got[4]["HistoricalOrders"] is None and got[4]["LateRate"] is None


def test_history_with_hot_keys_equals_plain_windows(spark):
    facts = features.delivered_orders(Roles(spark, SF).orders)
    columns = ["OrderID", "CustomerPriorOrderCount", "CustomerPriorSpend", "RestaurantPriorAvgDelivery", "PartnerPriorOrderCount"]
    plain = sorted(map(tuple, features.with_history(facts).select(*columns).collect()))
    for hot_rows in (25, None):
        sliced = sorted(map(tuple, features.with_history(facts, hot_rows=hot_rows).select(*columns).collect()))
        assert plain == sliced and len(plain) > 500


def test_distance_activates_with_coordinates(spark):
    t = domain_tables(Roles(spark, SF))
    t["orders"] = t["orders"].withColumns({"DeliveryLatitude": F.lit(20.0), "DeliveryLongitude": F.lit(77.0)})
    t["restaurants"] = t["restaurants"].withColumns({"Latitude": F.lit(20.0), "Longitude": F.lit(77.0)})
    got = features.delivery_features(t).agg(F.min("DistanceFeatureAvailable"), F.max("DistanceKm")).first()
    assert tuple(got) == (1, 0.0)


def test_chronological_split(spark, delivery):
    split = models.split_chronological(delivery.select("OrderID", "OrderTimestamp"), "OrderTimestamp", "OrderID")
    rows = {r["split"]: r for r in split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("OrderTimestamp").alias("a"), F.max("OrderTimestamp").alias("b")).collect()}
    n = delivery.count()
    assert rows["train"]["n"] == int(n * 0.8) and rows["train"]["b"] <= rows["test"]["a"]


def test_stratified_split_sizes_and_repeatability(spark):
    df = spark.range(8989).select(F.col("id").alias("CustomerID"), (F.col("id") % 100 < 87).cast("int").alias("y"))
    first = models.split_stratified(df, "y", "CustomerID")
    sizes = {r["split"]: r["count"] for r in first.groupBy("split").count().collect()}
    assert sizes == {"train": 6291, "validation": 1349, "test": 1349}
    shares = {r["split"]: r["m"] for r in first.groupBy("split").agg(F.avg("y").alias("m")).collect()}
    assert max(shares.values()) - min(shares.values()) < 0.001
    again = models.split_stratified(df.repartition(7), "y", "CustomerID")
    assert first.join(again.withColumnRenamed("split", "s2"), "CustomerID").filter("split <> s2").count() == 0


def test_class_shares():
    assert models.class_shares({0: 13, 1: 87}, 15) == {0: 2, 1: 13}
    assert sum(models.class_shares({0: 1, 1: 1, 2: 1}, 2).values()) == 2


def test_preprocessor_buckets_rare_and_unseen(spark):
    rows = [(float(i) if i else None, "a" if i < 20 else ("b" if i < 32 else f"r{i}")) for i in range(36)]
    train = spark.createDataFrame(rows, "x double, c string")
    pre = models.fit_preprocessor(train, ["x"], ["c"], scale=True)
    assert [r["label"] for r in pre.labels.orderBy("slot").collect()] == ["a", "b"] and pre.fill == {"c": "a", "x": 18.0}
    test = spark.createDataFrame([(None, "zzz"), (float("nan"), None)], "x double, c string")
    vectors = [r["features"].toArray().tolist() for r in pre.transform(test).collect()]
    assert vectors[0][0] == vectors[1][0] and vectors[0] != vectors[1] and len(vectors[0]) == 4


def test_preprocessor_with_fifty_thousand_labels(spark):
    n = 50_000
    rows = spark.range(2 * n + 30).select(F.when(F.col("id") < 2 * n, F.concat(F.lit("label "), F.col("id") % n)).otherwise(F.lit("most")).alias("c"))
    pre = models.fit_preprocessor(rows, [], ["c"], scale=False, min_rows=2)
    assert pre.slots == {"c": n + 1} and not pre.rare["c"] and pre.fill["c"] == "most"
    test = spark.createDataFrame([("label 49999",), ("most",), ("unseen",), (None,), ("label 0",)], "c string")
    got = {r["c"]: r["features"] for r in pre.transform(test).collect()}
    assert got["most"].indices.tolist() == got[None].indices.tolist() == [0] and got["most"].size == n + 1
    assert got["unseen"].indices.tolist() == [] and got["label 0"].indices.tolist() == [1]
    order = sorted(f"label {i}" for i in range(n))
    assert got["label 49999"].indices.tolist() == [1 + order.index("label 49999")]


def test_delivery_model(spark, delivery, tmp_path):
    bundle, predictions, report = models.train_delivery(delivery, SMALL)
    assert report["best_model"] == min((m for m in report["models"] if m != "baseline_mean"), key=lambda m: report["models"][m]["mae"])
    assert predictions.count() == report["test_rows"]
    again = regression_metrics(predictions, "DeliveryTimeMinutes", "PredictedDeliveryTimeMinutes").first().asDict()
    assert again == report["best_metrics"]
    assert "Area" not in report["features"] and "DistanceKm" not in report["features"]
    bundle.save(str(tmp_path))
    loaded = models.Bundle.load(str(tmp_path))
    ids = delivery.select("OrderID").union(spark.range(10**9, 10**9 + 2).toDF("OrderID"))
    a = models.score_delivery(bundle, delivery, ids).orderBy("OrderID").collect()
    b = models.score_delivery(loaded, delivery, ids).orderBy("OrderID").collect()
    assert a == b and len(a) == delivery.count()
    assert models.unknown_ids(ids, delivery, "OrderID").count() == 2


def test_churn_model(churn):
    bundle, ranked, report = models.train_churn(churn, SMALL)
    assert 0.1 <= bundle.threshold <= 0.9
    assert sum(report["split"].values()) == churn.count() == report["rows"]
    p = [r["ChurnProbability"] for r in ranked.collect()]
    assert p == sorted(p, reverse=True) and len(p) == report["split"]["test"]
    scores = models.score_churn(bundle, churn, churn.select("CustomerID"))
    row = scores.first()
    assert row["predicted_churn_60d"] in (0, 1) and scores.count() == churn.count()


def test_registered_queries_train_with_the_real_settings(monkeypatch):
    from mercata.catalog import model_queries

    class Trained(Exception):
        pass

    used = []

    def trains(df, settings=models.Settings(), *rest, **named):
        used.append(settings)
        raise Trained

    for name in ("train_delivery", "train_churn"):
        monkeypatch.setattr(models, name, trains)
    for name in ("_delivery", "_churn"):
        monkeypatch.setattr(model_queries, name, lambda t: None)
    for run in (model_queries.train_delivery, model_queries.score_delivery, model_queries.train_churn, model_queries.score_churn):
        with pytest.raises(Trained):
            run(None)
    assert used == [models.Settings()] * 4


def test_candidates_are_fitted_side_by_side(spark):
    from threading import Barrier

    together = Barrier(3, timeout=60)

    class Waits:
        def fit(self, df):
            together.wait()  # raises unless the three fits run at the same time
            return df.count()

    class Plain:
        def transform(self, df):
            return df

    got = models.fit_all(spark.range(7), "y", {n: (Plain(), Waits()) for n in ("b", "a", "c")})
    assert [(n, b.name, b.model, b.target) for n, b in got.items()] == [(n, n, 7, "y") for n in ("b", "a", "c")]


def test_forests_keep_the_node_of_a_row(spark, churn, delivery, monkeypatch):
    class Asked(Exception):
        pass

    asked = []
    for name, train, rows in (("RandomForestRegressor", models.train_delivery, delivery), ("RandomForestClassifier", models.train_churn, churn)):
        real = getattr(models, name)
        rf = real(numTrees=3, maxDepth=6, seed=42, minInstancesPerNode=3, **models.FOREST_RUN)
        asked.append(rf.getCacheNodeIds())
        x = models.fit_preprocessor(rows, ["Age" if "Age" in rows.columns else "FoodCost"], [], False).transform(rows)
        x = x.withColumn("label", F.col("Churn60d" if "Churn60d" in rows.columns else "DeliveryTimeMinutes").cast("double"))
        plain = real(numTrees=3, maxDepth=6, seed=42, minInstancesPerNode=3)
        assert rf.fit(x).toDebugString.split("\n")[1:] == plain.fit(x).toDebugString.split("\n")[1:]

        def spy(_real=real, **settings):
            asked.append(settings.get("cacheNodeIds"))
            raise Asked

        monkeypatch.setattr(models, name, spy)
        with pytest.raises(Asked):
            train(rows, SMALL)
    assert asked == [True] * 4


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_settled_leaves_no_shuffle_files(spark):
    df = spark.range(20_000).withColumn("x", F.col("id") % 7).repartition(4, "x")
    setting, before = spark.conf.get(RELEASE, None), shuffle_files(spark)
    got = settled(df, "test-settled")
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and got.count() == 20_000 and got.dtypes == df.dtypes and spark.conf.get(RELEASE, None) == setting


def test_lines_are_read_before_the_features_are(spark):
    """Lines, readings and weather are met in runs of their own: the table's plan has none of their shuffles left."""
    plan = features.delivery_features(domain_tables(Roles(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "FileScan" in plan


def test_look_ups_of_repeated_rows(spark):
    """Repeated customers and restaurants multiply their orders as a join of whole rows does, each with its own city's weather."""
    t = domain_tables(Roles(spark, SF))
    plain = features.delivery_features(t).cache()
    n, place = plain.count(), plain.filter("RestaurantCity IS NOT NULL").groupBy("RestaurantID").count().orderBy("count").first()
    t["customers"] = t["customers"].unionAll(t["customers"])
    t["restaurants"] = t["restaurants"].unionAll(t["restaurants"].filter(F.col("RestaurantID") == place["RestaurantID"]).withColumn("City", F.lit("Nowhere")))
    got = features.delivery_features(t)
    assert got.count() == 2 * (n + place["count"])
    moved = got.filter("RestaurantCity = 'Nowhere'").agg(F.count(F.lit(1)).alias("n"), F.count("Temperature").alias("t"), F.count("TrafficLevel").alias("l")).first()
    assert tuple(moved) == (2 * place["count"], 0, 0)
    plain.unpersist()


def test_forest_of_groups_is_a_forest(spark, tmp_path):
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(4000).select((F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    ).withColumn("label", F.col("a") * 2 + F.col("b")).repartition(6, "a")
    forest = RandomForestRegressor(numTrees=7, maxDepth=6, seed=42, minInstancesPerNode=3)
    grouped = models.GroupedForest(forest, 4000)
    assert grouped.parts(6) == 1 and models.GroupedForest(forest, 335_000).parts(6) == 2 and models.GroupedForest(forest, 30_000_000).parts(6) == 30
    model = grouped.fit(df)
    texts = [t.toDebugString.split("\n", 1)[1] for t in model.trees]
    assert model.getNumTrees == len(texts) == 7 and len(set(texts)) == 7 and model.numFeatures == 2
    found = [r["prediction"] for r in model.transform(df).orderBy("a", "b").collect()]
    each = [[r["prediction"] for r in t.transform(df).orderBy("a", "b").collect()] for t in model.trees]
    assert all(abs(x - sum(parts) / 7) < 1e-9 for x, parts in zip(found, zip(*each)))
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert [r["prediction"] for r in loaded.transform(df).orderBy("a", "b").collect()] == found
