"""Model preparation, training, evaluation and batch scoring (J).

Evaluation runs on predictions that are plain arithmetic on the given tables, so that SQL can
check them. Training runs on the real feature tables with the real settings.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions import is_completed
from ..operators.metrics import best_threshold, classification_metrics, regression_metrics, threshold_grid, threshold_table
from ..plans import features, models
from ..session import stored
from .feature_queries import churn_all, domain_tables
from .registry import DONE, query, ratio
from .relational_queries import FACTS_SQL
from .roles import Roles


@query(
    "feature_select",
    """SELECT name FROM (SELECT unnest(['CouponCode', 'DeliveryTimeMinutes', 'OrderTime']) AS name,
              unnest([count(CouponCode), count(DeliveryTimeMinutes), count(OrderTime)]) AS n FROM m_orders) WHERE n > 0""",
)
def feature_select(t: Roles) -> DataFrame:
    df = t.orders.withColumn("Area", F.lit(None).cast("string"))
    numeric, categorical = models.present_columns(df, ["DeliveryTimeMinutes", "OrderTime", "Humidity"], ["CouponCode", "Area"])
    return t.spark.createDataFrame([(n,) for n in numeric + categorical], "name string")


@query("sanitize", "SELECT OrderID, TRY_CAST(trim(NumberText) AS DOUBLE) AS NumberText, LabelText FROM m_dirty")
def sanitize(t: Roles) -> DataFrame:
    return models.sanitize(t.dirty, ["NumberText"], ["LabelText"]).select("OrderID", "NumberText", "LabelText")


_LABELS = """{c}_n AS (SELECT {c} AS label, count(*) AS n FROM m_orders WHERE {c} IS NOT NULL GROUP BY {c}),
        {c}_f AS (SELECT count(*) FILTER (n >= 10) AS kept, count(*) FILTER (n < 10) > 0 AS rare, arg_min(label, (-n, label)) AS top FROM {c}_n),
        {c}_s AS (SELECT label, row_number() OVER (ORDER BY n DESC, label) - 1 AS slot FROM {c}_n WHERE n >= 10)"""
_NUMBERS = ("DeliveryTimeMinutes", "FoodCost", "OrderTime")
_FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM m_orders)) AS {c}" for c in _NUMBERS)
_SCALED = ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_num" for c in _NUMBERS)
_SLOT = "coalesce({c}_s.slot, {c}_f.kept) AS {c}_slot"
_LABEL_JOIN = "CROSS JOIN {c}_f LEFT JOIN {c}_s ON {c}_s.label = coalesce(f.{c}, {c}_f.top)"
_CATEGORIES = ("PaymentMethod", "CouponCode")


@query(
    "preprocess",
    f"""WITH {', '.join(_LABELS.format(c=c) for c in _CATEGORIES)}, f AS (SELECT OrderID, PaymentMethod, CouponCode, {_FILLED} FROM m_orders)
        SELECT OrderID, {_SCALED}, {', '.join(_SLOT.format(c=c) for c in _CATEGORIES)},
               {' + '.join(f"{c}_f.kept + {c}_f.rare::INTEGER" for c in _CATEGORIES)} + {len(_NUMBERS)} AS width
        FROM f {' '.join(_LABEL_JOIN.format(c=c) for c in _CATEGORIES)}""",
)
def preprocess(t: Roles) -> DataFrame:
    df = stored(t.orders.select("OrderID", "DeliveryTimeMinutes", "FoodCost", "OrderTime", "PaymentMethod", "CouponCode"), "prep")
    pre = models.fit_preprocessor(df, _NUMBERS, _CATEGORIES, True)
    width = F.size(vector_to_array("features")).cast("long")
    slots = [F.col(f"{c}_slot").cast("long").alias(f"{c}_slot") for c in _CATEGORIES]
    return pre.transform(df).select("OrderID", *[F.round(f"{c}_num", 6).alias(f"{c}_num") for c in _NUMBERS], *slots, width.alias("width"))


@query(
    "split_chronological",
    f"""WITH f AS ({FACTS_SQL}), n AS (SELECT *, row_number() OVER (ORDER BY ts, OrderID) AS i, count(*) OVER () AS n FROM f)
        SELECT OrderID, CASE WHEN i <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM n""",
)
def split_chronological(t: Roles) -> DataFrame:
    facts = features.delivered_orders(t.orders).select("OrderID", "OrderTimestamp")
    return models.split_chronological(facts, "OrderTimestamp", "OrderID").select("OrderID", "split")


_SEATS = """{s} AS (SELECT label, CAST(floor(n * total / all_) AS BIGINT) + CAST(row_number() OVER (ORDER BY floor(n * total / all_) - n * total / all_, label)
              <= total - sum(floor(n * total / all_)) OVER () AS INTEGER) AS seats
              FROM (SELECT label, n::DOUBLE AS n, sum(n) OVER () AS all_, ceil(sum(n) OVER () * {share}) AS total FROM {source}))"""


@query(
    "split_stratified",
    f"""WITH o AS (SELECT OrderID, CAST(OrderStatus IN ('Delivered', 'Delivered Late') AS BIGINT) AS label FROM m_order_heads),
        c AS (SELECT label, count(*) AS n FROM o GROUP BY label), {_SEATS.format(s='tests', share='0.15::DOUBLE', source='c')},
        rest AS (SELECT c.label, n - seats AS n FROM c JOIN tests ON tests.label IS NOT DISTINCT FROM c.label),
        {_SEATS.format(s='checks', share='(0.15::DOUBLE / (1 - 0.15::DOUBLE))', source='rest')},
        p AS (SELECT OrderID, label, row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || OrderID), 1, 15), OrderID) AS i FROM o)
        SELECT OrderID, p.label, CASE WHEN i <= tests.seats THEN 'test' WHEN i <= tests.seats + checks.seats THEN 'validation' ELSE 'train' END AS split
        FROM p JOIN tests ON tests.label IS NOT DISTINCT FROM p.label JOIN checks ON checks.label IS NOT DISTINCT FROM p.label""",
)
def split_stratified(t: Roles) -> DataFrame:
    labelled = t.order_heads.select("OrderID", is_completed(F.col("OrderStatus")).cast("int").alias("label"))
    return models.split_stratified(labelled, "label", "OrderID")


_REG = "SELECT CAST(DeliveryTimeRaw AS DOUBLE) AS y, CAST(DeliveryFee AS DOUBLE) * 25.5 AS p FROM m_orders WHERE DeliveryTimeRaw IS NOT NULL"


@query(
    "eval_regression",
    f"""WITH r AS ({_REG}) SELECT round(avg(abs(p - y)), 4) AS mae, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
        round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 4) AS r2 FROM r""",
)
def eval_regression(t: Roles) -> DataFrame:
    p = t.orders.filter(F.col("DeliveryTimeRaw").isNotNull()).select(
        F.col("DeliveryTimeRaw").alias("y"), (F.col("DeliveryFee").cast("double") * 25.5).alias("p")
    )
    return regression_metrics(p, "y", "p")


_SCORED = f"SELECT OrderID, CAST({DONE} AS BIGINT) AS y, CAST(FinalAmount AS DOUBLE) / 500000 AS p FROM m_order_heads"


def scored(t: Roles) -> DataFrame:
    return t.order_heads.select(
        "OrderID", is_completed(F.col("OrderStatus")).cast("int").alias("y"), (F.col("FinalAmount").cast("double") / 500000).alias("p")
    )


_GRID = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in threshold_grid())
_F1 = f"coalesce({ratio('2 * tp', '2 * tp + fp + fn')}, 0)"


@query(
    "tune_threshold",
    f"""WITH s AS ({_SCORED}), g(threshold) AS (VALUES {_GRID}),
        c AS (SELECT threshold, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
                     count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn FROM s JOIN g ON TRUE GROUP BY threshold)
        SELECT threshold, tp, fp, fn, {_F1} AS f1 FROM c""",
)
def tune_threshold(t: Roles) -> DataFrame:
    return threshold_table(scored(t), "y", "p")


@query(
    "best_threshold",
    f"""WITH s AS ({_SCORED}), g(threshold) AS (VALUES {_GRID}),
        c AS (SELECT threshold, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
                     count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn FROM s JOIN g ON TRUE GROUP BY threshold)
        SELECT threshold, {_F1} AS f1 FROM c ORDER BY f1 DESC, threshold LIMIT 1""",
)
def q_best_threshold(t: Roles) -> DataFrame:
    return best_threshold(threshold_table(scored(t), "y", "p"))


def _part(a: str, b: str) -> str:
    return f"coalesce({ratio(a, b)}, 0)"


@query(
    "eval_classification",
    f"""WITH s AS ({_SCORED}),
        c AS (SELECT count(*) FILTER (WHERE y = 1 AND p >= 0.4) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.4) AS fp,
                     count(*) FILTER (WHERE y = 1 AND p < 0.4) AS fn, count(*) FILTER (WHERE y = 0 AND p < 0.4) AS tn FROM s),
        k AS (SELECT p, count(*) FILTER (WHERE y = 1) AS a, count(*) FILTER (WHERE y = 0) AS b FROM s GROUP BY p),
        w AS (SELECT *, sum(a) OVER (ORDER BY p DESC) AS hits, sum(b) OVER (ORDER BY p DESC) AS misses FROM k),
        z AS (SELECT CAST(sum(b * (2 * hits - a)) AS DOUBLE) / (2.0 * CAST(sum(a) AS DOUBLE) * CAST(sum(b) AS DOUBLE)) AS auc,
                     sum(a * (CAST(hits AS DOUBLE) / CAST(hits + misses AS DOUBLE))) / sum(a) AS ap FROM w),
        m AS (SELECT *, {_part('tp', 'tp + fp')} AS p1, {_part('tp', 'tp + fn')} AS r1, {_part('tn', 'tn + fn')} AS p0, {_part('tn', 'tn + fp')} AS r0,
                     {_part('2 * tp', '2 * tp + fp + fn')} AS f1_, {_part('2 * tn', '2 * tn + fp + fn')} AS f0, tp + fn AS s1, tn + fp AS s0 FROM c)
        SELECT CAST(0.4 AS DOUBLE) AS threshold, round({_part('tp + tn', 's1 + s0')}, 4) AS accuracy, round(p1, 4) AS precision, round(r1, 4) AS recall,
               round(f1_, 4) AS f1, round(p0, 4) AS precision_0, round(r0, 4) AS recall_0, round(f0, 4) AS f1_0,
               round((p1 + p0) / 2, 4) AS macro_precision, round((r1 + r0) / 2, 4) AS macro_recall, round((f1_ + f0) / 2, 4) AS macro_f1,
               round((p1 * s1 + p0 * s0) / (s1 + s0), 4) AS weighted_precision, round((r1 * s1 + r0 * s0) / (s1 + s0), 4) AS weighted_recall,
               round((f1_ * s1 + f0 * s0) / (s1 + s0), 4) AS weighted_f1, tp, fp, fn, tn, s1 AS support_1, s0 AS support_0,
               round(auc, 4) AS roc_auc, round(ap, 4) AS pr_auc FROM m JOIN z ON TRUE""",
)
def eval_classification(t: Roles) -> DataFrame:
    return classification_metrics(scored(t), "y", "p", 0.4)


def _delivery(t: Roles) -> DataFrame:
    return stored(features.delivery_features(domain_tables(t)), "delivery-features")


def _churn(t: Roles) -> DataFrame:
    return stored(features.churn_features(churn_all(t)), "churn-features")


@query("train_delivery")
def train_delivery(t: Roles) -> DataFrame:
    return models.train_delivery(_delivery(t))[1]


@query("score_delivery")
def score_delivery(t: Roles) -> DataFrame:
    """Scores every order; the ones without features appear with no prediction."""
    table = _delivery(t)
    bundle = models.train_delivery(table)[0]
    scores = models.score_delivery(bundle, table, t.order_heads)
    missing = models.unknown_ids(t.order_heads, table, "OrderID")
    return scores.unionByName(missing, allowMissingColumns=True)


@query("train_churn")
def train_churn(t: Roles) -> DataFrame:
    return models.train_churn(_churn(t))[1]


@query("score_churn")
def score_churn(t: Roles) -> DataFrame:
    table = _churn(t)
    bundle = models.train_churn(table)[0]
    return models.score_churn(bundle, table, t.customers)


@query(
    "ranked_churn_list",
    f"""WITH s AS ({_SCORED}) SELECT OrderID AS CustomerID, y AS ActualChurn60d, p AS ChurnProbability,
        CAST(p >= 0.4 AS BIGINT) AS PredictedChurn60d FROM s""",
)
def ranked_churn_list(t: Roles) -> DataFrame:
    named = scored(t).withColumnsRenamed({"OrderID": "CustomerID", "y": "Churn60d", "p": "ChurnProbability"})
    return models.ranked_churn(named, 0.4)
