"""Feature preparation and evaluation queries that SQL can check.

The score frame: one row per order; truth = the order is finished (status F),
score = total price over 600000 cut to three decimals, pred = score >= 0.5.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.common import rounded, table
from tabloom.operators import evaluate, features

CATEGORIES = ["o_orderstatus", "o_orderpriority"]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
COEFFICIENTS = {"l_quantity": 0.02, "l_discount": -3.5, "l_tax": 1.25}


def ordinal_encode(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", *CATEGORIES)
    return features.ordinal_encode(orders, CATEGORIES)[0]


def one_hot_columns(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return features.one_hot_columns(customers, features.category_levels(customers, ["c_mktsegment"]))


def min_max_scale(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_COLUMNS)
    scaled = features.min_max_scale(lines, LINE_COLUMNS)[0]
    return scaled.select("l_orderkey", "l_linenumber", *[rounded(F.col(c), c) for c in LINE_COLUMNS])


def hash_split(spark, folder):
    return features.hash_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


def _status(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")


def stratified_split(spark, folder):
    return features.stratified_split(_status(spark, folder), "o_orderkey", "o_orderstatus")


def fold_assignment(spark, folder):
    return features.fold_assignment(_status(spark, folder), "o_orderkey", "o_orderstatus")


def class_weights(spark, folder):
    found = features.class_weights(table(spark, folder, "labels"), "quality")
    return found.select("quality", rounded(F.col("weight"), "weight"))


def class_weights_applied(spark, folder):
    weighted = features.with_class_weights(table(spark, folder, "labels"), "quality")
    return weighted.groupBy("quality").agg(rounded(F.sum("weight"), "total"))


def _scores(spark, folder):
    score = F.col("o_totalprice") / 600000
    return table(spark, folder, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("truth"),
        (score >= 0.5).cast("int").alias("pred"),
        score.alias("score"),
    )


def _metrics(df, names):
    return df.select(*[rounded(F.col(c), c) for c in names])


def confusion_counts(spark, folder):
    return evaluate.confusion_counts(_scores(spark, folder))


def binary_metrics(spark, folder):
    return _metrics(evaluate.binary_metrics(_scores(spark, folder)), ["accuracy", "precision", "recall", "f1"])


def roc_curve(spark, folder):
    found = evaluate.roc_curve(_scores(spark, folder))
    return found.select(rounded(F.col("threshold"), "threshold", 9), rounded(F.col("fpr"), "fpr"), rounded(F.col("tpr"), "tpr"))


def roc_auc(spark, folder):
    return _metrics(evaluate.roc_auc(_scores(spark, folder)), ["auc"])


def _class_pairs(spark, folder):
    """Truth = event type; pred = a type read off the value."""
    value = F.col("value")
    guess = F.when(value < 10, "view").when(value < 30, "click").when(value < 60, "purchase").otherwise("error")
    return table(spark, folder, "events").select(F.col("event_type").alias("truth"), guess.alias("pred"))


def class_report(spark, folder):
    found = evaluate.class_report(_class_pairs(spark, folder))
    return found.select("label", *[rounded(F.col(c), c) for c in ("precision", "recall", "f1")], "support")


def token_accuracy(spark, folder):
    found = evaluate.token_accuracy(_class_pairs(spark, folder))
    return found.select("tokens", rounded(F.col("accuracy"), "accuracy"))


def model_comparison(spark, folder):
    """Two rules over the orders: by price, and by order date."""
    orders = table(spark, folder, "orders")
    truth = (F.col("o_orderstatus") == "F").cast("int").alias("truth")
    price = F.col("o_totalprice") / 600000
    age = (F.lit(2100) - F.year("o_orderdate")) / 200
    rows = [
        F.struct(F.lit("price").alias("model"), (price >= 0.5).cast("int").alias("pred"), price.alias("score")),
        F.struct(F.lit("age").alias("model"), (age >= 0.52).cast("int").alias("pred"), age.alias("score")),
    ]
    return evaluate.model_comparison(orders.select(truth, F.inline(F.array(*rows))))


def linear_attribution(spark, folder):
    lines = table(spark, folder, "lineitem")
    found = evaluate.linear_attribution(lines, COEFFICIENTS, ["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", "l_linenumber", *[rounded(F.col(c), c, 8) for c in COEFFICIENTS])


def attribution_bars(spark, folder):
    found = evaluate.linear_attribution(table(spark, folder, "lineitem"), COEFFICIENTS)
    return evaluate.attribution_bars(found, list(COEFFICIENTS)).select("feature", rounded(F.col("importance"), "importance"))


QUERIES = {
    "ordinal_encode": ordinal_encode,
    "one_hot_columns": one_hot_columns,
    "min_max_scale": min_max_scale,
    "hash_split": hash_split,
    "stratified_split": stratified_split,
    "fold_assignment": fold_assignment,
    "class_weights": class_weights,
    "class_weights_applied": class_weights_applied,
    "confusion_counts": confusion_counts,
    "binary_metrics": binary_metrics,
    "roc_curve": roc_curve,
    "roc_auc": roc_auc,
    "class_report": class_report,
    "token_accuracy": token_accuracy,
    "model_comparison": model_comparison,
    "linear_attribution": linear_attribution,
    "attribution_bars": attribution_bars,
}

_SCORES = """
    scores AS (
      SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS truth, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred, score
      FROM (SELECT o_orderstatus, o_totalprice / 600000 AS score FROM orders)),
    cells AS (
      SELECT count(*) FILTER (truth = 0 AND pred = 0) AS tn, count(*) FILTER (truth = 0 AND pred = 1) AS fp,
             count(*) FILTER (truth = 1 AND pred = 0) AS fn, count(*) FILTER (truth = 1 AND pred = 1) AS tp FROM scores)"""
_RANKS = """
    SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
           row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42' || chr(31) || o_orderkey)) AS r FROM orders"""
_CLASS = """
    pairs AS (
      SELECT event_type AS truth, CASE WHEN value < 10 THEN 'view' WHEN value < 30 THEN 'click'
             WHEN value < 60 THEN 'purchase' ELSE 'error' END AS pred FROM events)"""
_AUC = """
    SELECT model, sum(CASE WHEN truth = 1 THEN r ELSE 0 END) AS ranks, sum(truth) AS p, count(*) - sum(truth) AS n FROM (
      SELECT *, rank() OVER (PARTITION BY model ORDER BY score)
                + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM rated) GROUP BY model"""

SQL = {
    "ordinal_encode": """
        SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus,
               CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority FROM orders""",
    "one_hot_columns": "SELECT c_custkey, "
    + ", ".join(
        f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS \"c_mktsegment_{v}\""
        for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer",
    "min_max_scale": "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in LINE_COLUMNS)
    + " FROM lineitem",
    "hash_split": """
        SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42' || chr(31) || o_orderkey), 1, 8) AS BIGINT) / 4294967296.0 < 0.7
               THEN 'train' ELSE 'test' END AS part FROM orders""",
    "stratified_split": f"""
        SELECT o_orderkey, o_orderstatus, CASE WHEN r <= round(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM ({_RANKS})""",
    "fold_assignment": f"SELECT o_orderkey, o_orderstatus, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ({_RANKS})",
    "class_weights": """
        SELECT quality, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM labels GROUP BY quality""",
    "class_weights_applied": """
        SELECT quality, round(CAST(sum(count(*)) OVER () AS DOUBLE) / count(*) OVER (), 6) AS total FROM labels GROUP BY quality""",
    "confusion_counts": f"WITH {_SCORES} SELECT * FROM cells",
    "binary_metrics": f"""
        WITH {_SCORES} SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
        round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM cells""",
    "roc_curve": f"""
        WITH {_SCORES} SELECT round(score, 9) AS threshold,
          round(sum(sum(1 - truth)) OVER (ORDER BY score DESC) / (SELECT sum(1 - truth) FROM scores), 6) AS fpr,
          round(sum(sum(truth)) OVER (ORDER BY score DESC) / (SELECT sum(truth) FROM scores), 6) AS tpr
        FROM scores GROUP BY score""",
    "roc_auc": f"""
        WITH {_SCORES}, rated AS (SELECT 'm' AS model, * FROM scores)
        SELECT round((ranks - p * (p + 1) / 2) / (p * n), 6) AS auc FROM ({_AUC})""",
    "class_report": f"""
        WITH {_CLASS}, classes AS (
          SELECT label, sum(hit) AS hits, sum(t) AS support, sum(p) AS predicted FROM (
            SELECT truth AS label, 1 AS t, 0 AS p, CASE WHEN truth = pred THEN 1 ELSE 0 END AS hit FROM pairs
            UNION ALL SELECT pred, 0, 1, 0 FROM pairs) GROUP BY label),
        rates AS (
          SELECT label, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
                 CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
                 2 * hits / (predicted + support) AS f1, CAST(support AS BIGINT) AS support FROM classes)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rates
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
          CAST(sum(support) AS BIGINT) FROM rates
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
          round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
          CAST(sum(support) AS BIGINT) FROM rates""",
    "token_accuracy": f"""
        WITH {_CLASS} SELECT count(*) AS tokens, round(avg(CASE WHEN truth = pred THEN 1 ELSE 0 END), 6) AS accuracy FROM pairs""",
    "model_comparison": f"""
        WITH rated AS (
          SELECT 'price' AS model, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS truth,
                 o_totalprice / 600000 AS score, 0.5 AS cut FROM orders
          UNION ALL SELECT 'age', CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, (2100 - year(o_orderdate)) / 200, 0.52 FROM orders),
        cells AS (
          SELECT model, count(*) FILTER (truth = 0 AND score < cut) AS tn, count(*) FILTER (truth = 0 AND score >= cut) AS fp,
                 count(*) FILTER (truth = 1 AND score < cut) AS fn, count(*) FILTER (truth = 1 AND score >= cut) AS tp
          FROM rated GROUP BY model)
        SELECT model, round((tp + tn) / (tp + tn + fp + fn), 3) AS accuracy,
               CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 3) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn), 3) END AS recall,
               round(2 * tp / (2 * tp + fp + fn), 3) AS f1, round((ranks - p * (p + 1) / 2) / (p * n), 3) AS auc
        FROM cells JOIN ({_AUC}) USING (model)""",
    "linear_attribution": "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({w} * ({c} - avg({c}) OVER ()), 8) AS {c}" for c, w in COEFFICIENTS.items())
    + " FROM lineitem",
    "attribution_bars": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(abs({w} * ({c} - m))), 6) AS importance "
        f"FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"
        for c, w in COEFFICIENTS.items()
    ),
}
