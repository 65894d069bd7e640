"""Evaluation of predictions as plain relational aggregates.

Frames hold `truth` (0/1 or a class), `pred` and, where needed, `score`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ranking import join_groups, running_totals, value_buckets, with_value_bucket


def _ratio(top: Column, bottom: Column) -> Column:
    """0 when undefined."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp in one pass."""
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return df.groupBy(*groups).agg(
        *[F.count_if((F.col("truth") == t) & (F.col("pred") == p)).alias(n) for n, (t, p) in cells.items()]
    )


def binary_metrics(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion_counts(df, groups).select(
        *groups,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _cumulated(df: DataFrame, groups: Sequence[str], descending: bool) -> DataFrame:
    """Rows (groups, score, pos, neg, run_pos, run_neg, all_pos, all_neg): equal scores together.

    run_ are totals in score order, all_ those of the group. Scores are cut at
    sampled split points, so that running totals over many distinct scores stay
    spread over tasks.
    """
    sign = -1 if descending else 1
    keyed = df.select(*groups, "truth", "score", (F.col("score") * sign).cast("double").alias("__order"))
    bounds = value_buckets(keyed, ["__order"])["__order"]
    counted = keyed.groupBy(*groups, "score", "__order").agg(
        F.count_if(F.col("truth") == 1).alias("pos"), F.count_if(F.col("truth") == 0).alias("neg")
    )
    bucketed = with_value_bucket(counted, "__order", bounds, "__bucket")
    totals = {"run_pos": F.col("pos"), "run_neg": F.col("neg")}
    whole = {"all_pos": "run_pos", "all_neg": "run_neg"}
    return running_totals(bucketed, "__bucket", [F.col("__order")], totals, groups, whole)


def roc_curve(df: DataFrame, digits: int | None = None) -> DataFrame:
    """threshold, fpr, tpr by falling score, equal scores together.

    `digits` rounds the scores first, which bounds the number of points.
    """
    scored = df if digits is None else df.withColumn("score", F.round("score", digits))
    return _cumulated(scored, [], descending=True).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("run_neg"), F.col("all_neg")).alias("fpr"),
        _ratio(F.col("run_pos"), F.col("all_pos")).alias("tpr"),
    )


def roc_auc(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """auc: chance that a positive scores above a negative, ties count half. Null without both classes.

    One pass finds the split points, one counts the scores; the class totals
    come from those counts.
    """
    steps = _cumulated(df, groups, descending=False)
    below = F.col("run_neg") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    pairs = F.max("all_pos") * F.max("all_neg")
    return steps.groupBy(*groups).agg(F.when(pairs > 0, wins / pairs).alias("auc"))


def class_report(df: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support per class, with the rows macro avg and weighted avg."""
    cells = df.groupBy("truth", "pred").agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").cast("string").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("pred").cast("string").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        )
    )
    classes = (
        sides.groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .select(
            "label",
            _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
            _ratio(F.col("hits"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
            "support",
        )
    )
    rates = ("precision", "recall", "f1")
    macro = classes.agg(*[F.avg(c).alias(c) for c in rates], F.sum("support").alias("support"))
    weighted = classes.agg(
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in rates],
        F.sum("support").alias("support"),
    )
    named = [
        part.select(F.lit(name).alias("label"), *rates, "support")
        for name, part in (("macro avg", macro), ("weighted avg", weighted))
    ]
    return classes.unionByName(named[0]).unionByName(named[1])


def token_accuracy(df: DataFrame) -> DataFrame:
    """tokens, accuracy: with one label per token this is the micro-averaged F1."""
    return df.agg(
        F.count(F.lit(1)).alias("tokens"),
        F.avg(F.when(F.col("truth") == F.col("pred"), 1).otherwise(0)).alias("accuracy"),
    )


def model_comparison(df: DataFrame, digits: int = 3) -> DataFrame:
    """model, accuracy, precision, recall, f1, auc from rows (model, truth, pred, score)."""
    metrics = join_groups(binary_metrics(df, ["model"]), roc_auc(df, ["model"]), ["model"])
    return metrics.select(
        "model", *[F.round(c, digits).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc")]
    )


def linear_attribution(df: DataFrame, coefficients: dict[str, float], keep: Sequence[str] = ()) -> DataFrame:
    """Per row and feature: coefficient * (x - mean x), the share of the feature in a linear score."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefficients])).scalar()
    centred = df.withColumn("__mean", means)
    return centred.select(
        *keep, *[(F.lit(w) * (F.col(c) - F.col("__mean")[c])).alias(c) for c, w in coefficients.items()]
    )


def attribution_bars(attributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, importance: mean absolute attribution."""
    row = attributions.agg(*[F.avg(F.abs(c)).alias(c) for c in features])
    bars = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in features]
    return row.select(F.inline(F.array(*bars)))
