"""Stacks tuned over base and top parameters from one table of out-of-fold scores.

Every base with every parameter set is fitted once per fold, whatever the
number of stacks that use it; its scores of the rows it has not seen are one
slot of an array per row. A stack is then a choice of slots and a strength of
the logistic model on top, and all stacks of all folds are one batch of
`logits`.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import evaluate
from tabloom.operators.logits import Fitted, Logit, fit_logits, grid_report, logit_scores
from tabloom.operators.tuning import FOLD, out_of_fold
from tabloom.session import cut_lineage

Bases = dict[str, dict[str, Estimator]]


def base_slots(bases: Bases) -> dict[tuple[str, str], int]:
    """The slot of each base and parameter set."""
    return {pair: k for k, pair in enumerate((base, params) for base, sets in bases.items() for params in sets)}


def score_slots(bases: Bases, df: DataFrame, key: str, folds: int, parallelism: int = 4) -> DataFrame:
    """(key, label, weight, fold, x): the out-of-fold scores of every base and parameter set as one array, stored.

    The scores of one row are brought together by one shuffle of (key, slot,
    score), as many rows per key as there are slots.
    """
    scored = None
    for (base, params), slot in base_slots(bases).items():
        part = out_of_fold(bases[base][params], df, key, folds, parallelism).select(key, F.lit(slot).alias("slot"), "score")
        scored = part if scored is None else scored.unionByName(part)
    arrays = scored.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "score"))), lambda s: s["score"]).alias("x"))
    return cut_lineage(df.select(key, "label", "weight", FOLD).join(arrays, key))


def stack_points(bases: Bases, strengths: Sequence[float]) -> dict[str, tuple[tuple[int, ...], float]]:
    """The slots and the strength of every stack: one parameter set of each base, times the strengths of the top."""
    slots = base_slots(bases)
    points = {}
    for chosen in itertools.product(*[[(base, params) for params in sets] for base, sets in bases.items()]):
        for C in strengths:
            name = ", ".join([*(f"{base} {params}" for base, params in chosen), f"C={C:g}"])
            points[name] = tuple(slots[c] for c in chosen), C
    return points


def tune_stack(
    bases: Bases, df: DataFrame, key: str, folds: int, strengths: Sequence[float] = (1.0,), parallelism: int = 4
) -> tuple[dict[str, Fitted], DataFrame, DataFrame]:
    """The top models fitted on all rows by point, the report (point, train_auc, cv_auc, cv_std, best), and the score table.

    `df` has label, weight and fold as `features.fold_assignment` makes it. A
    top model of a fold is fitted on the out-of-fold scores of the other folds;
    train_auc is that of the top model on all rows' out-of-fold scores.
    """
    level = score_slots(bases, df, key, folds, parallelism)
    specs = [
        Logit(f"{name}|{'' if k is None else k}", slots, C, False, k) for name, (slots, C) in stack_points(bases, strengths).items() for k in (None, *range(folds))
    ]
    models = fit_logits(level, specs, fold=FOLD)
    scored = logit_scores(models, level, ["label", FOLD])
    side = F.when(F.col("held").isNull(), "train_auc").when(F.col(FOLD) == F.col("held"), "auc")
    rows = scored.withColumn("side", side).filter("side IS NOT NULL").select("model", "held", "side", F.col("label").cast("int").alias("truth"), F.round("score", 9).alias("score"))
    aucs = evaluate.roc_auc(rows, ["model", "held", "side"])
    report = aucs.groupBy(F.substring_index("model", "|", 1).alias("point"), F.col("held").alias("fold")).agg(
        F.max(F.when(F.col("side") == "train_auc", F.col("auc"))).alias("train_auc"), F.max(F.when(F.col("side") == "auc", F.col("auc"))).alias("auc")
    )
    whole = {m.spec.name.split("|")[0]: m for m in models if m.spec.held is None}
    return whole, grid_report(report), level
