"""Cross-validation, searches, feature selection, stacking and permutation importance.

Each fit is a distributed Spark job; threads on the driver only let several
jobs run side by side, as `CrossValidator(parallelism=...)` does. Training
frames should be stored or cached by the caller, they are read once per fit.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import evaluate
from tabloom.operators.models import auc, logistic, random_forest, score_table, weight_sum
from tabloom.operators.ranking import hashed_rank
from tabloom.session import cut_lineage

FOLD = "fold"


def _side_by_side(df: DataFrame, work: Callable, items: Sequence, parallelism: int) -> list:
    target = inheritable_thread_target(df.sparkSession)(work)
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(target, items)


def cross_scores(estimator: Estimator, df: DataFrame, folds: int, parallelism: int = 4) -> list[float]:
    """AUC on each fold of a model fitted on the other folds; `df` has a fold column."""

    def one(fold: int) -> float:
        held = F.col(FOLD) == fold
        return auc(estimator.fit(df.filter(~held)), df.filter(held))

    return _side_by_side(df, one, range(folds), parallelism)


def cv_scores(estimator: Estimator, df: DataFrame, folds: int, parallelism: int = 4) -> DataFrame:
    """(fold, auc)."""
    scores = cross_scores(estimator, df, folds, parallelism)
    return df.sparkSession.createDataFrame(list(enumerate(scores)), "fold int, auc double")


def grid_search(
    estimator: Estimator, grid: list[dict], df: DataFrame, folds: int, parallelism: int = 4
) -> tuple[CrossValidatorModel, DataFrame]:
    """Best model, refitted on all rows, and a report (params, cv_auc, cv_std, best).

    `grid` comes from `ParamGridBuilder`; folds are those of the fold column.
    """
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(numBins=0),
        numFolds=folds,
        foldCol=FOLD,
        parallelism=parallelism,
    ).fit(df)
    top = max(range(len(grid)), key=lambda i: search.avgMetrics[i])
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda item: item[0].name)),
            float(search.avgMetrics[i]),
            float(search.stdMetrics[i]),
            i == top,
        )
        for i, point in enumerate(grid)
    ]
    report = df.sparkSession.createDataFrame(rows, "params string, cv_auc double, cv_std double, best boolean")
    return search, report


# How a random trial draws a value: log-uniform, uniform or whole number in a range.
Range = tuple[str, float, float]


def draw(space: dict[str, Range], trials: int, seed: int = 42) -> list[dict]:
    """`trials` parameter sets drawn from named ranges ("log", "uniform" or "int", low, high)."""
    source = random.Random(seed)

    def value(kind: str, low: float, high: float):
        if kind == "log":
            return math.exp(source.uniform(math.log(low), math.log(high)))
        return source.randint(int(low), int(high)) if kind == "int" else source.uniform(low, high)

    return [{name: value(*range_) for name, range_ in space.items()} for _ in range(trials)]


def random_search(
    build: Callable[..., Estimator],
    space: dict[str, Range],
    train: DataFrame,
    valid: DataFrame,
    trials: int = 10,
    seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """(trial, params, auc, best): each drawn parameter set fitted on `train`, scored on `valid`."""
    points = draw(space, trials, seed)
    scores = _side_by_side(train, lambda p: auc(build(**p).fit(train), valid), points, parallelism)
    top = scores.index(max(scores))
    rows = [
        (i, ", ".join(f"{k}={v:.6g}" for k, v in p.items()), scores[i], i == top) for i, p in enumerate(points)
    ]
    return train.sparkSession.createDataFrame(rows, "trial int, params string, auc double, best boolean")


def _sliced(df: DataFrame, slots: Sequence[int]) -> DataFrame:
    """Only the given slots of the feature vector, other columns untouched."""
    cut = VectorSlicer(inputCol="features", outputCol="__cut", indices=sorted(slots)).transform(df)
    return cut.drop("features").withColumnRenamed("__cut", "features")


def select_by_importance(
    df: DataFrame, names: Sequence[str], folds: int = 5, steps: int = 20, trees: int = 10, parallelism: int = 4
) -> tuple[list[str], DataFrame]:
    """Features kept at the best importance threshold, and (threshold, features, auc, best).

    `steps` even thresholds from 0 to the highest importance of one forest;
    thresholds that keep the same features share one cross-validation.
    """
    forest = random_forest(trees)
    importance = [float(v) for v in forest.fit(df).featureImportances.toArray()]
    step = max(importance) / (steps - 1)
    thresholds = [min(i * step, max(importance)) for i in range(steps)]
    kept = [tuple(i for i, v in enumerate(importance) if v >= t) for t in thresholds]
    known: dict[tuple, float] = {}
    for slots in kept:
        if slots not in known:
            scores = cross_scores(forest, _sliced(df, slots), folds, parallelism)
            known[slots] = sum(scores) / folds
    aucs = [known[s] for s in kept]
    top = aucs.index(max(aucs))
    rows = [(t, len(s), a, i == top) for i, (t, s, a) in enumerate(zip(thresholds, kept, aucs))]
    report = df.sparkSession.createDataFrame(rows, "threshold double, features int, auc double, best boolean")
    return [names[i] for i in kept[top]], report


def recursive_elimination(
    df: DataFrame, names: Sequence[str], folds: int = 5, trees: int = 10, parallelism: int = 4
) -> DataFrame:
    """(features, dropped_next, auc) for every size: the weakest feature goes after each refit.

    One elimination run passes through all sizes, so each size is fitted once.
    """
    forest = random_forest(trees)
    slots = list(range(len(names)))
    rows = []
    while slots:
        current = _sliced(df, slots)
        scores = cross_scores(forest, current, folds, parallelism)
        weights = forest.fit(current).featureImportances.toArray()
        weakest = slots[min(range(len(slots)), key=lambda i: weights[i])]
        rows.append((len(slots), names[weakest], sum(scores) / folds))
        slots.remove(weakest)
    return df.sparkSession.createDataFrame(rows, "features int, dropped_next string, auc double")


def _fold_scores(estimator: Estimator, df: DataFrame, key: str, fold: int) -> DataFrame:
    held = F.col(FOLD) == fold
    return score_table(estimator.fit(df.filter(~held)), df.filter(held), key)


def out_of_fold(estimator: Estimator, df: DataFrame, key: str, folds: int, parallelism: int = 4) -> DataFrame:
    """(key, score) for every row, each scored by a model that has not seen its fold."""
    return _in_one(_side_by_side(df, lambda fold: _fold_scores(estimator, df, key, fold), range(folds), parallelism))


def _in_one(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


class Stack:
    """Base models refitted on all rows and the logistic model on top of their scores."""

    def __init__(self, bases: dict[str, Model], top: Model, key: str):
        self.bases, self.top, self.key = bases, top, key

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df
        for name, model in self.bases.items():
            kept = scored.columns
            scored = model.transform(scored).select(
                *kept, _class_one().alias(f"{name}_score")
            )
        names = [f"{n}_score" for n in self.bases]
        return self.top.transform(_score_features(scored, names)).drop("__base").withColumnRenamed("features", "__base")


def _class_one():
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("probability")[1]


def _score_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(df.drop("features"))


def fit_stack(bases: dict[str, Estimator], df: DataFrame, key: str, folds: int = 5, parallelism: int = 12) -> Stack:
    """Logistic model on the out-of-fold scores of `bases`, which are refitted on all rows.

    A fit is mostly many short steps one after the other, so those of all folds
    and the refits (fold None) run side by side.
    """

    def one(item: tuple) -> DataFrame | Model:
        name, fold = item
        return bases[name].fit(df) if fold is None else _fold_scores(bases[name], df, key, fold)

    items = [(name, fold) for name in bases for fold in (*range(folds), None)]
    done = dict(zip(items, _side_by_side(df, one, items, parallelism)))
    level = df.select(key, "label", "weight")
    for name in bases:
        scores = _in_one([done[name, fold] for fold in range(folds)])
        level = level.join(scores.withColumnRenamed("score", f"{name}_score"), key)
    rows = _score_features(level, [f"{n}_score" for n in bases])
    top = logistic(weight_sum(df)).fit(rows)
    return Stack({name: done[name, None] for name in bases}, top, key)


def permutation_importance(
    model: Model, df: DataFrame, key: str, columns: Sequence[str], assembler: VectorAssembler, seed: int = 42
) -> DataFrame:
    """(feature, auc_drop): fall of the AUC when one column is dealt out anew among the rows.

    Rows are ranked in two independent hash orders and joined on the rank, an
    exact shuffle without a single-task window. All columns are scored in one
    frame, which is stored, and ranked together.
    """
    plain = df.select(key, "label", "weight", *columns)
    spots = hashed_rank(plain, [], [key], "__spot", seed)
    donors = hashed_rank(plain.select(key, *columns), [], [key], "__spot", seed + 1).select(
        "__spot", *[F.col(c).alias(f"__{c}") for c in columns]
    )
    both = spots.join(donors, "__spot")
    variants = [
        F.struct(F.lit(v).alias("model"), *[F.col(f"__{c}" if c == v else c).alias(c) for c in columns])
        for v in ("", *columns)
    ]
    wide = both.select(key, "label", "weight", F.inline(F.array(*variants)))
    scored = cut_lineage(
        model.transform(assembler.transform(wide)).select(
            "model", F.col("label").cast("int").alias("truth"), _class_one().alias("score")
        )
    )
    aucs = evaluate.roc_auc(scored, ["model"])
    base = aucs.filter(F.col("model") == "").agg(F.max("auc")).scalar()
    return aucs.filter(F.col("model") != "").select(F.col("model").alias("feature"), (base - F.col("auc")).alias("auc_drop"))
