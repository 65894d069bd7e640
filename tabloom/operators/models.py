"""Classifiers from `pyspark.ml` with the settings of the usual tabular toolkits.

Training frames hold `features`, a 0/1 `label`, a `weight` and an id column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}


def logistic(weight_sum: float | None, C: float = 1.0, penalty: str = "l2", max_iter: int = 100) -> LogisticRegression:
    """Logistic regression with the inverse strength `C` of the summed loss.

    Spark averages the loss over the weights, hence regParam = 1 / (C * sum of
    weights). Without `weight_sum` the fit is not regularised.
    """
    strength = 0.0 if weight_sum is None else 1.0 / (C * weight_sum)
    return LogisticRegression(
        **COLUMNS,
        regParam=strength,
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False,
        maxIter=max_iter,
    )


def decision_tree(criterion: str = "gini", max_depth: int = 6, min_rows: int = 1, seed: int = 42) -> DecisionTreeClassifier:
    """Growth is limited by depth and leaf size; Spark has no limit on the number of leaves."""
    return DecisionTreeClassifier(**COLUMNS, impurity=criterion, maxDepth=max_depth, minInstancesPerNode=min_rows, seed=seed)


def random_forest(
    trees: int = 10, max_depth: int = 5, max_features: int | str = "auto", seed: int = 42
) -> RandomForestClassifier:
    return RandomForestClassifier(
        **COLUMNS, numTrees=trees, maxDepth=max_depth, featureSubsetStrategy=str(max_features), seed=seed
    )


def boosted_trees(
    rounds: int = 20,
    learning_rate: float = 0.1,
    max_depth: int = 3,
    bagging_fraction: float = 1.0,
    feature_fraction: float = 1.0,
    seed: int = 42,
) -> GBTClassifier:
    """Gradient boosting on log loss."""
    return GBTClassifier(
        **COLUMNS,
        maxIter=rounds,
        stepSize=learning_rate,
        maxDepth=max_depth,
        subsamplingRate=bagging_fraction,
        featureSubsetStrategy="all" if feature_fraction >= 1.0 else str(feature_fraction),
        seed=seed,
    )


def best_round(losses: Sequence[float], patience: int) -> int:
    """1-based round with the lowest loss, looking no further than `patience` rounds past it."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_until_best(estimator: GBTClassifier, train: DataFrame, valid: DataFrame, patience: int = 100) -> Model:
    """Boosting stopped at the best round on `valid`.

    All rounds are fitted, their validation losses come from one pass over
    `valid`, and the model is refitted with the rounds that count: with a fixed
    seed the first trees of both fits are the same.
    """
    full = estimator.fit(train)
    rounds = best_round(full.evaluateEachIteration(valid), patience)
    return full if rounds == estimator.getMaxIter() else estimator.copy({estimator.maxIter: rounds}).fit(train)


def weight_sum(df: DataFrame) -> float:
    return float(df.agg(F.sum("weight")).first()[0])


def score_table(model: Model, df: DataFrame, key: str) -> DataFrame:
    """(key, score): the chance of class 1, next to the id of the row it belongs to."""
    return model.transform(df).select(key, vector_to_array("probability")[1].alias("score"))


def scored_predictions(model: Model, df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """(key, truth, pred, score), with a model name if given; the input of the evaluation operators."""
    rows = model.transform(df).select(
        key,
        F.col("label").cast("int").alias("truth"),
        F.col("prediction").cast("int").alias("pred"),
        vector_to_array("probability")[1].alias("score"),
    )
    return rows if name is None else rows.select(F.lit(name).alias("model"), *rows.columns)


def auc(model: Model, df: DataFrame) -> float:
    """Area under the ROC curve from distributed rank statistics of the raw scores."""
    return BinaryClassificationEvaluator(numBins=0).evaluate(model.transform(df))


def feature_names(df: DataFrame, numeric: Sequence[str] = (), features: str = "features") -> list[str]:
    """Names of the vector slots, from the metadata that the assembler left.

    A scaler keeps no names for its slots; `numeric` gives those of the scaled block.
    """
    attributes = df.schema[features].metadata["ml_attr"]["attrs"]
    flat = sorted((a for kind in attributes.values() for a in kind), key=lambda a: a["idx"])
    scaled = {f"numbers_scaled_{i}": name for i, name in enumerate(numeric)}
    return [scaled.get(a["name"], a["name"]) for a in flat]


def importance_rank(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance), highest first, from a tree model. One row per feature."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    report = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return report.orderBy(F.col("importance").desc(), "feature")


def univariate_logistic(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """(feature, slope, intercept): one unregularised logistic curve per column."""
    rows = []
    for c in columns:
        one = VectorAssembler(inputCols=[c], outputCol="features").transform(
            df.select(F.col(c).cast("double").alias(c), F.col(label).alias("label"), F.lit(1.0).alias("weight"))
        )
        model = LogisticRegression(**COLUMNS, regParam=0.0).fit(one)
        rows.append((c, float(model.coefficients[0]), float(model.intercept)))
    return df.sparkSession.createDataFrame(rows, "feature string, slope double, intercept double")
