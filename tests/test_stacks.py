"""Tuned stacks: each base is fitted once per fold and parameter set, and the tops equal single fits."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tabloom.operators import evaluate, features, models, stacks, tuning
from tabloom.session import cut_lineage

FITS = []


class CountedTree(DecisionTreeClassifier):
    def _fit(self, dataset):
        FITS.append(self.getMaxDepth())
        return super()._fit(dataset)


@pytest.fixture(scope="module")
def data(spark):
    source = random.Random(6)
    rows = []
    for i in range(300):
        x, z = source.gauss(0, 1), source.gauss(0, 1)
        rows.append((i, x, z, float(source.random() < 1 / (1 + math.exp(-2 * x * z - x)))))
    df = features.fold_assignment(spark.createDataFrame(rows, "id long, x double, z double, label double").withColumn("weight", F.lit(1.0)), "id", "label", 3)
    ready = features.feature_pipeline(["x", "z"]).fit(df).transform(df)
    return cut_lineage(ready.select("id", "label", "weight", "fold", "features"))


@pytest.fixture(scope="module")
def tuned(data):
    FITS.clear()
    tree = {f"depth {d}": CountedTree(**models.COLUMNS, maxDepth=d, seed=1) for d in (1, 3, 4)}
    line = {"plain": models.logistic(300.0)}
    return stacks.tune_stack({"tree": tree, "line": line}, data, "id", 3, (0.1, 1.0))


def test_each_base_is_fitted_once_per_fold(tuned):
    assert sorted(FITS) == [1] * 3 + [3] * 3 + [4] * 3
    whole, report, _ = tuned
    assert report.count() == len(whole) == 6


def test_slots_hold_scores_of_unseen_rows(data, tuned):
    level = {r["id"]: r["x"] for r in tuned[2].collect()}
    assert len(level) == 300 and all(len(x) == 4 for x in level.values())
    expected = tuning.out_of_fold(models.logistic(300.0), data, "id", 3).collect()
    assert all(level[r["id"]][3] == pytest.approx(r["score"]) for r in expected)


def test_a_top_model_equals_its_own_fit(tuned):
    whole, report, level = tuned
    rows = level.collect()
    x, y = np.array([[r["x"][1], r["x"][3]] for r in rows]), np.array([r["label"] for r in rows])
    design, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-design @ beta))
        ridge = np.diag([1.0, 1.0, 0.0])
        beta -= np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge, design.T @ (p - y) + ridge @ beta)
    assert np.allclose(whole["tree depth 3, line plain, C=1"].beta, beta, atol=1e-8)


def test_report(tuned):
    _, report, level = tuned
    rows = {r["point"]: r for r in report.collect()}
    best = [p for p, r in rows.items() if r["best"]]
    assert len(best) == 1 and rows[best[0]]["cv_auc"] == max(r["cv_auc"] for r in rows.values()) > 0.75
    assert all(0.5 < r["train_auc"] <= 1 and r["cv_std"] >= 0 for r in rows.values())
    deep = evaluate.roc_auc(level.select(F.col("label").cast("int").alias("truth"), F.col("x")[2].alias("score"))).first()["auc"]
    assert rows["tree depth 4, line plain, C=1"]["train_auc"] > deep - 0.05


