import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import evaluate, features, models, tuning
from tabloom.session import cut_lineage


@pytest.fixture(scope="module")
def data(spark):
    source = random.Random(8)
    rows = []
    for i in range(400):
        x, noise, kind = source.gauss(0, 1), source.gauss(0, 1), source.choice("ab")
        rows.append((i, x, noise, kind, float(source.random() < 1 / (1 + math.exp(-3 * x)))))
    df = spark.createDataFrame(rows, "id long, x double, noise double, kind string, label double")
    df = features.fold_assignment(features.with_class_weights(df, "label"), "id", "label", 3)
    ready = features.feature_pipeline(["x", "noise"], ["kind"]).fit(df).transform(df)
    names = models.feature_names(ready, ["x", "noise"])
    return cut_lineage(ready.select("id", "x", "noise", "label", "weight", "fold", "features")), names


def test_slots_are_named(data):
    assert len(data[1]) == len(data[0].first().features)
    assert data[1][:4] == ["x", "noise", "kind_flags_a", "kind_flags_b"]


def test_strength_follows_the_weight_sum(spark):
    assert models.logistic(50.0, C=0.5).getRegParam() == pytest.approx(1 / 25)
    assert models.logistic(50.0, penalty="l1").getElasticNetParam() == 1.0
    assert models.logistic(None).getRegParam() == 0.0


def test_logistic_minimises_the_summed_loss(data):
    """The gradient of C * weighted loss + |w|^2 / 2 vanishes at the fit."""
    df, _ = data
    plain = VectorAssembler(inputCols=["x", "noise"], outputCol="features").transform(df.drop("features"))
    model = models.logistic(models.weight_sum(plain), C=0.1).fit(plain)
    w, b = model.coefficients, model.intercept
    rows = plain.select("x", "noise", "label", "weight").collect()
    gradient = [0.0, 0.0]
    for r in rows:
        p = 1 / (1 + math.exp(-(w[0] * r.x + w[1] * r.noise + b)))
        for j, v in enumerate((r.x, r.noise)):
            gradient[j] += 0.1 * r.weight * (p - r.label) * v
    assert [g + wj for g, wj in zip(gradient, w)] == pytest.approx([0.0, 0.0], abs=1e-2)


def test_scores_carry_their_ids(data):
    df, _ = data
    model = models.decision_tree(max_depth=3).fit(df)
    scores = models.score_table(model, df, "id")
    assert scores.count() == 400 and scores.select("id").distinct().count() == 400
    table = evaluate.model_comparison(models.scored_predictions(model, df, "id", "tree")).first()
    assert table.auc > 0.7


def test_cross_validation_and_grid(data):
    df, _ = data
    assert all(0.7 < r.auc <= 1 for r in tuning.cv_scores(models.logistic(400.0), df, 3).collect())
    tree = models.decision_tree()
    grid = [{tree.maxDepth: d} for d in (1, 4)]
    search, report = tuning.grid_search(tree, grid, df, 3)
    assert report.count() == 2 and report.filter("best").count() == 1
    assert search.bestModel.transform(df).count() == 400


def test_draws_stay_in_range_and_repeat():
    space = {"a": ("log", 1e-4, 1e-1), "b": ("uniform", 0.4, 1.0), "c": ("int", 2, 5)}
    points = tuning.draw(space, 50)
    assert points == tuning.draw(space, 50)
    assert all(1e-4 <= p["a"] <= 1e-1 and 0.4 <= p["b"] <= 1 and p["c"] in (2, 3, 4, 5) for p in points)


def test_early_stop_picks_the_best_round(data):
    assert models.best_round([5, 4, 3, 4, 4, 2], patience=2) == 3
    assert models.best_round([5, 4, 3, 4, 4, 2], patience=3) == 6
    assert models.best_round([1], patience=1) == 1
    df, _ = data
    model = models.fit_until_best(models.boosted_trees(6), df.filter("fold > 0"), df.filter("fold = 0"), patience=2)
    assert 1 <= model.getNumTrees <= 6


def test_selection_finds_the_signal(data):
    df, names = data
    kept, report = tuning.select_by_importance(df, names, 3, steps=5)
    assert "x" in kept
    assert report.count() == 5 and report.filter("best").count() == 1
    sizes = [r.features for r in tuning.recursive_elimination(df, names, 3, trees=5).collect()]
    assert sizes == list(range(len(names), 0, -1))


def test_stack_scores_every_row(data):
    df, _ = data
    bases = {"tree": models.decision_tree(max_depth=3), "linear": models.logistic(400.0)}
    out = tuning.out_of_fold(bases["tree"], df, "id", 3)
    assert out.count() == 400 and out.select("id").distinct().count() == 400
    stack = tuning.fit_stack(bases, df, "id", 3)
    scored = models.scored_predictions(stack, df, "id", "stack")
    assert scored.count() == 400
    assert evaluate.roc_auc(scored).first().auc > 0.75


def test_fits_of_a_stack_run_side_by_side(data):
    """All folds and refits of all bases are under way at once."""
    from threading import Barrier

    df, _ = data
    together = Barrier(8)

    class Waiting:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, rows):
            together.wait(timeout=60)
            return self.estimator.fit(rows)

    plain = {"tree": models.decision_tree(max_depth=3), "linear": models.logistic(400.0)}
    stack = tuning.fit_stack({n: Waiting(e) for n, e in plain.items()}, df, "id", 3)
    level = df.select("id", "label", "weight")
    for name, estimator in plain.items():
        level = level.join(tuning.out_of_fold(estimator, df, "id", 3).withColumnRenamed("score", name), "id")
    top = models.logistic(models.weight_sum(df)).fit(VectorAssembler(inputCols=list(plain), outputCol="features").transform(level))
    assert list(stack.bases) == list(plain) and list(stack.top.coefficients) == pytest.approx(list(top.coefficients), rel=1e-6)


def test_permutation_importance_ranks_signal_over_noise(data):
    df, _ = data
    plain = df.drop("features")
    assembler = VectorAssembler(inputCols=["x", "noise"], outputCol="features")
    model = models.random_forest(10, 4).fit(assembler.transform(plain))
    drops = dict(tuning.permutation_importance(model, plain, "id", ["x", "noise"], assembler).collect())
    assert drops["x"] > 0.2 > drops["noise"]


def test_word_vectors(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a", "b"],)], "t array<string>")
    rows = features.word_vectors(df, "t", size=4).collect()
    assert {r.word for r in rows} == {"a", "b", "c"} and all(len(r.vec) == 4 for r in rows)


def test_univariate_curves(data):
    df, _ = data
    rows = {r.feature: r for r in models.univariate_logistic(df, ["x", "noise"]).collect()}
    assert rows["x"].slope > 1 > abs(rows["noise"].slope)
