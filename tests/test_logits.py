"""Gram matrices, wide correlations and batched logistic fits against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import gram, logits, models
from tabloom.session import cut_lineage


def frame(spark, n=300, size=5, seed=1, missing=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) * np.arange(1, size + 1) + 3
    truth = np.linspace(-1, 1, size) / np.arange(1, size + 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x - 3) @ truth))).astype(float)
    w = rng.choice([0.5, 1.0, 2.0], n)
    rows = [(k, [None if rng.random() < missing else float(v) for v in x[k]], float(y[k]), float(w[k]), k % 3) for k in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, label double, weight double, fold int"), x, y, w


@pytest.mark.parametrize("size, block", [(5, 16), (5, 2), (7, 3), (4, 4)])
def test_gram_cells(spark, size, block):
    df, x, y, w = frame(spark, 60, size)
    found = gram.gram(df, "x", size, F.col("weight"), F.col("weight") * F.col("label"), [F.col("label"), F.lit(1.0)], ["fold"], block).collect()
    assert len(found) == 3 * (size * (size + 1) // 2 + size + 2)
    for r in found:
        own = np.arange(60) % 3 == r["fold"]
        if r["j"] == gram.TOTAL:
            expected = [y[own].sum(), own.sum()][r["i"]]
        elif r["j"] == gram.LINEAR:
            expected = (w * y * x[:, r["i"]])[own].sum()
        else:
            assert r["i"] <= r["j"]
            expected = (w * x[:, r["i"]] * x[:, r["j"]])[own].sum()
        assert r["value"] == pytest.approx(expected)


def test_the_plan_does_not_grow_with_the_columns(spark):
    wide = spark.range(10).select(F.transform(F.sequence(F.lit(0), F.lit(499)), lambda i: F.rand() + i).alias("x"))
    plan = gram.wide_correlations(wide, "x", 500)._jdf.queryExecution().analyzed().toString()
    assert plan.count("sum(") < 2_000


def test_five_hundred_columns(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 10))
    x = base @ rng.normal(size=(10, 500)) + 0.1 * rng.normal(size=(40, 500)) + 1e6
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    found = gram.wide_correlations(df, "x", 500).toPandas()
    expected = np.corrcoef(x.T)
    assert len(found) == 500 * 499 // 2
    assert np.allclose(found["corr"], expected[found["left"].astype(int), found["right"].astype(int)], atol=1e-8)


def test_correlations_of_common_rows_only(spark):
    df, *_ = frame(spark, 80, 4, missing=0.2)
    flat = df.select(*[F.col("x")[k].alias(f"c{k}") for k in range(4)], F.lit(7.0).alias("flat"))
    found = {(r["left"], r["right"]): r["corr"] for r in gram.wide_correlations(flat, flat.columns, block=2).collect()}
    assert len(found) == 10 and all(found[f"c{k}", "flat"] is None for k in range(4))
    data = flat.toPandas()
    for (a, b), value in found.items():
        if b != "flat":
            assert value == pytest.approx(data[a].corr(data[b]))


def by_newton(x, y, w, ridge):
    x = np.column_stack([x, np.ones(len(x))])
    beta, bound = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta - np.linalg.solve((x.T * (w * p * (1 - p))) @ x + np.diag(bound), x.T @ (w * (p - y)) + bound * beta)
    return beta


def test_batch_of_subsets_folds_and_strengths(spark):
    df, x, y, w = frame(spark)
    specs = [
        logits.Logit("all", tuple(range(5)), 0.5),
        logits.Logit("two", (4, 1), None),
        logits.Logit("fold", (0, 2, 3), 10.0, held=1),
    ]
    fitted = {m.spec.name: m for m in logits.fit_logits(df, specs, fold="fold")}
    kept = np.arange(300) % 3 != 1
    assert np.allclose(fitted["all"].beta, by_newton(x, y, w, 2.0), atol=1e-8)
    assert np.allclose(fitted["two"].beta, by_newton(x[:, [4, 1]], y, w, 0.0), atol=1e-8)
    assert np.allclose(fitted["fold"].beta, by_newton(x[kept][:, [0, 2, 3]], y[kept], w[kept], 0.1), atol=1e-8)
    assert all(m.done and m.steps < 12 for m in fitted.values())
    scores = logits.logit_scores([fitted["fold"], fitted["two"]], df, ["id", "fold"], fold="fold").collect()
    assert {r["model"] for r in scores} == {"fold"} and len(scores) == 100
    r = scores[0]
    z = x[r["id"]][[0, 2, 3]] @ fitted["fold"].beta[:-1] + fitted["fold"].beta[-1]
    assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)))
    assert logits.coefficients(list(fitted.values()), df).count() == 6 + 3 + 4


@pytest.mark.parametrize("C", [0.02, 0.3, 50.0])
def test_lasso_optimality(spark, C):
    """The slope of the loss is within the bound where a coefficient is zero, and at the bound elsewhere."""
    df, x, y, w = frame(spark, size=6)
    (m,) = logits.fit_logits(df, [logits.Logit("l1", tuple(range(6)), C, True)])
    p = 1 / (1 + np.exp(-(x @ m.beta[:-1] + m.beta[-1])))
    slope = x.T @ (w * (p - y))
    zero = m.beta[:-1] == 0
    assert m.done and abs((w * (p - y)).sum()) < 1e-6
    assert (np.abs(slope[zero]) <= 1 / C + 1e-6).all()
    assert np.allclose(slope[~zero], -np.sign(m.beta[:-1][~zero]) / C, atol=1e-6)
    assert zero.any() or C > 0.1


def test_steps_that_overshoot_are_halved(spark):
    """A far outlier makes the second full step raise the loss."""
    x = np.concatenate([np.linspace(-1, 1, 40), [400.0, -380.0]])
    y = np.concatenate([(np.arange(40) % 3 > 0).astype(float), [1.0, 1.0]])
    df = spark.createDataFrame([([float(a)], float(b), 1.0) for a, b in zip(x, y)], "x array<double>, label double, weight double")
    (m,) = logits.fit_logits(df, [logits.Logit("one", (0,), None)])
    p = 1 / (1 + np.exp(-(x * m.beta[0] + m.beta[1])))
    assert m.done and abs((p - y).sum()) < 1e-6 and abs(((p - y) * x).sum()) < 1e-4


def test_odd_rows(spark):
    df, x, y, w = frame(spark, 100, 2)
    extra = spark.createDataFrame([(1, [None, 1.0], 1.0, 1.0, 0), (2, [1.0, 2.0], None, 1.0, 0), (3, [1.0, 2.0], 1.0, None, 0)], df.schema)
    (m,) = logits.fit_logits(df.unionByName(extra), [logits.Logit("m", (0, 1), 1.0)])
    assert np.allclose(m.beta, by_newton(x, y, w, 1.0), atol=1e-8)
    (empty,) = logits.fit_logits(df.filter("id < 0"), [logits.Logit("m", (0, 1), 1.0)])
    assert empty.beta.tolist() == [0, 0, 0]
    (split,) = logits.fit_logits(df.withColumn("label", (F.col("x")[0] > 3).cast("double")), [logits.Logit("m", (0,), None)], steps=12)
    assert not split.done and split.beta[0] > 3
    with pytest.raises(ValueError):
        logits.fit_logits(df, [logits.Logit("m", (0,)), logits.Logit("m", (1,))])


def test_cross_validation_and_report(spark):
    df, *_ = frame(spark)
    df = cut_lineage(df)
    fitted, report = logits.cross_validated(df, 5, 3, {"a": (1.0, False), "b": (0.001, True)})
    assert len(fitted) == 8
    rows = {(r["point"], r["fold"]): r for r in report.collect()}
    assert rows["a", None]["auc"] is None and rows["b", 0]["auc"] == 0.5 and rows["a", 2]["train_auc"] > 0.7
    best = logits.grid_report(report).filter("best").collect()
    assert [r["point"] for r in best] == ["a"]
    assert best[0]["cv_auc"] == pytest.approx(np.mean([rows["a", k]["auc"] for k in range(3)]))


def test_univariate_curves_match_single_fits(spark):
    df, *_ = frame(spark)
    flat = cut_lineage(df.select("label", F.col("x")[0].alias("a"), F.col("x")[4].alias("b")))
    found = {r["feature"]: r for r in logits.univariate(flat, ["a", "b"]).collect()}
    for r in models.univariate_logistic(flat, ["a", "b"]).collect():
        assert found[r["feature"]]["slope"] == pytest.approx(r["slope"], rel=1e-3)
        assert found[r["feature"]]["intercept"] == pytest.approx(r["intercept"], rel=1e-3)


def test_sums_of_many_models_without_a_row_per_model(spark):
    """Subsets, folds and unknown cells; rows are not multiplied by the models on the way."""
    rng = np.random.default_rng(11)
    x, y, w, fold = rng.normal(size=(300, 4)), rng.integers(0, 2, 300), rng.uniform(0.5, 2.0, 300), rng.integers(0, 3, 300)
    rows = [([None if (i + k) % 50 == 0 else float(v) for k, v in enumerate(r)], float(y[i]), float(w[i]), int(fold[i])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "x array<double>, label double, weight double, fold int").repartition(3)
    specs = [logits.Logit(f"{s} {h}", s, held=h) for s in ((0, 1, 2, 3), (3, 1), ()) for h in (None, 0, 2)]
    fitted = [logits.Fitted(s, rng.normal(size=len(s.slots) + 1)) for s in specs]
    sums = logits._sums(df, fitted, "x", "label", "weight", "fold")
    assert "Generate" not in sums._jdf.queryExecution().executedPlan().toString()
    found = {(r["model"], r["i"], r["j"]): r["value"] for r in sums.collect()}
    for k, m in enumerate(fitted):
        used = [i for i in range(300) if fold[i] != m.spec.held and all(rows[i][0][s] is not None for s in m.spec.slots)]
        own = np.column_stack([x[used][:, list(m.spec.slots)], np.ones(len(used))])
        z = own @ m.beta
        p = 1 / (1 + np.exp(-z))
        curve, slope = own.T @ (own * (w[used] * p * (1 - p))[:, None]), own.T @ (w[used] * (p - y[used]))
        for i in range(len(m.beta)):
            assert found[k, i, logits.LINEAR] == pytest.approx(slope[i])
            assert all(found[k, i, j] == pytest.approx(curve[i, j]) for j in range(i, len(m.beta)))
        assert found[k, 0, logits.TOTAL] == pytest.approx((w[used] * (np.logaddexp(0, z) - y[used] * z)).sum())
