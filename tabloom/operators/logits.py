"""Many logistic models at once by Newton steps on shared aggregates.

All models of a batch - columns of a univariate scan, folds, penalties, or all
of them crossed - see the same stored rows. In each step every batch of rows
meets the coefficients of every model that is not finished, and each task adds up
gradients and weighted Gram matrices of the rows that a model may use; one
aggregate, keyed by the model, adds up the tasks. What comes
to the driver is models x slots^2 numbers, whatever the number of rows; there
each model solves its small system. A batch takes as many jobs as its slowest
model takes steps, usually below ten, instead of a job chain per fit.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators import evaluate
from tabloom.operators.gram import LINEAR, TOTAL

STEPS = 50
TOLERANCE = 1e-10
#: The most numbers that one step may bring to the driver.
DRIVER_CELLS = 20_000_000


@dataclass(frozen=True)
class Logit:
    """A model to be fitted: its slots of the feature array, the strength C of the summed loss (None: no penalty), the
    kind of penalty, and the fold that it must not see. The intercept is never penalised."""

    name: str
    slots: tuple[int, ...]
    C: float | None = 1.0
    l1: bool = False
    held: int | None = None


@dataclass
class Fitted:
    spec: Logit
    beta: np.ndarray = field(default=None)  # one per slot, the intercept last
    steps: int = 0
    done: bool = False
    loss: float = np.inf
    previous: np.ndarray = field(default=None)


def _design(models: list[Fitted], width: int) -> Column:
    """The models as one constant array; missing slots point beyond every feature array."""
    rows = [
        {"model": m.spec.name, "held": m.spec.held, "slots": [*m.spec.slots, *[-1] * (width - len(m.spec.slots))], "beta": [*m.beta.tolist()[:-1], *[0.0] * (width - len(m.spec.slots)), float(m.beta[-1])]}
        for m in models
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<model:string,held:int,slots:array<int>,beta:array<double>>>")


def _met(df: DataFrame, models: list[Fitted], features: str, kept: Sequence[str]) -> tuple[DataFrame, int]:
    """Each row with each model: the model's slots of it as `__x`, with a one at the end, and the linear score `__z`."""
    width = max(len(m.spec.slots) for m in models)
    met = df.select(*kept, features, F.explode(_design(models, width)).alias("__m"))
    used = [F.when(F.get("__m.slots", F.lit(k)) < 0, 0.0).otherwise(F.get(F.col(features), F.get("__m.slots", F.lit(k)))) for k in range(width)]
    met = met.select(*kept, F.col("__m.model").alias("model"), F.col("__m.held").alias("held"), F.col("__m.beta").alias("__beta"), F.array(*used, F.lit(1.0)).alias("__x"))
    score = F.lit(0.0)
    for k in range(width + 1):
        score = score + F.col("__x")[k] * F.col("__beta")[k]
    return met.select(*kept, "model", "held", "__x", score.alias("__z")), width + 1


def _solve(beta: np.ndarray, gradient: np.ndarray, curve: np.ndarray, spec: Logit) -> np.ndarray:
    """The minimum of the quadratic model of the penalised loss around `beta`."""
    size = len(beta)
    strength = 0.0 if spec.C is None else 1.0 / spec.C
    if not spec.l1 or not strength:
        ridge = np.diag(np.append(np.full(size - 1, strength), 0.0))
        slope = gradient + ridge @ beta
        return beta - np.linalg.lstsq(curve + ridge, slope, rcond=1e-14)[0]
    bound = np.append(np.full(size - 1, strength), 0.0)
    offset, found = gradient - curve @ beta, beta.copy()
    for _ in range(2_000):
        moved = 0.0
        for k in range(size):
            own = curve[k, k]
            pull = own * found[k] - offset[k] - curve[k] @ found
            value = 0.0 if own < 1e-12 else np.sign(pull) * max(abs(pull) - bound[k], 0.0) / own
            moved, found[k] = max(moved, abs(value - found[k])), value
        if moved < TOLERANCE / 10:
            break
    return found


def _penalty(m: Fitted, beta: np.ndarray) -> float:
    if m.spec.C is None:
        return 0.0
    return float(np.abs(beta[:-1]).sum() if m.spec.l1 else (beta[:-1] ** 2).sum() / 2) / m.spec.C


def _advance(m: Fitted, gradient: np.ndarray, curve: np.ndarray, loss: float) -> None:
    """One Newton step of a model from the sums at its coefficients; back half the way when the last one raised the loss."""
    total = loss + _penalty(m, m.beta)
    m.steps += 1
    if m.previous is not None and total > m.loss + 1e-9 * abs(m.loss) and np.abs(m.beta - m.previous).max() > 1e-12:
        m.beta = (m.beta + m.previous) / 2
        return
    new = _solve(m.beta, gradient, curve, m.spec)
    m.done = bool(np.abs(new - m.beta).max() <= TOLERANCE * max(1.0, np.abs(new).max()))
    m.previous, m.beta, m.loss = m.beta, new, total


def _sums(df: DataFrame, models: list[Fitted], features: str, label: str, weight: str, fold: str | None) -> DataFrame:
    """(model, i, j, value): per model, by its place in the list, the sums over its rows at its coefficients: of weight *
    p * (1 - p) * x_i * x_j for i <= j, (i, LINEAR) of weight * (p - label) * x_i, and (0, TOTAL) of the loss."""
    slots = sorted({s for m in models for s in m.spec.slots})
    places = {s: k for k, s in enumerate(slots)}
    shared = [([places[s] for s in m.spec.slots], m.spec.held if fold else None, m.beta) for m in models]
    taken = [F.get(F.col(features), F.lit(s)).cast("double") for s in slots]
    held = F.col(fold).cast("int") if fold else F.lit(None).cast("int")
    ready = df.select(F.array(*taken, F.lit(1.0)).alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), held.alias("fold"))

    def known(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        there = column.is_valid().to_numpy(zero_copy_only=False)
        return np.where(there, column.to_numpy(zero_copy_only=False), 0.0), there

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curves = [np.zeros((len(own) + 1, len(own) + 1)) for own, _, _ in shared]
        gradients, losses = [np.zeros(len(own) + 1) for own, _, _ in shared], np.zeros(len(shared))
        for batch in batches:
            (x, there), (y, labelled), (w, weighted), (folds, folded) = (known(c) for c in (batch.column("x").flatten(), *batch.columns[1:]))
            x, there = x.reshape(-1, len(slots) + 1), there.reshape(-1, len(slots) + 1)
            for k, (own, held, beta) in enumerate(shared):
                used = weighted & there[:, own].all(axis=1)
                if held is not None:
                    used &= folded & (folds != held)
                some, given = x[used][:, [*own, len(slots)]], w[used]
                z = some @ beta
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-z))
                curves[k] += (some * (given * p * (1 - p))[:, None]).T @ some
                marked = labelled[used]
                some, given, z, truth = some[marked], given[marked], z[marked], y[used][marked]
                gradients[k] += some.T @ (given * (p[marked] - truth))
                losses[k] += (given * (np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))) - truth * z)).sum()
        for k, (curve, gradient) in enumerate(zip(curves, gradients)):
            i, j = np.triu_indices(len(curve))
            i = np.concatenate([i, np.arange(len(gradient)), [0]])
            j = np.concatenate([j, np.full(len(gradient), LINEAR), [TOTAL]])
            values = np.concatenate([curve[np.triu_indices(len(curve))], gradient, losses[k : k + 1]])
            columns = [pa.array(np.full(len(i), k), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, ["model", "i", "j", "value"])

    return ready.mapInArrow(run, "model int, i int, j int, value double").groupBy("model", "i", "j").agg(F.sum("value").alias("value"))


def fit_logits(
    df: DataFrame,
    specs: Sequence[Logit],
    features: str = "x",
    label: str = "label",
    weight: str = "weight",
    fold: str | None = None,
    steps: int = STEPS,
) -> list[Fitted]:
    """Fit all `specs` on the stored frame `df` (an array<double> of features, a 0/1 label, a weight, a fold if one is held).

    A row with an unknown value in a slot, label or weight is left out of the
    models that need it. Full Newton steps; one that raises the penalised loss
    is halved. A model ends when no coefficient moves by more than TOLERANCE of
    its size, or after `steps` steps, as one without penalty on separable rows
    does. Without rows, or with rows of one label and no penalty, coefficients
    stay where the last step left them.
    """
    models = [Fitted(s, np.zeros(len(s.slots) + 1)) for s in specs]
    if len({s.name for s in specs}) != len(specs):
        raise ValueError("models need names of their own")
    if sum((len(s.slots) + 1) ** 2 for s in specs) > DRIVER_CELLS:
        raise ValueError("too many coefficients for one batch; fit fewer models at once")
    for _ in range(steps):
        open_ = [m for m in models if not m.done]
        if not open_:
            break
        sizes = [len(m.beta) for m in open_]
        found = [(np.zeros(n), np.zeros((n, n)), [0.0]) for n in sizes]
        for k, i, j, value in _sums(df, open_, features, label, weight, fold).collect():
            gradient, curve, total = found[k]
            if j == TOTAL:
                total[0] = value
            elif j == LINEAR:
                gradient[i] = value
            else:
                curve[i, j] = curve[j, i] = value
        for m, (gradient, curve, (total,)) in zip(open_, found):
            _advance(m, gradient, curve, total)
    return models


def coefficients(models: Sequence[Fitted], df: DataFrame) -> DataFrame:
    """(model, slot, value): one row per coefficient, the intercept with slot -1."""
    rows = [(m.spec.name, int(s), float(b)) for m in models for s, b in zip((*m.spec.slots, -1), m.beta)]
    return df.sparkSession.createDataFrame(rows, "model string, slot int, value double")


def logit_scores(models: Sequence[Fitted], df: DataFrame, kept: Sequence[str], features: str = "x", fold: str | None = None) -> DataFrame:
    """(kept, model, held, score): the chance of label 1 by each model; with `fold` a column too, which `kept` must hold
    to tell the rows that a model has not seen (fold = held) from those it has."""
    met, _ = _met(df, list(models), features, list(kept))
    scored = met.select(*kept, "model", "held", (1 / (1 + F.exp(-F.col("__z")))).alias("score"))
    return scored if fold is None else scored.filter(F.col(fold) == F.col("held"))


def univariate(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """(feature, slope, intercept): one unpenalised logistic curve per column, all fitted together."""
    rows = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), F.col(label).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    models = fit_logits(rows, [Logit(c, (k,), None) for k, c in enumerate(columns)])
    found = [(m.spec.name, float(m.beta[0]), float(m.beta[1])) for m in models]
    return df.sparkSession.createDataFrame(found, "feature string, slope double, intercept double")


def cross_validated(df: DataFrame, size: int, folds: int, points: dict[str, tuple[float | None, bool]], features: str = "x", fold: str = "fold") -> tuple[list[Fitted], DataFrame]:
    """Models and a report (point, fold, train_auc, auc) of each parameter point (C, l1) on each fold.

    All points x folds, and one fit on all rows per point (fold null, auc null,
    train_auc over all rows), run as one batch.
    """
    slots = tuple(range(size))
    specs = [Logit(f"{name}|{'' if k is None else k}", slots, C, l1, k) for name, (C, l1) in points.items() for k in (None, *range(folds))]
    models = fit_logits(df, specs, features, fold=fold)
    scored = logit_scores(models, df, ["label", fold], features)
    side = F.when(F.col(fold) == F.col("held"), "auc").otherwise("train_auc")
    rows = scored.select("model", "held", side.alias("side"), F.col("label").cast("int").alias("truth"), F.round("score", 9).alias("score"))
    aucs = evaluate.roc_auc(rows, ["model", "held", "side"])
    point = F.substring_index("model", "|", 1)
    report = aucs.groupBy(point.alias("point"), F.col("held").alias("fold")).agg(
        F.max(F.when(F.col("side") == "train_auc", F.col("auc"))).alias("train_auc"), F.max(F.when(F.col("side") == "auc", F.col("auc"))).alias("auc")
    )
    return models, report


def grid_report(report: DataFrame) -> DataFrame:
    """(point, train_auc, cv_auc, cv_std, best) from the report of `cross_validated`; the population deviation over the folds."""
    means = report.groupBy("point").agg(
        F.max(F.when(F.col("fold").isNull(), F.col("train_auc"))).alias("train_auc"), F.avg("auc").alias("cv_auc"), F.stddev_pop("auc").alias("cv_std")
    )
    top = means.agg(F.max_by("point", F.struct("cv_auc", "point"))).scalar()
    return means.withColumn("best", F.col("point") == top)
