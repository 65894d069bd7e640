"""Parameter search guided by Parzen estimators over the trials so far.

The trials are parted into the few best and the others. For each parameter the
places of either group, on a scale from 0 to 1, give a density: a wide bell
around the middle and a narrower one per trial. New points are drawn from the
density of the good ones, and the one with the largest ratio of the two
densities is tried. Points that run at the same time count as others until
they are known, so that trials side by side do not crowd.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from tabloom.operators.models import auc
from tabloom.operators.tuning import Range, _side_by_side

STARTUP = 5
GOOD_SHARE = 0.15
CANDIDATES = 24
WIDTH, LEAST_WIDTH = 0.25, 0.03


def _to_unit(value: float, kind: str, low: float, high: float) -> float:
    if high <= low:
        return 0.5
    if kind == "log":
        return (math.log(value) - math.log(low)) / (math.log(high) - math.log(low))
    if kind == "int":
        return (value - low + 0.5) / (high - low + 1)
    return (value - low) / (high - low)


def _from_unit(place: float, kind: str, low: float, high: float):
    place = min(max(place, 0.0), 1.0)
    if kind == "log":
        return min(max(math.exp(math.log(low) + place * (math.log(high) - math.log(low))), low), high)
    if kind == "int":
        return min(int(low) + int(place * (int(high) - int(low) + 1)), int(high))
    return min(low + place * (high - low), high)


def _bells(places: Sequence[float]) -> list[tuple[float, float]]:
    """(middle, width) of the parts of a density, the wide one first; the others narrow slowly with their number."""
    width = max(LEAST_WIDTH, WIDTH * max(1, len(places)) ** -0.2)
    return [(0.5, 1.0), *[(place, width) for place in sorted(places)]]


def _density(place: float, bells: Sequence[tuple[float, float]]) -> float:
    """Mean of the bells, each cut to [0, 1] and scaled to a mass of 1."""
    total = 0.0
    for middle, width in bells:
        mass = (math.erf((1 - middle) / (width * math.sqrt(2))) - math.erf((0 - middle) / (width * math.sqrt(2)))) / 2
        total += math.exp(-((place - middle) ** 2) / (2 * width * width)) / (width * math.sqrt(2 * math.pi) * mass)
    return total / len(bells)


def _drawn(bells: Sequence[tuple[float, float]], source: random.Random) -> float:
    middle, width = source.choice(bells)
    while True:
        place = source.gauss(middle, width)
        if 0 <= place <= 1:
            return place


def propose(space: dict[str, Range], done: Sequence[tuple[dict, float]], pending: Sequence[dict], source: random.Random) -> dict:
    """The next point to try; `done` holds points with scores, larger is better, `pending` those that still run."""
    if len(done) < STARTUP:
        return {name: _from_unit(source.random(), *range_) for name, range_ in space.items()}
    ranked = sorted(done, key=lambda trial: -trial[1])
    count = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    good, others = [p for p, _ in ranked[:count]], [p for p, _ in ranked[count:]] + list(pending)
    point = {}
    for name, range_ in space.items():
        near, far = (_bells([_to_unit(p[name], *range_) for p in points]) for points in (good, others))
        places = [_drawn(near, source) for _ in range(CANDIDATES)]
        point[name] = _from_unit(max(places, key=lambda x: math.log(_density(x, near)) - math.log(_density(x, far))), *range_)
    return point


def guided_trials(
    evaluate: Callable[[list[dict]], list[float]], space: dict[str, Range], trials: int, at_once: int = 1, seed: int = 42
) -> list[tuple[dict, float]]:
    """`trials` points with their scores, in the order in which they were proposed.

    `evaluate` scores a list of up to `at_once` points. Which of them ends
    first does not matter: the table is the same on every run with one seed.
    """
    source, done = random.Random(seed), []
    while len(done) < trials:
        batch: list[dict] = []
        while len(batch) < min(at_once, trials - len(done)):
            batch.append(propose(space, done, batch, source))
        done += list(zip(batch, evaluate(batch)))
    return done


def guided_search(
    build: Callable[..., Estimator],
    space: dict[str, Range],
    train: DataFrame,
    valid: DataFrame,
    trials: int = 20,
    seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """(trial, params, auc, best): parameter sets fitted on `train` and scored on `valid`, `parallelism` at a time."""

    def evaluate(points: list[dict]) -> list[float]:
        return _side_by_side(train, lambda p: auc(build(**p).fit(train), valid), points, parallelism)

    found = guided_trials(evaluate, space, trials, parallelism, seed)
    top = max(range(len(found)), key=lambda k: found[k][1])
    rows = [(k, ", ".join(f"{n}={v:.6g}" for n, v in p.items()), float(score), k == top) for k, (p, score) in enumerate(found)]
    return train.sparkSession.createDataFrame(rows, "trial int, params string, auc double, best boolean")
