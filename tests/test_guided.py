"""The guided search against random draws, its ranges and its repeatability."""

import math
import random

import pytest

from tabloom.operators import guided, tuning

SPACE = {"rate": ("log", 1e-4, 1e-1), "share": ("uniform", 0.4, 1.0), "leaves": ("int", 2, 40)}


def score(p):
    return -((math.log10(p["rate"]) + 2.3) ** 2) - 8 * (p["share"] - 0.85) ** 2 - ((p["leaves"] - 28) / 20) ** 2


def test_better_than_random_at_twenty_trials():
    wins, ours, theirs = 0, 0.0, 0.0
    for seed in range(60):
        guided_best = max(s for _, s in guided.guided_trials(lambda ps: [score(p) for p in ps], SPACE, 20, 1, seed))
        drawn_best = max(score(p) for p in tuning.draw(SPACE, 20, seed))
        wins += guided_best > drawn_best
        ours, theirs = ours + guided_best / 60, theirs + drawn_best / 60
    assert wins >= 38 and ours > 0.7 * theirs  # scores are negative, 0 is best


def test_trials_side_by_side_stay_apart_and_are_still_better():
    ours = [max(s for _, s in guided.guided_trials(lambda ps: [score(p) for p in ps], SPACE, 20, 4, seed)) for seed in range(60)]
    theirs = [max(score(p) for p in tuning.draw(SPACE, 20, seed)) for seed in range(60)]
    assert sum(ours) > 0.8 * sum(theirs)
    source, done = random.Random(1), [(p, score(p)) for p in tuning.draw(SPACE, 30, 3)]
    batch = []
    for _ in range(4):
        batch.append(guided.propose(SPACE, done, batch, source))
    places = sorted(guided._to_unit(p["rate"], *SPACE["rate"]) for p in batch)
    assert places[-1] - places[0] > 0.02


def test_points_stay_in_their_ranges_and_repeat():
    runs = [guided.guided_trials(lambda ps: [score(p) for p in ps], SPACE, 25, 3, 9) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 25
    assert all(1e-4 <= p["rate"] <= 1e-1 and 0.4 <= p["share"] <= 1 and p["leaves"] in range(2, 41) for p, _ in runs[0])


@pytest.mark.parametrize("kind, low, high", [("log", 1e-3, 10.0), ("uniform", -1.0, 1.0), ("int", 0, 9), ("uniform", 2.0, 2.0)])
def test_scales_go_both_ways(kind, low, high):
    for place in (0.0, 0.31, 1.0):
        value = guided._from_unit(place, kind, low, high)
        assert low <= value <= high
        assert guided._from_unit(guided._to_unit(value, kind, low, high), kind, low, high) == pytest.approx(value)


def test_densities_have_a_mass_of_one():
    bells = guided._bells([0.0, 0.1, 0.12, 0.9])
    assert sum(guided._density((k + 0.5) / 2000, bells) for k in range(2000)) / 2000 == pytest.approx(1.0, abs=1e-3)


def test_search_fits_and_reports(spark):
    from pyspark.ml.feature import VectorAssembler

    from tabloom.operators import models

    source = random.Random(2)
    rows = [(float(source.gauss(0, 1)), float(source.gauss(0, 1))) for _ in range(200)]
    df = spark.createDataFrame([(x, z, float(x + 0.3 * z > 0), 1.0) for x, z in rows], "x double, z double, label double, weight double")
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).cache()
    report = guided.guided_search(models.decision_tree, {"max_depth": ("int", 1, 6), "min_rows": ("int", 1, 40)}, df, df, trials=8).collect()
    assert [r["trial"] for r in report] == list(range(8)) and sum(r["best"] for r in report) == 1
    assert max(r["auc"] for r in report) == next(r["auc"] for r in report if r["best"]) > 0.9
