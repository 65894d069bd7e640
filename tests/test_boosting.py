"""Leaf-wise boosting against a direct search over all splits, and what ends it."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import attribution, boosting
from tabloom.operators.boosting import Boosting
from tabloom.session import cut_lineage

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    source = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = float(source.randrange(12)), float(source.randrange(5)), source.choice([None, 1.0, 2.0, 3.0])
        z = (a > 6) * 1.5 + (b < 2) * (a > 3) * 2 - (c is None) * 1.5 - 1 + source.gauss(0, 0.7)
        rows.append((i, a, b, c, float(z > 0), source.choice([1.0, 2.0]), i % 4 == 0))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double, weight double, held boolean")
    return rows, cut_lineage(df)


def directly(rows, margin, s, leaves):
    """One tree by trying every feature and threshold of every leaf; {leaf rows: value} as a list of (ids, value)."""
    def value_of(row, k):
        return math.inf if row[1 + k] is None else row[1 + k]

    def sums(ids):
        g = h = 0.0
        for i in ids:
            p = 1 / (1 + math.exp(-margin[i]))
            g += rows[i][5] * (p - rows[i][4])
            h += rows[i][5] * p * (1 - p)
        return g, h

    def score(ids):
        g, h = sums(ids)
        return max(abs(g) - s.lambda_l1, 0) ** 2 / (h + s.lambda_l2)

    def best(ids):
        found = (0.0, None)
        for k in range(3):
            for t in sorted({value_of(rows[i], k) for i in ids})[:-1]:
                left, right = [i for i in ids if value_of(rows[i], k) <= t], [i for i in ids if value_of(rows[i], k) > t]
                if min(len(left), len(right)) >= s.min_rows:
                    gain = score(left) + score(right) - score(ids)
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
        return found

    open_ = [(*best(list(margin)), list(margin))]
    while len(open_) < leaves:
        top = max(range(len(open_)), key=lambda n: open_[n][0])
        gain, parts, _ = open_[top]
        if not parts:
            break
        open_[top : top + 1] = [(*best(p), p) for p in parts]
    out = []
    for _, _, ids in open_:
        g, h = sums(ids)
        out.append((ids, -s.learning_rate * math.copysign(max(abs(g) - s.lambda_l1, 0), g) / (h + s.lambda_l2)))
    return out


@pytest.mark.parametrize("leaves, l1, l2", [(2, 0.0, 0.0), (6, 0.0, 1.0), (9, 2.0, 0.5)])
def test_trees_equal_a_direct_search(data, leaves, l1, l2):
    rows, df = data
    s = Boosting(rounds=3, learning_rate=0.3, num_leaves=leaves, lambda_l1=l1, lambda_l2=l2, min_rows=5)
    model = boosting.fit_leafwise(df, COLUMNS, ["id"], s)
    weight = sum(r[5] for r in rows)
    share = sum(r[5] * r[4] for r in rows) / weight
    margin = {r[0]: math.log(share / (1 - share)) for r in rows}
    for number in range(3):
        for ids, value in directly(rows, dict(margin), s, leaves):
            for i in ids:
                margin[i] += value
        ready = boosting.binned(df, COLUMNS, model.edges, ["id"]).select("id", model.margin(number + 1).alias("m"))
        assert {r["id"]: r["m"] for r in ready.collect()} == pytest.approx(margin, abs=1e-9)
    assert model.best == 3
    scores = {r["id"]: r["score"] for r in model.scores(df, ["id"]).collect()}
    assert scores == pytest.approx({i: 1 / (1 + math.exp(-m)) for i, m in margin.items()})


def test_stops_where_the_full_fit_is_best_and_reads_no_more(data):
    _, df = data
    s = dict(learning_rate=0.5, num_leaves=8, min_rows=3)
    full = boosting.fit_leafwise(df, COLUMNS, ["id"], Boosting(rounds=14, **s), valid=F.col("held"))
    short = boosting.fit_leafwise(df, COLUMNS, ["id"], Boosting(rounds=14, patience=4, **s), valid=F.col("held"))
    assert len(full.losses) == 15 and full.best == int(np.argmin(full.losses))
    assert short.best == full.best and short.losses == pytest.approx(full.losses[: len(short.losses)])
    assert len(short.trees) <= short.best + 4 < 14
    held = df.filter("held").join(short.scores(df, ["id"]), "id")
    loss = held.agg(F.sum(-F.col("weight") * F.log(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score")))) / F.sum("weight")).first()[0]
    assert loss == pytest.approx(short.losses[short.best])


def test_limits_of_trees(data):
    _, df = data
    deep = boosting.fit_leafwise(df, COLUMNS, ["id"], Boosting(rounds=1, num_leaves=40, max_depth=2, min_rows=1))

    def depth(n):
        return max(depth(n.left), depth(n.right)) + 1 if n.chosen else 0

    assert depth(deep.trees[0]) == 2
    strict = boosting.fit_leafwise(df, COLUMNS, ["id"], Boosting(rounds=1, min_rows=150))
    counts = [n["cover"] for n in strict.nodes(df).filter("left < 0").collect()]
    assert min(counts) >= 150 and sum(counts) == 400
    flat = boosting.fit_leafwise(df, COLUMNS, ["id"], Boosting(rounds=1, lambda_l1=1e6))
    assert not flat.trees[0].chosen and flat.trees[0].value == 0


def test_bags_and_feature_draws_repeat(data):
    _, df = data
    s = Boosting(rounds=4, num_leaves=4, feature_fraction=0.67, bagging_fraction=0.5, bagging_freq=2)
    one, two = (boosting.fit_leafwise(d, COLUMNS, ["id"], s) for d in (df, df.repartition(5)))
    a, b = ({r["id"]: r["score"] for r in m.scores(df, ["id"]).collect()} for m in (one, two))
    assert a == pytest.approx(b)
    assert all(t.sums[2] < 300 for t in one.trees) and one.trees[0].sums[2] == one.trees[1].sums[2] != one.trees[2].sums[2]


def test_attributions_explain_the_margin(data):
    _, df = data
    model = boosting.fit_leafwise(df, COLUMNS, ["id"], Boosting(rounds=3, num_leaves=5))
    paths = cut_lineage(attribution.tree_paths(cut_lineage(model.nodes(df))))
    rows = df.filter("c IS NOT NULL").select("id", F.array(*COLUMNS).alias("x"))
    sums = attribution.tree_attribution(rows, paths, ["id"], 3).groupBy("id").agg(F.sum("value").alias("v")).collect()
    margin = {r["id"]: r["m"] for r in boosting.binned(df, COLUMNS, model.edges, ["id"]).select("id", model.margin().alias("m")).collect()}
    base = attribution.expected_score(paths)
    assert {r["id"]: r["v"] for r in sums} == pytest.approx({r["id"]: margin[r["id"]] - model.base - base for r in sums})


def test_one_label_and_no_rows(data):
    _, df = data
    one = boosting.fit_leafwise(df.filter("label = 1"), COLUMNS, ["id"], Boosting(rounds=2))
    assert one.trees == [] and one.base == 15.0
    none = boosting.fit_leafwise(df.filter("id < 0"), COLUMNS, ["id"], Boosting(rounds=2))
    assert none.trees == [] and none.base == 0.0


def test_passes_and_scores_read_batches(spark, data, monkeypatch):
    """Every pass has a plan without the trees, its tasks follow the rows, and scores equal the margin as an expression."""
    rows, df = data
    seen = []
    plain = boosting._histograms

    def watched(stored, look):
        seen.append((stored.rdd.getNumPartitions(), len(stored._jdf.queryExecution().analyzed().toString())))
        return plain(stored, look)

    monkeypatch.setattr(boosting, "_histograms", watched)
    monkeypatch.setattr(boosting, "TASK_ROWS", 150)
    odd = df.withColumn("c", F.when(F.col("id") == 7, float("nan")).otherwise(F.col("c"))).repartition(40)
    model = boosting.fit_leafwise(odd, COLUMNS, ["id"], Boosting(rounds=12, num_leaves=6, min_rows=5), valid=F.col("held"))
    assert {n for n, _ in seen} == {3} and len({size for _, size in seen[:4]}) == 1
    twice = odd.unionByName(odd)
    scored = model.scores(twice, ["id"])
    assert "MapInArrow" in scored._jdf.queryExecution().executedPlan().toString()
    binned = boosting.binned(twice, COLUMNS, model.edges, ["id", "label"])
    places = {r.id: r.bins for r in binned.collect()}
    for i, a, b, c, *_ in rows:
        for k, v in enumerate((a, b, None if i == 7 else c)):
            assert places[i][k] == (len(model.edges[k]) + 1 if v is None else sum(e < v for e in model.edges[k]))
    direct = binned.select("id", (1 / (1 + F.exp(-model.margin()))).alias("score"))
    assert np.allclose(sorted(map(tuple, scored.collect())), sorted(map(tuple, direct.collect())), atol=1e-12)
    assert scored.count() == 800
