"""Marginals and slopes of the tag model against all taggings, and what it learns."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import learned_tags, sequence
from tabloom.session import cut_lineage

TAGS = ["A", "B", "C"]
SIZE = 7


@pytest.fixture(scope="module")
def short(spark):
    source = random.Random(3)
    rows = []
    for i in range(25):
        n = source.randrange(1, 5)
        rows.append((i, [[source.randrange(SIZE) for _ in range(2)] for _ in range(n)], [source.choice(TAGS) for _ in range(n)]))
    return rows, spark.createDataFrame(rows, "id long, features array<array<int>>, tags array<string>")


def random_model(seed=5):
    rng = np.random.default_rng(seed)
    return learned_tags.TagModel(TAGS, rng.normal(size=(SIZE, 3)), rng.normal(size=(4, 4)), [])


def score(model, features, path):
    total = model.step[3, path[0]] + model.step[path[-1], 3]
    total += sum(model.step[a, b] for a, b in zip(path, path[1:]))
    return total + sum(model.emit[f, t] for fs, t in zip(features, path) for f in fs)


def taggings(model, features):
    """Every tagging with its chance, and the log-partition."""
    paths = list(itertools.product(range(3), repeat=len(features)))
    scores = np.array([score(model, features, p) for p in paths])
    whole = scores.max() + math.log(np.exp(scores - scores.max()).sum())
    return paths, np.exp(scores - whole), whole


def counts(features, path):
    emit, step = np.zeros((SIZE, 3)), np.zeros((4, 4))
    for fs, t in zip(features, path):
        for f in fs:
            emit[f, t] += 1
    step[3, path[0]] += 1
    step[path[-1], 3] += 1
    for a, b in zip(path, path[1:]):
        step[a, b] += 1
    return emit, step


def test_marginals_equal_enumeration(short):
    rows, df = short
    model = random_model()
    found = dict(learned_tags.tag_marginals(learned_tags.with_learned_emissions(df, model), ["id"]).collect())
    for i, features, _ in rows:
        paths, chances, _ = taggings(model, features)
        for k in range(len(features)):
            expected = [sum(c for p, c in zip(paths, chances) if p[k] == t) for t in range(3)]
            assert found[i][k] == pytest.approx(expected, abs=1e-12)


def test_marginals_fold_many_sentences_at_once(spark, short, monkeypatch):
    """No fold in the rows; two taggers in one frame, repeated keys, no scores, and a long sentence."""
    rows, df = short
    models = [random_model(5), random_model(6)]
    long = spark.createDataFrame([(99, [[i % SIZE] for i in range(3000)], ["A"] * 3000), (0, *rows[0][1:])], df.schema)
    parts = [learned_tags.with_learned_emissions(d, m) for d, m in zip((df, df.unionByName(long)), models)]
    scored = parts[0].withColumn("m", F.lit(0)).unionByName(parts[1].withColumn("m", F.lit(1)))
    scored = scored.withColumn("emit", F.when((F.col("m") == 0) | (F.col("id") != 1), F.col("emit")))
    monkeypatch.setattr(learned_tags, "CELLS", 40)
    found = learned_tags.tag_marginals(scored.coalesce(1), ["m", "id"])
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    listed = [(r.m, r.id, r.marginals) for r in found.collect()]
    assert len(listed) == 52 and [x for x in listed if x[1] == 0 and x[0] == 1][0] == [x for x in listed if x[1] == 0 and x[0] == 1][1]
    known = {(m, i): x for m, i, x in listed}
    assert known[1, 1] is None
    for i, features, _ in rows:
        for m, model in enumerate(models):
            if (m, i) != (1, 1):
                paths, chances, _ = taggings(model, features)
                expected = [[sum(c for p, c in zip(paths, chances) if p[at] == t) for t in range(3)] for at in range(len(features))]
                assert np.allclose(known[m, i], expected, atol=1e-12)
    assert len(known[1, 99]) == 3000 and np.allclose(np.sum(known[1, 99], axis=1), 1.0)


def test_slope_equals_enumeration(short):
    rows, df = short
    model = random_model(8)
    emit, step, loss = np.zeros((SIZE, 3)), np.zeros((4, 4)), 0.0
    for _, features, tags in rows:
        given = [TAGS.index(t) for t in tags]
        paths, chances, whole = taggings(model, features)
        loss += whole - score(model, features, given)
        for path, chance in [*zip(paths, chances), (given, -1.0)]:
            own = counts(features, path)
            emit += chance * own[0]
            step += chance * own[1]
    found_emit, found_step = np.zeros((SIZE, 3)), np.zeros((4, 4))
    for r in learned_tags.count_differences(learned_tags.with_learned_emissions(df, model)).collect():
        if r["kind"] == "loss":
            assert r["value"] == pytest.approx(loss)
        else:
            (found_emit if r["kind"] == "emit" else found_step)[r["slot"], r["tag"]] = r["value"]
    assert np.allclose(found_emit, emit, atol=1e-9) and np.allclose(found_step, step, atol=1e-9)


def test_summed_differences_equal_the_expressions(short, spark, monkeypatch):
    """Many sentences folded at once, runs of one to a few sentences, and a token without features."""
    _, df = short
    df = df.unionByName(spark.createDataFrame([(100, [[1, 2], [], [3]], ["A", "C", "B"])], df.schema))
    model = random_model(4)
    scored = learned_tags.with_learned_emissions(df, model)
    expected = {(r["kind"], r["slot"], r["tag"]): r["value"] for r in learned_tags.count_differences(scored).collect()}
    for cells in (9, 60, learned_tags.CELLS):
        monkeypatch.setattr(learned_tags, "CELLS", cells)
        found = {(r["kind"], r["slot"], r["tag"]): r["value"] for r in learned_tags.summed_differences(df, model).collect()}
        assert set(found) <= set(expected)
        assert all(found.get(cell, 0.0) == pytest.approx(value, abs=1e-9) for cell, value in expected.items())


def test_a_step_of_the_fit_moves_one_table_of_sums_per_task(short):
    """The sums are added up inside the tasks: no row per token, feature and tag stands in the plan of a step."""
    plan = learned_tags.summed_differences(short[1], random_model())._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_learned_scores_work_with_the_path_operators(short):
    rows, df = short
    model = random_model(2)
    scored = learned_tags.with_learned_emissions(df, model)
    nll = dict(sequence.negative_log_likelihood(scored, ["id"]).collect())
    best = {r["id"]: r for r in sequence.decode_paths(scored, ["id"]).collect()}
    for i, features, tags in rows:
        paths, chances, whole = taggings(model, features)
        assert nll[i] == pytest.approx(whole - score(model, features, [TAGS.index(t) for t in tags]))
        assert best[i]["score"] == pytest.approx(whole + math.log(chances.max()))


@pytest.fixture(scope="module")
def chain(spark):
    """The tag of a word depends on its ending and on the tag before; many words of the last sentences are new."""
    source = random.Random(1)
    rows = []
    for i in range(160):
        words, tags = [], []
        for _ in range(source.randint(3, 12)):
            word = "".join(source.choice("bcdfg") for _ in range(3)) + source.choice(["ing", "ed", "o"])
            tag = "V" if word.endswith(("ing", "ed")) else ("N" if tags and tags[-1] == "N" else "X")
            words.append(word)
            tags.append("N" if tag == "V" and tags and tags[-1] == "X" else tag)
        rows.append((i, words, tags))
    return cut_lineage(spark.createDataFrame(rows, "id long, tokens array<string>, tags array<string>"))


def test_held_out_likelihood_beats_smoothed_counts(chain):
    train, test = chain.filter("id < 120"), chain.filter("id >= 120")
    model = learned_tags.fit_tags(train, size=512, steps=25)
    assert model.tags == ["N", "V", "X"] and all(b <= a for a, b in zip(model.losses, model.losses[1:]))
    scored = learned_tags.with_learned_emissions(test.withColumn("features", learned_tags.token_features("tokens", 512)), model)
    seen = cut_lineage(sequence.emissions(train))
    counted = sequence.with_emissions(test, ["id"], seen, sequence.tagger(cut_lineage(sequence.transitions(train)), seen))
    own, other = (sequence.negative_log_likelihood(s, ["id"]).agg(F.sum("nll")).first()[0] for s in (scored, counted))
    assert own < 0.3 * other
    right = sequence.decode_paths(scored, ["id"]).join(test, "id").select(F.explode(F.zip_with("path", "tags", lambda a, b: (a == b).cast("int"))).alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.85


def test_the_fit_ends_where_the_slope_vanishes(short):
    _, df = short
    rows = df.withColumn("tokens", F.transform("features", lambda f: F.array_join(f.cast("array<string>"), "-")))
    model = learned_tags.fit_tags(rows, size=64, penalty=2.0, steps=60)
    ready = rows.withColumn("features", learned_tags.token_features("tokens", 64))
    loss, slope = learned_tags._objective(ready, model, "tags", 2.0)
    assert loss == pytest.approx(model.losses[-1]) and np.abs(slope).max() < 0.3


def test_no_sentences_and_empty_ones(spark, chain):
    empty = learned_tags.fit_tags(chain.filter("id < 0"), size=16)
    assert empty.tags == [] and empty.losses == []
    odd = chain.limit(5).unionByName(spark.createDataFrame([(999, [], [])], chain.schema))
    assert learned_tags.fit_tags(odd, size=64, steps=2).tags
    with pytest.raises(ValueError):
        learned_tags.fit_tags(chain, size=learned_tags.MOST_WEIGHTS)
