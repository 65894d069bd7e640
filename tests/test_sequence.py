import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import sequence


@pytest.fixture(scope="module")
def corpus(spark):
    source = random.Random(7)
    rows = []
    for i in range(40):
        n = source.randrange(1, 5)
        rows.append((i, [source.choice("uvwxyz") for _ in range(n)], [source.choice("ABC") for _ in range(n)]))
    return rows


@pytest.fixture(scope="module")
def scored(spark, corpus):
    df = spark.createDataFrame(corpus, "id long, tokens array<string>, tags array<string>")
    train = df.filter("id < 30").cache()  # so that some words and steps stay unseen
    seen = sequence.emissions(train).cache()
    model = sequence.tagger(sequence.transitions(train).cache(), seen)
    return sequence.with_emissions(df, ["id"], seen, model).cache()


def brute(row):
    t = row.tagger

    def score(path):
        total = t.start[path[0]] + row.emit[0][path[0]]
        for k in range(1, len(path)):
            total += t.step[path[k]][path[k - 1]] + row.emit[k][path[k]]
        return total + t.stop[path[-1]]

    paths = list(itertools.product(range(len(t.tags)), repeat=len(row.emit)))
    return score, paths, t.tags


def test_scores_paths_and_partition_equal_brute_force(scored):
    rows = {r.id: r for r in scored.collect()}
    given = dict(sequence.score_paths(scored, ["id"]).collect())
    best = {r.id: r for r in sequence.decode_paths(scored, ["id"]).collect()}
    nll = dict(sequence.negative_log_likelihood(scored, ["id"]).collect())
    assert len(rows) == len(given) == len(best) == len(nll) == 40
    for i, row in rows.items():
        score, paths, tags = brute(row)
        own = score([tags.index(t) for t in row.tags])
        top = max(score(p) for p in paths)
        assert given[i] == pytest.approx(own)
        assert best[i].score == pytest.approx(top)
        assert score([tags.index(t) for t in best[i].path]) == pytest.approx(top)
        assert nll[i] == pytest.approx(math.log(sum(math.exp(score(p)) for p in paths)) - own)


def test_transitions_never_enter_start_or_leave_stop(spark, corpus):
    df = spark.createDataFrame(corpus, "id long, tokens array<string>, tags array<string>")
    rows = sequence.transitions(df).collect()
    assert all(r.tag != "<START>" and r.prev != "<STOP>" for r in rows)
    assert sum(r.n for r in rows) == sum(len(tags) + 1 for _, _, tags in corpus)
    by_prev = {}
    for r in rows:
        by_prev[r.prev] = by_prev.get(r.prev, 0) + math.exp(r.score)
    assert all(v == pytest.approx(1.0) for v in by_prev.values())


def test_scoring_uses_no_python(scored):
    plan = sequence.decode_paths(scored, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan


def test_first_maximum_wins(spark):
    df = spark.createDataFrame([(1, ["x", "x"], ["A", "B"]), (2, ["x", "x"], ["B", "A"])], "id long, tokens array<string>, tags array<string>")
    seen = sequence.emissions(df)
    model = sequence.tagger(sequence.transitions(df), seen)
    path = sequence.decode_paths(sequence.with_emissions(df, ["id"], seen, model), ["id"]).filter(F.col("id") == 1).first().path
    assert path in (["A", "B"], ["B", "A"])


def test_long_sentence_is_decoded_in_blocks(spark):
    source = random.Random(3)
    rows = []
    for i, n in enumerate((1, 2, 3, 5, 10, 17, 401)):
        rows.append((i, [source.choice("uvwxyz") for _ in range(n)], [source.choice("ABC") for _ in range(n)]))
    df = spark.createDataFrame(rows, "id long, tokens array<string>, tags array<string>")
    seen = sequence.emissions(df).cache()
    model = sequence.tagger(sequence.transitions(df).cache(), seen)
    scored = sequence.with_emissions(df, ["id"], seen, model).cache()
    best = {r.id: r for r in sequence.decode_paths(scored, ["id"]).collect()}
    for row in scored.collect():
        t, tags = row.tagger, range(len(row.tagger.tags))
        score, came = [t.start[g] + row.emit[0][g] for g in tags], []
        for emit in row.emit[1:]:
            sums = [[score[p] + t.step[g][p] for p in tags] for g in tags]
            came.append([s.index(max(s)) for s in sums])
            score = [max(s) + e for s, e in zip(sums, emit)]
        end = [a + b for a, b in zip(score, t.stop)]
        path = [end.index(max(end))]
        for places in reversed(came):
            path.append(places[path[-1]])
        assert best[row.id].score == pytest.approx(max(end))
        assert best[row.id].path == [t.tags[g] for g in reversed(path)]
