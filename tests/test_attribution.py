"""Tree attributions against all subsets of features, and against the scores they explain."""

import itertools
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import attribution, models
from tabloom.session import cut_lineage

SIZE = 6


@pytest.fixture(scope="module")
def data(spark):
    source = random.Random(5)
    rows = []
    for i in range(300):
        x = [source.gauss(0, 1) for _ in range(SIZE - 1)] + [float(source.randrange(3))]
        rows.append((i, x, float(x[0] * x[1] + x[2] + (x[5] == 1) + source.gauss(0, 0.5) > 0.3), source.choice([0.5, 1.0, 3.0])))
    df = spark.createDataFrame(rows, "id long, x array<double>, label double, weight double")
    wide = df.select("id", "x", "label", "weight", *[F.col("x")[k].alias(f"x{k}") for k in range(SIZE)])
    return cut_lineage(VectorAssembler(inputCols=[f"x{k}" for k in range(SIZE)], outputCol="features").transform(wide))


def by_subsets(nodes, x, size=SIZE):
    """Shapley values by walking the tree once for every subset of known features."""
    tree = {}
    for n in nodes:
        tree.setdefault(n["tree"], {})[n["node"]] = n

    def walk(own, n, known):
        node = own[n]
        if node["left"] < 0:
            return node["value"]
        if node["feature"] in known:
            value = x[node["feature"]]
            left = value <= node["threshold"] if node["levels"] is None else value in node["levels"]
            return walk(own, node["left"] if left else node["right"], known)
        parts = [(c, own[c]["cover"]) for c in (node["left"], node["right"]) if own[c]["cover"] > 0]
        return sum(cover * walk(own, c, known) for c, cover in parts) / sum(cover for _, cover in parts)

    score = {s: sum(walk(own, 0, set(s)) for own in tree.values()) for r in range(size + 1) for s in itertools.combinations(range(size), r)}
    out = []
    for i in range(size):
        total = 0.0
        for s in score:
            if i not in s:
                weight = math.factorial(len(s)) * math.factorial(size - 1 - len(s)) / math.factorial(size)
                total += weight * (score[tuple(sorted((*s, i)))] - score[s])
        out.append(total)
    return out


ESTIMATORS = {
    "tree": lambda: models.decision_tree("entropy", max_depth=6),
    "forest": lambda: models.random_forest(4, 4),
    "boosting": lambda: models.boosted_trees(4, 0.3, 3),
}


@pytest.mark.parametrize("kind", ESTIMATORS)
def test_equal_to_all_subsets_and_additive(spark, data, kind):
    model = ESTIMATORS[kind]().fit(data)
    nodes = cut_lineage(attribution.tree_nodes(model))
    paths = cut_lineage(attribution.tree_paths(nodes))
    found = attribution.tree_attribution(data, paths, ["id"], SIZE).collect()
    assert len(found) == 300 * SIZE
    values = {(r["id"], r["feature"]): r["value"] for r in found}
    rows = {r["id"]: r["x"] for r in data.select("id", "x").collect()}
    listed = nodes.collect()
    for key in range(0, 300, 60):
        assert [values[key, k] for k in range(SIZE)] == pytest.approx(by_subsets(listed, rows[key]), abs=1e-9)
    if kind == "boosting":
        scores = model.transform(data).select("id", vector_to_array("rawPrediction")[1].alias("score")).collect()
    else:
        scores = models.score_table(model, data, "id").collect()
    base = attribution.expected_score(paths)
    for r in scores:
        assert sum(values[r["id"], k] for k in range(SIZE)) == pytest.approx(r["score"] - base, abs=1e-9)


def test_categories_and_repeated_features(spark):
    rows = [
        (0, 0, 1, 2, 0, None, [1.0], 10.0, 0.0),
        (0, 1, 3, 4, 1, 0.5, None, 4.0, 0.0),
        (0, 2, 5, 6, 0, None, [2.0, 3.0], 6.0, 0.0),
        (0, 3, -1, -1, -1, None, None, 1.0, 5.0),
        (0, 4, 7, 8, 1, 2.0, None, 3.0, 0.0),
        (0, 5, -1, -1, -1, None, None, 2.0, -1.0),
        (0, 6, -1, -1, -1, None, None, 4.0, 2.0),
        (0, 7, -1, -1, -1, None, None, 3.0, 7.0),
        (0, 8, -1, -1, -1, None, None, 0.0, 100.0),
    ]
    nodes = spark.createDataFrame(rows, attribution.NODES)
    paths = attribution.tree_paths(nodes)
    assert {r["leaf"]: len(r["conditions"]) for r in paths.collect()} == {3: 2, 5: 1, 6: 1, 7: 2, 8: 2}
    cases = [[1.0, 0.0, 9.0], [1.0, 1.0, 9.0], [2.0, 0.0, 9.0], [4.0, 5.0, 9.0]]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, x array<double>")
    found = {(r["id"], r["feature"]): r["value"] for r in attribution.tree_attribution(df, paths, ["id"], 3).collect()}
    for key, x in enumerate(cases):
        assert [found[key, k] for k in range(3)] == pytest.approx(by_subsets(nodes.collect(), x, 3), abs=1e-12)
        assert found[key, 2] == 0


def test_tree_of_one_leaf_and_empty_rows(spark):
    nodes = spark.createDataFrame([(0, 0, -1, -1, -1, None, None, 5.0, 0.25)], attribution.NODES)
    paths = attribution.tree_paths(nodes)
    df = spark.createDataFrame([(1, [1.0])], "id int, x array<double>")
    assert [tuple(r) for r in attribution.tree_attribution(df, paths, ["id"], 1).collect()] == [(1, 0, 0.0)]
    assert attribution.expected_score(paths) == 0.25
    assert attribution.tree_attribution(df.filter("id > 1"), paths, ["id"], 1).count() == 0


def test_splits_get_their_leaves_from_the_rows(spark):
    df = spark.range(10).select("id", F.col("id").cast("double").alias("a"), (F.col("id") > 6).cast("int").alias("y"))
    nodes = attribution.nodes_of_splits(df, {0: (0, 4.0), 2: (0, 8.0)}, [F.col("a")], F.col("y"))
    found = {r["node"]: (r["cover"], r["value"]) for r in nodes.collect()}
    assert found[0][0] == 10 and found[1] == (5.0, 0.0) and found[2][0] == 5 and found[5] == (4.0, 0.5) and found[6] == (1.0, 1.0)


def test_too_many_paths(spark, monkeypatch):
    monkeypatch.setattr(attribution, "MOST_PATHS", 0)
    nodes = spark.createDataFrame([(0, 0, -1, -1, -1, None, None, 5.0, 0.25)], attribution.NODES)
    with pytest.raises(ValueError):
        attribution.tree_attribution(nodes, attribution.tree_paths(nodes), ["node"], 1)
