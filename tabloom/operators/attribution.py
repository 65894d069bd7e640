"""Exact attributions of tree models: Shapley values of the path-dependent expectation.

A model is a table of nodes, then a table of root-to-leaf paths. With a set S
of known features a row reaches a leaf in the share prod(o_j for j in S) *
prod(z_j for the others): o_j says whether the row meets the conditions of the
path on feature j, z_j is the share of training weight that follows them. Of a
path with d features, the Shapley value of feature i is

    value * (o_i - z_i) * sum over S without i of |S|! (d-1-|S|)! / d! * products
    = value * (o_i - z_i) * integral over u in [0, 1] of prod over j <> i of (z_j (1-u) + o_j u),

since |S|! (d-1-|S|)! / d! is the integral of u^|S| (1-u)^(d-1-|S|). The
integrand has degree d - 1, so Gauss-Legendre points, half as many as a path
has features, give it exactly. Features that a path does not test get nothing
from it. Every row works through the paths by itself; only sums per row and
feature are added up.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import ensure_checkpoint_dir

#: The most paths of one model: they are sent to every task.
MOST_PATHS = 200_000
#: Stands for the share of a side that no training row takes, so that no factor is zero.
LEAST_SHARE = 1e-30
NODES = "tree int, node int, left int, right int, feature int, threshold double, levels array<double>, cover double, value double"


def tree_nodes(model: Model) -> DataFrame:
    """The nodes (see NODES) of a fitted tree, forest or boosted model, read back from its stored form.

    `left` and `right` are -1 at leaves. A condition is x <= threshold, or x
    among `levels`, for the left side. `value` of a leaf is what it adds to the
    score: the weighted chance of class 1, averaged over a forest, or the
    weighted margin of a boosted model. `cover` is the training weight.
    """
    spark = SparkSession.getActiveSession()
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/model-{uuid.uuid4().hex}"
    model.save(folder)
    stored = spark.read.parquet(f"{folder}/data")
    if "nodeData" in stored.columns:
        weights = spark.read.parquet(f"{folder}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
        nodes = stored.select(F.col("treeID").alias("tree"), "nodeData.*").join(F.broadcast(weights), "tree")
    else:
        nodes = stored.withColumns({"tree": F.lit(0), "weight": F.lit(1.0)})
    stats = F.col("impurityStats")
    if model.__class__.__name__.startswith("GBT"):
        cover, value = stats[0], F.col("prediction") * F.col("weight")
    else:
        share = 1.0 / model.getNumTrees if hasattr(model, "getNumTrees") else 1.0
        cover = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
        value = F.when(cover > 0, stats[1] / cover).otherwise(0.0) * F.col("weight") * share
    ordered = F.col("split.numCategories") == -1
    return nodes.select(
        "tree",
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.when(ordered, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(~ordered, F.col("split.leftCategoriesOrThreshold")).alias("levels"),
        cover.alias("cover"),
        value.alias("value"),
    )


def nodes_of_splits(df: DataFrame, splits: dict[int, tuple[int, float]], features: Sequence[Column], label: Column) -> DataFrame:
    """The nodes of a tree with given splits {node: (feature, threshold)}; the children of node n are 2n + 1 and 2n + 2.

    One aggregate over `df` counts the rows of each leaf and averages `label` in it.
    """
    leaf = F.lit(0)
    for _ in range(max(int(math.log2(n + 1)) for n in splits) + 1):
        step = leaf
        for n, (k, threshold) in splits.items():
            step = F.when(leaf == n, 2 * n + F.when(features[k] <= threshold, 1).otherwise(2)).otherwise(step)
        leaf = step
    counted = {r["leaf"]: (float(r["n"]), r["mean"]) for r in df.groupBy(leaf.alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.avg(label.cast("double")).alias("mean")).collect()}

    def cover(n: int) -> float:
        return cover(2 * n + 1) + cover(2 * n + 2) if n in splits else counted.get(n, (0.0, 0.0))[0]

    rows = [(0, n, 2 * n + 1, 2 * n + 2, k, float(t), None, cover(n), 0.0) for n, (k, t) in splits.items()]
    leaves = {c for n in splits for c in (2 * n + 1, 2 * n + 2)} - splits.keys()
    rows += [(0, n, -1, -1, -1, None, None, cover(n), counted.get(n, (0.0, 0.0))[1]) for n in sorted(leaves)]
    return df.sparkSession.createDataFrame(rows, NODES)


def tree_paths(nodes: DataFrame, depth: int = 31) -> DataFrame:
    """(tree, leaf, value, conditions): one row per leaf.

    Conditions are (feature, share, tests): one per feature that the path
    tests, with the share of the weight that follows all its tests.
    """
    cover = nodes.select("tree", F.col("node").alias("child"), F.col("cover").alias("child_cover"))
    sides = []
    for side, left in (("left", True), ("right", False)):
        low = F.lit(-math.inf) if left else F.col("threshold")
        high = F.col("threshold") if left else F.lit(math.inf)
        sides.append(F.struct(F.col(side).alias("child"), low.alias("low"), high.alias("high"), F.col("levels"), F.lit(left).alias("inside")))
    edges = nodes.filter("left >= 0").select("tree", F.col("node"), "feature", "cover", F.explode(F.array(*sides)).alias("s"))
    edges = edges.select("tree", "node", "feature", "cover", "s.*").join(cover, ["tree", "child"])
    share = F.when(F.col("cover") > 0, F.greatest(F.col("child_cover") / F.col("cover"), F.lit(LEAST_SHARE))).otherwise(0.5)
    edge = F.struct("feature", share.alias("share"), F.struct("low", "high", "levels", "inside").alias("test"))
    steps = edges.select("tree", "node", "child", edge.alias("edge"))
    root = nodes.filter("node = 0").select("tree", "node", "left", "value")
    kind = steps.schema["edge"].dataType.simpleString()
    open_ = root.select("tree", "node", "left", "value", F.expr(f"cast(array() AS array<{kind}>)").alias("path"))
    facts = nodes.select("tree", F.col("node").alias("child"), F.col("left").alias("below"), F.col("value").alias("own"))
    done = open_.filter("left < 0")
    for _ in range(depth):
        open_ = open_.filter("left >= 0").join(steps, ["tree", "node"]).join(facts, ["tree", "child"]).select(
            "tree", F.col("child").alias("node"), F.col("below").alias("left"), F.col("own").alias("value"), F.array_append("path", F.col("edge")).alias("path")
        )
        open_ = open_.sparkSession.createDataFrame(open_.collect(), open_.schema)  # the frontier of the model, at most one row per leaf
        done = done.unionByName(open_.filter("left < 0"))
        if open_.filter("left >= 0").isEmpty():
            break
    features = F.array_sort(F.array_distinct(F.transform("path", lambda e: e["feature"])))

    def merged(feature: Column) -> Column:
        own = F.filter("path", lambda e: e["feature"] == feature)
        return F.struct(
            feature.alias("feature"), F.aggregate(own, F.lit(1.0), lambda a, e: a * e["share"]).alias("share"), F.transform(own, lambda e: e["test"]).alias("tests")
        )

    return done.select("tree", F.col("node").alias("leaf"), "value", F.transform(features, merged).alias("conditions"))


def _met(x: Column, condition: Column) -> Column:
    """1.0 when the row meets all tests of the condition on its feature, else 0.0."""
    value = F.get(x, condition["feature"])

    def holds(t: Column) -> Column:
        return F.when(t["levels"].isNull(), (value > t["low"]) & (value <= t["high"])).otherwise(F.array_contains(t["levels"], value) == t["inside"])

    return F.when(F.forall(condition["tests"], holds), 1.0).otherwise(0.0)


def expected_score(paths: DataFrame) -> float:
    """The score with no feature known: the mean over the training weight."""
    return float(paths.agg(F.sum(F.col("value") * F.aggregate("conditions", F.lit(1.0), lambda a, c: a * c["share"]))).first()[0] or 0.0)


def tree_attribution(df: DataFrame, paths: DataFrame, key: Sequence[str], size: int, features: str = "x") -> DataFrame:
    """(key, feature, value): the Shapley value of each of the `size` features of each row, by slot number.

    `paths` comes from `tree_paths`, `features` is an array<double> column. The
    values of a row add up to its score less `expected_score`. A row with an
    unknown value meets no condition on it. Rows with the same key are added up.
    """
    facts = paths.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("conditions")).alias("d")).first()
    if (facts["n"] or 0) > MOST_PATHS:
        raise ValueError(f"{facts['n']} paths; a model may have {MOST_PATHS}")
    at, weight = np.polynomial.legendre.leggauss(max(1, -(-(facts["d"] or 1) // 2)))
    points = F.from_json(F.lit(json.dumps([{"u": float((a + 1) / 2), "w": float(w / 2)} for a, w in zip(at, weight)])), "array<struct<u:double,w:double>>")
    listed = paths.agg(F.collect_list(F.struct("value", "conditions"))).scalar()
    met = df.select(*key, F.col(features).alias("__x"), points.alias("__points"), F.explode(listed).alias("__path"))
    sides = F.transform("__path.conditions", lambda c: F.struct(c["feature"].alias("f"), _met(F.col("__x"), c).alias("o"), c["share"].alias("z")))
    met = met.select(*key, "__points", F.col("__path.value").alias("__value"), sides.alias("__sides"))

    def at_point(side: Column, u: Column) -> Column:
        return side["z"] * (1 - u) + side["o"] * u

    products = F.transform("__points", lambda p: F.aggregate("__sides", F.lit(1.0), lambda a, s: a * at_point(s, p["u"])))
    met = met.withColumn("__products", products)

    def share(s: Column) -> Column:
        parts = F.zip_with("__points", "__products", lambda p, whole: p["w"] * whole / at_point(s, p["u"]))
        return F.struct(s["f"].alias("feature"), (F.col("__value") * (s["o"] - s["z"]) * F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)).alias("value"))

    parts = met.select(*key, F.inline(F.transform("__sides", share)))
    none = df.select(*key, F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("feature"), F.lit(0.0).alias("value"))
    return parts.unionByName(none).groupBy(*key, "feature").agg(F.sum("value").alias("value"))


def mean_attribution(attributions: DataFrame) -> DataFrame:
    """(feature, importance): the mean absolute value per feature, the bars of a summary."""
    return attributions.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))
