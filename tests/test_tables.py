"""Ranking, grouping, profiling, features and evaluation on small frames."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabloom.operators import evaluate, features, grouping, profile, ranking


@pytest.fixture(scope="module")
def lopsided(spark):
    """Group a holds most of the rows, one group key is null."""
    rows = [("a" if i % 10 else ("b" if i % 20 else None), i) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, id long").repartition(16)


def test_hashed_rank_numbers_each_group_without_gaps(lopsided):
    ranked = ranking.hashed_rank(lopsided, ["g"], ["id"]).collect()
    assert len(ranked) == 3000
    for group in ("a", "b", None):
        own = sorted(r["rank"] for r in ranked if r.g == group)
        assert own == list(range(1, len(own) + 1))


def test_hashed_rank_does_not_depend_on_partitions(lopsided):
    first = {(r.g, r.id): r["rank"] for r in ranking.hashed_rank(lopsided, ["g"], ["id"]).collect()}
    second = {(r.g, r.id): r["rank"] for r in ranking.hashed_rank(lopsided.coalesce(1), ["g"], ["id"]).collect()}
    assert first == second


def test_no_task_ranks_a_whole_group(lopsided):
    keyed = lopsided.withColumn("b", F.substring(ranking.hash_key(["id"]), 1, 2))
    biggest = keyed.groupBy("g", "b").count().agg(F.max("count")).first()[0]
    assert biggest < 40  # of 2700 rows in group a


def test_first_n_takes_the_limit_of_each_group(spark, lopsided):
    limited = lopsided.withColumn("n", F.when(F.col("g") == "a", 7).otherwise(100000))
    kept = ranking.first_n_per_group(limited, ["g"], ["id"], F.col("n")).groupBy("g").count()
    assert dict(kept.collect()) == {"a": 7, "b": 150, None: 150}


def test_running_totals_by_value(spark):
    source = random.Random(1)
    rows = [(source.choice("xy"), round(source.gauss(0, 1), 2), source.randrange(5)) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, v double, n long").groupBy("g", "v").agg(F.sum("n").alias("n"))
    bounds = ranking.value_buckets(df, ["v"], 16)["v"]
    got = ranking.running_totals(
        ranking.with_value_bucket(df, "v", bounds, "b"), "b", [F.col("v")], {"t": F.col("n")}, ["g"]
    ).collect()
    for r in got:
        assert r.t == sum(n for g, v, n in rows if g == r.g and v <= r.v)


@pytest.mark.parametrize("parts", [None, 2, 64])
def test_quantiles_are_exact(spark, parts):
    source = random.Random(2)
    values = [source.choice([source.gauss(0, 10), 5.0]) for _ in range(1001)] + [None] * 10
    df = spark.createDataFrame([(v, 1.5) for v in values], "v double, w double").repartition(7)
    got = {(r.column, r.share): r.value for r in profile.quantiles(df, ["v", "w"], [0.0, 0.1, 0.5, 0.99, 1.0], parts).collect()}
    clean = sorted(v for v in values if v is not None)
    for share in (0.0, 0.1, 0.5, 0.99, 1.0):
        place = share * (len(clean) - 1)
        low = math.floor(place)
        high = min(low + 1, len(clean) - 1)
        assert got[("v", share)] == pytest.approx(clean[low] + (clean[high] - clean[low]) * (place - low))
        assert got[("w", share)] == 1.5


def test_describe_approximate_and_edges(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None)], "a int, b double")
    rows = {r.column: r for r in profile.describe(df).collect()}
    assert (rows["a"]["count"], rows["a"].mean, rows["a"]["std"], rows["a"].q50) == (3, 2.0, 1.0, 2.0)
    assert (rows["b"]["count"], rows["b"].mean, rows["b"].q50) == (0, None, None)
    assert {r.column: r.q50 for r in profile.describe(df, ["a"], approximate=True).collect()} == {"a": 2.0}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in profile.duplicate_rows(df).collect()] == [(1, None), (1, None)]
    assert profile.drop_duplicates(df).count() == 2
    many = spark.createDataFrame([(1,)] * 1000 + [(2,)] * 2 + [(3,)], "a int")
    assert dict(profile.duplicate_rows(many, chunk=7).groupBy("a").count().collect()) == {1: 999, 2: 1}


def test_histogram_of_a_constant_and_of_values(spark):
    flat = profile.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v").collect()
    assert [(r.bin, r["count"]) for r in flat] == [(0, 4)]
    rows = profile.histogram(spark.createDataFrame([(float(i),) for i in range(11)], "v double"), "v", 5).collect()
    assert sorted((r.bin, r["count"]) for r in rows) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    assert sum(r.density * 2.0 for r in rows) == pytest.approx(1.0)
    assert profile.sturges(16) == 5


def test_kernel_density_close_to_the_direct_sum(spark):
    source = random.Random(3)
    values = [source.gauss(0, 1) for _ in range(400)]
    h = statistics.stdev(values) * len(values) ** -0.2
    rows = profile.kernel_density(spark.createDataFrame([(v,) for v in values], "v double"), "v", 9).collect()
    assert len(rows) == 9
    for r in rows:
        direct = sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(direct, rel=1e-9)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, "a", 0)], "id long, x int, c string, y int")
    x, y = grouping.split_xy(df, has_id=True)
    assert (x.columns, y.columns) == (["x", "c"], ["y"])
    assert grouping.split_xy(df)[0].columns == ["id", "x", "c"]
    assert grouping.columns_of_type(df, "bigint", "string") == ["id", "c"]
    assert grouping.numeric_columns(df) == ["id", "x", "y"]
    assert grouping.columns_except(df, "x", "c") == ["id", "y"]


def test_log_sum_exp_and_softmax_stay_finite(spark):
    values = [-1000.0, 1000.0, 1000.5, 3.0]
    df = spark.createDataFrame([(None, v) for v in values], "g string, v double")
    expected = 1000.5 + math.log(1 + math.exp(-0.5))
    assert grouping.log_sum_exp(df, ["g"], "v", "l").first().l == pytest.approx(expected)
    shares = {r.v: r.s for r in grouping.softmax(df, ["g"], "v", "s").collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and len(shares) == 4


def test_encoding_fits_on_train_only(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0)], "c string, v double")
    test = spark.createDataFrame([("a", 5.0), ("z", 1.0)], "c string, v double")
    coded_train, coded_test = features.ordinal_encode(train, ["c"], test)
    assert [r.c for r in coded_train.collect()] == [1, 0]
    assert [r.c for r in coded_test.collect()] == [0, 2]
    levels = features.category_levels(train, ["c"])
    assert features.one_hot_columns(train, levels).columns == features.one_hot_columns(test, levels).columns
    assert [(r.c_a, r.c_b) for r in features.one_hot_columns(test, levels).collect()] == [(1, 0), (0, 0)]
    scaled = features.min_max_scale(train, ["v"], test)
    assert [r.v for r in scaled[0].collect()] == [0.0, 1.0]
    assert [r.v for r in scaled[1].collect()] == [2.0, 0.0]


def test_stratified_parts_and_folds(spark):
    df = spark.createDataFrame([(i, i % 10 == 0) for i in range(1000)], "id long, y boolean")
    split = features.stratified_split(df, "id", "y", 0.8).groupBy("y", "part").count().collect()
    assert {(r.y, r.part): r["count"] for r in split} == {
        (True, "train"): 80, (True, "test"): 20, (False, "train"): 720, (False, "test"): 180,
    }
    folds = features.fold_assignment(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds if r.y} == {20} and {r["count"] for r in folds if not r.y} == {180}
    weights = dict(features.class_weights(df, "y").collect())
    assert weights == {True: 5.0, False: pytest.approx(1000 / 1800)}


def test_auc_equals_counting_pairs(spark):
    source = random.Random(6)
    rows = [(m, int(source.random() < 0.3), source.randrange(40) / 40) for m in ("a", "b") for _ in range(300)]
    df = spark.createDataFrame(rows, "model string, truth int, score double")
    got = dict(evaluate.roc_auc(df, ["model"]).collect())
    for model in ("a", "b"):
        pos = [s for m, t, s in rows if m == model and t]
        neg = [s for m, t, s in rows if m == model and not t]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[model] == pytest.approx(wins / (len(pos) * len(neg)))
    one_class = spark.createDataFrame([(1, 0.5)], "truth int, score double")
    assert evaluate.roc_auc(one_class).first().auc is None


def test_roc_curve_ends_at_one(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "truth int, score double")
    curve = sorted(map(tuple, evaluate.roc_curve(df).collect()), reverse=True)
    assert curve == [(0.9, 0.5, 0.5), (0.4, 0.5, 1.0), (0.1, 1.0, 1.0)]
    assert evaluate.roc_curve(df, digits=0).count() == 2


def test_metrics_are_zero_when_undefined(spark):
    row = evaluate.binary_metrics(spark.createDataFrame([(1, 0), (0, 0)], "truth int, pred int")).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)


def test_class_report_does_not_swap_sides(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "b"), ("b", "b")], "truth string, pred string")
    rows = {r.label: r for r in evaluate.class_report(df).collect()}
    assert (rows["a"].precision, rows["a"].recall, rows["a"].support) == (1.0, pytest.approx(1 / 3), 3)
    assert (rows["b"].precision, rows["b"].recall, rows["b"].support) == (pytest.approx(1 / 3), 1.0, 1)
    assert rows["macro avg"].recall == pytest.approx(2 / 3)
    assert rows["weighted avg"].recall == pytest.approx((3 / 3 + 1) / 4)


def test_linear_attribution_sums_to_the_centred_score(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 4.0, 5.0)], "id int, a double, b double")
    rows = {r.id: r for r in evaluate.linear_attribution(df, {"a": 2.0, "b": -1.0}, ["id"]).collect()}
    assert (rows[1].a, rows[1].b, rows[2].a, rows[2].b) == (-2.0, 2.0, 2.0, -2.0)
