"""A key that holds most of the rows must not end in one task."""

import pytest
from pyspark.sql import functions as F

from tabloom.operators import features, grouping
from tabloom.operators.lookup import keyed_lookup
from tabloom.operators import vocabulary as voc

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture
def tight(spark):
    """Settings of a large cluster in small: no broadcasts, splits at a few kB."""
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_groups(spark, n=60000):
    group = F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 500)).otherwise("hot")
    return spark.range(0, n, 1, 16).select("id", group.alias("g"), (F.col("id") % 97).cast("double").alias("v"))


def test_softmax_splits_the_hot_group(tight):
    shares = grouping.softmax(hot_groups(tight), ["g"], "v", "s")
    total = shares.groupBy("g").agg(F.sum("s").alias("t")).filter(F.abs(F.col("t") - 1) > 1e-6).count()
    assert total == 0
    rows = shares.collect()
    assert len(rows) == 60000
    assert "skew=true" in shares._jdf.queryExecution().executedPlan().toString()


def test_folds_of_a_dominant_class_are_dealt_by_many_tasks(tight):
    df = tight.range(0, 50000, 1, 16).select("id", (F.col("id") % 100 == 0).alias("y"))
    tight.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        folds = features.fold_assignment(df, "id", "y", 5)
        per_task = folds.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(per_task) == 8 and max(r["count"] for r in per_task) < 2 * 50000 / 8
        sizes = {r["count"] for r in folds.groupBy("y", "fold").count().collect()}
        assert sizes == {9900, 100}
    finally:
        tight.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_frequent_word_is_spread_in_the_look_up(tight):
    tokens = tight.range(0, 40000, 1, 16).select(
        F.col("id").alias("doc"),
        F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("w"), F.col("id") % 900)).otherwise("the").alias("word"),
    )
    dictionary = voc.vocabulary(tokens).cache()
    tight.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = voc.token_index(tokens, dictionary, ["doc"])
        per_task = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in per_task) == 40000
        assert max(r["count"] for r in per_task) < 2 * 40000 / 8
    finally:
        tight.conf.set("spark.sql.adaptive.enabled", "true")
        dictionary.unpersist()


def largest_share(spark, df, rows):
    """Rows of the fullest task against an even share, without adaptive execution."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_task) == rows
    return max(r["count"] for r in per_task) / (rows / 8)


def test_five_equally_hot_keys_are_spread(tight):
    coded = tight.range(0, 40000, 1, 16).select("id", (F.col("id") % 5).alias("ix"))
    names = tight.createDataFrame([(i, f"tag{i}") for i in range(5)], "ix long, tag string")
    assert largest_share(tight, voc.decode(coded, names, "ix", "tag"), 40000) < 1.5
    wrong = voc.decode(coded, names, "ix", "tag").filter(F.col("tag") != F.concat(F.lit("tag"), F.col("ix")))
    assert wrong.count() == 0


def test_hot_unknown_and_null_words_are_spread(tight):
    word = F.when(F.col("id") % 3 == 0, "<hidden>").when(F.col("id") % 3 == 1, F.concat(F.lit("w"), F.col("id") % 900))
    tokens = tight.range(0, 40000, 1, 16).select(F.col("id").alias("doc"), F.lit(0).alias("pos"), word.alias("word"))
    entries = tight.range(0, 900).select(F.concat(F.lit("w"), "id").alias("word"), F.lit(1).alias("freq"), F.col("id").alias("ix"))
    found = voc.lookup_words(tokens, entries, ["doc"])
    assert largest_share(tight, found, 40000) < 1.5
    assert found.filter("ix is null").count() == sum(i % 3 != 1 for i in range(40000))
    assert found.filter("ix is not null and word <> concat('w', ix)").count() == 0


def test_look_up_in_and_of_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id long, word string")
    entries = spark.createDataFrame([("a", 5)], "word string, ix long")
    assert sorted(keyed_lookup(rows, entries, "word").select("id", "ix").collect()) == [(1, 5), (1, 5), (2, None)]
    assert keyed_lookup(rows.limit(0), entries, "word").collect() == []
    assert {r.ix for r in keyed_lookup(rows, entries.limit(0), "word").collect()} == {None}
