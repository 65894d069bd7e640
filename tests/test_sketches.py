"""Stored sketches: stated errors against exact values, merging, replacing and adding parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import sketches

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).cast("string").alias("day"),
        (F.xxhash64("id") % 40_000).cast("double").alias("a"),
        F.exp(F.randn(3)).alias("b"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 11).cast("int").alias("c"),
    )
    return df.cache()


def test_errors_hold_for_one_part_and_for_many(spark, rows):
    for part in ("day", "one"):
        profile = sketches.merged_profile(sketches.sketch_parts(rows.withColumn("one", F.lit(1)), part, COLUMNS))
        found = sketches.within_errors(rows, profile, COLUMNS).collect()
        assert len(found) == 3 and all(r["distinct_within"] and r["quantiles_within"] for r in found)
        facts = {r["column"]: r for r in profile.collect()}
        assert facts["c"]["n"] == 20_000 and facts["c"]["nulls"] == 40_000 and facts["c"]["distinct"] == 11
        assert facts["a"]["parts"] == (7 if part == "day" else 1)
        exact = np.quantile([r[0] for r in rows.select("b").collect()], [0.25, 0.5, 0.75])
        assert np.allclose(facts["b"]["quantiles"], exact, rtol=0.06)


def test_a_wrong_profile_is_found_out(rows):
    profile = sketches.merged_profile(sketches.sketch_parts(rows.filter("a > 2000"), "day", COLUMNS))
    found = {r["column"]: r for r in sketches.within_errors(rows, profile, COLUMNS).collect()}
    assert not found["a"]["quantiles_within"] and not found["a"]["distinct_within"]


def test_a_new_day_is_added_and_a_day_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    sketches.store_sketches(rows.filter("day < '5'"), "day", COLUMNS, path)
    sketches.store_sketches(rows.filter("day = '5'"), "day", COLUMNS, path)
    sketches.store_sketches(rows.filter("day = '4' AND a > 100"), "day", COLUMNS, path)
    stored = sketches.stored_sketches(spark, path)
    assert stored.count() == 18
    now = rows.filter("day < '4' OR day = '5' OR (day = '4' AND a > 100)")
    profile = sketches.merged_profile(stored)
    assert {r["column"]: r["n"] for r in profile.collect()} == {c: now.filter(f"{c} IS NOT NULL").count() for c in COLUMNS}
    assert all(r["distinct_within"] and r["quantiles_within"] for r in sketches.within_errors(now, profile, COLUMNS).collect())
    some = sketches.merged_profile(stored.filter("part IN ('1', '2')")).filter("column = 'a'").first()
    assert some["parts"] == 2 and some["n"] == rows.filter("day IN ('1', '2')").count()
    plan = stored.filter("part = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_nulls_and_empty_parts(spark):
    df = spark.createDataFrame([(None, 1.0, None), ("x", None, None), ("x", float("nan"), None)], "day string, a double, b double")
    facts = {r["column"]: r for r in sketches.merged_profile(sketches.sketch_parts(df, "day", ["a", "b"])).collect()}
    assert facts["a"]["n"] == 2 and facts["a"]["parts"] == 2 and facts["a"]["distinct"] == 2
    assert facts["b"]["n"] == 0 and facts["b"]["distinct"] == 0 and facts["b"]["quantiles"] is None
    assert sketches.merged_profile(sketches.sketch_parts(df.filter("a > 5 AND a < 1"), "day", ["a"])).count() == 0
