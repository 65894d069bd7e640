"""Profiles that are kept as sketches per part and merged without reading the rows again.

A part is a day, a load or any other value of a column. Per part and numeric
column a distinct-count sketch and a quantile sketch are stored; a new day adds
its rows to the store, and the profile of any set of parts is a merge of some
kilobytes each. Counts are exact. With the chance of 99 % and more, a distinct
count is off by at most DISTINCT_ERROR of its value, and the rank of a quantile
by at most RANK_ERROR of the number of values, however many parts are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.grouping import unpivot

DISTINCT_BITS = 14
QUANTILE_K = 400
#: Three standard deviations, 1.04 / sqrt(2 ** DISTINCT_BITS) each.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)
#: The two-sided rank error of a quantile sketch with QUANTILE_K at 99 %.
RANK_ERROR = 0.012


def sketch_parts(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """(part, column, n, nulls, distinct_sketch, quantile_sketch): one row per part and column, from one scan.

    n counts the known values. A column without known values in a part has null
    sketches there. Rows with a null part form a part of their own.
    """
    cells = unpivot(df, columns, "double", [F.col(part).cast("string").alias("part")])
    known = F.col("value").isNotNull()
    value = F.when(~F.isnan("value"), F.col("value"))
    some = F.count("value") > 0
    return cells.groupBy("part", "column").agg(
        F.count("value").alias("n"),
        F.count_if(~known).alias("nulls"),
        F.when(some, F.hll_sketch_agg(F.col("value").cast("string"), F.lit(DISTINCT_BITS))).alias("distinct_sketch"),
        F.when(some, F.kll_sketch_agg_double(value, F.lit(QUANTILE_K))).alias("quantile_sketch"),
    )


def store_sketches(df: DataFrame, part: str, columns: Sequence[str], path: str) -> None:
    """Write the sketches of the parts in `df` under `path`; parts that are there already are replaced, others stay."""
    parts = sketch_parts(df, part, columns)
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on `part` reads only the folders it needs."""
    kinds = "column string, n bigint, nulls bigint, distinct_sketch binary, quantile_sketch binary, part string"
    return spark.read.schema(kinds).parquet(path)


def merged_profile(parts: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, parts, n, nulls, distinct, quantiles): one row per column over all given parts.

    `quantiles` holds a value per entry of `shares`. Columns without known
    values have a distinct count of 0 and null quantiles.
    """
    sums = parts.groupBy("column").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch", F.lit(False)).alias("d"),
        F.kll_merge_agg_double("quantile_sketch").alias("q"),
    )
    some = F.col("n") > 0
    return sums.select(
        "column",
        "parts",
        "n",
        "nulls",
        F.when(some, F.hll_sketch_estimate("d")).otherwise(F.lit(0).cast("bigint")).alias("distinct"),
        F.when(some, F.array(*[F.kll_sketch_get_quantile_double("q", F.lit(float(s))) for s in shares])).alias("quantiles"),
    )


def within_errors(df: DataFrame, profile: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, n, distinct_within, quantiles_within): whether a merged profile keeps the stated errors on the rows themselves."""
    cells = unpivot(df, columns, "double").filter(F.col("value").isNotNull())
    exact = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("k")).groupBy("column").agg(F.count(F.lit(1)).alias("exact"))
    wanted = profile.select("column", F.inline(F.arrays_zip(F.array(*[F.lit(float(s)) for s in shares]).alias("share"), F.col("quantiles").alias("at"))))
    met = cells.join(F.broadcast(wanted), "column").groupBy("column", "share").agg(
        F.avg((F.col("value") < F.col("at")).cast("int")).alias("below"), F.avg((F.col("value") <= F.col("at")).cast("int")).alias("upto")
    )
    kept = (F.col("below") <= F.col("share") + RANK_ERROR) & (F.col("upto") >= F.col("share") - RANK_ERROR)
    ranks = met.groupBy("column").agg(F.bool_and(kept).alias("quantiles_within"))
    off = F.abs(F.col("distinct") - F.col("exact"))
    return profile.join(exact, "column").join(ranks, "column").select(
        "column", "n", (off <= F.ceil(F.col("exact") * DISTINCT_ERROR)).alias("distinct_within"), "quantiles_within"
    )
