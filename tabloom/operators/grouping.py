"""Small grouping and restructuring operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.ranking import join_groups


def group_count(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_count_distinct(
    df: DataFrame, keys: Sequence[str], column: str, name: str = "count", approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per group.

    Counted in two steps, so the values of one big group are spread over tasks
    by value first; `approximate` uses a sketch instead.
    """
    if approximate:
        return df.groupBy(*keys).agg(F.approx_count_distinct(column).alias(name))
    return df.select(*keys, column).distinct().groupBy(*keys).agg(F.count(column).alias(name))


def group_distinct_list(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Sorted array of the distinct values per group.

    For columns with a small domain. For open-ended values keep rows
    (`dropDuplicates`) and rank them instead of building arrays.
    """
    values = df.select(*keys, column).distinct()
    return values.groupBy(*keys).agg(F.array_sort(F.collect_list(column)).alias(name))


def split_xy(df: DataFrame, has_id: bool = False) -> tuple[DataFrame, DataFrame]:
    """Predictors and label by position: the label is the last column, an id the first."""
    first = 1 if has_id else 0
    return df.select(df.columns[first:-1]), df.select(df.columns[-1])


def columns_of_type(df: DataFrame, *types: str) -> list[str]:
    """Names of the columns whose simple type is one of `types`."""
    return [name for name, kind in df.dtypes if kind in types]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, "int", "bigint", "smallint", "tinyint", "float", "double")


def columns_except(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]


def unpivot(df: DataFrame, columns: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (`keep`..., column, value) with values cast to `kind`."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows in a stated order (a per-task top-n, then one merge)."""
    return df.orderBy(*order).limit(n)


def best_row(df: DataFrame, score: str, key: str) -> DataFrame:
    """Row with the highest score; the smallest key among equals."""
    return top_rows(df, [F.col(score).desc(), F.col(key)], 1)


def arg_max(df: DataFrame, groups: Sequence[str], score: str, key: str) -> DataFrame:
    """Per group the key with the highest score; the smallest key among equals.

    A plain aggregate, so big groups are reduced before the shuffle.
    """
    best = df.groupBy(*groups).agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(key).alias("k"))).alias("b"))
    return best.select(*groups, F.col("b.k").alias(key), (-F.col("b.s")).alias(score))


def log_sum_exp(df: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """m + log(sum(exp(x - m))) per group with m its maximum; two plain aggregates.

    Partial sums are taken around the value's whole part, a small set of
    scales, so big groups are reduced before they meet.
    """
    scale = F.floor(column).alias("__scale")
    parts = df.groupBy(*groups, scale).agg(F.sum(F.exp(F.col(column) - F.floor(column))).alias("__part"))
    shifted = join_groups(parts, parts.groupBy(*groups).agg(F.max("__scale").alias("__top")), groups)
    return shifted.groupBy(*groups).agg(
        (F.max("__top") + F.log(F.sum(F.col("__part") * F.exp(F.col("__scale") - F.col("__top"))))).alias(name)
    )


def softmax(df: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """exp(x) / sum(exp(x)) per group, stable: exp(x - log_sum_exp).

    The group total comes from an aggregate joined back, so the rows of one
    group need not meet in one task.
    """
    total = log_sum_exp(df, groups, column, "__lse")
    joined = join_groups(df, total, groups)
    return joined.select(*df.columns, F.exp(F.col(column) - F.col("__lse")).alias(name))


def row_to_json(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
