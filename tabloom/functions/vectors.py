"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def scaled_dot(a: Column, b: Column) -> Column:
    """Dot product over the root of the width."""
    return dot(a, b) / F.sqrt(F.size(a))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def zeros(width: int) -> Column:
    return F.array_repeat(F.lit(0.0), width)


def one_hot(index: Column, width: int | Column) -> Column:
    """array<double> with a one at the 0-based `index`."""
    size = F.lit(width) if isinstance(width, int) else width
    return F.transform(F.sequence(F.lit(0), (size - 1).cast("int")), lambda i: F.when(i == index, 1.0).otherwise(0.0))


def prefix(array: Column, n: int) -> Column:
    return F.slice(array, 1, n)
