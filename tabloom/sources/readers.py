"""Inputs: nested QA documents, flat tables, tag lines, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.text import tag_list
from tabloom.operators.flatten import NESTED_QA
from tabloom.operators.ranking import running_totals


def read_nested_qa(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Nested QA documents with a declared schema, so no pass is spent on inference.

    JSON lines (one document per line) are split over tasks; a multi-line file
    is read by one task per file.
    """
    return spark.read.schema(NESTED_QA).option("multiLine", multiline).json(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """A flat table whose first line holds the column names, with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_tag_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, tags): one sentence per line, one tag per token.

    Lines are numbered from 0 inside their file. The blocks of a large file are
    numbered in parallel and shifted by the lines before them.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        tag_list(F.col("value")).alias("tags"),
    )
    one = {"line_no": F.lit(1).cast("long")}
    numbered = running_totals(lines, "block", [F.col("place")], one, ["file"])
    return numbered.select("file", (F.col("line_no") - 1).alias("line_no"), "tags")


def read_pages(spark: SparkSession, path: str, columns: Sequence[str] = ("page_id", "url", "html")) -> DataFrame:
    """A stored page corpus."""
    return spark.read.parquet(path).select(*columns)
