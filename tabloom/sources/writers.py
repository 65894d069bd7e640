"""Outputs, written by the tasks and never collected on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_samples_json(samples: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line and row, many part files."""
    samples.write.mode(mode).json(path)


def write_predictions_csv(scores: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Id and score with a header line, no row number column."""
    scores.write.mode(mode).option("header", True).csv(path)
