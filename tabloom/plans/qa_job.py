"""Batch job: nested QA documents in, balanced training samples out.

spark-submit tabloom/plans/qa_job.py --input DOCS --output SAMPLES
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tabloom.functions import spans
from tabloom.operators.flatten import flatten_qa
from tabloom.plans.qa_samples import build_samples
from tabloom.sources.readers import read_nested_qa
from tabloom.sources.writers import write_samples_json


def run(
    spark: SparkSession,
    source: str,
    target: str,
    multiline: bool = False,
    size: int = spans.SIZE,
    stride: int = spans.STRIDE,
    keep_tail: bool = True,
) -> None:
    qa = flatten_qa(read_nested_qa(spark, source, multiline), (size, stride, keep_tail))
    write_samples_json(build_samples(qa, size, stride, keep_tail), target)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="JSON lines, or JSON files with --multiline")
    parser.add_argument("--output", required=True, help="folder for the JSON lines")
    parser.add_argument("--multiline", action="store_true")
    parser.add_argument("--size", type=int, default=spans.SIZE)
    parser.add_argument("--stride", type=int, default=spans.STRIDE)
    parser.add_argument("--drop-tail", action="store_true", help="leave out what stands behind the last full window")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("qa-samples").getOrCreate()
    run(spark, options.input, options.output, options.multiline, options.size, options.stride, not options.drop_tail)
    spark.stop()


if __name__ == "__main__":
    main()
