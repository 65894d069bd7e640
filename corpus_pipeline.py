"""A corpus pipeline: quality, exact duplicates, near-duplicates, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import bpe, exact_dedup, quality
from tabloom.llm.common import counted_ids, shared_folder, table
from tabloom.llm.decontaminate import contaminated
from tabloom.llm.ngram_join import near_duplicates


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is not among `ids`, in one pass over the texts while the ids fit a broadcast.

    Rows with a null id stay. Other columns, empty texts and repeated rows are
    not looked at; no ids, or an empty table, change nothing.
    """
    gone = counted_ids(ids.select(F.col("doc_id").alias("__gone")))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    An id goes when all its rows are rejected, so a good text is not lost to a
    bad one under its id. A null text is scored as an empty one, which counts as
    any other text; rows with a null id stay.
    """
    scores = quality.quality_scores(docs, table(spark, sf_dir, "labels"))
    return without(docs, scores.groupBy("doc_id").agg(F.max("predicted").alias("best")).filter("best = 0"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z, the row with the largest id; see `drop_exact_duplicates`."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id.

    Texts without words are classes of their own and stay, as rows with a null
    id do. Rows with the same id stay or go together.
    """
    return without(docs, near_duplicates(docs).filter("doc_id <> class_id"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none, rows with the same id go together."""
    return without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text and their digests, one row per row; a null text counts as empty and has no tokens."""
    return bpe.round_trip(docs, *bpe.public_vocabulary())


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: Trained scores and the chosen paths have no SQL; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written as Parquet in the shared folder and read again by the next."""
    import uuid

    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
