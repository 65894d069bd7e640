"""Nested question-answer documents to one row per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import spans
from tabloom.operators.ranking import SEPARATOR

ANSWER = T.StructType([T.StructField("text", T.StringType()), T.StructField("answer_start", T.LongType())])
QUESTION = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("is_impossible", T.BooleanType()),
        T.StructField("answers", T.ArrayType(ANSWER)),
    ]
)
PARAGRAPH = T.StructType([T.StructField("context", T.StringType()), T.StructField("qas", T.ArrayType(QUESTION))])
ENTRY = T.StructType([T.StructField("title", T.StringType()), T.StructField("paragraphs", T.ArrayType(PARAGRAPH))])
NESTED_QA = T.StructType([T.StructField("data", T.ArrayType(ENTRY))])

QA_COLUMNS = ["title", "para_key", "context", "question", "is_impossible", "answers"]


def window_digests(text: Column, size: int, stride: int, keep_tail: bool = True) -> Column:
    """array<string>: a digest per window of the text, in their order."""
    count = spans.window_count(F.length(text).cast("int"), size, stride, keep_tail)
    return F.transform(spans.window_texts(text, count, size, stride), F.md5)


def flatten_qa(nested: DataFrame, windows: tuple[int, int, bool] | None = None) -> DataFrame:
    """title, para_key, context, question, is_impossible, answers: one row per question.

    Paragraphs are opened as structs, so a question stays with its own context
    and titles need no join. para_key is a digest of title and context; equal
    paragraphs under one title share it. With `windows` (size, stride,
    keep_tail) a column `digests` is added, which is made once per paragraph,
    before its questions are opened.
    """
    entries = nested.select(F.inline("data"))
    paragraphs = entries.select("title", F.inline("paragraphs"))
    key = F.md5(F.concat_ws(SEPARATOR, F.coalesce("title", F.lit("")), F.coalesce("context", F.lit(""))))
    extra = {} if windows is None else {"digests": window_digests(F.col("context"), *windows)}
    keyed = paragraphs.withColumn("para_key", key).withColumns(extra)
    return keyed.select("title", "para_key", "context", *extra, F.inline("qas")).select(*QA_COLUMNS, *extra)


def split_answerable(qa: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Answerable and unanswerable questions; a null flag falls in neither."""
    return qa.filter(~F.col("is_impossible")), qa.filter(F.col("is_impossible"))


def explode_answers(qa: DataFrame) -> DataFrame:
    """One row per answer with its half-open span [span_start, span_end) in the context."""
    others = [c for c in qa.columns if c != "answers"]
    return (
        qa.select(*others, F.inline("answers"))
        .withColumnRenamed("answer_start", "span_start")
        .withColumn("span_end", F.col("span_start") + F.length("text"))
    )
