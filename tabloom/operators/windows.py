"""Character windows over long texts and answer spans inside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import spans

POSITIVE = "positive"
POSSIBLE_NEGATIVE = "possible negative"
IMPOSSIBLE_NEGATIVE = "impossible negative"


def char_windows(
    df: DataFrame,
    text: str = "text",
    size: int = spans.SIZE,
    stride: int = spans.STRIDE,
    keep_tail: bool = True,
) -> DataFrame:
    """One row per overlapping window: window_no, win_start, win_end, source.

    The text column is dropped, the other columns are repeated.
    """
    length = F.length(text).cast("int")
    count = spans.window_count(length, size, stride, keep_tail)
    texts = spans.window_texts(F.col(text), count, size, stride)
    others = [c for c in df.columns if c != text]
    start = F.col("window_no").cast("long") * stride
    return df.select(*others, F.posexplode(texts).alias("window_no", "source")).select(
        *others,
        "window_no",
        start.alias("win_start"),
        (start + F.length("source")).alias("win_end"),
        "source",
    )


def window_bounds(
    df: DataFrame,
    length: str = "n_chars",
    size: int = spans.SIZE,
    stride: int = spans.STRIDE,
    keep_tail: bool = True,
) -> DataFrame:
    """The offsets of `char_windows` from text lengths alone, without reading the text."""
    count = spans.window_count(F.col(length).cast("int"), size, stride, keep_tail)
    start = F.col("window_no").cast("long") * stride
    return (
        df.withColumn("window_no", F.explode(spans.numbers_below(count)))
        .withColumn("win_start", start)
        .withColumn("win_end", F.least(F.col("win_start") + size, F.col(length).cast("long")))
    )


def label_spans(df: DataFrame) -> DataFrame:
    """Add `type`: does the answer [span_start, span_end) share a character with the window?"""
    hit = spans.overlaps(*[F.col(c) for c in ("span_start", "span_end", "win_start", "win_end")])
    return df.withColumn("type", F.when(hit, POSITIVE).otherwise(POSSIBLE_NEGATIVE))


def clip_spans(df: DataFrame) -> DataFrame:
    """Add answer_start and answer_end, the answer offsets inside the window; (0, 0) for negatives."""
    inside = spans.clip(*[F.col(c) for c in ("span_start", "span_end", "win_start", "win_end")])
    positive = F.col("type") == POSITIVE
    zero = F.lit(0).cast("long")
    return df.withColumn("answer_start", F.when(positive, inside[0]).otherwise(zero)).withColumn(
        "answer_end", F.when(positive, inside[1]).otherwise(zero)
    )
