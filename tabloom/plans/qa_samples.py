"""Balanced training rows (source, question, answer_start, answer_end) from QA documents.

Texts are read where they lie. Everything that is shuffled for counting,
choosing and ranking is keys and digests; the text of a chosen negative window
is cut at the very end by one join back to its paragraph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import spans
from tabloom.operators.flatten import window_digests
from tabloom.operators.ranking import first_n_per_group, join_groups
from tabloom.session import cut_lineage

SAMPLE_COLUMNS = ["source", "question", "answer_start", "answer_end"]
PAIR = ["title", "question"]
#: Pairs of title and question, with two numbers each, that may be broadcast.
BROADCAST_PAIRS = 500_000


def _count(size: int, stride: int, keep_tail: bool) -> Column:
    return spans.window_count(F.length("context").cast("int"), size, stride, keep_tail)


def _hit_range(start: Column, end: Column, count: Column, size: int, stride: int) -> tuple[Column, Column]:
    """First and last window that overlap [start, end); last < first when none does."""
    return spans.first_window(start, size, stride), spans.last_window(end, count, stride)


def positive_counts(qa: DataFrame, size: int, stride: int, keep_tail: bool = True) -> DataFrame:
    """Number of positive (answer, window) pairs per (title, question), from lengths alone."""
    def hits(answer: Column, count: Column) -> Column:
        start = answer["answer_start"]
        first, last = _hit_range(start, start + F.length(answer["text"]), count, size, stride)
        return F.coalesce(F.greatest(last - first + 1, F.lit(0)), F.lit(0)).cast("long")

    per_row = spans.let(
        _count(size, stride, keep_tail),
        lambda count: F.aggregate("answers", F.lit(0).cast("long"), lambda total, answer: total + hits(answer, count)),
    )
    return (
        qa.filter(~F.col("is_impossible"))
        .select(*PAIR, per_row.alias("n"))
        .groupBy(*PAIR)
        .agg(F.sum("n").alias("positives"))
        .filter(F.col("positives") > 0)
    )


def question_quota(pair_counts: DataFrame) -> DataFrame:
    """Per question: positives, distinct titles and their rounded ratio.

    The counts per (title, question) are added up, so no distinct count and no
    join of two aggregates is needed.
    """
    sums = pair_counts.groupBy("question").agg(
        F.sum("positives").alias("question_count"),
        F.count("title").alias("title_count"),
    )
    ratio = F.round(F.col("question_count") / F.col("title_count"), 0)
    return sums.withColumn("quota", ratio.cast("int"))


def positive_samples(qa: DataFrame, size: int, stride: int, keep_tail: bool = True) -> DataFrame:
    """Every (answer, window) pair that shares a character, with the clipped span. No shuffle."""
    count = _count(size, stride, keep_tail)
    answers = qa.filter(~F.col("is_impossible")).select(
        *PAIR, "context", F.inline("answers")
    ).select(
        *PAIR,
        "context",
        F.col("answer_start").alias("a"),
        (F.col("answer_start") + F.length("text")).alias("b"),
    )
    first, last = _hit_range(F.col("a"), F.col("b"), count, size, stride)
    hits = F.greatest(last - first + 1, F.lit(0))
    # the part of the text under the hit windows, cut once
    part = F.substring("context", first * stride + 1, (hits - 1) * stride + size)
    start = (F.col("first") + F.col("k")).cast("long") * stride
    inside = spans.clip(F.col("a"), F.col("b"), start, start + F.length("source"))
    return (
        answers.select(*PAIR, "a", "b", first.alias("first"), hits.alias("hits"), part.alias("part"))
        .filter(F.col("hits") > 0)
        .select(
            *PAIR,
            "a",
            "b",
            "first",
            F.posexplode(spans.window_texts(F.col("part"), F.col("hits"), size, stride)).alias("k", "source"),
        )
        .select(*PAIR, "source", inside[0].alias("answer_start"), inside[1].alias("answer_end"))
    )


def negative_candidates(qa: DataFrame, size: int, stride: int, keep_tail: bool = True) -> DataFrame:
    """(title, question, is_impossible, digest, place): distinct window texts that may become negatives.

    For an unanswerable question all windows, for an answerable one those that
    at least one of its answers does not touch. A text is represented by its
    digest and by one place (para_key, window_no) where it can be cut again. The
    column `digests` of `flatten_qa` is used when `qa` has it for the same
    windows; else the windows are hashed here, once per question.
    """
    digests = F.col("digests") if "digests" in qa.columns else window_digests(F.col("context"), size, stride, keep_tail)
    windows = F.transform(digests, lambda digest, k: F.struct(k.alias("window_no"), digest.alias("digest")))
    answer_spans = F.transform(
        "answers",
        lambda answer: F.struct(
            answer["answer_start"].alias("a"), (answer["answer_start"] + F.length(answer["text"])).alias("b")
        ),
    )

    def missed(window: Column, answers: Column) -> Column:
        start = window["window_no"].cast("long") * stride
        end = F.least(start + size, F.col("n_chars"))
        return F.exists(answers, lambda answer: ~spans.overlaps(answer["a"], answer["b"], start, end))

    possible = spans.let(answer_spans, lambda answers: F.filter("windows", lambda w: missed(w, answers)))
    found = F.when(F.col("is_impossible"), F.col("windows")).otherwise(possible)
    return (
        qa.filter(F.col("is_impossible").isNotNull())
        .select(*PAIR, "is_impossible", "para_key", "answers", F.length("context").cast("long").alias("n_chars"), windows.alias("windows"))
        .select(*PAIR, "is_impossible", "para_key", F.inline(found))
        .groupBy(*PAIR, "is_impossible", "digest")
        .agg(F.min(F.struct("para_key", "window_no")).alias("place"))
    )


def pair_limits(qa: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """(title, question, quota, positives) of every pair whose question has a quota; positives are null where it has none.

    Keys and counts only, stored; marked for a broadcast up to BROADCAST_PAIRS rows.
    """
    quota = question_quota(pair_counts).select("question", "quota")
    pairs = qa.select(*PAIR).distinct().join(quota, "question")
    limits = cut_lineage(pairs.join(pair_counts, PAIR, "left").select(*PAIR, "quota", "positives"))
    return F.broadcast(limits) if limits.count() <= BROADCAST_PAIRS else limits


def choose_negatives(
    qa: DataFrame, pair_counts: DataFrame, size: int, stride: int, keep_tail: bool = True
) -> DataFrame:
    """Candidates kept, per title and question: as many unanswerable windows as the quota of the
    question, and as many unanswered windows as the pair has positives.

    `pair_counts` should be a stored frame. Pairs without a limit drop out.
    """
    limits = pair_limits(qa, pair_counts)
    limited = (
        join_groups(negative_candidates(qa, size, stride, keep_tail), limits, PAIR)
        .withColumn("n", F.when(F.col("is_impossible"), F.col("quota")).otherwise(F.col("positives")))
        .filter(F.col("n").isNotNull())
    )
    return first_n_per_group(limited, [*PAIR, "is_impossible"], ["digest"], F.col("n"), present=["place"])


def cut_negatives(qa: DataFrame, places: DataFrame, size: int, stride: int) -> DataFrame:
    """Join chosen places back to their paragraphs and cut the window text; span (0, 0).

    Only paragraphs with a chosen window get past the semi-join, so that no
    other text is moved when repeated paragraphs are dropped.
    """
    wanted = places.select(F.col("place.para_key").alias("para_key")).distinct()
    paragraphs = qa.select("para_key", "context").join(wanted, "para_key", "left_semi").dropDuplicates(["para_key"])
    chosen = places.select(
        "title",
        "question",
        F.col("place.para_key").alias("para_key"),
        (F.col("place.window_no") * stride).cast("int").alias("start"),
    )
    zero = F.lit(0).cast("long")
    return chosen.join(paragraphs, "para_key").select(
        "title",
        "question",
        F.substring("context", F.col("start") + 1, F.lit(size)).alias("source"),
        zero.alias("answer_start"),
        zero.alias("answer_end"),
    )


def build_samples(
    qa: DataFrame, size: int = spans.SIZE, stride: int = spans.STRIDE, keep_tail: bool = True
) -> DataFrame:
    """Positives, balanced unanswerable windows and balanced unanswered windows.

    The counts, one row per (title, question), are stored before the balancing
    that reads them several times.
    """
    counts = cut_lineage(positive_counts(qa, size, stride, keep_tail))
    negatives = cut_negatives(qa, choose_negatives(qa, counts, size, stride, keep_tail), size, stride)
    positives = positive_samples(qa, size, stride, keep_tail)
    return positives.select(*SAMPLE_COLUMNS).unionByName(negatives.select(*SAMPLE_COLUMNS))
