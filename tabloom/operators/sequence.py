"""Tag sequences: transition and emission tables, path scores, best paths.

A sentence is one row with two arrays of equal length, tokens and tags. The
tag inventory is small; its tables travel with the rows as one constant struct,
so that scoring needs no join except the look-up of the tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.lookup import keyed_lookup
from tabloom.operators.vocabulary import START, STOP, gather, lookup_words

SMOOTHING = 1.0


def _bigrams(tags: str) -> Column:
    """Neighbouring tags of a sentence, with the steps from START and to STOP."""
    before = F.concat(F.array(F.lit(START)), F.col(tags))
    after = F.concat(F.col(tags), F.array(F.lit(STOP)))
    return F.zip_with(before, after, lambda p, t: F.struct(p.alias("prev"), t.alias("tag")))


def transitions(sentences: DataFrame, tags: str = "tags", smoothing: float = SMOOTHING) -> DataFrame:
    """(prev, tag, n, score): smoothed log-frequency of every allowed step.

    Nothing enters START and nothing leaves STOP. Pairs are cut inside the rows,
    so only the counts are shuffled.
    """
    counts = (
        sentences.select(F.inline(_bigrams(tags))).groupBy("prev", "tag").agg(F.count(F.lit(1)).alias("n"))
    )
    inventory = counts.agg(F.array_sort(F.collect_set(F.when(F.col("tag") != STOP, F.col("tag")))).alias("all"))
    pairs = inventory.select(
        "all", F.explode(F.concat(F.array(F.lit(START)), "all")).alias("prev")
    ).select("prev", F.explode(F.concat("all", F.array(F.lit(STOP)))).alias("tag"), (F.size("all") + 1).alias("k"))
    totals = counts.groupBy("prev").agg(F.sum("n").alias("total"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return (
        pairs.join(counts, ["prev", "tag"], "left")
        .join(totals, "prev", "left")
        .select(
            "prev",
            "tag",
            n.alias("n"),
            F.log((n + smoothing) / (F.coalesce("total", F.lit(0)) + smoothing * F.col("k"))).alias("score"),
        )
    )


def emissions(
    sentences: DataFrame, tokens: str = "tokens", tags: str = "tags", smoothing: float = SMOOTHING
) -> DataFrame:
    """(tag, word, n, score): smoothed log-frequency of a word under a tag, for the pairs seen."""
    pairs = sentences.select(F.inline(F.arrays_zip(F.col(tokens).alias("word"), F.col(tags).alias("tag"))))
    counts = pairs.groupBy("tag", "word").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("tag").agg(F.sum("n").alias("total"))
    words = counts.select(F.struct(F.count_distinct("word").alias("v"))).scalar()
    score = F.log((F.col("n") + smoothing) / (F.col("total") + smoothing * (words["v"] + 1)))
    return keyed_lookup(counts, totals, "tag", ["tag", "word"]).select("tag", "word", "n", score.alias("score"))


def tagger(steps: DataFrame, seen: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with the tables of a tagger: tags, start, step (to x from), stop, unseen.

    `steps` and `seen` come from `transitions` and `emissions` and should be
    stored frames.
    """
    scores = steps.agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "prev", "tag"), "score"))).alias("m"),
        F.array_sort(F.collect_set(F.when(F.col("tag") != STOP, F.col("tag")))).alias("tags"),
    )
    totals = (
        seen.groupBy("tag").agg(F.sum("n").alias("total")).agg(
            F.map_from_entries(F.collect_list(F.struct("tag", "total"))).alias("totals")
        )
    )
    words = seen.agg(F.count_distinct("word").alias("v"))
    one = scores.withColumn("totals", totals.scalar()).withColumn("v", words.scalar())

    def score(prev: Column, tag: Column) -> Column:
        return F.element_at("m", F.concat_ws("\x1f", prev, tag))

    return one.select(
        F.struct(
            "tags",
            F.transform("tags", lambda t: score(F.lit(START), t)).alias("start"),
            F.transform("tags", lambda t: F.transform("tags", lambda p: score(p, t))).alias("step"),
            F.transform("tags", lambda t: score(t, F.lit(STOP))).alias("stop"),
            F.transform(
                "tags",
                lambda t: F.log(smoothing / (F.element_at("totals", t) + smoothing * (F.col("v") + 1))),
            ).alias("unseen"),
        ).alias("tagger")
    )


def with_emissions(
    sentences: DataFrame,
    keys: Sequence[str],
    seen: DataFrame,
    model: DataFrame,
    tokens: str = "tokens",
    tags: str | None = "tags",
) -> DataFrame:
    """(keys..., tags, emit, tagger); emit holds per token the scores under the tagger's tags.

    Given tags travel with their tokens, so the sentences need no join of their
    own. Pass `tags=None` for sentences without tags.
    """
    by_word = seen.groupBy("word").agg(
        F.sum("n").alias("freq"), F.map_from_entries(F.collect_list(F.struct("tag", "score"))).alias("by_tag")
    )
    dense = by_word.withColumn("tagger", model.scalar()).select(
        "word",
        "freq",
        F.zip_with(
            "tagger.tags", "tagger.unseen", lambda t, u: F.coalesce(F.try_element_at(F.col("by_tag"), t), u)
        ).alias("scores"),
    )
    parallel = F.arrays_zip(F.col(tokens).alias("word"), *([F.col(tags).alias("tag")] if tags else []))
    rows = sentences.select(*keys, F.posexplode(parallel).alias("pos", "t")).select(*keys, "pos", "t.*")
    arrays = {"emit": "scores"} | ({tags: "tag"} if tags else {})
    gathered = gather(lookup_words(rows, dense, keys), keys, arrays).withColumn("tagger", model.scalar())
    return gathered.withColumn("emit", F.transform("emit", lambda e: F.coalesce(e, F.col("tagger.unseen"))))


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _lse(values: Column) -> Column:
    """Stable log of the sum of exponents of an array."""

    def total(top: Column) -> Column:
        return top + F.log(F.aggregate(values, F.lit(0.0), lambda t, x: t + F.exp(x - top)))

    return F.element_at(F.transform(F.array(F.array_max(values)), total), 1)


def path_score(tags: str) -> Column:
    """Score of the given tagging: steps, emissions and the step to STOP."""
    places = F.transform(F.col(tags), lambda t: F.array_position("tagger.tags", t).cast("int"))

    def add(state: Column, item: Column) -> Column:
        step = F.when(state["prev"] == 0, F.element_at("tagger.start", item["ix"])).otherwise(
            F.element_at(F.element_at("tagger.step", item["ix"]), F.greatest(state["prev"], F.lit(1)))
        )
        return F.struct(
            (state["score"] + step + F.element_at(item["e"], item["ix"])).alias("score"), item["ix"].alias("prev")
        )

    items = F.zip_with(places, F.col("emit"), lambda ix, e: F.struct(ix.alias("ix"), e.alias("e")))
    begin = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("prev"))
    return F.aggregate(items, begin, add, lambda s: s["score"] + F.element_at("tagger.stop", s["prev"]))


def _first() -> Column:
    return _add(F.col("tagger.start"), F.element_at("emit", 1))


def _rest() -> Column:
    return F.slice("emit", F.lit(2), F.greatest(F.size("emit") - 1, F.lit(0)))


def _forward(score: Column, emit: Column) -> Column:
    """Best scores after one more token; the emission is added after the maximum."""
    return F.zip_with(F.col("tagger.step"), emit, lambda row, e: F.array_max(_add(score, row)) + e)


def _arg_max(values: Column) -> Column:
    """1-based place of the first maximum."""
    return F.array_position(values, F.array_max(values)).cast("int")


def _blocks() -> Column:
    """The emissions behind the first token in blocks of about the square root of their number."""
    rest = F.size("emit") - 1
    width = F.greatest(F.ceil(F.sqrt(rest)).cast("int"), F.lit(1))
    count = F.ceil(rest / width).cast("int")
    numbers = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)
    return F.transform(numbers, lambda b: F.slice("emit", b * width + 2, width))


def best_path() -> Column:
    """struct(score, tags) of the best tagging; first maximum wins.

    The way forward keeps the scores at the start of each block only. The way
    back computes the scores inside one block again and follows the best places
    through them, so no array grows with every token of the sentence.
    """
    marks_type = "array<struct<begin:array<double>,emits:array<array<double>>>>"

    def ahead(state: Column, block: Column) -> Column:
        mark = F.struct(state["score"].alias("begin"), block.alias("emits"))
        return F.struct(
            F.aggregate(block, state["score"], _forward).alias("score"),
            F.concat(state["marks"], F.array(mark)).alias("marks"),
        )

    def back(parts: Column, mark: Column) -> Column:
        but_last = F.slice(mark["emits"], F.lit(1), F.size(mark["emits"]) - 1)
        scores = F.aggregate(
            but_last, F.array(mark["begin"]), lambda s, e: F.concat(s, F.array(_forward(F.element_at(s, -1), e)))
        )
        places = F.aggregate(
            F.reverse(scores),
            F.array(F.element_at(F.element_at(parts, -1), -1)),
            lambda p, s: F.concat(p, F.array(_arg_max(_add(s, F.element_at("tagger.step", F.element_at(p, -1)))))),
        )
        return F.concat(parts, F.array(F.slice(places, F.lit(2), F.size(mark["emits"]))))

    def finish(state: Column) -> Column:
        end = _add(state["score"], F.col("tagger.stop"))
        places = F.flatten(F.aggregate(F.reverse(state["marks"]), F.array(F.array(_arg_max(end))), back))
        tags = F.transform(F.reverse(places), lambda i: F.element_at("tagger.tags", i))
        return F.struct(F.array_max(end).alias("score"), tags.alias("tags"))

    begin = F.struct(_first().alias("score"), F.array().cast(marks_type).alias("marks"))
    return F.aggregate(_blocks(), begin, ahead, finish)


def log_partition() -> Column:
    """Log of the summed exponent scores of all taggings."""

    def step(score: Column, emit: Column) -> Column:
        return F.zip_with(F.col("tagger.step"), emit, lambda row, e: _lse(_add(score, row)) + e)

    return F.aggregate(_rest(), _first(), step, lambda score: _lse(_add(score, F.col("tagger.stop"))))


def score_paths(scored: DataFrame, keys: Sequence[str], tags: str = "tags") -> DataFrame:
    """(keys..., score) of the given taggings."""
    return scored.select(*keys, path_score(tags).alias("score"))


def decode_paths(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., score, path): the best tagging of every sentence."""
    return scored.select(*keys, best_path().alias("b")).select(
        *keys, F.col("b.score").alias("score"), F.col("b.tags").alias("path")
    )


def negative_log_likelihood(scored: DataFrame, keys: Sequence[str], tags: str = "tags") -> DataFrame:
    """(keys..., nll): log-partition minus the score of the given tagging."""
    return scored.select(*keys, (log_partition() - path_score(tags)).alias("nll"))
