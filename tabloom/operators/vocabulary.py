"""Vocabularies, dictionary look-ups and spelling correction on token rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.vectors import doubles, zeros
from tabloom.operators.lookup import keyed_lookup
from tabloom.operators.ranking import row_weight, running_totals, value_buckets, with_value_bucket
from tabloom.session import cut_lineage

PAD, UNKNOWN = "[PAD]", "[UNKNOWN]"
START, STOP = "<START>", "<STOP>"


def token_rows(df: DataFrame, tokens: Column, keys: Sequence[str]) -> DataFrame:
    """(keys..., pos, word): one row per token."""
    return df.select(*keys, F.posexplode(tokens).alias("pos", "word"))


def gather(df: DataFrame, keys: Sequence[str], arrays: dict[str, str]) -> DataFrame:
    """Back to arrays per text in token order; a group is the tokens of one text.

    `arrays` maps the names of the arrays to the columns they hold.
    """
    columns = list(arrays.values())
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", *columns))).alias("__rows"))
    return rows.select(*keys, *[F.col("__rows")[column].alias(name) for name, column in arrays.items()])


def vocabulary(words: DataFrame, word: str = "word", specials: Sequence[str] = (PAD, UNKNOWN)) -> DataFrame:
    """word, freq, ix: distinct words and the special entries with a dense index from 0.

    Words are indexed by a digest prefix and then alphabetically: the index is
    the same on every run and no task has to hold the whole vocabulary.
    """
    ones = words.select(F.col(word).alias("word"), F.lit(1).cast("long").alias("n"))
    extra = words.sparkSession.createDataFrame([(s, 0) for s in specials], "word string, n long")
    counted = ones.unionByName(extra).groupBy("word").agg(F.sum("n").alias("freq"))
    spread = counted.withColumn("__bucket", F.substring(F.md5("word"), 1, 3))
    ranked = running_totals(spread, "__bucket", [F.col("word")], {"ix": row_weight(["freq"])})
    return ranked.select("word", "freq", (F.col("ix") - 1).alias("ix"))


def stack_splits(splits: dict[str, DataFrame], name: str = "split") -> DataFrame:
    """The rows of all frames with the name of their split; a column that one of them lacks is null there."""
    named = [df.withColumn(name, F.lit(split)) for split, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def split_vocabulary(words: DataFrame, splits: Sequence[str], word: str = "word", split: str = "split") -> DataFrame:
    """word, freq, ix as `vocabulary` over all splits, and in_<split>: how often the word stands in each.

    One index for training and validation, which also tells the words that
    training never sees. A special entry stands in no split.
    """
    each = words.groupBy(F.col(word).alias("word")).agg(*[F.count_if(F.col(split) == s).alias(f"in_{s}") for s in splits])
    whole = vocabulary(words, word)
    counts = [F.coalesce(f"in_{s}", F.lit(0).cast("long")).alias(f"in_{s}") for s in splits]
    return whole.join(each, "word", "left").select("word", "freq", "ix", *counts)


def first_seen_index(
    df: DataFrame, mark: str, order: Sequence[str], fixed: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """(mark, ix): index by first appearance; `fixed` entries take the first numbers.

    The first column of `order` must be numeric. Marks are reduced to their
    first place before they are ranked.
    """
    first = df.filter(~F.col(mark).isin(*fixed) if fixed else F.lit(True)).groupBy(mark).agg(
        F.min(F.struct(*order)).alias("first")
    )
    placed = first.withColumn("__place", F.col("first")[order[0]].cast("double"))
    bounds = value_buckets(placed, ["__place"], parts)["__place"]
    bucketed = with_value_bucket(placed, "__place", bounds, "__bucket")
    ranked = running_totals(bucketed, "__bucket", [F.col("first")], {"ix": row_weight()})
    found = ranked.select(mark, (F.col("ix") - 1 + len(fixed)).alias("ix"))
    if not fixed:
        return found
    kind = dict(df.dtypes)[mark]
    head = df.sparkSession.createDataFrame([(m, i) for i, m in enumerate(fixed)], f"`{mark}` {kind}, ix long")
    return head.unionByName(found)


def lookup_words(tokens: DataFrame, entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of token rows (keys..., pos, word) with `entries` (word, freq, value columns).

    `entries` has one row per word and should be a stored frame.
    """
    return keyed_lookup(tokens, entries.drop("freq"), "word", [*keys, "pos"])


def token_index(tokens: DataFrame, dictionary: DataFrame, keys: Sequence[str], unknown: str = UNKNOWN) -> DataFrame:
    """(keys..., pos, ix): dictionary index of every token, the index of `unknown` for the rest.

    `dictionary` has word, freq and ix.
    """
    other = dictionary.filter(F.col("word") == unknown).agg(F.max("ix")).scalar()
    looked = lookup_words(tokens, dictionary.select("word", "freq", "ix"), keys)
    return looked.select(*keys, "pos", F.coalesce("ix", other).alias("ix"))


def decode(df: DataFrame, dictionary: DataFrame, index: str, label: str) -> DataFrame:
    """Add the label of an index; `dictionary` has `label` and ix, one row per index."""
    return keyed_lookup(df, dictionary.select(F.col("ix").alias(index), label), index)


def out_of_vocabulary(words: DataFrame, known: DataFrame, word: str = "word") -> DataFrame:
    """Distinct words that `known` does not hold."""
    return words.select(word).distinct().join(known.select(word), word, "left_anti")


def _without(word: str, at: str = "__i") -> Column:
    return F.concat(F.expr(f"left({word}, {at} - 1)"), F.expr(f"substring({word}, {at} + 1)"))


def _swapped(word: str, at: str = "__i") -> Column:
    return F.expr(
        f"concat(left({word}, {at} - 1), substring({word}, {at} + 1, 1), substring({word}, {at}, 1), substring({word}, {at} + 2))"
    )


def _variants(df: DataFrame, word: str, count: Column, made) -> DataFrame:
    """A row for each of `count` variants, with its place and a short hash; the variant itself is not moved."""
    rows = df.filter(count > 0).withColumn("__i", F.explode(F.sequence(F.lit(1), count)))
    return rows.withColumn("__key", F.xxhash64(made(word)))


def spelling_fixes(words: DataFrame, known: DataFrame, min_length: int = 4) -> DataFrame:
    """(word, fixed): unknown words one insertion, deletion or neighbour swap away from a known word.

    `known` has word and freq. Edits are found by equi-joins on one-edit
    variants instead of comparing every pair; variants meet by a hash of eight
    bytes, and what meets is compared. Among several known words the most
    frequent wins, then the first in the alphabet.
    """
    vocabulary_words = known.select(F.col("word").alias("fixed"), "freq")
    # read by four joins, so stored: each would count the words anew
    strange = cut_lineage(out_of_vocabulary(words, known).filter(F.length("word") >= min_length))
    by_word = vocabulary_words.withColumn("__key", F.xxhash64("fixed"))
    # only a known word one character longer than a strange one can lose a character and match
    lengths = strange.select((F.length("word") + 1).alias("__n")).distinct()
    longer_words = vocabulary_words.withColumn("__n", F.length("fixed")).join(lengths, "__n", "left_semi").drop("__n")
    shorter = _variants(strange, "word", F.length("word"), _without).join(by_word, "__key").filter(_without("word") == F.col("fixed"))
    swapped = _variants(strange, "word", F.length("word") - 1, _swapped).join(by_word, "__key").filter(_swapped("word") == F.col("fixed"))
    by_deletion = _variants(longer_words, "fixed", F.length("fixed"), _without)
    longer = strange.withColumn("__key", F.xxhash64("word")).join(by_deletion, "__key").filter(_without("fixed") == F.col("word"))
    columns = ["word", "fixed", "freq"]
    found = shorter.select(*columns).unionByName(swapped.select(*columns)).unionByName(longer.select(*columns))
    best = found.groupBy("word").agg(F.min(F.struct((-F.col("freq")).alias("f"), "fixed")).alias("b"))
    return best.select("word", F.col("b.fixed").alias("fixed"))


def apply_fixes(tokens: DataFrame, fixes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace every token (keys..., pos, word) that has a fix."""
    looked = keyed_lookup(tokens, fixes.select("word", "fixed"), "word", [*keys, "pos"])
    return looked.withColumn("word", F.coalesce("fixed", "word")).select(*tokens.columns)


def embed(words: DataFrame, word: str, sources: Sequence[tuple[DataFrame, int]], name: str = "vector") -> DataFrame:
    """Vectors of several sources side by side; a missing word gives zeros of the source's width.

    Each source is (frame with `word` and vec, width) with one row per word.
    """
    joined = words
    for i, (vectors, _) in enumerate(sources):
        entries = vectors.select(word, doubles(F.col("vec")).alias(f"__v{i}"))
        joined = keyed_lookup(joined, entries, word, words.columns)
    parts = [F.coalesce(F.col(f"__v{i}"), zeros(width)) for i, (_, width) in enumerate(sources)]
    return joined.select(*words.columns, reduce(F.concat, parts).alias(name))
