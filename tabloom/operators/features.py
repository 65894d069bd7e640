"""Feature encoding, scaling, splitting and weighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators import skipgram
from tabloom.operators.ranking import hash_key, hashed_rank, join_groups
from tabloom.session import cut_lineage

#: Classes whose weights may be broadcast.
BROADCAST_CLASSES = 100_000


def ordinal_encoder(columns: Sequence[str], suffix: str = "_code") -> StringIndexer:
    """Codes by sorted value, fitted once; values not seen in training get the next code."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def ordinal_encode(train: DataFrame, columns: Sequence[str], *others: DataFrame) -> list[DataFrame]:
    """`train` and `others` with integer codes in place of the category columns."""
    model = ordinal_encoder(columns).fit(train)

    def apply(df: DataFrame) -> DataFrame:
        codes = {c: F.col(f"{c}_code").cast("int") for c in columns}
        return model.transform(df).withColumns(codes).drop(*[f"{c}_code" for c in columns])

    return [apply(df) for df in (train, *others)]


def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels per category column: one aggregate, one row to the driver."""
    row = df.agg(*[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def one_hot_columns(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Every level becomes a 0/1 column `col_level`; the category columns go.

    Pass the levels of the training frame for all frames, so that their
    columns agree.
    """
    flags = [
        F.when(F.col(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}") for c, vs in levels.items() for v in vs
    ]
    return df.select(*[c for c in df.columns if c not in levels], *flags)


def min_max_scale(train: DataFrame, columns: Sequence[str], *others: DataFrame) -> list[DataFrame]:
    """Columns scaled to [0, 1] by the range of `train`; a constant column becomes 0.5."""
    limits = train.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        )
    )

    def scaled(range_: Column, c: str) -> Column:
        low, high = range_[f"lo_{c}"], range_[f"hi_{c}"]
        return F.when(high > low, (F.col(c) - low) / (high - low)).when(F.col(c).isNotNull(), F.lit(0.5))

    def apply(df: DataFrame) -> DataFrame:
        wide = df.withColumn("__range", limits.scalar())
        return wide.withColumns({c: scaled(F.col("__range"), c) for c in columns}).drop("__range")

    return [apply(df) for df in (train, *others)]


def feature_pipeline(
    numeric: Sequence[str], categories: Sequence[str] = (), one_hot: bool = True, scale: bool = True
) -> Pipeline:
    """Index, one-hot encode (no level dropped), scale and assemble into `features`."""
    codes = [f"{c}_code" for c in categories]
    stages: list = []
    if categories:
        stages.append(ordinal_encoder(categories))
    inputs = codes
    if categories and one_hot:
        inputs = [f"{c}_flags" for c in categories]
        stages.append(OneHotEncoder(inputCols=codes, outputCols=inputs, dropLast=False, handleInvalid="keep"))
    block = "numbers_scaled" if scale else "numbers"
    stages.append(VectorAssembler(inputCols=list(numeric), outputCol="numbers", handleInvalid="keep"))
    if scale:
        stages.append(MinMaxScaler(inputCol="numbers", outputCol=block))
    stages.append(VectorAssembler(inputCols=[block, *inputs], outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def hash_share(items: Sequence[str], seed: int) -> Column:
    """A repeatable uniform number in [0, 1) per row key."""
    return F.conv(F.substring(hash_key(items, seed), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def hash_split(df: DataFrame, key: str, share: float = 0.7, seed: int = 42) -> DataFrame:
    """Add `part` = train or test by a hash of the key: stable under any partitioning, no shuffle."""
    return df.withColumn("part", F.when(hash_share([key], seed) < share, "train").otherwise("test"))


def _label_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("__size"))


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add `part`: in each label class the first `share` of the rows, in hash order, are train."""
    sized = hashed_rank(df, [label], [key], "__rank", seed, size="__size")
    limit = F.round(F.col("__size") * share)
    return sized.withColumn("part", F.when(F.col("__rank") <= limit, "train").otherwise("test")).drop(
        "__rank", "__size"
    )


def fold_assignment(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add `fold` in 0..folds-1, dealt out in hash order inside each label class."""
    ranked = hashed_rank(df, [label], [key], "__rank", seed)
    return ranked.withColumn("fold", F.pmod(F.col("__rank") - 1, F.lit(folds)).cast("int")).drop("__rank")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): n / (classes * class size)."""
    sizes = _label_sizes(df, label)
    totals = sizes.agg(F.struct(F.sum("__size").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return sizes.select(label, (totals["n"] / (totals["k"] * F.col("__size"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add the balanced weight of each row's class.

    The weights, one row per class, are stored and counted: up to
    BROADCAST_CLASSES of them are broadcast, so that even a class with most of
    the rows is not shuffled; more are joined by a shuffle.
    """
    weights = cut_lineage(class_weights(df, label).withColumnRenamed("weight", name))
    small = weights.count() <= BROADCAST_CLASSES
    return join_groups(df, F.broadcast(weights) if small else weights, [label], "left")


def word_vectors(
    sentences: DataFrame,
    tokens: str,
    size: int = 100,
    window: int = 3,
    min_count: int = 1,
    seed: int = 42,
    parts: int | None = None,
) -> DataFrame:
    """(word, vec): skip-gram word vectors of the token arrays, see `skipgram`.

    Training runs on `parts` partitions, by default one per core; with one
    partition a single task would read all sentences.
    """
    parts = parts or sentences.sparkSession.sparkContext.defaultParallelism
    return skipgram.word_vectors(sentences, tokens, size, window, min_count, seed, parts)
