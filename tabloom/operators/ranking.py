"""Ranks and running totals that never put one big group into one task.

A plain `row_number` over a group sends the whole group to one task. Here each
group is cut into ordered buckets; rows are ranked inside their bucket and the
sizes of the earlier buckets are added. Only the bucket sizes, a bounded number
per group, meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def hash_key(items: Sequence[str], seed: int | None = None) -> Column:
    """md5 over the text form of `items`: a repeatable random order with even prefixes."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in items]
    if seed is not None:
        parts.insert(0, F.lit(str(seed)))
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on `keys` with null equal to null, keeping the keys of `left`.

    A struct holds the keys: its fields compare null-safely, while the join key
    itself stays one plain column that windows and aggregates can share.
    """
    others = [c for c in right.columns if c not in keys]
    keyed = right.select(F.struct(*keys).alias("__key"), *others)
    return left.withColumn("__key", F.struct(*keys)).join(keyed, "__key", how).drop("__key")


def row_weight(present: Sequence[str] = ()) -> Column:
    """One per row, read through the never-null columns `present`."""
    one = F.lit(1).cast("long")
    for name in present:
        one = F.when(F.col(name).isNotNull(), one)
    return one


def running_totals(
    df: DataFrame,
    bucket: str,
    order: Sequence[Column],
    totals: dict[str, Column],
    groups: Sequence[str] = (),
    whole: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running totals in (`bucket`, `order`) order within `groups`.

    `bucket` must be a deterministic column that rises with the order; `totals`
    maps new column names to the expression to add up. `whole` maps further
    names to an entry of `totals` whose sum over the entire group they take.
    Window, bucket totals and join share one key, so the rows are shuffled once.
    """
    whole = whole or {}
    columns = df.columns
    if "__key" in columns:
        raise ValueError("__key is a reserved column name")
    keyed = df.withColumn("__key", F.struct(*groups, bucket))
    local_window = (
        Window.partitionBy("__key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = keyed.select("*", *[F.sum(v).over(local_window).alias(f"__l_{n}") for n, v in totals.items()])
    sizes = keyed.groupBy("__key").agg(*[F.sum(v).alias(f"__n_{n}") for n, v in totals.items()])
    group = Window.partitionBy(*[F.col("__key")[g] for g in groups])
    step = group.orderBy(F.col("__key")[bucket]).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "__key",
        *[F.coalesce(F.sum(f"__n_{n}").over(step), F.lit(0)).alias(f"__b_{n}") for n in totals],
        *[F.sum(f"__n_{n}").over(group).alias(name) for name, n in whole.items()],
    )
    return local.join(before, "__key").select(
        *columns, *[(F.col(f"__l_{n}") + F.col(f"__b_{n}")).alias(n) for n in totals], *whole
    )


def hashed_rank(
    df: DataFrame,
    groups: Sequence[str],
    items: Sequence[str],
    rank: str = "rank",
    seed: int | None = None,
    digits: int = 4,
    present: Sequence[str] = (),
    size: str | None = None,
) -> DataFrame:
    """1-based rank of each row inside `groups`, in hash order of `items`.

    `items` must tell the rows of a group apart. A large group is spread over
    16**digits buckets. `size` names a column for the size of the group, if
    wanted. `present` names further columns that are never
    null: counting the rows through them keeps them in both branches of the
    plan, which then share the shuffle that produced them.
    """
    keyed = df.withColumn("__hash", hash_key(items, seed))
    keyed = keyed.withColumn("__bucket", F.substring("__hash", 1, digits))
    ranked = running_totals(
        keyed,
        "__bucket",
        [F.col("__hash"), *[F.col(c) for c in items]],
        {rank: row_weight(present)},
        groups,
        {size: rank} if size else None,
    )
    return ranked.drop("__hash", "__bucket")


def first_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    items: Sequence[str],
    n: Column | int,
    seed: int | None = None,
    present: Sequence[str] = (),
) -> DataFrame:
    """Keep the first `n` distinct `items` of each group, `n` may differ per group.

    Which items come first is a repeatable pick (hash order). Rows of `df` must
    already be distinct on groups and items.
    """
    limit = F.lit(n) if isinstance(n, int) else n
    ranked = hashed_rank(df, groups, items, "__rank", seed, present=present)
    return ranked.filter(F.col("__rank") <= limit).drop("__rank")


def value_buckets(df: DataFrame, columns: Sequence[str], parts: int | None = None) -> dict[str, list[float]]:
    """Split points that cut each numeric column into about `parts` equal shares.

    One pass with quantile sketches; at most `parts` numbers per column reach
    the driver, by default four per shuffle partition within 64..2048.
    Exactness never depends on them, only balance does.
    """
    if parts is None:
        parts = min(max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 64), 2048)
    shares = [i / parts for i in range(1, parts)]
    found = df.approxQuantile(list(columns), shares, 0.5 / parts)
    bounds = {}
    for name, points in zip(columns, found):
        inner = sorted(set(points)) or [0.0]
        bounds[name] = [float("-inf"), *inner, float("inf")]
    return bounds


def with_value_bucket(df: DataFrame, column: str, bounds: list[float], bucket: str) -> DataFrame:
    """Add the number of the split interval that holds `column`."""
    cutter = Bucketizer(splits=bounds, inputCol=column, outputCol=bucket, handleInvalid="keep")
    return cutter.transform(df)
