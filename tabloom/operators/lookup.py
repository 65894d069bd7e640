"""Dictionary joins that keep frequent keys out of the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
HOT_SHARE = 256


def keyed_lookup(rows: DataFrame, entries: DataFrame, key: str, identity: Sequence[str] | None = None) -> DataFrame:
    """Left join of `rows` with `entries`, which has one row per `key`.

    The keys that more than 1/256 of `rows` carry, hence fewer than 256, are
    counted in `rows` itself, so a frequent key that `entries` lacks is found as
    well. Their entries are broadcast. Rows with such a key, and rows without a
    key, join the rest under a key of their own, made of the `identity` columns
    (all by default), which matches nothing and spreads them over the tasks. A
    missing or null key gives null values.
    """
    values = [c for c in entries.columns if c != key]
    entries = entries.select(F.col(key).cast(rows.schema[key].dataType).alias(key), F.struct(*values).alias("__entry"))
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    hot = counts.filter(F.col("__n") * HOT_SHARE > total).filter(F.col(key).isNotNull()).select(key)
    present = entries.join(F.broadcast(hot), key)
    table = hot.join(F.broadcast(present), key, "left").select(
        key, F.lit(True).alias("__is_hot"), F.col("__entry").alias("__hot")
    )
    own = F.concat(F.lit(SEPARATOR), F.xxhash64(*(identity or rows.columns)).cast("string"))
    shared = F.col("__is_hot").isNull() & F.col(key).isNotNull()
    seen = rows.join(F.broadcast(table), key, "left").withColumn(
        "__look", F.when(shared, F.col(key).cast("string")).otherwise(own)
    )
    rest = entries.select(F.col(key).cast("string").alias("__look"), F.col("__entry").alias("__rest"))
    found = F.coalesce("__hot", "__rest")
    return seen.join(rest.filter(F.col("__look").isNotNull()), "__look", "left").select(
        *rows.columns, *[found[v].alias(v) for v in values]
    )
