"""Heavy-hitter split: groups that hold a large share of the rows are answered map-side.

A Misra-Gries summary of bounded size is made in each partition. The summaries
are added up, and the few keys that can still be frequent are counted exactly.
Only those verified keys, at most 1/share of them whatever the input, are
broadcast; rows of all other keys meet in ordinary shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.session import cut_lineage

SHARE = 1 / 1024
COUNTERS = 4096


def merge_counters(counters: dict, more: dict, size: int) -> dict:
    """Misra-Gries merge: add the counts; if over `size` keys remain, take the (size+1)-th largest count off each."""
    for key, count in more.items():
        counters[key] = counters.get(key, 0) + count
    if len(counters) <= size:
        return counters
    off = sorted(counters.values(), reverse=True)[size]
    return {key: count - off for key, count in counters.items() if count > off}


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for found in batch.column(0).value_counts().to_pylist():
                counters[found["values"]] = counters.get(found["values"], 0) + found["counts"]
            if len(counters) > size:
                counters = merge_counters(counters, {}, size)
        keys, counts = [None, *counters], [rows, *counters.values()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], ["key", "count"])

    return run


def frequent_keys(keyed: DataFrame, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """(key): at most 1 / (share - 1/(counters+1)) keys, among them every one of at least `share` of the rows.

    `keyed` is a stored frame with a binary, never-null column `key`. A counter
    is too small by at most rows/(counters+1), also after adding up, so no
    frequent key falls below the limit.
    """
    parts = keyed.select("key").mapInArrow(_summaries(counters), "key binary, count bigint")
    sums = cut_lineage(parts.groupBy("key").agg(F.sum("count").alias("count")))
    rows = sums.filter(F.col("key").isNull()).agg(F.sum("count")).first()[0] or 0
    least = max(1.0, rows * (share - 1 / (counters + 1)))
    return sums.filter(F.col("key").isNotNull() & (F.col("count") >= least)).select("key")


def group_winners(
    keyed: DataFrame, winner: Callable[[str], Column] = F.max, share: float = SHARE, counters: int = COUNTERS
) -> DataFrame:
    """(id, key, keep_id, group_size) for each row of the stored frame `keyed` (id, key).

    keep_id is `winner` over the ids of the key, group_size its number of rows.
    """
    facts = [winner("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    suspects = F.broadcast(frequent_keys(keyed, share, counters))
    verified = cut_lineage(keyed.join(suspects, "key").groupBy("key").agg(*facts))
    marked = keyed.join(F.broadcast(verified), "key", "left")
    heavy = marked.filter(F.col("group_size").isNotNull())
    rest = marked.filter(F.col("group_size").isNull()).select("id", "key")
    light = rest.join(rest.groupBy("key").agg(*facts), "key")
    columns = ["id", "key", "keep_id", "group_size"]
    return heavy.select(*columns).unionByName(light.select(*columns))
