"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

import uuid
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import shared_folder
from tabloom.session import cut_lineage

#: A node that more than this share of the pairs start at is a hub; there are fewer than 1 / SHARE.
SHARE = 1 / 512
#: Pairs of one partition.
ROWS = 100_000


def _with_least(pairs: DataFrame, total: int) -> DataFrame:
    """Each of the `total` pairs (u, v) with the smallest of u and its partners.

    A node with many partners is added up map-side first. What the hubs found
    comes back to their pairs by a broadcast, so that no task gets a whole hub.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    hubs = least.filter(F.col("n") > max(1.0, total * SHARE))
    seen = pairs.join(F.broadcast(hubs.select("u", F.col("m").alias("hub"))), "u", "left")
    others = seen.filter("hub IS NULL").select("u", "v").join(least.select("u", "m"), "u")
    return seen.filter("hub IS NOT NULL").select("u", "v", F.col("hub").alias("m")).unionByName(others)


def _packed(pairs: DataFrame, total: int) -> DataFrame:
    """`pairs` in as many partitions as `total` rows need: a link table is far smaller than what it came from."""
    return pairs.coalesce(max(8, total // ROWS))


def _written(pairs: DataFrame, folder: str) -> DataFrame:
    """`pairs` (u, v), written as Parquet and read again.

    The planner knows the size of a file. A checkpoint keeps its guess, which
    joins with stored frames multiply: in a loop that number gets millions of
    digits, and its arithmetic fills the driver.
    """
    pairs.write.parquet(folder)
    return pairs.sparkSession.read.schema(pairs.schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b); root is the smallest id of its component.

    Works on the link table alone, in a number of rounds that grows with the
    logarithm of the longest chain. Loops (a = b) are left out.

    The pairs after each star stay in the shared folder as files, see
    `_written`; a plan of both stars would hold its input some fifty times.
    """
    folder = f"{shared_folder(edges.sparkSession)}/links-{uuid.uuid4().hex}"
    pairs = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{folder}/edges")
    before, total = None, pairs.count()
    for turn in count():
        pairs = _packed(pairs, total)
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        ordered = _written(_packed(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), total), f"{folder}/large-{turn}")
        starred = _with_least(ordered, total)
        small = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(starred.select("u", F.col("m").alias("v")))
        pairs = _written(_packed(small.filter("u <> v").distinct(), total), f"{folder}/small-{turn}")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, total = state, state[0]
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cut_lineage(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))
