"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Only DataFrame functions. Test items are the short side. They are cut into
partitions by their number of shingles, each spanning a factor of two. The
MinHash sketch of an item is its k smallest shingle hashes; k follows from the
upper end of its partition so that a document with the wanted share of the
item must hold at least one of them. Documents are looked up by their own
shingle hashes and only those with enough shingles stay; what is found is
counted exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import WORD_BREAK, ascii_lower, counted_ids, table
from tabloom.session import cut_lineage

WORDS = 5
CONTAINMENT = 0.8
BROADCAST_BYTES = 64 << 20
SKETCH_ROW_BYTES = 64


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """array<bigint>, 64-bit hashes of all runs of `words` words; a shorter text is one run, a text without words none.

    Words are what white space separates, with A-Z lower-cased. Every word is
    hashed once, a run from the hashes of its words.
    """
    found = F.filter(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), WORD_BREAK), lambda w: w != "")
    hashes = F.transform(found, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        parts = lambda i: [F.get(h, i + k) for k in range(words)]
        starts = F.sequence(F.lit(0), F.size(h) - words)
        long = F.transform(starts, lambda i: F.xxhash64(*parts(i)))
        short = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= words, long).otherwise(short)

    return F.element_at(F.transform(F.array(hashes), runs), 1)


def sketch_length(largest: int, share: float) -> int:
    """Fewest sketch hashes that a document with `share` of an item of at most `largest` shingles cannot miss."""
    return largest - math.ceil(share * largest - 1e-9) + 1


def item_sketches(items: DataFrame, share: float, words: int = WORDS) -> DataFrame:
    """(item_id, items_size, hash, in_sketch): the distinct shingles of each item; those of the MinHash sketch are marked."""
    sets = items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("item_text"), words))).alias("hashes"))
    sized = sets.filter(F.size("hashes") > 0).withColumn("item_size", F.size("hashes"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("item_size"))))  # the partition (upper/2, upper]
    k = (upper - F.ceil(upper * share - 1e-9) + 1).cast("int")
    return sized.select("item_id", "item_size", k.alias("k"), F.posexplode("hashes").alias("at", "hash")).select(
        "item_id", "item_size", "hash", (F.col("at") < F.col("k")).alias("in_sketch")
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    share: float = CONTAINMENT,
    words: int = WORDS,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for each document that holds at least `share` of an item.

    Containment is the share of the distinct shingles of the item that the
    whole document has, wherever they stand. Null and empty texts have no
    shingles and never match; an item of fewer words than a shingle matches
    documents of exactly the same words. A repeated id counts as one document
    or item, with the shingles of all its rows; rows with a null id are left
    out. Empty tables give no rows; other columns are not looked at.

    The shingles of the items are broadcast when their counted size is below
    64 MB, else the joins shuffle by hash.
    """
    d = docs.select(docs[doc_id].alias("doc_id"), docs[doc_text].alias("doc_text")).filter(F.col("doc_id").isNotNull())
    i = items.select(items[item_id].alias("item_id"), items[item_text].alias("item_text")).filter(F.col("item_id").isNotNull())
    shingles = cut_lineage(item_sketches(i, share, words).dropDuplicates(["item_id", "hash"]))
    small = shingles.count() * SKETCH_ROW_BYTES <= BROADCAST_BYTES
    sketch = shingles.filter("in_sketch").select("hash", "item_id", "item_size")
    hashed = d.select("doc_id", shingle_hashes(F.col("doc_text"), words).alias("hashes"))
    looked_up = hashed.select("doc_id", F.size("hashes").alias("doc_size"), F.explode("hashes").alias("hash"))
    candidates = (
        looked_up.join(F.broadcast(sketch) if small else sketch, "hash")
        .filter(F.col("doc_size") >= F.ceil(F.col("item_size") * share - 1e-9))
        .groupBy("doc_id", "item_id")
        .agg(F.max("item_size").alias("n_item"))
    )
    candidates = cut_lineage(candidates)
    wanted = d.join(counted_ids(candidates.select("doc_id")), "doc_id", "left_semi")
    again = wanted.select("doc_id", F.explode(F.array_distinct(shingle_hashes(F.col("doc_text"), words))).alias("hash"))
    every = shingles.select("hash", "item_id")
    shared = (
        again.join(F.broadcast(every) if small else every, "hash")
        .groupBy("doc_id", "item_id")
        .agg(F.count_distinct("hash").alias("n_shared"))
    )
    ratio = F.col("n_shared") / F.col("n_item")
    return (
        shared.join(candidates, ["doc_id", "item_id"])
        .filter(F.col("n_shared") >= F.ceil(F.col("n_item") * share - 1e-9))
        .select("doc_id", "item_id", "n_shared", F.col("n_item").cast("bigint").alias("n_item"), F.round(ratio, 6).alias("containment"))
    )


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {"op7_decontaminate": op7_decontaminate}


def _runs(source: str, key: str) -> str:
    words = (
        "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\r\f\v]+'), lambda w: w <> '')"
    )
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5
                 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
             FROM (SELECT {key}, {words} AS w FROM {source})"""


SQL = {
    "op7_decontaminate": f"""
        WITH d AS ({_runs('documents', 'doc_id')}), b AS ({_runs('benchmark', 'item_id')}),
        n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
        SELECT doc_id, item_id, count(*) AS n_shared, n_item, round(count(*) / n_item, 6) AS containment
        FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item
        HAVING count(*) >= ceil(n_item * 0.8 - 1e-9)"""
}
