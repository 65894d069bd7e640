"""Exact duplicates by a heavy-hitter split on text digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import ascii_lower, counted_ids, table
from tabloom.llm.heavy import COUNTERS, SHARE, group_winners
from tabloom.session import cut_lineage

DIGEST_BYTES = 16
BROADCAST_DIGESTS = 1_000_000


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: float = SHARE, counters: int = COUNTERS
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per input row.

    Texts are equal when they are identical after lower-casing A-Z; their
    SHA-256 stands for them, so texts themselves are read once and never
    shuffled. The largest doc_id of a group stays.

    A null text counts as empty, and empty texts form one group. A row with a
    null id belongs to its group and stays only when the group has no other id.
    Rows that repeat id and text are one document: each of them is returned and
    counted, with the same `kept`. Other columns are not looked at. An empty
    table gives no rows.
    """
    text = ascii_lower(F.coalesce(docs[text_column].cast("string"), F.lit("")))
    keyed = cut_lineage(docs.select(docs[id_column].alias("id"), F.unhex(F.sha2(text, 256)).alias("key")))
    found = group_winners(keyed, F.max, share, counters)
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("key")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Of equal texts the rows with the largest id stay, all of them if id and
    text repeat; a row with a null id goes when its text has an id. A row goes by
    its id and the digest of its text together, so another text under the same
    id is not touched. Up to BROADCAST_DIGESTS digests of texts with dropped rows
    are broadcast (about 100 MB), and texts are not shuffled. An empty table
    gives no rows.
    """
    found = exact_duplicates(docs, id_column, text_column).filter("NOT kept")
    digest = F.substring(F.unhex("text_sha256"), 1, DIGEST_BYTES)
    gone = counted_ids(found.select(digest.alias("__gone"), F.col("keep_id").alias("__keep")), BROADCAST_DIGESTS)
    text = ascii_lower(F.coalesce(docs[text_column].cast("string"), F.lit("")))
    dropped = (F.substring(F.unhex(F.sha2(text, 256)), 1, DIGEST_BYTES) == gone["__gone"]) & ~docs[id_column].eqNullSafe(gone["__keep"])
    return docs.join(gone, dropped, "left_anti")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES = {"op4_exact_dedup": op4_exact_dedup}

SQL = {
    "op4_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)"""
}
