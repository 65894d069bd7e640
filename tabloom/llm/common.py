"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import cut_lineage, ensure_checkpoint_dir

WORD_BREAK = r"[ \t\n\r\f\x0B]+"


#: Ids that may be broadcast: at 4 million, 8 bytes each, the hashed relation takes about 100 MB.
BROADCAST_IDS = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(mapped)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as the session names it."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def whole_batches(spark: SparkSession, megabytes: int = 16) -> None:
    """Bound the Arrow batches by bytes, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def hash_prefix(df: DataFrame, total: int, rows: int, key: Column) -> DataFrame:
    """The rows of `df`, which has `total`, whose hash lies in a prefix of the hash range that should hold four times `rows`.

    Filter with it before taking the first `rows` by the same hash: otherwise
    each task sends its own first `rows`, which grows with the number of tasks.
    """
    if total <= 4 * rows:
        return df
    return df.filter(key < F.lit(-(2**63) + 4 * rows * 2**64 // total))


def counted(df: DataFrame, most: int) -> DataFrame:
    """`df`, stored and counted; marked for a broadcast when it has at most `most` rows.

    The planner sees no size in a stored frame and would shuffle both sides of
    a join with it, whole texts included. Beyond the bound it still does.
    """
    stored = cut_lineage(df)
    return F.broadcast(stored) if stored.count() <= most else stored


def counted_ids(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """Distinct ids, stored and broadcast up to `most`, see `counted`."""
    return counted(ids.distinct(), most)
