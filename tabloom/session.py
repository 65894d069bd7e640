"""Session settings shared by the tests and the benchmark.

On a cluster the caller brings its own session; nothing in the library builds
one or depends on the values set here.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names in spark.checkpoint.dir.

    Only a session on one machine gets a folder of its own when none is set; on
    a cluster executors could not share it, so there the setting is required.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tabloom-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the reliable checkpoint folder.

    Used where a frame feeds many model fits: its rows stay fixed and survive
    the loss of executors, which a cached block would not.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a frame that has fewer splits than the session has cores.

    Meant for small inputs with heavy work per row, such as one file of texts.
    An input that already fills the cores is returned as it is, so nothing is
    shuffled on large data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
