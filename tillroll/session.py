"""Session settings and the checkpoint rule shared by all jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(name: str = "tillroll", cores: int | str = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pinned(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and continue from there.

    Later steps then see the same partitions however often they are evaluated, and a lost
    executor costs a re-read instead of a recomputation. The folder is the one the session
    names in ``spark.checkpoint.dir``; only a local session without one gets a temporary folder.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the checkpoint folder, for tables of lines that are read several times.

    Columns that a later step does not read cost it nothing, and text takes little room.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="tillroll-checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()
