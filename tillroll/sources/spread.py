"""Parallelism of small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash the rows of an input over all cores if it has fewer splits than the cluster has cores.

    A table in one file with one row group is read by a single task, which then would also do all
    work up to the first shuffle. Large tables have more splits than cores and are left alone, so
    no shuffle is added where it would cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
