"""Writing partitioned Parquet with partition-level replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sedimenta.session import freed_shuffles


def cluster_for_write(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one folder together without tying a folder to one task.

    The rebalance exchange hashes on ``columns``, and at run time splits what is
    too large and joins what is too small, so a heavy date is written by many
    tasks and a light one does not leave a file per task.
    """
    return df.hint("rebalance", *columns)


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    cluster: bool = True,
    prune_stale: bool = False,
) -> None:
    """Replace the partitions present in ``df`` and leave the others alone.

    An empty frame touches no partition. ``prune_stale`` replaces the whole
    dataset instead, so partitions absent from ``df`` go away; it cannot be used
    on a path that ``df`` itself reads, and a failed run leaves the dataset to be
    written again.
    """
    if cluster:
        df = cluster_for_write(df, by)
    with freed_shuffles(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if prune_stale else "dynamic")
            .option("compression", "snappy")
            .partitionBy(*by)
            .parquet(path)
        )
