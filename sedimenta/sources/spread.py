"""Giving few large input files to more tasks, where the caller asks for it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Hash-distribute a table over ``partitions`` tasks; None leaves it as it is.

    A Parquet file is read by as many tasks as it has row groups, often one, and
    everything up to the first shuffle then runs in that task. Column pruning and
    filters still pass through to the scan. For tables of many row groups the
    exchange costs a shuffle and gains nothing, so it is never made unasked.
    """
    return df if partitions is None else df.repartition(partitions, *keys)
