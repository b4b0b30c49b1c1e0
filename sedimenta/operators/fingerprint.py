"""Digests of the rows of each date, whatever their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Two hashes of 64 bits, told apart by a leading constant.
SEEDS = (1, 2)


def date_digests(rows: DataFrame, date: str) -> DataFrame:
    """(date, rows, digest): the number of rows and the sums of two hashes of each row.

    Copies count as often as they occur. Columns are taken by name, and a null is told from
    every value. Sums are wide decimals, so they never wrap, and are folded on the map side:
    one row per task and date is shuffled.
    """
    columns = sorted(c for c in rows.columns if c != date)
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")) for seed in SEEDS]
    return rows.groupBy(F.col(date).cast("date").alias(date)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws("/", *[s.cast("string") for s in sums]).alias("digest"))
