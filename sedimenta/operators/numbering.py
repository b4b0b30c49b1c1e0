"""Numbers without gaps for the rows of a table, without sorting it in one place."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import freed_shuffles, scratch_path

# A monotonic id is a partition number followed by the row's place in that partition.
PLACE_BITS = 33
# Offsets are one pair of longs per partition of the table; beyond this many they are not broadcast.
BROADCAST_PARTITIONS = 1_000_000


def dense_ids(df: DataFrame, column: str, first: int = 1) -> DataFrame:
    """``df`` with ``column`` counting from ``first`` in the order of its partitions and their rows.

    Two steps: every partition numbers its own rows, and the number of rows before a partition,
    a sum over one count per partition, is added. The rows are written in between, so that a
    task that runs again finds the same numbers; the counts are the only thing the driver sees.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    local = df.withColumn(column, F.monotonically_increasing_id())
    part = F.shiftright(column, PLACE_BITS)
    with freed_shuffles(spark):
        local.write.parquet(path)
        stored = spark.read.schema(local.schema).parquet(path)
        counts = sorted(tuple(r) for r in stored.groupBy(part).count().collect())
    before = accumulate((n for _, n in counts[:-1]), initial=first)
    names = [c.lower() for c in df.columns]
    key, offset = "part", "offset"
    while key in names or offset in names:
        key, offset = f"_{key}", f"_{offset}"
    offsets = spark.createDataFrame([(p, n) for (p, _), n in zip(counts, before)], f"{key} long, {offset} long")
    if len(counts) <= BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    place = F.col(column).bitwiseAND((1 << PLACE_BITS) - 1)
    return stored.withColumn(key, part).join(offsets, key).withColumn(column, F.col(offset) + place).select(*df.columns, column)
