"""Sharding by Karmarkar-Karp differencing, with equal texts kept together.

Differencing starts with every group of equal texts as a partial partition (all its
bytes in one part, nothing in the others) and repeatedly combines the two partial
partitions with the largest spread, the heaviest part of one with the lightest of the
other. Combining is associative in kind: groups are dealt to cells of about ``CELL``
groups by hash, each cell is differenced in its own task to one partial partition, and
those are differenced in cells again until one is left. No task holds more than a cell.

Defined cases: a null text has no bytes and shares the group of the empty text; equal
texts are indivisible, however many there are, so a group larger than a fair share
makes a shard of that size; an empty table gives an empty result; columns other than
the id and the text are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import staged

SHARDS = 24
ROW_BYTES = 8
CELL = 2000
RUN = 1000


def difference(loads: np.ndarray) -> np.ndarray:
    """Difference n partial partitions of k parts (n x k loads) into one.

    Row i, column j of the result is the part of the whole that part j of partition i
    goes to. Ties go to the earlier partition, so the result is deterministic.
    """
    n, k = loads.shape
    order = [np.argsort(-row, kind="stable") for row in loads]
    parts = [row[o] for row, o in zip(loads, order)]
    children: list[tuple[int, int] | None] = [None] * n
    heap = [(-int(p[0] - p[-1]), i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = parts[a] + parts[b][::-1]
        o = np.argsort(-joined, kind="stable")
        joined = joined[o]
        parts[a] = parts[b] = None
        parts.append(joined)
        order.append(o)
        children.append((a, b))
        heapq.heappush(heap, (-int(joined[0] - joined[-1]), len(parts) - 1))
    places: list[np.ndarray | None] = [None] * len(parts)
    if parts:
        places[-1] = np.arange(k)
    result = np.empty((n, k), dtype=np.int32)
    for node in range(len(parts) - 1, -1, -1):
        raw = np.empty(k, dtype=np.int64)
        raw[order[node]] = places[node]
        places[node] = None
        if children[node] is None:
            result[node] = raw
        else:
            a, b = children[node]
            places[a], places[b] = raw, raw[::-1]
    return result


def _difference_cells(items: DataFrame, key: str, shards: int) -> DataFrame:
    """Difference each cell of (cell, key, part, bytes): (key, part, cell, to)."""

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, at = np.unique(pdf[key].to_numpy(), return_inverse=True)
        loads = np.zeros((len(keys), shards), dtype=np.int64)
        loads[at, pdf["part"].to_numpy()] = pdf["bytes"].to_numpy()
        to = difference(loads)
        return pd.DataFrame({
            key: pdf[key], "part": pdf["part"], "cell": pdf["cell"],
            "to": to[at, pdf["part"].to_numpy()], "bytes": pdf["bytes"]})

    kind = dict(items.dtypes)[key]
    return items.groupBy("cell").applyInPandas(
        cell, f"{key} {kind}, part int, cell long, to int, bytes long")


def assign(groups: DataFrame, shards: int = SHARDS, cell: int = CELL) -> DataFrame:
    """(grp string, bytes long) to (grp, shard); the byte sums of shards come out nearly equal."""
    n = groups.count()
    cells = max(1, -(-n // cell))
    items = groups.select(
        "grp", F.lit(0).alias("part"), "bytes", F.pmod(F.xxhash64("grp"), F.lit(cells)).alias("cell"))
    placed = staged(_difference_cells(items, "grp", shards), "shard-cells")
    levels = []
    level = placed
    while cells > 1:
        above = max(1, -(-cells // cell))
        items = (
            level.groupBy(F.col("cell").alias("item"), F.col("to").alias("part")).agg(F.sum("bytes").alias("bytes"))
            .withColumn("cell", F.pmod(F.xxhash64("item"), F.lit(above)))
        )
        level = staged(_difference_cells(items, "item", shards), "shard-levels")
        levels.append(level.select(
            F.col("item").alias("cell"), F.col("part").alias("to"),
            F.col("cell").alias("up_cell"), F.col("to").alias("up")))
        cells = above
    found = placed.select("grp", "cell", "to")
    for above in levels:
        # Parts of cells that no group fell into do not occur on the left either.
        found = found.join(above, ["cell", "to"]).select("grp", F.col("up_cell").alias("cell"), F.col("up").alias("to"))
    return found.select("grp", F.col("to").alias("shard"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps, in the order of a hash of
    the row; runs of about ``RUN`` rows are numbered apart and then put end to end.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    thin = staged(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("grp"),
    ), "shard-thin")
    groups = staged(thin.groupBy("grp").agg(F.sum("size").alias("bytes")), "shard-groups")
    found = staged(assign(groups, shards), "shard-found")
    runs = max(1, -(-thin.count() // (RUN * shards)))
    rows = staged(thin.join(found, "grp").withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(runs))), "shard-rows")
    earlier = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard", "run").count().select(
        "shard", "run", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "grp")) - 1
    return (
        rows.withColumn("within", within).join(bases, ["shard", "run"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("base") + F.col("within")).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )
