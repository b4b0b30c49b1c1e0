"""Exact deduplication by deterministic block naming.

Each text is cut into blocks of a fixed number of bytes. The distinct blocks are
sorted and numbered, adjacent numbers are paired, the distinct pairs are sorted and
numbered again, and so on until one number is left per text. Two texts get the same
(level, number) exactly if they are equal byte for byte: no hash decides anything. Blocks
are sorted and numbered within shuffle partitions, so numbers are unique but neither in
the order of all blocks nor the same under another number of partitions.

Only built-in functions are used. Blocks that make up more than a thousandth of all
blocks (fewer than a thousand, by that very share) are numbered below zero and joined
by broadcast, so the shuffled join has no heavy key; pairs of numbers are joined as
written tables, where AQE splits a heavy pair.

Defined cases: a null text counts as empty; equal rows, null ids and ties form groups
like any others; an empty table gives an empty result; columns other than the id and
the text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import staged

BLOCK_BYTES = 4096
HOT_SHARE = 1000


def _blocks(texts: DataFrame, block_bytes: int, *keep: str) -> DataFrame:
    """One row per block: idx, n (blocks of its text), block, plus the kept columns."""
    n = F.greatest(F.lit(1), F.ceil(F.length("bytes") / block_bytes)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            i.alias("idx"),
            n.alias("n"),
            F.col("bytes").substr(i * block_bytes + 1, F.lit(block_bytes)).alias("block"),
        ),
    )
    return texts.select(*keep, F.explode(cut).alias("cut")).select(*keep, "cut.*")


def _name_blocks(texts: DataFrame, block_bytes: int, total: int) -> DataFrame:
    """(rid, head, idx, n, name): the first level of names."""
    counted = _blocks(texts, block_bytes).groupBy("block").count()
    bar = total // HOT_SHARE
    # Fewer than HOT_SHARE rows, so neither the sort nor the broadcast can grow.
    hot = counted.filter(F.col("count") > bar).select(
        "block",
        (-F.row_number().over(Window.orderBy("block"))).cast("long").alias("hot_name"),
    )
    names = (
        counted.filter(F.col("count") <= bar)
        .select(F.col("block").alias("key"))
        .sortWithinPartitions("key")
        .select("key", (F.monotonically_increasing_id() + 1).alias("cold_name"))
    )
    rows = _blocks(texts, block_bytes, "rid", "head").join(F.broadcast(hot), "block", "left")
    # A hot row looks up a key of its own instead of its block; what it may find is unused.
    own = F.concat_ws(":", "rid", "idx").cast("binary")
    rows = rows.select(
        "rid",
        F.when(F.col("idx") == 0, F.col("head")).alias("head"),
        "idx",
        "n",
        "hot_name",
        F.when(F.col("hot_name").isNull(), F.col("block")).otherwise(own).alias("key"),
    )
    return rows.join(names, "key", "left").select(
        "rid", "head", "idx", "n", F.coalesce("hot_name", "cold_name").alias("name")
    )


def _name_pairs(rows: DataFrame) -> DataFrame:
    """The next level: adjacent names of a text are paired and the pairs named."""
    left, right = F.col("idx") % 2 == 0, F.col("idx") % 2 == 1
    pairs = staged(
        rows.groupBy("rid", F.floor(F.col("idx") / 2).cast("int").alias("idx"))
        .agg(
            F.max("head").alias("head"),
            F.max(F.ceil(F.col("n") / 2)).cast("int").alias("n"),
            F.max(F.when(left, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(right, F.col("name"))), F.lit(0)).alias("b"),
        ),
        "pairs",
    )
    names = staged(
        pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
        .select("a", "b", (F.monotonically_increasing_id() + 1).alias("name")),
        "pair-names",
    )
    return pairs.join(names, ["a", "b"]).select("rid", "head", "idx", "n", "name")


def identities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: rid, id, text_sha256, level, name.

    (level, name) is the identity: equal for equal texts and for no others.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha")).alias("head"),
        text.cast("binary").alias("bytes"),
    )
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / block_bytes))
    total, longest = docs.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(n), F.lit(1))).first()
    rows = staged(_name_blocks(texts, block_bytes, int(total)), "block-names")
    done = []
    for level in range(max(1, int(longest - 1).bit_length() + 1)):
        if level:
            rows = staged(_name_pairs(rows.filter("n > 1")), f"names-{level}")
        done.append(rows.filter("n = 1").select(
            "rid", "head.id", F.col("head.sha").alias("text_sha256"), F.lit(level).alias("level"), "name"
        ))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest id of each group of equal texts stays; of several rows
    with that id exactly one is kept.
    """
    rows = identities(docs, id_col, text_col)
    groups = staged(
        rows.groupBy("level", "name").agg(
            F.max(F.struct("id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "groups",
    )
    return rows.join(groups, ["level", "name"]).select(
        F.col("id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"),
        "text_sha256",
    )
