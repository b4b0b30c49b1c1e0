"""Data layout for lookups on several columns: rows in the order of interleaved range ranks.

Each column is cut into ranges of about as many rows, by quantiles of a sample. The bits of a
row's range numbers, one of each column in turn, make one number, and rows are range
partitioned and sorted by it. Files and row groups then span few ranges of every column, so
their min/max statistics skip most of what a lookup on any one of them does not need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that quantiles are taken from, whatever the size of the table; they reach the driver.
SAMPLE_ROWS = 8192
# A long holds the bits of all columns.
ORDER_BITS = 62
MOST_BITS = 6


def quantile_cuts(df: DataFrame, columns: Sequence[str], rows: int, bits: int) -> dict[str, list[tuple]]:
    """Per column at most 2^bits - 1 (value, quantile) that cut its rows into ranges, from a bounded sample.

    The value of a heavy key is at several quantiles; it is a cut once, at the first. So the
    numbers of a column with few values still spread over all bits.
    """
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    found = df.select(*columns).sample(fraction=share, seed=17).limit(2 * SAMPLE_ROWS).collect()
    cuts = {}
    for at, name in enumerate(columns):
        values = sorted(r[at] for r in found if r[at] is not None)
        first: dict = {}
        for quantile in range(1, 1 << bits) if values else ():
            first.setdefault(values[len(values) * quantile >> bits], quantile)
        cuts[name] = sorted(first.items())
    return cuts


def range_rank(column: str, cuts: Sequence[tuple]) -> Column:
    """The quantile of the last cut that is not above a value, by a tree of comparisons; nulls come first."""
    value, ranks = F.col(column), [0, *(quantile for _, quantile in cuts)]

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(ranks[low])
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle][0]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(tree(0, len(cuts)))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number of the bits of all ranks, highest bits first, the first rank leading."""
    total, place = F.lit(0).cast("long"), len(ranks) * bits
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place -= 1
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            total = total.bitwiseOR(F.shiftleft(one, place))
    return total


def rank_bits(columns: int, rows: int) -> int:
    """Bits per column: together a few more than tell that many rows apart, which is as far as order matters."""
    enough = -(-max(1, rows).bit_length() // columns) + 1
    return max(1, min(MOST_BITS, ORDER_BITS // columns, enough))


def cluster(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """``df`` in the order of the interleaved ranks of ``columns``, in one shuffle.

    Rows of one place are told apart by the columns themselves, so a heavy key is spread over
    tasks by the others. ``rows`` is about how many there are. Ranks are columns of their own
    below the interleaving, so that each tree of comparisons is planned and evaluated once.
    """
    bits = rank_bits(len(columns), rows)
    cuts = quantile_cuts(df, columns, rows, bits)
    place = "_place"
    while any(c.startswith(place) for c in df.columns):
        place = f"_{place}"
    ranks = {f"{place}{at}": range_rank(c, cuts[c]) for at, c in enumerate(columns)}
    order = interleaved([F.col(name) for name in ranks], bits)
    keys = [place, *columns]
    return (df.withColumns(ranks).withColumn(place, order).drop(*ranks)
            .repartitionByRange(*keys).sortWithinPartitions(*keys).drop(place))
