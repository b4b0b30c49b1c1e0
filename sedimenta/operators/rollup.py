"""Monthly aggregation over a rolling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.scalars import date_value, month_start, pad_id, run_stamp, window_start
from sedimenta.purchases import ROLLUP
from sedimenta.specs import RollupSpec


def rolling_window(df: DataFrame, event_date: str, as_of=None, months: int = 24) -> DataFrame:
    """Rows dated on or after the first day of the month ``months`` ago."""
    return df.where(F.col(event_date) >= window_start(date_value(as_of), months))


def representative(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The greatest text of each group.

    Distinct pairs are formed first: that step is a hash aggregate, so only the
    few remaining pairs go through the sort that a text maximum needs.
    """
    return df.select(*keys, column).distinct().groupBy(*keys).agg(
        F.max(column).alias(column)
    )


def monthly_rollup(df: DataFrame, spec: RollupSpec = ROLLUP, as_of=None, run_ts=None,
                   stamp: bool = True, year_from: str = "processing",
                   strict: bool = True, prune_by: str | None = None,
                   first_event: str | None = None) -> DataFrame:
    """Sums per key and month over the rolling window.

    Grouping uses raw values: '1' and '01' stay two rows although both are
    emitted as the same padded id. The year key is the processing year of the
    lake folder; with ``year_from='issue'`` it is the year of the event date, so
    a month processed across New Year is one row.

    ``prune_by`` names the processing date. Where nothing is processed before it
    is issued, the window holds for that date too, and lake folders before it are
    not listed or opened at all. It is off by default because it would lose rows
    where that does not hold. ``first_event`` names a column with the earliest event
    date of each group, from which a later run knows what has left the window.
    """
    rows = rolling_window(df, spec.event_date, as_of, spec.window_months)
    if prune_by is not None:
        rows = rolling_window(rows, prune_by, as_of, spec.window_months)
    if year_from == "issue":
        rows = rows.withColumn(spec.year_key, F.year(spec.event_date))
    elif year_from != "processing":
        raise ValueError(f"year_from must be 'processing' or 'issue', not {year_from!r}")
    grouped = rows.groupBy(*spec.keys).agg(
        *[F.sum(c).alias(c) for c in spec.sums],
        *[F.max(c).alias(c) for c in spec.representatives],
        *([F.min(spec.event_date).alias(first_event)] if first_event else []),
    )
    shaped = {spec.month_key: month_start(spec.month_key, strict)}
    shaped.update({c: pad_id(c) for c in spec.padded})
    if stamp:
        shaped[spec.stamp] = run_stamp(run_ts)
    columns = list(spec.output) + ([spec.stamp] if stamp else []) + ([first_event] if first_event else [])
    return grouped.withColumns(shaped).select(*columns)
