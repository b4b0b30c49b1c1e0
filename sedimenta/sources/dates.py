"""Sets of processing dates used to prune scans.

A set of dates has at most one member per calendar day (the date type holds
3,652,059 of them), so it is small whatever the number of rows behind it, and may
be evaluated on the driver. It becomes an IN list, which prunes lake folders
statically and is pushed into JDBC sources.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DateSet:
    column: str
    dates: tuple[dt.date, ...]

    def __bool__(self) -> bool:
        return bool(self.dates)

    def frame(self, spark: SparkSession, column: str | None = None) -> DataFrame:
        return spark.createDataFrame([(d,) for d in self.dates], f"{column or self.column} date")

    def restrict(self, df: DataFrame, column: str | None = None) -> DataFrame:
        """Rows of ``df`` whose date is in the set."""
        column = column or self.column
        if not self.dates:
            return df.where(F.lit(False))
        days = ", ".join(f"DATE'{d:%Y-%m-%d}'" for d in self.dates)
        return df.where(f"`{column}` IN ({days})")


def make_date_set(column: str, dates: Iterable[dt.date]) -> DateSet:
    return DateSet(column, tuple(sorted(set(dates))))


def date_set(df: DataFrame, column: str) -> DateSet:
    """Evaluate the distinct non-null dates of a date column."""
    dates = df.where(F.col(column).isNotNull()).select(F.col(column).cast("date")).distinct()
    return make_date_set(column, (row[0] for row in dates.collect()))
