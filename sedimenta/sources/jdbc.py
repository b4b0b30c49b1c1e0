"""Reading operational tables over JDBC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTable:
    """One operational table. Credentials come in as caller options only.

    ``split_column`` (an integer column) cuts each date into ``splits`` queries, so
    that one heavy date is not one task: into ranges between ``split_bounds``, which an
    index serves, or by remainder without bounds. ``max_connections`` bounds how many
    queries the database serves at a time, whatever the size of the cluster; scans that
    may run at once share it.
    """

    url: str
    table: str
    options: dict[str, str] = field(default_factory=dict, repr=False)
    date_column: str = "proc_date"
    split_column: str | None = None
    splits: int = 1
    split_bounds: tuple[int, int] | None = None
    max_connections: int = 32

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table, lazily; filters on it are pushed into the database.

        Give ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
        among the options to split a large read.
        """
        return self._load(spark, self.table)

    def read_dates(self, spark: SparkSession, dates: Iterable[dt.date], scans: int = 1) -> DataFrame:
        """The rows of the given dates, one or more queries per date.

        ``scans`` is the number of reads that this one shares the connections with,
        itself included.
        """
        if self.max_connections < scans:
            raise ValueError(f"{scans} scans need a connection each, {self.max_connections} are allowed")
        predicates = date_predicates(
            self.date_column, dates, self.split_column, self.splits, self.split_bounds)
        if not predicates:
            return self.read(spark).where(F.lit(False))
        rows = spark.read.jdbc(
            self.url, self.table, predicates=predicates, properties=self._properties()
        )
        return rows.coalesce(self.max_connections // scans)

    def distinct_dates(self, spark: SparkSession) -> DataFrame:
        """The dates that have rows, made distinct by the database."""
        return self._load(spark, distinct_dates_query(self.table, self.date_column))

    def _properties(self) -> dict[str, str]:
        return {"fetchsize": "10000", **self.options}

    def _load(self, spark: SparkSession, dbtable: str) -> DataFrame:
        return (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("dbtable", dbtable)
            .options(**self._properties())
            .load()
        )


def distinct_dates_query(table: str, date_column: str) -> str:
    return (f"(SELECT DISTINCT {date_column} FROM {table} "
            f"WHERE {date_column} IS NOT NULL) dates")


def date_predicates(
    date_column: str,
    dates: Iterable[dt.date],
    split_column: str | None = None,
    splits: int = 1,
    bounds: tuple[int, int] | None = None,
) -> list[str]:
    """WHERE clauses that cover the rows of ``dates`` exactly once."""
    days = sorted(set(dates))
    if split_column is None or splits <= 1:
        return [f"{date_column} = DATE '{d:%Y-%m-%d}'" for d in days]
    predicates = []
    for d in days:
        for part in range(splits):
            # NULLs of the split column belong to the first part.
            share = _range(split_column, splits, bounds, part) if bounds else (
                f"ABS(MOD({split_column}, {splits})) = {part}")
            if part == 0:
                share = f"({share} OR {split_column} IS NULL)"
            predicates.append(f"{date_column} = DATE '{d:%Y-%m-%d}' AND {share}")
    return predicates


def _range(column: str, splits: int, bounds: tuple[int, int], part: int) -> str:
    """One of ``splits`` ranges; the first and the last are open, so no row is left out."""
    low, high = bounds
    edges = [low + (high + 1 - low) * i // splits for i in range(splits + 1)]
    limits = [f"{column} >= {edges[part]}"] if part else []
    limits += [f"{column} < {edges[part + 1]}"] if part < splits - 1 else []
    return " AND ".join(limits)
