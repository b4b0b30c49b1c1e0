"""Expected-versus-actual row counts per processing date.

Each side is counted per date before anything is joined, so only one row per date
is ever shuffled, and counting the lake reads no column other than the date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.scalars import date_value
from sedimenta.purchases import RECENT_DAYS
from sedimenta.sources.dates import DateSet, make_date_set

RECENT = "recent"
FLAGGED = "flagged"


def date_spine(spark: SparkSession, as_of=None, days: int = RECENT_DAYS,
               date: str = "proc_date") -> DataFrame:
    """The ``days`` dates before ``as_of``, one row each."""
    today = date_value(as_of)
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(today, days), F.date_sub(today, 1))).alias(date)
    )


def in_recent_window(column: Column, as_of=None, days: int = RECENT_DAYS) -> Column:
    today = date_value(as_of)
    return column.between(F.date_sub(today, days), F.date_sub(today, 1))


def expected_counts(totals: DataFrame, date: str = "proc_date",
                    rows: str = "expected_rows") -> DataFrame:
    """Announced rows per date; a date with only NULL counts is 0."""
    return totals.groupBy(date).agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("expected_rows")
    )


def actual_counts(lake: DataFrame, date: str = "proc_date") -> DataFrame:
    """Stored rows per date. Dates without rows are absent and count as 0 later."""
    return lake.groupBy(date).agg(F.count(F.lit(1)).alias("actual_rows"))


def late_dates(late: DataFrame, date: str = "proc_date") -> DataFrame:
    """Dates for which late rows exist."""
    return late.where(F.col(date).isNotNull()).select(date).distinct()


def compare_counts(dates: DataFrame, expected: DataFrame, actual: DataFrame,
                   date: str = "proc_date") -> DataFrame:
    """One row per date: both counts, absent being 0, and whether they differ."""
    expected_rows = F.coalesce("expected_rows", F.lit(0))
    actual_rows = F.coalesce("actual_rows", F.lit(0))
    return (
        dates.join(expected, date, "left")
        .join(actual, date, "left")
        .withColumns({"expected_rows": expected_rows, "actual_rows": actual_rows})
        .withColumns({
            "diverged": F.col("expected_rows") != F.col("actual_rows"),
            "has_lake": F.col("actual_rows") > 0,
        })
    )


def reconcile_recent(lake: DataFrame, totals: DataFrame, as_of=None,
                     days: int = RECENT_DAYS, date: str = "proc_date") -> DataFrame:
    """Report on each of the ``days`` dates before ``as_of``."""
    recent = in_recent_window(F.col(date), as_of, days)
    return compare_counts(
        date_spine(lake.sparkSession, as_of, days, date),
        expected_counts(totals.where(recent), date),
        actual_counts(lake.where(recent), date),
        date,
    ).orderBy(F.desc(date))


def reconcile_flagged(lake: DataFrame, late: DataFrame, totals: DataFrame, as_of=None,
                      days: int = RECENT_DAYS, date: str = "proc_date") -> DataFrame:
    """Report on every date with late rows outside the recent window.

    The recent window is one range of dates, so leaving it out is a filter.
    """
    older = ~in_recent_window(F.col(date), as_of, days)
    return compare_counts(
        late_dates(late.where(older), date),
        expected_counts(totals.where(older), date),
        actual_counts(lake.where(older), date),
        date,
    ).orderBy(F.desc(date))


def reconcile(lake: DataFrame, late: DataFrame, totals: DataFrame, as_of=None,
              days: int = RECENT_DAYS, date: str = "proc_date",
              candidates: DateSet | None = None,
              counted: dict[dt.date, int] | None = None) -> DataFrame:
    """Both reports in one, counting the lake and the totaliser once.

    ``reason`` tells why a date was looked at. ``candidates`` (from
    ``candidate_dates``) limits the counting to the folders that matter; of those, dates
    whose stored rows are known already (``counted``) are not opened.
    """
    spark, known = lake.sparkSession, []
    recent = in_recent_window(F.col(date), as_of, days)
    spine = date_spine(lake.sparkSession, as_of, days, date)
    if candidates is None:
        flagged = late_dates(late.where(~recent), date)
    else:
        known = [(d, n) for d, n in (counted or {}).items() if d in set(candidates.dates)]
        open_dates = make_date_set(date, set(candidates.dates) - {d for d, _ in known})
        lake, totals = open_dates.restrict(lake, date), candidates.restrict(totals, date)
        flagged = candidates.frame(spark, date).where(~recent)
    dates = spine.select(date, F.lit(RECENT).alias("reason")).unionByName(
        flagged.select(date, F.lit(FLAGGED).alias("reason"))
    )
    actual = actual_counts(lake, date)
    if known:
        actual = actual.unionByName(spark.createDataFrame(known, f"{date} date, actual_rows long"))
    return compare_counts(dates, expected_counts(totals, date), actual, date).orderBy(F.desc(date))


def candidate_dates(late: DataFrame, as_of=None, days: int = RECENT_DAYS,
                    date: str = "proc_date") -> DataFrame:
    """Every date ``reconcile`` looks at: the recent window and the late dates."""
    return late_dates(late, date).unionByName(
        date_spine(late.sparkSession, as_of, days, date)
    ).distinct()
