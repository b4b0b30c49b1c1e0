"""Initial loads and late-row merges, as one job over all dates concerned."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sedimenta.purchases import DAILY, LATE, LAYOUT, ORIGIN
from sedimenta.sources.dates import DateSet, make_date_set
from sedimenta.sources.lake import with_partition_columns, without_partition_columns
from sedimenta.specs import LakeLayout


def tag_origin(df: DataFrame, origin: str, column: str = ORIGIN) -> DataFrame:
    return df.withColumn(column, F.lit(origin))


def initial_load(daily: DataFrame, late: DataFrame) -> DataFrame:
    """Daily plus late source rows, tagged with their origin. Nothing is deduplicated."""
    return tag_origin(daily, DAILY).unionByName(tag_origin(late, LATE))


def merge_rows(lake: DataFrame, incoming: DataFrame, layout: LakeLayout = LAYOUT) -> DataFrame:
    """Lake rows and tagged incoming rows, each distinct row once.

    Columns are matched by name, a column missing on one side is NULL there, and
    NULLs are equal. Folder columns derived from the date take no part. Copies are
    folded on the map side, so a row repeated a billion times is one row per task
    before the shuffle.
    """
    rows = without_partition_columns(lake, layout).unionByName(
        without_partition_columns(incoming, layout), allowMissingColumns=True
    )
    return rows.distinct()


def merge_late_rows(lake: DataFrame, late: DataFrame, layout: LakeLayout = LAYOUT) -> DataFrame:
    """Merge late source rows into the lake rows of the same dates."""
    return merge_rows(lake, tag_origin(late, LATE), layout)


@dataclass(frozen=True)
class RepairPlan:
    """Diverged dates: those to merge into lake rows and those to load afresh."""

    merge: DateSet
    load: DateSet
    report: tuple[Row, ...] = ()

    def __bool__(self) -> bool:
        return bool(self.merge) or bool(self.load)


def plan_repair(report: DataFrame, layout: LakeLayout = LAYOUT) -> RepairPlan:
    """Evaluate a reconciliation report, which has one row per date, into a plan.

    The plan is fixed from here on: the write that follows changes the counts the
    report was made of.
    """
    def day(value):  # a timestamp would not be bounded by the calendar
        return value.date() if isinstance(value, dt.datetime) else value

    date = layout.date
    rows = tuple(report.collect())
    return RepairPlan(
        merge=make_date_set(date, (day(r[date]) for r in rows if r.diverged and r.has_lake)),
        load=make_date_set(date, (day(r[date]) for r in rows if r.diverged and not r.has_lake)),
        report=rows,
    )


def changed_dates(lake: DataFrame, incoming: DataFrame, layout: LakeLayout = LAYOUT) -> DataFrame:
    """(date, changed): whether merging would leave other rows than the lake has.

    A date changes if a row comes in that the lake lacks, or if the lake holds a row
    more than once. All business columns are compared, NULLs being equal, in the one
    shuffle that a merge would take too; copies are folded on the map side.
    """
    date = layout.date
    stored = without_partition_columns(lake, layout).select(F.struct("*").alias("row"), F.lit(1).alias("stored"))
    fields = stored.schema["row"].dataType.names
    new = without_partition_columns(incoming, layout)
    new = new.select(F.struct(*[
        (F.col(f) if f in new.columns else F.lit(None).cast(stored.schema["row"].dataType[f].dataType)).alias(f)
        for f in fields
    ]).alias("row"), F.lit(0).alias("stored"))
    rows = stored.unionByName(new).groupBy("row").agg(F.sum("stored").alias("times"))
    return rows.groupBy(F.col(f"row.{date}").alias(date)).agg(F.bool_or(F.col("times") != 1).alias("changed"))


def narrowed(plan: RepairPlan, changed: DataFrame, layout: LakeLayout = LAYOUT) -> RepairPlan:
    """The plan without the merge dates whose content would stay as it is.

    A date whose late rows hold copies never has the announced count after a merge;
    without this it would be written again at every run.
    """
    date = layout.date
    dates = [r[0] for r in changed.where("changed").select(F.col(date).cast("date")).collect()]
    return RepairPlan(make_date_set(date, dates), plan.load, plan.report)


def incoming_rows(daily: DataFrame | None, late: DataFrame) -> DataFrame:
    """Rows to merge: late ones, and the daily ones again where they are given."""
    return tag_origin(late, LATE) if daily is None else initial_load(daily, late)


def repaired(lake: DataFrame, incoming: DataFrame, loaded: DataFrame,
             layout: LakeLayout = LAYOUT) -> DataFrame:
    """Lake rows merged with incoming ones, and loaded ones as they are, with folder columns."""
    merged = merge_rows(lake, incoming, layout)
    return with_partition_columns(merged.unionByName(loaded, allowMissingColumns=True), layout)


def repair(lake: DataFrame, daily: DataFrame, late: DataFrame, plan: RepairPlan,
           layout: LakeLayout = LAYOUT, reread_daily: bool = False) -> DataFrame:
    """The new content of every diverged date, with its folder columns.

    Dates with lake rows: lake and late rows, deduplicated. Dates without: daily
    and late rows as they are. Dates for which no source has a row do not appear,
    so a partition-level overwrite leaves them untouched. ``reread_daily`` also
    reads the daily rows again for dates with lake rows, so that a date whose
    daily rows were incomplete converges.
    """
    date = layout.date
    again = plan.merge.restrict(daily, date) if reread_daily else None
    incoming = incoming_rows(again, plan.merge.restrict(late, date))
    loaded = initial_load(plan.load.restrict(daily, date), plan.load.restrict(late, date))
    return repaired(plan.merge.restrict(lake, date), incoming, loaded, layout)
