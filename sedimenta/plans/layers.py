"""The daily run: bronze, then silver, then gold."""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.scalars import date_value, window_start
from sedimenta.operators.fingerprint import date_digests
from sedimenta.operators.merge import (
    changed_dates,
    incoming_rows,
    initial_load,
    narrowed,
    plan_repair,
    repaired,
)
from sedimenta.operators.reconcile import candidate_dates, reconcile
from sedimenta.operators.rollup import monthly_rollup
from sedimenta.operators.star import build_fact
from sedimenta.purchases import DIMENSIONS, FACT, LAYOUT, RECENT_DAYS, ROLLUP
from sedimenta.session import discard, freed_shuffles, passing_scratch, scratch_path
from sedimenta.sinks.files import Store
from sedimenta.sinks.lease import Record, leased
from sedimenta.sinks.partitions import write_partitions
from sedimenta.sinks.tables import LoadMetrics, PublishResult, publish_dimensions, publish_fact
from sedimenta.sources.dates import DateSet, date_set, make_date_set
from sedimenta.sources.lake import read_lake
from sedimenta.sources.listing import folder_tokens
from sedimenta.specs import DimensionSpec, FactSpec, LakeLayout, RollupSpec


# Working column of the rollup, not stored.
FIRST_EVENT = "_first_event"


class DatedTable(Protocol):
    """An operational table that can be read by date, such as ``JdbcTable``."""

    def read(self, spark: SparkSession) -> DataFrame: ...

    def read_dates(self, spark: SparkSession, dates: Iterable[dt.date], scans: int = 1) -> DataFrame: ...

    def distinct_dates(self, spark: SparkSession) -> DataFrame: ...


@dataclass(frozen=True)
class Feeds:
    """The operational tables of a run, each a frame or a table read by date."""

    daily: DataFrame | DatedTable
    late: DataFrame | DatedTable
    totals: DataFrame | DatedTable


def _whole(spark: SparkSession, feed: DataFrame | DatedTable) -> DataFrame:
    return feed if isinstance(feed, DataFrame) else feed.read(spark)


def _of_dates(spark: SparkSession, feed: DataFrame | DatedTable, dates: DateSet, scans: int) -> DataFrame:
    if isinstance(feed, DataFrame):
        return dates.restrict(feed)
    return feed.read_dates(spark, dates.dates, scans)


@dataclass(frozen=True)
class Settings:
    bronze_path: str
    silver_path: str
    database: str
    bronze_schema: T.StructType
    as_of: object = None
    run_ts: object = None
    layout: LakeLayout = LAYOUT
    rollup: RollupSpec = ROLLUP
    fact: FactSpec = FACT
    dimensions: tuple[DimensionSpec, ...] = DIMENSIONS
    recent_days: int = RECENT_DAYS
    reread_daily: bool = False
    prune_stale: bool = False
    processing_follows_issue: bool = False
    year_from: str = "processing"
    lease_seconds: float = 600.0
    table_format: str | None = "parquet"


@dataclass
class RunResult:
    report: tuple[Row, ...] = ()
    # Layers and dimensions that an earlier, failed run for the same date had finished.
    skipped: tuple[str, ...] = ()
    fact: LoadMetrics | None = None
    dimensions: list[PublishResult] = field(default_factory=list)


def beside(path: str, what: str) -> str:
    """A folder next to a lake, in the same store and of the same name."""
    return f"{path.rstrip('/')}_{what}"


@dataclass(frozen=True)
class Known:
    """What an earlier run found of a date: its files, their rows, and the rows last merged into it."""

    files: str
    rows: int
    merged: str | None = None


def known_dates(store: Store, files: dict[dt.date, str]) -> dict[dt.date, Known]:
    """Dates whose files are still the ones that an earlier run recorded."""
    stored = (store.latest("dates") or {}).get("dates", {})
    found = {dt.date.fromisoformat(day): Known(**entry) for day, entry in stored.items()}
    return {day: entry for day, entry in found.items() if files.get(day) == entry.files}


def remember_dates(store: Store, known: dict[dt.date, Known]) -> None:
    store.put("dates", {"dates": {day.isoformat(): vars(entry) for day, entry in sorted(known.items())}})


def lake_files(lake: DataFrame, layout: LakeLayout) -> dict[dt.date, str]:
    return {dt.date.fromisoformat(day): token for day, token in folder_tokens(lake, layout.date).items() if day}


def _digests(rows: DataFrame, date: str) -> dict[dt.date, str]:
    """One short text per date."""
    return {r[date]: f"{r['rows']}:{r['digest']}" for r in date_digests(rows, date).collect()}


def refresh_bronze(spark: SparkSession, feeds: Feeds, settings: Settings) -> tuple[Row, ...]:
    """Reconcile, then merge or load every diverged date in one job.

    Stored with the lake is, per date, a digest of its file names, its row count and a digest
    of the rows last merged into it. A date with the same files is not counted again, and if
    the rows to merge are the same as well it is settled: no file of it is opened. Any
    difference is confirmed by comparing rows. Returns the report, one row per date looked at.
    """
    with passing_scratch(spark) as passing, freed_shuffles(spark):
        layout, date = settings.layout, settings.layout.date
        as_of, days = settings.as_of, settings.recent_days
        finish_staged(spark, settings)
        store = Store(spark, beside(settings.bronze_path, "state"))
        lake = read_lake(spark, settings.bronze_path, settings.bronze_schema)
        files = lake_files(lake, layout)
        known = known_dates(store, files)
        dated = feeds.late if isinstance(feeds.late, DataFrame) else feeds.late.distinct_dates(spark)
        candidates = date_set(candidate_dates(dated, as_of, days, date), date)
        report = reconcile(lake, dated, _whole(spark, feeds.totals), as_of, days, date, candidates,
                           {day: entry.rows for day, entry in known.items()})
        plan = plan_repair(report, layout)
        before = dict(known)
        known.update({day: Known(files[day], row["actual_rows"]) for row in plan.report
                      if (day := row[date]) in files and day not in known})

        # Scans that may overlap share the connections of a table read by date.
        scans = 4 if settings.reread_daily else 3

        def to_merge(dates: DateSet) -> DataFrame:
            again = _of_dates(spark, feeds.daily, dates, scans) if settings.reread_daily else None
            return incoming_rows(again, _of_dates(spark, feeds.late, dates, scans))

        recorded = make_date_set(date, (d for d in plan.merge.dates if d in known and known[d].merged))
        if recorded:
            # Read and folded to a line per date; nothing is written or compared for settled dates.
            now = _digests(to_merge(recorded), date)
            settled = {d for d in recorded.dates if now.get(d) == known[d].merged}
            plan = replace(plan, merge=make_date_set(date, set(plan.merge.dates) - settled))
        incoming, merged = None, {}
        if plan.merge:
            # Compared first and merged then: written once, so the source is not asked again.
            incoming = staged_rows(to_merge(plan.merge), "incoming")
            merged = _digests(incoming, date)
            changed = changed_dates(plan.merge.restrict(lake, date), incoming, layout)
            asked = plan.merge.dates
            plan = narrowed(plan, changed, layout)
            for day in set(asked) - set(plan.merge.dates):
                known[day] = replace(known[day], merged=merged.get(day))
        if plan:
            daily = _of_dates(spark, feeds.daily, plan.load, scans)
            late = _of_dates(spark, feeds.late, plan.load, scans)
            loaded = initial_load(daily, late)
            incoming = loaded.where("1 = 0") if incoming is None else plan.merge.restrict(incoming, date)
            rows = repaired(plan.merge.restrict(lake, date), incoming, loaded, layout)
            stage(rows, settings)
            discard(spark, passing)
            stored = finish_staged(spark, settings)
            after = lake_files(read_lake(spark, settings.bronze_path, settings.bronze_schema), layout)
            known.update({day: Known(after[day], n, merged.get(day)) for day, n in stored.items() if day in after})
        if known != before:
            remember_dates(store, known)
        return plan.report


def staged_rows(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the scratch folder and read back."""
    path = scratch_path(rows.sparkSession, name)
    with freed_shuffles(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stage(rows: DataFrame, settings: Settings) -> str:
    """Keep a finished copy of the repaired dates beside the lake before the lake is touched.

    Replacing folders deletes before it renames. A driver that dies in between leaves the copy,
    from which the next run, in any session, completes the lake. The manifest that names the
    copy's files is written last: a copy without one was never finished and is not used. Rows of
    a date are brought together when the copy is written to the lake, not before.
    """
    spark, root = rows.sparkSession, beside(settings.bronze_path, "repairs")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    path = f"{root}/{name}"
    with freed_shuffles(spark):
        rows.write.parquet(path)
    store = Store(spark, root)
    copied = [n for n in store.names(name) if n.endswith(".parquet")]
    store.create(f"{name}.json", {"files": copied})
    return path


def finish_staged(spark: SparkSession, settings: Settings) -> dict[dt.date, int]:
    """Write every finished copy to the lake, then remove it; rows written by date.

    The manifest is removed last. Files of a copy only go once the lake is complete, so a
    copy that lacks some of its files was written already and is just cleared away.
    """
    store, date = Store(spark, beside(settings.bronze_path, "repairs")), settings.layout.date
    written: dict[dt.date, int] = {}
    for manifest in [n for n in store.names() if n.endswith(".json")]:
        name, listed = manifest.removesuffix(".json"), store.read(manifest)
        if listed is not None and set(listed["files"]) <= set(store.names(name)):
            rows = spark.read.schema(settings.bronze_schema).parquet(f"{store.root}/{name}")
            write_partitions(rows, settings.bronze_path, settings.layout.columns)
            written.update({r[0]: r[1] for r in rows.groupBy(date).count().collect()})
        store.remove(name)
        store.remove(manifest)
    return written


def drop_unfinished(spark: SparkSession, settings: Settings) -> None:
    """Remove copies that a dead run never finished. Only for the run that holds the lake's lease."""
    store = Store(spark, beside(settings.bronze_path, "repairs"))
    names = set(store.names())
    for name in names:
        if not name.endswith(".json") and f"{name}.json" not in names:
            store.remove(name)


def refresh_silver(spark: SparkSession, settings: Settings) -> list[str]:
    """Roll bronze up by month and replace the years whose content can have changed.

    Stored with silver is, per processing year, a digest of the bronze file names that it was
    made of, one of its own, and its earliest event date. A year is made anew if one of the
    digests differs or if rows of it have left the window since; the others are neither read
    nor written. Other settings than last time, years taken from issue dates, or pruning of
    stale years need all years, once anything has changed. Returns the years made anew.

    The aggregate already leaves evenly sized tasks that span the few years of the
    window, so no further exchange is made for the write.
    """
    spec, year = settings.rollup, settings.layout.year
    bronze = read_lake(spark, settings.bronze_path, settings.bronze_schema)
    sources = {k or "": v for k, v in folder_tokens(bronze, year).items()}
    store = Store(spark, beside(settings.silver_path, "state"))
    start = spark.range(1).select(window_start(date_value(settings.as_of), spec.window_months)).first()[0].isoformat()
    by_year = settings.year_from == "processing" and not settings.prune_stale and spec.year_key == year
    asked = hashlib.sha256(repr((spec, settings.year_from, settings.prune_stale, settings.processing_follows_issue,
                                 settings.bronze_schema.json())).encode()).hexdigest()
    state = store.latest("rollup") or {}
    same = state.get("settings") == asked and start >= state.get("start", "")
    before = state.get("years", {}) if same else {}
    present = {k or "": v for k, v in folder_tokens(read_silver(spark, settings), spec.year_key).items()}

    def stale(name: str) -> bool:
        entry = before.get(name)
        return (entry is None or entry["bronze"] != sources.get(name) or entry["silver"] != present.get(name)
                or (entry["first"] is not None and entry["first"] < start))

    wanted = sorted(name for name in {*sources, *before} if stale(name))
    if wanted and not by_year:
        wanted = sorted({*sources, *before})
    if not wanted:
        if state.get("start") != start:
            store.put("rollup", {**state, "settings": asked, "start": start, "years": before})
        return []
    if by_year:
        years = [int(name) for name in wanted if name]
        listed = F.col(year).isin(years) if years else F.lit(False)
        bronze = bronze.where(listed | F.col(year).isNull() if "" in wanted else listed)
    rollup = monthly_rollup(
        bronze, spec, settings.as_of, settings.run_ts, year_from=settings.year_from,
        prune_by=settings.layout.date if settings.processing_follows_issue else None,
        first_event=FIRST_EVENT,
    )
    firsts, observation = {}, Observation(f"rollup-{uuid.uuid4().hex}")
    if by_year:
        given = F.coalesce(F.col(spec.year_key).cast("string"), F.lit(""))
        rollup = rollup.observe(observation, F.count(F.lit(1)).alias("rows"), *[
            F.min(F.when(given == name, F.col(FIRST_EVENT))).cast("string").alias(f"first_{name}") for name in wanted])
    write_partitions(rollup.drop(FIRST_EVENT), settings.silver_path, [spec.year_key],
                     cluster=False, prune_stale=settings.prune_stale)
    if by_year:
        firsts = {name: observation.get[f"first_{name}"] for name in wanted}
    present = {k or "": v for k, v in folder_tokens(read_silver(spark, settings), spec.year_key).items()}
    # Without years of their own the earliest event is not known: the window's start stands for it.
    entries = {name: {"bronze": sources.get(name), "silver": present.get(name),
                      "first": firsts.get(name) if by_year else start} for name in sources}
    kept = {name: entry for name, entry in before.items() if name not in wanted}
    store.put("rollup", {"settings": asked, "start": start, "years": {**entries, **kept}})
    return wanted


def read_silver(spark: SparkSession, settings: Settings) -> DataFrame:
    bronze = spark.createDataFrame([], settings.bronze_schema)
    schema = monthly_rollup(bronze, settings.rollup, settings.as_of, settings.run_ts).schema
    year = settings.rollup.year_key
    body = [f for f in schema.fields if f.name != year]
    return read_lake(
        spark, settings.silver_path,
        T.StructType(body + [T.StructField(year, schema[year].dataType)]),
    )


def refresh_fact(spark: SparkSession, settings: Settings) -> LoadMetrics:
    silver = read_silver(spark, settings)
    fact = build_fact(silver, settings.fact, settings.run_ts)
    # One fact row per rollup row; counting those reads file footers only.
    return publish_fact(fact, settings.fact, f"{settings.database}.{settings.fact.table}",
                        settings.table_format, silver.count())


def refresh_dimensions(spark: SparkSession, settings: Settings) -> list[PublishResult]:
    return publish_dimensions(read_silver(spark, settings), settings.dimensions,
                              settings.database, settings.run_ts, settings.table_format)


def resolved(spark: SparkSession, settings: Settings) -> Settings:
    """One date and one stamp for the whole run, however long it takes, from one clock."""
    now = spark.sql("SELECT current_date() AS day, current_timestamp() AS stamp").first()
    return replace(settings, as_of=now.day if settings.as_of is None else settings.as_of,
                   run_ts=now.stamp if settings.run_ts is None else settings.run_ts)


def run_layers(spark: SparkSession, feeds: Feeds, settings: Settings) -> RunResult:
    """All layers in dependency order. Running it again changes nothing.

    One run per lake at a time: it holds a lease, and another is refused meanwhile. What is
    finished is recorded, so a run for the same date after one that failed goes on where that
    one stopped, with its stamp. A failing bronze or silver step stops the run. The dimensions
    do not depend on the fact: they are published even if it fails, and its error is raised after.
    """
    given = settings.run_ts
    settings = resolved(spark, settings)
    store = Store(spark, beside(settings.bronze_path, "runs"))
    with leased(store, settings.lease_seconds) as lease:
        kind = hashlib.sha256(f"{settings.silver_path}|{settings.database}".encode()).hexdigest()[:12]
        record = Record(store, kind, str(settings.as_of), str(settings.run_ts))
        if given is None:
            settings = replace(settings, run_ts=dt.datetime.fromisoformat(record.stamp))
        result = RunResult(skipped=tuple(record.done))

        def step(name: str, action) -> None:
            if name not in record.done:
                lease.renew()
                action()
                record.finish(name)

        def bronze() -> None:
            drop_unfinished(spark, settings)
            result.report = refresh_bronze(spark, feeds, settings)

        def fact() -> None:
            result.fact = refresh_fact(spark, settings)

        step("bronze", bronze)
        step("silver", lambda: refresh_silver(spark, settings))
        try:
            step("fact", fact)
        finally:
            left = tuple(d for d in settings.dimensions if d.table not in record.done)
            result.dimensions = refresh_dimensions(spark, replace(settings, dimensions=left))
            for published in result.dimensions:
                if published.ok:
                    record.finish(published.table.rpartition(".")[2])
        if all(d.ok for d in result.dimensions):
            record.close()
    return result
