"""Publishing tables: typed staging table, load, check, swap.

Table names may point into the session catalog (``db.table``) or into any other
catalog configured in Spark, such as a JDBC one (``catalog.schema.table``); the
statements are the same.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.star import (
    MEMBER_SET,
    all_members,
    build_dimension,
    dimension_of,
    with_row_ids,
)
from sedimenta.session import discard, freed_shuffles, passing_scratch, scratch_path
from sedimenta.sinks.clustering import cluster
from sedimenta.specs import DimensionSpec, FactSpec


# Between the name of a published table and the mark of one of its versions: when it was
# begun, and a random part.
VERSION = "__v_"
# Property of a published view: its version and those it had before, newest first.
HISTORY = "sedimenta.versions"
# Versions that stay: the live one, and the former one for queries that still read it.
KEPT_VERSIONS = 2
# A version that never went live belongs to a dead run once it is this old.
ABANDONED_SECONDS = 7 * 24 * 3600


class PublishError(RuntimeError):
    """The staged table is not what was loaded; the live table was left alone."""


@dataclass(frozen=True)
class LoadMetrics:
    """What one load moved."""

    table: str
    rows: int
    seconds: float
    sums: dict[str, object]
    expected_rows: int | None = None
    bytes: int | None = None
    # Former versions that could not be dropped after the new one went live.
    leftovers: tuple[str, ...] = ()

    @property
    def megabytes_per_second(self) -> float | None:
        if self.bytes is None or not self.seconds:
            return None
        return self.bytes / 1e6 / self.seconds

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0

    @property
    def percent(self) -> float | None:
        if not self.expected_rows:
            return None
        return 100.0 * self.rows / self.expected_rows


@dataclass(frozen=True)
class PublishResult:
    table: str
    metrics: LoadMetrics | None = None
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


def observed(df: DataFrame, sums: Iterable[str] = ()) -> tuple[DataFrame, Observation]:
    """``df`` with a row count and column sums gathered while it is being written."""
    observation = Observation(f"load-{uuid.uuid4().hex}")
    measures = [F.count(F.lit(1)).alias("rows")]
    measures += [F.sum(c).alias(c) for c in sums]
    return df.observe(observation, *measures), observation


def create_table(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]],
                 using: str | None = "parquet", lookups: Iterable[str] = ()) -> None:
    """A typed table. In Parquet, ``lookups`` get Bloom filters in every row group."""
    body = ", ".join(f"`{name}` {kind}" for name, kind in columns)
    provider = f" USING {using}" if using else ""
    if using == "parquet" and (names := list(lookups)):
        switches = ", ".join(f"'parquet.bloom.filter.enabled#{c}'='true'" for c in names)
        provider += f" OPTIONS ({switches})"
    spark.sql(f"CREATE TABLE {table} ({body}){provider}")


def load_table(df: DataFrame, table: str, sums: Iterable[str] = (),
               expected_rows: int | None = None) -> LoadMetrics:
    """Append to an existing table; columns are bound by name, types are enforced."""
    rows, observation = observed(df, sums)
    started = time.monotonic()
    df.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)
    seconds = time.monotonic() - started
    found = dict(observation.get)
    return LoadMetrics(table, found.pop("rows"), seconds, found, expected_rows,
                       stored_bytes(df.sparkSession, table))


def stored_bytes(spark: SparkSession, table: str) -> int | None:
    """Size of a table from its file listing; None where the catalog has no such figure."""
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    except AnalysisException:
        return None
    size = described.where("col_name = 'Statistics'").select("data_type").first()
    return int(size[0].split()[0]) if size else None


def _renamed(spark: SparkSession, source: str, target: str) -> None:
    # The new name of a table in a named catalog is given without the catalog.
    parts = target.split(".")
    spark.sql(f"ALTER TABLE {source} RENAME TO {'.'.join(parts[-2:])}")


def _dropped(spark: SparkSession, table: str) -> bool:
    """Drop a table that nobody needs; a failure is the caller's to report."""
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        return True
    except Exception:  # noqa: BLE001 - whatever the catalog raises
        return False


def swap_table(spark: SparkSession, live: str, staging: str) -> None:
    """Put ``staging`` in the place of ``live`` by renaming, as a database does it.

    The second rename is the commit: nothing after it can undo it. When it fails the first is
    undone, and a run that died between them is healed at the start of the next ``publish``.
    The former table stays beside the live one until the next swap, for queries that read it.
    """
    old = f"{live}_old"
    restore_interrupted_swap(spark, live)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    existed = spark.catalog.tableExists(live)
    if existed:
        _renamed(spark, live, old)
    try:
        _renamed(spark, staging, live)
    except Exception:
        # An error after the rename was done, such as a lost answer, is no failure.
        if spark.catalog.tableExists(live) and not spark.catalog.tableExists(staging):
            return
        if existed:
            _renamed(spark, old, live)
        raise


def restore_interrupted_swap(spark: SparkSession, live: str) -> bool:
    """Bring back the live table of a run that died between the two renames."""
    old = f"{live}_old"
    if spark.catalog.tableExists(live) or not spark.catalog.tableExists(old):
        return False
    _renamed(spark, old, live)
    return True


def version_name(table: str) -> str:
    return f"{table}{VERSION}{time.time_ns() // 10**9:010d}_{uuid.uuid4().hex}"


def version_history(spark: SparkSession, live: str) -> list[str]:
    """Versions of a published view, the live one first; empty if there is no such view."""
    if not spark.catalog.tableExists(live) or spark.catalog.getTable(live).tableType != "VIEW":
        return []
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {live}").collect()}
    return [v for v in found.get(HISTORY, "").split(",") if v]


def repoint_view(spark: SparkSession, live: str, version: str) -> tuple[str, ...]:
    """Make ``live`` a view of ``version``: one catalog step, which is the commit.

    Until then a failure leaves everything as it was; from then on nothing undoes it. The view
    itself lists its versions, so the former one is known and kept, and versions of other
    runs that are not live yet are not touched. A plain table of that name, from before there
    were versions, becomes the former version. Returns former versions that could not be dropped.
    """
    plain = spark.catalog.tableExists(live) and spark.catalog.getTable(live).tableType != "VIEW"
    history = version_history(spark, live)
    if plain:
        history = [version_name(live)]
        _renamed(spark, live, history[0])
    listed = [version, *(v for v in history if v != version)]
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {live} TBLPROPERTIES ('{HISTORY}' = '{','.join(listed)}') "
                  f"AS SELECT * FROM {version}")
    except Exception:
        if version_history(spark, live)[:1] != [version]:
            if plain:
                _renamed(spark, history[0], live)
            raise
    return tuple(v for v in listed[KEPT_VERSIONS:] if not _dropped(spark, v))


def drop_abandoned(spark: SparkSession, live: str, seconds: float = ABANDONED_SECONDS) -> list[str]:
    """Drop versions that dead runs left: old ones that the live view does not list."""
    database, _, name = live.rpartition(".")
    listed = {v.lower() for v in version_history(spark, live)}
    found = spark.sql(f"SHOW TABLES{' IN ' + database if database else ''} LIKE '{name}{VERSION}*'")
    dropped = []
    for row in found.collect():
        version = f"{database}.{row['tableName']}" if database else row["tableName"]
        begun = version.rpartition(VERSION)[2].partition("_")[0]
        old = not begun.isdigit() or int(begun) < time.time() - seconds
        if old and version.lower() not in listed and _dropped(spark, version):
            dropped.append(version)
    return dropped


def publish(df: DataFrame, table: str, columns: Sequence[tuple[str, str]],
            sums: Iterable[str] = (), using: str | None = "parquet",
            expected_rows: int | None = None, unique_key: str | None = None,
            lookups: Iterable[str] = ()) -> LoadMetrics:
    """Load ``df`` into a typed staging table, check it and put it live.

    Tables stored as files (``using``) are a table per run behind a view; a catalog that
    stores tables itself has them renamed. Whatever fails before the switch drops the staging
    table and leaves the live one alone; nothing that fails after it touches what is live.
    What an earlier run left half swapped is restored before anything else. The staged rows
    have to be as many as were loaded, and as ``expected_rows`` if given. ``unique_key`` also
    checks that no two staged rows share that column, which is what the primary key of a
    dimension enforces.
    """
    spark = df.sparkSession
    restore_interrupted_swap(spark, table)
    staging = version_name(table) if using else f"{table}_new"
    if not using:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    try:
        create_table(spark, staging, columns, using, lookups)
        metrics = load_table(df, staging, sums, expected_rows)
        staged = spark.table(staging)
        stored = staged.count()
        if stored != metrics.rows:
            raise PublishError(f"{staging} holds {stored} rows, {metrics.rows} were loaded")
        if expected_rows is not None and stored != expected_rows:
            raise PublishError(f"{staging} holds {stored} rows, {expected_rows} were expected")
        if unique_key is not None:
            repeated = staged.groupBy(unique_key).count().where("count > 1").limit(1)
            if not repeated.isEmpty():
                raise PublishError(f"{staging}.{unique_key} is not unique")
        leftovers: tuple[str, ...] = ()
        if using:
            leftovers = repoint_view(spark, table, staging)
        else:
            create_indexes(spark, staging, lookups)
            swap_table(spark, table, staging)
    except Exception:
        # The switch raises only if it has not happened.
        _dropped(spark, staging)
        raise
    return replace(metrics, table=table, leftovers=leftovers)


def publish_fact(fact: DataFrame, spec: FactSpec, table: str, using: str | None = "parquet",
                 expected_rows: int | None = None) -> LoadMetrics:
    """Lay out, number and publish a fact.

    Rows that nobody has counted yet are written first: they are read for their number, for
    quantiles, for ranges and for the table, and what they are made of is only worked out once.
    Each copy on the way to the table is deleted as soon as the next one is written.
    """
    spark = fact.sparkSession
    with passing_scratch(spark) as made, freed_shuffles(spark):
        if expected_rows is None:
            fact = _written(fact, spec.table)
        rows = fact.count() if expected_rows is None else expected_rows
        # The month leads: most lookups give one.
        columns = sorted((c for c in spec.lookups if c in fact.columns), key=lambda c: c != spec.month)
        laid_out = cluster(fact, columns, rows) if columns else fact
        used = list(made)
        numbered = with_row_ids(laid_out, spec.row_id)
        discard(spark, used)
        return publish(numbered, table, spec.ddl(), sums=spec.totals, using=using,
                       expected_rows=expected_rows, lookups=spec.lookups)


def publish_dimension(silver: DataFrame, spec: DimensionSpec, database: str,
                      run_ts=None, using: str | None = "parquet") -> PublishResult:
    """Build and publish one dimension; a failure is returned, not raised."""
    return _publish_members(silver.sparkSession, lambda: _written(build_dimension(silver, spec, run_ts), spec.table),
                            spec, database, using)


def _written(rows: DataFrame, name: str, *folders: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    with freed_shuffles(rows.sparkSession):
        rows.write.partitionBy(*folders).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _publish_members(spark: SparkSession, build: Callable[[], DataFrame], spec: DimensionSpec, database: str,
                     using: str | None) -> PublishResult:
    table = f"{database}.{spec.table}"
    try:
        with passing_scratch(spark):
            # Written rows: the layout reads them for quantiles, for ranges and for the table.
            members = build()
            count = members.count()
            members = cluster(members, spec.lookup_columns(), count)
            # Grouping already makes the key unique unless other attributes are shown.
            only_key = set(spec.attributes) <= set(spec.key.columns)
            metrics = publish(members, table, spec.ddl(), using=using, expected_rows=count,
                              unique_key=None if only_key else spec.key.name, lookups=spec.lookup_columns())
        return PublishResult(table, metrics)
    except Exception as error:  # noqa: BLE001 - reported per dimension
        return PublishResult(table, error=str(error))


def publish_dimensions(silver: DataFrame, specs: Iterable[DimensionSpec], database: str,
                       run_ts=None, using: str | None = "parquet",
                       concurrency: int = 5) -> list[PublishResult]:
    """Publish each dimension; one that fails does not stop the others.

    Silver is read once: the members of all dimensions are grouped in one pass and written,
    a folder per dimension. If that pass fails, each dimension is built by itself, so that only
    the one at fault is missing. They are published side by side and fill the executors that
    the tail of another one leaves idle.
    """
    specs = list(specs)
    if not specs:
        return []
    spark = silver.sparkSession
    with passing_scratch(spark), freed_shuffles(spark):
        try:
            members = _written(all_members(silver, specs), "members", MEMBER_SET)
        except Exception:  # noqa: BLE001 - whose fault it is shows when they are built one by one
            members = None

        def one(spec: DimensionSpec) -> PublishResult:
            if members is None:
                return publish_dimension(silver, spec, database, run_ts, using)
            return _publish_members(spark, lambda: dimension_of(members, spec, specs, run_ts), spec, database, using)

        inherited = inheritable_thread_target(spark)(one)
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            return list(pool.map(inherited, specs))


def create_indexes(spark: SparkSession, table: str, columns: Iterable[str]) -> None:
    """Lookup indexes in a catalog that has them, such as a JDBC one."""
    for column in columns:
        spark.sql(f"CREATE INDEX idx_{column} ON TABLE {table} (`{column}`)")
