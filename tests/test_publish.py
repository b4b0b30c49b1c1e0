import datetime as dt
import os
import re
import shutil
import subprocess
import sys
import time
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta import purchases as P
from sedimenta.operators.fingerprint import date_digests
from sedimenta.operators.rollup import monthly_rollup
from sedimenta.operators.star import build_fact
from sedimenta.plans.feed import LAKE_SCHEMA
from sedimenta.plans import layers as layers_module
from sedimenta.plans.layers import (
    Feeds,
    Settings,
    beside,
    read_silver,
    refresh_bronze,
    refresh_silver,
    run_layers,
    stage,
)
from sedimenta.plans.queries import scratch_database
from sedimenta.purchases import LAYOUT
from sedimenta.sinks import tables as S
from sedimenta.sinks.files import Store
from sedimenta.sinks.lease import Lease, LeaseLost, RunInProgress, leased
from sedimenta.sinks.partitions import write_partitions
from sedimenta.sources.lake import read_lake, with_partition_columns
from sedimenta.specs import ColumnSpec, DimensionSpec, KeySpec
from tests.fixtures import TOTALS_SCHEMA, frame, plan_of, row, source

AS_OF = dt.date(2001, 8, 15)
RUN_TS = dt.datetime(2001, 8, 15, 3, 0)
COLUMNS = [("id", "bigint"), ("name", "varchar(5)")]


@pytest.fixture
def database(spark):
    return scratch_database(spark, "t")


def silver(spark, rows):
    lake = with_partition_columns(frame(spark, rows), LAYOUT)
    return monthly_rollup(lake, as_of=AS_OF, run_ts=RUN_TS)


def rows_of(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def data(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, name string")


def published(spark, database):
    """Names of live tables; each must be a view of a stored version, with one former version at most."""
    tables = spark.catalog.listTables(database)
    live = [t.name for t in tables if t.tableType == "VIEW"]
    stored = [t.name.partition(S.VERSION)[0] for t in tables if t.tableType != "VIEW"]
    assert set(stored) == set(live) and all(stored.count(name) <= S.KEPT_VERSIONS for name in live)
    return live


def test_first_run_and_replacement(spark, database):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")), table, COLUMNS)
    assert rows_of(spark, table) == [(1, "a")]
    metrics = S.publish(data(spark, (2, "b"), (3, "c")), table, COLUMNS, expected_rows=2)
    assert rows_of(spark, table) == [(2, "b"), (3, "c")]
    assert (metrics.rows, metrics.percent, metrics.leftovers) == (2, 100.0, ())
    assert metrics.rows_per_second > 0
    assert published(spark, database) == ["x"]


@pytest.mark.parametrize("expected", [0, 1, 3])
def test_other_than_expected_rows_do_not_go_live(spark, database, expected):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")), table, COLUMNS)
    with pytest.raises(S.PublishError, match="were expected"):
        S.publish(data(spark, (2, "b"), (3, "c")), table, COLUMNS, expected_rows=expected)
    assert rows_of(spark, table) == [(1, "a")]


class FailingCatalog:
    """A session whose catalog refuses some statements."""

    def __init__(self, spark, monkeypatch, *refused):
        self.seen = []

        def sql(session, statement, *args, **options):
            if any(re.search(pattern, statement) for pattern in refused):
                self.seen.append(statement)
                raise RuntimeError("the catalog is away")
            return real(session, statement, *args, **options)

        real = type(spark).sql
        monkeypatch.setattr(type(spark), "sql", sql)


def test_failing_clean_up_leaves_the_new_rows_live(spark, database, monkeypatch):
    table = f"{database}.x"
    for i in range(2):
        S.publish(data(spark, (i, "a")), table, COLUMNS)
    with monkeypatch.context() as patch:
        catalog = FailingCatalog(spark, patch, "^DROP TABLE")
        metrics = S.publish(data(spark, (5, "b")), table, COLUMNS)
    assert len(catalog.seen) == 1 and len(metrics.leftovers) == 1
    assert rows_of(spark, table) == [(5, "b")]
    # The next publish tries again.
    assert S.publish(data(spark, (6, "b")), table, COLUMNS).leftovers == ()
    assert rows_of(spark, table) == [(6, "b")] and published(spark, database) == ["x"]


def test_failing_switch_leaves_the_old_rows_live(spark, database, monkeypatch):
    table = f"{database}.x"
    S.create_table(spark, table, COLUMNS)
    S.load_table(data(spark, (1, "a")), table)
    for refused in (["CREATE OR REPLACE VIEW"], ["CREATE OR REPLACE VIEW", "^DROP"]):
        with monkeypatch.context() as patch:
            FailingCatalog(spark, patch, *refused)
            with pytest.raises(RuntimeError, match="away"):
                S.publish(data(spark, (2, "b")), table, COLUMNS)
        assert rows_of(spark, table) == [(1, "a")]
    S.publish(data(spark, (3, "c")), table, COLUMNS)
    assert rows_of(spark, table) == [(3, "c")]


def test_lost_answer_after_the_switch_is_a_switch(spark, database, monkeypatch):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")), table, COLUMNS)
    real = type(spark).sql

    def sql(session, statement, *args, **options):
        done = real(session, statement, *args, **options)
        if statement.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("no answer")
        return done

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        S.publish(data(spark, (2, "b")), table, COLUMNS)
    assert rows_of(spark, table) == [(2, "b")]


def test_a_reader_outlives_one_publish(spark, database):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")), table, COLUMNS)
    reader = spark.table(table)
    S.publish(data(spark, (2, "b")), table, COLUMNS)
    assert [tuple(r) for r in reader.collect()] == [(1, "a")]
    assert rows_of(spark, table) == [(2, "b")]
    S.publish(data(spark, (3, "c")), table, COLUMNS)
    with pytest.raises(Exception):
        reader.collect()
    assert len(S.version_history(spark, table)) >= 2 and published(spark, database) == ["x"]


def test_versions_of_other_runs_are_left_alone(spark, database):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")), table, COLUMNS)
    loading = S.version_name(table)
    S.create_table(spark, loading, COLUMNS)
    old = f"{table}{S.VERSION}{1:010d}_dead"
    S.create_table(spark, old, COLUMNS)
    for i in range(3):
        S.publish(data(spark, (i, "b")), table, COLUMNS)
    assert spark.catalog.tableExists(loading) and spark.catalog.tableExists(old)
    assert S.drop_abandoned(spark, table) == [old]
    assert spark.catalog.tableExists(loading) and rows_of(spark, table) == [(2, "b")]


def test_swap_keeps_the_former_table_until_the_next(spark, database):
    live = f"{database}.x"
    for i in range(3):
        S.create_table(spark, f"{live}_new", COLUMNS)
        S.load_table(data(spark, (i, "a")), f"{live}_new")
        S.swap_table(spark, live, f"{live}_new")
        assert rows_of(spark, live) == [(i, "a")]
    assert rows_of(spark, f"{live}_old") == [(1, "a")]


def test_columns_are_bound_by_name(spark, database):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")).select("name", "id"), table, COLUMNS)
    assert rows_of(spark, table) == [(1, "a")]


def test_failed_load_leaves_the_live_table(spark, database):
    table = f"{database}.x"
    S.publish(data(spark, (1, "a")), table, COLUMNS)
    with pytest.raises(Exception, match="LENGTH|length"):
        S.publish(data(spark, (2, "too long")), table, COLUMNS)
    with pytest.raises(S.PublishError, match="not unique"):
        S.publish(data(spark, (2, "b"), (2, "c")), table, COLUMNS, unique_key="id")
    assert rows_of(spark, table) == [(1, "a")]
    assert published(spark, database) == ["x"]


def test_failed_swap_restores_the_live_table(spark, database):
    table = f"{database}.x"
    S.create_table(spark, table, COLUMNS)
    S.load_table(data(spark, (1, "a")), table)
    with pytest.raises(Exception):
        S.swap_table(spark, table, f"{database}.absent")
    assert rows_of(spark, table) == [(1, "a")]


def test_interrupted_swap_is_healed_before_a_failing_load(spark, database):
    table = f"{database}.x"
    S.create_table(spark, f"{table}_old", COLUMNS)
    S.load_table(data(spark, (1, "a")), f"{table}_old")
    with pytest.raises(Exception, match="LENGTH|length"):
        S.publish(data(spark, (2, "too long")), table, COLUMNS)
    assert rows_of(spark, table) == [(1, "a")]
    assert not S.restore_interrupted_swap(spark, table)
    S.publish(data(spark, (3, "c")), table, COLUMNS)
    assert rows_of(spark, table) == [(3, "c")] and published(spark, database) == ["x"]


def test_lookup_columns_have_bloom_filters(spark, database):
    table = f"{database}.x"
    S.publish(data(spark, *[(i, f"{i:05d}") for i in range(1000)]), table, COLUMNS, lookups=["name"])
    (path,) = spark.table(table).inputFiles()[:1]
    options = spark.sql(f"DESCRIBE TABLE EXTENDED {version_of(spark, database)}").where(
        "col_name = 'Storage Properties'").first()[1]
    assert "parquet.bloom.filter.enabled#name=true" in options
    with open(path.removeprefix("file:"), "rb") as f:
        whole = f.read()
    plain = f"{database}.y"
    S.publish(data(spark, *[(i, f"{i:05d}") for i in range(1000)]), plain, COLUMNS)
    (other,) = spark.table(plain).inputFiles()[:1]
    with open(other.removeprefix("file:"), "rb") as f:
        # The filter of one column adds its bits to the file.
        assert len(whole) > len(f.read()) + 30


def version_of(spark, database):
    return next(f"{database}.{t.name}" for t in spark.catalog.listTables(database)
                if t.name.startswith(f"x{S.VERSION}"))


def test_load_metrics_sums(spark, database):
    table = f"{database}.x"
    S.create_table(spark, table, COLUMNS)
    metrics = S.load_table(data(spark, (1, "a"), (4, "b")), table, sums=["id"])
    assert (metrics.rows, metrics.sums) == (2, {"id": 5})
    assert metrics.bytes > 0 and metrics.megabytes_per_second > 0
    assert S.stored_bytes(spark, f"{database}.absent") is None


def test_fact_table_types(spark, database):
    table = f"{database}.{P.FACT.table}"
    S.publish_fact(build_fact(silver(spark, [row(), row(brand=None)]), run_ts=RUN_TS),
                   P.FACT, table)
    stored = spark.table(table)
    assert stored.columns == [name for name, _ in P.FACT.ddl()]
    assert sorted(r[0] for r in stored.select("fact_id").collect()) == [1, 2]
    assert stored.schema["quantity"].dataType.simpleString() == "int"


def test_one_failing_dimension_does_not_stop_the_rest(spark, database):
    broken = DimensionSpec("dim_broken", KeySpec("id", ("absent",)), ("absent",), "issue_month")
    results = S.publish_dimensions(silver(spark, [row()]), [broken, P.DIM_BRAND], database, RUN_TS)
    assert [r.ok for r in results] == [False, True]
    assert "absent" in results[0].error
    assert spark.table(f"{database}.dim_brand").count() == 1


def layers(spark, tmp_path, database, **options):
    def day(n):
        return dt.date(2001, 8, n)

    daily = [row(src_order=n, proc_date=day(n), issue_date=day(n - 1)) for n in range(9, 15)]
    late = [row(src_order=20, proc_date=day(13)), row(src_order=21, proc_date=day(2)),
            row(src_order=22, proc_date=None)]
    totals = [(day(n), 1) for n in range(9, 15) if n != 13] + [(day(13), 2), (day(2), 1),
                                                              (day(8), 9)]
    feeds = Feeds(source(spark, daily), source(spark, late),
                  spark.createDataFrame(totals, TOTALS_SCHEMA))
    settings = Settings(str(tmp_path / "bronze"), str(tmp_path / "silver"), database,
                        LAKE_SCHEMA, AS_OF, RUN_TS, **options)
    return feeds, settings


def snapshot(spark, settings):
    bronze = read_lake(spark, settings.bronze_path, LAKE_SCHEMA)
    found = {"bronze": bronze, "silver": read_silver(spark, settings)}
    for name in [P.FACT.table] + [d.table for d in P.DIMENSIONS]:
        found[name] = spark.table(f"{settings.database}.{name}").drop("fact_id")
    return {k: sorted(str(r) for r in df.collect()) for k, df in found.items()}


def test_layers_from_nothing_and_again(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    first = run_layers(spark, feeds, settings)
    assert {r.proc_date.day for r in first.report if r.diverged} == {2, 8, 9, 10, 11, 12, 13, 14}
    assert all(d.ok for d in first.dimensions)
    before = snapshot(spark, settings)
    assert len(before["bronze"]) == 8
    assert first.fact.rows == len(before[P.FACT.table]) == len(before["silver"])

    second = run_layers(spark, feeds, settings)
    assert {r.proc_date.day for r in second.report if r.diverged} == {8}
    assert snapshot(spark, settings) == before


def test_layers_merge_late_rows_into_existing_dates(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    run_layers(spark, feeds, settings)
    late = feeds.late.unionByName(source(spark, [row(src_order=30, proc_date=dt.date(2001, 8, 9))]))
    totals = feeds.totals.unionByName(
        spark.createDataFrame([(dt.date(2001, 8, 9), 1)], TOTALS_SCHEMA)
    )
    run_layers(spark, Feeds(feeds.daily, late, totals), settings)
    stored = read_lake(spark, settings.bronze_path, LAKE_SCHEMA)
    ninth = stored.where(F.col("proc_date") == dt.date(2001, 8, 9))
    assert sorted((r.src_order, r.origin) for r in ninth.collect()) == [(9, "DAILY"), (30, "LATE")]


NO_FEEDS = ("daily", "late", "totals")


def broken_lake(spark, tmp_path, settings):
    """A finished copy of the lake, and a date removed, as a driver leaves them that dies in between."""
    bronze = read_lake(spark, settings.bronze_path, LAKE_SCHEMA)
    rows = sorted(str(r) for r in bronze.collect())
    assert len(rows) == 8
    stage(bronze, settings)
    shutil.rmtree(tmp_path / "bronze" / "proc_year=2001" / "proc_month=08" / "proc_date=2001-08-13")
    return rows


def repairs(tmp_path):
    return sorted(p.name for p in (tmp_path / "bronze_repairs").iterdir() if not p.name.startswith("."))


def test_interrupted_repair_is_completed(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    refresh_bronze(spark, feeds, settings)
    assert repairs(tmp_path) == []
    rows = broken_lake(spark, tmp_path, settings)
    assert len(repairs(tmp_path)) == 2
    # A session of its own has other temporary views and settings, and knows of the copy all the same.
    other = spark.newSession()
    none = Feeds(*(spark_frame(other, getattr(feeds, f)) for f in NO_FEEDS))
    refresh_bronze(other, none, settings)
    assert sorted(str(r) for r in read_lake(other, settings.bronze_path, LAKE_SCHEMA).collect()) == rows
    assert repairs(tmp_path) == []


def spark_frame(spark, like):
    return spark.createDataFrame([], like.schema)


RESTART = """
import datetime as dt, sys
sys.path.insert(0, {root!r})
from sedimenta.plans.feed import LAKE_SCHEMA
from sedimenta.plans.layers import Feeds, Settings, finish_staged, refresh_bronze, stage
from sedimenta.session import build_session
from sedimenta.sources.lake import read_lake
from tests.fixtures import TOTALS_SCHEMA, source
spark = build_session("restart", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.sql.warehouse.dir": {warehouse!r}}})
settings = Settings({bronze!r}, {silver!r}, "gold", LAKE_SCHEMA, dt.date(2001, 8, 15))
refresh_bronze(spark, Feeds(source(spark, []), source(spark, []), spark.createDataFrame([], TOTALS_SCHEMA)), settings)
print("ROWS", sorted(str(r) for r in read_lake(spark, settings.bronze_path, LAKE_SCHEMA).collect()))
"""


def test_interrupted_repair_is_completed_by_another_process(spark, tmp_path, database):
    """Neither the session, its catalog nor its warehouse is the one that made the copy."""
    feeds, settings = layers(spark, tmp_path, database)
    refresh_bronze(spark, feeds, settings)
    rows = broken_lake(spark, tmp_path, settings)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = RESTART.format(root=root, warehouse=str(tmp_path / "w"), bronze=settings.bronze_path, silver=settings.silver_path)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert f"ROWS {rows}" in done.stdout, done.stderr[-2000:]
    assert repairs(tmp_path) == []


def test_unfinished_and_used_copies_do_not_touch_the_lake(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    run_layers(spark, feeds, settings)
    before = files(tmp_path / "bronze")
    bronze = read_lake(spark, settings.bronze_path, LAKE_SCHEMA)
    # Two dates in two files: half of a copy would lose rows of the other half's dates.
    path = stage(bronze.where("proc_date < DATE'2001-08-12'").repartition(2), settings)
    os.remove(next(p for p in (tmp_path / "bronze_repairs" / os.path.basename(path)).iterdir()
                   if p.name.endswith(".parquet")))
    bronze.limit(1).write.parquet(str(tmp_path / "bronze_repairs" / "never-finished"))
    run_layers(spark, feeds, settings)
    assert files(tmp_path / "bronze") == before and repairs(tmp_path) == []


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_settled_dates_are_not_written_again(spark, tmp_path, database):
    """Copies among the late rows keep the counts apart for ever; the content settles."""
    feeds, settings = layers(spark, tmp_path, database)
    copies = source(spark, [row(src_order=31, proc_date=dt.date(2001, 8, 9))] * 3)
    run_layers(spark, feeds, settings)
    feeds = Feeds(feeds.daily, feeds.late.unionByName(copies), feeds.totals.unionByName(
        spark.createDataFrame([(dt.date(2001, 8, 9), 3)], TOTALS_SCHEMA)))
    run_layers(spark, feeds, settings)
    before = files(tmp_path / "bronze")
    report = run_layers(spark, feeds, settings).report
    assert dt.date(2001, 8, 9) in {r.proc_date for r in report if r.diverged}
    assert files(tmp_path / "bronze") == before


def test_one_stamp_and_full_percentage(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    result = run_layers(spark, feeds, replace(settings, run_ts=None))
    assert result.fact.percent == 100.0
    stamps = {r[0] for t in [P.FACT.table] + [d.table for d in P.DIMENSIONS]
              for r in spark.table(f"{database}.{t}").select("updated_at").distinct().collect()}
    assert len(stamps) == 1
    run_layers(spark, feeds, replace(settings, year_from="issue", silver_path=str(tmp_path / "s2")))


def spoil(path):
    """Make every data file unreadable; names, and so the listing, stay."""
    for p in path.rglob("*.parquet"):
        os.chmod(p, 0o644)
        p.write_bytes(b"not parquet")
        crc = p.with_name(f".{p.name}.crc")
        if crc.exists():
            crc.unlink()


def test_settled_dates_are_not_read_again(spark, tmp_path, database):
    """With copies among the late rows two dates diverge for ever; a third run opens no file of the lake."""
    feeds, settings = layers(spark, tmp_path, database)
    run_layers(spark, feeds, settings)
    copies = source(spark, [row(src_order=31, proc_date=dt.date(2001, 8, 9))] * 3 + [row(src_order=20, proc_date=dt.date(2001, 8, 13))])
    feeds = Feeds(feeds.daily, feeds.late.unionByName(copies), feeds.totals.unionByName(
        spark.createDataFrame([(dt.date(2001, 8, 9), 3), (dt.date(2001, 8, 13), 1)], TOTALS_SCHEMA)))
    run_layers(spark, feeds, settings)
    before = snapshot_without_bronze(spark, settings)
    kept = tmp_path / "kept"
    shutil.copytree(tmp_path / "bronze", kept)
    spoil(tmp_path / "bronze")
    report = run_layers(spark, feeds, settings).report
    assert {9, 13} <= {r.proc_date.day for r in report if r.diverged}
    assert snapshot_without_bronze(spark, settings) == before

    # Another late row is noticed, and its date is read and merged.
    with pytest.raises(Exception):
        run_layers(spark, more_late(spark, feeds), settings)
    shutil.copytree(kept, tmp_path / "bronze", dirs_exist_ok=True)
    run_layers(spark, more_late(spark, feeds), settings)
    ninth = read_lake(spark, settings.bronze_path, LAKE_SCHEMA).where("proc_date = DATE'2001-08-09'")
    assert sorted((r.src_order, r.origin) for r in ninth.collect()) == [(9, "DAILY"), (31, "LATE"), (77, "LATE")]


def more_late(spark, feeds):
    return Feeds(feeds.daily, feeds.late.unionByName(source(spark, [row(src_order=77, proc_date=dt.date(2001, 8, 9))])),
                 feeds.totals)


def snapshot_without_bronze(spark, settings):
    found = {"silver": read_silver(spark, settings)}
    for name in [P.FACT.table] + [d.table for d in P.DIMENSIONS]:
        found[name] = spark.table(f"{settings.database}.{name}").drop("fact_id")
    return {k: sorted(str(r) for r in df.collect()) for k, df in found.items()}


def test_a_date_changed_by_others_is_looked_at_again(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    run_layers(spark, feeds, settings)
    day = read_lake(spark, settings.bronze_path, LAKE_SCHEMA).where("proc_date = DATE'2001-08-13'")
    lost = day.where("origin = 'DAILY'").collect()
    assert len(lost) == 1
    write_partitions(spark.createDataFrame(lost, LAKE_SCHEMA), settings.bronze_path, LAYOUT.columns)
    assert read_lake(spark, settings.bronze_path, LAKE_SCHEMA).count() == 7
    report = run_layers(spark, feeds, settings).report
    assert dt.date(2001, 8, 13) in {r.proc_date for r in report if r.diverged}
    assert read_lake(spark, settings.bronze_path, LAKE_SCHEMA).count() == 8


def years(spark, tmp_path, name, **options):
    """Purchases of three years, one of them partly outside of the window as time passes."""
    rows = [row(src_order=i, proc_date=d + dt.timedelta(days=1), issue_date=d, issue_month=f"{d:%Y%m}", amount=Decimal(i))
            for i, d in enumerate(dt.date(1999, 6, 10) + dt.timedelta(days=23 * k) for k in range(35))]
    settings = Settings(str(tmp_path / "bronze"), str(tmp_path / name), "unused", LAKE_SCHEMA, AS_OF, RUN_TS, **options)
    return rows, settings


def silver_rows(spark, settings):
    return sorted(str(r) for r in read_silver(spark, settings).collect())


def write_dates(spark, rows, settings):
    lake = with_partition_columns(frame(spark, rows), LAYOUT)
    write_partitions(lake, settings.bronze_path, LAYOUT.columns)


@pytest.mark.parametrize("options", [{}, {"year_from": "issue"}, {"prune_stale": True}])
def test_rollup_of_changed_years_equals_a_full_one(spark, tmp_path, options):
    rows, settings = years(spark, tmp_path, "delta", **options)
    write_dates(spark, rows, settings)
    full = replace(settings, silver_path=str(tmp_path / "full"))
    made = []
    for k, as_of in enumerate([dt.date(2001, 6, 2), dt.date(2001, 6, 30), dt.date(2001, 7, 1), dt.date(2001, 9, 5),
                               dt.date(2002, 2, 1), dt.date(2001, 7, 1)]):
        if k == 3:
            write_dates(spark, [row(src_order=90, proc_date=dt.date(2001, 3, 3), issue_date=dt.date(2001, 3, 2),
                                    issue_month="200103")], settings)
        made.append(refresh_silver(spark, replace(settings, as_of=as_of)))
        shutil.rmtree(tmp_path / "full_state", ignore_errors=True)
        refresh_silver(spark, replace(full, as_of=as_of))
        assert silver_rows(spark, settings) == silver_rows(spark, full)
    if not options:
        # Same month: nothing. The window's edge moves: the year that loses rows. A date is written: its year.
        assert made[:2] == [["1999", "2000", "2001"], []]
        assert made[2] == ["1999"] and made[3] == ["1999", "2001"]
        assert made[4] == ["1999", "2000"] and made[5] == ["1999", "2000", "2001"]


def test_nothing_repaired_writes_no_silver(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    run_layers(spark, feeds, settings)
    before = files(tmp_path / "silver")
    run_layers(spark, feeds, replace(settings, as_of=AS_OF + dt.timedelta(days=1)))
    assert files(tmp_path / "silver") == before
    # A year of silver that was lost is made again.
    shutil.rmtree(tmp_path / "silver" / "proc_year=2001")
    run_layers(spark, feeds, settings)
    assert len(files(tmp_path / "silver")) == len(before)


def test_second_run_is_refused_meanwhile(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    store = Store(spark, beside(settings.bronze_path, "runs"))
    with leased(store, 600):
        with pytest.raises(RunInProgress):
            run_layers(spark, feeds, settings)
    assert run_layers(spark, feeds, settings).fact.rows > 0
    assert "lease.json" not in store.names()


def test_expired_lease_is_taken_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "runs"))
    dead, other = Lease(store, 0.2), Lease(store, 600)
    dead.acquire()
    time.sleep(0.3)
    other.acquire()
    with pytest.raises(LeaseLost):
        dead.renew()
    with pytest.raises(RunInProgress):
        Lease(store, 600).acquire()
    dead.release()
    other.renew()
    other.release()
    assert store.names() == []


def test_lease_is_renewed_while_it_is_held(spark, tmp_path):
    store = Store(spark, str(tmp_path / "runs"))
    with leased(store, 0.6):
        time.sleep(1.5)
        with pytest.raises(RunInProgress):
            Lease(store, 600).acquire()


def test_begun_lease_of_a_dead_run_expires(spark, tmp_path):
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "lease.json").write_text("")
    store = Store(spark, str(tmp_path / "runs"))
    with pytest.raises(RunInProgress):
        Lease(store, 600).acquire()
    time.sleep(1.2)
    Lease(store, 1.0).acquire()


def test_failed_run_goes_on_where_it_stopped(spark, tmp_path, database, monkeypatch):
    feeds, settings = layers(spark, tmp_path, database)
    settings = replace(settings, run_ts=None)
    with monkeypatch.context() as patch:
        patch.setattr(layers_module, "publish_fact", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_layers(spark, feeds, settings)
    before = files(tmp_path)
    result = run_layers(spark, feeds, settings)
    assert set(result.skipped) == {"bronze", "silver", *(d.table for d in P.DIMENSIONS)}
    assert result.report == () and result.dimensions == [] and result.fact.rows > 0
    kept = files(tmp_path)
    assert {p: t for p, t in kept.items() if p in before} == before
    stamps = {r[0] for t in [P.FACT.table] + [d.table for d in P.DIMENSIONS]
              for r in spark.table(f"{database}.{t}").select("updated_at").distinct().collect()}
    assert len(stamps) == 1
    # All is done: the next run is a new one.
    assert run_layers(spark, feeds, settings).skipped == ()


def test_files_hold_what_was_put(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.latest("x") is None and store.names() == [] and store.read("a.json") is None
    for i in range(3):
        store.put("x", {"i": i})
    assert store.latest("x") == {"i": 2} and len(store.names()) == 1
    assert store.create("a.json", {"é": 1}) and not store.create("a.json", {}) and store.read("a.json") == {"é": 1}
    store.replace("a.json", {"b": None})
    assert store.read("a.json") == {"b": None}


def test_digests_tell_rows_apart(spark):
    schema = "proc_date date, a string, b string"
    day, other = dt.date(2001, 1, 1), dt.date(2001, 1, 2)
    base = [(day, "x", None), (day, "y", "z"), (other, None, "x")]

    def of(rows):
        return {r["proc_date"]: (r["rows"], r["digest"]) for r in date_digests(spark.createDataFrame(rows, schema), "proc_date").collect()}

    assert of(base) == of(base[::-1])
    for rows in ([(day, None, "x"), (day, "y", "z")], [(day, "x", None)] * 2 + [(day, "y", "z")], [(day, "x", ""), (day, "y", "z")],
                 [(day, "x", None)], [(day, "x", "z"), (day, "y", None)]):
        assert of(rows)[day] != of(base)[day]
    assert of([(other, None, "x")])[other] == of(base)[other]


class ByDate:
    """Stands in for an operational table that is read by date."""

    def __init__(self, rows):
        self.rows, self.asked = rows, []

    def read(self, spark):
        return self.rows

    def read_dates(self, spark, dates, scans=1):
        if dates:
            self.asked.append(sorted(d.day for d in dates))
        return self.rows.where(F.col("proc_date").isin(list(dates)))

    def distinct_dates(self, spark):
        return self.rows.where("proc_date IS NOT NULL").select("proc_date").distinct()


def test_layers_read_only_the_dates_they_repair(spark, tmp_path, database):
    feeds, settings = layers(spark, tmp_path, database)
    tables = Feeds(ByDate(feeds.daily), ByDate(feeds.late), ByDate(feeds.totals))
    run_layers(spark, tables, settings)
    by_date = snapshot(spark, settings)
    assert tables.daily.asked == [[2, 8, 9, 10, 11, 12, 13, 14]]
    run_layers(spark, tables, settings)
    assert tables.daily.asked[1] == tables.late.asked[1] == [8]

    _, other = layers(spark, tmp_path / "frames", scratch_database(spark, "t"))
    run_layers(spark, feeds, other)
    assert snapshot(spark, other) == by_date


def test_failing_fact_does_not_stop_the_dimensions(spark, tmp_path, database):
    wrong = replace(P.FACT, columns=(ColumnSpec("x", "brand", "int"),
                                     ColumnSpec("issue_month", "issue_month", "date")),
                    totals=())
    feeds, settings = layers(spark, tmp_path, database, fact=wrong)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_layers(spark, feeds, settings)
    assert spark.table(f"{database}.dim_brand").count() == 1
    assert not spark.catalog.tableExists(f"{database}.{P.FACT.table}")
