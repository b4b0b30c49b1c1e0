"""Registered queries: every operator over the whole derived feed."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta import purchases as P
from sedimenta.operators import merge, reconcile, rollup, star
from sedimenta.plans import feed
from sedimenta.plans.layers import Feeds, Settings, read_silver, run_layers, staged_rows
from sedimenta.plans.oracles import RUN_CONTENTS
from sedimenta.session import freed_shuffles, passing_scratch, scratch_path
from sedimenta.sinks import tables
from sedimenta.sinks.delimited import write_delimited
from sedimenta.sinks.partitions import write_partitions
from sedimenta.sources.delimited import read_delimited
from sedimenta.sources.lake import read_lake, with_partition_columns
from sedimenta.specs import DimensionSpec

EARLIER = dt.date(1999, 8, 15)
RUN_TS = dt.datetime(2001, 8, 15, 3, 0, 0)


def silver(spark: SparkSession, sf_dir: str, as_of: dt.date = feed.AS_OF) -> DataFrame:
    return rollup.monthly_rollup(feed.all_rows(feed.feed_all(spark, sf_dir)), as_of=as_of, stamp=False)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a written table, so that its readers do not each repeat it."""
    rows = silver(spark, sf_dir)
    path = scratch_path(spark, "silver")
    write_partitions(rows, path, [P.ROLLUP.year_key], cluster=False)
    return read_lake(spark, path, rows.schema)


def scratch_database(spark: SparkSession, name: str) -> str:
    """A database of its own, stored in the scratch folder."""
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, name)}'")
    return database


def monthly_rollup(spark, sf_dir):
    return silver(spark, sf_dir)


def rolling_window_filter(spark, sf_dir):
    rows = feed.all_rows(feed.feed_all(spark, sf_dir)).select(*feed.COLUMNS)
    return rollup.rolling_window(rows, "issue_date", feed.AS_OF)


def representative_supplier(spark, sf_dir):
    rows = feed.all_rows(feed.feed_all(spark, sf_dir))
    return rollup.representative(rows, ["supplier_tax_id"], "supplier")


def fact_build(spark, sf_dir):
    return star.build_fact(silver(spark, sf_dir), stamp=False)


def fact_with_supplier_key(spark, sf_dir):
    return star.build_fact(silver(spark, sf_dir), stamp=False, extra_keys=[P.SUPPLIER_KEY])


def dimension(spec: DimensionSpec) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: star.build_dimension(silver(spark, sf_dir), spec, stamp=False)


def fact_key_integrity(spark, sf_dir):
    rows = stored_silver(spark, sf_dir)
    fact = star.build_fact(rows, stamp=False, extra_keys=[P.SUPPLIER_KEY])
    return star.orphan_counts(fact, star.member_keys(rows), [d.key.name for d in P.DIMENSIONS])


def expected_counts(spark, sf_dir):
    return reconcile.expected_counts(feed.totals(feed.feed_all(spark, sf_dir)))


def actual_counts(spark, sf_dir):
    return reconcile.actual_counts(feed.lake(feed.feed_all(spark, sf_dir)))


def late_dates(spark, sf_dir):
    return reconcile.late_dates(feed.late_source(feed.feed_all(spark, sf_dir)))


def reconcile_recent(spark, sf_dir):
    lines = feed.feed_all(spark, sf_dir)
    return reconcile.reconcile_recent(feed.lake(lines), feed.totals(lines), feed.AS_OF)


def reconcile_flagged(spark, sf_dir):
    lines = feed.feed_all(spark, sf_dir)
    return reconcile.reconcile_flagged(
        feed.lake(lines), feed.late_source(lines), feed.totals(lines), feed.AS_OF
    )


def _report(lines):
    return reconcile.reconcile(
        feed.lake(lines), feed.late_source(lines), feed.totals(lines), feed.AS_OF
    )


def reconcile_report(spark, sf_dir):
    return _report(feed.feed_all(spark, sf_dir))


def initial_load(spark, sf_dir):
    lines = feed.feed_all(spark, sf_dir)
    return merge.initial_load(feed.daily_source(lines), feed.late_source(lines))


def late_merge(spark, sf_dir):
    lines = feed.feed_all(spark, sf_dir)
    return merge.merge_late_rows(feed.lake(lines), feed.late_source(lines))


def _repair(spark, sf_dir, reread_daily=False):
    lines = feed.stored_feed(spark, sf_dir)
    plan = merge.plan_repair(_report(lines))
    return merge.repair(feed.lake(lines), feed.daily_source(lines), feed.late_source(lines),
                        plan, reread_daily=reread_daily)


def repair_all(spark, sf_dir):
    return _repair(spark, sf_dir)


def repair_reread_daily(spark, sf_dir):
    return _repair(spark, sf_dir, reread_daily=True)


def repair_again(spark, sf_dir):
    """The dates that still diverge after a repair, and whether they would be written again."""
    with freed_shuffles(spark):
        lines = feed.stored_feed(spark, sf_dir)
        late = feed.late_source(lines)
        plan = merge.plan_repair(_report(lines))
        fixed = merge.repair(feed.lake(lines), feed.daily_source(lines), late, plan)
        path = scratch_path(spark, "bronze")
        write_partitions(feed.lake(lines), path, P.LAYOUT.columns)
        fixed = fixed.select(*read_lake(spark, path, feed.LAKE_SCHEMA).columns)
        with passing_scratch(spark):
            # Merged and then brought together by date: the shuffle files of only one of the two exist at a time.
            write_partitions(staged_rows(fixed, "repaired"), path, P.LAYOUT.columns)
        stored = read_lake(spark, path, feed.LAKE_SCHEMA)
        again = merge.plan_repair(reconcile.reconcile(stored, late, feed.totals(lines), feed.AS_OF))
    date = P.LAYOUT.date
    incoming = merge.incoming_rows(None, again.merge.restrict(late, date))
    return merge.changed_dates(again.merge.restrict(stored, date), incoming)


def bronze_partition_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    rows = with_partition_columns(initial_load(spark, sf_dir), P.LAYOUT)
    write_partitions(rows, path, P.LAYOUT.columns)
    return read_lake(spark, path, feed.LAKE_SCHEMA)


def silver_partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "silver")
    for as_of in (EARLIER, feed.AS_OF):
        write_partitions(silver(spark, sf_dir, as_of), path, [P.ROLLUP.year_key], cluster=False)
    return read_lake(spark, path, silver(spark, sf_dir).schema)


def delimited_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    rows = silver(spark, sf_dir)
    write_delimited(rows, path)
    return read_delimited(spark, path, rows.schema)


def swap_publish(spark, sf_dir):
    table = f"{scratch_database(spark, 'gold')}.{P.FACT.table}"
    for as_of in (EARLIER, feed.AS_OF):
        fact = star.build_fact(silver(spark, sf_dir, as_of), run_ts=RUN_TS)
        tables.publish_fact(fact, P.FACT, table)
    return spark.table(table).drop(P.FACT.row_id, P.FACT.stamp)


def published_dimensions(spark, sf_dir):
    """What readers find in every published dimension, one row per member."""
    database = scratch_database(spark, "dims")
    results = tables.publish_dimensions(stored_silver(spark, sf_dir), P.DIMENSIONS, database, RUN_TS)
    failed = [r for r in results if not r.ok]
    if failed:
        raise RuntimeError("; ".join(f"{r.table}: {r.error}" for r in failed))
    return reduce(DataFrame.unionByName, [_published(spark, database, d) for d in P.DIMENSIONS])


def _published(spark, database, spec):
    names = [spec.output_name(a) for a in spec.attributes]
    second = F.col(names[1]) if len(names) > 1 else F.lit(None).cast("string")
    return spark.table(f"{database}.{spec.table}").select(
        F.lit(spec.table).alias("table_name"),
        F.col(spec.key.name).alias("member_key"),
        F.col(names[0]).alias("first_attribute"),
        second.alias("second_attribute"),
        spec.month,
        F.date_format(spec.stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"),
    )


def load_metrics(spark, sf_dir):
    table = f"{scratch_database(spark, 'metrics')}.{P.FACT.table}"
    fact = star.build_fact(silver(spark, sf_dir), run_ts=RUN_TS)
    tables.create_table(spark, table, P.FACT.ddl())
    loaded = tables.load_table(star.with_row_ids(fact), table, sums=P.FACT.totals)
    return spark.range(1).select(
        F.lit(P.FACT.table).alias("table_name"),
        F.lit(loaded.rows).cast("bigint").alias("row_count"),
        F.lit(loaded.sums["amount"]).cast("decimal(25,4)").alias("amount_total"),
    )


def fact_row_ids(spark, sf_dir):
    fact = star.with_row_ids(star.build_fact(silver(spark, sf_dir), stamp=False))
    return fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(P.FACT.row_id).alias("distinct_ids"),
        F.min(P.FACT.row_id).alias("first_id"),
        F.max(P.FACT.row_id).alias("last_id"),
    )


def layered_run(spark, sf_dir):
    """All layers from an existing lake; size, total and contents of every table they leave."""
    database = scratch_database(spark, "layers")
    settings = Settings(
        bronze_path=scratch_path(spark, "bronze"),
        silver_path=scratch_path(spark, "silver"),
        database=database,
        bronze_schema=feed.LAKE_SCHEMA,
        as_of=feed.AS_OF,
        run_ts=RUN_TS,
    )
    with passing_scratch(spark):
        lines = feed.stored_feed(spark, sf_dir)
        write_partitions(feed.lake(lines), settings.bronze_path, P.LAYOUT.columns)
        feeds = Feeds(feed.daily_source(lines), feed.late_source(lines), feed.totals(lines))
        result = run_layers(spark, feeds, settings)
    failed = [d for d in result.dimensions if not d.ok]
    if failed:
        raise RuntimeError("; ".join(f"{d.table}: {d.error}" for d in failed))

    stored = {
        "bronze": read_lake(spark, settings.bronze_path, feed.LAKE_SCHEMA),
        "silver": read_silver(spark, settings),
        P.FACT.table: spark.table(f"{database}.{P.FACT.table}"),
    }
    stored.update({d.table: spark.table(f"{database}.{d.table}") for d in P.DIMENSIONS})
    sizes = [_size(name, rows) for name, rows in stored.items()]
    return reduce(DataFrame.unionByName, sizes)


def _contents(rows: DataFrame, columns: list[str]):
    """A number that changes with any value of any row, whatever the order of rows."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
    digest = F.substring(F.md5(F.concat_ws("|", *values)), 1, 12)
    return F.sum(F.conv(digest, 16, 10).cast("decimal(20,0)")).cast("string")


def _size(name: str, rows: DataFrame) -> DataFrame:
    total = F.sum("amount") if "amount" in rows.columns else F.lit(None)
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        total.cast("decimal(25,4)").alias("amount_total"),
        _contents(rows, RUN_CONTENTS[name]).alias("contents"),
    ).select(F.lit(name).alias("table_name"), "row_count", "amount_total", "contents")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "monthly_rollup": monthly_rollup,
    "rolling_window_filter": rolling_window_filter,
    "representative_supplier": representative_supplier,
    "fact_build": fact_build,
    "fact_with_supplier_key": fact_with_supplier_key,
    "dim_manufacturer": dimension(P.DIM_MANUFACTURER),
    "dim_supplier": dimension(P.DIM_SUPPLIER),
    "dim_brand": dimension(P.DIM_BRAND),
    "dim_group": dimension(P.DIM_GROUP),
    "dim_product": dimension(P.DIM_PRODUCT),
    "fact_key_integrity": fact_key_integrity,
    "expected_counts": expected_counts,
    "actual_counts": actual_counts,
    "late_dates": late_dates,
    "reconcile_recent": reconcile_recent,
    "reconcile_flagged": reconcile_flagged,
    "reconcile_report": reconcile_report,
    "initial_load": initial_load,
    "late_merge": late_merge,
    "repair_all": repair_all,
    "repair_reread_daily": repair_reread_daily,
    "repair_again": repair_again,
    "bronze_partition_roundtrip": bronze_partition_roundtrip,
    "silver_partition_overwrite": silver_partition_overwrite,
    "delimited_roundtrip": delimited_roundtrip,
    "swap_publish": swap_publish,
    "published_dimensions": published_dimensions,
    "load_metrics": load_metrics,
    "fact_row_ids": fact_row_ids,
    "layered_run": layered_run,
}
