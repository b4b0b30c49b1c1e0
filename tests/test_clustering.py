"""Layout of published tables for lookups."""

import datetime as dt
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sedimenta import purchases as P
from sedimenta.operators.rollup import monthly_rollup
from sedimenta.operators.star import build_fact
from sedimenta.plans.queries import scratch_database
from sedimenta.purchases import LAYOUT
from sedimenta.sinks import clustering as C
from sedimenta.sinks import tables as S
from sedimenta.sources.lake import with_partition_columns
from tests.fixtures import frame, plan_of, row


def test_ranks_and_interleaving(spark):
    values = [None, "a", "b", "b", "c", "d", "x", "é"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, i int")
    cuts = [("b", 2), ("c", 3), ("x", 6)]
    got = df.select("v", C.range_rank("v", cuts).alias("r"), C.interleaved([F.col("i"), F.lit(5) - F.col("i")], 3).alias("z"), "i")
    for r in got.where("i <= 5").collect():
        assert r["r"] == max([0, *(q for v, q in cuts if r["v"] is not None and v <= r["v"])])
        want = 0
        for bit in (2, 1, 0):
            for number in (r["i"], 5 - r["i"]):
                want = want << 1 | (number >> bit & 1)
        assert r["z"] == want
    assert [r["r"] for r in got.orderBy("i").collect()][-2:] == [6, 6]


@pytest.mark.parametrize("rows", [0, 1, 5, 50_000])
def test_cuts_come_from_a_bounded_sample(spark, rows):
    df = spark.range(rows).select((F.col("id") % 1000).alias("a"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("b"),
                                  F.lit(None).cast("date").alias("none"))
    cuts = C.quantile_cuts(df, ["a", "b", "none"], rows, 4)
    assert all(len(c) <= 15 and c == sorted(set(c)) for c in cuts.values()) and cuts["none"] == []
    if rows > 1000:
        assert [q for _, q in cuts["a"]] == list(range(1, 16)) and all(abs(x - 1000 * q / 16) < 40 for x, q in cuts["a"])
    # Rows of no cut, of equal values and of nulls are all kept.
    laid = C.cluster(df, ["a", "b", "none"], rows)
    assert laid.columns == ["a", "b", "none"] and laid.count() == rows


def test_one_shuffle_and_a_heavy_key_is_spread(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("other"))
    laid = C.cluster(df, ["k", "other"], 4000)
    plan = plan_of(laid)
    assert plan.count("rangepartitioning") >= 1 and "hashpartitioning" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in C.cluster(df, ["k", "other"], 4000).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 2000


def test_each_tree_is_planned_once(spark):
    values = [(f"a{i % 97:02d}", f"b{i}") for i in range(5000)]
    df = spark.createDataFrame(values, "a string, b string")
    laid = C.cluster(df, ["a", "b"], 5000)
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    # Two trees of at most 63 comparisons; repeated for every bit they would be twelve.
    assert 60 < plan.count("CASE WHEN") <= 2 * 64
    assert laid.columns == ["a", "b"] and sorted(map(tuple, laid.collect())) == sorted(values)


def test_bits_follow_rows_and_columns():
    assert C.rank_bits(2, 0) == C.rank_bits(7, 1) == 2
    assert C.rank_bits(7, 10**4) == 3 and C.rank_bits(2, 10**12) == C.MOST_BITS
    assert all(n * C.rank_bits(n, 10**15) <= C.ORDER_BITS for n in range(1, 63))


def purchases(n):
    rng = random.Random(4)
    out = []
    for i in range(n):
        out.append(row(src_order=i, ean=f"{rng.randrange(400):013d}", store_tax_id=f"{rng.randrange(60):014d}",
                       issue_month=f"2001{rng.randrange(1, 9):02d}", product=f"product {rng.randrange(9)}",
                       manufacturer=f"Maker {rng.randrange(50)}", supplier=f"Supplier {rng.randrange(80)}",
                       supplier_tax_id=str(rng.randrange(500)), product_group=f"G{rng.randrange(30)}", subclass=str(rng.randrange(9)),
                       brand=f"Brand {rng.randrange(300)}", amount=Decimal(i), issue_date=dt.date(2001, 5, 1)))
    return out


def groups(spark, table):
    """(rows, {column: (least, greatest)}) of every row group of a published table."""
    found = []
    for path in spark.table(table).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:")).metadata
        for g in range(meta.num_row_groups):
            group, spans = meta.row_group(g), {}
            for c in range(group.num_columns):
                column = group.column(c)
                if column.path_in_schema != "updated_at" and column.statistics is not None and column.statistics.has_min_max:
                    spans[column.path_in_schema] = column.statistics.min, column.statistics.max
            found.append((group.num_rows, spans))
    return found


def opened(found, column, value):
    """Share of row groups that a lookup has to open."""
    return sum(1 for _, spans in found if spans[column][0] <= value <= spans[column][1]) / len(found)


@pytest.fixture(scope="module")
def published(spark):
    """Fact and dimensions in many small row groups."""
    database = scratch_database(spark, "lookup")
    lake = with_partition_columns(frame(spark, purchases(6_000)), LAYOUT)
    silver = monthly_rollup(lake, as_of=dt.date(2001, 8, 15), run_ts=dt.datetime(2001, 8, 15))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "20")
    try:
        S.publish_fact(build_fact(silver, run_ts=dt.datetime(2001, 8, 15)), P.FACT, f"{database}.{P.FACT.table}")
        spark.conf.set("spark.sql.files.maxRecordsPerFile", "25")
        results = S.publish_dimensions(silver, P.DIMENSIONS, database, dt.datetime(2001, 8, 15))
        assert all(r.ok for r in results), results
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    return database


@pytest.mark.parametrize("column", P.FACT.lookups)
def test_fact_lookups_skip_row_groups(spark, published, column):
    table = f"{published}.{P.FACT.table}"
    found = groups(spark, table)
    assert len(found) > 250
    values = [r[0] for r in spark.table(table).select(column).distinct().orderBy(column).collect()]
    shares = [opened(found, column, v) for v in values[:: max(1, len(values) // 9)]]
    # 300 groups are little more than a bit of order for each of seven columns: about half of them at best.
    assert sum(shares) / len(shares) < 0.7, shares


@pytest.mark.parametrize("spec", P.DIMENSIONS, ids=lambda d: d.table)
def test_dimension_keys_skip_row_groups(spark, published, spec):
    table = f"{published}.{spec.table}"
    found = groups(spark, table)
    for column in spec.lookup_columns():
        values = [r[0] for r in spark.table(table).select(column).distinct().orderBy(column).collect()]
        shares = [opened(found, column, v) for v in values[:: max(1, len(values) // 9)]]
        assert len(found) < 4 or sum(shares) / len(shares) < 0.6, (column, shares)
    options = spark.sql(f"DESCRIBE TABLE EXTENDED {S.version_history(spark, table)[0]}").where(
        "col_name = 'Storage Properties'").first()[1]
    assert f"parquet.bloom.filter.enabled#{spec.key.name}=true" in options


def test_ids_follow_the_layout(spark, published):
    ids = [r[0] for r in spark.table(f"{published}.{P.FACT.table}").select(P.FACT.row_id).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
