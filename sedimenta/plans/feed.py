"""A purchase feed derived from the order tables, used by queries and benchmarks.

The same derivation is written as SQL in ``oracles.py``. Every lineitem row is
one purchase line; its origin, its late copies and its presence in the lake are
functions of row attributes, so each view below is one pass over the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.purchases import DAILY, LATE, LAYOUT
from sedimenta.session import freed_shuffles, scratch_path
from sedimenta.sources.lake import lake_schema, with_partition_columns
from sedimenta.sources.spread import spread

AS_OF = dt.date(2001, 8, 15)

# Announced by the totaliser, absent from both sources.
MISSING_AT_SOURCE = dt.date(2001, 8, 12)
ANNOUNCED_ROWS = 5

# The lake has nothing for this day of any month.
MISSING_IN_LAKE_DAY = 9

FEED_SCHEMA = T.StructType([
    T.StructField("src_order", T.LongType()),
    T.StructField("src_line", T.IntegerType()),
    T.StructField("ean", T.StringType()),
    T.StructField("store_tax_id", T.StringType()),
    T.StructField("issue_month", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("manufacturer", T.StringType()),
    T.StructField("supplier", T.StringType()),
    T.StructField("supplier_tax_id", T.StringType()),
    T.StructField("product_group", T.StringType()),
    T.StructField("subclass", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("amount", T.DecimalType(15, 4)),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("issue_date", T.DateType()),
    T.StructField("proc_date", T.DateType()),
    T.StructField("origin", T.StringType()),
])

LAKE_SCHEMA = lake_schema(FEED_SCHEMA, LAYOUT)

SOURCE_COLUMNS = [f.name for f in FEED_SCHEMA.fields if f.name != "origin"]
COLUMNS = [f.name for f in FEED_SCHEMA.fields]


# The order tables, declared so that no file is opened to infer a schema.
TABLES = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string,
        p_size int, p_retailprice double""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

PARTITIONS = "sedimenta.feed.partitions"

LINE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

# A week is processed on Tuesday to Thursday of the next one.
LINE = [
    "l_orderkey AS src_order",
    "l_linenumber AS src_line",
    "lpad(CAST(l_partkey AS STRING), 13, '0') AS ean",
    "lpad(CAST(o_custkey AS STRING), 14, '0') AS store_tax_id",
    "CAST(year(shipped) * 100 + month(shipped) AS STRING) AS issue_month",
    "CASE WHEN p_type = 'PROMO' THEN concat(p_name, '; x') ELSE p_name END AS product",
    "concat('Maker ', substring(p_brand, 7, 1)) AS manufacturer",
    "CASE WHEN l_linenumber = 1 THEN concat(s_name, ' Ltd') ELSE s_name END AS supplier",
    "CAST(l_suppkey AS STRING) AS supplier_tax_id",
    "p_type AS product_group",
    "CASE WHEN p_size >= 5 THEN CAST(p_size AS STRING) END AS subclass",
    "CASE WHEN p_size <= 45 THEN p_brand END AS brand",
    "CAST(l_extendedprice AS DECIMAL(15,4)) AS amount",
    "l_quantity + CASE WHEN l_linenumber = 2 THEN 0.5D ELSE 0.0D END AS quantity",
    "shipped AS issue_date",
    """date_add(trunc(shipped, 'week'),
         CASE l_returnflag WHEN 'N' THEN 8 WHEN 'A' THEN 9 ELSE 10 END) AS proc_date""",
    f"""CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'O'
         THEN '{LATE}' ELSE '{DAILY}' END AS origin""",
    "l_returnflag",
    "l_linestatus",
]

# Late rows with return flag R are delivered twice; late rows of Tuesdays, or with
# line status F, were merged into the lake by an earlier run.
FLAGS = [
    "*",
    f"proc_date <> DATE'{MISSING_AT_SOURCE}' AS at_source",
    f"CASE WHEN origin = '{LATE}' AND l_returnflag = 'R' THEN 2 ELSE 1 END AS copies",
    f"""proc_date <> DATE'{MISSING_AT_SOURCE}'
          AND day(proc_date) <> {MISSING_IN_LAKE_DAY}
          AND (origin = '{DAILY}' OR l_returnflag = 'N' OR l_linestatus = 'F') AS in_lake""",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _partitions(spark: SparkSession) -> int | None:
    """Tasks that the lines are spread over, if the session asks for it."""
    asked = spark.conf.get(PARTITIONS, None)
    return int(asked) if asked else None


def feed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase line, with the flags the other views are made of."""
    lines = spread(_table(spark, sf_dir, "lineitem"), _partitions(spark), *LINE_KEYS)
    orders, part, supplier = (_table(spark, sf_dir, t) for t in ("orders", "part", "supplier"))
    return (
        lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(part, F.expr("l_partkey = p_partkey"))
        .join(supplier, F.expr("l_suppkey = s_suppkey"))
        .selectExpr("*", "CAST(l_shipdate AS DATE) AS shipped")
        .selectExpr(*LINE)
        .selectExpr(*FLAGS)
    )


def stored_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a written table, for runs that read it many times."""
    feed = feed_all(spark, sf_dir)
    path = scratch_path(spark, "feed")
    with freed_shuffles(spark):
        feed.write.parquet(path)
    return spark.read.schema(feed.schema).parquet(path)


def daily_source(feed: DataFrame) -> DataFrame:
    return feed.where(f"at_source AND origin = '{DAILY}'").select(*SOURCE_COLUMNS)


def late_source(feed: DataFrame) -> DataFrame:
    return (
        feed.where(f"at_source AND origin = '{LATE}'")
        .selectExpr(*SOURCE_COLUMNS, "explode(sequence(1, copies)) AS copy")
        .select(*SOURCE_COLUMNS)
    )


def totals(feed: DataFrame) -> DataFrame:
    """Announced counts, one row per date and origin, plus one date nobody has."""
    counted = (
        feed.where("at_source").groupBy("proc_date", "origin")
        .agg(F.sum("copies").alias("expected_rows"))
    )
    extra = feed.sparkSession.range(1).select(
        F.lit(MISSING_AT_SOURCE).alias("proc_date"),
        F.lit(ANNOUNCED_ROWS).cast("bigint").alias("expected_rows"),
    )
    return counted.select("proc_date", "expected_rows").unionByName(extra)


def lake(feed: DataFrame) -> DataFrame:
    """What earlier runs have stored."""
    return with_partition_columns(feed.where("in_lake").select(*COLUMNS), LAYOUT)


def all_rows(feed: DataFrame) -> DataFrame:
    """Every line of the feed as lake rows."""
    return with_partition_columns(feed.select(*COLUMNS), LAYOUT)
