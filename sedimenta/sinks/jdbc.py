"""Writing to a reporting database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def column_types(columns: Sequence[tuple[str, str]]) -> str:
    """Declared column types in the form of the ``createTableColumnTypes`` option."""
    return ", ".join(f"{name} {kind.upper()}" for name, kind in columns)


def write_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[tuple[str, str]],
               options: Mapping[str, str] | None = None, writers: int = 16,
               mode: str = "overwrite") -> None:
    """Create the table with declared types and load it from the executors.

    ``writers`` bounds the number of connections the database has to serve.
    """
    known = set(df.columns)
    declared = [(name, kind) for name, kind in columns if name in known]
    (
        df.write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("createTableColumnTypes", column_types(declared))
        .option("numPartitions", str(writers))
        .option("batchsize", "10000")
        .options(**dict(options or {}))
        .save()
    )


def register_jdbc_catalog(spark: SparkSession, name: str, url: str,
                          options: Mapping[str, str] | None = None) -> None:
    """Make a database available as catalog ``name`` for ``publish`` and SQL."""
    spark.conf.set(f"spark.sql.catalog.{name}", JDBC_CATALOG)
    spark.conf.set(f"spark.sql.catalog.{name}.url", url)
    for key, value in dict(options or {}).items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key}", value)
