"""Reading the partitioned Parquet lake."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.specs import LakeLayout


def lake_schema(rows: T.StructType, layout: LakeLayout) -> T.StructType:
    """Schema of lake files holding ``rows``: the partition columns go last."""
    body = [f for f in rows.fields if f.name not in layout.columns]
    return T.StructType(
        body
        + [
            T.StructField(layout.year, T.IntegerType()),
            T.StructField(layout.month, T.StringType()),
            T.StructField(layout.date, T.DateType()),
        ]
    )


def read_lake(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All rows below ``path``, recursively, with hive partition columns.

    The schema is always declared, partition columns included, so no file is
    opened to infer it and two-digit month text stays text. A lake that does not
    exist yet is an empty one; any other failure is raised. Filters on the
    partition columns prune folders, other filters and the column list reach the
    Parquet reader.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_partition_columns(df: DataFrame, layout: LakeLayout) -> DataFrame:
    """Derive the year and two-digit month folders from the processing date."""
    date = F.col(layout.date)
    return df.withColumns(
        {layout.year: F.year(date), layout.month: F.date_format(date, "MM")}
    )


def without_partition_columns(df: DataFrame, layout: LakeLayout) -> DataFrame:
    """Drop the derived folders; the processing date itself stays."""
    return df.drop(layout.year, layout.month)
