"""Headerless delimited files with a declared column list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# One dialect for both directions: quotes are doubled, blanks are kept, NULL is
# an empty field and the empty string a quoted one.
DIALECT = {
    "sep": ";",
    "header": "false",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# What the parser hands over for an empty unquoted field. It only has to differ
# from every stored text, the quoted empty string above all.
NULL_FIELD = "\x01null\x01"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    multiline: bool = False,
) -> DataFrame:
    """Read what ``write_delimited`` wrote; a row that does not parse is an error.

    ``multiline`` admits line breaks inside values, at the price of files that
    cannot be split. Attributes cleaned with ``clean_text`` do not need it.
    """
    options = {
        **DIALECT,
        "nullValue": NULL_FIELD,
        "emptyValue": "",
        "mode": "FAILFAST",
        "multiLine": str(multiline),
    }
    return spark.read.schema(schema).options(**options).csv(path)
