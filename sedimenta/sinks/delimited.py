"""Headerless delimited export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sedimenta.sources.delimited import DIALECT


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**DIALECT).csv(path)
