"""Scalar expressions. All of them are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAX_ID_WIDTH = 14

# Characters removed from dimension attributes: the record and field
# delimiters of the delimited export.
DELIMITERS = "\n\r;"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(yyyymm: Column | str, strict: bool = True) -> Column:
    """First day of the month named by ``yyyyMM`` text.

    Bad text is an error, or NULL with ``strict=False``.
    """
    parse = F.to_date if strict else F.try_to_date
    return parse(_col(yyyymm), "yyyyMM")


def pad_id(c: Column | str, width: int = TAX_ID_WIDTH) -> Column:
    """Text of ``c`` left-padded with zeros; longer text is cut to ``width``."""
    return F.lpad(_col(c).cast("string"), width, "0")


def clean_text(c: Column | str) -> Column:
    """Text of ``c`` without line breaks and field delimiters."""
    return F.translate(_col(c).cast("string"), DELIMITERS, "")


def round_to_int(c: Column | str, source: T.DataType, target: str = "int") -> Column:
    """Integer cast that rounds instead of truncating.

    Binary fractions round half to even, decimals half away from zero. A value
    outside the target range is an error under ANSI mode.
    """
    c = _col(c)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        c = F.rint(c)
    elif isinstance(source, T.DecimalType):
        c = F.round(c, 0)
    return c.cast(target)


def cast_as(c: Column | str, source: T.DataType, target: str) -> Column:
    """Cast to a declared type; fractions going to an integer type are rounded."""
    if target in ("int", "integer", "bigint", "long"):
        return round_to_int(c, source, target)
    return _col(c).cast(target)


def _framed(c: Column | str) -> Column:
    text = _col(c).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def surrogate_key(*parts: Column | str) -> Column:
    """Stable text key of a tuple of values.

    Each part is framed by its length, and NULL is a lone dash, so different
    tuples never share a key text: ('ab','c'), ('a','bc'), ('a',NULL) and
    ('a','') all differ. The key is the md5 of that text in hexadecimal.
    """
    return F.md5(F.concat(*[_framed(p) for p in parts]))


def window_start(as_of: Column, months: int) -> Column:
    """First day of the month ``months`` before the month of ``as_of``."""
    return F.add_months(F.trunc(as_of, "MM"), -months)


def date_value(as_of) -> Column:
    """``as_of`` as a date column; None means the current date of the session."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def run_stamp(run_ts) -> Column:
    """Audit timestamp column; None means the time of the run."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
