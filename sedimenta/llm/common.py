"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.session import scratch_path
from sedimenta.sinks.files import Store

# A join side is broadcast only if its counted rows stay below this many bytes.
BROADCAST_BYTES = 32 << 20

# The tables staged in the innermost open block of ``passing_tables``, by their folder.
_PASSING: ContextVar[dict[str, DataFrame | None] | None] = ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation,
    and values that depend on the order of a scan (row ids) are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    passing = _PASSING.get()
    if passing is not None:
        passing[path] = None
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    if passing is not None:
        passing[path] = made
    return made


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that are staged in this block when it ends, but for those it keeps.

    Yields a function that marks a staged table as kept. Nothing read after the block may
    depend on the other tables, so what leaves the block has to be staged and kept itself.
    What a block within a block keeps passes to the outer one.
    """
    made: dict[str, DataFrame | None] = {}
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    outer = _PASSING.get()
    token = _PASSING.set(made)
    try:
        yield keep
    finally:
        _PASSING.reset(token)
        for path, df in made.items():
            if not any(df is one for one in kept):
                # What cannot be deleted stays, and is for the owner of the scratch folder to expire.
                with suppress(Exception):
                    Store(spark, path).remove("")
            elif outer is not None:
                outer[path] = df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_join(left: DataFrame, right: DataFrame, on: str, how: str, row_bytes: int) -> DataFrame:
    """Join, broadcasting the right side only if its counted size is below the bound.

    Beyond the bound it is an ordinary shuffled join, whose heavy keys AQE splits.
    """
    if right.count() * row_bytes <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return left.join(right, on, how)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hand rows to Python in batches of at most ``rows`` while jobs run in this block.

    For operators whose rows are long lists: a batch is held several times over, as
    Arrow data in the JVM and in Python and as the values made of it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of documents whose labels no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


ARROW = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<float>": pa.list_(pa.float32()),
    "array<long>": pa.list_(pa.int64()),
}


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    fields: Sequence[tuple[str, str]],
    start: Callable[[], Callable[[list[str | None]], Sequence[Sequence]]],
) -> DataFrame:
    """One row per row: the kept columns and what a Python function makes of the text.

    ``start`` is called once a task and gives a function from a list of texts to one
    list for each of ``fields``. The kept columns stay in Arrow, so nulls and long
    integers come through unchanged.
    """
    df = df.select(*keep, text)
    names = [*keep, *(name for name, _ in fields)]
    types = [ARROW[kind] for _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))),
                 *(x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(made, types))],
                names=names,
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[: len(keep)]]
    return df.mapInArrow(run, ", ".join([*kept, *(f"`{name}` {kind}" for name, kind in fields)]))
