"""Sparse rows and mini-batch descent for the models that are fitted on a sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import held_out

# A model learns from at most this many rows, and from none longer than MAX_BYTES.
SAMPLE_ROWS = 12_000
MAX_BYTES = 32_768


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """(label, text) of at most ``rows`` rows that are not held out, the same every time.

    A document with several labels has the largest, an id with several rows the text
    that sorts last; rows are taken in the order of a hash of the id.
    """
    one = labels.filter(F.col(label_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(id_col).agg(
        F.max(label_col).alias("label"))
    chosen = one.orderBy(F.xxhash64(F.col(id_col)), id_col).limit(rows)
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(
        F.octet_length("text") <= max_bytes)
    # At most ``rows`` pairs of numbers.
    found = texts.join(F.broadcast(chosen), id_col).groupBy(id_col, "label").agg(F.max("text").alias("text"))
    return found.select("label", "text", F.xxhash64(id_col).alias("order"))


def collected(sample: DataFrame, *lists: str) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Labels, and the arrays of each list column, of a bounded sample in its order."""
    table = sample.toArrow().combine_chunks()
    order = np.argsort(table.column("order").to_numpy(), kind="stable")
    found = []
    for name in lists:
        column = table.column(name)
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
        found.append([flat[ends[i]: ends[i + 1]] for i in order])
    return table.column("label").to_numpy()[order], found


@dataclass
class Rows:
    """Rows of (feature, value) pairs, one after the other."""

    ends: np.ndarray
    features: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) triples of the chosen rows, rows numbered anew."""
        sizes = self.ends[at + 1] - self.ends[at]
        row = np.repeat(np.arange(len(at)), sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.ends[at], sizes)
        return row, self.features[place], self.values[place]

    def part(self, at: np.ndarray) -> Rows:
        """The chosen rows."""
        _, feature, value = self.take(at)
        return Rows(np.concatenate([[0], np.cumsum(self.ends[at + 1] - self.ends[at])]), feature, value)

    def only(self, keep: np.ndarray) -> Rows:
        """The features for which ``keep`` is true, numbered anew."""
        ok = keep[self.features]
        row = np.repeat(np.arange(len(self)), np.diff(self.ends))[ok]
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self)))])
        return Rows(ends, (np.cumsum(keep) - 1)[self.features[ok]], self.values[ok])


def gather(features: list[np.ndarray], values: list[np.ndarray], least_rows: int) -> tuple[Rows, np.ndarray]:
    """Number the features that occur in at least ``least_rows`` rows; drop the others."""
    sizes = np.array([len(f) for f in features], dtype=np.int64)
    flat = np.concatenate(features) if len(features) else np.zeros(0, dtype=np.int64)
    weight = np.concatenate(values) if len(values) else np.zeros(0)
    known, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    keep = count >= least_rows
    return Rows(ends, at, weight).only(keep), known[keep]


class AdaGrad:
    def __init__(self, shape, rate: float):
        self.seen = np.full(shape, 1e-8)
        self.rate = rate

    def step(self, value: np.ndarray, slope: np.ndarray) -> None:
        self.seen += slope * slope
        value -= self.rate * slope / np.sqrt(self.seen)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
