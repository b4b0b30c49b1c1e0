"""Declarative descriptions that configure the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LakeLayout:
    """Hive-style partition columns of the lake, outermost first.

    The month is two-digit text. It must be read as text: an inferred integer
    would be written back as ``month=2`` next to ``month=02``.
    """

    date: str = "proc_date"
    year: str = "proc_year"
    month: str = "proc_month"

    @property
    def columns(self) -> tuple[str, str, str]:
        return (self.year, self.month, self.date)


@dataclass(frozen=True)
class RollupSpec:
    """Monthly aggregation over a rolling window.

    ``keys`` are grouped on raw values. ``month_key`` is a ``yyyyMM`` key emitted
    as a date and ``padded`` keys are emitted padded; both happen after grouping.
    """

    keys: tuple[str, ...]
    month_key: str
    year_key: str
    event_date: str
    sums: tuple[str, ...]
    representatives: tuple[str, ...] = ()
    padded: tuple[str, ...] = ()
    output: tuple[str, ...] = ()
    window_months: int = 24
    stamp: str = "updated_at"


@dataclass(frozen=True)
class KeySpec:
    """A surrogate key column and the columns it is made of."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ColumnSpec:
    """An output column, where it comes from and its declared type."""

    name: str
    source: str
    type: str


@dataclass(frozen=True)
class FactSpec:
    """A fact: surrogate keys, typed columns, measures totalled on load, lookup columns."""

    table: str
    keys: tuple[KeySpec, ...]
    columns: tuple[ColumnSpec, ...]
    month: str
    totals: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()
    row_id: str = "fact_id"
    key_type: str = "varchar(50)"
    stamp: str = "updated_at"

    def ddl(self) -> list[tuple[str, str]]:
        return (
            [(self.row_id, "bigint")]
            + [(k.name, self.key_type) for k in self.keys]
            + [(c.name, c.type) for c in self.columns]
            + [(self.stamp, "timestamp")]
        )


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension: source columns, the columns its key is made of, renames, lookup columns."""

    table: str
    key: KeySpec
    attributes: tuple[str, ...]
    month: str
    renames: dict[str, str] = field(default_factory=dict)
    key_type: str = "varchar(50)"
    attribute_type: str = "varchar(255)"
    stamp: str = "updated_at"
    lookups: tuple[str, ...] = ()

    def output_name(self, attribute: str) -> str:
        return self.renames.get(attribute, attribute)

    def ddl(self) -> list[tuple[str, str]]:
        return (
            [(self.key.name, self.key_type)]
            + [(self.output_name(a), self.attribute_type) for a in self.attributes]
            + [(self.month, "date"), (self.stamp, "timestamp")]
        )

    def lookup_columns(self) -> tuple[str, ...]:
        """Columns that readers look members up by: the key first, then ``lookups`` or the first attribute."""
        return (self.key.name, *(self.output_name(a) for a in self.lookups or self.attributes[:1]))
