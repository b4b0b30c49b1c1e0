"""Fact and dimensions derived from the monthly rollup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.scalars import cast_as, clean_text, run_stamp, surrogate_key
from sedimenta.operators.numbering import dense_ids
from sedimenta.purchases import DIMENSIONS, FACT
from sedimenta.specs import DimensionSpec, FactSpec, KeySpec

# Column of the members of several dimensions that says which grouping set a row is of.
MEMBER_SET = "member_set"


def fact_key(key: KeySpec):
    """Surrogate key, NULL when its leading part is: dimensions have no such member."""
    return F.when(F.col(key.columns[0]).isNotNull(), surrogate_key(*key.columns))


def build_fact(silver: DataFrame, spec: FactSpec = FACT, run_ts=None, stamp: bool = True,
               extra_keys: Iterable[KeySpec] = ()) -> DataFrame:
    """One fact row per rollup row: surrogate keys and declared types. No shuffle.

    ``extra_keys`` adds keys the fact does not carry by default, such as the
    supplier member.
    """
    types = {f.name: f.dataType for f in silver.schema.fields}
    columns = [fact_key(k).alias(k.name) for k in (*spec.keys, *extra_keys)]
    for c in spec.columns:
        target = "string" if c.type.startswith("varchar") else c.type
        columns.append(cast_as(c.source, types[c.source], target).alias(c.name))
    if stamp:
        columns.append(run_stamp(run_ts).alias(spec.stamp))
    return silver.select(*columns)


def with_row_ids(df: DataFrame, name: str = FACT.row_id) -> DataFrame:
    """Row ids from 1 without gaps, in the order of the partitions. No shuffle of rows."""
    return dense_ids(df, name).select(name, *df.columns)


def build_dimension(silver: DataFrame, spec: DimensionSpec, run_ts=None,
                    stamp: bool = True) -> DataFrame:
    """Distinct members, cleaned attributes and the last month each was seen.

    The key is made of raw text and attributes are shown cleaned. Key columns are
    grouped raw, so hashing and cleaning run once per member instead of once per
    row, and the partial aggregate folds a heavy member before the shuffle.
    """
    members = (
        silver.where(F.col(spec.key.columns[0]).isNotNull())
        .groupBy(*[part.alias(name) for name, part in _parts(spec).items()])
        .agg(F.max(spec.month).alias(f"month_{spec.month}"))
    )
    return _shown(members, spec, _member_key(spec), run_ts, stamp)


def build_dimensions(silver: DataFrame, specs: Iterable[DimensionSpec] = DIMENSIONS,
                     run_ts=None) -> dict[str, DataFrame]:
    """Every dimension, lazily. Each one scans only its own few columns."""
    return {s.table: build_dimension(silver, s, run_ts) for s in specs}


def all_members(silver: DataFrame, specs: Sequence[DimensionSpec] = DIMENSIONS) -> DataFrame:
    """Members of every dimension from one pass over silver: one expand, one aggregate.

    A grouping set per dimension. ``member_set`` says which one a row is of; ``dimension_of``
    takes the rows of one dimension. Members are hashed here, once.
    """
    parts = {name: part for s in specs for name, part in _parts(s).items()}
    months = dict.fromkeys(s.month for s in specs)
    sets = {_set_number(s, list(parts)): list(_parts(s)) for s in specs}
    members = (
        silver.select(*[part.alias(name) for name, part in parts.items()],
                      *[F.col(m).alias(f"month_{m}") for m in months])
        .groupingSets(list(sets.values()), *parts)
        .agg(F.grouping_id().alias(MEMBER_SET), *[F.max(f"month_{m}").alias(f"month_{m}") for m in months])
    )
    keys = [F.when(F.col(MEMBER_SET) == _set_number(s, list(parts)), _member_key(s)).alias(f"key_{s.table}")
            for s in specs]
    return members.select("*", *keys)


def dimension_of(members: DataFrame, spec: DimensionSpec, specs: Sequence[DimensionSpec] = DIMENSIONS,
                 run_ts=None, stamp: bool = True) -> DataFrame:
    """The rows that ``build_dimension`` gives, from the members of all ``specs``."""
    parts = list(dict.fromkeys(name for s in specs for name in _parts(s)))
    own = members.where((F.col(MEMBER_SET) == _set_number(spec, parts)) & F.col(f"raw_{spec.key.columns[0]}").isNotNull())
    return _shown(own, spec, F.col(f"key_{spec.table}"), run_ts, stamp)


def _parts(spec: DimensionSpec) -> dict[str, Column]:
    """What a dimension is grouped by: its key's columns raw, other attributes cleaned."""
    raw = {f"raw_{c}": F.col(c) for c in spec.key.columns}
    others = [a for a in spec.attributes if a not in spec.key.columns]
    return {**raw, **{f"shown_{a}": clean_text(a) for a in others}}


def _set_number(spec: DimensionSpec, parts: Sequence[str]) -> int:
    """The grouping id of a dimension's set: a bit per part, set where the part is left out."""
    own = _parts(spec)
    return sum(1 << (len(parts) - 1 - at) for at, name in enumerate(parts) if name not in own)


def _member_key(spec: DimensionSpec) -> Column:
    return surrogate_key(*[f"raw_{c}" for c in spec.key.columns])


def _shown(members: DataFrame, spec: DimensionSpec, key: Column, run_ts, stamp: bool) -> DataFrame:
    columns = [key.alias(spec.key.name)]
    columns += [
        (clean_text(f"raw_{a}") if a in spec.key.columns else F.col(f"shown_{a}")).alias(a)
        for a in spec.attributes
    ]
    columns.append(F.col(f"month_{spec.month}").alias(spec.month))
    if stamp:
        columns.append(run_stamp(run_ts).alias(spec.stamp))
    return members.select(*columns).withColumnsRenamed(spec.renames)


def member_keys(silver: DataFrame, specs: Iterable[DimensionSpec] = DIMENSIONS) -> DataFrame:
    """(key_name, key) of every member of every dimension, in one pass over silver."""
    return _keys(silver, [(s.key.name, fact_key(s.key)) for s in specs])


def orphan_counts(fact: DataFrame, members: DataFrame, names: Iterable[str]) -> DataFrame:
    """Per key, the number of distinct fact keys without a dimension member.

    Each side is read once: its keys become rows of (name, key), which the partial
    aggregate folds, and one anti-join compares all keys at a time.
    """
    names = list(names)
    used = _keys(fact, [(name, F.col(name)) for name in names])
    orphans = used.join(members, ["key_name", "key"], "left_anti").groupBy("key_name").count()
    listed = fact.sparkSession.createDataFrame([(n,) for n in names], "key_name string")
    return listed.join(orphans, "key_name", "left").select(
        "key_name", F.coalesce("count", F.lit(0)).alias("orphans")
    )


def _keys(df: DataFrame, keys: list[tuple[str, Column]]) -> DataFrame:
    pairs = [F.struct(F.lit(name).alias("key_name"), key.alias("key")) for name, key in keys]
    return df.select(F.explode(F.array(*pairs)).alias("k")).select("k.*").where("key IS NOT NULL").distinct()
