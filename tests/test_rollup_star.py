import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta import purchases as P
from sedimenta.functions.scalars import surrogate_key
from sedimenta.operators import star
from sedimenta.operators.rollup import monthly_rollup, representative, rolling_window
from sedimenta.plans.feed import LAKE_SCHEMA
from sedimenta.purchases import LAYOUT
from sedimenta.sinks.partitions import write_partitions
from sedimenta.sources.lake import read_lake, with_partition_columns
from sedimenta.specs import DimensionSpec, KeySpec
from tests.fixtures import expected_key, frame, plan_of, row

AS_OF = dt.date(2001, 8, 15)
RUN_TS = dt.datetime(2001, 8, 15, 3, 0)


def lake(spark, rows):
    return with_partition_columns(frame(spark, rows), LAYOUT)


def rollup(spark, rows, **options):
    return monthly_rollup(lake(spark, rows), as_of=AS_OF, **{"stamp": False, **options})


def test_window_edges(spark):
    rows = [row(src_order=1, issue_date=dt.date(1999, 8, 1)),
            row(src_order=2, issue_date=dt.date(1999, 7, 31)),
            row(src_order=3, issue_date=dt.date(2002, 1, 1))]
    kept = rolling_window(frame(spark, rows), "issue_date", AS_OF)
    assert sorted(r.src_order for r in kept.collect()) == [1, 3]


def test_sums_and_greatest_supplier(spark):
    rows = [row(supplier="Acme", quantity=0.5), row(supplier="Acme Ltd"), row(supplier=None)]
    (found,) = rollup(spark, rows).collect()
    assert found.supplier == "Acme Ltd"
    assert (found.amount, found.quantity) == (Decimal("31.5000"), 2.5)
    assert found.issue_month == dt.date(2001, 8, 1)


def test_padded_ids_are_grouped_raw(spark):
    found = rollup(spark, [row(supplier_tax_id="1"), row(supplier_tax_id="01")]).collect()
    assert [r.supplier_tax_id for r in found] == ["00000000000001"] * 2


def test_null_keys_form_a_group(spark):
    assert rollup(spark, [row(brand=None), row(brand=None), row()]).count() == 2


def test_year_of_processing_or_issue(spark):
    rows = [row(issue_month="200012", issue_date=dt.date(2000, 12, 30), proc_date=d)
            for d in (dt.date(2000, 12, 31), dt.date(2001, 1, 2))]
    assert sorted(r.proc_year for r in rollup(spark, rows).collect()) == [2000, 2001]
    (found,) = rollup(spark, rows, year_from="issue").collect()
    assert (found.proc_year, found.amount) == (2000, Decimal("21.0000"))
    with pytest.raises(ValueError):
        rollup(spark, rows, year_from="other")


def test_processing_date_can_prune_folders(spark, tmp_path):
    rows = [row(issue_date=d, proc_date=d) for d in (dt.date(1999, 7, 31), dt.date(1999, 8, 1))]
    path = str(tmp_path / "lake")
    write_partitions(lake(spark, rows), path, LAYOUT.columns)
    stored = read_lake(spark, path, LAKE_SCHEMA)
    plain = monthly_rollup(stored, as_of=AS_OF, stamp=False)
    pruned = monthly_rollup(stored, as_of=AS_OF, stamp=False, prune_by="proc_date")
    assert plain.collect() == pruned.collect()
    filters = next(x for x in plan_of(pruned).splitlines() if x.startswith("PartitionFilters"))
    assert "proc_date" in filters


def test_bad_month_text(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed"):
        rollup(spark, [row(issue_month="2001-08")]).collect()
    (found,) = rollup(spark, [row(issue_month="2001-08")], strict=False).collect()
    assert found.issue_month is None


def test_representative_matches_plain_maximum(spark):
    df = spark.createDataFrame(
        [("1", "b"), ("1", "a"), ("1", None), ("2", None), (None, "z")], "k string, v string"
    )
    assert {r.k: r.v for r in representative(df, ["k"], "v").collect()} == {
        "1": "b", "2": None, None: "z"
    }


def test_rollup_shuffles_once(spark):
    plan = plan_of(rollup(spark, [row()]))
    assert plan.count("+- Exchange (") == 1


def random_rows(seed):
    """Random lines; a third of them share one key and a third of those are copies."""
    rng = random.Random(seed)

    def one(**fixed):
        month = rng.choice([dt.date(2001, 7, 1), dt.date(2001, 8, 1), dt.date(1999, 7, 1)])
        values = dict(
            ean=rng.choice(["1", "2"]), product=rng.choice(["a", "a;", None]),
            brand=rng.choice(["B1", "B2", None]), subclass=rng.choice(["10", None]),
            supplier=rng.choice(["Acme", "Acme Ltd", "Zeta", None]),
            supplier_tax_id=rng.choice(["7", "07"]), issue_month=f"{month:%Y%m}",
            issue_date=month, proc_date=month + dt.timedelta(days=rng.choice([1, 200])),
            amount=Decimal(rng.randrange(1, 10**6)).scaleb(-4), quantity=rng.randrange(9) / 2,
        )
        return row(**{**values, **fixed})

    hot = dict(ean="1", product="a", brand="B1", subclass="10", supplier_tax_id="7",
               issue_month="200108", issue_date=dt.date(2001, 8, 1),
               proc_date=dt.date(2001, 8, 2))
    return [one() for _ in range(200)] + [one(**hot) for _ in range(70)] + [one(**hot)] * 30


@pytest.mark.parametrize("seed", [3, 4])
def test_rollup_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    groups = {}
    for r in rows:
        if r["issue_date"] < dt.date(1999, 8, 1):
            continue
        key = tuple({**r, "proc_year": r["proc_date"].year}[k] for k in P.ROLLUP.keys)
        groups.setdefault(key, []).append(r)
    expected = []
    for key, members in groups.items():
        shown = dict(zip(P.ROLLUP.keys, key))
        names = [m["supplier"] for m in members if m["supplier"] is not None]
        shown.update(
            issue_month=members[0]["issue_date"],
            supplier_tax_id=shown["supplier_tax_id"].zfill(14),
            supplier=max(names, default=None),
            amount=sum(m["amount"] for m in members),
            quantity=sum(m["quantity"] for m in members),
        )
        expected.append(tuple(shown[c] for c in P.ROLLUP.output))
    found = [tuple(r) for r in rollup(spark, rows).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("spec", P.DIMENSIONS, ids=lambda d: d.table)
def test_dimension_matches_brute_force(spark, spec):
    silver = rollup(spark, random_rows(5))
    seen = {}
    for r in silver.collect():
        raw = tuple(r[c] for c in spec.attributes)
        if raw[0] is not None:
            seen[raw] = max(seen.get(raw, dt.date.min), r.issue_month)
    strip = str.maketrans("", "", "\n\r;")
    expected = [
        (expected_key(raw), *(v and v.translate(strip) for v in raw), month)
        for raw, month in seen.items()
    ]
    found = [tuple(r) for r in star.build_dimension(silver, spec, stamp=False).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_fact_row_per_rollup_row(spark):
    silver = rollup(spark, [row(quantity=2.5), row(brand=None, quantity=1.5),
                            row(subclass=None)])
    fact = star.build_fact(silver, run_ts=RUN_TS, extra_keys=[P.SUPPLIER_KEY])
    assert fact.count() == 3
    assert plan_of(star.build_fact(silver)).count("Exchange (") == plan_of(silver).count("Exchange (")
    found = {(r.brand_id is None, r.quantity) for r in fact.collect()}
    # 2.5 -> 2 and 1.5 -> 2: halves go to the even neighbour.
    assert found == {(False, 2), (True, 2), (False, 1)}
    assert fact.schema["amount"].dataType.simpleString() == "decimal(15,4)"
    assert fact.columns[-1] == "updated_at"


def test_fact_keys_find_their_members(spark):
    silver = rollup(spark, [row(), row(brand=None), row(subclass=None), row(product="a;b"),
                            row(manufacturer=None)])
    fact = star.build_fact(silver, extra_keys=[P.SUPPLIER_KEY])
    members = star.member_keys(silver)
    names = [d.key.name for d in P.DIMENSIONS]
    assert {r.key_name: r.orphans for r in star.orphan_counts(fact, members, names).collect()} == {
        name: 0 for name in names
    }
    for d in P.DIMENSIONS:
        built = {r[0] for r in star.build_dimension(silver, d).select(d.key.name).collect()}
        assert built == {r.key for r in members.where(f"key_name = '{d.key.name}'").collect()}
    fewer = members.where("key_name <> 'brand_id'")
    assert {r.key_name: r.orphans
            for r in star.orphan_counts(fact, fewer, names).collect()}["brand_id"] == 1


def test_dimension_members(spark):
    silver = rollup(spark, [
        row(product="a;b"), row(product="ab"),
        row(product="a;b", issue_month="200107"), row(brand=None, manufacturer=None),
    ])
    product = star.build_dimension(silver, P.DIM_PRODUCT, stamp=False).collect()
    # Two raw spellings stay two members although they look the same.
    assert sorted(r.product for r in product) == ["ab", "ab", "red ring"]
    assert len({r.product_id for r in product}) == 3
    assert {r.issue_month for r in product} == {dt.date(2001, 8, 1)}
    brand = star.build_dimension(silver, P.DIM_BRAND, stamp=False)
    assert brand.columns == ["brand_id", "brand_name", "issue_month"]
    assert [r.brand_name for r in brand.collect()] == ["Brand#1"]


def test_two_suppliers_under_one_tax_id(spark):
    silver = rollup(spark, [row(supplier="A"), row(supplier="B", ean="2")])
    assert star.build_dimension(silver, P.DIM_SUPPLIER).count() == 2


def test_attributes_outside_the_key_are_grouped_clean(spark):
    spec = DimensionSpec("d", KeySpec("id", ("ean",)), ("ean", "product"), "issue_month")
    silver = rollup(spark, [row(product="a;b"), row(product="ab"), row(product="c")])
    found = star.build_dimension(silver, spec, stamp=False)
    expected = (
        silver.groupBy(surrogate_key("ean").alias("id"), "ean",
                       F.translate("product", ";", "").alias("product"))
        .agg(F.max("issue_month").alias("issue_month"))
    )
    assert sorted(found.collect()) == sorted(expected.select(found.columns).collect())


def test_dimensions_are_named_by_table(spark):
    found = star.build_dimensions(rollup(spark, [row()]), run_ts=RUN_TS)
    assert list(found) == [d.table for d in P.DIMENSIONS]
    assert all(df.first().updated_at == RUN_TS for df in found.values())


# One attribute shown beside its key, and one set of columns under two keys.
MORE = (
    DimensionSpec("d_shown", KeySpec("id", ("ean",)), ("ean", "product"), "issue_month"),
    DimensionSpec("d_turned", KeySpec("id", ("subclass", "product_group")), ("product_group", "subclass"), "issue_month"),
)


def test_all_members_give_every_dimension(spark):
    silver = rollup(spark, random_rows(9) + [row(brand=None, product="a;b"), row(product="ab"), row(subclass=None)])
    specs = [*P.DIMENSIONS, *MORE]
    members = star.all_members(silver, specs)
    for spec in specs:
        found = star.dimension_of(members, spec, specs, RUN_TS)
        alone = star.build_dimension(silver, spec, RUN_TS)
        assert found.columns == alone.columns and found.count() > 0
        assert sorted(found.collect(), key=repr) == sorted(alone.collect(), key=repr)


def test_all_members_scan_silver_once(spark, tmp_path):
    rollup(spark, [row()]).write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    plan = plan_of(star.all_members(silver))
    tree = plan[:plan.index("\n\n\n")]
    assert tree.count("Scan parquet") == 1 and tree.count("Expand") == 1 and tree.count("Exchange") == 1
    assert "store_tax_id" not in plan and "amount" not in plan
    # Every hash stays above the aggregate: one per member, not one per row.
    assert "md5" not in plan[plan.index("Expand", len(tree)):plan.index("Exchange", len(tree))]


def test_row_ids_are_unique(spark):
    df = star.with_row_ids(spark.range(1000).repartition(7).withColumnRenamed("id", "x"))
    assert df.select("fact_id").distinct().count() == 1000
