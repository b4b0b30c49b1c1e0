import datetime as dt
import random

import pytest

from sedimenta.operators import merge as M
from sedimenta.plans.feed import COLUMNS, LAKE_SCHEMA
from sedimenta.purchases import LAYOUT
from sedimenta.sources.dates import make_date_set
from sedimenta.sources.lake import with_partition_columns
from tests.fixtures import frame, row, source

D1, D2, D3 = (dt.date(2001, 8, n) for n in (1, 2, 3))


def orders(df):
    return sorted(r.src_order for r in df.collect())


def plan(merge=(), load=()):
    return M.RepairPlan(make_date_set("proc_date", merge), make_date_set("proc_date", load))


def test_merge_drops_rows_already_stored(spark):
    lake = with_partition_columns(
        frame(spark, [row(src_order=1), row(src_order=2, origin="LATE")]), LAYOUT
    )
    late = source(spark, [row(src_order=2), row(src_order=3), row(src_order=3)])
    assert orders(M.merge_late_rows(lake, late)) == [1, 2, 3]


def test_merge_treats_nulls_as_equal(spark):
    lake = frame(spark, [row(brand=None, origin="LATE")])
    assert M.merge_late_rows(lake, source(spark, [row(brand=None)])).count() == 1


def test_merge_fills_missing_columns(spark):
    lake = frame(spark, [row(src_order=1)]).drop("brand")
    merged = M.merge_late_rows(lake, source(spark, [row(src_order=2, brand="B")]))
    assert {r.src_order: r.brand for r in merged.collect()} == {1: None, 2: "B"}


def test_initial_load_keeps_duplicates(spark):
    loaded = M.initial_load(source(spark, [row(), row()]), source(spark, [row()]))
    assert sorted(r.origin for r in loaded.collect()) == ["DAILY", "DAILY", "LATE"]


def test_repair_branches(spark):
    lake = with_partition_columns(frame(spark, [
        row(src_order=1, proc_date=D1), row(src_order=1, proc_date=D1),
        row(src_order=9, proc_date=D3),
    ]), LAYOUT)
    daily = source(spark, [
        row(src_order=5, proc_date=D1), row(src_order=2, proc_date=D2),
        row(src_order=2, proc_date=D2), row(src_order=8, proc_date=D3),
    ])
    late = source(spark, [row(src_order=3, proc_date=D1), row(src_order=2, proc_date=D2),
                          row(src_order=7, proc_date=D3)])
    fixed = M.repair(lake, daily, late, plan([D1], [D2, dt.date(2001, 8, 4)]))
    assert orders(fixed) == [1, 2, 2, 2, 3]
    assert {(r.proc_year, r.proc_month) for r in fixed.collect()} == {(2001, "08")}

    again = M.repair(lake, daily, late, plan([D1], [D2]), reread_daily=True)
    assert orders(again) == [1, 2, 2, 2, 3, 5]
    assert M.repair(lake, daily, late, plan()).count() == 0


def test_plan_repair_splits_by_lake_content(spark):
    report = spark.createDataFrame(
        [(D1, True, True), (D2, True, False), (D3, False, True)],
        "proc_date date, diverged boolean, has_lake boolean",
    )
    found = M.plan_repair(report)
    assert found.merge.dates == (D1,) and found.load.dates == (D2,)
    assert len(found.report) == 3 and found
    assert not M.plan_repair(report.where("proc_date = DATE'2001-08-03'"))


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_matches_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(n):
        # A third of the rows are copies of one row.
        rows = [row(src_order=rng.randrange(6), brand=rng.choice(["A", None]),
                    proc_date=rng.choice([D1, D2, D3])) for _ in range(n)]
        return rows + [row(src_order=1, brand="A", proc_date=D1)] * (n // 2)

    lake, daily, late = some(40), some(40), some(20)
    tagged = [r if rng.random() < 0.5 else {**r, "origin": "LATE"} for r in lake]

    def key(r):
        return tuple(str(r[c]) for c in COLUMNS)

    merged = {key(r) for r in tagged if r["proc_date"] == D1}
    merged |= {key({**r, "origin": "LATE"}) for r in late if r["proc_date"] == D1}
    loaded = [key({**r, "origin": "DAILY"}) for r in daily if r["proc_date"] == D2]
    loaded += [key({**r, "origin": "LATE"}) for r in late if r["proc_date"] == D2]

    fixed = M.repair(with_partition_columns(frame(spark, tagged), LAYOUT),
                     source(spark, daily), source(spark, late), plan([D1], [D2]))
    assert sorted(key(r.asDict()) for r in fixed.collect()) == sorted([*merged, *loaded])
    assert set(fixed.columns) == set(LAKE_SCHEMA.names)
