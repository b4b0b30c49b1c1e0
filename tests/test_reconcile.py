import datetime as dt
import random
from collections import Counter

from sedimenta.operators import reconcile as R
from sedimenta.sources.dates import DateSet, date_set
from tests.fixtures import TOTALS_SCHEMA, plan_of

AS_OF = dt.date(2001, 8, 15)


def day(n):
    return dt.date(2001, 8, n)


def dates(spark, days):
    return spark.createDataFrame([(d,) for d in days], "proc_date date")


def test_date_spine_leaves_today_out(spark):
    found = sorted(r[0] for r in R.date_spine(spark, AS_OF).collect())
    assert found == [day(n) for n in range(8, 15)]


def test_expected_counts_sum_and_null(spark):
    totals = spark.createDataFrame(
        [(day(8), 3), (day(8), 4), (day(9), None)], TOTALS_SCHEMA
    )
    assert {r[0]: r[1] for r in R.expected_counts(totals).collect()} == {day(8): 7, day(9): 0}


def test_recent_report_cases(spark):
    lake = dates(spark, [day(14)] * 2 + [day(13)] + [day(1)])
    totals = spark.createDataFrame([(day(14), 2), (day(13), 3), (day(12), 5)], TOTALS_SCHEMA)
    report = R.reconcile_recent(lake, totals, AS_OF).collect()
    assert [r.proc_date for r in report] == [day(n) for n in range(14, 7, -1)]
    found = {r.proc_date.day: tuple(r)[1:] for r in report}
    assert found[14] == (2, 2, False, True)
    assert found[13] == (3, 1, True, True)
    assert found[12] == (5, 0, True, False)
    assert found[11] == (0, 0, False, False)


def test_flagged_report_skips_recent_and_null(spark):
    late = dates(spark, [day(14), day(2), day(2), None])
    report = R.reconcile_flagged(
        dates(spark, [day(2)]), late, spark.createDataFrame([(day(2), 2)], TOTALS_SCHEMA), AS_OF
    ).collect()
    assert [tuple(r) for r in report] == [(day(2), 2, 1, True, True)]


def test_report_matches_brute_force(spark):
    rng = random.Random(7)
    pool = [dt.date(2001, 7, 20) + dt.timedelta(days=n) for n in range(30)]
    # One date holds a third of the lake.
    lake = [rng.choice(pool) for _ in range(400)] + [pool[5]] * 200
    late = [rng.choice(pool[:10]) for _ in range(20)] + [None]
    totals = [(rng.choice(pool), rng.randrange(1, 30)) for _ in range(40)]

    recent = {AS_OF - dt.timedelta(days=n) for n in range(1, 8)}
    stored, announced = Counter(lake), Counter()
    for d, n in totals:
        announced[d] += n
    expected = {}
    for d in recent | {d for d in late if d}:
        e, a = announced[d], stored[d]
        expected[d] = ("recent" if d in recent else "flagged", e, a, e != a, a > 0)

    frames = (dates(spark, lake), dates(spark, late), spark.createDataFrame(totals, TOTALS_SCHEMA))
    plain = R.reconcile(*frames, AS_OF)
    pruned = R.reconcile(*frames, AS_OF, candidates=date_set(
        R.candidate_dates(frames[1], AS_OF), "proc_date"))
    for report in (plain, pruned):
        assert {r.proc_date: tuple(r)[1:] for r in report.collect()} == expected


def test_date_set_restricts(spark):
    df = dates(spark, [day(1), day(2), day(2), day(3)])
    chosen = DateSet("proc_date", (day(2), day(3)))
    assert "Join" not in plan_of(chosen.restrict(df))
    assert sorted(r[0].day for r in chosen.restrict(df).collect()) == [2, 2, 3]
    assert DateSet("proc_date", ()).restrict(df).count() == 0


def test_counts_are_reduced_before_the_join(spark):
    lake = dates(spark, [day(14)])
    totals = spark.createDataFrame([(day(14), 2)], TOTALS_SCHEMA)
    plan = R.reconcile_recent(lake, totals, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    join, aggregate = plan.index("Join"), plan.index("Aggregate")
    assert join < aggregate
