"""What the jobs of the operators are made of."""

import re

import pytest

from sedimenta.llm import bbit, common, mixing, naming, near_join, shards, templates, turns, whitening
from tests.fixtures import plan_of
from tests.llm import fixtures


@pytest.fixture
def plans(monkeypatch):
    """The plan of every job that an operator writes a table with."""
    seen = []

    def staged(df, name):
        seen.append(plan_of(df))
        return common.staged(df, name)

    for module in (bbit, mixing, naming, near_join, shards, templates, turns, whitening):
        monkeypatch.setattr(module, "staged", staged)
    return seen


def texts():
    return [fixtures.sentence(i % 60, 40) for i in range(150)] + ["the same text for many"] * 150


PYTHON = re.compile("EvalPython|InPandas|InArrow|PythonUDF")


def test_mixing_and_naming_are_native(spark, plans):
    docs = fixtures.plain(spark, texts())
    for result in (mixing.taken_words(mixing.mix(docs)), naming.exact_groups(docs), mixing.mixed_documents(docs)):
        plans.append(plan_of(result))
    assert len(plans) > 8
    assert not any(PYTHON.search(p) for p in plans)


def test_no_cross_joins(spark, plans):
    docs, items = fixtures.plain(spark, texts()), fixtures.items(spark)
    for result in (mixing.taken_words(mixing.mix(docs)), naming.exact_groups(docs), near_join.near_join(docs),
                   bbit.near_components(docs), shards.shard(docs), templates.decontaminate(docs, items)):
        plans.append(plan_of(result))
    assert not any("CartesianProduct" in p or "BroadcastNestedLoopJoin" in p for p in plans)


def test_hot_blocks_are_joined_by_broadcast(spark, plans):
    docs = fixtures.plain(spark, [f"text {i}" for i in range(2500)] + ["copy"] * 500)
    rows = naming.exact_groups(docs).collect()
    assert sorted(r["group_size"] for r in rows)[-500:] == [500] * 500
    assert sum(r["kept"] for r in rows) == 2501
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[0]


def test_scratch_is_the_shared_folder(spark):
    df = common.staged(spark.range(3), "x")
    assert df.inputFiles()[0].split(":")[-1].lstrip("/").startswith(spark.conf.get("spark.checkpoint.dir").lstrip("/"))


def test_small_join_has_another_way(spark, monkeypatch):
    left, right = spark.range(10), spark.range(5)
    assert "Broadcast" in plan_of(common.small_join(left, right, "id", "inner", 8))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 8)
    assert sorted(r[0] for r in common.small_join(left, right, "id", "left_anti", 8).collect()) == [5, 6, 7, 8, 9]
