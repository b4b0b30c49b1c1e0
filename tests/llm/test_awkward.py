"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import pytest

import corpus_pipeline
from sedimenta.llm import language, quality, toxicity
from sedimenta.llm.bbit import near_components
from sedimenta.llm.mixing import mix, mixed_documents, taken_words
from sedimenta.llm.naming import exact_groups
from sedimenta.llm.near_join import keep_one, near_join
from sedimenta.llm.rendering import render_pages
from sedimenta.llm.secrets import scan
from sedimenta.llm.shards import shard
from sedimenta.llm.templates import decontaminate, drop_contaminated
from tests.llm import fixtures

OPERATORS = {
    "mixing": lambda spark, docs: taken_words(mix(docs)),
    "secrets": lambda spark, docs: scan(docs),
    "near_join": lambda spark, docs: near_join(docs),
    "toxicity": lambda spark, docs: toxicity.score(docs, toxicity.learn(docs, fixtures.labels(spark))),
    "quality": lambda spark, docs: quality.grade(docs, quality.learn(docs, fixtures.labels(spark))),
    "bbit": lambda spark, docs: near_components(docs),
    "naming": lambda spark, docs: exact_groups(docs),
    "language": lambda spark, docs: language.identify(docs, language.learn(docs)),
    "shards": lambda spark, docs: shard(docs),
    "rendering": lambda spark, docs: render_pages(docs, "doc_id", "text"),
    "templates": lambda spark, docs: decontaminate(docs, fixtures.items(spark)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, name):
    docs = fixtures.awkward(spark)
    found = OPERATORS[name](spark, docs).collect()
    assert len(found) == docs.count()
    key = "doc_id"
    assert sorted(str(r[key]) for r in found) == sorted(str(r[0]) for r in fixtures.rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, fixtures.empty(spark)).collect() == []


STAGES = {
    "quality": lambda spark, docs: quality.select_good(docs, quality.learn(docs, fixtures.labels(spark))),
    "near_join": lambda spark, docs: keep_one(docs),
    "templates": lambda spark, docs: drop_contaminated(docs, fixtures.items(spark)),
    "mixing": lambda spark, docs: mixed_documents(docs),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(spark, name):
    docs = fixtures.awkward(spark)
    found = STAGES[name](spark, docs)
    assert found.schema.names == docs.schema.names
    given = {tuple(r) for r in docs.collect()}
    got = found.collect()
    assert got and {tuple(r) for r in got} <= given
    assert STAGES[name](spark, fixtures.empty(spark)).collect() == []


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_defined_results(spark):
    docs = fixtures.awkward(spark)
    by_id = {}
    for r in OPERATORS["language"](spark, docs).collect():
        by_id.setdefault(r["doc_id"], r)
    assert by_id[1]["lang_pred"] == by_id[2]["lang_pred"] == by_id[9]["lang_pred"] == "und"
    assert by_id[9]["score"] == 0.0
    named = [r for r in exact_groups(docs).collect() if r["doc_id"] == 6 and r["group_size"] == 4]
    assert len(named) == 3 and not any(r["kept"] for r in named) and named[0]["keep_id"] == 7
    blank = [r for r in exact_groups(docs).collect() if r["doc_id"] in (1, 2)]
    assert {(r["keep_id"], r["group_size"]) for r in blank} == {(2, 3)}
    sizes = {r["doc_id"]: r["size"] for r in shard(docs).collect() if r["doc_id"] in (1, 2, 11)}
    assert sizes == {1: 8, 2: 8, 11: 50_008}
    near = {r["doc_id"]: r for r in near_join(docs).collect()}
    assert near[4]["class_id"] == near[5]["class_id"] == 4 and near[5]["n_links"] == 1
    assert near[7]["class_id"] == 6 and near[7]["copies"] == 4 and near[7]["n_links"] == 0
