"""What operators and the pipeline leave in the scratch folder."""

import os
from urllib.parse import urlparse

import pytest

import corpus_pipeline
from sedimenta.llm.common import passing_tables, staged
from sedimenta.llm.mixing import mixed_documents
from sedimenta.llm.near_join import keep_one
from tests.llm import fixtures


@pytest.fixture
def left(spark):
    """The names of the tables that have come to the scratch folder since the test began."""
    folder = urlparse(spark.conf.get("spark.checkpoint.dir")).path

    def names():
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = names()
    return lambda: sorted(name.rsplit("-", 1)[0] for name in names() - before)


def texts():
    return [fixtures.sentence(i % 60, 40) for i in range(150)] + [fixtures.sentence(7, 40) + " tail", None, ""]


def test_near_copies_leave_only_what_the_result_reads(spark, left):
    kept = keep_one(fixtures.plain(spark, texts()))
    assert left() == ["near-docs", "near-kept"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(60), 151]


def test_mix_leaves_only_what_the_result_reads(spark, left):
    docs = fixtures.plain(spark, texts())
    mixed = mixed_documents(docs, block_words=64)
    assert left() == ["mix-docs", "mix-taken"]
    assert mixed.count() > 150 and {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in docs.collect()}


def test_pipeline_leaves_one_table_a_stage(spark, left, tmp_path):
    fixtures.awkward(spark).write.parquet(str(tmp_path / "documents.parquet"))
    fixtures.labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    fixtures.items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and left() == sorted(name for name, _ in corpus_pipeline.STAGES)


def test_kept_tables_pass_to_the_outer_block(spark, left):
    with passing_tables(spark) as keep:
        with passing_tables(spark) as keep_inner:
            staged(spark.range(3), "gone")
            inner = keep_inner(staged(spark.range(4), "inner"))
        assert left() == ["inner"]
        outer = keep(staged(inner.selectExpr("id + 1 AS id"), "outer"))
    assert left() == ["outer"] and sorted(r[0] for r in outer.collect()) == [1, 2, 3, 4]


def test_a_block_that_fails_leaves_nothing(spark, left):
    with pytest.raises(ZeroDivisionError):
        with passing_tables(spark):
            staged(spark.range(3), "gone")
            raise ZeroDivisionError
    assert left() == []
