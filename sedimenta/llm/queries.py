"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sedimenta.llm import language, quality, toxicity
from sedimenta.llm.bbit import near_components
from sedimenta.llm.common import table
from sedimenta.llm.mixing import mix, taken_words
from sedimenta.llm.naming import exact_groups
from sedimenta.llm.near_join import near_join
from sedimenta.llm.oracles import ORACLES as ORACLES
from sedimenta.llm.rendering import render_pages
from sedimenta.llm.secrets import scan
from sedimenta.llm.shards import shard
from sedimenta.llm.templates import decontaminate
from sedimenta.llm.turns import structure_digest
from sedimenta.llm.whitening import whiten


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix(table(spark, sf_dir, "documents")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op3_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.grade(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_pages(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_digest(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_secret_scan,
        op3_near_join,
        op4_toxicity,
        op5_quality,
        op6_exact_dedup,
        op7_language_id,
        op8_shards,
        op9_html_text,
        op10_decontaminate,
        op11_whiten,
        op12_near_dedup,
        op13_turn_repair,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
