"""The corpus pipeline: five stages over documents, each written and read again.

Every stage but the last takes and returns the columns of documents, whatever they are:

1. quality: documents that the ordinal regression gives less than even odds of the
   better grade go (learnt from the labels that are not held out);
2. near duplicates: of each class of near copies the document with the least id stays;
3. decontamination: documents that a benchmark item is found in go;
4. mixing: sources are brought to their target weights, so documents of a source above
   its weight are left out and those of one below it come twice, in slot order;
5. sharding: groups of equal texts go to shards of nearly equal bytes.

Stages 1 to 3 read nothing of a row but its text and id; null and empty texts, ties and
repeated rows have the results that the operators define, and an empty table passes
through every stage. A stage's intermediate tables are deleted once its result is written;
the results of the stages stay below the scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm import quality
from sedimenta.llm.common import passing_tables, staged, table
from sedimenta.llm.mixing import mixed_documents
from sedimenta.llm.near_join import keep_one
from sedimenta.llm.shards import shard
from sedimenta.llm.templates import drop_contaminated


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.select_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", sharded),
]

# Learnt models, MinHash and differencing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with passing_tables(spark) as keep:
            docs = keep(staged(stage(spark, docs, sf_dir), name))
    return docs
