"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again for the next.

All stages but the last return the columns of `documents`; rows that repeat a doc_id (after mixing: copies) are the same
document. Documents without an id are kept by the near-duplicate stage, as no other row can stand for them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netkpi.llm import decontaminate, mixing, quality, sharding, simhash
from netkpi.llm.shared import attach, table
from netkpi.sources.tables import materialize

#: Documents below this score are rejected.
LEAST_QUALITY = 0.3
SHARDS = 16


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    own = ["text" if c == "text" else f"_c{i}" for i, c in enumerate(docs.columns)]  # a column of the score's name stays as it is
    return quality.scored(docs.toDF(*own), model, LEAST_QUALITY).select(*own).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays.

    Links are those of op2 (three-word shingles, at most two bits), so most pairs of five-word similarity 0.8 or more stay.
    """
    found = simhash.near_duplicates(docs)
    gone = materialize(found.filter("doc_id <> component_id").select("doc_id").distinct(), "near-duplicates")
    return attach(docs, gone, "doc_id", None, 0, "left_anti").select(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.copied(docs, mixing.mix_plan(mixing.word_counts(docs)))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs, SHARDS)


STAGES = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Fitted models and fingerprints are not SQL; tests/llm/test_pipeline.py holds each stage's rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
