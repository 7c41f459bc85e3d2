"""The given test tables seen as event records, procedure records, entities and labelled rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_records(load(spark, sf_dir, "events"))


def as_event_records(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("entity_id"),
        F.col("ts").alias("event_ts"),
        F.when(kind == "error", "dropped").when(kind == "view", "missed")
         .when(kind == "purchase", "answered").alias("outcome"),
        F.when(kind == "click", "text").when(kind == "signup", "call").alias("channel"),
    )


def procedure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_procedure_records(load(spark, sf_dir, "events"))


def as_procedure_records(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("entity_id"),
        F.col("ts").alias("event_ts"),
        F.when(kind == "click", "11").when(kind == "view", "15")
         .when(kind == "purchase", "16").otherwise("99").alias("proc_code"),
        F.col("value").alias("duration"),
    )


def entity_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (load(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("entity_id"),
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("county"),
            F.col("r_name").alias("state"),
            F.col("c_acctbal").alias("lon"),
            F.col("c_nationkey").cast("double").alias("lat"),
        )
    )


def nested_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_dimension(spark, sf_dir).select(
        F.struct("entity_id", "city", "county", "state").alias("properties"),
        F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"),
    )


def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per labelled document: label, categoricals, one numeric, slice columns."""
    return (
        load(spark, sf_dir, "labels")
        .join(load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
        .select("doc_id", "quality", "toxic", "lang", "source", "n_chars")
    )


def fixed_score(key: Column) -> Column:
    """Repeatable stand-in for a model score in [0, 1]."""
    return (key * 37 % 101) / F.lit(100.0)


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = fixed_score(F.col("doc_id"))
    return labelled_rows(spark, sf_dir).select(
        "doc_id", F.col("quality").alias("label"), "lang", "toxic",
        score.alias("score"), (score >= 0.5).cast("int").alias("prediction"),
    )


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as training runs: one name per priority, one metric per run."""
    status = F.col("o_orderstatus")
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").alias("started"),
        F.when(status == "F", "FINISHED").when(status == "O", "RUNNING").otherwise("FAILED").alias("status"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice")).alias("metric"),
    )
