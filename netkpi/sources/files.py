"""Batch readers with declared schemas."""
from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from netkpi.functions.names import raw_name, rename_all

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Directory of JSON-lines files; no inference pass over the data."""
    return spark.read.schema(schema).option("timestampNTZFormat", TIME_FORMAT).json(path)


def read_nested_gzip(spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None) -> DataFrame:
    """Gzip JSON cannot be split: one task per file. Give `partitions` to spread what follows."""
    df = spark.read.schema(schema).json(path)
    return df.repartition(partitions) if partitions else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             clean: Callable[[str], str] = raw_name) -> DataFrame:
    """Headered CSV, names cleaned."""
    return rename_all(spark.read.schema(schema).option("header", True).csv(path), clean)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small hand-written frame, such as a list of entities to look at.

    Handed over as an Arrow table, so Spark knows its size when it plans a join.
    """
    shape = T.StructType.fromDDL(schema)
    columns = {name: list(values) for name, values in zip(shape.fieldNames(), zip(*rows))}
    return spark.createDataFrame(pa.table(columns)).to(shape)
