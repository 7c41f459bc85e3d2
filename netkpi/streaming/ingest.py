"""File streams, rules and enrichment on a stream."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from netkpi.functions.scalar import utc_instant
from netkpi.operators.enrich import enrich_facts
from netkpi.operators.quality import drop_violations
from netkpi.sources.files import TIME_FORMAT


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files: int | None = None, only: str | None = None) -> DataFrame:
    """New files of a folder as they appear. `only` is a file-name pattern.

    The schema is declared; a column added to the files later is picked up by declaring it,
    older files then read as NULL.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("timestampNTZFormat", TIME_FORMAT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.load(path)


def with_event_time(stream: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Event time as an instant; a watermark on a wall-clock column is refused by Spark."""
    return stream.withColumn(ts, utc_instant(ts))


def silver_stream(stream: DataFrame, dim: DataFrame, rules: Mapping[str, Column], salts: int = 16) -> DataFrame:
    """Rows that keep all rules, joined to the static dimension.

    A measured small dimension is broadcast. Beyond that the join is salted, because a hot key of a
    micro-batch is not split by AQE.
    """
    return enrich_facts(drop_violations(stream, rules), dim, salts=salts)


def unique_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key; a key is remembered until the watermark passes it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
