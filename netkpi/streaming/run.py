"""Sinks, triggered runs and control of running streams."""
from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from netkpi.functions.scalar import utc_instant
from netkpi.sources.versions import VersionedTable


def start_files(stream: DataFrame, path: str, checkpoint: str, name: str | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet folder, exactly once. Restarted with the same checkpoint it goes on
    where it stopped."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def start_table(stream: DataFrame, table: str, path: str, checkpoint: str, name: str | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Append to a catalog table."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
    )
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(table)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything that is there, stop, and read the result. Windows the watermark has not
    passed stay open in the state and are not in it."""
    start_files(stream, path, checkpoint).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


#: Seconds that a partition of a stored level covers.
LEVEL_PART = 86400


def drain_levels(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str = "datetime") -> DataFrame:
    """Process everything that is there and read the whole level, open windows included.

    The level is a table of versions with a partition per day of `ts`. Each trigger's changed windows take the place of
    those with the same keys in the days they touch, in a new version that also names the batch, so a repeated batch changes
    nothing. Reads see one version; two are kept, for whoever still reads the older one. A later run with the same
    checkpoint goes on where this one stopped.
    """
    table = VersionedTable(stream.sparkSession, path)
    day = F.floor((F.unix_seconds(ts) if dict(stream.dtypes)[ts] == "timestamp" else F.unix_seconds(utc_instant(ts))) / LEVEL_PART)

    def keep(rows: DataFrame, batch: int) -> None:
        if batch <= table.version().properties.get("batch", -1):
            rows.write.format("noop").mode("overwrite").save()  # the stream's state of this batch is still to be written
            return
        table.merge(rows, keys, day, batch=batch)
        table.vacuum(2)

    query = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(keep).start())
    query.awaitTermination()
    return table.read() if table.numbers() else stream.sparkSession.createDataFrame([], stream.schema)


def active_streams(spark: SparkSession, prefix: str) -> list[StreamingQuery]:
    return [q for q in spark.streams.active if (q.name or "").startswith(prefix)]


def stop_streams(spark: SparkSession, prefix: str) -> list[str]:
    found = active_streams(spark, prefix)
    for q in found:
        q.stop()
    return [q.name for q in found]


def await_streams(spark: SparkSession, prefix: str, seconds: int) -> bool:
    """Wait until all streams of the prefix have ended; False when time runs out first."""
    until = time.monotonic() + seconds
    for q in active_streams(spark, prefix):
        if not q.awaitTermination(max(1, int(until - time.monotonic()))):
            return False
    return True


def await_rows(spark: SparkSession, table: str, seconds: int, pause: float = 0.5) -> bool:
    """Wait until a table exists and holds a row."""
    until = time.monotonic() + seconds
    while time.monotonic() < until:
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
            if not spark.table(table).isEmpty():
                return True
        time.sleep(pause)
    return False
