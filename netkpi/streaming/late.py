"""Late rows of a stream: kept apart and counted, instead of dropped inside the stateful step.

The watermark of a batch is the greatest event time of all batches before it, less the delay, as Spark has it. A row is late
when its window ended at or before it: then the stateful step would drop it. Rows are split before that step and
go to two folders per batch, which appear whole or not at all; a batch that is repeated finds them and changes nothing.
Rows without an event time belong to no window and are counted as late.
"""
from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from netkpi.sources import small_files

KEPT, LATE = "kept", "late"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class LateRows:
    """Folders of a split stream: kept/batch_id=, late/batch_id=, and a mark per finished batch."""

    def __init__(self, spark: SparkSession, path: str, ts: str, delay: timedelta, window: timedelta) -> None:
        self.spark, self.path, self.ts, self.delay, self.window = spark, path.rstrip("/"), ts, delay, window

    def _mark(self, batch: int) -> dict:
        path = f"{self.path}/marks/b{batch:09d}.json"
        return json.loads(small_files.read(self.spark, path)) if batch >= 0 and small_files.exists(self.spark, path) else {}

    def watermark(self, batch: int) -> datetime | None:
        """What holds for a batch; None before any event time was seen."""
        seen = self._mark(batch - 1).get("newest")
        return None if seen is None else EPOCH + timedelta(microseconds=seen) - self.delay

    def is_late(self, batch: int) -> Column:
        mark, ts = self.watermark(batch), F.col(self.ts)
        if mark is None:
            return ts.isNull()
        # end of the window in microseconds; a window expression may not stand in a filter
        width = int(self.window.total_seconds() * 1_000_000)
        end = (F.floor(F.unix_micros(ts) / F.lit(width)) + 1) * width
        return ts.isNull() | (end <= F.lit(int((mark - EPOCH).total_seconds() * 1_000_000)))

    def start(self, stream: DataFrame, checkpoint: str, name: str | None = None) -> StreamingQuery:
        """Split all that is there, batch by batch. The stream's event time is an instant."""
        def split(rows: DataFrame, batch: int) -> None:
            if self._mark(batch):
                rows.write.format("noop").mode("overwrite").save()  # for the state of steps before the split
                return
            rows = rows.persist()
            try:
                newest = rows.agg(F.max(F.unix_micros(self.ts)), F.count(F.lit(1))).first()
                work, late = f"{self.path}/_work/{uuid.uuid4().hex}", self.is_late(batch)
                counts = {}
                for part, chosen in ((KEPT, ~late), (LATE, late)):
                    rows.filter(chosen).write.parquet(f"{work}/{part}")
                    counts[part] = self.spark.read.schema(rows.schema).parquet(f"{work}/{part}").count()
                for part in (KEPT, LATE):
                    small_files.move(self.spark, f"{work}/{part}", f"{self.path}/{part}/batch_id={batch}")
                before = self._mark(batch - 1).get("newest")
                seen = [x for x in (before, newest[0]) if x is not None]
                small_files.put(self.spark, f"{self.path}/marks/b{batch:09d}.json", json.dumps({"newest": max(seen, default=None), "rows": newest[1], **counts}))
            finally:
                rows.unpersist()

        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return (writer.queryName(name) if name else writer).foreachBatch(split).start()

    def rows(self, part: str, schema: StructType) -> DataFrame:
        """Stored rows of one side, with their batch_id."""
        return self.spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(f"{self.path}/{part}")

    def kept_stream(self, schema: StructType) -> DataFrame:
        """The rows that are in time, as a stream for the stateful step. It is to be drained after the split has ended."""
        return self.spark.readStream.schema(schema).parquet(f"{self.path}/{KEPT}/*")

    def counts(self) -> DataFrame:
        """batch_id, n_rows, n_kept, n_late of every finished batch."""
        marks = [(int(n[1:-5]), self._mark(int(n[1:-5]))) for n in small_files.names(self.spark, f"{self.path}/marks")]
        return self.spark.createDataFrame([(b, m["rows"], m[KEPT], m[LATE]) for b, m in marks], "batch_id long, n_rows long, n_kept long, n_late long")
