"""Rule counts of a stream, batch by batch, as a table.

The counts of `quality.observe_rules` come with each batch's progress. A listener writes them under the query's id and the
batch's number, so a batch that runs twice has one row per rule. The query's id stays the same over restarts.
Counts of a batch that was committed while the driver was lost before its progress was told are missing: such a
batch has no file, which `missing_batches` shows.
"""
from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from netkpi.sources import small_files

ROW = "query_id string, batch_id long, at string, rule string, rows_seen long, violations long"


class RuleHistory(StreamingQueryListener):
    """To be added to a session by `watch`; path: folder of the table; label: that of observe_rules."""

    def __init__(self, spark: SparkSession, path: str, label: str) -> None:
        self.spark, self.path, self.label = spark, path.rstrip("/"), label
        self.ended: dict[str, threading.Event] = {}
        self.failures: list[Exception] = []

    def watch(self) -> "RuleHistory":
        self.spark.streams.addListener(self)
        return self

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self.store(event.progress)
        except Exception as e:  # nobody catches it in the listener's thread; `wait` raises it
            self.failures.append(e)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def store(self, progress) -> bool:
        """False if the batch has no such counts or is there already."""
        seen = progress.observedMetrics.get(self.label)
        if seen is None:
            return False
        counts = seen.asDict()
        rows_seen = counts.pop("rows_seen")
        lines = [json.dumps({"query_id": str(progress.id), "batch_id": progress.batchId, "at": progress.timestamp, "rule": rule,
                             "rows_seen": rows_seen, "violations": bad}) for rule, bad in counts.items()]
        return small_files.put(self.spark, f"{self.path}/{progress.id}/b{progress.batchId:09d}.json", "\n".join(lines) + "\n")

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and all its progress has been told."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the listener was not told of the query's end")
        if self.failures:
            raise self.failures[0]

    def read(self) -> DataFrame:
        folders = [f"{self.path}/{n}" for n in small_files.names(self.spark, self.path)]
        return self.spark.read.schema(ROW).json(folders) if folders else self.spark.createDataFrame([], ROW)

    def missing_batches(self, query_id: str) -> list[int]:
        """Numbers below the newest without counts: batches without rows, or lost ones."""
        there = {int(n[1:-5]) for n in small_files.names(self.spark, f"{self.path}/{query_id}")}
        return sorted(set(range(max(there, default=-1) + 1)) - there)
