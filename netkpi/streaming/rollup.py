"""Stateful KPI windows. Every level needs the watermark set here to close its windows."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netkpi.operators import kpi


def minute_stream(events: DataFrame, delay: str, ts: str = "event_ts") -> DataFrame:
    return kpi.windowed(events.withWatermark(ts, delay), ts, ["entity_id"], "1 minute", kpi.event_counts())


def level_stream(events: DataFrame, delay: str, interval: str, ts: str = "event_ts") -> DataFrame:
    """One level straight from the records, for update mode, in which windows may not be chained."""
    return kpi.windowed(events.withWatermark(ts, delay), ts, ["entity_id"], interval, kpi.event_counts())


def procedure_stream(procedures: DataFrame, delay: str, ts: str = "event_ts") -> DataFrame:
    return kpi.windowed(procedures.withWatermark(ts, delay), ts, ["entity_id"], "1 minute", kpi.procedure_measures())


def coarser_stream(windows: DataFrame, interval: str) -> DataFrame:
    """Second window level over the closed windows of the first, in the same query.

    Windowing on the window struct keeps the event time; its start alone would lose it.
    """
    return kpi.windowed(windows, "window", ["entity_id"], interval, {c: F.sum(c) for c in kpi.EVENT_SUMS})
