"""Tumbling-window KPIs, their roll-ups, and area views of them."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

EVENT_COUNTS = ("answered", "dropped", "missed", "call", "text")
EVENT_SUMS = EVENT_COUNTS + ("total_records",)

# fixed values: procedure code -> column stem
PROCEDURE_CODES = {"11": "release_bearer", "15": "notification_sent", "16": "setup_bearer"}


def event_counts() -> dict[str, Column]:
    return {
        name: F.count_if(F.col("channel" if name in ("call", "text") else "outcome") == name)
        for name in EVENT_COUNTS
    } | {"total_records": F.count(F.lit(1))}


def procedure_measures() -> dict[str, Column]:
    out: dict[str, Column] = {}
    for code, stem in PROCEDURE_CODES.items():
        value = F.when(F.col("proc_code") == code, F.col("duration"))
        out |= {f"avg_{stem}": F.avg(value), f"max_{stem}": F.max(value), f"min_{stem}": F.min(value)}
    return out | {"total_records": F.count(F.lit(1))}


def windowed(df: DataFrame, ts: str, keys: Sequence[str], interval: str,
             measures: Mapping[str, Column], offset: str | None = None) -> DataFrame:
    """One row per non-empty (window, key), the window kept as struct so that a stream can be
    windowed again. `offset` moves the origin of multi-day windows."""
    win = F.window(F.col(ts), interval, startTime=offset) if offset else F.window(F.col(ts), interval)
    return df.groupBy(win.alias("window"), *keys).agg(*[m.alias(name) for name, m in measures.items()])


def started(df: DataFrame) -> DataFrame:
    """Replace the window struct by its start."""
    return df.select(F.col("window.start").alias("datetime"), *[c for c in df.columns if c != "window"])


def tumbling_kpi(df: DataFrame, ts: str, keys: Sequence[str], interval: str,
                 measures: Mapping[str, Column], offset: str | None = None) -> DataFrame:
    return started(windowed(df, ts, keys, interval, measures, offset))


def rollup_kpi(kpi: DataFrame, interval: str, keys: Sequence[str], sums: Sequence[str],
               offset: str | None = None) -> DataFrame:
    """Sum finer KPI rows into coarser windows."""
    return tumbling_kpi(kpi, "datetime", keys, interval, {c: F.sum(c) for c in sums}, offset)


def event_kpi(events: DataFrame, interval: str, offset: str | None = None) -> DataFrame:
    """Event counts per window and entity straight from the records.

    Equal to rolling up minute rows, but with one shuffle less and that of coarse rows: to be
    used where the minute level is not stored anyway.
    """
    return tumbling_kpi(events, "event_ts", ["entity_id"], interval, event_counts(), offset)


def minute_kpi(events: DataFrame) -> DataFrame:
    return event_kpi(events, "1 minute")


def procedure_kpi(procedures: DataFrame, interval: str = "1 minute") -> DataFrame:
    return tumbling_kpi(procedures, "event_ts", ["entity_id"], interval, procedure_measures())


def with_rate(df: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    ratio = F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0)).cast("double")
    return df.withColumn(name, ratio)


def period_totals(kpi: DataFrame, start: str, end: str) -> DataFrame:
    """Dashboard head line: totals and drop rate in [start, end)."""
    when = F.col("datetime")
    totals = (
        kpi.filter((when >= F.lit(start).cast("timestamp_ntz")) & (when < F.lit(end).cast("timestamp_ntz")))
        .agg(*[F.sum(c).alias(c) for c in EVENT_SUMS])
    )
    return with_rate(totals, "dropped", "total_records", "drop_rate")


def entity_totals(kpi: DataFrame) -> DataFrame:
    totals = kpi.groupBy("entity_id").agg(*[F.sum(c).alias(c) for c in EVENT_SUMS])
    return with_rate(totals, "dropped", "total_records", "drop_rate")


def area_view(kpi: DataFrame, dim: DataFrame) -> DataFrame:
    """KPIs per state, county and city with subtotals and the centroid of the entities counted.

    Facts are reduced to one row per entity before the join and the four-fold rollup expansion.
    """
    per_entity = kpi.groupBy("entity_id").agg(*[F.sum(c).alias(c) for c in EVENT_SUMS])
    area = (
        per_entity.join(dim, "entity_id")
        .rollup("state", "county", "city")
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("n_entities"),
            *[F.sum(c).alias(c) for c in EVENT_SUMS],
            F.avg("lat").alias("center_lat"),
            F.avg("lon").alias("center_lon"),
        )
    )
    return with_rate(area, "dropped", "total_records", "drop_rate")
