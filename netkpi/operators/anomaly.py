"""Observed values against the newest forecast."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netkpi.functions.scalar import band_distance, outside_band


def latest_training(forecasts: DataFrame, stamp: str = "trained_at", day: str | None = None) -> DataFrame:
    """Rows of the newest training: one plan with a scalar subquery, nothing comes to the driver.

    `day` names the partition column that holds the day of the stamp; older days are then not read.
    """
    if day:
        forecasts = forecasts.filter(F.col(day) == forecasts.agg(F.max(day)).scalar())
    return forecasts.filter(F.col(stamp) == forecasts.agg(F.max(stamp)).scalar())


def flag_anomalies(actuals: DataFrame, forecasts: DataFrame, tasks: int | None = None) -> DataFrame:
    """Join on (entity, ds), so one run covers any number of time slots.

    tasks: number of tasks that share the join, for many entities; without, Spark's own.
    """
    a, lo, hi = F.col("actual"), F.col("yhat_lower"), F.col("yhat_upper")
    fc = forecasts.select("entity_id", "ds", "yhat", "yhat_lower", "yhat_upper", "trained_at")
    seen = actuals.select("entity_id", "ds", F.col("y").alias("actual"))
    if tasks:
        seen, fc = (rows.repartition(tasks, "entity_id", "ds") for rows in (seen, fc))
    return (
        seen.join(fc, ["entity_id", "ds"])
        .withColumn("is_anomaly", outside_band(a, lo, hi))
        .withColumn("anomaly_size", band_distance(a, lo, hi))
    )
