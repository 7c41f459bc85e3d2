"""Time series per entity: history, grids, profiles and per-series aggregates."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netkpi.functions.scalar import in_range


def series_sum(df: DataFrame, keys: Sequence[str], ts: str, target: str) -> DataFrame:
    """One row per (key, time): the target summed, named ds and y."""
    return df.groupBy(*keys, F.col(ts).alias("ds")).agg(F.sum(target).cast("double").alias("y"))


def series_mean(df: DataFrame, keys: Sequence[str], ts: str, target: str) -> DataFrame:
    """Repeated (key, time) rows averaged."""
    return df.groupBy(*keys, F.col(ts).alias("ds")).agg(F.avg(target).alias("y"))


def count_series(df: DataFrame, entity: str, ts: str, interval: str) -> DataFrame:
    """Rows counted per entity and window of `interval`; combined in the map tasks, so a hot
    entity leaves each task as one row per window."""
    return (
        df.groupBy(F.window(ts, interval).alias("window"), F.col(entity).alias("entity_id"))
        .agg(F.count(F.lit(1)).cast("double").alias("y"))
        .select("entity_id", F.col("window.start").alias("ds"), "y")
    )


def training_history(series: DataFrame, start: str, end: str) -> DataFrame:
    return series.filter(in_range(F.col("ds"), start, end)).select("entity_id", "ds", "y")


def extents(series: DataFrame) -> DataFrame:
    return series.groupBy("entity_id").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.count(F.lit(1)).alias("n_obs"))


def steps_after(last: Column, horizon: int, unit: str) -> Column:
    """The `horizon` time stamps that follow `last`, as an array."""
    one = F.expr(f"INTERVAL 1 {unit}")
    return F.sequence(last + one, last + F.expr(f"INTERVAL {horizon} {unit}"), one)


def future_grid(series: DataFrame, horizon: int, unit: str, include_history: bool = False) -> DataFrame:
    """(entity, ds) for the next `horizon` steps of every entity; gaps in the history stay gaps."""
    ahead = extents(series).select(
        "entity_id", F.explode(steps_after(F.col("last_ds"), horizon, unit)).alias("ds"))
    return series.select("entity_id", "ds").unionByName(ahead) if include_history else ahead


def attach_history(grid: DataFrame, series: DataFrame) -> DataFrame:
    """Grid rows with the observed value, NULL where there is none."""
    return grid.join(series.select("entity_id", "ds", "y"), ["entity_id", "ds"], "left")


def fill_gaps(series: DataFrame, unit: str) -> DataFrame:
    """Option: zero rows for empty steps between the first and last observation of an entity."""
    steps = F.sequence("first_ds", "last_ds", F.expr(f"INTERVAL 1 {unit}"))
    grid = extents(series).select("entity_id", F.explode(steps).alias("ds"))
    return attach_history(grid, series).fillna(0.0, ["y"])


def season_profile(series: DataFrame, part: Column, name: str) -> DataFrame:
    """Mean level per calendar part relative to the entity mean.

    The entity mean comes from the per-part sums, so the series itself is shuffled once.
    """
    cells = series.groupBy("entity_id", part.alias(name)).agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    level = cells.groupBy("entity_id").agg((F.sum("s") / F.sum("n")).alias("level"))
    return cells.join(level, "entity_id").select(
        "entity_id", name, (F.col("s") / F.col("n") / F.nullif(F.col("level"), F.lit(0.0))).alias("relative_level"))


def weekend_share(series: DataFrame) -> DataFrame:
    total = F.sum("y")
    weekend = F.sum(F.when(F.dayofweek("ds").isin(1, 7), F.col("y")).otherwise(0.0))
    return series.groupBy("entity_id").agg(
        (weekend / F.nullif(total, F.lit(0.0))).alias("weekend_share"))


def missing_models(ids: DataFrame, models: DataFrame) -> DataFrame:
    """Series for which no model exists."""
    return ids.select("entity_id").distinct().join(models.select("entity_id"), "entity_id", "left_anti")


def training_status(ids: DataFrame, models: DataFrame) -> DataFrame:
    """One row: series wanted, series trained, and the verdict failed / partial / complete."""
    wanted = ids.select("entity_id").distinct()
    have = models.select("entity_id").distinct().withColumn("_hit", F.lit(1))
    counts = wanted.join(have, "entity_id", "left").agg(
        F.count(F.lit(1)).alias("n_series"), F.count("_hit").alias("n_trained"))
    verdict = (
        F.when(F.col("n_trained") == 0, "failed")
        .when(F.col("n_trained") < F.col("n_series"), "partial").otherwise("complete")
    )
    return counts.withColumn("verdict", verdict)
