"""Seasonal-trend forecasts in plain aggregates: one bounded model row per series.

The model of a series is y = intercept + slope * x + effect[slot]: a least-squares line over time
plus the mean residual of each calendar slot (168 hours of the week, or 7 days of it).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from netkpi.functions.scalar import elapsed_seconds
from netkpi.operators.series import steps_after
from netkpi.sources.tables import materialize, tasks_for

Z95 = 1.959963984540054
Z80 = 1.2815515655446004
# history rows of a task of a forecast
ROWS_PER_TASK = 100_000


@dataclass(frozen=True)
class Grain:
    """Step of a series and its calendar cycle."""
    unit: str
    seconds: int
    slots: int

    def slot(self, ds: Column) -> Column:
        day = F.dayofweek(ds) - 1
        return day * 24 + F.hour(ds) if self.slots == 168 else day

    def elapsed(self, ds: Column, origin: str) -> Column:
        return elapsed_seconds(ds, origin) / F.lit(float(self.seconds))


HOURLY = Grain("HOUR", 3600, 168)
DAILY = Grain("DAY", 86400, 7)

MODEL_JSON = "intercept DOUBLE, slope DOUBLE, sigma DOUBLE, effects MAP<STRING, DOUBLE>"


def fit(history: DataFrame, grain: Grain, origin: str, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """One row per series: n_obs, fit_start, fit_end, intercept, slope, sigma, effects by slot.

    Give `history` laid out by entity and nothing below shuffles again. A window group is one
    series on its time grid; a model row holds at most `grain.slots` effects.
    """
    keys = list(keys)
    series = Window.partitionBy(*keys)
    y, x = F.col("y"), F.col("x")
    line = {
        "slope": F.coalesce(F.regr_slope(y, x).over(series), F.lit(0.0)),
        "mean_x": F.avg(F.when(y.isNotNull(), x)).over(series), "mean_y": F.avg(y).over(series),
        "fit_start": F.min("ds").over(series), "fit_end": F.max("ds").over(series), "n_obs": F.count(y).over(series),
    }
    fitted = history.select(*keys, "ds", "y").withColumn("x", grain.elapsed(F.col("ds"), origin)).withColumns(line)
    intercept = (F.col("mean_y") - F.col("slope") * F.col("mean_x")).alias("intercept")
    whole = [*keys, "n_obs", "fit_start", "fit_end", "intercept", "slope"]  # constant within a series
    resid = fitted.select(
        *keys, "n_obs", "fit_start", "fit_end", intercept, "slope", grain.slot(F.col("ds")).alias("slot"),
        (y - F.col("mean_y") - F.col("slope") * (x - F.col("mean_x"))).alias("r"))
    cells = resid.groupBy(*whole, "slot").agg(F.avg("r").alias("effect"), (F.var_pop("r") * F.count("r")).alias("ss"))
    return cells.groupBy(*whole).agg(
        F.sqrt(F.sum("ss") / F.col("n_obs")).alias("sigma"),
        F.map_from_entries(F.collect_list(F.struct("slot", "effect"))).alias("effects"))


def predicted(rows: DataFrame, grain: Grain, origin: str, z: float = Z95) -> DataFrame:
    """Add yhat and the band to rows that carry ds and the model columns."""
    ds = F.col("ds")
    point = (
        F.col("intercept") + F.col("slope") * grain.elapsed(ds, origin)
        + F.coalesce(F.try_element_at("effects", grain.slot(ds)), F.lit(0.0))
    )
    half = F.col("sigma") * z
    return (
        rows.withColumn("yhat", point)
        .withColumn("yhat_lower", F.col("yhat") - half)
        .withColumn("yhat_upper", F.col("yhat") + half)
        .drop("intercept", "slope", "sigma", "effects", "n_obs", "fit_start", "fit_end")
    )


def predict(models: DataFrame, grid: DataFrame, grain: Grain, origin: str, z: float = Z95,
            keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    return predicted(grid.join(models, list(keys)), grain, origin, z)


def predict_ahead(models: DataFrame, horizon: int, grain: Grain, origin: str, z: float = Z95) -> DataFrame:
    """Future rows straight from the model rows, no join."""
    ahead = models.withColumn("ds", F.explode(steps_after(F.col("fit_end"), horizon, grain.unit)))
    return predicted(ahead, grain, origin, z)


def forecast(history: DataFrame, horizon: int, grain: Grain, origin: str, z: float = Z95) -> DataFrame:
    """History and the next `horizon` steps: entity_id, ds, y, yhat, yhat_lower, yhat_upper.

    History is written once and laid out by entity, over as many tasks as its rows need: a few bytes of it become many
    rows, so tasks must not be merged by size. Fit, look-up of the fit and the future rows use that layout.
    """
    stored = materialize(history.select("entity_id", "ds", "y"), "forecast-input")
    placed = stored.repartition(tasks_for(stored, ROWS_PER_TASK), "entity_id")
    models = fit(placed, grain, origin)
    seen = predict(models, placed, grain, origin, z)
    ahead = predict_ahead(models, horizon, grain, origin, z).withColumn("y", F.lit(None).cast("double"))
    return seen.unionByName(ahead)


def model_table(models: DataFrame, z: float, origin: str) -> DataFrame:
    """Models as one JSON text each, with the range they were fitted on."""
    return models.select(
        "entity_id",
        F.to_json(F.struct("intercept", "slope", "sigma", "effects")).alias("model_json"),
        F.to_json(F.struct(F.lit(z).alias("z"), F.lit(origin).alias("origin"))).alias("params"),
        "fit_start", "fit_end", "n_obs",
    )


def load_models(table: DataFrame) -> DataFrame:
    parsed = F.from_json("model_json", MODEL_JSON)
    by_slot = F.transform_keys("_m.effects", lambda k, v: k.cast("int"))
    return table.withColumn("_m", parsed).select(
        "entity_id", "n_obs", "fit_start", "fit_end", "_m.intercept", "_m.slope", "_m.sigma", by_slot.alias("effects"))


def fold_cutoffs(end: str, folds: int, horizon_hours: int, spacing_hours: int) -> Column:
    """Array of `folds` cutoffs `spacing_hours` apart, the last one `horizon_hours` before `end`."""
    stop = F.lit(end).cast("timestamp_ntz")
    return F.array(*[
        F.struct(F.lit(i).alias("fold"),
                 (stop - F.expr(f"INTERVAL {horizon_hours + (folds - i) * spacing_hours} HOUR")).alias("cutoff"))
        for i in range(1, folds + 1)])


def rolling_origin(history: DataFrame, end: str, folds: int, horizon_hours: int, grain: Grain,
                   origin: str, z: float = Z95, spacing_hours: int | None = None) -> DataFrame:
    """Predictions of each fold for the `horizon_hours` after its cutoff, from rows before it.

    Cutoffs lie `spacing_hours` apart, by default a horizon.

    Each history row is repeated only into the folds it takes part in.
    """
    cuts = F.filter(
        fold_cutoffs(end, folds, horizon_hours, spacing_hours or horizon_hours),
        lambda c: F.col("ds") < c["cutoff"] + F.expr(f"INTERVAL {horizon_hours} HOUR"))
    rows = history.repartition("entity_id").select("entity_id", "ds", "y", F.inline(cuts))
    keys = ["entity_id", "fold"]
    models = fit(rows.filter(F.col("ds") < F.col("cutoff")), grain, origin, keys)
    held = rows.filter(F.col("ds") >= F.col("cutoff"))
    return predict(models, held, grain, origin, z, keys)


def accuracy(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """mse, rmse, mae, mape, mdape, smape and coverage per key over rows with a known y.

    mape and mdape leave out y near 0; smape counts 0/0 as 0. A key holds one row per time
    step, which bounds what the exact median keeps in memory.
    """
    y, p = F.col("y"), F.col("yhat")
    err = F.abs(y - p)
    ape = F.when(F.abs(y) > 1e-9, err / F.abs(y))
    size = F.abs(y) + F.abs(p)
    sape = F.when(size == 0, F.lit(0.0)).otherwise(2 * err / F.nullif(size, F.lit(0.0)))
    inside = ((y >= F.col("yhat_lower")) & (y <= F.col("yhat_upper"))).cast("double")
    metrics = {
        "mse": F.avg(err * err), "rmse": F.sqrt(F.avg(err * err)), "mae": F.avg(err),
        "mape": F.avg(ape), "mdape": F.percentile(ape, 0.5), "smape": F.avg(sape), "coverage": F.avg(inside),
    }
    return (
        pred.filter(y.isNotNull()).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_points"), *[m.alias(name) for name, m in metrics.items()])
    )


METRICS = ("mse", "rmse", "mae", "mape", "mdape", "smape", "coverage")


def validation_means(metrics: DataFrame) -> DataFrame:
    """One row: the mean of each metric over all series."""
    return metrics.agg(*[F.avg(m).alias(f"val_{m}") for m in METRICS])
