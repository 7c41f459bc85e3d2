"""Per-series curve fit: piecewise-linear trend plus Fourier seasonality (Taylor & Letham 2018).

Solved as penalised least squares. Spark lays out the series, runs the fits next to the data and
aggregates what comes back; the numpy part is the solve of one series. A group is one series on
its time grid (one row per step), so its size is bounded by the training range, not by the
number of events behind it. Time stamps travel as microseconds, groups as Arrow tables.
"""
from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from netkpi import schemas
from netkpi.operators.forecast import Z80, Z95

DAY = 86400.0
_ARROW = {T.StringType(): pa.string(), T.DoubleType(): pa.float64(), T.IntegerType(): pa.int32(),
          T.TimestampNTZType(): pa.timestamp("us")}
#: (series, model, ascending seconds) -> yhat, yhat_lower and yhat_upper
Bands = Callable[[str | None, dict, np.ndarray], dict[str, np.ndarray]]


@dataclass(frozen=True)
class Spec:
    """Settings of a fit. Scales are prior standard deviations on the standardised series."""
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    holiday_scale: float = 10.0
    multiplicative: bool = False
    changepoints: int = 25
    daily_order: int = 4
    weekly_order: int = 3
    z: float = Z95
    holidays: tuple[str, ...] = ()


def _seasons(sec: np.ndarray, spec: Spec) -> np.ndarray:
    cols = [
        f(2 * np.pi * k * sec / period)
        for period, order in ((DAY, spec.daily_order), (7 * DAY, spec.weekly_order))
        for k in range(1, order + 1) for f in (np.sin, np.cos)
    ]
    days = np.floor(sec / DAY)
    cols += [(days == np.datetime64(h, "D").astype("int64")).astype(float) for h in spec.holidays]
    return np.column_stack(cols) if cols else np.zeros((len(sec), 0))


def _trend_columns(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots[None, :], 0.0)])


def _ridge(x: np.ndarray, y: np.ndarray, scales: np.ndarray, noise: float) -> np.ndarray:
    """Posterior mean for prior standard deviations `scales` (inf: no prior)."""
    return _ridge_solve(x.T @ x, x.T @ y, scales, noise)


def _ridge_solve(gram: np.ndarray, cross: np.ndarray, scales: np.ndarray, noise: float) -> np.ndarray:
    penalty = np.where(np.isinf(scales), 1e-9, noise ** 2 / np.maximum(scales, 1e-9) ** 2)
    return np.linalg.solve(gram + np.diag(penalty), cross)


def knot_count(spec: Spec, steps: int) -> int:
    return max(0, min(spec.changepoints, int(0.8 * steps) - 1))


def priors(spec: Spec, n_knots: int, n_season: int) -> tuple[np.ndarray, np.ndarray]:
    """Prior standard deviations of the trend and season coefficients."""
    return (np.r_[np.inf, np.inf, np.full(n_knots, spec.changepoint_scale)],
            np.r_[np.full(n_season - len(spec.holidays), spec.season_scale), np.full(len(spec.holidays), spec.holiday_scale)])


def fit_one(sec: np.ndarray, y: np.ndarray, spec: Spec, frame: tuple[float, float, int] | None = None) -> dict:
    """Model of one series; `sec` are seconds since the epoch, ascending.

    frame: start, span and number of bends of the trend, by default those of the series itself.
    """
    if len(sec) < 2 or sec.max() == sec.min():
        raise ValueError("needs observations at two different times")
    if not np.all(np.isfinite(y)):
        raise ValueError("holds values that are not finite")
    start, span, n_knots = frame or (float(sec.min()), float(sec.max() - sec.min()), knot_count(spec, len(np.unique(sec))))
    level, size = float(np.mean(y)), float(np.std(y)) or 1.0
    t, v = (sec - start) / span, (y - level) / size
    knots = np.linspace(0, 0.8, n_knots + 1)[1:]
    trend, season = _trend_columns(t, knots), _seasons(sec, spec)
    prior_trend, prior_season = priors(spec, n_knots, season.shape[1])
    both = _ridge(np.hstack([trend, season]), v, np.r_[prior_trend, prior_season], 0.5)
    a, b = both[:trend.shape[1]], both[trend.shape[1]:]
    line = trend @ a
    base = line * size + level
    # a multiplicative season is a share of the trend, so the trend has to stay away from zero
    multiplicative = bool(spec.multiplicative and np.all(base > 0))
    if multiplicative:
        b = _ridge(season, y / base - 1, prior_season, 0.5 * size / max(abs(level), 1e-9))
        fitted = base * (1 + season @ b)
    else:
        fitted = (line + season @ b) * size + level
    resid = y - fitted
    return {
        "start": start, "span": span, "level": level, "size": size, "knots": knots.tolist(),
        "trend": a.tolist(), "season": b.tolist(), "multiplicative": multiplicative,
        "sigma": float(np.sqrt(np.mean(resid ** 2))),
        "slope_spread": float(np.mean(np.abs(a[2:]))) if len(knots) else 0.0,
        "spec": asdict(spec),
    }


def spec_from(values: dict) -> Spec:
    return Spec(**{**values, "holidays": tuple(values["holidays"])})


def predict_one(model: dict, sec: np.ndarray) -> dict[str, np.ndarray]:
    spec = spec_from(model["spec"])
    t = (sec - model["start"]) / model["span"]
    base = _trend_columns(t, np.asarray(model["knots"])) @ np.asarray(model["trend"])
    base = base * model["size"] + model["level"]
    season = _seasons(sec, spec) @ np.asarray(model["season"])
    yhat = base * (1 + season) if model["multiplicative"] else base + season * model["size"]
    # beyond the history the slope may change again at the rate and size seen so far
    # (Laplace steps of mean size s have variance 2 s^2; their effect grows with the cube of time)
    beyond = np.maximum(t - 1.0, 0.0)
    rate = len(model["knots"]) / 0.8
    drift = rate * 2 * (model["slope_spread"] * model["size"]) ** 2 * beyond ** 3 / 3
    half = spec.z * np.sqrt(model["sigma"] ** 2 + drift)
    return {"yhat": yhat, "yhat_lower": yhat - half, "yhat_upper": yhat + half}


def closed_form(entity: str | None, model: dict, sec: np.ndarray) -> dict[str, np.ndarray]:
    """The bands of `predict_one`; they need no draws, so the series does not matter."""
    return predict_one(model, sec)


def _table(schema: T.StructType, columns: dict) -> pa.Table:
    """Arrow table of a declared schema; scalars are repeated, missing columns are NULL."""
    n = max((len(v) for v in columns.values() if isinstance(v, (list, np.ndarray, pa.Array))), default=0)
    arrays = []
    for f in schema.fields:
        kind, v = _ARROW[f.dataType], columns.get(f.name)
        if isinstance(v, np.ndarray) and f.dataType == T.TimestampNTZType():
            v = v.astype("datetime64[us]")
        elif not isinstance(v, (list, np.ndarray, pa.Array)):
            v = [v] * n
        arrays.append(pa.array(v, type=kind, from_pandas=True))
    return pa.table(arrays, names=schema.fieldNames())


def _points(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds and values of a series in time order; NULL values become NaN."""
    micros = table.column("ds").to_numpy().astype("datetime64[us]").astype("int64")
    order = np.argsort(micros, kind="stable")
    return micros[order], table.column("y").to_numpy().astype(float)[order]


def _by_series(df: DataFrame) -> DataFrame:
    """Series rows spread over all tasks. The count is explicit: a fit costs far more than its
    bytes suggest, so partitions must not be merged by size."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    y = F.col("y") if "y" in df.columns else F.lit(None)
    return df.select(F.col("entity_id").cast("string").alias("entity_id"), "ds", y.cast("double").alias("y")).repartition(
        tasks, "entity_id")


def _observed(history: DataFrame) -> DataFrame:
    return _by_series(history.filter(F.col("y").isNotNull()))


def fit(history: DataFrame, spec: Spec) -> DataFrame:
    """One row per series: the model as JSON, or the message of the failure; the job goes on either way."""
    params = json.dumps(asdict(spec))

    def one(key: tuple, table: pa.Table) -> pa.Table:
        micros, y = _points(table)
        model, error = None, None
        try:
            model = json.dumps(fit_one(micros / 1e6, y, spec))
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        return _table(schemas.CURVE_MODEL_ROW, {
            "entity_id": [key[0].as_py()], "model_json": model, "params": params,
            "fit_start": micros[:1], "fit_end": micros[-1:], "error": error})

    return _observed(history).groupBy("entity_id").applyInArrow(one, schemas.CURVE_MODEL_ROW)


def fitted(models: DataFrame) -> DataFrame:
    return models.filter(F.col("error").isNull())


def failed(models: DataFrame) -> DataFrame:
    return models.filter(F.col("error").isNotNull())


def predict(models: DataFrame, grid: DataFrame, bands: Bands = closed_form) -> DataFrame:
    """Grid rows (entity_id, ds, optionally y) of every series that has a model."""
    def one(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _table(schemas.FORECAST_ROW, {})
        micros, y = _points(right)
        model = json.loads(left.column("model_json")[0].as_py())
        return _table(schemas.FORECAST_ROW, {
            "entity_id": key[0].as_py(), "ds": micros, "y": y, **bands(key[0].as_py(), model, micros / 1e6)})

    return (
        models.select("entity_id", "model_json").groupBy("entity_id")
        .cogroup(_by_series(grid).groupBy("entity_id")).applyInArrow(one, schemas.FORECAST_ROW)
    )


def forecast_or_error(history: DataFrame, spec: Spec, horizon: int, step_seconds: int = 3600, bands: Bands = closed_form) -> DataFrame:
    """Fit and predict in one pass over the series: history plus `horizon` steps.

    A series whose fit fails yields one row: its error, no time.
    """
    def one(key: tuple, table: pa.Table) -> pa.Table:
        return _extended(key[0].as_py(), table, spec, horizon, step_seconds, bands)

    return _observed(history).groupBy("entity_id").applyInArrow(one, schemas.AUTO_FORECAST_ROW)


def forecast(history: DataFrame, spec: Spec, horizon: int, step_seconds: int = 3600) -> DataFrame:
    """The rows of `forecast_or_error` without those of failures."""
    return forecast_or_error(history, spec, horizon, step_seconds).filter(F.col("error").isNull()).drop("error")


def _extended(entity: str, table: pa.Table, spec: Spec, horizon: int, step_seconds: int, bands: Bands = closed_form) -> pa.Table:
    micros, y = _points(table)
    try:
        model = fit_one(micros / 1e6, y, spec)
    except Exception as e:
        return _table(schemas.AUTO_FORECAST_ROW, {"entity_id": [entity], "error": f"{type(e).__name__}: {e}"})
    ahead = micros[-1] + np.arange(1, horizon + 1) * step_seconds * 1_000_000
    ds = np.r_[micros, ahead]
    return _table(schemas.AUTO_FORECAST_ROW, {
        "entity_id": entity, "ds": ds, "y": np.r_[y, np.full(horizon, np.nan)], **bands(entity, model, ds / 1e6)})


def forecast_with(best: DataFrame, history: DataFrame, horizon: int, step_seconds: int = 3600) -> DataFrame:
    """Forecast of each series under its own settings: `best` holds (entity_id, params) per series.

    A series without settings or without a fit yields one row: its error, no time.
    """
    def one(key: tuple, table: pa.Table) -> pa.Table:
        told = table.column("_told").to_numpy(zero_copy_only=False)
        settings, right = table.filter(pa.array(told)), table.filter(pa.array(~told))
        if not len(right):
            return _table(schemas.AUTO_FORECAST_ROW, {})
        if not len(settings) or settings.column("params")[0].as_py() is None:
            return _table(schemas.AUTO_FORECAST_ROW, {"entity_id": [key[0].as_py()], "error": "no settings"})
        spec = spec_from(json.loads(settings.column("params")[0].as_py()))
        return _extended(key[0].as_py(), right, spec, horizon, step_seconds)

    # settings travel as one more row of their series: a group of one frame costs far less than one of two
    settings = best.select(F.col("entity_id").cast("string").alias("entity_id"), "params", F.lit(True).alias("_told"))
    observed = history.filter(F.col("y").isNotNull()).select(
        F.col("entity_id").cast("string").alias("entity_id"), "ds", F.col("y").cast("double").alias("y"), F.lit(False).alias("_told"))
    tasks = int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = observed.unionByName(settings, allowMissingColumns=True)
    return both.repartition(tasks, "entity_id").groupBy("entity_id").applyInArrow(one, schemas.AUTO_FORECAST_ROW)


def changepoints(models: DataFrame) -> DataFrame:
    """Time and size of every possible trend change, in units of the series per day."""
    shape = "start DOUBLE, span DOUBLE, size DOUBLE, knots ARRAY<DOUBLE>, trend ARRAY<DOUBLE>"
    m = F.from_json("model_json", shape)
    pairs = F.arrays_zip(m["knots"].alias("knot"), F.slice(m["trend"], F.lit(3), F.size(m["knots"])).alias("step"))
    exploded = fitted(models).withColumn("m", m).select("entity_id", "m", F.inline(pairs).alias("knot", "step"))
    at = F.col("m.start") + F.col("knot") * F.col("m.span")
    origin = F.lit("1970-01-01").cast("timestamp_ntz")
    return exploded.select(
        "entity_id",
        F.timestamp_add("MICROSECOND", F.round(at * 1e6).cast("long"), origin).alias("ds"),
        (F.col("step") * F.col("m.size") / F.col("m.span") * DAY).alias("slope_change"))


# fixed values: logarithms of the search ranges of the prior scales
LOG_CHANGEPOINT_SCALE = (-6.9, -0.69)
LOG_SEASON_SCALE = (-6.9, 2.3)
LOG_HOLIDAY_SCALE = (-6.9, 2.3)


def random_trials(n: int, seed: int, holidays: Sequence[str] = ()) -> list[Spec]:
    """Settings drawn log-uniformly from the search ranges; the band is the 80 % one."""
    rng = np.random.default_rng(seed)

    def scale(bounds: tuple[float, float]) -> float:
        return float(np.exp(rng.uniform(*bounds)))

    return [
        replace(Spec(), changepoint_scale=scale(LOG_CHANGEPOINT_SCALE), season_scale=scale(LOG_SEASON_SCALE),
                holiday_scale=scale(LOG_HOLIDAY_SCALE), multiplicative=bool(rng.integers(2)), z=Z80,
                holidays=tuple(holidays))
        for _ in range(n)
    ]


@lru_cache(maxsize=256)
def _scales(trials: tuple[Spec, ...], n_knots: int, n_season: int) -> tuple[np.ndarray, np.ndarray]:
    """Prior standard deviations of all trials, one row each: of trend and season together, and of the season."""
    each = [priors(t, n_knots, n_season) for t in trials]
    return np.array([np.r_[a, b] for a, b in each]), np.array([b for _, b in each])


def _solve_each(gram: np.ndarray, cross: np.ndarray, scales: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """`_ridge_solve` for rows of scales; gram and cross are shared or one each."""
    penalty = np.where(np.isinf(scales), 1e-9, noise[:, None] ** 2 / np.maximum(scales, 1e-9) ** 2)
    grams = np.array(np.broadcast_to(gram, (len(scales), *gram.shape[-2:])))
    at = np.arange(scales.shape[1])
    grams[:, at, at] += penalty
    return np.linalg.solve(grams, np.broadcast_to(cross, scales.shape)[..., None])[..., 0]


def predict_trials(sec: np.ndarray, y: np.ndarray, season: np.ndarray, ahead: np.ndarray, season_ahead: np.ndarray,
                   trials: tuple[Spec, ...]) -> tuple[np.ndarray, np.ndarray]:
    """`fit_one` and `predict_one` for trials that differ in scales, form of the season and z only.

    Columns and their products, which are the greater part of the work, are made once. season, season_ahead: `_seasons`
    at the observed times and at those ahead. Returns yhat and half the band, one row per trial.
    """
    if len(sec) < 2 or sec.max() == sec.min():
        raise ValueError("needs observations at two different times")
    if not np.all(np.isfinite(y)):
        raise ValueError("holds values that are not finite")
    start, span = float(sec.min()), float(sec.max() - sec.min())
    n_knots = knot_count(trials[0], len(np.unique(sec)))
    level, size = float(np.mean(y)), float(np.std(y)) or 1.0
    v, knots = (y - level) / size, np.linspace(0, 0.8, n_knots + 1)[1:]
    t = (ahead - start) / span
    trend, trend_ahead = _trend_columns((sec - start) / span, knots), _trend_columns(t, knots)
    both_scales, season_scales = _scales(trials, n_knots, season.shape[1])
    x = np.hstack([trend, season])
    both = _solve_each(x.T @ x, x.T @ v, both_scales, np.full(len(trials), 0.5))
    a, b = both[:, :trend.shape[1]], both[:, trend.shape[1]:]
    base, base_ahead = (a @ c.T * size + level for c in (trend, trend_ahead))
    fitted, yhat = base + b @ season.T * size, base_ahead + b @ season_ahead.T * size
    many = np.flatnonzero(np.array([s.multiplicative for s in trials]) & np.all(base > 0, axis=1))
    if len(many):
        cross = (y / base[many] - 1) @ season
        share = _solve_each(season.T @ season, cross, season_scales[many], np.full(len(many), 0.5 * size / max(abs(level), 1e-9)))
        fitted[many] = base[many] * (1 + share @ season.T)
        yhat[many] = base_ahead[many] * (1 + share @ season_ahead.T)
    sigma2 = np.mean((y - fitted) ** 2, axis=1)
    spread = np.mean(np.abs(a[:, 2:]), axis=1) if n_knots else np.zeros(len(trials))
    drift = (n_knots / 0.8 * 2 * (spread * size) ** 2)[:, None] * np.maximum(t - 1.0, 0.0) ** 3 / 3
    return yhat, np.array([s.z for s in trials])[:, None] * np.sqrt(sigma2[:, None] + drift)


def _tried(numbers: list[int], trials: Sequence[Spec], *series: np.ndarray) -> Iterator[tuple]:
    """Trial numbers, their yhat and half bands or None, and the error; a trial that cannot be solved does not take the others with it."""
    try:
        yield numbers, *predict_trials(*series, tuple(trials[i] for i in numbers)), None
    except Exception as e:
        if len(numbers) == 1:
            yield numbers, None, None, f"{type(e).__name__}: {e}"
        else:
            for i in numbers:
                yield from _tried([i], trials, *series)


def search(history: DataFrame, trials: Sequence[Spec], folds: int, horizon_hours: int,
           spacing_hours: int | None = None, steps: bool = True) -> DataFrame:
    """Rolling-origin predictions of every trial for every series, one row per held-out step.

    The last fold ends with the series, the others `spacing_hours` (by default the horizon) before the next one.
    A group holds all trials of one series, which share what does not depend on the scales. steps=False: one row per
    series and trial instead, with the symmetric error over all its steps, so that steps stay in the worker.
    """
    hour = 3600 * 1_000_000
    step, spacing = horizon_hours * hour, (spacing_hours or horizon_hours) * hour
    params = [json.dumps(asdict(t)) for t in trials]
    alike: dict[tuple, list[int]] = {}
    for i, s in enumerate(trials):
        alike.setdefault((s.changepoints, s.daily_order, s.weekly_order, s.holidays), []).append(i)

    def held_out(micros: np.ndarray, y: np.ndarray) -> Iterator[tuple]:
        """Fold after fold: places of the held-out steps, and what `_tried` found."""
        sec = micros / 1e6
        for numbers in alike.values():
            season = _seasons(sec, trials[numbers[0]])
            for fold in range(folds - 1, -1, -1):
                cut = micros[-1] + hour - step - fold * spacing
                first, last = np.searchsorted(micros, (cut, cut + step))
                if first < last:
                    seen, held = slice(0, first), slice(first, last)
                    for found in _tried(numbers, trials, sec[seen], y[seen], season[seen], sec[held], season[held]):
                        yield held, *found

    def rows(key: tuple, table: pa.Table) -> pa.Table:
        micros, y = _points(table)
        parts = [_table(schemas.TRIAL_ROW, {})]
        for held, numbers, yhat, half, error in held_out(micros, y):
            for k, i in enumerate(numbers):
                row = {"entity_id": key[0].as_py(), "trial": i, "params": params[i]}
                parts.append(_table(schemas.TRIAL_ROW, row | ({"error": [error]} if error else {
                    "ds": micros[held], "y": y[held], "yhat": yhat[k], "yhat_lower": yhat[k] - half[k], "yhat_upper": yhat[k] + half[k]})))
        return pa.concat_tables(parts)

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        micros, y = _points(table)
        total, n, errors, tried = np.zeros(len(trials)), np.zeros(len(trials), int), [None] * len(trials), set()
        for held, numbers, yhat, _, error in held_out(micros, y):
            tried.update(numbers)
            if error:
                errors[numbers[0]] = min(error, errors[numbers[0]] or error)
                continue
            size = np.abs(y[held]) + np.abs(yhat)
            known = ~np.isnan(size)  # steps without a value do not count
            share = np.divide(2 * np.abs(y[held] - yhat), size, out=np.zeros_like(size), where=known & (size != 0))
            total[numbers] += share.sum(axis=1)
            n[numbers] += known.sum(axis=1)
        at = sorted(tried)
        return _table(schemas.TRIAL_SCORE_ROW, {
            "entity_id": [key[0].as_py()] * len(at), "trial": at, "error": [errors[i] for i in at],
            "smape": pa.array([total[i] / n[i] if n[i] else None for i in at], pa.float64())})

    series = _observed(history).groupBy("entity_id")
    if steps:
        return series.applyInArrow(rows, schemas.TRIAL_ROW)
    text = F.element_at(F.array(*[F.lit(p) for p in params]), F.col("trial") + 1)
    return series.applyInArrow(sums, schemas.TRIAL_SCORE_ROW).select("entity_id", "trial", text.alias("params"), "smape", "error")


def best_trials(results: DataFrame) -> DataFrame:
    """The trial with the lowest symmetric error per series; trial number breaks ties.

    `n_trials` counts the trials that gave predictions. A series in which every trial failed stays, with an error in
    place of settings. results: of `search`, with or without steps.
    """
    scored = results
    if "smape" not in results.columns:
        err, size = F.abs(F.col("y") - F.col("yhat")), F.abs("y") + F.abs("yhat")
        share = F.when(size == 0, F.lit(0.0)).otherwise(2 * err / F.nullif(size, F.lit(0.0)))
        scored = results.groupBy("entity_id", "trial", "params").agg(
            F.avg(F.when(F.col("error").isNull(), share)).alias("smape"), F.min("error").alias("error"))
    worked = F.col("smape").isNotNull()
    best = F.min_by(F.struct("trial", "params", "smape"), F.when(worked, F.struct("smape", "trial")))
    return scored.groupBy("entity_id").agg(
        best.alias("b"), F.count_if(worked).alias("n_trials"), F.min("error").alias("_error")).select(
        "entity_id", "b.*", "n_trials", F.when(F.col("n_trials") == 0, F.col("_error")).alias("error"))
