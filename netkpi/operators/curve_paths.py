"""Bands from simulated trends: the slope goes on changing as it did in the history, and each path draws when and by how much.

Changes arrive at the rate of the possible bends of the fit, at any moment after its last row; their sizes are Laplace
draws whose mean size is that of the fitted bends. A path adds them to the model's trend, the season follows, and noise of the
residual size is drawn per step. The band of a step are quantiles over the paths. Unlike the closed form of
`curvefit.predict_one`, which takes the sum of changes for normal, this keeps its long tails and, in a multiplicative model, lets
the season grow with the path.

Draws depend on the seed, the series and its grid, not on how rows are partitioned, so reruns agree.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from netkpi.operators import curvefit
from netkpi.operators.curvefit import Spec

#: Cells (paths times steps) that are held at once.
CELLS = 1 << 20


@dataclass(frozen=True)
class Paths:
    """Number of simulated paths, share of them inside the band, and seed."""
    count: int = 1000
    coverage: float = 0.8
    seed: int = 0

    def __post_init__(self) -> None:
        if self.count < 2 or not 0 < self.coverage < 1:
            raise ValueError("needs two paths or more and a coverage between 0 and 1")


def generator(seed: int, entity: str | None) -> np.random.Generator:
    """Random numbers of one series; a null name has draws of its own."""
    name = hashlib.sha256(b"-" if entity is None else b"=" + entity.encode("utf-8", "surrogatepass")).digest()
    return np.random.default_rng([seed, int.from_bytes(name[:8], "big")])


def trend_steps(rng: np.random.Generator, after: np.ndarray, count: int, rate: float, spread: float) -> np.ndarray:
    """Departure of each path from the trend at each time: a row per path, a column per time.

    after: ascending times since the end of the history; rate: changes per unit of time; spread: mean size of a change.
    """
    out = np.zeros((count, len(after)))
    end = max(float(after[-1]), 0.0) if len(after) else 0.0
    if not end or not rate or not spread:
        return out
    many = rng.poisson(rate * end, count)
    path = np.repeat(np.arange(count), many)
    at, step = rng.uniform(0.0, end, len(path)), rng.laplace(0.0, spread, len(path))
    # a change at time s moves all later times t by step * (t - s): sums of step and of step * s up to t say all
    cell = path * len(after) + np.searchsorted(after, at, "left")
    slopes = np.bincount(cell, step, out.size).reshape(out.shape).cumsum(axis=1)
    shifts = np.bincount(cell, step * at, out.size).reshape(out.shape).cumsum(axis=1)
    return slopes * np.maximum(after, 0.0) - shifts


def simulated(model: dict, sec: np.ndarray, entity: str | None, paths: Paths) -> dict[str, np.ndarray]:
    """Forecast and simulated band of one series at ascending seconds, in blocks of steps of `CELLS` cells."""
    point = curvefit.predict_one(model, sec)["yhat"]
    after = (sec - model["start"]) / model["span"] - 1.0
    season = np.zeros(len(sec))
    if model["multiplicative"]:
        season = curvefit._seasons(sec, curvefit.spec_from(model["spec"])) @ np.asarray(model["season"])
    rate, spread = len(model["knots"]) / 0.8, model["slope_spread"] * model["size"]
    tail = (1 - paths.coverage) / 2
    low, high = np.empty(len(sec)), np.empty(len(sec))
    rng = generator(paths.seed, entity)
    changes, noise = rng.integers(1 << 62), np.random.default_rng(rng.integers(1 << 62))
    width = max(1, CELLS // paths.count)
    for a in range(0, len(sec), width):
        b = min(len(sec), a + width)
        # every block replays all changes, summed up to its own steps
        steps = trend_steps(np.random.default_rng(changes), np.r_[after[a:b], after[-1]], paths.count, rate, spread)[:, :-1]
        values = point[a:b] + steps * (1 + season[a:b]) + noise.normal(0.0, model["sigma"], steps.shape)
        low[a:b], high[a:b] = np.quantile(values, [tail, 1 - tail], axis=0)
    # with few paths the quantiles of a step may miss the forecast itself
    return {"yhat": point, "yhat_lower": np.minimum(low, point), "yhat_upper": np.maximum(high, point)}


def _bands(paths: Paths) -> curvefit.Bands:
    return lambda entity, model, sec: simulated(model, sec, entity, paths)


def predict_paths(models: DataFrame, grid: DataFrame, paths: Paths = Paths()) -> DataFrame:
    """`curvefit.predict` with simulated bands."""
    return curvefit.predict(models, grid, _bands(paths))


def forecast_paths(history: DataFrame, spec: Spec, horizon: int, step_seconds: int = 3600, paths: Paths = Paths()) -> DataFrame:
    """`curvefit.forecast_or_error` with simulated bands: history plus `horizon` steps, one error row per series without a fit."""
    return curvefit.forecast_or_error(history, spec, horizon, step_seconds, _bands(paths))
