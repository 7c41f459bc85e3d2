"""Simulated bands: coverage of planted futures, long tails, blocks, reruns and series without a fit."""
from datetime import datetime as dt, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from netkpi.operators import curve_paths, curvefit

HOUR = 3600.0


def model(multiplicative=False, sigma=1.0, spread=0.3):
    spec = curvefit.Spec(changepoints=20)
    n = 2 * (spec.daily_order + spec.weekly_order)
    return {"start": 0.0, "span": 400 * HOUR, "level": 50.0, "size": 10.0, "knots": np.linspace(0.04, 0.8, 20).tolist(),
            "trend": [0.0, 1.0, *([0.0] * 20)], "season": [0.2, *([0.0] * (n - 1))], "multiplicative": multiplicative,
            "sigma": sigma, "slope_spread": spread, "spec": curvefit.asdict(spec)}


def planted(m, steps, draws, seed):
    """Futures one by one: changes by exponential gaps, the slope walked from change to change."""
    rng, out = np.random.default_rng(seed), np.zeros((draws, steps))
    times = np.arange(1, steps + 1) * HOUR / m["span"]
    for d in range(draws):
        at = rng.exponential(0.8 / len(m["knots"]))
        while at < times[-1]:
            out[d] += rng.laplace(0, m["slope_spread"] * m["size"]) * np.maximum(times - at, 0)
            at += rng.exponential(0.8 / len(m["knots"]))
    return out


@pytest.mark.parametrize("multiplicative", [False, True])
@pytest.mark.parametrize("coverage", [0.8, 0.95])
def test_bands_hold_their_share_of_planted_futures(multiplicative, coverage):
    m, steps = model(multiplicative), 200
    sec = m["start"] + m["span"] + np.arange(1, steps + 1) * HOUR
    got = curve_paths.simulated(m, sec, "a", curve_paths.Paths(8000, coverage, 3))
    season = curvefit._seasons(sec, curvefit.spec_from(m["spec"])) @ np.array(m["season"]) if multiplicative else np.zeros(steps)
    values = got["yhat"] + planted(m, steps, 4000, 1) * (1 + season) + np.random.default_rng(2).normal(0, m["sigma"], (4000, steps))
    share = ((values >= got["yhat_lower"]) & (values <= got["yhat_upper"])).mean(axis=0)
    assert np.abs(share.mean() - coverage) < 0.01 and np.abs(share - coverage).max() < 0.03


def test_variance_is_that_of_the_closed_form():
    m = model()
    after = np.arange(1, 201) * HOUR / m["span"]
    steps = curve_paths.trend_steps(np.random.default_rng(5), after, 40_000, 25.0, 3.0)
    expected = 25.0 * 2 * 9.0 * after ** 3 / 3
    assert np.allclose(steps.var(axis=0)[20:], expected[20:], rtol=0.06) and abs(steps.mean(axis=0)[-1]) < 0.1
    # few, large changes have longer tails than a normal sum of equal variance
    few = curve_paths.trend_steps(np.random.default_rng(5), after, 40_000, 2.0, 3.0)[:, -1]
    assert np.mean((few / few.std()) ** 4) > 6


def test_blocks_of_steps_follow_the_same_paths(monkeypatch):
    m = model(sigma=0.0)
    sec = m["span"] + np.arange(-50, 200) * HOUR
    whole = curve_paths.simulated(m, sec, "a", curve_paths.Paths(300))
    monkeypatch.setattr(curve_paths, "CELLS", 300 * 7)
    parts = curve_paths.simulated(m, sec, "a", curve_paths.Paths(300))
    assert all(np.allclose(whole[k], parts[k], rtol=1e-12) for k in whole)
    # without noise there is no band inside the history, and one that widens beyond it
    width = whole["yhat_upper"] - whole["yhat_lower"]
    assert np.allclose(width[:51], 0) and width[-1] > width[120] > width[60] > 0


def test_draws_depend_on_seed_and_series():
    m, sec = model(), model()["span"] + np.arange(1, 50) * HOUR
    band = lambda e, s: curve_paths.simulated(m, sec, e, curve_paths.Paths(100, 0.8, s))["yhat_upper"]
    assert np.array_equal(band("a", 1), band("a", 1)) and not np.array_equal(band("a", 1), band("a", 2))
    assert not np.array_equal(band("a", 1), band("b", 1)) and not np.array_equal(band(None, 1), band("", 1))


def test_settings_and_flat_models():
    for bad in ({"count": 1}, {"coverage": 0.0}, {"coverage": 1.0}):
        with pytest.raises(ValueError):
            curve_paths.Paths(**bad)
    flat = {**model(sigma=0.0, spread=0.0)}
    sec = flat["span"] + np.arange(1, 5) * HOUR
    got = curve_paths.simulated(flat, sec, "a", curve_paths.Paths(10))
    assert np.array_equal(got["yhat_lower"], got["yhat"]) and np.array_equal(got["yhat_upper"], got["yhat"])
    assert not len(curve_paths.simulated(flat, sec[:0], "a", curve_paths.Paths(10))["yhat"])


def test_frames(spark):
    rows = [(e, dt(2024, 1, 1) + timedelta(hours=h), float(10 + k + np.sin(h / 24 * 2 * np.pi) + (h * 37 % 11) / 10))
            for k, e in enumerate("ab") for h in range(240)] + [("one", dt(2024, 1, 1), 1.0), ("nulls", dt(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "entity_id string, ds timestamp_ntz, y double")
    got = curve_paths.forecast_paths(df, curvefit.Spec(), 48, paths=curve_paths.Paths(200)).toPandas()
    failed = got[got["error"].notna()]
    assert failed["entity_id"].tolist() == ["one"] and failed["ds"].isna().all()
    good = got[got["error"].isna()]
    assert good.groupby("entity_id").size().to_dict() == {"a": 288, "b": 288}
    assert (good["yhat_lower"] <= good["yhat"]).all() and (good["yhat"] <= good["yhat_upper"]).all()
    again = curve_paths.forecast_paths(df.repartition(7), curvefit.Spec(), 48, paths=curve_paths.Paths(200)).toPandas()
    order = ["entity_id", "ds"]
    a, b = (x[x["error"].isna()].sort_values(order)["yhat_upper"].to_numpy() for x in (got, again))
    assert np.allclose(a, b, rtol=1e-12)
    # points are those of the closed form
    plain = curvefit.forecast(df, curvefit.Spec(), 48).select("entity_id", "ds", F.col("yhat").alias("p")).toPandas()
    both = good.merge(plain, on=order)
    assert len(both) == 576 and np.allclose(both["yhat"], both["p"])
    empty = curve_paths.forecast_paths(df.limit(0), curvefit.Spec(), 48)
    assert empty.count() == 0 and empty.columns == got.columns.tolist()
