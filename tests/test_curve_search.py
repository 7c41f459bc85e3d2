"""Successive halving: rounds, errors of the last trials, stuck and failing trials."""
import time
from datetime import datetime as dt, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from netkpi.operators import curve_search, curvefit


def history(spark, hours=24 * 12):
    rows = [(e, dt(2024, 1, 1) + timedelta(hours=h), float(10 + k + np.sin(h / 24 * 2 * np.pi) + (h * 37 % 11) / 10)) for k, e in enumerate("ab") for h in range(hours)]
    return spark.createDataFrame(rows, "entity_id string, ds timestamp_ntz, y double")


def test_schedule():
    assert curve_search.schedule(5, 9, 3) == [(1, 9), (3, 3), (5, 1)]
    assert curve_search.schedule(1, 4, 3) == [(1, 4)] and curve_search.schedule(9, 2, 3) == [(1, 2), (3, 1), (9, 1)]


def test_last_trials_have_the_errors_of_a_full_search(spark):
    df, trials = history(spark), curvefit.random_trials(5, 3)
    got = {(r["entity_id"], r["trial"]): r for r in curve_search.search_halving(df, trials, 3, 24, eta=2).collect()}
    # five trials on one fold, three on two, two on three
    assert all(sorted(r["rounds"] for k, r in got.items() if k[0] == e) == [1, 1, 2, 3, 3] for e in "ab")
    err, size = F.abs(F.col("y") - F.col("yhat")), F.abs("y") + F.abs("yhat")
    full = curvefit.search(df, trials, 3, 24).groupBy("entity_id", "trial").agg(F.avg(2 * err / size).alias("s")).collect()
    for r in full:
        row = got[r["entity_id"], r["trial"]]
        if row["n_folds"] == 3:
            assert row["smape"] == pytest.approx(r["s"], abs=1e-9) and row["n_steps"] == 72
    assert any(r["n_folds"] == 3 for r in got.values()) and any(r["n_folds"] == 1 for r in got.values())


def test_a_stuck_trial_becomes_an_error_row_and_drops_out(spark):
    trials = curvefit.random_trials(4, 5)

    def stuck(sec, y, spec):
        if spec == trials[0]:
            time.sleep(60)
        if spec == trials[1]:
            raise ValueError("no fit")
        return curvefit.fit_one(sec, y, spec)

    began = time.time()
    results = curve_search.search_halving(history(spark), trials, 2, 24, eta=2, limit=2.0, fit=stuck)
    got = {(r["entity_id"], r["trial"]): r for r in results.collect()}
    assert time.time() - began < 50
    for e in "ab":
        assert got[e, 0]["error"] == "TimeoutError: over 2 s" and got[e, 1]["error"] == "ValueError: no fit"
        assert got[e, 0]["smape"] is None and got[e, 0]["rounds"] == 1
    best = curve_search.best_halved(results).collect()
    assert all(r["trial"] in (2, 3) and r["n_trials"] == 2 and r["error"] is None for r in best)


def test_a_series_in_which_every_trial_fails_stays(spark):
    one = spark.createDataFrame([("x", dt(2024, 1, 1), 1.0), ("x", dt(2024, 1, 2), 2.0)], "entity_id string, ds timestamp_ntz, y double")
    row = curve_search.best_halved(curve_search.search_halving(one, curvefit.random_trials(2, 1), 1, 24)).first()
    assert row["trial"] is None and row["n_trials"] == 0 and "ValueError" in row["error"]
