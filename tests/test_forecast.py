"""Forecast edge cases, planted signals, fault isolation, search."""
import json
from datetime import datetime as dt, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from netkpi.functions import scalar
from netkpi.operators import anomaly, curvefit, forecast as fc, series as ts

T0 = dt(2024, 1, 1)
ORIGIN = "2024-01-01"
SHAPE = "entity_id string, ds timestamp_ntz, y double"


def hours(name, values):
    return [(name, T0 + timedelta(hours=i), float(v)) for i, v in enumerate(values)]


def planted(n=336, slope=0.05):
    t = np.arange(n)
    return 20 + slope * t + 5 * np.sin(2 * np.pi * t / 24) + 2 * (t % 168 >= 120)


def test_seasonal_fit_recovers_line_and_slots(spark):
    # a season that is orthogonal to time inside each week, two whole weeks, no noise
    hist = spark.createDataFrame(hours("a", [10 + 0.5 * i for i in range(336)]), SHAPE)
    m = fc.fit(hist, fc.HOURLY, ORIGIN).first()
    assert m["slope"] == pytest.approx(0.5) and m["intercept"] == pytest.approx(10) and m["sigma"] == pytest.approx(0, abs=1e-9)
    assert m["n_obs"] == 336 and len(m["effects"]) == 168


def test_constant_and_single_point_series(spark):
    hist = spark.createDataFrame(hours("flat", [4] * 48) + hours("one", [7]), SHAPE)
    out = {(r["entity_id"], r["ds"]): r for r in fc.forecast(hist, 24, fc.HOURLY, ORIGIN).collect()}
    for name, level, n in (("flat", 4, 48), ("one", 7, 1)):
        ahead = out[(name, T0 + timedelta(hours=n + 5))]
        assert ahead["y"] is None
        assert ahead["yhat"] == ahead["yhat_lower"] == ahead["yhat_upper"] == pytest.approx(level)
    assert len(out) == 48 + 24 + 1 + 24


def test_first_forecast_step_follows_the_history(spark):
    hist = spark.createDataFrame(hours("a", range(336)), SHAPE)
    ahead = fc.forecast(hist, 168, fc.HOURLY, ORIGIN).filter("y IS NULL").agg(F.min("ds"), F.max("ds"), F.count("ds")).first()
    assert tuple(ahead) == (dt(2024, 1, 15), dt(2024, 1, 21, 23), 168)


def test_gaps_stay_gaps_unless_filled(spark):
    hist = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + timedelta(hours=3), 2.0)], SHAPE)
    grid = ts.attach_history(ts.future_grid(hist, 2, "HOUR", include_history=True), hist)
    assert sorted(r["ds"].hour for r in grid.collect()) == [0, 3, 4, 5]
    assert sorted(r["y"] for r in ts.fill_gaps(hist, "HOUR").collect()) == [0.0, 0.0, 1.0, 2.0]


def test_accuracy_with_zero_targets(spark):
    pred = spark.createDataFrame(
        [("a", 0.0, 0.0, -1.0, 1.0), ("a", 2.0, 1.0, 1.0, 2.0), ("a", None, 1.0, 0.0, 2.0)],
        "entity_id string, y double, yhat double, yhat_lower double, yhat_upper double")
    r = fc.accuracy(pred, ["entity_id"]).first()
    assert (r["n_points"], r["mse"], r["mae"], r["mape"], r["mdape"], r["coverage"]) == (2, 0.5, 0.5, 0.5, 0.5, 1.0)
    assert r["smape"] == pytest.approx((0 + 2 * 1 / 3) / 2)


def test_models_survive_the_json_table(spark):
    hist = spark.createDataFrame(hours("a", planted()) + hours("b", planted(200, -0.1)), SHAPE)
    models = fc.fit(hist, fc.HOURLY, ORIGIN)
    direct = fc.predict_ahead(models, 48, fc.HOURLY, ORIGIN)
    stored = fc.predict_ahead(fc.load_models(fc.model_table(models, fc.Z95, ORIGIN)), 48, fc.HOURLY, ORIGIN)
    key = ["entity_id", "ds"]
    apart = direct.join(stored.withColumnRenamed("yhat", "other").select(*key, "other"), key).agg(
        F.count("ds"), F.max(F.abs(F.col("yhat") - F.col("other")))).first()
    assert apart[0] == 96 and apart[1] < 1e-9


def test_rolling_origin_uses_no_later_rows(spark):
    values = [5.0] * 240 + [500.0] * 96
    hist = spark.createDataFrame(hours("a", values), SHAPE)
    pred = fc.rolling_origin(hist, "2024-01-15", 2, 48, fc.HOURLY, ORIGIN)
    first = pred.filter("fold = 1").agg(F.max("yhat"), F.count("ds")).first()
    assert first[0] == pytest.approx(5) and first[1] == 48
    assert pred.filter("fold = 2").count() == 48


def test_rolling_origin_plan_has_no_cross_join(spark):
    hist = spark.createDataFrame(hours("a", planted()), SHAPE)
    plan = fc.rolling_origin(hist, "2024-01-15", 5, 24, fc.HOURLY, ORIGIN)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_band_flags(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 5.0), (4, 0.5), (5, 6.5), (6, None)], "id long, a double")
    a, lo, hi = F.col("a"), F.lit(1.0), F.lit(5.0)
    out = df.select("id", scalar.outside_band(a, lo, hi).alias("f"), scalar.band_distance(a, lo, hi).alias("d"))
    assert rows(out) == [(1, 0, None), (2, 0, None), (3, 0, None), (4, 1, 0.5), (5, 1, 1.5), (6, None, None)]


def test_only_the_newest_training_counts(spark, rows):
    f = spark.createDataFrame(
        [("a", T0, 1.0, 0.0, 2.0, dt(2023, 1, 1)), ("a", T0, 9.0, 8.0, 10.0, dt(2023, 6, 1))],
        "entity_id string, ds timestamp_ntz, yhat double, yhat_lower double, yhat_upper double, trained_at timestamp_ntz")
    actual = spark.createDataFrame([("a", T0, 1.0), ("b", T0, 1.0)], SHAPE)
    out = anomaly.flag_anomalies(actual, anomaly.latest_training(f))
    assert rows(out, "entity_id", "is_anomaly", "anomaly_size") == [("a", 1, 7.0)]


def test_training_status(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("b",)], "entity_id string")
    for have, verdict in (([], "failed"), (["a"], "partial"), (["a", "b", "c"], "complete")):
        models = spark.createDataFrame([(h,) for h in have], "entity_id string")
        assert ts.training_status(ids, models).first()["verdict"] == verdict
    assert [r[0] for r in ts.missing_models(ids, spark.createDataFrame([("a",)], "entity_id string")).collect()] == ["b"]


def micro(n):
    return np.arange(n) * 3600.0 + 1704067200.0


@pytest.mark.parametrize("multiplicative", [False, True])
def test_curve_recovers_planted_signal(multiplicative):
    n = 336
    t = np.arange(n + 48)
    season = np.sin(2 * np.pi * t / 24)
    line = 50 + 0.05 * t
    y = line * (1 + 0.2 * season) if multiplicative else line + 5 * season
    spec = curvefit.Spec(multiplicative=multiplicative, changepoint_scale=0.01)
    model = curvefit.fit_one(micro(n), y[:n], spec)
    out = curvefit.predict_one(model, micro(n + 48)[n:])
    assert model["multiplicative"] == multiplicative
    assert np.max(np.abs(out["yhat"] - y[n:])) < 2.5
    width = out["yhat_upper"] - out["yhat_lower"]
    assert width[-1] >= width[0] > 0


def test_curve_finds_a_planted_trend_change(spark):
    y = [0.0 + (i if i < 168 else 168 + 4 * (i - 168)) for i in range(336)]
    hist = spark.createDataFrame(hours("a", y), SHAPE)
    models = curvefit.fit(hist, curvefit.Spec(changepoint_scale=5.0))
    best = curvefit.changepoints(models).orderBy(F.col("slope_change").desc()).first()
    assert abs((best["ds"] - (T0 + timedelta(hours=168))).total_seconds()) < 12 * 3600


def test_a_failing_series_does_not_stop_the_others(spark):
    hist = spark.createDataFrame(hours("good", planted()) + hours("one", [1]) + hours("nan", [float("nan")] * 3), SHAPE)
    models = curvefit.fit(hist, curvefit.Spec())
    assert {r["entity_id"] for r in curvefit.fitted(models).select("entity_id").collect()} == {"good"}
    errors = {r["entity_id"]: r["error"] for r in curvefit.failed(models).collect()}
    assert "two different times" in errors["one"] and "finite" in errors["nan"]
    ahead = curvefit.predict(curvefit.fitted(models), ts.future_grid(hist, 24, "HOUR")).filter("entity_id = 'good'")
    assert ahead.count() == 24 and ahead.filter("yhat IS NULL").isEmpty()
    assert curvefit.forecast(hist, curvefit.Spec(), 24).filter("entity_id = 'one'").isEmpty()


def test_failed_series_stay_in_the_forecast_queries(spark, monkeypatch):
    from netkpi.plans import series_queries

    hist = spark.createDataFrame(hours("good", [10 + i % 24 for i in range(200)]) + hours("one", [5.0]), SHAPE)
    monkeypatch.setattr(series_queries, "_history", lambda spark, sf_dir: hist)
    monkeypatch.setattr(series_queries.adapters, "load", lambda *_: hist)
    monkeypatch.setattr(series_queries.ts, "count_series", lambda *_: hist)
    for query, ahead in ((series_queries.curve_forecast, 168), (series_queries.curve_forecast_daily, 90)):
        got = query(spark, "").collect()
        lost = [r for r in got if r["entity_id"] == "one"]
        assert len(lost) == 1 and "two different times" in lost[0]["error"] and lost[0]["ds"] is None
        assert sum(r["entity_id"] == "good" and r["error"] is None for r in got) == 200 + ahead


def test_search_prefers_the_better_setting(spark):
    y = [30 + 10 * np.sin(2 * np.pi * i / 24) for i in range(336)]
    hist = spark.createDataFrame(hours("a", y), SHAPE)
    trials = [curvefit.Spec(season_scale=1e-4), curvefit.Spec(season_scale=10.0)]
    best = curvefit.best_trials(curvefit.search(hist, trials, 3, 24)).first()
    assert best["trial"] == 1 and best["n_trials"] == 2 and json.loads(best["params"])["season_scale"] == 10.0


def test_trials_are_repeatable_and_in_range():
    a, b = curvefit.random_trials(10, 3), curvefit.random_trials(10, 3)
    assert a == b
    assert all(np.exp(-6.9) <= t.changepoint_scale <= np.exp(-0.69) for t in a)


def test_holiday_effect_is_learned():
    n = 24 * 14
    y = np.full(n, 10.0)
    y[24 * 7:24 * 8] = 40.0
    spec = curvefit.Spec(holidays=("2024-01-08", "2024-01-16"), weekly_order=0)
    model = curvefit.fit_one(micro(n), y, spec)
    fitted = curvefit.predict_one(model, micro(n))["yhat"]
    assert fitted[24 * 7:24 * 8].mean() > 30


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_elapsed_time_ignores_clock_changes(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(dt(2024, 3, 11),)], "ds timestamp_ntz")
        assert df.select(scalar.elapsed_seconds(F.col("ds"), "2024-03-10")).first()[0] == 86400.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_year_and_range_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter(scalar.in_year(F.col("o_orderdate"), 1997))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan and "LessThan(o_orderdate,1998-01-01" in plan


def test_each_series_is_forecast_with_its_own_settings(spark):
    hist = spark.createDataFrame(hours("a", planted()) + hours("b", planted()), SHAPE)
    from dataclasses import asdict

    best = spark.createDataFrame(
        [("a", json.dumps(asdict(curvefit.Spec(z=1.0)))), ("b", json.dumps(asdict(curvefit.Spec(z=2.0))))], "entity_id string, params string")
    out = curvefit.forecast_with(best, hist, 24).groupBy("entity_id").agg(
        F.count("ds").alias("n"), F.max(F.col("yhat_upper") - F.col("yhat")).alias("half")).collect()
    got = {r["entity_id"]: r for r in out}
    assert got["a"]["n"] == got["b"]["n"] == 360
    assert got["b"]["half"] == pytest.approx(2 * got["a"]["half"])


def test_a_series_without_fit_or_settings_leaves_its_error(spark):
    hist = spark.createDataFrame(hours("a", planted()) + hours("one", [1]), SHAPE)
    best = curvefit.best_trials(curvefit.search(hist, [curvefit.Spec()], 2, 24, 12))
    got = {r["entity_id"]: r for r in best.collect()}
    assert got["a"]["n_trials"] == 1 and got["a"]["error"] is None
    assert got["one"]["n_trials"] == 0 and got["one"]["params"] is None and "two different times" in got["one"]["error"]
    out = curvefit.forecast_with(best, hist, 24)
    assert out.filter("entity_id = 'a' AND error IS NULL").count() == 360
    assert [tuple(r) for r in out.filter("error IS NOT NULL").select("entity_id", "ds").collect()] == [("one", None)]


def test_folds_may_lie_closer_than_the_horizon(spark):
    hist = spark.createDataFrame(hours("a", planted()), SHAPE)
    pred = fc.rolling_origin(hist, "2024-01-15", 3, 48, fc.HOURLY, ORIGIN, spacing_hours=12)
    ends = {r["fold"]: (r["n"], r["last"]) for r in pred.groupBy("fold").agg(F.count("ds").alias("n"), F.max("ds").alias("last")).collect()}
    assert {k: v[0] for k, v in ends.items()} == {1: 48, 2: 48, 3: 48}
    assert ends[3][1] == dt(2024, 1, 14, 23) and ends[2][1] == dt(2024, 1, 14, 11)
    rows = curvefit.search(hist, [curvefit.Spec()] * 2, 3, 48, 12)
    assert rows.groupBy("trial").count().filter("count = 144").count() == 2


def test_stored_trainings_need_no_sort_and_as_many_tasks_as_rows(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from netkpi.plans import series_queries

    first = F.lit("2024-01-01").cast("timestamp_ntz")
    hist = spark.range(3000).select(
        F.col("id").alias("entity_id"), (first + F.make_dt_interval(hours=F.col("id") % 40)).alias("ds"), F.lit(1.0).alias("y"))
    by, sorted_by = DataFrameWriter.partitionBy, []
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda w, *c: sorted_by.extend(c) or by(w, *c))
    monkeypatch.setattr(series_queries, "_history", lambda *_, **__: hist)
    monkeypatch.setattr(fc, "ROWS_PER_TASK", 300, raising=False)
    got = series_queries._latest(spark, "", "user_id")
    assert "trained_on" not in sorted_by  # the sort by folder held all rows of a task
    assert got.count() == 3000 * 169 and got.columns == ["entity_id", "ds", "y", "yhat", "yhat_lower", "yhat_upper", "trained_at"]
    assert [tuple(r) for r in got.select("trained_at").distinct().collect()] == [(dt(2024, 1, 15),)]
    # files of the newest training: those of histories and of future rows come from ten tasks
    assert got.filter("y IS NULL").select(F.input_file_name().alias("f")).distinct().count() == 10


def test_anomalies_are_the_same_in_any_number_of_tasks(spark, rows):
    f = spark.createDataFrame(
        [("a", T0, 9.0, 8.0, 10.0, T0), ("b", T0, 9.0, 8.0, 10.0, T0)],
        "entity_id string, ds timestamp_ntz, yhat double, yhat_lower double, yhat_upper double, trained_at timestamp_ntz")
    actual = spark.createDataFrame([("a", T0, 1.0), ("b", T0, 12.0), ("b", T0, 9.0), ("c", T0, 1.0), (None, T0, 1.0)], SHAPE)
    out = anomaly.flag_anomalies(actual, f, tasks=7)
    assert rows(out) == rows(anomaly.flag_anomalies(actual, f)) and len(rows(out)) == 3
    assert "hashpartitioning(entity_id" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", 7)" in plan


def test_trials_together_predict_as_one_by_one():
    rng, trials = np.random.default_rng(3), tuple(curvefit.random_trials(6, 4, ["2024-01-03"]))
    assert len({t.multiplicative for t in trials}) == 2
    for n in (2, 5, 40, 300):
        at = np.sort(rng.choice(400, n, replace=False))
        sec, ahead = micro(400)[at], micro(500)[400::7]
        for y in (rng.integers(1, 5, n).astype(float), rng.normal(size=n), np.full(n, 3.0)):
            yhat, half = curvefit.predict_trials(sec, y, curvefit._seasons(sec, trials[0]), ahead, curvefit._seasons(ahead, trials[0]), trials)
            for i, t in enumerate(trials):
                one = curvefit.predict_one(curvefit.fit_one(sec, y, t), ahead)
                assert yhat[i] == pytest.approx(one["yhat"], rel=1e-6, abs=1e-6)
                assert half[i] == pytest.approx(one["yhat_upper"] - one["yhat"], rel=1e-6, abs=1e-6)


def test_scores_of_a_search_equal_those_of_its_steps(spark, monkeypatch):
    y = [30 + 10 * np.sin(2 * np.pi * i / 24) + (i * 37 % 11) for i in range(336)]
    nan = [*y[:330], float("nan"), 0.0, 1.0]
    hist = spark.createDataFrame(hours("a", y) + hours("b", [0.0] * 200) + hours("nan", nan) + hours("one", [1]) + hours(None, y[:250]), SHAPE)
    trials = [*curvefit.random_trials(3, 2), curvefit.Spec(changepoints=3), curvefit.Spec(weekly_order=400, changepoint_scale=float("nan"))]
    best = [{r["entity_id"]: r for r in curvefit.best_trials(curvefit.search(hist, trials, 3, 24, 12, steps=s)).collect()} for s in (True, False)]
    assert len(best[0]) == len(best[1]) == 5
    for e, r in best[0].items():
        same = best[1][e]
        assert (r["trial"], r["params"], r["n_trials"], r["error"]) == (same["trial"], same["params"], same["n_trials"], same["error"])
        assert r["smape"] == pytest.approx(same["smape"], abs=1e-12) if r["smape"] is not None else same["smape"] is None


def test_a_search_holds_one_group_per_series(spark):
    hist = spark.createDataFrame(hours("a", planted()) + hours("b", planted()), SHAPE)
    plan = curvefit.search(hist, [curvefit.Spec()] * 10, 2, 24)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "FlatMapGroupsInArrow" in plan  # rows were copied per trial
    best = curvefit.best_trials(curvefit.search(hist, [curvefit.Spec()], 2, 24, steps=False))
    assert "CoGroups" not in curvefit.forecast_with(best, hist, 24)._jdf.queryExecution().executedPlan().toString()
