"""Series, forecasts, their accuracy, and anomalies."""
from pyspark.sql import functions as F, types as T

from netkpi.functions import scalar
from netkpi.operators import anomaly, curvefit, enrich, forecast as fc, kpi, ledger, series as ts
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register, rounded
from netkpi.sources import adapters, files, tables

START, END = "2024-01-01", "2024-01-15"
FORECAST_END = "2024-01-22"  # 168 hours after END
TRAINED_ON = ("2024-01-08", END)
ORDER_START = "1995-01-01"
# folds of the searches: a week ahead, five times, over the whole range of the events
RANGE_END, HORIZON, FOLDS, SPACING = "2024-01-31", 168, 5, 84

_BAND = "p AS yhat, p - 1.959963984540054 * sigma AS yhat_lower, p + 1.959963984540054 * sigma AS yhat_upper"
_FORECAST_OUT = "round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper"
_BAND_COLS = ("yhat", "yhat_lower", "yhat_upper")


def _fit_sql(history: str, slot: str, seconds: int, origin: str, keys: str = "entity_id", tag: str = "") -> str:
    """The same model with the textbook functions: regression line, then residuals averaged per slot."""
    on = f"USING ({keys})"
    return f"""line{tag} AS (
  SELECT {keys}, coalesce(regr_slope(y, x), 0) AS b, avg(y) - coalesce(regr_slope(y, x), 0) * avg(x) AS a,
    max(ds) AS fit_end, min(ds) AS fit_start, count(*) AS n_obs
  FROM (SELECT *, epoch(ds - TIMESTAMP '{origin}') / {seconds}.0 AS x FROM {history}) GROUP BY {keys}),
resid{tag} AS (
  SELECT {keys}, {slot} AS slot, y - a - b * epoch(ds - TIMESTAMP '{origin}') / {seconds}.0 AS r
  FROM {history} JOIN line{tag} {on}),
effect{tag} AS (SELECT {keys}, slot, avg(r) AS e FROM resid{tag} GROUP BY {keys}, slot),
spread{tag} AS (
  SELECT {keys}, sqrt(avg((r - e) * (r - e))) AS sigma FROM resid{tag} JOIN effect{tag} USING ({keys}, slot) GROUP BY {keys})"""


_HOUR_SLOT = "dayofweek(ds) * 24 + hour(ds)"
_HOUR_FIT = _fit_sql("history", _HOUR_SLOT, 3600, START)
_POINT = f"a + b * epoch(ds - TIMESTAMP '{START}') / 3600.0 + coalesce(e, 0)"
_AHEAD = """ahead AS (
  SELECT entity_id, unnest(generate_series(fit_end + INTERVAL 1 HOUR, fit_end + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ds,
    NULL::DOUBLE AS y FROM line)"""
_PREDICT = f"""frame AS (SELECT entity_id, ds, y FROM history UNION ALL SELECT entity_id, ds, y FROM ahead),
forecast AS (
  SELECT entity_id, ds, y, {_BAND} FROM (
    SELECT f.*, sigma, {_POINT} AS p FROM (SELECT *, {_HOUR_SLOT} AS slot FROM frame) f
    JOIN line USING (entity_id) JOIN spread USING (entity_id) LEFT JOIN effect USING (entity_id, slot)))"""
_FORECAST = (o.SERIES, _HOUR_FIT, _AHEAD, _PREDICT)


def _series(spark, sf_dir):
    return ts.count_series(adapters.load(spark, sf_dir, "events"), "event_type", "ts", "1 hour")


def _history(spark, sf_dir, end=END, start=START, key="event_type"):
    """The time range is applied to the events, where it prunes the scan."""
    events = adapters.load(spark, sf_dir, "events").filter(scalar.in_range(F.col("ts"), start, end))
    return ts.count_series(events, key, "ts", "1 hour")


def _user_history(spark, sf_dir, end=END):
    return _history(spark, sf_dir, end, key="user_id")


@register("series_sum", "D8 F1", o.with_(o.EVENT, o.MINUTE, o.HOUR) + f"""
SELECT entity_id, datetime AS ds, sum(dropped)::DOUBLE AS y FROM hour_kpi
WHERE datetime >= TIMESTAMP '{START}' AND datetime < TIMESTAMP '{END}' GROUP BY 1, 2""")
def series_sum(spark, sf_dir):
    # the bounds are whole hours, so filtering records gives the same windows and reaches the scan
    records = adapters.event_records(spark, sf_dir).filter(scalar.in_range(F.col("event_ts"), START, END))
    hour = kpi.event_kpi(records, "1 hour")
    return ts.training_history(ts.series_sum(hour, ["entity_id"], "datetime", "dropped"), START, END)


@register("series_sum_by_day", "D9 B9", """
SELECT o_orderpriority, o_orderdate AS ds, round(sum(o_totalprice), 2) AS y FROM orders
WHERE year(o_orderdate) = 1997 GROUP BY 1, 2""")
def series_sum_by_day(spark, sf_dir):
    orders = adapters.load(spark, sf_dir, "orders").filter(scalar.in_year(F.col("o_orderdate"), 1997))
    out = ts.series_sum(orders, ["o_orderpriority"], "o_orderdate", "o_totalprice")
    return out.withColumn("y", F.round("y", 2))


@register("series_mean", "D10", """
SELECT user_id, date_trunc('hour', ts) AS ds, round(avg(value), 6) AS y FROM events GROUP BY 1, 2""")
def series_mean(spark, sf_dir):
    events = adapters.load(spark, sf_dir, "events").withColumn("hour", F.window("ts", "1 hour").start)
    return ts.series_mean(events, ["user_id"], "hour", "value").withColumn("y", F.round("y", 6))


@register("series_extents", "D12", """
WITH e AS (SELECT user_id AS entity_id, min(ts) AS first_ds, max(ts) AS last_ds, count(*) AS n_obs FROM events GROUP BY 1)
SELECT *, (SELECT max(last_ds) FROM e) AS last_of_all FROM e""")
def series_extents(spark, sf_dir):
    events = adapters.load(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), F.col("ts").alias("ds"))
    per = ts.extents(events)
    return per.withColumn("last_of_all", events.agg(F.max("ds")).scalar())


@register("distinct_values", "D13", "SELECT lang, source FROM documents GROUP BY ALL")
def distinct_values(spark, sf_dir):
    return adapters.load(spark, sf_dir, "documents").select("lang", "source").distinct()


@register("future_grid_hours", "F2", o.with_(o.SERIES) + """
SELECT entity_id, unnest(generate_series(m + INTERVAL 1 HOUR, m + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ds
FROM (SELECT entity_id, max(ds) AS m FROM history GROUP BY 1)""")
def future_grid_hours(spark, sf_dir):
    return ts.future_grid(_history(spark, sf_dir), 168, "HOUR")


@register("grid_with_history", "C4 F2", o.with_(o.SERIES) + """
SELECT entity_id, ds, y FROM history UNION ALL
SELECT entity_id, unnest(generate_series(m + INTERVAL 1 HOUR, m + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ds, NULL
FROM (SELECT entity_id, max(ds) AS m FROM history GROUP BY 1)""")
def grid_with_history(spark, sf_dir):
    hist = _history(spark, sf_dir)
    return ts.attach_history(ts.future_grid(hist, 168, "HOUR", include_history=True), hist)


@register("forecast_hourly", "F3", o.with_(*_FORECAST) + f"SELECT entity_id, ds, y, {_FORECAST_OUT} FROM forecast")
def forecast_hourly(spark, sf_dir):
    return rounded(fc.forecast(_history(spark, sf_dir), 168, fc.HOURLY, START), *_BAND_COLS)


@register("forecast_hourly_by_entity", "F3 F1", o.with_(
    f"""history AS (SELECT user_id AS entity_id, date_trunc('hour', ts) AS ds, count(*)::DOUBLE AS y FROM events
  WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}' GROUP BY 1, 2)""",
    _HOUR_FIT, _AHEAD, _PREDICT) + f"SELECT entity_id, ds, y, {_FORECAST_OUT} FROM forecast")
def forecast_hourly_by_entity(spark, sf_dir):
    return rounded(fc.forecast(_user_history(spark, sf_dir), 168, fc.HOURLY, START), *_BAND_COLS)


@register("forecast_daily", "F4", o.with_(
    """history AS (SELECT o_orderpriority AS entity_id, o_orderdate AS ds, count(*)::DOUBLE AS y FROM orders GROUP BY 1, 2)""",
    _fit_sql("history", "dayofweek(ds)", 86400, ORDER_START),
    """ahead AS (SELECT entity_id, unnest(generate_series(fit_end + INTERVAL 1 DAY, fit_end + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS ds,
  NULL::DOUBLE AS y FROM line)""") + f"""
SELECT entity_id, ds, y, {_FORECAST_OUT} FROM (SELECT *, {_BAND} FROM (
  SELECT f.*, sigma, a + b * epoch(ds - TIMESTAMP '{ORDER_START}') / 86400.0 + coalesce(e, 0) AS p
  FROM (SELECT *, dayofweek(ds) AS slot FROM (SELECT * FROM history UNION ALL SELECT * FROM ahead)) f
  JOIN line USING (entity_id) JOIN spread USING (entity_id) LEFT JOIN effect USING (entity_id, slot)))""")
def forecast_daily(spark, sf_dir):
    days = ts.count_series(adapters.load(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "1 day")
    return rounded(fc.forecast(days, 90, fc.DAILY, ORDER_START), *_BAND_COLS)


@register("season_by_weekday", "F5", o.with_(o.SERIES) + """
SELECT entity_id, weekday, round(m / level, 6) AS relative_level FROM (
  SELECT entity_id, dayofweek(ds) + 1 AS weekday, avg(y) AS m FROM history GROUP BY 1, 2)
JOIN (SELECT entity_id, avg(y) AS level FROM history GROUP BY 1) USING (entity_id)""")
def season_by_weekday(spark, sf_dir):
    return rounded(ts.season_profile(_history(spark, sf_dir), F.dayofweek("ds"), "weekday"), "relative_level")


@register("season_by_hour", "F5", o.with_(o.SERIES) + """
SELECT entity_id, hour, round(m / level, 6) AS relative_level FROM (
  SELECT entity_id, hour(ds) AS hour, avg(y) AS m FROM history GROUP BY 1, 2)
JOIN (SELECT entity_id, avg(y) AS level FROM history GROUP BY 1) USING (entity_id)""")
def season_by_hour(spark, sf_dir):
    return rounded(ts.season_profile(_history(spark, sf_dir), F.hour("ds"), "hour"), "relative_level")


@register("weekend_share", "F5", """
SELECT user_id AS entity_id, round(count(*) FILTER (WHERE dayofweek(ts) IN (0, 6))::DOUBLE / count(*), 6) AS weekend_share
FROM events GROUP BY 1""")
def weekend_share(spark, sf_dir):
    days = ts.count_series(adapters.load(spark, sf_dir, "events"), "user_id", "ts", "1 day")
    return rounded(ts.weekend_share(days), "weekend_share")


_ACC = """count(*) AS n_points, avg((y - yhat) ** 2) AS mse, sqrt(avg((y - yhat) ** 2)) AS rmse, avg(abs(y - yhat)) AS mae,
  avg(abs(y - yhat) / abs(y)) FILTER (WHERE abs(y) > 1e-9) AS mape,
  quantile_cont(abs(y - yhat) / abs(y), 0.5) FILTER (WHERE abs(y) > 1e-9) AS mdape,
  avg(CASE WHEN abs(y) + abs(yhat) = 0 THEN 0 ELSE 2 * abs(y - yhat) / (abs(y) + abs(yhat)) END) AS smape,
  avg((y BETWEEN yhat_lower AND yhat_upper)::INT) AS coverage"""
_ACC_OUT = "n_points, " + ", ".join(f"round({m}, 6) AS {m}" for m in fc.METRICS)


def _accuracy(spark, sf_dir):
    return fc.accuracy(fc.forecast(_history(spark, sf_dir), 168, fc.HOURLY, START), ["entity_id"])


@register("forecast_accuracy", "F6", o.with_(*_FORECAST) + f"""
SELECT entity_id, {_ACC_OUT} FROM (SELECT entity_id, {_ACC} FROM forecast WHERE y IS NOT NULL GROUP BY 1)""")
def forecast_accuracy(spark, sf_dir):
    return rounded(_accuracy(spark, sf_dir), *fc.METRICS)


@register("forecast_accuracy_means", "D11", o.with_(*_FORECAST) + f"""
SELECT {', '.join(f'round(avg({m}), 6) AS val_{m}' for m in fc.METRICS)} FROM (
  SELECT entity_id, {_ACC} FROM forecast WHERE y IS NOT NULL GROUP BY 1)""")
def forecast_accuracy_means(spark, sf_dir):
    return rounded(fc.validation_means(_accuracy(spark, sf_dir)), *[f"val_{m}" for m in fc.METRICS])


_FOLDS = """folds AS (SELECT i AS fold, TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR * (168 + (5 - i) * 84) AS cutoff FROM range(1, 6) t(i)),
train AS (SELECT entity_id, fold, ds, y FROM history JOIN folds ON ds < cutoff),
held AS (SELECT entity_id, fold, ds, y FROM history JOIN folds ON ds >= cutoff AND ds < cutoff + INTERVAL 168 HOUR)"""


@register("forecast_rolling_origin", "F7", o.with_(
    o.SERIES.replace(f"'{END}'", f"'{RANGE_END}'"), _FOLDS, _fit_sql("train", _HOUR_SLOT, 3600, START, "entity_id, fold", "_f")) + f"""
, pred AS (SELECT entity_id, fold, y, {_BAND} FROM (
    SELECT h.*, sigma, {_POINT} AS p FROM (SELECT *, {_HOUR_SLOT} AS slot FROM held) h
    JOIN line_f USING (entity_id, fold) JOIN spread_f USING (entity_id, fold) LEFT JOIN effect_f USING (entity_id, fold, slot)))
SELECT entity_id, fold, {_ACC_OUT} FROM (SELECT entity_id, fold, {_ACC} FROM pred GROUP BY 1, 2)""")
def forecast_rolling_origin(spark, sf_dir):
    pred = fc.rolling_origin(
        _history(spark, sf_dir, RANGE_END), RANGE_END, FOLDS, HORIZON, fc.HOURLY, START, spacing_hours=SPACING)
    return rounded(fc.accuracy(pred, ["entity_id", "fold"]), *fc.METRICS).withColumn("fold", F.col("fold").cast("long"))


@register("model_table_predict", "F10 G10", o.with_(o.SERIES, _HOUR_FIT, _AHEAD) + f"""
SELECT entity_id, ds, {_FORECAST_OUT} FROM (SELECT *, {_BAND} FROM (
  SELECT f.entity_id, ds, sigma, {_POINT} AS p FROM (SELECT *, {_HOUR_SLOT} AS slot FROM ahead) f
  JOIN line USING (entity_id) JOIN spread USING (entity_id) LEFT JOIN effect USING (entity_id, slot)))""")
def model_table_predict(spark, sf_dir):
    """Fit once, write the models as JSON, read them back and predict without refitting."""
    fitted = fc.model_table(fc.fit(_history(spark, sf_dir), fc.HOURLY, START), fc.Z95, START)
    stored = tables.materialize(fitted, "season-models")
    return rounded(fc.predict_ahead(fc.load_models(stored), 168, fc.HOURLY, START), *_BAND_COLS)


@register("model_table", "F10", o.with_(o.SERIES, _HOUR_FIT) + """
SELECT entity_id, n_obs, fit_start, fit_end, round(a, 6) AS intercept, round(b, 9) AS slope, round(sigma, 6) AS sigma
FROM line JOIN spread USING (entity_id)""")
def model_table(spark, sf_dir):
    return fc.fit(_history(spark, sf_dir), fc.HOURLY, START).select(
        "entity_id", "n_obs", "fit_start", "fit_end", F.round("intercept", 6).alias("intercept"),
        F.round("slope", 9).alias("slope"), F.round("sigma", 6).alias("sigma"))


def _trainings(spark, sf_dir, key="event_type"):
    """Forecasts of two trainings, each stamped with its time and day."""
    for end in TRAINED_ON:
        yield fc.forecast(_history(spark, sf_dir, end, key=key), 168, fc.HOURLY, START).withColumns({
            "trained_at": F.lit(end).cast("timestamp_ntz"), "trained_on": F.lit(end).cast("date")})


def _latest(spark, sf_dir, key="event_type"):
    """Newest training out of the stored forecast history, which is partitioned by training day."""
    by_day = zip(TRAINED_ON, (rows.drop("trained_on") for rows in _trainings(spark, sf_dir, key)), strict=True)
    stored = tables.materialize_parts(by_day, "forecast-history", "trained_on", T.DateType())
    return anomaly.latest_training(stored, day="trained_on").drop("trained_on")


def _two(key):
    """Forecasts of two trainings, for series of one column."""
    return (
        f"series AS (SELECT {key} AS entity_id, date_trunc('hour', ts) AS ds, count(*)::DOUBLE AS y FROM events GROUP BY ALL)",
        """trainings AS (SELECT unnest([TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-15']) AS trained_at)""",
        """history AS (SELECT trained_at, s.* FROM series s JOIN trainings ON ds < trained_at)""",
        _fit_sql("history", _HOUR_SLOT, 3600, START, "entity_id, trained_at"),
        """ahead AS (SELECT trained_at, entity_id, unnest(generate_series(fit_end + INTERVAL 1 HOUR, fit_end + INTERVAL 168 HOUR, INTERVAL 1 HOUR)) AS ds,
  NULL::DOUBLE AS y FROM line)""",
        f"""forecast AS (SELECT entity_id, trained_at, ds, y, {_BAND} FROM (
  SELECT f.*, sigma, {_POINT} AS p FROM (
    SELECT *, {_HOUR_SLOT} AS slot FROM (SELECT * FROM history UNION ALL BY NAME SELECT * FROM ahead)) f
  JOIN line USING (entity_id, trained_at) JOIN spread USING (entity_id, trained_at)
  LEFT JOIN effect USING (entity_id, trained_at, slot)))""",
    )


_TWO = _two("event_type")


@register("forecast_history", "F11 A9", o.with_(*_TWO) + f"""
SELECT entity_id, trained_at, ds, y, {_FORECAST_OUT} FROM forecast""")
def forecast_history(spark, sf_dir):
    """Each training is appended to one table."""
    name, path = tables.fresh_name("forecast_history"), tables.fresh_path(spark, "forecast-history")
    for rows in _trainings(spark, sf_dir):
        table = tables.append_table(rows, name, path, ["trained_on"])
    return rounded(table.drop("trained_on"), *_BAND_COLS)


@register("latest_forecast", "C5 F11", o.with_(*_TWO) + f"""
SELECT entity_id, trained_at, ds, y, {_FORECAST_OUT} FROM forecast
WHERE trained_at = (SELECT max(trained_at) FROM forecast)""")
def latest_forecast(spark, sf_dir):
    return rounded(_latest(spark, sf_dir), *_BAND_COLS)


@register("anomalies", "F12 C3 B26 B27", o.with_(*_TWO) + f"""
SELECT s.entity_id, s.ds, s.y AS actual, {_FORECAST_OUT}, trained_at,
  CASE WHEN s.y < yhat_lower OR s.y > yhat_upper THEN 1 ELSE 0 END AS is_anomaly,
  round(CASE WHEN s.y < yhat_lower THEN yhat_lower - s.y WHEN s.y > yhat_upper THEN s.y - yhat_upper END, 6) AS anomaly_size
FROM series s JOIN forecast f ON s.entity_id = f.entity_id AND s.ds = f.ds
WHERE trained_at = (SELECT max(trained_at) FROM forecast)""")
def anomalies(spark, sf_dir):
    flagged = anomaly.flag_anomalies(_history(spark, sf_dir, FORECAST_END), _latest(spark, sf_dir))
    return rounded(flagged, *_BAND_COLS, "anomaly_size")


@register("anomalies_by_entity", "F12 C3 B26 B27", o.with_(*_two("user_id")) + f"""
, stored AS (SELECT entity_id, ds, trained_at, {_FORECAST_OUT} FROM forecast WHERE trained_at = TIMESTAMP '{END}')
SELECT s.entity_id, s.ds, s.y AS actual, yhat, yhat_lower, yhat_upper, trained_at,
  CASE WHEN s.y < yhat_lower OR s.y > yhat_upper THEN 1 ELSE 0 END AS is_anomaly,
  round(CASE WHEN s.y < yhat_lower THEN yhat_lower - s.y WHEN s.y > yhat_upper THEN s.y - yhat_upper END, 6) AS anomaly_size
FROM series s JOIN stored f ON s.entity_id = f.entity_id AND s.ds = f.ds""")
def anomalies_by_entity(spark, sf_dir):
    """Every entity's hours against its newest forecast. Sparse series fit without error, so bands are rounded before the test."""
    latest = _latest(spark, sf_dir, "user_id")
    flagged = anomaly.flag_anomalies(
        _history(spark, sf_dir, FORECAST_END, key="user_id"), rounded(latest, *_BAND_COLS), tables.tasks_for(latest, 500_000))
    return rounded(flagged, "anomaly_size")


@register("actuals_with_forecast", "C3", o.with_(*_TWO) + """
SELECT s.entity_id, s.y AS actual, round(yhat, 6) AS yhat FROM series s JOIN forecast f ON s.entity_id = f.entity_id AND s.ds = f.ds
WHERE s.ds = TIMESTAMP '2024-01-15' AND trained_at = TIMESTAMP '2024-01-15'""")
def actuals_with_forecast(spark, sf_dir):
    slot = F.col("ds") == F.lit("2024-01-15").cast("timestamp_ntz")
    fcs = _latest(spark, sf_dir).filter(slot).select("entity_id", "yhat")
    actual = _history(spark, sf_dir, "2024-01-15 01:00:00", "2024-01-15").filter(slot).select("entity_id", F.col("y").alias("actual"))
    return rounded(actual.join(fcs, "entity_id"), "yhat")


def _wanted_and_models(spark, sf_dir):
    """Ids of all entities, and the model table of the entities seen on the first day."""
    ids = adapters.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"))
    fitted = fc.model_table(fc.fit(_user_history(spark, sf_dir, DAY_END), fc.HOURLY, START), fc.Z95, START)
    return ids, tables.replace_table(fitted, tables.fresh_name("season_models"), tables.fresh_path(spark, "season-models"))


DAY_END = "2024-01-02"
_SEEN = f"SELECT user_id FROM events WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{DAY_END}'"


@register("series_without_model", "C6", f"""
SELECT c_custkey AS entity_id FROM customer WHERE c_custkey NOT IN ({_SEEN})""")
def series_without_model(spark, sf_dir):
    return ts.missing_models(*_wanted_and_models(spark, sf_dir))


@register("training_status", "C6", f"""
SELECT n_series, n_trained, CASE WHEN n_trained = 0 THEN 'failed' WHEN n_trained < n_series THEN 'partial' ELSE 'complete' END AS verdict
FROM (SELECT count(*) AS n_series, count(*) FILTER (WHERE c_custkey IN ({_SEEN})) AS n_trained FROM customer)""")
def training_status(spark, sf_dir):
    return ts.training_status(*_wanted_and_models(spark, sf_dir))


# fixed values: holidays inside the range of the event table
_HOLIDAYS = [("2024-01-01", "New Year's Day"), ("2024-01-15", "Martin Luther King Jr. Day")]


@register("series_with_holidays", "C7 A6", o.with_(o.SERIES) + """
SELECT entity_id, ds, y, CASE ds::DATE WHEN DATE '2024-01-01' THEN 'New Year''s Day' WHEN DATE '2024-01-15' THEN 'Martin Luther King Jr. Day' END AS holiday,
  CASE WHEN ds::DATE IN (DATE '2024-01-01', DATE '2024-01-15') THEN 1 ELSE 0 END AS is_holiday FROM series""")
def series_with_holidays(spark, sf_dir):
    calendar = files.literal_rows(spark, _HOLIDAYS, "day string, holiday string").withColumn("day", F.to_date("day"))
    return enrich.attach_calendar(_series(spark, sf_dir), calendar)


@register("chosen_entities", "E6 A6", """
SELECT event_id, user_id AS entity_id, ts FROM events WHERE user_id IN (3, 7, 11)""")
def chosen_entities(spark, sf_dir):
    ids = files.literal_rows(spark, [(3,), (7,), (11,)], "entity_id long")
    events = adapters.load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("entity_id"), "ts")
    return events.join(ids, "entity_id", "left_semi")


@register("curve_forecast", "F3 I2")
def curve_forecast(spark, sf_dir):
    return curvefit.forecast_or_error(_history(spark, sf_dir), curvefit.Spec(), 168)


@register("curve_forecast_daily", "F4")
def curve_forecast_daily(spark, sf_dir):
    """Weekly season and trend on daily counts, 90 days ahead."""
    days = ts.count_series(adapters.load(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "1 day")
    return curvefit.forecast_or_error(days, curvefit.Spec(daily_order=0), 90, step_seconds=86400)


@register("curve_changepoints", "F13")
def curve_changepoints(spark, sf_dir):
    return curvefit.changepoints(curvefit.fit(_history(spark, sf_dir), curvefit.Spec()))


@register("curve_models_predict", "F10 F9 I6")
def curve_models_predict(spark, sf_dir):
    hist = _history(spark, sf_dir)
    models = tables.materialize(curvefit.fit(hist, curvefit.Spec()), "curve-models")
    return curvefit.predict(curvefit.fitted(models), ts.future_grid(hist, 168, "HOUR"))


@register("curve_fit_failures", "F9 B14", """
SELECT o_custkey::VARCHAR || '-' || o_orderstatus AS entity_id, 'ValueError: needs observations at two different times' AS error
FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderdate) < 2""")
def curve_fit_failures(spark, sf_dir):
    """Series seen on one day only cannot be fitted; they end up here and the other fits go on."""
    orders = adapters.load(spark, sf_dir, "orders").withColumn(
        "series_id", scalar.series_key(["o_custkey", "o_orderstatus"]))
    days = ts.count_series(orders, "series_id", "o_orderdate", "1 day")
    plain = curvefit.Spec(daily_order=0)
    return curvefit.failed(curvefit.fit(days, plain)).select("entity_id", "error")


def _best(history):
    trials = curvefit.random_trials(10, seed=7, holidays=[day for day, _ in _HOLIDAYS])
    return curvefit.best_trials(curvefit.search(history, trials, FOLDS, HORIZON, SPACING, steps=False))


@register("forecast_search", "F8 F14")
def forecast_search(spark, sf_dir):
    return _best(_history(spark, sf_dir, RANGE_END))


def _auto(spark, hist):
    """Search, keep the best setting per series in the run ledger, forecast with it, store the rows."""
    best = tables.materialize(_best(hist), "best-trials")
    runs = best.select(
        F.concat_ws("-", F.lit("auto"), "entity_id").alias("run_id"), F.lit("auto").alias("name"),
        F.when(F.col("n_trials") > 0, "FINISHED").otherwise("FAILED").alias("status"),
        F.lit(RANGE_END).cast("timestamp_ntz").alias("started"), F.lit("events").alias("source_table"),
        F.create_map(F.lit("settings"), "params").alias("params"), F.create_map(F.lit("val_smape"), "smape").alias("metrics"))
    ledger.append_runs(runs, tables.fresh_name("runs"), tables.fresh_path(spark, "runs"))
    return best, tables.materialize(curvefit.forecast_with(best, hist, HORIZON), "auto-forecast")


@register("forecast_auto", "F14 F8 G13")
def forecast_auto(spark, sf_dir):
    return _auto(spark, _history(spark, sf_dir, RANGE_END))[1]


@register("forecast_auto_by_entity", "F14 F8 F3", f"""
WITH hours AS (SELECT user_id::VARCHAR AS entity_id, date_trunc('hour', ts) AS ds FROM events
  WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{RANGE_END}' GROUP BY ALL),
last AS (SELECT entity_id, max(ds) + INTERVAL 1 HOUR AS e, count(*) AS n FROM hours GROUP BY 1),
seen AS (SELECT entity_id, n, count(*) FILTER (WHERE ds < e - INTERVAL {HORIZON} HOUR) > 1 AS fits FROM hours JOIN last USING (entity_id) GROUP BY 1, 2)
SELECT entity_id, CASE WHEN fits THEN 10 ELSE 0 END AS n_trials, CASE WHEN fits THEN n + {HORIZON} ELSE 0 END AS n_rows,
  CASE WHEN fits THEN 0 ELSE 1 END AS n_errors, CASE WHEN fits THEN {HORIZON} ELSE 0 END AS n_ahead, 1 AS bands_ordered FROM seen""")
def forecast_auto_by_entity(spark, sf_dir):
    """Automatic forecast of every entity, counted per entity: a forecast, or one row with the error."""
    best, rows = _auto(spark, _user_history(spark, sf_dir, RANGE_END))
    done = F.col("error").isNull()
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    counted = rows.groupBy("entity_id").agg(
        F.count_if(done).alias("n_rows"), F.count_if(~done).alias("n_errors"), F.count_if(done & F.col("y").isNull()).alias("n_ahead"),
        F.bool_and(~done | ordered).cast("int").alias("bands_ordered"))
    return best.select("entity_id", "n_trials").join(counted, "entity_id")
