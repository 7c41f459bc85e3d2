"""Curve fits held against what defines them: the optimum of the penalised squares, computed anew from data and result."""
from pyspark.sql import functions as F

from netkpi.operators import curve_moments, curve_paths, curve_search, curvefit, series as ts
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register
from netkpi.plans.series_queries import _history
from netkpi.sources import adapters, tables
from netkpi.sources.versions import VersionedTable

_MODEL = "start DOUBLE, span DOUBLE, size DOUBLE, knots ARRAY<DOUBLE>, trend ARRAY<DOUBLE>, season ARRAY<DOUBLE>"
#: Noise deviation that the solver assumes on the standardised series.
_NOISE = 0.5


def _gaps(points, models, spec):
    """Per series the largest gap in X'(v - Xb) = Pb, with v and Xb standardised, P the penalties and b the coefficients."""
    m = F.from_json("model_json", _MODEL)
    rows = points.join(models.select("entity_id", m.alias("m")), "entity_id")
    sec = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ds")) / 1e6
    t = (sec - F.col("m.start")) / F.col("m.span")
    waves = [f(F.lit(2 * 3.141592653589793 * k / period) * sec)
             for period, order in ((86400, spec.daily_order), (7 * 86400, spec.weekly_order))
             for k in range(1, order + 1) for f in (F.sin, F.cos)]
    x = F.concat(F.array(F.lit(1.0), t), F.transform("m.knots", lambda k: F.greatest(t - k, F.lit(0.0))), F.array(*waves))

    def pull(coefficients, scale):
        return F.transform(coefficients, lambda b: b * (_NOISE / scale) ** 2)

    own = F.slice("m.trend", F.lit(3), F.size("m.knots"))
    pb = F.concat(F.array(F.lit(0.0), F.lit(0.0)), pull(own, spec.changepoint_scale), pull(F.col("m.season"), spec.season_scale))
    terms = rows.select("entity_id", ((F.col("y") - F.col("yhat")) / F.col("m.size")).alias("r"), F.posexplode(F.arrays_zip(x.alias("x"), pb.alias("pb"))))
    sums = terms.groupBy("entity_id", "pos").agg(F.abs(F.sum(F.col("col.x") * F.col("r")) - F.first("col.pb")).alias("gap"))
    return sums.groupBy("entity_id").agg(F.max("gap").alias("gap"))


def _checked(history, spec, horizon, step_seconds):
    models = tables.materialize(curvefit.fit(history, spec), "curve-models")
    rows = tables.materialize(curvefit.forecast(history, spec, horizon, step_seconds), "curve-forecast")
    unit = "HOUR" if step_seconds == 3600 else "DAY"
    stored = curvefit.predict(curvefit.fitted(models), ts.future_grid(history, horizon, unit))
    again = rows.join(stored.select("entity_id", "ds", F.col("yhat").alias("_again")), ["entity_id", "ds"], "left")
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    same = F.col("y").isNotNull() | (F.abs(F.col("yhat") - F.col("_again")) < 1e-6)
    counted = again.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("y").isNull()).alias("n_ahead"),
        F.max("ds").alias("last_ds"), F.bool_and(ordered).cast("int").alias("bands_ordered"),
        F.coalesce(F.bool_and(same), F.lit(False)).cast("int").alias("stored_models_agree"))
    ends = models.select("entity_id", "fit_start", "fit_end")
    bends = curvefit.changepoints(models).join(ends, "entity_id").groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_bends"),
        F.bool_and((F.col("ds") > F.col("fit_start")) & (F.col("ds") < F.col("fit_end"))).cast("int").alias("bends_in_history"))
    gaps = _gaps(rows.filter("y is not null"), models, spec).select("entity_id", (F.col("gap") < 1e-5).cast("int").alias("is_optimal"))
    return counted.join(gaps, "entity_id").join(bends, "entity_id")


def _checks_sql(history, horizon, unit):
    return f"""
SELECT entity_id, count(*) + {horizon} AS n_rows, {horizon} AS n_ahead, max(ds) + INTERVAL {horizon} {unit} AS last_ds,
  1 AS bands_ordered, 1 AS stored_models_agree, least(25, floor(0.8 * count(*))::BIGINT - 1) AS n_bends, 1 AS bends_in_history, 1 AS is_optimal
FROM {history} GROUP BY 1"""


@register("curve_forecast_checks", "F3 F9 F10 F13 I2 I6", o.with_(o.SERIES) + _checks_sql("history", 168, "HOUR"))
def curve_forecast_checks(spark, sf_dir):
    return _checked(_history(spark, sf_dir), curvefit.Spec(), 168, 3600)


@register("curve_forecast_daily_checks", "F4 F9 F10 F13 I2 I6", """
WITH days AS (SELECT o_orderpriority AS entity_id, o_orderdate AS ds FROM orders GROUP BY 1, 2)""" + _checks_sql("days", 90, "DAY"))
def curve_forecast_daily_checks(spark, sf_dir):
    days = ts.count_series(adapters.load(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "1 day")
    return _checked(days, curvefit.Spec(daily_order=0), 90, 86400)


@register("curve_models_merged", "F10", o.with_(o.SERIES) + "SELECT entity_id, count(*) AS n_points, 14 AS n_parts, 1 AS as_refitted FROM history GROUP BY 1")
def curve_models_merged(spark, sf_dir):
    """Ten days of sums are stored, four more are added and one is done again; the models are those of a fit of all rows."""
    spec, history = curvefit.Spec(), tables.materialize(_history(spark, sf_dir), "merged-history")
    frame = curve_moments.Frame.planned("2024-01-01T00:00:00", "2024-01-14T23:00:00", 3600, spec)
    day = F.datediff(F.col("ds").cast("date"), F.lit("2024-01-01").cast("date"))
    table = VersionedTable(spark, tables.fresh_path(spark, "curve-sums"))
    for days in (day < 10, day >= 10, day == 4):
        curve_moments.store(table, curve_moments.part_moments(history.filter(days), day, frame, spec))
    merged = tables.materialize(curve_moments.models(table.read(), frame, spec), "merged-models")
    whole = curve_moments.part_moments(history, F.lit(0), frame, spec)  # the same sums, taken at once
    again = curvefit.predict(curve_moments.models(whole, frame, spec), history).select("entity_id", "ds", F.col("yhat").alias("_again"))
    gap = F.max(F.abs(F.col("yhat") - F.col("_again")))
    same = curvefit.predict(merged, history).join(again, ["entity_id", "ds"]).groupBy("entity_id").agg((gap < 1e-6).cast("int").alias("as_refitted"))
    counts = table.read().groupBy("entity_id").agg(F.sum("n").alias("n_points"), F.count(F.lit(1)).cast("int").alias("n_parts"))
    return counts.join(same, "entity_id").select("entity_id", "n_points", "n_parts", "as_refitted")


@register("forecast_search_halving", "F8 F14", o.with_(o.SERIES) + """
SELECT entity_id, 9 AS in_first, 3 AS in_second, 1 AS in_last, count(*) FILTER (WHERE ds > last - INTERVAL 120 HOUR) AS steps_of_last, 1 AS as_full_search
FROM (SELECT *, max(ds) OVER (PARTITION BY entity_id) AS last FROM history) GROUP BY 1""")
def forecast_search_halving(spark, sf_dir):
    """Nine trials on one day, three on three, one on five; the last one's error is that of a search of all trials on all days."""
    history, trials = tables.materialize(_history(spark, sf_dir), "halving-input"), curvefit.random_trials(9, 11)
    tried = tables.materialize(curve_search.search_halving(history, trials, 5, 24, limit=120.0), "halving-tried")
    err, size = F.abs(F.col("y") - F.col("yhat")), F.abs("y") + F.abs("yhat")
    full = curvefit.search(history, trials, 5, 24).groupBy("entity_id", "trial").agg(
        F.avg(F.when(size == 0, 0.0).otherwise(2 * err / F.nullif(size, F.lit(0.0)))).alias("full"))
    best = curve_search.best_halved(tried).select("entity_id", "trial", "smape")
    same = best.join(full, ["entity_id", "trial"]).select("entity_id", (F.abs(F.col("smape") - F.col("full")) < 1e-9).cast("int").alias("as_full_search"))
    counts = tried.groupBy("entity_id").agg(
        *[F.count_if(F.col("rounds") >= k).cast("int").alias(n) for k, n in ((1, "in_first"), (2, "in_second"), (3, "in_last"))],
        F.max("n_steps").alias("steps_of_last"))
    return counts.join(same, "entity_id")


@register("curve_forecast_paths", "F3 F4")
def curve_forecast_paths(spark, sf_dir):
    """Forecast of every series with 80 % bands from a thousand simulated trends."""
    return curve_paths.forecast_paths(_history(spark, sf_dir), curvefit.Spec(), 168)


def _planted(models, drawn):
    """`drawn` futures of each series, told by hashes: moments of change by exponential gaps, sizes by the inverse of the
    Laplace distribution, noise by Box and Muller. One row per series, future and step, with the departure from the trend."""
    m = F.from_json("model_json", _MODEL + ", slope_spread DOUBLE, sigma DOUBLE")
    tasks = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    futures = models.select("entity_id", m.alias("m"), F.explode(F.sequence(F.lit(1), F.lit(drawn))).alias("future")).select(
        "entity_id", "future", *[F.col(f"m.{c}") for c in ("span", "size", "slope_spread", "sigma")], F.size("m.knots").alias("bends")).repartition(tasks, "future")

    def uniform(what, i):
        """Above 0 and below 1."""
        return (F.shiftrightunsigned(F.xxhash64("entity_id", "future", F.lit(what), i), 12) + 0.5) / F.lit(float(1 << 52))

    rate = F.col("bends") / 0.8
    mean = rate * 168 * 3600 / F.col("span")
    numbers = F.sequence(F.lit(1), F.ceil(mean + 10 * F.sqrt(mean) + 10).cast("int"))
    u = lambda i: uniform("size", i) - 0.5
    changes = F.transform(numbers, lambda i: F.struct(
        (-F.log(uniform("gap", i)) / rate).alias("gap"),
        (-F.signum(u(i)) * F.log(1 - 2 * F.abs(u(i))) * F.col("slope_spread") * F.col("size")).alias("step")))

    def moved(t):
        start = F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("sum"))
        return F.aggregate("changes", start, lambda s, c: F.struct(
            (s["at"] + c["gap"]).alias("at"), (s["sum"] + c["step"] * F.greatest(t - s["at"] - c["gap"], F.lit(0.0))).alias("sum")))["sum"]
    steps = futures.withColumn("changes", changes).select("*", F.explode(F.array(F.lit(24), F.lit(84), F.lit(168))).alias("step"))
    noise = F.sqrt(-2 * F.log(uniform("radius", F.col("step")))) * F.cos(2 * 3.141592653589793 * uniform("angle", F.col("step")))
    return steps.select("entity_id", "step", (moved(F.col("step") * 3600 / F.col("span")) + F.col("sigma") * noise).alias("departure"))


@register("curve_paths_checks", "F3 F4", o.with_(o.SERIES) + """
SELECT entity_id, count(*) + 168 AS n_rows, 168 AS n_ahead, 1 AS bands_ordered, 1 AS as_stored_models, 1 AS covers_80, 1 AS covers_95
FROM history GROUP BY 1""")
def curve_paths_checks(spark, sf_dir):
    """Bands hold their share, within two points, of futures that Spark draws from the models by other means; reruns agree."""
    spec, history = curvefit.Spec(), tables.materialize(_history(spark, sf_dir), "paths-history")
    models = tables.materialize(curvefit.fitted(curvefit.fit(history, spec)), "paths-models")
    rows = tables.materialize(curve_paths.forecast_paths(history, spec, 168), "paths-forecast")
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    counts = rows.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("y").isNull()).alias("n_ahead"),
                                           F.bool_and(ordered).cast("int").alias("bands_ordered"))
    # the same draws for the same grid, whatever the partitions and whether the model was stored
    again = curve_paths.predict_paths(models, rows.select("entity_id", "ds", "y").repartition(3)).select(
        "entity_id", "ds", F.col("yhat_lower").alias("_low"), F.col("yhat_upper").alias("_high"))
    apart = F.abs(F.col("yhat_lower") - F.col("_low")) + F.abs(F.col("yhat_upper") - F.col("_high"))
    out = counts.join(rows.join(again, ["entity_id", "ds"], "left").groupBy("entity_id").agg(
        F.coalesce(F.bool_and(F.coalesce(apart, F.lit(1.0)) < 1e-6), F.lit(False)).cast("int").alias("as_stored_models")), "entity_id")
    futures = tables.materialize(_planted(models, 10_000), "paths-planted")
    step = F.timestamp_diff("HOUR", F.col("fit_end"), F.col("ds")).cast("int")
    grid = rows.filter("y is null").select("entity_id", "ds")
    for share in (80, 95):
        bands = curve_paths.predict_paths(models, grid, curve_paths.Paths(20_000, share / 100)).join(models.select("entity_id", "fit_end"), "entity_id").select(
            "entity_id", step.alias("step"), "yhat", "yhat_lower", "yhat_upper")
        value = F.col("yhat") + F.col("departure")
        held = futures.join(F.broadcast(bands.filter(F.col("step").isin(24, 84, 168))), ["entity_id", "step"]).groupBy("entity_id", "step").agg(
            F.avg(value.between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")).alias("share"))
        worst = F.max(F.abs(F.col("share") - share / 100))
        out = out.join(held.groupBy("entity_id").agg(((worst <= 0.02) & (F.count(F.lit(1)) == 3)).cast("int").alias(f"covers_{share}")), "entity_id")
    return out
