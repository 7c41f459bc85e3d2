"""Stored sums and sketches: models and profiles from parts against those of all rows at once."""
from datetime import datetime as dt, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from netkpi.operators import curve_moments, curvefit, sketches
from netkpi.sources import tables
from netkpi.sources.versions import VersionedTable

SPEC = curvefit.Spec(daily_order=2, weekly_order=1)


def series(spark, hours=24 * 14):
    rows = [(e, dt(2024, 1, 1) + timedelta(hours=h), 5.0 * k + 0.02 * h + np.sin(h / 24 * 2 * np.pi) + (h * 37 % 11) / 5)
            for k, e in enumerate(("a", "b")) for h in range(hours) if (h + k) % 5]
    return spark.createDataFrame([(e, t, float(y)) for e, t, y in rows] + [("a", dt(2024, 1, 1), None)], "entity_id string, ds timestamp_ntz, y double")


def test_sums_of_parts_give_the_model_of_all_rows(spark):
    history = series(spark)
    frame = curve_moments.Frame.planned("2024-01-01T00:00:00", "2024-01-14T23:00:00", 3600, SPEC)
    day = F.dayofmonth("ds")
    got = curve_moments.models(curve_moments.part_moments(history, day, frame, SPEC), frame, SPEC)
    rows = {r["entity_id"]: r for r in got.collect()}
    assert all(r["error"] is None for r in rows.values()) and rows["b"]["fit_end"] == dt(2024, 1, 14, 23)
    import json

    for e in ("a", "b"):
        pts = history.filter((F.col("entity_id") == e) & F.col("y").isNotNull()).orderBy("ds").toPandas()
        sec = pts["ds"].to_numpy().astype("datetime64[us]").astype("int64") / 1e6
        want = curvefit.fit_one(sec, pts["y"].to_numpy(), SPEC, (frame.start, frame.span, frame.knots))
        model = json.loads(rows[e]["model_json"])
        for k in ("level", "size", "sigma", "slope_spread", "trend", "season", "knots"):
            assert model[k] == pytest.approx(want[k], abs=1e-6), k
        ahead = sec[-1] + 3600 * np.arange(1, 50)
        for k, v in curvefit.predict_one(want, ahead).items():
            assert curvefit.predict_one(model, ahead)[k] == pytest.approx(v, abs=1e-6)


def test_a_part_done_again_replaces_its_sums(spark):
    history = series(spark)
    frame = curve_moments.Frame.planned("2024-01-01T00:00:00", "2024-01-14T23:00:00", 3600, SPEC)
    table = VersionedTable(spark, tables.fresh_path(spark, "sums"))
    wrong = history.withColumn("y", F.when(F.dayofmonth("ds") == 3, F.lit(1e6)).otherwise(F.col("y")))
    curve_moments.store(table, curve_moments.part_moments(wrong, F.dayofmonth("ds"), frame, SPEC))
    curve_moments.store(table, curve_moments.part_moments(history.filter("dayofmonth(ds) = 3"), F.dayofmonth("ds"), frame, SPEC))
    once = curve_moments.models(curve_moments.part_moments(history, F.lit(0), frame, SPEC), frame, SPEC)
    both = curvefit.predict(curve_moments.models(table.read(), frame, SPEC), history).join(
        curvefit.predict(once, history).select("entity_id", "ds", F.col("yhat").alias("again")), ["entity_id", "ds"])
    assert both.agg(F.max(F.abs(F.col("yhat") - F.col("again")))).first()[0] < 1e-6 and table.read().count() == 28


def test_series_that_cannot_be_fitted_are_error_rows(spark):
    frame = curve_moments.Frame.planned("2024-01-01T00:00:00", "2024-01-02T00:00:00", 3600, SPEC)
    one = spark.createDataFrame([("x", dt(2024, 1, 1), 1.0), ("y", dt(2024, 1, 1), float("nan")), ("y", dt(2024, 1, 1, 1), 1.0)],
                                "entity_id string, ds timestamp_ntz, y double")
    got = curve_moments.models(curve_moments.part_moments(one, F.lit(1), frame, SPEC), frame, SPEC)
    assert got.count() == 2 and curvefit.failed(got).count() == 2
    with pytest.raises(ValueError):
        curve_moments.part_moments(one, F.lit(1), frame, curvefit.Spec(multiplicative=True))


def table_of(spark):
    return spark.range(30_000).select(
        (F.col("id") % 30).alias("day"), (F.col("id") * 7919 % 10007).cast("double").alias("x"), (F.col("id") % 90).cast("int").alias("k"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), (F.col("id") * F.col("id") % 13).cast("string"))).alias("s"),
        F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("t"))


def test_profile_of_merged_parts_is_within_the_stated_bounds(spark):
    df, columns = table_of(spark), ["x", "k", "s", "t"]
    stored = tables.materialize(sketches.part_sketches(df, F.col("day"), columns), "sketches")
    for low, high in ((None, None), (3, 9), (29, 29)):
        rows = df if low is None else df.filter(F.col("day").between(low, high))
        pdf = rows.toPandas()
        got = {r["column"]: r for r in sketches.profile(stored, low, high).collect()}
        assert set(got) == set(columns)
        for c in columns:
            r, held = got[c], pdf[c].dropna()
            assert r["n_rows"] == len(pdf) and r["missing"] == len(pdf) - len(held)
            assert abs(r["n_distinct"] - held.nunique()) <= max(1, 4 * 1.04 / 64 * held.nunique())
        x = pdf["x"]
        assert got["x"]["mean"] == pytest.approx(x.mean()) and got["x"]["std"] == pytest.approx(x.std()) and got["x"]["max"] == x.max()
        for name, q in sketches.QUANTILES.items():
            assert (x < got["x"][name]).mean() - 0.02 <= q <= (x <= got["x"][name]).mean() + 0.02
        top = pdf["s"].value_counts()
        assert got["s"]["top_count"] == top.iloc[0] and top[got["s"]["top"]] == top.iloc[0]
    t = sketches.profile(stored).filter("column = 't'").select(sketches.as_time(F.col("min")).alias("a"), sketches.as_time(F.col("max")).alias("b")).first()
    assert (t["a"], t["b"]) == (dt(2024, 1, 1), dt(2024, 1, 1) + timedelta(seconds=29_999))


def test_profile_of_empty_and_missing_columns(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, float("nan"))], "day int, s string, x double")
    got = {r["column"]: r for r in sketches.profile(sketches.part_sketches(df, F.col("day"), ["s", "x"])).collect()}
    assert got["s"]["missing"] == 2 and got["s"]["top"] is None and got["s"]["n_distinct"] == 0
    assert got["x"]["n_rows"] == 2 and got["x"]["mean"] is None and got["x"]["median"] is None
    assert sketches.profile(sketches.part_sketches(df.limit(0), F.col("day"), ["s", "x"])).count() == 0
