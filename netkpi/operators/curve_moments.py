"""Curve models that grow with their history: what a fit needs of a part of a series is a few sums, and sums add up.

For a fixed frame (start, span and bends of the trend) the normal equations of the penalised squares hold only X'X, X'y and y'y.
They are taken once per series and part (say, a day), stored, and added up; the model is solved from the sums, without reading
history again. A part that is done anew replaces its sums. Only additive seasons: a multiplicative one is fitted to the
values left by the trend, which sums do not hold.
"""
from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from netkpi import schemas
from netkpi.operators.curvefit import Spec, _points, _ridge_solve, _seasons, _table, _trend_columns, knot_count, priors
from netkpi.sources.versions import VersionedTable

MOMENT_ROW = T.StructType([
    T.StructField("entity_id", T.StringType()), T.StructField("part", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("gram", T.ArrayType(T.DoubleType())), T.StructField("cross", T.ArrayType(T.DoubleType())), T.StructField("squares", T.DoubleType()),
    T.StructField("first", T.TimestampNTZType()), T.StructField("last", T.TimestampNTZType())])


@dataclass(frozen=True)
class Frame:
    """Seconds of the first and last planned step, and the number of bends."""
    start: float
    span: float
    knots: int

    @classmethod
    def planned(cls, first: str, last: str, step_seconds: int, spec: Spec) -> "Frame":
        """Of a range of wall-clock times with steps of a known size."""
        start, end = (float(np.datetime64(x, "s").astype("int64")) for x in (first, last))
        return cls(start, end - start, knot_count(spec, int((end - start) // step_seconds) + 1))

    def design(self, sec: np.ndarray, spec: Spec) -> np.ndarray:
        knots = np.linspace(0, 0.8, self.knots + 1)[1:]
        return np.hstack([_trend_columns((sec - self.start) / self.span, knots), _seasons(sec, spec)])


def part_moments(history: DataFrame, part: Column, frame: Frame, spec: Spec) -> DataFrame:
    """Sums per series and part; history: entity_id, ds, y. A group is one part of one series."""
    if spec.multiplicative:
        raise ValueError("a multiplicative season cannot be fitted from sums")
    rows = history.filter(F.col("y").isNotNull()).select(
        F.col("entity_id").cast("string").alias("entity_id"), "ds", F.col("y").cast("double").alias("y"), part.cast("long").alias("part"))

    def one(key: tuple, table: pa.Table) -> pa.Table:
        micros, y = _points(table)
        x = frame.design(micros / 1e6, spec)
        gram = (x.T @ x)[np.triu_indices(x.shape[1])]
        return pa.table({
            "entity_id": pa.array([key[0].as_py()]), "part": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([len(y)], pa.int64()),
            "gram": pa.array([gram.tolist()], pa.list_(pa.float64())), "cross": pa.array([(x.T @ y).tolist()], pa.list_(pa.float64())),
            "squares": pa.array([float(y @ y)]), "first": pa.array(micros[:1].astype("datetime64[us]"), pa.timestamp("us")),
            "last": pa.array(micros[-1:].astype("datetime64[us]"), pa.timestamp("us"))})

    return rows.groupBy("entity_id", "part").applyInArrow(one, MOMENT_ROW)


def store(table: VersionedTable, moments: DataFrame) -> None:
    """Put parts into the table, in the place of their earlier sums."""
    table.merge(moments, ["entity_id", "part"], F.col("part"))


def _solved(gram: np.ndarray, cross: np.ndarray, squares: float, n: int, frame: Frame, spec: Spec) -> dict:
    """The model that a fit of all rows in this frame gives."""
    if n < 2 or not np.all(np.isfinite(cross)):
        raise ValueError("needs two observations, all finite")
    level = cross[0] / n  # the first column of the design is one
    size = float(np.sqrt(max(squares / n - level ** 2, 0.0))) or 1.0
    ones = gram[0]
    standard = (cross - level * ones) / size
    n_season = len(cross) - 2 - frame.knots
    both = _ridge_solve(gram, standard, np.concatenate(priors(spec, frame.knots, n_season)), 0.5)
    a, b = both[:2 + frame.knots], both[2 + frame.knots:]
    variance = (squares - n * level ** 2) / size ** 2
    left = variance - 2 * both @ standard + both @ gram @ both
    return {
        "start": frame.start, "span": frame.span, "level": level, "size": size, "knots": np.linspace(0, 0.8, frame.knots + 1)[1:].tolist(),
        "trend": a.tolist(), "season": b.tolist(), "multiplicative": False, "sigma": float(np.sqrt(max(left, 0.0) / n) * size),
        "slope_spread": float(np.mean(np.abs(a[2:]))) if frame.knots else 0.0, "spec": asdict(spec)}


def models(moments: DataFrame, frame: Frame, spec: Spec) -> DataFrame:
    """One model (or error) per series from its stored parts; as `curvefit.fit` gives them, for its `predict` and `changepoints`.

    A group holds the sums of one series, one row per part.
    """
    params = json.dumps(asdict(spec))

    def one(key: tuple, table: pa.Table) -> pa.Table:
        n, model, error = int(sum(table.column("n").to_pylist())), None, None
        try:
            cross = np.sum(table.column("cross").to_pylist(), axis=0)
            gram = np.zeros((len(cross), len(cross)))
            upper = np.triu_indices(len(cross))
            gram[upper] = np.sum(table.column("gram").to_pylist(), axis=0)
            gram = gram + np.triu(gram, 1).T
            model = json.dumps(_solved(gram, cross, float(sum(table.column("squares").to_pylist())), n, frame, spec))
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        return _table(schemas.CURVE_MODEL_ROW, {
            "entity_id": [key[0].as_py()], "model_json": model, "params": params, "error": error,
            "fit_start": pa.array([min(table.column("first").to_pylist())], pa.timestamp("us")),
            "fit_end": pa.array([max(table.column("last").to_pylist())], pa.timestamp("us"))})

    return moments.groupBy("entity_id").applyInArrow(one, schemas.CURVE_MODEL_ROW)
