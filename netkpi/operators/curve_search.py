"""Search of curve settings by successive halving over folds, with a time limit per trial that holds where the trial runs.

All trials of a series start on one held-out fold. After each round the better part of them goes on to more folds; what a
trial has already done is kept, not done again. The last ones have been through every fold, so their errors are those of
a full search. A trial that takes longer than its limit ends in its worker and becomes an error row, and drops out.
"""
from __future__ import annotations

import json
import signal
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from netkpi.operators.curvefit import Spec, _points, _table, fit_one, predict_one
from netkpi.sources.tables import materialize

FOLD_ROW = T.StructType([
    T.StructField("entity_id", T.StringType()), T.StructField("trial", T.IntegerType()), T.StructField("fold", T.IntegerType()),
    T.StructField("n", T.IntegerType()), T.StructField("shares", T.DoubleType()), T.StructField("error", T.StringType())])


@contextmanager
def time_limit(seconds: float | None) -> Iterator[None]:
    """Raise TimeoutError in the worker's main thread once the time is over; without a main thread there is no limit."""
    if not seconds or threading.current_thread() is not threading.main_thread():
        yield
        return

    def over(*_) -> None:
        raise TimeoutError(f"over {seconds:g} s")

    before = signal.signal(signal.SIGALRM, over)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def shares(y: np.ndarray, yhat: np.ndarray) -> float:
    """Sum of symmetric relative errors; 0 where both are 0."""
    size = np.abs(y) + np.abs(yhat)
    return float(np.sum(np.divide(2 * np.abs(y - yhat), size, out=np.zeros_like(size), where=size > 0)))


def schedule(folds: int, trials: int, eta: int) -> list[tuple[int, int]]:
    """Rounds of (folds done by its end, trials in it): folds grow by eta to all of them, trials fall by eta to one at least."""
    out, done = [], 1
    while True:
        out.append((min(done, folds), trials))
        if done >= folds:
            return out
        done, trials = done * eta, max(1, -(-trials // eta))


def _tried(trials: Sequence[Spec], folds: Sequence[int], horizon_hours: int, spacing_hours: int, limit: float | None, fit=fit_one):
    """Errors of one trial of one series on some folds; the limit is for all of them together."""
    hour = 3600 * 1_000_000

    def one(key: tuple, table: pa.Table) -> pa.Table:
        micros, y = _points(table)
        entity, number, end = key[0].as_py(), key[1].as_py(), micros[-1] + hour
        rows: list[tuple] = []
        try:
            with time_limit(limit):
                for fold in folds:
                    cut = end - horizon_hours * hour - fold * spacing_hours * hour
                    seen, held = micros < cut, (micros >= cut) & (micros < cut + horizon_hours * hour)
                    if not held.any():
                        continue
                    model = fit(micros[seen] / 1e6, y[seen], trials[number])
                    rows.append((fold, int(held.sum()), shares(y[held], predict_one(model, micros[held] / 1e6)["yhat"]), None))
        except Exception as e:
            rows.append((None, None, None, f"{type(e).__name__}: {e}"))
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        return _table(FOLD_ROW, {"entity_id": [entity] * len(rows), "trial": [number] * len(rows),
                                 **{n: list(c) for n, c in zip(("fold", "n", "shares", "error"), cols, strict=True)}})
    return one


def search_halving(history: DataFrame, trials: Sequence[Spec], folds: int, horizon_hours: int, spacing_hours: int | None = None,
                   eta: int = 3, limit: float | None = None, fit=fit_one) -> DataFrame:
    """One row per series and trial: params, rounds it was in, folds and steps it was held against, smape over them, error.

    A task holds one trial of one series. limit: seconds for a trial's folds of one round.
    """
    spark = history.sparkSession
    params = [json.dumps(asdict(t)) for t in trials]
    rows = materialize(history.filter(F.col("y").isNotNull()).select(
        F.col("entity_id").cast("string").alias("entity_id"), "ds", F.col("y").cast("double").alias("y")), "halving-history")
    numbers = F.explode(F.array(*[F.lit(i) for i in range(len(trials))])).alias("trial")
    active = materialize(rows.select("entity_id").distinct().select("entity_id", numbers), "halving-active")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found, before, scored = None, 0, None
    plan = schedule(folds, len(trials), eta)
    for i, (upto, _) in enumerate(plan):
        run = _tried(trials, range(before, upto), horizon_hours, spacing_hours or horizon_hours, limit, fit)
        new = (rows.join(active, "entity_id").repartition(tasks, "entity_id", "trial").groupBy("entity_id", "trial").applyInArrow(run, FOLD_ROW)
               .withColumn("round", F.lit(i + 1)))
        new = materialize(new, "halving-folds")
        found, before = new if found is None else found.unionByName(new), upto
        scored = found.groupBy("entity_id", "trial").agg(
            F.max("round").alias("rounds"), F.count("fold").alias("n_folds"), F.sum("n").alias("n_steps"),
            F.when(F.count("error") == 0, F.sum("shares") / F.sum("n")).alias("smape"), F.min("error").alias("error"))
        scored = materialize(scored, "halving-scores")
        if i + 1 < len(plan):
            order = Window.partitionBy("entity_id").orderBy("smape", "trial")
            active = materialize(scored.filter((F.col("rounds") == i + 1) & F.col("smape").isNotNull()).withColumn("_rn", F.row_number().over(order))
                                 .filter(F.col("_rn") <= plan[i + 1][1]).select("entity_id", "trial"), "halving-active")
    text = F.element_at(F.array(*[F.lit(p) for p in params]), F.col("trial") + 1)
    return scored.withColumn("params", text)


def best_halved(results: DataFrame) -> DataFrame:
    """The trial with the least error among those of the last round of each series; trial number breaks ties. As `best_trials` gives them."""
    worked = F.col("smape").isNotNull()
    best = F.min_by(F.struct("trial", "params", "smape"), F.when(worked, F.struct(-F.col("rounds"), F.col("smape"), F.col("trial"))))
    return results.groupBy("entity_id").agg(best.alias("b"), F.count_if(worked).alias("n_trials"), F.min("error").alias("_error")).select(
        "entity_id", "b.*", "n_trials", F.when(F.col("n_trials") == 0, F.col("_error")).alias("error"))
