"""Run ledger: one row per training run, appended, and the two look-ups made on it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netkpi.operators.ordering import top_rows, top_rows_per_group
from netkpi.sources.tables import append_table


def append_runs(runs: DataFrame, name: str, path: str | None = None) -> DataFrame:
    return append_table(runs, name, path)


def newest_run(runs: DataFrame, name: str) -> DataFrame:
    return top_rows(runs.filter(F.col("name") == name), [F.col("started").desc(), F.col("run_id").desc()], 1)


def newest_run_per_name(runs: DataFrame) -> DataFrame:
    """Each map task keeps one row per name before the shuffle."""
    order = [F.col("started").desc(), F.col("run_id").desc()]
    return top_rows_per_group(runs, ["name"], order, 1).drop("position")


def _ordered(metric: Column, lower_is_better: bool) -> list[Column]:
    by = metric.asc_nulls_last() if lower_is_better else metric.desc_nulls_last()
    return [by, F.col("run_id").asc()]


def best_run(runs: DataFrame, metric: Column, lower_is_better: bool = True) -> DataFrame:
    """Best finished run; runs without the metric come last, run_id breaks ties."""
    return top_rows(runs.filter(F.col("status") == "FINISHED"), _ordered(metric, lower_is_better), 1)
