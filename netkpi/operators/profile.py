"""Table profile: what a data profiling view shows, as rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netkpi.operators.ordering import running_totals

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def _long(one_row: DataFrame, columns: Sequence[str], stats: dict) -> DataFrame:
    items = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}__{i}").alias(s) for s in stats])
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*items)))


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column from one pass without a shuffle of rows."""
    stats = {
        "n_rows": lambda c: F.count(F.lit(1)),
        "missing": lambda c: F.count_if(c.isNull()),
        "zeros": lambda c: F.count_if(c == 0),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
    }
    one = df.agg(*[
        fn(F.col(c).cast("double")).alias(f"{s}__{i}") for i, c in enumerate(columns) for s, fn in stats.items()])
    return _long(one, columns, stats)


def value_counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(column, exact, value, n) without NULLs; equal values meet in the map tasks first.

    `exact` is the value in its own type as text, so that large integers which share a double stay apart.
    """
    def exact(c: str) -> Column:
        same_zero = F.when(F.col(c) == 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)) if kind == "double" else F.col(c)
        return same_zero.cast("string")

    items = [F.struct(F.lit(c).alias("column"), exact(c).alias("exact"), F.col(c).cast(kind).alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*items))).filter(F.col("value").isNotNull())
        .groupBy("column", "exact", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quartiles(counts: DataFrame) -> DataFrame:
    """Interpolated quartiles per column from distinct values and their counts."""
    by_value = counts.groupBy("column", "value").agg(F.sum("n").alias("n"))
    ranked = running_totals(by_value, ["column"], "value", ["n"], bounded_groups=True)

    def value_at(rank: Column) -> Column:
        hit = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    aggs = []
    for name, q in QUARTILES.items():
        rank = (F.col("n_total") - 1) * F.lit(q)
        aggs += [value_at(F.floor(rank)).alias(f"{name}_lo"), value_at(F.ceil(rank)).alias(f"{name}_hi"),
                 F.max(rank - F.floor(rank)).alias(f"{name}_part")]
    wide = ranked.groupBy("column").agg(*aggs)
    return wide.select("column", *[
        (F.col(f"{n}_lo") + F.col(f"{n}_part") * (F.col(f"{n}_hi") - F.col(f"{n}_lo"))).alias(n) for n in QUARTILES])


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact profile. Small frames (one row per column of the table) are broadcast."""
    counts = value_counts(df, columns, "double")
    tops = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("top"),
        F.max("n").alias("top_count"))
    return (
        moments(df, columns).join(F.broadcast(tops), "column", "left")
        .join(F.broadcast(exact_quartiles(counts)), "column", "left")
    )


def quick_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sketch-based profile for very large tables: one pass, no shuffle of values."""
    stats = {
        "n_distinct": lambda c: F.approx_count_distinct(c, 0.02),
        "quartiles": lambda c: F.percentile_approx(c, F.array(*[F.lit(q) for q in QUARTILES.values()]), 10000),
    }
    one = df.agg(*[
        fn(F.col(c).cast("double")).alias(f"{s}__{i}") for i, c in enumerate(columns) for s, fn in stats.items()])
    return moments(df, columns).join(F.broadcast(_long(one, columns, stats)), "column")


def text_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = {"n_rows": lambda c: F.count(F.lit(1)), "missing": lambda c: F.count_if(c.isNull())}
    one = df.agg(*[fn(F.col(c)).alias(f"{s}__{i}") for i, c in enumerate(columns) for s, fn in stats.items()])
    tops = value_counts(df, columns, "string").groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        # most frequent, the alphabetically first of equals
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("top_count"))
    return _long(one, columns, stats).join(F.broadcast(tops), "column", "left")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum belongs to the last bin."""
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    edges = moments(df, columns).select("column", "min", "max")
    width = F.nullif(F.col("max") - F.col("min"), F.lit(0.0))
    at = F.floor((F.col("value") - F.col("min")) / width * bins)
    return (
        df.select(F.inline(F.array(*items))).filter(F.col("value").isNotNull())
        .join(F.broadcast(edges), "column")
        .groupBy("column", F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
