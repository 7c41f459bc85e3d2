"""Profiles from stored sketches: a part of a table (say, a day) is read once, and any range of parts is profiled from what was kept.

Per part and column: counts, sums, extremes, and three sketches of bounded size that add up like counts do: distinct values
(HyperLogLog), quantiles (KLL) and the most frequent values. A part that is done again replaces its rows in the versioned
table. Relative error of distinct counts: 1.04 / sqrt(2^lg_k), 1.6 % by default, for one in three; error of a quantile's rank:
below 1.65 % at k = 200 (99 % sure). A value that makes up more than its share of the tracked items is never missed.
Times and dates are profiled as microseconds and given back as times.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netkpi.sources.versions import VersionedTable

#: Buckets of the distinct count (2 to the power), k of the quantile sketch, values tracked for the most frequent ones.
DISTINCT_BITS, QUANTILE_K, TRACKED = 12, 200, 1000
QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
TIMES = ("date", "timestamp", "timestamp_ntz")


def _kind(dtype: str) -> str:
    return "number" if dtype.startswith(NUMBERS) else "time" if dtype in TIMES else "text"


def _number(name: str, dtype: str) -> Column:
    """The value as a double: times as microseconds (exact until the year 2255), texts none."""
    kind = _kind(dtype)
    if kind == "number":
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) if dtype in ("float", "double") else F.col(name).cast("double")
    if kind == "time":
        wall = F.col(name).cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), wall).cast("double")
    return F.lit(None).cast("double")


def part_sketches(df: DataFrame, part: Column, columns: Sequence[str]) -> DataFrame:
    """One row per part and column. One pass over the rows with partial aggregates; no row is copied per column."""
    kinds = dict(df.dtypes)
    aggs, items = [F.count(F.lit(1)).alias("_n")], []
    for i, c in enumerate(columns):
        x, text = _number(c, kinds[c]), F.col(c).cast("string")
        named = {
            "present": F.count(F.col(c) if kinds[c] not in ("float", "double") else x), "zeros": F.count_if(x == 0), "total": F.sum(x), "squares": F.sum(x * x), "low": F.min(x), "high": F.max(x),
            "distinct": F.hll_sketch_agg(text, F.lit(DISTINCT_BITS)),
            "ranks": F.kll_sketch_agg_double(x, F.lit(QUANTILE_K)), "tops": F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {TRACKED}) FILTER (WHERE `{c}` IS NOT NULL)")}
        aggs += [a.alias(f"{n}_{i}") for n, a in named.items()]
        items.append(F.struct(F.lit(c).alias("column"), F.lit(_kind(kinds[c])).alias("kind"), F.col("_n").alias("n_rows"),
                              *[F.col(f"{n}_{i}").alias(n) for n in named]))
    return df.groupBy(part.cast("long").alias("part")).agg(*aggs).select("part", F.inline(F.array(*items)))


def store(table: VersionedTable, sketches: DataFrame) -> None:
    """Put parts into the table, in the place of their earlier rows."""
    table.merge(sketches, ["part", "column"], F.col("part"))


def profile(sketches: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """The profile of all parts from first to last, from their stored rows alone.

    column, kind, n_rows, missing, zeros, mean, std, min, max, n_distinct, quartiles, top, top_count; those of times as micros.
    """
    if first is not None:
        sketches = sketches.filter(F.col("part") >= first)
    if last is not None:
        sketches = sketches.filter(F.col("part") <= last)
    one = sketches.groupBy("column", "kind").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("present").alias("present"), F.sum("zeros").alias("zeros"), F.sum("total").alias("total"),
        F.sum("squares").alias("squares"), F.min("low").alias("min"), F.max("high").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"), F.kll_merge_agg_double("ranks").alias("ranks"),
        F.expr("approx_top_k_estimate(approx_top_k_combine(tops), 1)").alias("tops"))
    n, is_text = F.col("present"), F.col("kind") == "text"
    mean = F.when(~is_text, F.col("total") / F.nullif(n, F.lit(0)))
    spread = (F.col("squares") - F.col("total") * F.col("total") / n) / F.nullif(n - 1, F.lit(0))
    at = [F.when(F.kll_sketch_get_n_double("ranks") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(name) for name, q in QUANTILES.items()]
    top = F.when(F.size("tops") > 0, F.col("tops")[0])
    return one.select(
        "column", "kind", "n_rows", (F.col("n_rows") - n).alias("missing"), F.when(F.col("kind") == "number", F.col("zeros")).alias("zeros"),
        mean.alias("mean"), F.when(F.col("kind") == "number", F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("std"), "min", "max", "n_distinct", *at,
        top["item"].alias("top"), top["count"].alias("top_count"))


def as_time(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.round(micros).cast("long"), F.lit("1970-01-01").cast("timestamp_ntz"))
