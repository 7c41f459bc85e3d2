"""Exact ranks, running totals and top rows that do not put a whole group into one task."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], hint=lambda d: d, how: str = "inner") -> DataFrame:
    """Join on equal keys in which NULL equals NULL; one copy of the keys stays."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(hint(other), same, how).drop(*[f"_right_{k}" for k in keys])


def running_totals(df: DataFrame, group: Sequence[str], value: str, weights: Sequence[str],
                   slots: int | None = None, bounded_groups: bool = False) -> DataFrame:
    """Add, for every weight w, `w_before` (of smaller values) and `w_total` (of the group), exactly.

    `df` holds one row per (group, value). Each group is cut at approximate quantiles of its
    values; a slot holds about 1/slots of them, so the sorted running sum is taken per
    (group, slot) and shifted by the slots before it. The cuts only place the work: the result
    does not depend on their accuracy. Offsets are at most slots + 1 rows per group. By default
    there are as many slots as shuffle partitions.

    `bounded_groups` states that the groups are few by construction (columns of a table, splits);
    their cuts and offsets are then broadcast. Otherwise the join is picked by measured size.
    """
    group, weights = list(group), list(weights)
    slots = slots or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hint = F.broadcast if bounded_groups else (lambda d: d)
    marks = F.array(*[F.lit(i / slots) for i in range(1, slots)])
    number = F.col(value).cast("double")
    # weights are counts, so the test always holds; it keeps them in this branch too, which lets
    # Spark reuse the shuffle below instead of running a second one on the values alone
    weighed = F.when(sum((F.col(w) for w in weights), F.lit(0)) >= 0, number)
    cuts = df.groupBy(*group).agg(F.percentile_approx(weighed, marks, slots * 20).alias("_cuts"))
    joined = join_same(df, cuts, group, hint) if group else df.withColumn("_cuts", cuts.scalar())
    # never NULL: a nullable join key would be tested, and thereby computed, a second time
    slot = F.coalesce(F.size(F.filter(F.col("_cuts"), lambda c: c < number)), F.lit(0))
    placed = joined.withColumn("_slot", slot).drop("_cuts")
    by_slot = placed.groupBy(*group, "_slot").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    ahead = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = by_slot.select(
        *group, "_slot",
        *[F.coalesce(F.sum(f"_sum_{w}").over(ahead), F.lit(0)).alias(f"_shift_{w}") for w in weights],
        *[F.sum(f"_sum_{w}").over(whole).alias(f"{w}_total") for w in weights])
    inside = (
        Window.partitionBy(*group, "_slot").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = placed.withColumns({f"_in_{w}": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
    return (
        join_same(placed, offsets, [*group, "_slot"], hint)
        .withColumns({f"{w}_before": F.col(f"_in_{w}") + F.col(f"_shift_{w}") for w in weights})
        .drop("_slot", *[f"_in_{w}" for w in weights], *[f"_shift_{w}" for w in weights])
    )


def rank_within(df: DataFrame, group: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """SQL rank() by descending value inside each group, NULL values last; rows of equal value share one count row.

    Every row stays: a NULL group is a group, and NULL values share the rank after the last value.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, group, value, ["n"]).select(
        *group, value, (F.col("n_total") - F.col("n_before") - F.col("n") + 1).alias(name))
    nulls = df.groupBy(*group).agg(F.count(value).alias("_n"), F.count_if(F.col(value).isNull()).alias("_null")).filter("_null > 0")
    last = nulls.select(*group, F.lit(None).cast(df.schema[value].dataType).alias(value), (F.col("_n") + 1).alias(name))
    return join_same(df, ranked.unionByName(last), [*group, value])


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows; each task keeps its own k before the merge."""
    return df.orderBy(*order).limit(k)


def top_rows_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group.

    Up to the session's threshold Spark cuts every group to k rows in the map tasks. For a larger k parts of a group are
    cut to k apart first, so that the last step sees k rows per part and no task sorts a whole group.
    """
    conf = df.sparkSession.conf
    if k > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        part = F.pmod(F.xxhash64(*df.columns), F.lit(int(conf.get("spark.sql.shuffle.partitions"))))
        within = Window.partitionBy(*group, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_pos", F.row_number().over(within)).filter(F.col("_pos") <= k).drop("_part", "_pos")
    pos = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("position", pos).filter(F.col("position") <= k)


def repeatable_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """At most n rows, the same ones on any partitioning."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key))), key).limit(n)
