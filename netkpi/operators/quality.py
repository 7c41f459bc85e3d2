"""Row-quality rules, key audits and duplicate removal."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _holds(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def drop_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Keep the rows for which every rule is true; an unknown outcome is a violation."""
    return df.filter(reduce(lambda a, b: a & b, rules.values()))


def rule_metrics(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: rows seen, rows violating. A single pass, two columns per rule."""
    aggs = [F.count(F.lit(1)).alias("_seen")]
    aggs += [F.count_if(~_holds(p)).alias(f"_bad_{i}") for i, p in enumerate(rules.values())]
    one = df.agg(*aggs)
    items = [
        F.struct(F.lit(name).alias("rule"), F.col("_seen").alias("rows_seen"),
                 F.col(f"_bad_{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*items)))


def observe_rules(df: DataFrame, rules: Mapping[str, Column], label: str) -> DataFrame:
    """Warn-only form for batch and stream: rows pass unchanged, counts arrive as observed metrics."""
    return df.observe(
        label, F.count(F.lit(1)).alias("rows_seen"),
        *[F.count_if(~_holds(p)).alias(name) for name, p in rules.items()])


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that cannot serve as primary key: a NULL part or more than one row."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | has_null)
    )


def drop_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. Rows sharing a key are taken to be copies of each other."""
    return df.dropDuplicates(list(keys))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the one greatest in `order`; partial max per task, so hot keys collapse early."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, "_r.*")
