"""Feature encoding. What is learned (levels, means) is learned on the training rows only."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netkpi.functions.names import feature_name, rename_all
from netkpi.functions.scalar import split_bucket

MAX_LEVELS = 1000


def fit_levels(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted levels of each column, found in one pass.

    Levels become columns, so they have to reach the driver; their number is checked first. `one_hot_long` has no such limit.
    """
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]
    found = df.select(F.inline(F.array(*items))).filter(F.col("level").isNotNull()).distinct()
    cap = max_levels * len(columns)
    rows = found.limit(cap + 1).collect()
    out = {c: sorted(r["level"] for r in rows if r["column"] == c) for c in columns}
    if len(rows) > cap or any(len(v) > max_levels for v in out.values()):
        raise ValueError(f"more than {max_levels} levels in one of {list(columns)}")
    return out


def one_hot_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The ones of a one-hot encoding as rows (keys, feature), for any number of levels; nothing reaches the driver."""
    named = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))) for c in columns]
    return df.select(*keys, F.explode(F.array_compact(F.array(*named))).alias("feature"))


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: bool = False,
            keep_source: bool = False) -> DataFrame:
    """One long 0/1 column `<column>_<level>` per level; NULL and unseen levels are all zeros."""
    hot = {
        f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("long"), F.lit(0).cast("long"))
        for c, found in levels.items() for v in (found[1:] if drop_first else found)
    }
    kept = df.columns if keep_source else [c for c in df.columns if c not in levels]
    return df.select(*kept, *[e.alias(n) for n, e in hot.items()])


def clean_features(df: DataFrame) -> DataFrame:
    return rename_all(df, feature_name)


def impute_mean(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs take the mean of the training rows, fetched as scalar subqueries of the same plan."""
    means = train.agg(*[F.avg(c).alias(c) for c in columns])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means.select(c).scalar()) for c in columns})


def standardise(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation of the training rows; a zero deviation divides by 1."""
    stats = train.agg(*[F.struct(
        F.avg(c).alias("mean"), F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias("std")).alias(c)
        for c in columns])
    out = df
    for c in columns:
        s = stats.select(c).scalar()
        out = out.withColumn(c, (F.col(c) - s["mean"]) / s["std"])
    return out


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Model inputs by stored signature: others are ignored, a missing one is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*names)


def with_split(df: DataFrame, key: Column, shares: Mapping[str, int], seed: int = 0) -> DataFrame:
    """Split name per row from a hash of the key: the same rows on every run and layout."""
    if sum(shares.values()) != 100:
        raise ValueError("shares must add up to 100")
    bucket, edge, name = split_bucket(key, seed), 0, None
    for part, share in shares.items():
        edge += share
        name = F.when(bucket < edge, part) if name is None else name.when(bucket < edge, part)
    return df.withColumn("split", name)
