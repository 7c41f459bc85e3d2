"""Name -> query, oracle SQL and covered inventory ids."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Ratios and fits rounded for comparison with another engine; the operators themselves never round."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def register(name: str, covers: str, sql: str | None = None):
    """Register the decorated query; `covers` lists inventory ids separated by blanks."""
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep
