"""Flattening the nested dimension and joining facts to it."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def flatten_dimension(nested: DataFrame) -> DataFrame:
    """Struct fields by path; coordinate 0 is the longitude, 1 the latitude, NULL when the array is short."""
    xy = F.col("geometry.coordinates")
    return nested.select(
        "properties.entity_id", "properties.city", "properties.county", "properties.state",
        F.get(xy, F.lit(0)).alias("lon"), F.get(xy, F.lit(1)).alias("lat"),
    )


# largest dimension that is sent to every executor
BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame from one distributed count: 8 bytes per cell plus the length of its texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType == T.StringType()]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(texts, F.lit(0))).alias("text")).first()
    return row["n"] * 8 * len(df.columns) + (row["text"] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The frame, marked for broadcast when its measured size allows it, and whether it is marked."""
    small = measured_bytes(df) <= max_bytes
    return (F.broadcast(df) if small else df), small


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str = "entity_id", dim_key: str = "entity_id",
                   keep_both_keys: bool = False, salts: int = 1) -> DataFrame:
    """Inner equi-join without a hint: Spark picks by size, again at run time under AQE, which also
    splits hot keys of a sort-merge join.

    KPI plans join *after* they aggregate, so that no more than one row per window is left of a hot
    key. `salts` > 1 spreads every key over that many tasks and repeats the dimension as often;
    for joins AQE does not look after, such as those in a stream.
    """
    on = [fact_key]
    if fact_key != dim_key or keep_both_keys:
        kept = dim_key if dim_key not in fact.columns else f"dim_{dim_key}"
        dim = dim.withColumnRenamed(dim_key, kept).withColumn("_key", F.col(kept))
        fact, on = fact.withColumn("_key", F.col(fact_key)), ["_key"]
    if salts > 1:
        fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int"))
        dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = [*on, "_salt"]
    return fact.join(dim, on).drop("_salt", "_key")


def enrich_facts(fact: DataFrame, dim: DataFrame, keep_both_keys: bool = False, salts: int = 1,
                 max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Raw facts joined to the dimension.

    The dimension is measured first: while it is small it is broadcast and the facts stay where
    they are; beyond that it is the shuffled join of join_dimension.
    """
    dim, small = broadcast_if_small(dim, max_bytes)
    return join_dimension(fact, dim, keep_both_keys=keep_both_keys, salts=1 if small else salts)


def attach_calendar(series: DataFrame, calendar: DataFrame, ds: str = "ds") -> DataFrame:
    """Left join of a series to a user-supplied holiday calendar (day, holiday); several holidays of a day share its row."""
    names = F.array_join(F.sort_array(F.collect_set("holiday")), ", ")
    calendar = calendar.groupBy("day").agg(F.nullif(names, F.lit("")).alias("holiday"))
    return (
        series.join(calendar, F.to_date(F.col(ds)) == F.col("day"), "left")
        .drop("day")
        .withColumn("is_holiday", F.col("holiday").isNotNull().cast("int"))
    )
