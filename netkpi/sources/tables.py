"""Shared scratch folder, table sinks, row delete by new version, and catalog helpers."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from netkpi.operators.quality import key_audit


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a temporary one only for a local master."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="netkpi-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_parts(parts: Iterable[tuple[str, DataFrame]], label: str, column: str, kind: DataType) -> DataFrame:
    """Frames of one schema, each written to the folder of its value of `column`, and read back as one table.

    A folder per frame needs no sort by the partition column, which would hold all rows of a task.
    """
    path = df = None
    for value, df in parts:
        path = path or fresh_path(df.sparkSession, label)
        df.write.parquet(f"{path}/{column}={value}")
    if df is None:
        raise ValueError(f"{label}: no frames to write")
    return df.sparkSession.read.schema(StructType([*df.schema.fields, StructField(column, kind)])).parquet(path)


def tasks_for(stored: DataFrame, most: int) -> int:
    """Tasks that leave each about `most` rows of a stored table, whose files hold the count; at least the session's number."""
    return max(int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // most))


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table, its schema included.

    The rows go to a new folder (below `path`, if given) and only then come under the name, so the files that others
    read stay, a table may be replaced by what is read from it, and a job lost half-way leaves the table that was there.
    For readable old versions and a change-over that is one step for new columns, too, see `versions.VersionedTable`.
    """
    spark, folder = df.sparkSession, f"{path.rstrip('/')}/{uuid.uuid4().hex}" if path else fresh_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(folder)
    return _point(spark, name, folder, df.schema, partition_by)


def _point(spark: SparkSession, name: str, folder: str, schema: StructType, partition_by: Sequence[str] = ()) -> DataFrame:
    """Put written files under a name."""
    if not partition_by and spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:  # a new table, or other columns than before
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=folder, source="parquet")
        if partition_by:
            spark.catalog.recoverPartitions(name)
    return spark.table(name)


def append_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    writer = df.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_files(df: DataFrame, path: str) -> None:
    """Append rows that may bring new columns; read_merged shows them."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def without_matching(df: DataFrame, pred: Column) -> DataFrame:
    """DELETE WHERE pred as a filter: a row whose predicate is NULL stays."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def delete_rows(spark: SparkSession, name: str, pred: Column, new_path: str) -> DataFrame:
    """Write the remaining rows as a new version, then point the table at it.

    The files being read are never overwritten, so a job lost half-way leaves the old version.
    """
    without_matching(spark.table(name), pred).write.parquet(new_path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def write_feature_table(df: DataFrame, name: str, keys: Sequence[str], path: str | None = None, time_key: str | None = None) -> DataFrame:
    """Keyed table: written once, audited on what was written, and only then put under its name.

    A NULL or repeated key is an error and leaves the table that was there before. time_key: the column among the keys that
    says from when a row holds. Both are kept with the table and read back by `table_keys`.
    """
    if time_key and time_key not in keys:
        raise ValueError(f"{name}: time key {time_key} is not one of the keys {list(keys)}")
    spark, path = df.sparkSession, path or fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    if not key_audit(spark.read.schema(df.schema).parquet(path), keys).isEmpty():
        raise ValueError(f"{name}: NULL or repeated key in {list(keys)}")
    _point(spark, name, path, df.schema)
    held = {"keys": ",".join(keys)} | ({"time_key": time_key} if time_key else {})
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f"'netkpi.{k}' = '{v}'" for k, v in held.items())})")
    return spark.table(name)


def table_keys(spark: SparkSession, name: str) -> tuple[list[str], str | None]:
    """Keys and time key that a feature table was written with."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    keys = held.get("netkpi.keys")
    return keys.split(",") if keys else [], held.get("netkpi.time_key")


def rows_as_of(features: DataFrame, keys: tuple[list[str], str | None], asked: DataFrame, at: str, closed_after: str) -> DataFrame:
    """For every row of `asked` (entity keys and a time `at`) the newest feature row that was closed by then, or NULLs.

    A feature row is closed `closed_after` its time key. Both sides meet in one sort per entity, and the last feature row
    seen is carried along, so no pair of rows is formed.
    """
    names, time_key = keys
    entity = [k for k in names if k != time_key]
    held = [c for c in features.columns if c not in entity]
    closed = (F.col(time_key) + F.expr(f"interval {closed_after}")).alias("_when")
    known = features.select(*entity, closed, F.struct(*held).alias("_row"), F.lit(0).alias("_asks"))
    wants = asked.select(*entity, F.col(at).alias("_when"), F.lit(None).cast(known.schema["_row"].dataType).alias("_row"), F.lit(1).alias("_asks"))
    so_far = Window.partitionBy(*entity).orderBy("_when", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = known.unionByName(wants).withColumn("_last", F.last("_row", ignorenulls=True).over(so_far)).filter("_asks = 1")
    return out.select(*entity, F.col("_when").alias(at), *[F.col("_last")[c].alias(c) for c in held])


def drop_schema_tables(spark: SparkSession, schema: str) -> list[str]:
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{n}")
    return names


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
