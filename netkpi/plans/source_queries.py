"""Readers and sinks: each query writes what Spark derives from a given table and reads it back."""
from pyspark.sql import functions as F

from netkpi import schemas
from netkpi.operators import enrich, quality
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register
from netkpi.sources import adapters, files, tables


@register("scan_json_events", "A1", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json_events(spark, sf_dir):
    path = tables.fresh_path(spark, "events-json")
    adapters.load(spark, sf_dir, "events").write.option("timestampNTZFormat", files.TIME_FORMAT).json(path)
    return files.read_json(spark, path, schemas.EVENT_TABLE)


@register("scan_nested_dimension", "A2 B1", o.with_(o.DIM) + "SELECT * FROM entity_dim")
def scan_nested_dimension(spark, sf_dir):
    path = tables.fresh_path(spark, "dimension-json")
    adapters.nested_dimension(spark, sf_dir).write.option("compression", "gzip").json(path)
    return enrich.flatten_dimension(files.read_nested_gzip(spark, path, schemas.NESTED_DIMENSION))


@register("scan_catalog_table", "A3 A7", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_catalog_table(spark, sf_dir):
    name = tables.fresh_name("orders_bronze")
    df = adapters.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return tables.replace_table(df, name, tables.fresh_path(spark, "orders-bronze"))


@register("scan_parquet_training_set", "A4", "SELECT doc_id, quality, toxic FROM labels")
def scan_parquet_training_set(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/labels.parquet", ["doc_id", "quality", "toxic"])


@register("scan_customer_csv", "A5 B19", """
SELECT c_custkey AS cust_key, c_name AS cust_name, c_nationkey AS nation_key, c_acctbal AS acct_bal_usd,
  c_mktsegment AS mkt_segment FROM customer""")
def scan_customer_csv(spark, sf_dir):
    path = tables.fresh_path(spark, "customer-csv")
    names = schemas.CUSTOMER_CSV.fieldNames()
    adapters.load(spark, sf_dir, "customer").toDF(*names).write.option("header", True).csv(path)
    return files.read_csv(spark, path, schemas.CUSTOMER_CSV)


@register("table_replace_schema", "A7 A8", """
SELECT user_id, count(*) AS n_events, round(max(value), 6) AS max_value FROM events GROUP BY 1""")
def table_replace_schema(spark, sf_dir):
    """The second write has other columns; nothing of the first is left."""
    events = adapters.load(spark, sf_dir, "events")
    name, path = tables.fresh_name("customer_bronze"), tables.fresh_path(spark, "customer-bronze")
    tables.replace_table(events.select("user_id"), name, path)
    second = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.max("value"), 6).alias("max_value"))
    return tables.replace_table(second, name, path)


@register("table_append_new_columns", "A10", """
SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def table_append_new_columns(spark, sf_dir):
    orders = adapters.load(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    path = tables.fresh_path(spark, "orders-growing")
    tables.append_files(orders.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus"), path)
    tables.append_files(
        orders.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return tables.read_merged(spark, path)


@register("table_delete_rows", "A12", """
SELECT run_id, name, metric FROM (
  SELECT o_orderkey AS run_id, o_orderpriority AS name, CASE WHEN o_custkey % 10 <> 0 THEN o_totalprice END AS metric
  FROM orders) WHERE NOT coalesce(metric > 100000, FALSE)""")
def table_delete_rows(spark, sf_dir):
    name = tables.fresh_name("runs")
    runs = adapters.run_records(spark, sf_dir).select("run_id", "name", "metric")
    tables.replace_table(runs, name, tables.fresh_path(spark, "runs-v1"))
    return tables.delete_rows(spark, name, F.col("metric") > 100000, tables.fresh_path(spark, "runs-v2"))


@register("feature_key_audit", "A11", """
SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n_rows FROM events
GROUP BY 1, 2 HAVING count(*) > 1 OR user_id IS NULL OR date_trunc('hour', ts) IS NULL""")
def feature_key_audit(spark, sf_dir):
    raw = adapters.load(spark, sf_dir, "events").select("user_id", F.window("ts", "1 hour").start.alias("hour"))
    return quality.key_audit(raw, ["user_id", "hour"])
