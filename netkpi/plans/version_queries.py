"""Tables of versions, keyed feature tables with their keys, and an inventory of a schema."""
from pyspark.sql import functions as F

from netkpi.operators import kpi
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register
from netkpi.sources import adapters, tables
from netkpi.sources.versions import VersionedTable

_OLD, _LARGE = "TIMESTAMP '1998-01-01'", 200000


def _orders(spark, sf_dir):
    """Four versions: old orders, newer ones with a further column, without large ones, totals per customer."""
    orders = adapters.load(spark, sf_dir, "orders")
    new = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    table = VersionedTable(spark, tables.fresh_path(spark, "orders-versions"))
    table.replace(orders.filter(~new).select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])
    table.append(orders.filter(new).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"))
    table.delete(F.col("o_totalprice") > _LARGE)
    table.replace(table.read().groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")), ["o_custkey"])
    return table


_STAGES = f"""WITH first AS (SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderdate < {_OLD}),
second AS (SELECT * FROM first UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= {_OLD}),
third AS (SELECT * FROM second WHERE NOT coalesce(o_totalprice > {_LARGE}, FALSE))
"""


@register("table_version_history", "A7 A8 A12", _STAGES + """, n AS (
SELECT 1 AS version, 'replace' AS operation, count(*) AS n_rows, 'o_orderkey,o_custkey,o_totalprice' AS columns, 'o_orderkey' AS keys FROM first
UNION ALL SELECT 2, 'append', count(*), 'o_orderkey,o_custkey,o_totalprice,o_orderpriority', 'o_orderkey' FROM second
UNION ALL SELECT 3, 'delete', count(*), 'o_orderkey,o_custkey,o_totalprice,o_orderpriority', 'o_orderkey' FROM third
UNION ALL SELECT 4, 'replace', count(DISTINCT o_custkey), 'o_custkey,n_orders', 'o_custkey' FROM third)
SELECT version, operation, n_rows, n_rows AS rows_read, columns, keys FROM n""")
def table_version_history(spark, sf_dir):
    """What each manifest says, and how many rows its version still gives after all later ones."""
    table = _orders(spark, sf_dir)
    read = None
    for n in table.numbers():
        one = table.read(n).agg(F.count(F.lit(1)).alias("rows_read")).select(F.lit(n).cast("long").alias("version"), "rows_read")
        read = one if read is None else read.unionByName(one)
    return table.history().join(read, "version").select(
        "version", "operation", "n_rows", "rows_read", F.array_join("columns", ",").alias("columns"), F.array_join("keys", ",").alias("keys"))


@register("table_old_version", "A7 A8 A12", _STAGES + "SELECT * FROM second")
def table_old_version(spark, sf_dir):
    """The second version, read after rows were deleted and columns replaced."""
    return _orders(spark, sf_dir).read(2)


@register("table_merge_days", "A7 A12", """
SELECT o_orderkey, o_orderdate, CASE WHEN o_custkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders""")
def table_merge_days(spark, sf_dir):
    """Every third customer's orders come again with another price; only their months are rewritten."""
    rows = adapters.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    table = VersionedTable(spark, tables.fresh_path(spark, "orders-months"))
    table.merge(rows.drop("o_custkey"), ["o_orderkey", "o_orderdate"], month)
    table.merge(rows.filter("o_custkey % 3 = 0").withColumn("price", F.col("price") + 1).drop("o_custkey"), ["o_orderkey", "o_orderdate"], month)
    return table.read()


@register("feature_table_keys", "A11", o.with_(o.EVENT, o.MINUTE, o.HOUR) + """
SELECT position, key, is_time, n_rows FROM (VALUES (1, 'entity_id', 0), (2, 'datetime', 1)) t(position, key, is_time), (SELECT count(*) AS n_rows FROM hour_kpi)""")
def feature_table_keys(spark, sf_dir):
    """Keys and time key as they are stored with the written table."""
    name = tables.fresh_name("keyed")
    hours = kpi.event_kpi(adapters.event_records(spark, sf_dir), "1 hour")
    n_rows = tables.write_feature_table(hours, name, ["entity_id", "datetime"], time_key="datetime").count()
    keys, time_key = tables.table_keys(spark, name)
    return spark.createDataFrame([(i + 1, k, int(k == time_key), n_rows) for i, k in enumerate(keys)], "position int, key string, is_time int, n_rows long")


@register("feature_rows_as_of", "A11", o.with_(o.EVENT, o.MINUTE, o.HOUR, """asked AS (
  SELECT user_id AS entity_id, ts AS asked_at FROM events WHERE event_type = 'purchase')""") + """
SELECT a.entity_id, a.asked_at, max(h.datetime) AS known_from, arg_max(h.total_records, h.datetime) AS total_records
FROM asked a LEFT JOIN hour_kpi h ON h.entity_id = a.entity_id AND h.datetime + INTERVAL 1 HOUR <= a.asked_at GROUP BY 1, 2""")
def feature_rows_as_of(spark, sf_dir):
    """For every purchase the newest hour of its entity that was over by then: one pass over both sides in the order of time."""
    name = tables.fresh_name("keyed")
    hours = kpi.event_kpi(adapters.event_records(spark, sf_dir), "1 hour")
    hours = tables.write_feature_table(hours, name, ["entity_id", "datetime"], time_key="datetime")
    asked = adapters.load(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        F.col("user_id").alias("entity_id"), F.col("ts").alias("asked_at")).distinct()
    return tables.rows_as_of(hours, tables.table_keys(spark, name), asked, "asked_at", "1 hour").select(
        "entity_id", "asked_at", F.col("datetime").alias("known_from"), "total_records")


@register("schema_inventory", "A13", """
SELECT * FROM (VALUES ('made', 'nations'), ('made', 'regions'), ('dropped', 'nations'), ('dropped', 'regions')) t(step, name)
UNION ALL SELECT 'rows of ' || 'nations', count(*)::VARCHAR FROM nation UNION ALL SELECT 'rows of regions', count(*)::VARCHAR FROM region""")
def schema_inventory(spark, sf_dir):
    """A schema is made, filled, listed and emptied again; nothing is left in it."""
    schema = tables.fresh_name("area")
    tables.ensure_schema(spark, schema)
    for name in ("nation", "region"):
        tables.replace_table(adapters.load(spark, sf_dir, name), f"{schema}.{name}s", tables.fresh_path(spark, name))
    made = sorted(t.name for t in spark.catalog.listTables(schema))
    rows = [("made", n) for n in made] + [(f"rows of {n}", str(spark.table(f"{schema}.{n}").count())) for n in made]
    rows += [("dropped", n) for n in tables.drop_schema_tables(spark, schema)]
    rows += [("left", t.name) for t in spark.catalog.listTables(schema) if not t.isTemporary]
    spark.sql(f"DROP SCHEMA {schema}")
    return spark.createDataFrame(rows, "step string, name string")
