"""Projection, filter, casts, quality rules and scalar functions on whole tables."""
from pyspark.sql import functions as F

from netkpi.functions import names, scalar
from netkpi.operators import quality
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register
from netkpi.sources import adapters


@register("array_elements", "B1", """
SELECT vec_id, embedding[1] AS first_value, embedding[2] AS second_value FROM embeddings""")
def array_elements(spark, sf_dir):
    vec = F.col("embedding")
    return adapters.load(spark, sf_dir, "embeddings").select(
        "vec_id", F.get(vec, F.lit(0)).alias("first_value"), F.get(vec, F.lit(1)).alias("second_value"))


@register("project_columns", "B2 B3 B4 B5", """
SELECT o_orderkey, o_custkey AS customer_id, o_totalprice, o_totalprice AS price_copy, o_orderdate FROM orders""")
def project_columns(spark, sf_dir):
    return (
        adapters.load(spark, sf_dir, "orders")
        .withColumn("price_copy", F.col("o_totalprice"))
        .withColumnRenamed("o_custkey", "customer_id")
        .drop("o_orderstatus", "o_orderpriority")
        .select("o_orderdate", "o_orderkey", "customer_id", "o_totalprice", "price_copy")
    )


@register("time_range_rows", "B6 B8", """
SELECT event_id, ts AS ds, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'""")
def time_range_rows(spark, sf_dir):
    return (
        adapters.load(spark, sf_dir, "events")
        .filter(scalar.in_range(F.col("ts"), "2024-01-05", "2024-01-12"))
        .select("event_id", F.col("ts").alias("ds"), "user_id")
    )


@register("time_slot_rows", "B7", """
SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate = TIMESTAMP '1998-03-04' AND o_orderstatus = 'F'""")
def time_slot_rows(spark, sf_dir):
    slot = F.col("o_orderdate") == F.lit("1998-03-04").cast("timestamp_ntz")
    return (
        adapters.load(spark, sf_dir, "orders").filter(slot & (F.col("o_orderstatus") == "F"))
        .select("o_orderkey", "o_orderdate", "o_orderpriority")
    )


@register("calendar_year_rows", "B9", """
SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997""")
def calendar_year_rows(spark, sf_dir):
    return (
        adapters.load(spark, sf_dir, "orders").filter(scalar.in_year(F.col("o_orderdate"), 1997))
        .select("o_orderkey", "o_orderdate")
    )


@register("casts", "B10", """
SELECT o_orderkey::VARCHAR AS order_id, o_orderdate::DATE::VARCHAR AS order_day, (o_orderstatus = 'F')::INTEGER AS label,
  try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
  CAST(o_orderdate::DATE::VARCHAR AS TIMESTAMP) AS parsed FROM orders""")
def casts(spark, sf_dir):
    day = F.col("o_orderdate").cast("date").cast("string")
    return adapters.load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        day.alias("order_day"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        day.cast("timestamp_ntz").alias("parsed"),
    )


@register("quality_drop", "B11", o.with_(o.EVENT) + """
SELECT * FROM event_record WHERE outcome IS NOT NULL AND entity_id % 7 <> 0""")
def quality_drop(spark, sf_dir):
    return quality.drop_violations(adapters.event_records(spark, sf_dir), {
        "outcome present": F.col("outcome").isNotNull(),
        "key accepted": F.col("entity_id") % 7 != 0,
    })


@register("quality_metrics", "B12", o.with_(o.PROC, o.EVENT) + """
SELECT 'duration above 100' AS rule, count(*) AS rows_seen, count(*) FILTER (WHERE NOT coalesce(duration > 100, FALSE)) AS violations FROM proc_record
UNION ALL
SELECT 'known code', count(*), count(*) FILTER (WHERE NOT coalesce(proc_code <> '99', FALSE)) FROM proc_record""")
def quality_metrics(spark, sf_dir):
    return quality.rule_metrics(adapters.procedure_records(spark, sf_dir), {
        "duration above 100": F.col("duration") > 100,
        "known code": F.col("proc_code") != "99",
    })


@register("conditional_values", "B13", """
SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS click_value,
  CASE WHEN event_type = 'error' THEN 1.0::DOUBLE END AS error_mark FROM events""")
def conditional_values(spark, sf_dir):
    kind = F.col("event_type")
    return adapters.load(spark, sf_dir, "events").select(
        "event_id", F.when(kind == "click", F.col("value")).alias("click_value"),
        F.when(kind == "error", F.lit(1.0)).alias("error_mark"))


@register("series_keys", "B14", """
SELECT o_orderpriority || '-' || o_orderstatus AS series_id, count(*) AS n_rows FROM orders GROUP BY 1""")
def series_keys(spark, sf_dir):
    return (
        adapters.load(spark, sf_dir, "orders")
        .groupBy(scalar.series_key(["o_orderpriority", "o_orderstatus"]).alias("series_id"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@register("training_stamp", "B15", """
SELECT c_custkey, TIMESTAMP '2024-01-15' AS trained_at FROM customer""")
def training_stamp(spark, sf_dir):
    return adapters.load(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("2024-01-15").cast("timestamp_ntz").alias("trained_at"))


@register("label_codes", "B17", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label FROM orders""")
def label_codes(spark, sf_dir):
    return adapters.load(spark, sf_dir, "orders").select(
        "o_orderkey", scalar.label_code(F.col("o_orderstatus"), {"F": 1, "O": 0}).alias("label"))


@register("clean_column_names", "B18", """
SELECT c_custkey AS cust_key__id_, c_acctbal AS acct_bal FROM customer""")
def clean_column_names(spark, sf_dir):
    df = adapters.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust-Key (ID)"), F.col("c_acctbal").alias("Acct Bal"))
    return names.rename_all(df, names.feature_name)


@register("drop_null_rows", "B20", """
SELECT * FROM documents LEFT JOIN labels USING (doc_id)
WHERE doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL
  AND quality IS NOT NULL AND toxic IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    """Documents without a label, or with a NULL in any column, go."""
    docs, labels = (adapters.load(spark, sf_dir, n) for n in ("documents", "labels"))
    return docs.join(labels, "doc_id", "left").dropna(how="any")


@register("coerce_numbers", "B21", """
SELECT p_partkey, try_cast(raw AS DOUBLE) AS number FROM (
  SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_type ELSE substr(p_brand, 7) END AS raw FROM part)""")
def coerce_numbers(spark, sf_dir):
    raw = F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(F.substr("p_brand", F.lit(7)))
    return adapters.load(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")).select(
        "p_partkey", scalar.to_number("raw").alias("number"))


@register("recent_paths", "B28", """
WITH p AS (SELECT o_orderkey, '/runs/' || o_orderpriority || '/' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '/part' AS path FROM orders),
s AS (SELECT o_orderkey, path, strptime(regexp_extract(path, '([0-9]{8}_[0-9]{6})', 1), '%Y%m%d_%H%M%S') AS stamp FROM p)
SELECT o_orderkey, path, stamp, floor(epoch(TIMESTAMP '2001-08-01 12:00:00' - stamp) / 86400)::BIGINT AS age_days
FROM s WHERE floor(epoch(TIMESTAMP '2001-08-01 12:00:00' - stamp) / 86400) <= 30""")
def recent_paths(spark, sf_dir):
    path = F.concat(F.lit("/runs/"), "o_orderpriority", F.lit("/"),
                    F.date_format("o_orderdate", "yyyyMMdd_HHmmss"), F.lit("/part"))
    return (
        adapters.load(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
        .withColumn("stamp", scalar.stamp_in_path(F.col("path")))
        .withColumn("age_days", scalar.age_in_days(F.col("stamp"), "2001-08-01 12:00:00"))
        .filter(F.col("age_days") <= 30)
    )


@register("unique_rows", "H7", """
SELECT o_custkey, o_orderdate::DATE::VARCHAR AS day FROM orders GROUP BY ALL""")
def unique_rows(spark, sf_dir):
    df = adapters.load(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))
    return quality.drop_duplicate_keys(df, ["o_custkey", "day"])
