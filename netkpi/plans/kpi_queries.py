"""KPI levels from minute to day, procedure KPIs, joins and area views."""
from pyspark.sql import functions as F

from netkpi.functions import scalar
from netkpi.operators import enrich, kpi, ordering, quality
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register, rounded
from netkpi.sources import adapters, tables

_KPI_COLS = "k.datetime, k.entity_id, answered, dropped, missed, call, text, total_records, city, county, state, lon, lat"


def _minute(spark, sf_dir):
    return kpi.minute_kpi(adapters.event_records(spark, sf_dir))


def _level(spark, sf_dir, interval):
    return kpi.event_kpi(adapters.event_records(spark, sf_dir), interval)


def _rolled_up(spark, sf_dir, interval, offset=None):
    return kpi.rollup_kpi(_minute(spark, sf_dir), interval, ["entity_id"], kpi.EVENT_SUMS, offset)


def _described(spark, sf_dir, rows):
    return enrich.join_dimension(rows, adapters.entity_dimension(spark, sf_dir))


@register("silver_events", "C1 B2", o.with_(o.EVENT, o.DIM) + """
SELECT e.entity_id, d.entity_id AS dim_entity_id, event_ts, outcome, channel, city, county, state, lon, lat
FROM event_record e JOIN entity_dim d ON e.entity_id = d.entity_id""")
def silver_events(spark, sf_dir):
    return enrich.enrich_facts(
        adapters.event_records(spark, sf_dir), adapters.entity_dimension(spark, sf_dir), keep_both_keys=True)


@register("silver_procedures", "C1 B11", o.with_(o.PROC, o.DIM) + """
SELECT e.entity_id, event_ts, proc_code, duration, city, county, state, lon, lat
FROM proc_record e JOIN entity_dim d ON e.entity_id = d.entity_id
WHERE e.entity_id IS NOT NULL AND event_ts IS NOT NULL""")
def silver_procedures(spark, sf_dir):
    clean = quality.drop_violations(adapters.procedure_records(spark, sf_dir), {
        "key present": F.col("entity_id").isNotNull(), "time present": F.col("event_ts").isNotNull()})
    return enrich.enrich_facts(clean, adapters.entity_dimension(spark, sf_dir))


@register("dimension_key_audit", "C1 A11", o.with_(o.DIM) + """
SELECT city, count(*) AS n_rows FROM entity_dim GROUP BY city HAVING count(*) > 1 OR city IS NULL""")
def dimension_key_audit(spark, sf_dir):
    """City is audited as a would-be key, which it is not; entity_id gives no row (see the tests)."""
    return quality.key_audit(adapters.entity_dimension(spark, sf_dir), ["city"])


@register("kpi_minute", "D1 D3 B13", o.with_(o.EVENT, o.DIM, o.MINUTE) + f"""
SELECT {_KPI_COLS} FROM minute_kpi k JOIN entity_dim d USING (entity_id)""")
def kpi_minute(spark, sf_dir):
    return _described(spark, sf_dir, _minute(spark, sf_dir))


@register("kpi_procedure_minute", "D2 D3 B13", o.with_(o.PROC, o.DIM) + """
, k AS (SELECT date_trunc('minute', event_ts) AS datetime, entity_id,
    avg(duration) FILTER (WHERE proc_code = '11') AS a11, max(duration) FILTER (WHERE proc_code = '11') AS max_release_bearer,
    min(duration) FILTER (WHERE proc_code = '11') AS min_release_bearer,
    avg(duration) FILTER (WHERE proc_code = '15') AS a15, max(duration) FILTER (WHERE proc_code = '15') AS max_notification_sent,
    min(duration) FILTER (WHERE proc_code = '15') AS min_notification_sent,
    avg(duration) FILTER (WHERE proc_code = '16') AS a16, max(duration) FILTER (WHERE proc_code = '16') AS max_setup_bearer,
    min(duration) FILTER (WHERE proc_code = '16') AS min_setup_bearer, count(*) AS total_records
  FROM proc_record GROUP BY ALL)
SELECT k.datetime, k.entity_id, round(a11, 6) AS avg_release_bearer, max_release_bearer, min_release_bearer,
  round(a15, 6) AS avg_notification_sent, max_notification_sent, min_notification_sent,
  round(a16, 6) AS avg_setup_bearer, max_setup_bearer, min_setup_bearer, total_records,
  city, county, state, lon, lat
FROM k JOIN entity_dim USING (entity_id)""")
def kpi_procedure_minute(spark, sf_dir):
    rows = kpi.procedure_kpi(adapters.procedure_records(spark, sf_dir))
    return _described(spark, sf_dir, rounded(rows, *[f"avg_{stem}" for stem in kpi.PROCEDURE_CODES.values()]))


@register("kpi_hour", "D4 D3", o.with_(o.EVENT, o.DIM, o.MINUTE, o.HOUR) + f"""
SELECT {_KPI_COLS} FROM hour_kpi k JOIN entity_dim d USING (entity_id)""")
def kpi_hour(spark, sf_dir):
    return _described(spark, sf_dir, _level(spark, sf_dir, "1 hour"))


@register("kpi_hour_from_minutes", "D4", o.with_(o.EVENT, o.MINUTE, o.HOUR) + "SELECT * FROM hour_kpi")
def kpi_hour_from_minutes(spark, sf_dir):
    return _rolled_up(spark, sf_dir, "1 hour")


@register("kpi_day_from_minutes", "D5", o.with_(o.EVENT, o.MINUTE, o.DAY) + "SELECT * FROM day_kpi")
def kpi_day_from_minutes(spark, sf_dir):
    return _rolled_up(spark, sf_dir, "1 day")


@register("kpi_day", "D5 D3", o.with_(o.EVENT, o.DIM, o.MINUTE, o.DAY) + f"""
SELECT {_KPI_COLS} FROM day_kpi k JOIN entity_dim d USING (entity_id)""")
def kpi_day(spark, sf_dir):
    return _described(spark, sf_dir, _level(spark, sf_dir, "1 day"))


@register("kpi_quarter_hour", "D6", o.with_(o.EVENT, o.MINUTE) + f"""
SELECT time_bucket(INTERVAL 15 minutes, datetime) AS datetime, entity_id, {o.SUMS}
FROM minute_kpi GROUP BY 1, 2""")
def kpi_quarter_hour(spark, sf_dir):
    return _rolled_up(spark, sf_dir, "15 minutes")


@register("kpi_week", "D6", o.with_(o.EVENT, o.MINUTE) + f"""
SELECT date_trunc('week', datetime)::TIMESTAMP AS datetime, entity_id, {o.SUMS}
FROM minute_kpi GROUP BY 1, 2""")
def kpi_week(spark, sf_dir):
    """Seven-day windows start on Thursdays unless moved; four days later is Monday."""
    return _rolled_up(spark, sf_dir, "7 days", offset="4 days")


@register("kpi_procedure_hour", "D2 D6", o.with_(o.PROC) + """
SELECT date_trunc('hour', event_ts) AS datetime, entity_id,
  max(duration) FILTER (WHERE proc_code = '11') AS max_release_bearer,
  max(duration) FILTER (WHERE proc_code = '15') AS max_notification_sent,
  max(duration) FILTER (WHERE proc_code = '16') AS max_setup_bearer, count(*) AS total_records
FROM proc_record GROUP BY 1, 2""")
def kpi_procedure_hour(spark, sf_dir):
    rows = kpi.procedure_kpi(adapters.procedure_records(spark, sf_dir), "1 hour")
    return rows.select("datetime", "entity_id", "max_release_bearer", "max_notification_sent",
                       "max_setup_bearer", "total_records")


@register("table_row_counts", "D7", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("customer", "events", "orders", "lineitem")))
def table_row_counts(spark, sf_dir):
    counts = [
        adapters.load(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in ("customer", "events", "orders", "lineitem")
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("dashboard_totals", "D17", o.with_(o.EVENT, o.MINUTE, o.DAY) + f"""
SELECT {o.SUMS}, round(sum(dropped)::DOUBLE / nullif(sum(total_records), 0)::DOUBLE, 6) AS drop_rate
FROM day_kpi WHERE datetime >= TIMESTAMP '2024-01-08' AND datetime < TIMESTAMP '2024-01-22'""")
def dashboard_totals(spark, sf_dir):
    start, end = "2024-01-08", "2024-01-22"
    # whole days, so filtering records gives the same windows and reaches the scan
    records = adapters.event_records(spark, sf_dir).filter(scalar.in_range(F.col("event_ts"), start, end))
    return rounded(kpi.period_totals(kpi.event_kpi(records, "1 day"), start, end), "drop_rate")


@register("dashboard_areas", "D18", o.with_(o.EVENT, o.DIM, o.MINUTE, o.DAY) + f"""
, per_entity AS (SELECT entity_id, {o.SUMS} FROM day_kpi GROUP BY 1)
SELECT state, county, city, grouping_id(state, county, city)::BIGINT AS level, count(*) AS n_entities, {o.SUMS},
  round(avg(lat), 6) AS center_lat, round(avg(lon), 6) AS center_lon,
  round(sum(dropped)::DOUBLE / nullif(sum(total_records), 0)::DOUBLE, 6) AS drop_rate
FROM per_entity JOIN entity_dim USING (entity_id) GROUP BY ROLLUP (state, county, city)""")
def dashboard_areas(spark, sf_dir):
    view = kpi.area_view(_level(spark, sf_dir, "1 day"), adapters.entity_dimension(spark, sf_dir))
    return rounded(view, "center_lat", "center_lon", "drop_rate")


@register("dashboard_entity_rank", "D19", o.with_(o.EVENT, o.DIM, o.MINUTE) + f"""
, per_entity AS (SELECT entity_id, {o.SUMS},
    sum(dropped)::DOUBLE / nullif(sum(total_records), 0)::DOUBLE AS drop_rate
  FROM minute_kpi GROUP BY 1)
SELECT entity_id, answered, dropped, missed, call, text, total_records, round(drop_rate, 6) AS drop_rate, state, county, city,
  rank() OVER (PARTITION BY state ORDER BY drop_rate DESC) AS area_rank
FROM per_entity JOIN entity_dim USING (entity_id)""")
def dashboard_entity_rank(spark, sf_dir):
    detail = kpi.entity_totals(_level(spark, sf_dir, "1 day")).join(
        adapters.entity_dimension(spark, sf_dir).drop("lon", "lat"), "entity_id")
    # ranking reads its input several times: one row per entity is stored, the events are read once
    detail = tables.materialize(detail, "entity-totals")
    return rounded(ordering.rank_within(detail, ["state"], "drop_rate", "area_rank"), "drop_rate")
