"""SQL text shared by the oracles: the adapters and KPI levels stated a second time, in SQL."""

EVENT = """event_record AS (
  SELECT user_id AS entity_id, ts AS event_ts,
    CASE event_type WHEN 'error' THEN 'dropped' WHEN 'view' THEN 'missed' WHEN 'purchase' THEN 'answered' END AS outcome,
    CASE event_type WHEN 'click' THEN 'text' WHEN 'signup' THEN 'call' END AS channel
  FROM events)"""

PROC = """proc_record AS (
  SELECT user_id AS entity_id, ts AS event_ts, value AS duration,
    CASE event_type WHEN 'click' THEN '11' WHEN 'view' THEN '15' WHEN 'purchase' THEN '16' ELSE '99' END AS proc_code
  FROM events)"""

DIM = """entity_dim AS (
  SELECT c_custkey AS entity_id, c_mktsegment AS city, n_name AS county, r_name AS state,
    c_acctbal AS lon, CAST(c_nationkey AS DOUBLE) AS lat
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_COUNTS = """
    count(*) FILTER (WHERE outcome = 'answered') AS answered,
    count(*) FILTER (WHERE outcome = 'dropped') AS dropped,
    count(*) FILTER (WHERE outcome = 'missed') AS missed,
    count(*) FILTER (WHERE channel = 'call') AS call,
    count(*) FILTER (WHERE channel = 'text') AS text,
    count(*) AS total_records"""

SUMS = """
    sum(answered)::BIGINT AS answered, sum(dropped)::BIGINT AS dropped, sum(missed)::BIGINT AS missed,
    sum(call)::BIGINT AS call, sum(text)::BIGINT AS text, sum(total_records)::BIGINT AS total_records"""

MINUTE = f"""minute_kpi AS (
  SELECT date_trunc('minute', event_ts) AS datetime, entity_id, {_COUNTS}
  FROM event_record GROUP BY ALL)"""

HOUR = f"""hour_kpi AS (
  SELECT date_trunc('hour', datetime) AS datetime, entity_id, {SUMS}
  FROM minute_kpi GROUP BY 1, 2)"""

DAY = f"""day_kpi AS (
  SELECT date_trunc('day', datetime)::TIMESTAMP AS datetime, entity_id, {SUMS}
  FROM minute_kpi GROUP BY 1, 2)"""

LABELLED = """labelled AS (
  SELECT doc_id, quality, toxic, lang, source, n_chars FROM labels JOIN documents USING (doc_id))"""

SCORED = f"""{LABELLED}, scored AS (
  SELECT doc_id, quality AS label, lang, toxic, (doc_id * 37 % 101) / 100.0::DOUBLE AS score,
    CASE WHEN (doc_id * 37 % 101) / 100.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labelled)"""

RUNS = """run_record AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS name, o_orderdate AS started,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    CASE WHEN o_custkey % 10 <> 0 THEN o_totalprice END AS metric
  FROM orders)"""

SERIES = """series AS (
  SELECT event_type AS entity_id, date_trunc('hour', ts) AS ds, count(*)::DOUBLE AS y
  FROM events GROUP BY ALL),
history AS (
  SELECT * FROM series WHERE ds >= TIMESTAMP '2024-01-01' AND ds < TIMESTAMP '2024-01-15')"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
