"""The ingest and KPI levels as triggered streams over the event table."""
from datetime import timedelta

from pyspark.sql import functions as F, types as T

from netkpi import schemas
from netkpi.functions.scalar import utc_instant, utc_wallclock
from netkpi.operators import kpi, quality
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register, rounded
from netkpi.sources import adapters, files, tables
from netkpi.streaming import growing, history, ingest, late, rollup, run

DELAY = "10 minutes"


def _events(spark, sf_dir):
    # one file or a folder of files
    return ingest.file_stream(spark, f"{sf_dir}/events.parquet*", schemas.EVENT_TABLE, "parquet")


def _wallclock(out):
    for name, kind in out.dtypes:
        if kind == "timestamp":
            out = out.withColumn(name, utc_wallclock(name))
    return out


def _drain(spark, stream, label):
    return _wallclock(run.drain(stream, tables.fresh_path(spark, label), tables.fresh_path(spark, f"{label}-state")))


def _level(spark, stream, label):
    """All windows of a level; only their start leaves the stream."""
    out, state = tables.fresh_path(spark, label), tables.fresh_path(spark, f"{label}-state")
    return _wallclock(run.drain_levels(kpi.started(stream), out, state, ["datetime", "entity_id"]))


@register("stream_json_events", "H1 H9", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_json_events(spark, sf_dir):
    path = tables.fresh_path(spark, "events-json")
    adapters.load(spark, sf_dir, "events").write.option("timestampNTZFormat", files.TIME_FORMAT).json(path)
    return _drain(spark, ingest.file_stream(spark, path, schemas.EVENT_TABLE, max_files=4), "bronze")


def _rules():
    return {
        "key present": F.col("entity_id").isNotNull(), "time present": F.col("event_ts").isNotNull(),
        "kind known": F.col("outcome").isNotNull() | F.col("channel").isNotNull()}


@register("stream_silver", "H2 H3 C2", o.with_(o.EVENT, o.DIM) + """
SELECT entity_id, event_ts, outcome, channel, city, county, state, lon, lat FROM event_record JOIN entity_dim USING (entity_id)
WHERE outcome IS NOT NULL OR channel IS NOT NULL""")
def stream_silver(spark, sf_dir):
    records = ingest.with_event_time(adapters.as_event_records(_events(spark, sf_dir)))
    return _drain(spark, ingest.silver_stream(records, adapters.entity_dimension(spark, sf_dir), _rules()), "silver")


@register("stream_table_sink", "H8", o.with_(o.PROC) + "SELECT * FROM proc_record")
def stream_table_sink(spark, sf_dir):
    rows = adapters.as_procedure_records(_events(spark, sf_dir))
    name = tables.fresh_name("procedures")
    run.start_table(rows, name, tables.fresh_path(spark, name), tables.fresh_path(spark, f"{name}-state")).awaitTermination()
    return spark.table(name)


def _kpi_level(spark, sf_dir, interval, label):
    records = ingest.with_event_time(adapters.as_event_records(_events(spark, sf_dir)))
    return _level(spark, rollup.level_stream(records, DELAY, interval), label)


@register("stream_kpi_minute", "H4 H6", o.with_(o.EVENT, o.MINUTE) + "SELECT * FROM minute_kpi")
def stream_kpi_minute(spark, sf_dir):
    return _kpi_level(spark, sf_dir, "1 minute", "minute")


_MEASURES = ", ".join(
    f"round(avg(duration) FILTER (WHERE proc_code = '{c}'), 6) AS avg_{n}, max(duration) FILTER (WHERE proc_code = '{c}') AS max_{n}, "
    f"min(duration) FILTER (WHERE proc_code = '{c}') AS min_{n}" for c, n in kpi.PROCEDURE_CODES.items())


@register("stream_kpi_procedure", "H4", o.with_(o.PROC) + f"""
SELECT date_trunc('minute', event_ts) AS datetime, entity_id, {_MEASURES}, count(*) AS total_records FROM proc_record GROUP BY 1, 2""")
def stream_kpi_procedure(spark, sf_dir):
    records = ingest.with_event_time(adapters.as_procedure_records(_events(spark, sf_dir)))
    out = _level(spark, rollup.procedure_stream(records, DELAY), "procedure")
    return rounded(out, *[f"avg_{n}" for n in kpi.PROCEDURE_CODES.values()])


@register("stream_kpi_hour", "H5", o.with_(o.EVENT, o.MINUTE, o.HOUR) + "SELECT * FROM hour_kpi")
def stream_kpi_hour(spark, sf_dir):
    return _kpi_level(spark, sf_dir, "1 hour", "hour")


@register("stream_kpi_day", "H5", o.with_(o.EVENT, o.MINUTE, o.DAY) + "SELECT * FROM day_kpi")
def stream_kpi_day(spark, sf_dir):
    return _kpi_level(spark, sf_dir, "1 day", "day")


_CHAIN = o.with_(o.EVENT.replace("event_record AS", "every_record AS"), o.DIM, """event_record AS (
  SELECT e.* FROM every_record e JOIN entity_dim USING (entity_id) WHERE outcome IS NOT NULL OR channel IS NOT NULL)""",
                 o.MINUTE, o.HOUR, o.DAY) + "\nUNION ALL ".join(
    f"SELECT '{level}' AS level, * FROM {level}_kpi" for level in ("minute", "hour", "day"))


@register("stream_level_chain", "H1 H2 H3 H4 H5", _CHAIN)
def stream_level_chain(spark, sf_dir):
    """Stage after stage, each with its own checkpoint and files: bronze, silver, and from silver the minute, hour and day levels."""
    bronze, silver = tables.fresh_path(spark, "chain-bronze"), tables.fresh_path(spark, "chain-silver")
    run.start_files(_events(spark, sf_dir), bronze, tables.fresh_path(spark, "chain-bronze-state")).awaitTermination()
    arrived = ingest.file_stream(spark, bronze, schemas.EVENT_TABLE, "parquet")
    records = ingest.with_event_time(adapters.as_event_records(arrived))
    clean = ingest.silver_stream(records, adapters.entity_dimension(spark, sf_dir), _rules())
    run.start_files(clean, silver, tables.fresh_path(spark, "chain-silver-state")).awaitTermination()
    out = None
    for level in ("minute", "hour", "day"):
        stored = ingest.file_stream(spark, silver, clean.schema, "parquet").select("entity_id", "event_ts", "outcome", "channel")
        windows = _level(spark, rollup.level_stream(stored, DELAY, f"1 {level}"), f"chain-{level}")
        rows = windows.select(F.lit(level).alias("level"), *windows.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


@register("stream_unique_events", "H7", """
SELECT event_id, ts AS event_ts, user_id FROM events""")
def stream_unique_events(spark, sf_dir):
    """Every event arrives twice; one copy of each is kept."""
    twice = F.explode(F.array(F.lit(1), F.lit(2)))
    rows = _events(spark, sf_dir).select("event_id", F.col("ts").alias("event_ts"), "user_id", twice.alias("copy"))
    unique = ingest.unique_stream(ingest.with_event_time(rows.drop("copy")), ["event_id"], "event_ts", DELAY)
    return _drain(spark, unique, "unique")


def _halves(spark, sf_dir, label):
    """Two generations of event rows, the second with every third event."""
    events = adapters.load(spark, sf_dir, "events")
    path = tables.fresh_path(spark, label)
    second = F.col("event_id") % 3 == 0
    return path, events.filter(~second), events.filter(second)


@register("stream_growing_schema", "H1", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, CASE WHEN event_id % 3 <> 0 OR event_id % 7 <> 0 THEN value END AS value,
  CASE WHEN event_id % 3 = 0 THEN props END AS props, CASE WHEN event_id % 3 = 0 THEN value * 2 END AS score,
  CASE WHEN event_id % 3 = 0 THEN user_id END AS device_user, CASE WHEN event_id % 3 = 0 THEN event_type END AS device_kind,
  CASE WHEN event_id % 3 = 0 AND event_id % 7 = 0 THEN 'unknown' END AS rescued_value, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS first_version
FROM events""")
def stream_growing_schema(spark, sf_dir):
    """The second generation of files has three fields more, and text in a number field; the stream is restarted in between."""
    path, first, second = _halves(spark, sf_dir, "growing-in")
    ledger, out, state = (tables.fresh_path(spark, f"growing-{n}") for n in ("schema", "out", "state"))
    ledger = growing.SchemaLedger(spark, ledger)
    plain = ["event_id", "ts", "user_id", "event_type", "value"]
    value = F.when(F.col("event_id") % 7 == 0, "unknown")
    more = second.select(
        *plain[:-1], "props", (F.col("value") * 2).alias("score"), F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")).alias("device"),
        F.to_json(F.struct(F.col("value"))).alias("_number"), value.alias("_text"))
    # a number field that holds a text in some lines
    text = F.to_json(F.struct(*plain[:-1], "props", "score", "device"), {"timestampNTZFormat": files.TIME_FORMAT})
    line = F.concat(F.expr("left(_json, length(_json) - 1)"), F.when(F.col("_text").isNotNull(), F.lit(',"value":"unknown"}')).otherwise(
        F.when(F.col("_number") == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.expr("substring(_number, 2)")))))
    first.select(*plain).write.mode("append").option("timestampNTZFormat", files.TIME_FORMAT).json(path)
    growing.start(spark, path, ledger, out, state).awaitTermination()
    more.withColumn("_json", text).select(line.alias("value")).write.mode("append").text(path)
    growing.start(spark, path, ledger, out, state).awaitTermination()
    device = F.col("device")
    return growing.read(ledger, out).select(
        *plain, "props", "score", device["user"].alias("device_user"), device["kind"].alias("device_kind"),
        F.col(growing.RESCUED)["value"].alias("rescued_value"), F.when(device.isNotNull(), 2).otherwise(1).alias("first_version"))


@register("stream_rescued_fields", "H1", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS user_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS event_type,
  CASE WHEN event_id % 3 <> 0 THEN user_id::VARCHAR END AS rescued_user FROM events""")
def stream_rescued_fields(spark, sf_dir):
    """Only event_id is declared at first; before the second generation event_type and user_id are: the first one's types come back, too."""
    path, first, second = _halves(spark, sf_dir, "rescued-in")
    ledger, out, state = (tables.fresh_path(spark, f"rescued-{n}") for n in ("schema", "out", "state"))
    ledger = growing.SchemaLedger(spark, ledger)
    ledger.declare(T.StructType.fromDDL("event_id long"))
    for rows, later in ((first, "event_id long"), (second, "event_id long, user_id long, event_type string")):
        ledger.declare(T.StructType.fromDDL(later))
        rows.select("event_id", "user_id", "event_type").write.mode("append").json(path)
        growing.start(spark, path, ledger, out, state, grow=False).awaitTermination()
    stored = [spark.read.parquet(f"{out}/schema_version={n}") for n in (1, 2)]  # as they were written, before `read` brings them together
    old = stored[0].select("event_id", F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("string").alias("event_type"),
                           F.col(growing.RESCUED)["user_id"].alias("rescued_user"))
    return old.unionByName(stored[1].select("event_id", "user_id", "event_type", F.lit(None).cast("string").alias("rescued_user")))


def _chained(spark, sf_dir, interval, label):
    """Minute windows and the coarser ones over them in one append query, closed by a row far ahead, with a restart in between."""
    path, out, state = (tables.fresh_path(spark, f"{label}-{n}") for n in ("in", "out", "state"))
    events = adapters.load(spark, sf_dir, "events")

    def level():
        arrived = ingest.file_stream(spark, path, schemas.EVENT_TABLE, "parquet")
        records = ingest.with_event_time(adapters.as_event_records(arrived))
        return kpi.started(rollup.coarser_stream(rollup.minute_stream(records, DELAY), interval))

    events.write.mode("append").parquet(path)
    run.drain(level(), out, state)
    last = events.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("interval 40 days")).alias("ts"), F.lit(-1).cast("long").alias("user_id"),
        F.lit("error").alias("event_type"), F.lit(0.0).alias("value"), F.lit(None).cast("string").alias("props"))
    last.write.mode("append").parquet(path)
    return _wallclock(run.drain(level(), out, state))


@register("stream_chained_hour", "H5", o.with_(o.EVENT, o.MINUTE, o.HOUR) + "SELECT * FROM hour_kpi")
def stream_chained_hour(spark, sf_dir):
    return _chained(spark, sf_dir, "1 hour", "chained-hour")


@register("stream_chained_day", "H5", o.with_(o.EVENT, o.MINUTE, o.DAY) + "SELECT * FROM day_kpi")
def stream_chained_day(spark, sf_dir):
    return _chained(spark, sf_dir, "1 day", "chained-day")


def _split(spark, sf_dir):
    """Every third event comes in a second run, after the watermark of the first has passed most of them."""
    path, first, second = _halves(spark, sf_dir, "late-in")
    split = late.LateRows(spark, tables.fresh_path(spark, "late"), "ts", timedelta(minutes=10), timedelta(hours=1))
    state = tables.fresh_path(spark, "late-state")
    for rows in (first, second):
        rows.write.mode("append").parquet(path)
        arrived = ingest.file_stream(spark, path, schemas.EVENT_TABLE, "parquet").withColumn("ts", utc_instant("ts"))
        split.start(arrived, state).awaitTermination()
    return split, arrived.schema


_LATE = """WITH mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS passed FROM events WHERE event_id % 3 <> 0),
sided AS (SELECT e.*, e.event_id % 3 = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= passed AS is_late FROM events e, mark)
"""


@register("stream_late_rows", "H6", _LATE + "SELECT event_id, user_id, CASE WHEN is_late THEN 'late' ELSE 'kept' END AS side, (event_id % 3 = 0)::INTEGER AS batch FROM sided")
def stream_late_rows(spark, sf_dir):
    split, schema = _split(spark, sf_dir)
    sides = [split.rows(side, schema).select("event_id", "user_id", F.lit(side).alias("side"), F.col("batch_id").cast("int").alias("batch"))
             for side in (late.KEPT, late.LATE)]
    return sides[0].unionByName(sides[1])


@register("stream_late_counts", "H6", _LATE + """
SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS batch_id, count(*) AS n_rows, count(*) FILTER (WHERE NOT is_late) AS n_kept,
  count(*) FILTER (WHERE is_late) AS n_late FROM sided GROUP BY 1""")
def stream_late_counts(spark, sf_dir):
    return _split(spark, sf_dir)[0].counts()


@register("stream_hour_in_time", "H6 H4", _LATE + """
SELECT date_trunc('hour', ts) AS datetime, user_id AS entity_id, count(*) AS n FROM sided WHERE NOT is_late GROUP BY 1, 2""")
def stream_hour_in_time(spark, sf_dir):
    """The stateful step over the rows in time: it drops none of them."""
    split, schema = _split(spark, sf_dir)
    rows = split.kept_stream(schema).withColumnRenamed("user_id", "entity_id").withWatermark("ts", DELAY)
    return _level(spark, kpi.windowed(rows, "ts", ["entity_id"], "1 hour", {"n": F.count(F.lit(1))}), "in-time")


@register("stream_rule_history", "B12 H3", o.with_(o.PROC) + """
SELECT 'duration above 100' AS rule, count(*) AS rows_seen, count(*) FILTER (WHERE NOT coalesce(duration > 100, FALSE)) AS violations, 2 AS n_batches FROM proc_record
UNION ALL
SELECT 'known code', count(*), count(*) FILTER (WHERE NOT coalesce(proc_code <> '99', FALSE)), 2 FROM proc_record""")
def stream_rule_history(spark, sf_dir):
    """Two runs of one stream; the counts of their batches add up to those of `quality_metrics`."""
    rules = {"duration above 100": F.col("duration") > 100, "known code": F.col("proc_code") != "99"}
    path, first, second = _halves(spark, sf_dir, "rules-in")
    out, state = tables.fresh_path(spark, "rules-out"), tables.fresh_path(spark, "rules-state")
    told = history.RuleHistory(spark, tables.fresh_path(spark, "rules"), "rules").watch()
    try:
        for rows in (first, second):
            rows.write.mode("append").parquet(path)
            arrived = adapters.as_procedure_records(ingest.file_stream(spark, path, schemas.EVENT_TABLE, "parquet"))
            told.wait(run.start_files(quality.observe_rules(arrived, rules, "rules"), out, state))
    finally:
        told.close()
    return told.read().groupBy("rule").agg(
        F.sum("rows_seen").alias("rows_seen"), F.sum("violations").alias("violations"), F.count_distinct("batch_id").cast("int").alias("n_batches"))


@register("stream_inventory", "H10", """
SELECT * FROM (VALUES ('started', 'clicks', 1), ('started', 'views', 1), ('stopped', 'clicks', 0), ('stopped', 'views', 0)) t(step, name, active),
(SELECT count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'view') AS views FROM events)""")
def stream_inventory(spark, sf_dir):
    """Two named streams are started, waited for until their tables have rows, listed, stopped and listed again."""
    prefix, names, rows = tables.fresh_name("inventory"), {"click": "clicks", "view": "views"}, []
    stored = {}
    try:
        for kind, name in names.items():
            stream = _events(spark, sf_dir).filter(F.col("event_type") == kind)
            stored[name] = f"{prefix}_{name}"
            run.start_table(stream, stored[name], tables.fresh_path(spark, name), tables.fresh_path(spark, f"{name}-state"),
                            name=f"{prefix}_{name}", available_now=False)
        for name in names.values():
            if not run.await_rows(spark, stored[name], 120):
                raise TimeoutError(name)
        rows += [("started", q.name.removeprefix(f"{prefix}_"), int(q.isActive)) for q in run.active_streams(spark, prefix)]
    finally:
        stopped = run.stop_streams(spark, prefix)
    active = {q.name for q in run.active_streams(spark, prefix)}
    rows += [("stopped", n.removeprefix(f"{prefix}_"), int(n in active)) for n in stopped]
    counts = {n: spark.table(stored[n]).count() for n in names.values()}
    return spark.createDataFrame([(*r, counts["clicks"], counts["views"]) for r in rows], "step string, name string, active int, clicks long, views long")
