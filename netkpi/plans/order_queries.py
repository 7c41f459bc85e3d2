"""Top rows, samples, newest and best runs, versions, profiles."""
from pyspark.sql import functions as F

from netkpi.functions import scalar
from netkpi.operators import ledger, ordering, profile, scoring, sketches
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register, rounded
from netkpi.sources import adapters, tables
from netkpi.sources.versions import VersionedTable


@register("newest_run_of_name", "E1", o.with_(o.RUNS) + """
SELECT run_id, name, started, status FROM run_record WHERE name = '1-URGENT' ORDER BY started DESC, run_id DESC LIMIT 1""")
def newest_run_of_name(spark, sf_dir):
    return ledger.newest_run(adapters.run_records(spark, sf_dir).drop("metric"), "1-URGENT")


@register("newest_run_per_name", "E1", o.with_(o.RUNS) + """
SELECT run_id, name, started, status FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY started DESC, run_id DESC) AS rn FROM run_record) WHERE rn = 1""")
def newest_run_per_name(spark, sf_dir):
    return ledger.newest_run_per_name(adapters.run_records(spark, sf_dir).drop("metric"))


@register("best_finished_run", "E2", o.with_(o.RUNS) + """
SELECT * FROM run_record WHERE status = 'FINISHED' ORDER BY metric ASC NULLS LAST, run_id LIMIT 1""")
def best_finished_run(spark, sf_dir):
    return ledger.best_run(adapters.run_records(spark, sf_dir), F.col("metric"))


@register("best_finished_run_highest", "E2", o.with_(o.RUNS) + """
SELECT * FROM run_record WHERE status = 'FINISHED' ORDER BY metric DESC NULLS LAST, run_id LIMIT 1""")
def best_finished_run_highest(spark, sf_dir):
    return ledger.best_run(adapters.run_records(spark, sf_dir), F.col("metric"), lower_is_better=False)


@register("run_ledger", "G13 A9", """
SELECT o_orderkey::VARCHAR AS run_id, o_orderpriority AS name, o_orderstatus AS trigger, round(o_totalprice / 1000, 6) AS smape
FROM orders""")
def run_ledger(spark, sf_dir):
    """Runs appended in two batches, params and metrics as maps; read back and unpacked."""
    orders = adapters.load(spark, sf_dir, "orders")
    runs = orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("name"),
        F.lit("FINISHED").alias("status"), F.col("o_orderdate").alias("started"), F.lit("orders").alias("source_table"),
        F.create_map(F.lit("trigger"), "o_orderstatus").alias("params"),
        F.create_map(F.lit("smape"), F.round(F.col("o_totalprice") / 1000, 6)).alias("metrics"))
    name, path = tables.fresh_name("runs"), tables.fresh_path(spark, "runs")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    ledger.append_runs(runs.filter(F.col("started") < cut), name, path)
    stored = ledger.append_runs(runs.filter(F.col("started") >= cut), name, path)
    return stored.select("run_id", "name", F.col("params")["trigger"].alias("trigger"), F.col("metrics")["smape"].alias("smape"))


@register("highest_version", "D15", """
SELECT p_name, max(CAST(p_size::VARCHAR AS INTEGER)) AS version FROM part GROUP BY 1""")
def highest_version(spark, sf_dir):
    """Versions are text; compared as numbers, so 10 beats 9."""
    parts = adapters.load(spark, sf_dir, "part").select("p_name", F.col("p_size").cast("string").alias("v"))
    return parts.groupBy("p_name").agg(F.max(F.col("v").cast("int")).alias("version"))


@register("ordered_series", "E3", """
SELECT user_id AS entity_id, ts AS ds, value FROM events ORDER BY entity_id, ds""")
def ordered_series(spark, sf_dir):
    return adapters.load(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity_id"), F.col("ts").alias("ds"), "value").orderBy("entity_id", "ds")


@register("first_rows", "E4", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 5")
def first_rows(spark, sf_dir):
    events = adapters.load(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return ordering.top_rows(events, [F.col("ts"), F.col("event_id")], 5)


@register("last_rows_per_series", "E4", """
SELECT event_id, ts, user_id, position FROM (
  SELECT event_id, ts, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)::INTEGER AS position FROM events)
WHERE position <= 3""")
def last_rows_per_series(spark, sf_dir):
    events = adapters.load(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return ordering.top_rows_per_group(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3)


@register("seeded_sample", "E5", o.with_(o.LABELLED) + """
SELECT doc_id, quality, toxic, lang, source, n_chars FROM labelled ORDER BY md5('42|' || doc_id::VARCHAR), doc_id LIMIT 100""")
def seeded_sample(spark, sf_dir):
    return ordering.repeatable_sample(adapters.labelled_rows(spark, sf_dir), "doc_id", 100, 42)


@register("at_risk_top", "E7", o.with_(o.SCORED) + """
SELECT doc_id, score FROM scored ORDER BY score DESC, doc_id LIMIT 20""")
def at_risk_top(spark, sf_dir):
    scored = adapters.scored_rows(spark, sf_dir).select("doc_id", "score")
    return ordering.top_rows(scored, [F.col("score").desc(), F.col("doc_id")], 20)


@register("at_risk_per_segment", "E7", o.with_(o.SCORED) + """
SELECT doc_id, lang, score, position FROM (
  SELECT doc_id, lang, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id)::INTEGER AS position FROM scored)
WHERE position <= 5""")
def at_risk_per_segment(spark, sf_dir):
    scored = adapters.scored_rows(spark, sf_dir).select("doc_id", "lang", "score")
    return ordering.top_rows_per_group(scored, ["lang"], [F.col("score").desc(), F.col("doc_id")], 5)


_NUM = ("o_orderkey", "o_custkey", "o_totalprice")


@register("profile_numeric", "D16", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS missing,
  count(*) FILTER (WHERE {c} = 0) AS zeros, round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std,
  min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, count(DISTINCT {c}) AS n_distinct,
  (SELECT v FROM (SELECT {c}::DOUBLE AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, v LIMIT 1)) AS top,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c})) AS top_count,
  round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median,
  round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75 FROM orders""" for c in _NUM))
def profile_numeric(spark, sf_dir):
    out = profile.numeric_profile(adapters.load(spark, sf_dir, "orders"), _NUM)
    return rounded(out, "mean", "std", "q25", "median", "q75", places=4)


_TEXT = ("o_orderstatus", "o_orderpriority")


@register("profile_text", "D16", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(DISTINCT {c}) AS n_distinct,
  (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, v LIMIT 1)) AS top,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c})) AS top_count FROM orders""" for c in _TEXT))
def profile_text(spark, sf_dir):
    return profile.text_profile(adapters.load(spark, sf_dir, "orders"), _TEXT)


@register("profile_histogram", "D16", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", least(floor(({c}::DOUBLE - lo) / (hi - lo) * 10), 9)::BIGINT AS bin, count(*) AS n
FROM orders, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM orders) GROUP BY ALL""" for c in _NUM))
def profile_histogram(spark, sf_dir):
    return profile.histogram(adapters.load(spark, sf_dir, "orders"), _NUM)


@register("profile_quick", "D16")
def profile_quick(spark, sf_dir):
    return profile.quick_profile(adapters.load(spark, sf_dir, "orders"), _NUM)


@register("profile_quick_checks", "D16", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS missing, 1 AS distinct_close, 1 AS quartiles_close
FROM orders""" for c in _NUM))
def profile_quick_checks(spark, sf_dir):
    """The sketches held against whole columns: distinct values within a tenth, quartiles within a thousandth of the rows."""
    orders = adapters.load(spark, sf_dir, "orders").select(*_NUM)
    # one row per column of the table
    quick = F.broadcast(profile.quick_profile(orders, _NUM))
    exact = F.broadcast(orders.agg(*[F.count_distinct(c).alias(c) for c in _NUM]).unpivot([], list(_NUM), "column", "exact"))
    cells = orders.select(*[F.col(c).cast("double").alias(c) for c in _NUM]).unpivot([], list(_NUM), "column", "value")
    n = F.count("value")
    close = [(F.count_if(F.col("value") < q) <= n * (share + 0.001)) & (F.count_if(F.col("value") <= q) >= n * (share - 0.001))
             for i, share in enumerate(profile.QUARTILES.values()) for q in [F.col("quartiles")[i]]]
    ranks = cells.join(quick.select("column", "quartiles"), "column").groupBy("column").agg(
        (close[0] & close[1] & close[2]).cast("int").alias("quartiles_close"))
    return quick.join(exact, "column").join(ranks, "column").select(
        "column", "n_rows", "missing", (F.abs(F.col("n_distinct") / F.col("exact") - 1) < 0.1).cast("int").alias("distinct_close"),
        "quartiles_close")


@register("slice_accuracy", "D14", o.with_(o.SCORED) + """
SELECT lang, toxic, count(*) FILTER (WHERE prediction = label) AS n_right, count(*) AS n_seen,
  round(count(*) FILTER (WHERE prediction = label) / count(*)::DOUBLE, 6) AS accuracy FROM scored GROUP BY 1, 2""")
def slice_accuracy(spark, sf_dir):
    return rounded(scoring.slice_accuracy(adapters.scored_rows(spark, sf_dir), ["lang", "toxic"]), "accuracy")


@register("band_checks", "B26 B27", """
WITH b AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value END AS actual, 5.0::DOUBLE AS lo,
  50.0 + (event_id % 3)::DOUBLE AS hi FROM events)
SELECT event_id, CASE WHEN actual IS NULL THEN NULL WHEN actual < lo OR actual > hi THEN 1.0 ELSE 0.0 END::DOUBLE AS is_anomaly,
  round(CASE WHEN actual < lo THEN lo - actual WHEN actual > hi THEN actual - hi END, 6) AS anomaly_size FROM b""")
def band_checks(spark, sf_dir):
    actual, lo, hi = F.col("actual"), F.lit(5.0), F.lit(50.0) + F.col("event_id") % 3
    rows = adapters.load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("actual"))
    return rows.select(
        "event_id", scalar.outside_band(actual, lo, hi).cast("double").alias("is_anomaly"),
        F.round(scalar.band_distance(actual, lo, hi), 6).alias("anomaly_size"))


_EVENT_COLUMNS = {"event_id": "event_id::DOUBLE", "user_id": "user_id::DOUBLE", "value": "value", "ts": "epoch_us(ts)::DOUBLE", "event_type": "NULL::DOUBLE"}


def _sketched(spark, sf_dir):
    """A month of events by day; two days are done again, and days 3 to 20 are asked for."""
    events = adapters.load(spark, sf_dir, "events")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    table = VersionedTable(spark, tables.fresh_path(spark, "event-sketches"))
    for rows in (events, events.filter(day.isin(5, 6))):
        sketches.store(table, sketches.part_sketches(rows, day, list(_EVENT_COLUMNS)))
    return sketches.profile(table.read(), 3, 20), events.filter(day.between(3, 20))


@register("profile_from_sketches", "D16", "WITH e AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-04' AND ts < TIMESTAMP '2024-01-22')" + "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS missing, {"NULL::DOUBLE" if c == "ts" else f"round(avg({x}), 3)"} AS mean, min({x}) AS min, max({x}) AS max,
  1 AS distinct_in_bound, 1 AS ranks_in_bound, CASE WHEN count(DISTINCT {c}) <= 1000 THEN (SELECT max(n) FROM (SELECT count(*) AS n FROM e GROUP BY {c})) END AS top_count
FROM e""" for c, x in _EVENT_COLUMNS.items()))
def profile_from_sketches(spark, sf_dir):
    """What is exact as it is; distinct counts and ranks of the quartiles held against all rows of the range; the greatest count where
    all values are tracked."""
    found, rows = _sketched(spark, sf_dir)
    found = tables.materialize(found, "sketch-profile")
    number = {c: F.col(c).cast("double") for c in ("event_id", "user_id", "value")}
    number["ts"] = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).cast("double")
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"), number.get(c, F.lit(None).cast("double")).alias("x")) for c in _EVENT_COLUMNS]
    # the profile has one row per column
    held = rows.select(F.inline(F.array(*items))).join(F.broadcast(found.select("column", *sketches.QUANTILES)), "column")
    sides = [F.count_if(F.col("x") < F.col(q)).alias(f"below_{q}") for q in sketches.QUANTILES] + [
        F.count_if(F.col("x") <= F.col(q)).alias(f"upto_{q}") for q in sketches.QUANTILES]
    exact = held.groupBy("column").agg(F.count("x").alias("n"), F.count_distinct("v").alias("n_exact"), *sides)
    ranks = F.lit(True)
    for name, q in sketches.QUANTILES.items():
        ranks = ranks & ((F.col("n") == 0) | (F.col(f"below_{name}") <= (q + 0.02) * F.col("n")) & (F.col(f"upto_{name}") >= (q - 0.02) * F.col("n")))
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    return found.join(F.broadcast(exact), "column").select(
        "column", "n_rows", "missing", F.when(F.col("kind") != "time", F.round("mean", 3)).alias("mean"), "min", "max",
        (off <= F.greatest(F.lit(1.0), 0.07 * F.col("n_exact"))).cast("int").alias("distinct_in_bound"), ranks.cast("int").alias("ranks_in_bound"),
        F.when(F.col("n_exact") <= sketches.TRACKED, F.col("top_count")).alias("top_count"))


@register("profile_times", "D16", """
WITH e AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-04' AND ts < TIMESTAMP '2024-01-22')
SELECT 'ts' AS "column", count(*) AS n_rows, min(ts) AS first, max(ts) AS last, 1 AS median_between FROM e""")
def profile_times(spark, sf_dir):
    """A time column, profiled from sketches and given as times."""
    found, _ = _sketched(spark, sf_dir)
    return found.filter("kind = 'time'").select(
        "column", "n_rows", sketches.as_time(F.col("min")).alias("first"), sketches.as_time(F.col("max")).alias("last"),
        F.col("median").between(F.col("q25"), F.col("q75")).cast("int").alias("median_between"))
