"""Edge cases of rules, joins and windows."""
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from netkpi.operators import enrich, kpi, quality
from netkpi.sources import adapters

EVENTS = "entity_id long, event_ts timestamp_ntz, outcome string, channel string"


def events(spark, *data):
    return spark.createDataFrame(list(data), EVENTS)


def test_null_and_unknown_kinds_count_in_the_total_only(spark, rows):
    df = events(spark, (1, dt(2024, 1, 1), None, None), (1, dt(2024, 1, 1, 0, 0, 59), "odd", "odd"),
                (1, dt(2024, 1, 1), "dropped", "call"))
    out = kpi.minute_kpi(df)
    assert rows(out, "answered", "dropped", "missed", "call", "text", "total_records") == [(0, 1, 0, 1, 0, 3)]


def test_window_bounds_are_half_open_and_empty_windows_absent(spark, rows):
    df = events(spark, (1, dt(2024, 1, 1, 0, 0, 59, 999999), "missed", None), (1, dt(2024, 1, 1, 0, 1), "missed", None),
                (1, dt(2024, 1, 1, 0, 5), "missed", None))
    assert rows(kpi.minute_kpi(df), "datetime") == [
        (dt(2024, 1, 1, 0, 0),), (dt(2024, 1, 1, 0, 1),), (dt(2024, 1, 1, 0, 5),)]


def test_unmatched_facts_are_lost_and_duplicate_keys_fan_out(spark, rows):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "entity_id long, city string")
    df = events(spark, (1, dt(2024, 1, 1), "missed", None), (2, dt(2024, 1, 1), "missed", None))
    assert rows(enrich.join_dimension(df, dim), "entity_id", "city") == [(1, "a"), (1, "b")]
    assert rows(quality.key_audit(dim, ["entity_id"])) == [(1, 2)]


def test_both_keys_can_be_kept(spark):
    dim = spark.createDataFrame([(1, "a")], "entity_id long, city string")
    df = events(spark, (1, dt(2024, 1, 1), "missed", None))
    assert {"entity_id", "dim_entity_id"} <= set(enrich.join_dimension(df, dim, keep_both_keys=True).columns)


def test_levels_add_up(spark):
    minute = kpi.minute_kpi(adapters.event_records(spark, "/root/testdata/sf0.001"))
    n = adapters.load(spark, "/root/testdata/sf0.001", "events").count()
    for interval in ("15 minutes", "1 hour", "1 day", "7 days"):
        level = kpi.rollup_kpi(minute, interval, ["entity_id"], kpi.EVENT_SUMS)
        assert level.agg(F.sum("total_records")).first()[0] == n
        bad = level.filter(F.col("answered") + F.col("dropped") + F.col("missed") > F.col("total_records"))
        assert bad.isEmpty()


def test_late_join_equals_early_join(spark, rows):
    sf = "/root/testdata/sf0.001"
    ev, dim = adapters.event_records(spark, sf), adapters.entity_dimension(spark, sf)
    late = kpi.minute_kpi(ev).join(dim, "entity_id")
    early = kpi.tumbling_kpi(ev.join(dim, "entity_id"), "event_ts", ["entity_id", "city", "state"], "1 minute", kpi.event_counts())
    cols = ("datetime", "entity_id", "city", "state", "total_records", "dropped")
    assert rows(late, *cols) == rows(early, *cols)


def test_procedures_without_a_code_are_null(spark, rows):
    df = spark.createDataFrame([(1, dt(2024, 1, 1), "11", 2.0), (1, dt(2024, 1, 1), "11", 4.0), (1, dt(2024, 1, 1), "99", 9.0)],
                               "entity_id long, event_ts timestamp_ntz, proc_code string, duration double")
    out = kpi.procedure_kpi(df)
    assert rows(out, "avg_release_bearer", "max_release_bearer", "min_setup_bearer", "total_records") == [(3.0, 4.0, None, 3)]


def test_unknown_rule_result_is_a_violation(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id long, duration double")
    rules = {"positive": F.col("duration") > 0, "id below 9": F.col("id") < 9}
    assert rows(quality.drop_violations(df, rules), "id") == [(1,)]
    assert rows(quality.rule_metrics(df, rules)) == [("id below 9", 3, 0), ("positive", 3, 2)]


def test_observed_rules_do_not_drop_rows(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, 5.0), (2, None)], "id long, duration double")
    seen = Observation("rules")
    out = quality.observe_rules(df, {"positive": F.col("duration") > 0}, seen)
    assert out.count() == 2
    assert seen.get == {"rows_seen": 2, "positive": 1}


def test_newest_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, v long, t string")
    assert rows(quality.newest_per_key(df, ["k"], [F.col("v")])) == [(1, 2, "b"), (2, 1, "c")]


def test_short_coordinates_give_null(spark, rows):
    from netkpi import schemas

    df = spark.createDataFrame([((7, "c", "k", "s"), ([1.5],))], schemas.NESTED_DIMENSION)
    assert rows(enrich.flatten_dimension(df), "entity_id", "lon", "lat") == [(7, 1.5, None)]


def test_empty_period_has_no_rate(spark):
    minute = kpi.minute_kpi(events(spark, (1, dt(2024, 1, 1), "missed", None)))
    assert kpi.period_totals(minute, "2030-01-01", "2030-02-01").first()["drop_rate"] is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_day_windows_do_not_depend_on_the_session_zone(spark, rows, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = events(spark, (1, dt(2024, 3, 10, 2, 30), "missed", None), (1, dt(2024, 3, 10, 23, 59), "missed", None))
        day = kpi.rollup_kpi(kpi.minute_kpi(df), "1 day", ["entity_id"], kpi.EVENT_SUMS)
        assert rows(day, "datetime", "total_records") == [(dt(2024, 3, 10), 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_salted_join_equals_plain_join(spark, rows):
    sf = "/root/testdata/sf0.001"
    ev, dim = adapters.event_records(spark, sf), adapters.entity_dimension(spark, sf)
    plain = enrich.join_dimension(ev, dim)
    for other in (enrich.join_dimension(ev, dim, salts=7), enrich.enrich_facts(ev, dim),
                  enrich.enrich_facts(ev, dim, salts=5, max_bytes=0)):
        assert other.columns == plain.columns
        assert other.exceptAll(plain).isEmpty() and plain.exceptAll(other).isEmpty()


def test_broadcast_only_below_the_measured_size(spark):
    sf = "/root/testdata/sf0.001"
    ev, dim = adapters.event_records(spark, sf), adapters.entity_dimension(spark, sf)
    size = enrich.measured_bytes(dim)
    assert 150 * 6 * 8 < size < 150 * 200
    assert enrich.broadcast_if_small(dim, size)[1] and not enrich.broadcast_if_small(dim, size - 1)[1]
    hinted = enrich.enrich_facts(ev, dim)._jdf.queryExecution().logical().toString()
    plain = enrich.enrich_facts(ev, dim, max_bytes=0)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted and "broadcast" not in plain
