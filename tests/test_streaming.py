"""Streams against their batch form; late rows; restart; control by name."""
from datetime import datetime as dt, timedelta

import pytest
from pyspark.sql import functions as F

from netkpi import schemas
from netkpi.functions.scalar import utc_instant, utc_wallclock
from netkpi.operators import kpi
from netkpi.sources import adapters, files, tables
from netkpi.streaming import ingest, rollup, run

SF = "/root/testdata/sf0.001"


def write_json(spark, rows, path, mode="append"):
    df = spark.createDataFrame(rows, schemas.EVENT_TABLE).coalesce(1)
    df.write.mode(mode).option("timestampNTZFormat", files.TIME_FORMAT).json(path)


def event(i, ts, kind="error", user=1):
    return (i, ts, user, kind, 1.0, "{}")


def source(spark, path):
    return ingest.with_event_time(adapters.as_event_records(ingest.file_stream(spark, path, schemas.EVENT_TABLE)))


@pytest.mark.parametrize("interval", ["1 hour", "1 day"])
def test_stream_equals_batch_once_all_windows_are_closed(spark, interval):
    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    adapters.load(spark, SF, "events").write.option("timestampNTZFormat", files.TIME_FORMAT).json(path)
    chain = lambda: kpi.started(rollup.coarser_stream(rollup.minute_stream(source(spark, path), "10 minutes"), interval))
    run.drain(chain(), out, state)
    write_json(spark, [event(10 ** 9, dt(2030, 1, 1), user=-1)], path)  # pushes the watermark past everything
    got = run.drain(chain(), out, state).withColumn("datetime", utc_wallclock("datetime"))
    want = kpi.rollup_kpi(kpi.minute_kpi(adapters.event_records(spark, SF)), interval, ["entity_id"], kpi.EVENT_SUMS)
    want = want.select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_late_row_is_dropped_and_restart_repeats_nothing(spark, rows):
    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    t = dt(2024, 1, 1, 12)
    write_json(spark, [event(1, t), event(2, t + timedelta(hours=1))], path)
    minute = lambda: kpi.started(rollup.minute_stream(source(spark, path), "10 minutes"))
    assert rows(run.drain(minute(), out, state), "dropped") == [(1,)]
    write_json(spark, [event(3, t), event(4, t + timedelta(hours=3))], path)  # event 3 is an hour late
    got = run.drain(minute(), out, state).withColumn("datetime", utc_wallclock("datetime"))
    assert rows(got, "datetime", "dropped") == [(t, 1), (t + timedelta(hours=1), 1)]
    assert run.drain(minute(), out, state).count() == 2


def test_duplicates_within_the_delay_are_removed(spark, rows):
    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    t = dt(2024, 1, 1, 12)
    write_json(spark, [event(1, t), event(1, t), event(2, t + timedelta(minutes=1))], path)
    stream = ingest.file_stream(spark, path, schemas.EVENT_TABLE).withColumnRenamed("ts", "event_ts")
    unique = lambda: ingest.unique_stream(ingest.with_event_time(stream), ["event_id"], "event_ts", "10 minutes")
    run.drain(unique(), out, state)
    write_json(spark, [event(1, t), event(3, t)], path)  # a copy in a later run
    assert rows(run.drain(unique(), out, state), "event_id") == [(1,), (2,), (3,)]


def test_rules_and_static_join_on_a_stream(spark, rows):
    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    write_json(spark, [event(1, dt(2024, 1, 1)), event(2, dt(2024, 1, 1), user=None), event(3, dt(2024, 1, 1), user=99)], path)
    dim = spark.createDataFrame([(1, "c")], "entity_id long, city string")
    silver = ingest.silver_stream(source(spark, path), dim, {"key present": F.col("entity_id").isNotNull()})
    assert rows(run.drain(silver, out, state), "entity_id", "city") == [(1, "c")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instant_and_wall_clock_are_inverse(spark, rows, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(dt(2024, 7, 1, 5, 6, 7),)], "t timestamp_ntz").withColumn("i", utc_instant("t"))
        assert df.select(F.unix_seconds("i")).first()[0] == 1719810367
        assert rows(df.select(utc_wallclock("i"))) == [(dt(2024, 7, 1, 5, 6, 7),)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_streams_are_controlled_by_name(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    for n in ("kpi_a", "kpi_b", "other"):
        run.start_files(rate, tables.fresh_path(spark, n), tables.fresh_path(spark, "s"), name=n, available_now=False)
    try:
        assert sorted(q.name for q in run.active_streams(spark, "kpi_")) == ["kpi_a", "kpi_b"]
        assert not run.await_streams(spark, "kpi_", 1)
        assert sorted(run.stop_streams(spark, "kpi_")) == ["kpi_a", "kpi_b"]
        assert [q.name for q in run.active_streams(spark, "")] == ["other"]
    finally:
        run.stop_streams(spark, "")
    assert run.await_streams(spark, "kpi_", 1)


def test_waiting_for_a_table(spark):
    name = tables.fresh_name("late")
    assert not run.await_rows(spark, name, 1)
    path, state = tables.fresh_path(spark, "in"), tables.fresh_path(spark, "state")
    write_json(spark, [event(1, dt(2024, 1, 1))], path)
    stream = ingest.file_stream(spark, path, schemas.EVENT_TABLE)
    run.start_table(stream, name, tables.fresh_path(spark, name), state).awaitTermination()
    assert run.await_rows(spark, name, 20)


def test_observed_rules_arrive_with_the_progress(spark):
    from netkpi.operators.quality import observe_rules

    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    write_json(spark, [event(1, dt(2024, 1, 1)), event(2, dt(2024, 1, 1), user=None)], path)
    stream = observe_rules(source(spark, path), {"no_key": F.col("entity_id").isNotNull()}, "rules")
    query = run.start_files(stream, out, state)
    query.awaitTermination()
    seen = [p.observedMetrics["rules"] for p in query.recentProgress if "rules" in p.observedMetrics]
    assert sum(r["rows_seen"] for r in seen) == 2 and sum(r["no_key"] for r in seen) == 1


def test_a_new_column_is_read_once_it_is_declared(spark, rows):
    path = tables.fresh_path(spark, "in")
    spark.createDataFrame([(1,)], "id long").write.mode("append").json(path)
    spark.createDataFrame([(2, "x")], "id long, extra string").write.mode("append").json(path)
    from pyspark.sql import types as T

    grown = T.StructType.fromDDL("id long, extra string")
    got = run.drain(ingest.file_stream(spark, path, grown), tables.fresh_path(spark, "out"), tables.fresh_path(spark, "state"))
    assert rows(got, "id", "extra") == [(1, None), (2, "x")]


def test_level_holds_open_windows_and_their_newest_count(spark, rows):
    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    t = dt(2024, 1, 1, 12)
    level = lambda: run.drain_levels(
        kpi.started(rollup.level_stream(source(spark, path), "10 minutes", "1 hour")), out, state, ["datetime", "entity_id"])
    read = lambda: rows(level().withColumn("datetime", utc_wallclock("datetime")), "datetime", "dropped")
    write_json(spark, [event(1, t), event(2, t + timedelta(hours=1))], path)
    assert read() == [(t, 1), (t + timedelta(hours=1), 1)]
    write_json(spark, [event(3, t + timedelta(hours=1, minutes=5)), event(4, t + timedelta(hours=3))], path)
    want = [(t, 1), (t + timedelta(hours=1), 2), (t + timedelta(hours=3), 1)]
    assert read() == want and read() == want


def test_level_files_stay_bounded_over_many_batches(spark, rows):
    from netkpi.sources import small_files
    from netkpi.sources.versions import VersionedTable

    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    t, n = dt(2024, 1, 1, 12), 50
    for i in range(n):
        write_json(spark, [event(i, t + timedelta(hours=i % 3), user=i % 2)], path)
    stream = ingest.with_event_time(adapters.as_event_records(ingest.file_stream(spark, path, schemas.EVENT_TABLE, max_files=1)))
    level = run.drain_levels(kpi.started(rollup.level_stream(stream, "1 day", "1 hour")), out, state, ["datetime", "entity_id"])
    assert sum(r[0] for r in rows(level, "dropped")) == n and level.count() == 6
    table = VersionedTable(spark, out)
    assert len(table.numbers()) == 2 and table.version().properties["batch"] >= n - 1
    assert len(level.inputFiles()) == 1 and len(small_files.names(spark, f"{out}/data")) <= 2


def test_a_repeated_batch_changes_no_level(spark, rows, monkeypatch):
    from netkpi.sources.versions import VersionedTable

    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    t = dt(2024, 1, 1, 12)
    write_json(spark, [event(1, t)], path)
    level = lambda: run.drain_levels(
        kpi.started(rollup.level_stream(source(spark, path), "10 minutes", "1 hour")), out, state, ["datetime", "entity_id"])
    merge = VersionedTable.merge

    def lost_after(self, *args, **kw):
        merge(self, *args, **kw)
        raise RuntimeError("lost after the version was written")

    monkeypatch.setattr(VersionedTable, "merge", lost_after)
    with pytest.raises(Exception):
        level()
    monkeypatch.undo()
    assert rows(level(), "dropped") == [(1,)] and VersionedTable(spark, out).numbers() == [1]


def split_of(spark, path, window=timedelta(minutes=1)):
    from netkpi.streaming.late import LateRows

    return LateRows(spark, tables.fresh_path(spark, "split"), "event_ts", timedelta(minutes=10), window)


def test_late_rows_are_kept_apart_and_counted(spark, rows):
    from netkpi.streaming.late import KEPT, LATE

    path, state, out, state2 = (tables.fresh_path(spark, p) for p in ("in", "state", "out", "state2"))
    split, t = split_of(spark, path), dt(2024, 1, 1, 12)
    batches = [[event(1, t), event(2, t + timedelta(hours=1))], [event(3, t), event(4, t + timedelta(minutes=49, seconds=30)), event(5, t + timedelta(hours=3))],
               [event(6, t + timedelta(hours=2, minutes=49)), event(7, t + timedelta(hours=2, minutes=50)), (8, None, 1, "error", 1.0, "{}")]]
    for b in batches:
        write_json(spark, b, path)
        stream = source(spark, path)
        split.start(stream, state).awaitTermination()
    assert rows(split.counts()) == [(0, 2, 2, 0), (1, 3, 1, 2), (2, 3, 1, 2)]
    assert split.rows(KEPT, stream.schema).count() + split.rows(LATE, stream.schema).count() == 8
    # what the stateful step makes of the rows in time, and of all rows of the same batches: the same
    alone = run.drain_levels(kpi.started(rollup.minute_stream(split.kept_stream(stream.schema), "10 minutes")), out, state2, ["datetime", "entity_id"])
    path2, out3, state3 = (tables.fresh_path(spark, p) for p in ("in2", "out3", "state3"))
    for b in batches:
        write_json(spark, b, path2)
        every = run.drain_levels(kpi.started(rollup.minute_stream(source(spark, path2), "10 minutes")), out3, state3, ["datetime", "entity_id"])
    assert rows(alone) == rows(every) and alone.count() == 4


def test_a_repeated_split_changes_nothing(spark, monkeypatch):
    from netkpi.sources import small_files

    path, state = (tables.fresh_path(spark, p) for p in ("in", "state"))
    split, t = split_of(spark, path), dt(2024, 1, 1, 12)
    write_json(spark, [event(1, t), event(2, t + timedelta(hours=1))], path)
    put = small_files.put
    monkeypatch.setattr(small_files, "put", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the mark")))
    with pytest.raises(Exception):
        split.start(source(spark, path), state).awaitTermination()
    monkeypatch.setattr(small_files, "put", put)
    split.start(source(spark, path), state).awaitTermination()
    assert [tuple(r) for r in split.counts().collect()] == [(0, 2, 2, 0)]
    assert split.rows("kept", source(spark, path).schema).count() == 2


def test_rule_history_has_one_row_per_batch_and_rule(spark, rows):
    from netkpi.operators.quality import observe_rules
    from netkpi.streaming.history import RuleHistory

    path, out, state = (tables.fresh_path(spark, p) for p in ("in", "out", "state"))
    told = RuleHistory(spark, tables.fresh_path(spark, "rules"), "rules").watch()
    try:
        for i in range(3):
            write_json(spark, [event(i, dt(2024, 1, 1), user=None if i == 1 else 1)], path)
            stream = observe_rules(source(spark, path), {"no_key": F.col("entity_id").isNotNull()}, "rules")
            query = run.start_files(stream, out, state)
            told.wait(query)
    finally:
        told.close()
    got = told.read().filter("rows_seen > 0")
    assert rows(got, "batch_id", "rule", "rows_seen", "violations") == [(0, "no_key", 1, 0), (1, "no_key", 1, 1), (2, "no_key", 1, 0)]
    last = query.recentProgress[0]
    assert not told.store(last) and got.count() == 3 and told.missing_batches(str(query.id)) == []


def lines(spark, path, *texts):
    spark.createDataFrame([(x,) for x in texts], "value string").coalesce(1).write.mode("append").text(path)


def growing_parts(spark):
    from netkpi.streaming.growing import SchemaLedger

    path, ledger, out, state = (tables.fresh_path(spark, p) for p in ("in", "ledger", "out", "state"))
    return path, SchemaLedger(spark, ledger), out, state


def test_new_fields_make_a_new_version_and_no_value_is_lost(spark):
    from netkpi.streaming import growing

    path, ledger, out, state = growing_parts(spark)
    lines(spark, path, '{"id":1,"v":1,"e":null}', '{"id":2,"o":{"p":1}}', "no json", "", "[1]", '{"id":3,"v":2,"o":{"p":"text"}}')
    growing.start(spark, path, ledger, out, state).awaitTermination()
    lines(spark, path, '{"id":4,"v":1.5,"e":"now","l":[1,2],"o":{"p":2,"q":"z"}}', '{"id":"five","n m":true}')
    growing.start(spark, path, ledger, out, state).awaitTermination()
    got = {(r["id"], str(r["_rescued"])): r for r in growing.read(ledger, out).collect()}
    assert len(got) == 8 - 1 + 1 and ledger.numbers() == [1, 2]
    by_id = {k[0]: r for k, r in got.items() if k[0] is not None}
    assert by_id[1]["v"] == 1.0 and by_id[4]["v"] == 1.5 and by_id[4]["e"] == "now" and by_id[4]["l"] == [1, 2]
    assert by_id[4]["o"].asDict() == {"p": "2", "q": "z"} and by_id[2]["o"].asDict() == {"p": "1", "q": None} and by_id[3]["o"]["p"] == "text"
    rescued = [r["_rescued"] for r in got.values() if r["_rescued"]]
    assert {"_line": "no json"} in rescued and {"_line": "[1]"} in rescued and {"id": "five"} in rescued
    new = {(r.version, r.field) for r in ledger.history().filter("is_new").collect()}
    assert new == {(1, "id"), (1, "v"), (1, "e"), (1, "o"), (2, "l"), (2, "n m")}


def test_rescued_values_fill_a_field_that_is_declared_later(spark, rows):
    from pyspark.sql import types as T

    from netkpi.streaming import growing

    path, ledger, out, state = growing_parts(spark)
    ledger.declare(T.StructType.fromDDL("id long, o struct<p: long>"))
    lines(spark, path, '{"id":1,"o":{"p":1,"q":2},"n":7,"s":"x"}', '{"id":2,"n":"many"}')
    growing.start(spark, path, ledger, out, state, grow=False).awaitTermination()
    first = growing.read(ledger, out)
    assert first.filter("id = 1").first()["_rescued"] == {"o": '{"p":1,"q":2}', "n": "7", "s": "x"}
    ledger.declare(T.StructType.fromDDL("id long, o struct<p: long, q: long>, n long"))
    got = {r["id"]: r for r in growing.read(ledger, out).collect()}
    assert got[1]["o"].asDict() == {"p": 1, "q": 2} and got[1]["n"] == 7 and got[1]["_rescued"] == {"s": "x"}
    assert got[2]["n"] is None and got[2]["_rescued"] == {"n": "many"}


def test_a_repeated_batch_replaces_its_own_folder(spark, monkeypatch):
    from netkpi.streaming import growing

    path, ledger, out, state = growing_parts(spark)
    lines(spark, path, '{"id":1}', '{"id":2,"v":3}')
    grown = growing.SchemaLedger.grow

    def lost_after(self, *args):
        grown(self, *args)
        raise RuntimeError("lost after the version was stored")

    monkeypatch.setattr(growing.SchemaLedger, "grow", lost_after)
    with pytest.raises(Exception):
        growing.start(spark, path, ledger, out, state).awaitTermination()
    monkeypatch.undo()
    growing.start(spark, path, ledger, out, state).awaitTermination()
    assert ledger.numbers() == [1] and growing.read(ledger, out).count() == 2


def test_lines_without_any_object(spark):
    from netkpi.streaming import growing

    path, ledger, out, state = growing_parts(spark)
    lines(spark, path, "7", "x y", "{}")
    growing.start(spark, path, ledger, out, state).awaitTermination()
    got = growing.read(ledger, out).collect()
    assert ledger.numbers() == [] and sorted(str(r["_rescued"]) for r in got) == ["None", "{'_line': '7'}", "{'_line': 'x y'}"]
