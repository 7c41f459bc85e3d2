"""Versioned tables: old versions, lost jobs, two writers, merges, clean-up."""
import pytest
from pyspark.sql import functions as F

from netkpi.sources import small_files, tables
from netkpi.sources.versions import Conflict, VersionedTable


@pytest.fixture()
def table(spark):
    return VersionedTable(spark, tables.fresh_path(spark, "versioned"))


def frame(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_versions_stay_readable(spark, table, rows):
    table.replace(frame(spark, [(1, "a"), (2, "b"), (3, None)]), ["k"])
    table.append(frame(spark, [(4, "d", 0.5)], "k int, v string, w double"))
    table.delete(F.col("v") >= "b")
    table.replace(frame(spark, [("x",)], "other string"))
    assert rows(table.read(1)) == [(1, "a"), (2, "b"), (3, None)]
    assert rows(table.read(2), "k", "w") == [(1, None), (2, None), (3, None), (4, 0.5)]
    assert rows(table.read(3), "k") == [(1,), (3,)] and rows(table.read()) == [("x",)]
    assert rows(table.history(), "version", "operation", "n_rows") == [(1, "replace", 3), (2, "append", 4), (3, "delete", 2), (4, "replace", 1)]
    assert table.version(3).properties["keys"] == ["k"] and "keys" not in table.version().properties


def test_a_job_lost_half_way_changes_nothing(spark, table, rows):
    table.replace(frame(spark, [(1, "a")]))
    broken = spark.range(100).repartition(4).select(
        F.col("id").cast("int").alias("k"), F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).cast("string").alias("v"))
    for write in (table.replace, table.append, lambda df: table.merge(df, ["k"], F.col("k"))):
        with pytest.raises(Exception):
            write(broken)
        assert table.numbers() == [1] and rows(table.read()) == [(1, "a")]
    assert table.vacuum() > 0 and rows(table.read()) == [(1, "a")]  # what the lost jobs had written


@pytest.mark.parametrize("data", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_bad_keys_change_nothing(spark, table, rows, data):
    table.replace(frame(spark, [(1, "a")]), ["k"])
    with pytest.raises(ValueError):
        table.replace(frame(spark, data), ["k"])
    assert rows(table.read()) == [(1, "a")] and len(small_files.names(spark, f"{table.path}/data")) == 1


def test_of_two_writers_one_gets_an_error(spark, table, rows, monkeypatch):
    table.replace(frame(spark, [(1, "a")]))
    base = table.version()
    table.append(frame(spark, [(2, "b")]))
    monkeypatch.setattr(table, "version", lambda number=None: base)  # a writer that started before
    with pytest.raises(Conflict):
        table.append(frame(spark, [(3, "c")]))
    monkeypatch.undo()
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_merge_rewrites_only_the_parts_it_touches(spark, table, rows):
    part = F.col("k") % 3
    table.merge(frame(spark, [(i, "old") for i in range(9)]), ["k"], part)
    before = {f["part"]: f["path"] for f in table.version().folders}
    table.merge(frame(spark, [(4, "new"), (12, "more")]), ["k"], part, batch=7)
    after = {f["part"]: f["path"] for f in table.version().folders}
    assert before[2] == after[2] and before[0] != after[0] and before[1] != after[1] and table.version().properties["batch"] == 7
    assert rows(table.read()) == sorted([(i, "new" if i == 4 else "old") for i in range(9)] + [(12, "more")])
    assert rows(table.read(1)) == [(i, "old") for i in range(9)]
    table.vacuum(1)
    assert table.numbers() == [2] and table.read().count() == 10
    assert table.merge(frame(spark, []), ["k"], part).number == 2 and rows(table.history(), "n_rows") == [(10,)]


def test_delete_keeps_folders_without_such_rows(spark, table, rows):
    table.merge(frame(spark, [(i, "v") for i in range(6)]), ["k"], F.col("k") % 2)
    before = {f["part"]: f["path"] for f in table.version().folders}
    table.delete(F.col("k").isin(1, 3, 5))
    assert [f["path"] for f in table.version().folders] == [before[0]] and rows(table.read(), "k") == [(0,), (2,), (4,)]
    assert table.delete(F.col("k") > 100).number == 3 and table.read().count() == 3


def test_published_name_changes_over_with_the_columns(spark, table, rows):
    name = tables.fresh_name("published")
    table.replace(frame(spark, [(1, "a")]))
    table.append(frame(spark, [(2, "b", 1.5)], "k int, v string, w double"))
    assert rows(table.publish(name)) == [(1, "a", None), (2, "b", 1.5)]
    table.replace(frame(spark, [("x",)], "other string"))
    assert spark.table(name).count() == 2  # until it is published
    assert rows(table.publish(name)) == [("x",)]
    table.replace(frame(spark, [], "other string"))
    assert table.publish(name).count() == 0 and table.read().count() == 0


def test_an_empty_table_has_no_version(spark, table):
    assert table.numbers() == [] and table.version().number == 0 and table.read().count() == 0
    assert table.delete(F.lit(True)).number == 0


def test_small_files_appear_once(spark):
    path = f"{tables.fresh_path(spark, 'small')}/a.json"
    assert small_files.put(spark, path, "één") and not small_files.put(spark, path, "two")
    assert small_files.read(spark, path) == "één" and small_files.names(spark, path.rpartition("/")[0]) == ["a.json"]
    assert small_files.names(spark, path + "-none") == []
