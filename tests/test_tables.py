"""Readers, sinks, row delete, keyed tables, catalog helpers."""
import pytest
from pyspark.sql import functions as F

from netkpi import schemas
from netkpi.operators import ledger
from netkpi.sources import files, tables


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert tables.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert tables.fresh_path(spark, "x") != tables.fresh_path(spark, "x")


def test_materialize_keeps_schema_and_rows(spark):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    out = tables.materialize(df, "m", ["part"])
    assert out.dtypes == df.dtypes and out.count() == 10
    assert out.filter("part = 1").select("id").exceptAll(df.filter("part = 1").select("id")).isEmpty()


def test_replace_append_and_schema_change(spark, rows):
    name = tables.fresh_name("t")
    tables.replace_table(spark.createDataFrame([(1,)], "a int"), name)
    tables.append_table(spark.createDataFrame([(2,)], "a int"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]
    tables.replace_table(spark.createDataFrame([("x", 2.0)], "b string, c double"), name)
    assert spark.table(name).columns == ["b", "c"] and spark.table(name).count() == 1


def test_delete_keeps_rows_with_an_unknown_predicate(spark, rows):
    name, old, new = tables.fresh_name("t"), tables.fresh_path(spark, "v1"), tables.fresh_path(spark, "v2")
    tables.replace_table(spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "id int, v double"), name, old)
    before = spark.table(name).inputFiles()
    assert all(f"{old}/" in f for f in before)
    assert rows(tables.delete_rows(spark, name, F.col("v") > 10, new)) == [(1, 5.0), (2, None)]
    assert rows(spark.table(name)) == [(1, 5.0), (2, None)]
    assert spark.read.parquet(*before).count() == 3  # the old version was not touched


def test_new_columns_read_as_null_before(spark, rows):
    path = tables.fresh_path(spark, "grow")
    tables.append_files(spark.createDataFrame([(1,)], "a int"), path)
    tables.append_files(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert rows(tables.read_merged(spark, path), "a", "b") == [(1, None), (2, "x")]


@pytest.mark.parametrize("data", [[(1, 1), (1, 2)], [(None, 1)]])
def test_feature_table_refuses_bad_keys(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    with pytest.raises(ValueError):
        tables.write_feature_table(df, tables.fresh_name("f"), ["k"], tables.fresh_path(spark, "f"))


def test_bad_keys_leave_the_old_feature_table(spark):
    name = tables.fresh_name("f")
    tables.write_feature_table(spark.createDataFrame([(1, 1)], "k int, v int"), name, ["k"])
    with pytest.raises(ValueError):
        tables.write_feature_table(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), name, ["k"])
    assert spark.table(name).count() == 1
    tables.write_feature_table(spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), name, ["k"])
    assert spark.table(name).count() == 2


def test_keys_and_time_key_are_kept_with_the_table(spark):
    name, df = tables.fresh_name("f"), spark.createDataFrame([(1, 1, 5)], "k int, t int, v int")
    tables.write_feature_table(df, name, ["k", "t"], time_key="t")
    assert tables.table_keys(spark, name) == (["k", "t"], "t")
    tables.write_feature_table(df.withColumn("w", F.lit(1)), name, ["k"])  # other columns, other keys
    assert tables.table_keys(spark, name) == (["k"], None)
    with pytest.raises(ValueError):
        tables.write_feature_table(df, name, ["k"], time_key="t")


def test_rows_as_of_take_the_newest_closed_row(spark, rows):
    from datetime import datetime as dt

    feats = spark.createDataFrame([(1, dt(2024, 1, 1, h), h) for h in (1, 2, 5)] + [(2, dt(2024, 1, 1, 9), 9)], "e int, t timestamp_ntz, v int")
    asked = spark.createDataFrame([(1, dt(2024, 1, 1, 2)), (1, dt(2024, 1, 1, 4, 30)), (1, dt(2024, 1, 1, 1, 59)), (2, dt(2024, 1, 1)), (3, dt(2024, 1, 2))],
                                  "e int, at timestamp_ntz")
    got = tables.rows_as_of(feats, (["e", "t"], "t"), asked, "at", "1 hour")
    assert rows(got, "e", "at", "v") == rows(spark.createDataFrame(
        [(1, dt(2024, 1, 1, 2), 1), (1, dt(2024, 1, 1, 4, 30), 2), (1, dt(2024, 1, 1, 1, 59), None), (2, dt(2024, 1, 1), None), (3, dt(2024, 1, 2), None)],
        "e int, at timestamp_ntz, v int"))


def test_a_table_is_replaced_by_what_is_read_from_it_and_survives_a_lost_job(spark, rows):
    name, path = tables.fresh_name("t"), tables.fresh_path(spark, "t")
    tables.replace_table(spark.createDataFrame([(1,), (2,)], "a int"), name, path)
    tables.replace_table(spark.table(name).filter("a = 2"), name, path)
    with pytest.raises(Exception):
        tables.replace_table(spark.table(name).withColumn("b", F.raise_error(F.lit("lost")).cast("int")), name, path)
    assert rows(spark.table(name)) == [(2,)]


def test_catalog_helpers(spark):
    tables.ensure_schema(spark, "area_one")
    tables.ensure_schema(spark, "area_one")
    tables.replace_table(spark.range(3), "area_one.a")
    tables.replace_table(spark.range(3), "area_one.b")
    assert spark.catalog.tableExists("area_one.a")
    assert sorted(tables.drop_schema_tables(spark, "area_one")) == ["a", "b"]
    assert not spark.catalog.tableExists("area_one.a")


def test_gzip_file_is_one_task_until_spread(spark):
    path = tables.fresh_path(spark, "gz")
    spark.range(50).coalesce(1).select(
        F.struct(F.col("id").alias("entity_id"), F.lit("c").alias("city"), F.lit("k").alias("county"), F.lit("s").alias("state")).alias("properties"),
        F.struct(F.array(F.lit(1.0), F.lit(2.0)).alias("coordinates")).alias("geometry"),
    ).write.option("compression", "gzip").json(path)
    assert files.read_nested_gzip(spark, path, schemas.NESTED_DIMENSION).rdd.getNumPartitions() == 1
    spread = files.read_nested_gzip(spark, path, schemas.NESTED_DIMENSION, partitions=6)
    assert spread.rdd.getNumPartitions() == 6 and spread.count() == 50


def test_literal_rows_have_a_known_size(spark, rows):
    ids = files.literal_rows(spark, [(3,), (7,)], "entity_id long")
    assert rows(ids) == [(3,), (7,)]
    plan = spark.range(100).withColumnRenamed("id", "entity_id").join(ids, "entity_id", "left_semi")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_csv_names_are_cleaned(spark):
    path = tables.fresh_path(spark, "csv")
    spark.createDataFrame([(1, "n", 2, 3.5, "m")], schemas.CUSTOMER_CSV).write.option("header", True).csv(path)
    df = files.read_csv(spark, path, schemas.CUSTOMER_CSV)
    assert df.columns == ["cust_key", "cust_name", "nation_key", "acct_bal_usd", "mkt_segment"] and df.first()["acct_bal_usd"] == 3.5


def test_ledger_round_trip(spark):
    from datetime import datetime as dt

    rows = [(str(i), "fit", "FINISHED", dt(2024, 1, i), "events", {"trigger": "a"}, {"smape": float(10 - i)}) for i in (1, 2, 3)]
    name = tables.fresh_name("runs")
    for r in rows:
        runs = ledger.append_runs(spark.createDataFrame([r], schemas.RUN_ROW), name)
    assert ledger.best_run(runs, F.col("metrics")["smape"]).first()["run_id"] == "3"
    assert ledger.newest_run(runs, "fit").first()["run_id"] == "3"
    assert ledger.newest_run_per_name(runs).first()["run_id"] == "3"
