"""Distributed ranks and running totals against brute force, skewed groups included."""
import random

import pytest
from pyspark.sql import functions as F

from netkpi.operators import ordering, profile


def skewed(n=3000, seed=1):
    """Half the rows in one group, a third of all rows on one value."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if rng.random() < 0.5 else f"g{rng.randrange(5)}"
        value = 0.0 if rng.random() < 0.33 else round(rng.lognormvariate(0, 3), 3)
        out.append((i, group, value))
    return out


@pytest.mark.parametrize("slots", [2, 16, 64])
@pytest.mark.parametrize("bounded", [True, False])
def test_rank_equals_brute_force(spark, slots, bounded):
    data = skewed()
    df = spark.createDataFrame(data, "id long, grp string, v double")
    counts = df.groupBy("grp", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["grp"], r["v"]): (r["n_before"], r["n_total"])
           for r in ordering.running_totals(counts, ["grp"], "v", ["n"], slots, bounded).collect()}
    for g, v in {(g, v) for _, g, v in data}:
        assert got[(g, v)] == (sum(1 for _, a, b in data if a == g and b < v), sum(1 for _, a, _ in data if a == g))


def test_rank_within_has_gaps_after_ties(spark, rows):
    df = spark.createDataFrame([(1, "a", 3.0), (2, "a", 3.0), (3, "a", 1.0), (4, "b", 0.0)], "id long, g string, v double")
    assert rows(ordering.rank_within(df, ["g"], "v"), "id", "rank") == [(1, 1), (2, 1), (3, 3), (4, 1)]


def test_running_totals_without_group(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(1, 101)], "v double, n long")
    got = {r["v"]: (r["n_before"], r["n_total"]) for r in ordering.running_totals(df, [], "v", ["n"]).collect()}
    assert got[1.0] == (0, 5050) and got[100.0] == (4950, 5050)


def test_top_per_group_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(), "id long, grp string, v double")
    top = ordering.top_rows_per_group(df, ["grp"], [F.col("v").desc(), F.col("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert top.groupBy("grp").count().filter("count <> 3").isEmpty()


def test_sample_is_the_same_on_any_layout(spark, rows):
    df = spark.range(1000)
    one = rows(ordering.repeatable_sample(df.repartition(1), "id", 50, 3))
    assert one == rows(ordering.repeatable_sample(df.repartition(13), "id", 50, 3)) and len(one) == 50
    assert one != rows(ordering.repeatable_sample(df, "id", 50, 4))
    assert ordering.repeatable_sample(df, "id", 5000, 3).count() == 1000


def test_quartiles_with_nulls_ties_and_one_value(spark):
    import numpy as np

    values = [v for _, _, v in skewed(501, 9)]
    df = spark.createDataFrame([(v, 7.0, None) for v in values] + [(None, 7.0, None)], "a double, b double, c double")
    got = {r["column"]: r for r in profile.numeric_profile(df, ["a", "b", "c"]).collect()}
    assert got["a"]["missing"] == 1 and got["a"]["n_distinct"] == len(set(values))
    for name, q in profile.QUARTILES.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, q))
        assert got["b"][name] == 7.0
    assert got["a"]["top"] == 0.0 and got["c"]["n_distinct"] is None and got["c"]["missing"] == 502


def test_quick_profile_is_close(spark):
    df = spark.range(10000).select(F.col("id").cast("double").alias("a"))
    r = profile.quick_profile(df, ["a"]).first()
    assert abs(r["n_distinct"] - 10000) < 800 and abs(r["quartiles"][1] - 5000) < 10


def test_histogram_keeps_the_maximum_and_constant_columns(spark, rows):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(11)], "a double, b double")
    got = rows(profile.histogram(df, ["a", "b"], 10))
    assert sum(n for c, _, n in got if c == "a") == 11 and ("a", 9, 2) in got and ("b", 0, 11) in got


def test_rank_keeps_null_values_and_null_groups(spark, rows):
    from netkpi.operators.ordering import rank_within

    df = spark.createDataFrame([("a", 5.0), ("a", None), (None, 7.0), (None, 9.0), ("a", 5.0), ("a", 2.0)], "area string, rate double")
    got = rows(rank_within(df, ["area"], "rate"), "area", "rate", "rank")
    assert got == [(None, 7.0, 2), (None, 9.0, 1), ("a", None, 4), ("a", 2.0, 3), ("a", 5.0, 1), ("a", 5.0, 1)]


def test_top_rows_beyond_the_threshold(spark):
    from pyspark.sql import functions as F

    from netkpi.operators.ordering import top_rows_per_group

    df = spark.range(4000).select((F.col("id") % 2).alias("g"), "id")
    got = top_rows_per_group(df, ["g"], [F.desc("id")], 1500)
    assert got.groupBy("g").agg(F.count("id"), F.min("id"), F.max("position")).orderBy("g").collect() == [(0, 1500, 1000, 1500), (1, 1500, 1001, 1500)]
