"""Shapley values against the definition: all subsets of inputs, on a small model."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from netkpi.operators import explain, models


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, float(i % 7), float(i * 37 % 11), float(i % 3), int((i % 7 > 3) ^ (i * 37 % 11 > 5))) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y int")
    model = models.fit_trees(df.filter("id % 5 <> 0"), df.filter("id % 5 = 0"), ["a", "b", "c"], "y",
                             {"maxDepth": 3, "maxIter": 6, "subsamplingRate": 1.0, "stepSize": 0.3}, features_per_split="all")
    return df, model


def known(held, x, subset):
    """Expected margin when only the inputs of the subset are known."""
    total = 0.0
    for leaf in held:
        part = leaf.value
        for i, (share, conditions) in leaf.kept.items():
            part *= float(explain._keeps(np.array([x[i]]), conditions)[0]) if i in subset else share
        total += part
    return total


def test_equal_to_all_subsets_and_to_the_margin(spark, fitted):
    df, model = fitted
    held = explain.leaves(explain.tree_nodes(spark, model))
    assert max(len(leaf.kept) for leaf in held) >= 2
    got = explain.shapley_values(spark, model, df.filter("id < 40"), ["a", "b", "c"], ["id", "a", "b", "c"]).collect()
    for r in got:
        x = (r["a"], r["b"], r["c"])
        assert known(held, x, {0, 1, 2}) == pytest.approx(r["margin"], abs=1e-9) and r["base"] == pytest.approx(known(held, x, set()))
        for i in range(3):
            rest, want = [j for j in range(3) if j != i], 0.0
            for k in range(3):
                for s in itertools.combinations(rest, k):
                    weight = math.factorial(k) * math.factorial(2 - k) / math.factorial(3)
                    want += weight * (known(held, x, {*s, i}) - known(held, x, set(s)))
            assert r["shapley"][i] == pytest.approx(want, abs=1e-9)


def test_long_form_and_importance(spark, fitted):
    df, model = fitted
    values = explain.shapley_values(spark, model, df, ["a", "b", "c"], ["id"])
    long = explain.long_form(values, ["a", "b", "c"])
    assert long.count() == 1200 and long.columns == ["id", "base", "margin", "input", "shapley"]
    means = {r["input"]: r["m"] for r in long.groupBy("input").agg(F.avg(F.abs("shapley")).alias("m")).collect()}
    got = {r["input"]: r["mean_abs_shapley"] for r in explain.shapley_importance(values, ["a", "b", "c"]).collect()}
    assert got == pytest.approx(means) and got["a"] > got["c"]


def test_missing_numbers_and_too_large_models(spark, fitted, monkeypatch):
    df, model = fitted
    odd = df.limit(1).select(F.lit(1).alias("id"), F.lit(float("nan")).alias("a"), F.lit(None).cast("double").alias("b"), F.lit(1e300).alias("c"))
    r = explain.shapley_values(spark, model, odd, ["a", "b", "c"], ["id"]).first()
    assert r["base"] + sum(r["shapley"]) == pytest.approx(r["margin"], abs=1e-9)
    monkeypatch.setattr(explain, "MOST_CONDITIONS", 3)
    with pytest.raises(ValueError):
        explain.leaves(explain.tree_nodes(spark, model))


def test_values_with_listed_categories():
    left = explain.Leaf(2.0, {0: (0.25, [(frozenset({1.0, 3.0}), True)])})
    right = explain.Leaf(-1.0, {0: (0.75, [(frozenset({1.0, 3.0}), False)])})
    assert explain.base_value([left, right]) == pytest.approx(-0.25)
    assert explain.explained([left, right], np.array([[3.0], [2.0]])).ravel() == pytest.approx([2.25, -0.75])
