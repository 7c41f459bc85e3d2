"""Metrics, curves, gate, encodings and models on small frames."""
import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from netkpi.functions import names, scalar
from netkpi.operators import features, ledger, models, profile, scoring

SCORED = "split string, label int, score double"


def brute_auc(rows):
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(0)
    data = [("a", int(rng.random() < 0.3), float(np.round(rng.random(), 1))) for _ in range(400)]
    r = scoring.binary_metrics(spark.createDataFrame(data, SCORED), ["split"]).first()
    assert r["roc_auc"] == pytest.approx(brute_auc([(l, s) for _, l, s in data]))
    assert r["n_rows"] == 400


def test_one_class_has_no_auc_but_finite_loss(spark):
    r = scoring.binary_metrics(spark.createDataFrame([("a", 1, 1.0), ("a", 1, 0.0)], SCORED), ["split"]).first()
    assert r["roc_auc"] is None and r["recall"] == 0.5 and 17 < r["log_loss"] < 18


def test_all_scores_equal(spark):
    r = scoring.binary_metrics(spark.createDataFrame([("a", 1, 0.4), ("a", 0, 0.4), ("a", 0, 0.4)], SCORED), ["split"]).first()
    assert r["roc_auc"] == 0.5 and r["pr_auc"] == pytest.approx(1 / 3) and r["precision"] is None


def test_empty_confusion_cells_are_present(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction int")
    assert rows(scoring.confusion(df)) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)]


CONTRACT = T.StructType([T.StructField("Seg", T.StringType()), T.StructField("x", T.DoubleType())])


@pytest.mark.parametrize("right, verdict", [([1, 1, 1, 1], "pass"), ([1, 1, 1, 0], "fail")])
def test_gate_needs_every_slice(spark, right, verdict):
    data = [("a", 1, r, 0.5) for r in right[:2]] + [("b", 1, r, 0.5) for r in right[2:]]
    df = spark.createDataFrame(data, "seg string, label int, prediction int, x double")
    r = scoring.validation_gate(df, CONTRACT, ["SEG"]).first()
    assert r["verdict"] == verdict and r["n_slices"] == 2


def test_gate_reports_schema_problems(spark):
    df = spark.createDataFrame([("a", 1, 1, 3)], "seg string, label int, prediction int, x int")
    r = scoring.validation_gate(df, CONTRACT, ["seg"]).first()
    assert (r["schema_ok"], r["verdict"]) == (0, "fail") and "x: int instead of double" in r["problems"]
    with pytest.raises(ValueError):
        scoring.validation_gate(df, CONTRACT, ["unknown"])


def test_gate_on_no_rows_fails(spark):
    df = spark.createDataFrame([], "seg string, label int, prediction int, x double")
    assert scoring.validation_gate(df, CONTRACT, ["seg"]).first()["verdict"] == "fail"


def test_one_hot_null_and_unseen_are_zero(spark, rows):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    levels = features.fit_levels(train, ["c"])
    assert levels == {"c": ["a", "b"]}
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id long, c string")
    assert rows(features.one_hot(df, levels)) == [(1, 1, 0), (2, 0, 0), (3, 0, 0)]
    assert features.one_hot(df, levels, drop_first=True).columns == ["id", "c_b"]


def test_long_one_hot_has_no_limit_of_levels(spark, rows):
    df = spark.range(1500).select("id", F.concat(F.lit("v"), "id").alias("c"), F.lit(None).cast("string").alias("d"))
    out = features.one_hot_long(df, ["id"], ["c", "d"])
    assert out.count() == 1500 and rows(out.filter("id = 7")) == [(7, "c_v7")]


def test_permuted_inputs_move_together_and_keep_their_values(spark):
    df = spark.range(200).select("id", (F.col("id") * 2).alias("x"), (F.col("id") * 3).alias("y"))
    mixed = models.permuted(df, ["x", "y"], "id", 5, buckets=3)
    assert mixed.filter("x * 3 <> y * 2").isEmpty() and mixed.select("x").exceptAll(df.select("x")).isEmpty()
    assert mixed.count() == 200 and mixed.filter("x <> id * 2").count() > 190


def test_too_many_levels_are_refused(spark):
    with pytest.raises(ValueError):
        features.fit_levels(spark.range(20).select(F.col("id").cast("string").alias("c")), ["c"], max_levels=5)


def test_constant_column_is_divided_by_one(spark, rows):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0)], "id long, x double")
    assert rows(features.standardise(df, df, ["x"])) == [(1, 0.0), (2, 0.0)]


def test_mean_comes_from_train_only(spark, rows):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 100.0)], "id long, x double")
    assert rows(features.impute_mean(df.filter("id < 3"), df, ["x"])) == [(1, 2.0), (2, 2.0), (3, 100.0)]


def test_missing_model_input_is_an_error(spark):
    with pytest.raises(ValueError):
        features.require_columns(spark.range(1), ["id", "other"])


def test_split_shares_and_stability(spark):
    df = spark.range(20000)
    split = features.with_split(df, F.col("id"), {"train": 60, "validate": 20, "test": 20}, seed=5)
    n = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert abs(n["train"] - 12000) < 400 and abs(n["test"] - 4000) < 300
    again = features.with_split(df.repartition(7), F.col("id"), {"train": 60, "validate": 20, "test": 20}, seed=5)
    assert split.exceptAll(again).isEmpty()


def test_names():
    assert names.feature_name("Payment (auto)") == "payment__auto_"
    assert names.raw_name("seniorCitizen") == "senior_citizen"
    assert names.raw_name("acct_Bal (USD)") == "acct_bal_usd"
    assert names.raw_name("customerID", {"customer_id": "cid"}) == "cid"


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        names.rename_all(df, names.feature_name)


def test_scalar_helpers(spark):
    r = spark.createDataFrame([("Yes", None, "x/20240131_235959/y", "nope")], "l string, n string, p string, q string").select(
        scalar.label_code(F.col("l"), {"Yes": 1, "No": 0}).alias("yes"), scalar.label_code(F.col("q"), {"Yes": 1}).alias("other"),
        scalar.series_key(["l", "n"]).alias("k"), scalar.to_number("q").alias("num"),
        scalar.age_in_days(scalar.stamp_in_path(F.col("p")), "2024-02-02").alias("age"),
        scalar.stamp_in_path(F.col("q")).alias("none")).first()
    assert tuple(r) == (1, None, None, None, 1, None)


def toy(spark, n=600):
    rng = np.random.default_rng(1)
    x, z = rng.random(n), rng.random(n)
    data = [(i, float(a), float(b), int(a > 0.5), "train" if i % 5 < 3 else "validate") for i, (a, b) in enumerate(zip(x, z))]
    return spark.createDataFrame(data, "id long, x double, z double, label int, split string")


def test_trees_learn_and_importance_finds_the_signal(spark):
    df = toy(spark)
    train, validate = df.filter("split = 'train'"), df.filter("split = 'validate'")
    model = models.fit_trees(train, validate, ["x", "z"], "label", {"maxDepth": 2, "maxIter": 5})
    scored = models.score(model, validate, ["split", "label"])
    assert scoring.binary_metrics(scored, ["split"]).first()["accuracy"] > 0.95
    imp = {r["feature"]: r["importance"] for r in models.permutation_importance(model, validate, ["x", "z"], "label", "id").collect()}
    assert imp["x"] > 0.2 > abs(imp["z"])
    own = {r["feature"]: r["importance"] for r in models.tree_importance(spark, model, ["x", "z"]).collect()}
    assert own["x"] > own["z"]


def test_search_maximises_f1(spark):
    df = toy(spark)
    train, validate = df.filter("split = 'train'"), df.filter("split = 'validate'")
    _, results = models.search_trees(train, validate, ["x", "z"], "label", [{"maxDepth": 0, "maxIter": 1}, {"maxDepth": 2, "maxIter": 3}])
    assert results[1][1] > results[0][1]


def test_permutation_keeps_the_values(spark):
    df = toy(spark)
    mixed = models.permuted(df, "x", "id", 3)
    assert sorted(r[0] for r in mixed.select("x").collect()) == sorted(r[0] for r in df.select("x").collect())
    moved = mixed.select("id", F.col("x").alias("m")).join(df, "id").filter("m <> x").count()
    assert moved > 550
    assert mixed.exceptAll(models.permuted(df.repartition(9), "x", "id", 3)).isEmpty()


def test_sql_scorer_equals_expression(spark):
    df = toy(spark)
    net = models.fit_elastic_net(df, ["x", "z"], "label")
    name = models.register_linear_scorer(spark, "score_test", net.coefficients, net.intercept)
    both = df.selectExpr("*", f"{name}(array(x, z)) AS s").withColumn(
        "e", models.linear_score(["x", "z"], net.coefficients, net.intercept))
    assert both.filter(F.abs(F.col("s") - F.col("e")) > 1e-9).isEmpty()
    assert net.coefficients[0] > 0.3 and abs(net.coefficients[1]) < 0.1


def test_features_and_label_are_separated(spark):
    out = models.assemble(toy(spark), ["x", "z"], "label", keep=["id"])
    assert out.columns == ["id", "features", "label"] and out.first()["features"].size == 2


def test_unseen_label_gets_the_next_code(spark, rows):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "c string")
    assert rows(models.encode_labels(train, df, "c", "code")) == [("a", 0.0), ("b", 1.0), ("z", 2.0)]


def test_any_number_of_labels_gets_codes(spark):
    df = spark.range(1500).selectExpr("concat('l', id) AS c").unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    got = {r["c"]: r["code"] for r in models.encode_labels(df.repartition(9), df, "c", "code").collect()}
    names = sorted(c for c in got if c)
    assert [got[c] for c in names] == list(range(1500)) and got[None] == 1500


def test_sql_scorer_takes_null_rows(spark):
    name = models.register_linear_scorer(spark, "score_null", [2.0, 1e-7], 1.0)
    df = spark.sql(f"SELECT {name}(array(1D, 0D)) AS a, {name}(CAST(NULL AS ARRAY<DOUBLE>)) AS b, {name}(array(1D, NULL)) AS c")
    assert tuple(df.first()) == (3.0, None, None)


def test_profile_keeps_large_integers_apart(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (0,)], "x long")
    assert profile.numeric_profile(df, ["x"]).first()["n_distinct"] == 3


def test_best_run_ignores_unfinished_and_puts_null_last(spark):
    runs = spark.createDataFrame([(1, "FINISHED", None), (2, "FAILED", 0.1), (3, "FINISHED", 0.5), (4, "FINISHED", 0.5)],
                                 "run_id long, status string, m double")
    assert ledger.best_run(runs, F.col("m")).first()["run_id"] == 3
    assert ledger.best_run(runs, F.col("m"), lower_is_better=False).first()["run_id"] == 3
    assert ledger.best_run(runs.filter("run_id < 3"), F.col("m")).first()["run_id"] == 1
