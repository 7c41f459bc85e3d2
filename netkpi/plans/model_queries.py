"""Evaluation on a fixed score formula (exact), and trained models with checks of their properties."""
from pyspark.sql import functions as F, types as T

from netkpi.operators import explain, features, models, ordering, scoring
from netkpi.plans import oracle_parts as o
from netkpi.plans.feature_queries import _SPLIT, split_rows
from netkpi.plans.registry import register, rounded
from netkpi.sources import adapters, tables

_SPLIT_SCORED = f"""{_SPLIT}, scored AS (
  SELECT split, quality AS label, (doc_id * 37 % 101) / 100.0::DOUBLE AS score,
    CASE WHEN (doc_id * 37 % 101) / 100.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS prediction FROM rows)"""


def _scored(spark, sf_dir):
    score = adapters.fixed_score(F.col("doc_id"))
    return split_rows(spark, sf_dir).select("split", F.col("quality").alias("label"), score.alias("score"))


@register("binary_metrics", "G6", o.with_(_SPLIT_SCORED) + """
, pairs AS (SELECT a.split, avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS roc_auc
  FROM scored a JOIN scored b ON a.split = b.split AND a.label = 1 AND b.label = 0 GROUP BY 1),
cut AS (SELECT s.split, t.score, count(*) FILTER (WHERE s.label = 1) AS tp, count(*) AS n
  FROM scored s JOIN (SELECT DISTINCT split, score FROM scored) t ON s.split = t.split AND s.score >= t.score GROUP BY 1, 2),
pr AS (SELECT s.split, avg(tp / n::DOUBLE) AS pr_auc FROM scored s JOIN cut USING (split, score) WHERE label = 1 GROUP BY 1),
c AS (SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
    count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp, count(*) FILTER (WHERE label = 1)::DOUBLE AS p,
    count(*) FILTER (WHERE label = prediction)::DOUBLE AS ok,
    avg(-CASE WHEN label = 1 THEN ln(greatest(least(score, 1 - 1e-15), 1e-15)) ELSE ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)) END) AS ll
  FROM scored GROUP BY 1)
SELECT split, n_rows, round(ok / n_rows, 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision,
  round(tp / nullif(p, 0), 6) AS recall, round(2 * tp / nullif(tp + fp + p, 0), 6) AS f1, round(ll, 6) AS log_loss,
  round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM c JOIN pairs USING (split) JOIN pr USING (split)""")
def binary_metrics(spark, sf_dir):
    return rounded(scoring.binary_metrics(_scored(spark, sf_dir), ["split"], few_groups=True), *scoring.METRICS)


@register("confusion_table", "G7", o.with_(o.SCORED) + """
SELECT l::INTEGER AS label, p::INTEGER AS prediction, count(doc_id) AS n FROM range(2) a(l) CROSS JOIN range(2) b(p)
LEFT JOIN scored ON label = l AND prediction = p GROUP BY 1, 2""")
def confusion_table(spark, sf_dir):
    return scoring.confusion(adapters.scored_rows(spark, sf_dir))


_AT = """, s AS (SELECT DISTINCT split, score FROM scored),
cut AS (SELECT s.split, s.score, count(*) FILTER (WHERE label = 1) AS tp, count(*) FILTER (WHERE label = 0) AS fp
  FROM s JOIN scored r ON r.split = s.split AND r.score >= s.score GROUP BY 1, 2),
tot AS (SELECT split, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM scored GROUP BY 1)
"""


@register("roc_points", "G8", o.with_(_SPLIT_SCORED) + _AT + """
SELECT split, score, round(tp::DOUBLE / nullif(p, 0), 6) AS tpr, round(fp::DOUBLE / nullif(n, 0), 6) AS fpr FROM cut JOIN tot USING (split)""")
def roc_points(spark, sf_dir):
    return rounded(scoring.roc_points(_scored(spark, sf_dir), ["split"], few_groups=True), "tpr", "fpr")


@register("precision_recall_points", "G8", o.with_(_SPLIT_SCORED) + _AT + """
SELECT split, score, round(tp::DOUBLE / nullif(p, 0), 6) AS recall, round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision
FROM cut JOIN tot USING (split)""")
def precision_recall_points(spark, sf_dir):
    return rounded(scoring.pr_points(_scored(spark, sf_dir), ["split"], few_groups=True), "recall", "precision")


_CONTRACT = T.StructType([
    T.StructField("Lang", T.StringType()), T.StructField("toxic", T.IntegerType()), T.StructField("score", T.DoubleType())])


@register("validation_gate", "G12 D14", o.with_(o.SCORED) + """
, slices AS (SELECT lang, toxic, count(*) FILTER (WHERE prediction = label) / count(*)::DOUBLE AS acc FROM scored GROUP BY 1, 2)
SELECT 1 AS schema_ok, '' AS problems, count(*) AS n_slices, round(min(acc), 6) AS worst_accuracy, bool_and(acc > 0.55)::INTEGER AS slices_ok,
  CASE WHEN bool_and(acc > 0.55) THEN 'pass' ELSE 'fail' END AS verdict FROM slices""")
def validation_gate(spark, sf_dir):
    gate = scoring.validation_gate(adapters.scored_rows(spark, sf_dir), _CONTRACT, ["LANG", "toxic"])
    return rounded(gate, "worst_accuracy")


def _inputs(spark, sf_dir):
    """Labelled rows with their split; inputs are both categoricals as 0/1 columns and the numbers."""
    rows = split_rows(spark, sf_dir)
    wide = features.one_hot(rows, features.fit_levels(rows, ["lang", "source"]))
    inputs = [c for c in wide.columns if c.startswith(("lang_", "source_"))] + ["n_chars", "toxic"]
    return wide, inputs


def _parts(wide):
    return [wide.filter(F.col("split") == s) for s in ("train", "validate", "test")]


def _predictions(spark, sf_dir):
    """The prediction table: boosted trees at the stated rounds with early stop, scores of all rows."""
    wide, inputs = _inputs(spark, sf_dir)
    train, validate, _ = _parts(wide)
    model = models.fit_trees(train, validate, inputs, "quality", models.BASELINE_TREES)
    scored = models.score(model, wide, ["doc_id", "split", F.col("quality").alias("label")])
    return tables.replace_table(scored, tables.fresh_name("predictions"), tables.fresh_path(spark, "predictions"))


@register("classifier_scores", "G4 G2 G10 G11 A7")
def classifier_scores(spark, sf_dir):
    return _predictions(spark, sf_dir)


@register("classifier_score_checks", "G4 G2 G10 G11", o.with_(_SPLIT) + """
SELECT split, count(*) AS n_rows, 1 AS scores_in_range, 1 AS predictions_match, CASE WHEN split = 'train' THEN 1 END AS beats_base_rate
FROM rows GROUP BY 1""")
def classifier_score_checks(spark, sf_dir):
    """Properties of the prediction table: every row once, scores in [0, 1], 0/1 from the score, less loss than the base rate."""
    table = _predictions(spark, sf_dir)
    p, y = F.greatest(F.least("score", F.lit(1 - 1e-15)), F.lit(1e-15)), F.col("label")
    share = F.avg("label")
    base = -(share * F.ln(share) + (1 - share) * F.ln(1 - share))
    loss = F.avg(-y * F.ln(p) - (1 - y) * F.ln(1 - p))
    return table.groupBy("split").agg(
        F.count_distinct("doc_id").alias("n_rows"),
        F.bool_and(F.col("score").between(0, 1)).cast("int").alias("scores_in_range"),
        F.bool_and(F.col("prediction") == (F.col("score") >= 0.5).cast("int")).cast("int").alias("predictions_match"),
        F.when(F.col("split") == "train", (loss < base).cast("int")).alias("beats_base_rate"))


@register("churn_flow", "E7 G12 D14 G4 G11", o.with_(o.LABELLED) + """
SELECT lang, least(5, count(*)) AS n_at_risk, 1 AS are_the_highest, 1 AS schema_ok, 1 AS can_predict,
  (SELECT count(*) FROM (SELECT DISTINCT lang, toxic FROM labelled)) AS n_slices, 1 AS verdict_follows FROM labelled GROUP BY 1""")
def churn_flow(spark, sf_dir):
    """Features, trees, prediction table, then the at-risk list and the gate, both read from that table."""
    rows = adapters.labelled_rows(spark, sf_dir).select("doc_id", "lang", "toxic")
    scored = tables.materialize(_predictions(spark, sf_dir).join(rows, "doc_id"), "scored")
    top = ordering.top_rows_per_group(scored, ["lang"], [F.col("score").desc(), F.col("doc_id")], 5)
    listed = top.groupBy("lang").agg(F.count(F.lit(1)).alias("n_at_risk"), F.min("score").alias("_least"))
    rest = scored.join(top.select("doc_id"), "doc_id", "left_anti").groupBy("lang").agg(F.max("score").alias("_next"))
    gate = scoring.validation_gate(scored, _CONTRACT, ["lang", "toxic"])
    usable = scored.agg(F.coalesce(F.bool_and(F.col("score").isNotNull() & F.col("prediction").isNotNull()), F.lit(False)).alias("ok"))
    passed = (F.col("schema_ok") == 1) & (F.col("worst_accuracy") > 0.55)
    verdict = gate.select("schema_ok", "n_slices", ((F.col("verdict") == "pass") == passed).cast("int").alias("verdict_follows"))
    # one row of the gate beside each segment
    return ordering.join_same(listed, rest, ["lang"], how="left").select(
        "lang", "n_at_risk", (F.coalesce("_least", F.lit(0.0)) >= F.coalesce("_next", F.lit(-1.0))).cast("int").alias("are_the_highest"),
        usable.select(F.col("ok").cast("int")).scalar().alias("can_predict"),
        *[verdict.select(c).scalar().alias(c) for c in verdict.columns])


def _search(spark, sf_dir):
    wide, inputs = _inputs(spark, sf_dir)
    train, validate, _ = _parts(wide)
    grid = [{**models.BASELINE_TREES, "maxDepth": d, "stepSize": s} for d in (2, 3) for s in (0.1, 0.3)]
    best, trials = models.search_trees(train, validate, inputs, "quality", grid)
    scored = models.score(best, wide, ["split", F.col("quality").alias("label")])
    return trials, scoring.binary_metrics(scored, ["split"], few_groups=True)


@register("classifier_search", "G5")
def classifier_search(spark, sf_dir):
    """Metrics on train, validation and test of the settings with the best validation F1."""
    return _search(spark, sf_dir)[1]


@register("classifier_search_trials", "G5", """
SELECT trial, max_depth, step_size, 1 AS not_above_best, 1 AS f1_in_range
FROM (VALUES (0, 2, 0.1::DOUBLE), (1, 2, 0.3), (2, 3, 0.1), (3, 3, 0.3)) t(trial, max_depth, step_size)
WHERE EXISTS (SELECT * FROM labels)""")
def classifier_search_trials(spark, sf_dir):
    """Every trial of the search, held against the F1 of the chosen model, which is scored anew."""
    trials, metrics = _search(spark, sf_dir)
    rows = spark.createDataFrame(
        [(i, int(s["maxDepth"]), float(s["stepSize"]), f1) for i, (s, f1) in enumerate(trials)],
        "trial int, max_depth int, step_size double, f1 double")
    top = metrics.filter("split = 'validate'").select(F.coalesce("f1", F.lit(0.0))).scalar()
    return rows.select(
        "trial", "max_depth", "step_size", (F.col("f1") <= top + 1e-9).cast("int").alias("not_above_best"),
        F.col("f1").between(0, 1).cast("int").alias("f1_in_range"))


def _importance(spark, sf_dir):
    wide, inputs = _inputs(spark, sf_dir)
    train, validate, test = _parts(wide)
    model = models.fit_trees(train, validate, inputs, "quality", models.BASELINE_TREES)
    own = models.tree_importance(spark, model, inputs).withColumnRenamed("importance", "split_gain")
    return models.permutation_importance(model, test, inputs, "quality", "doc_id").join(F.broadcast(own), "feature")


@register("feature_importance", "G9")
def feature_importance(spark, sf_dir):
    return _importance(spark, sf_dir)


@register("feature_importance_checks", "G9", o.with_(o.LABELLED) + """
SELECT count(DISTINCT lang) + count(DISTINCT source) + 2 AS n_features, 1 AS gains_add_up, 1 AS unused_do_not_matter FROM labelled""")
def feature_importance_checks(spark, sf_dir):
    """Split gains add up to one, and permuting an input that no tree uses changes nothing."""
    unused = F.col("split_gain") == 0
    return _importance(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_features"), (F.abs(F.sum("split_gain") - 1) < 1e-6).cast("int").alias("gains_add_up"),
        F.bool_and(~unused | (F.abs("importance") < 1e-9)).cast("int").alias("unused_do_not_matter"))


def _linear(spark, sf_dir):
    """Elastic net fitted on train, registered as a SQL function; the vector that is its argument."""
    wide, inputs = _inputs(spark, sf_dir)
    model = models.fit_elastic_net(wide.filter(F.col("split") == "train"), inputs, "quality")
    name = models.register_linear_scorer(spark, tables.fresh_name("score"), model.coefficients, model.intercept)
    vector = f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in inputs)})"
    return wide, inputs, model, f"{name}({vector})"


@register("linear_scores_sql", "G14 G10 I3 I4")
def linear_scores_sql(spark, sf_dir):
    wide, _, _, call = _linear(spark, sf_dir)
    return wide.selectExpr("doc_id", "split", f"{call} AS score")


@register("linear_scores_checks", "G14 G10 I3 I4", o.with_(_SPLIT) + """
SELECT split, count(*) AS n_rows, 1 AS same_by_expression, 1 AS same_by_model, CASE WHEN split = 'train' THEN 1 END AS mean_kept FROM rows GROUP BY 1""")
def linear_scores_checks(spark, sf_dir):
    """The SQL function, the plain expression and the fitted model agree, and the intercept keeps the mean of the training rows."""
    wide, inputs, model, call = _linear(spark, sf_dir)
    plain = models.linear_score(inputs, model.coefficients, model.intercept)
    rows = wide.select("doc_id", "split", F.col("quality").alias("label"), F.expr(call).alias("score"), plain.alias("plain"), *inputs)
    rows = model.transform(models.assemble(rows, inputs, None, ["split", "label", "score", "plain"]))

    def close(x):
        return F.bool_and(F.abs(F.col("score") - F.col(x)) < 1e-9).cast("int")

    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), close("plain").alias("same_by_expression"), close("prediction").alias("same_by_model"),
        F.when(F.col("split") == "train", (F.abs(F.avg("score") - F.avg("label")) < 1e-6).cast("int")).alias("mean_kept"))


def _explained(spark, sf_dir):
    wide, inputs = _inputs(spark, sf_dir)
    train, validate, _ = _parts(wide)
    model = models.fit_trees(train, validate, inputs, "quality", models.BASELINE_TREES)
    return wide, inputs, explain.shapley_values(spark, model, wide, inputs, ["doc_id", "split"])


@register("shapley_values", "G9")
def shapley_values(spark, sf_dir):
    """One row per document and input: what the input adds to the margin of this prediction."""
    _, inputs, values = _explained(spark, sf_dir)
    return explain.long_form(values, inputs)


@register("shapley_importance", "G9")
def shapley_importance(spark, sf_dir):
    _, inputs, values = _explained(spark, sf_dir)
    return explain.shapley_importance(values, inputs)


@register("shapley_checks", "G9", o.with_(_SPLIT) + """
SELECT split, count(*) AS n_rows, (SELECT count(DISTINCT lang) + count(DISTINCT source) + 2 FROM rows) AS n_inputs, 1 AS adds_up, 1 AS one_base FROM rows GROUP BY 1""")
def shapley_checks(spark, sf_dir):
    """Of every row the values add up to the model's own margin less the base value, which is the same for all."""
    _, _, values = _explained(spark, sf_dir)
    total = F.aggregate("shapley", F.lit(0.0), lambda a, x: a + x)
    return values.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.size("shapley")).alias("n_inputs"),
        F.bool_and(F.abs(F.col("base") + total - F.col("margin")) < 1e-9).cast("int").alias("adds_up"),
        (F.min("base") == F.max("base")).cast("int").alias("one_base"))
