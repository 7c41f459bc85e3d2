"""Evaluation of scored rows and the validation gate."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from netkpi.operators.ordering import running_totals


def slice_accuracy(scored: DataFrame, slices: Sequence[str]) -> DataFrame:
    right = F.count_if(F.col("prediction") == F.col("label"))
    return scored.groupBy(*slices).agg(
        right.alias("n_right"), F.count(F.lit(1)).alias("n_seen"),
        (right / F.count(F.lit(1))).alias("accuracy"))


def confusion(scored: DataFrame, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """All cells of the confusion table, empty ones included, from one pass."""
    cells = [(a, p) for a in classes for p in classes]
    one = scored.agg(*[
        F.count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"c{i}") for i, (a, p) in enumerate(cells)])
    rows = [F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"c{i}").alias("n"))
            for i, (a, p) in enumerate(cells)]
    return one.select(F.inline(F.array(*rows)))


def score_counts(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score: all that rank metrics need, far smaller than the rows.

    Rows without a score are left out; missing_scores tells how many.
    """
    return scored.filter(F.col("score").isNotNull()).groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))


def missing_scores(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and rows without a score, per group."""
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score").isNull()).alias("n_missing"))


def _cumulated(scored: DataFrame, by: Sequence[str], few_groups: bool) -> DataFrame:
    """Per distinct score: positives and negatives at or above it."""
    r = running_totals(score_counts(scored, by), by, "score", ["pos", "neg"], bounded_groups=few_groups)
    return r.withColumn("tp", F.col("pos_total") - F.col("pos_before")).withColumn(
        "fp", F.col("neg_total") - F.col("neg_before"))


def _share(a, b):
    return F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0)).cast("double")


def roc_points(scored: DataFrame, by: Sequence[str], few_groups: bool = False) -> DataFrame:
    """`few_groups`: the groups are few by construction, such as splits."""
    return _cumulated(scored, by, few_groups).select(
        *by, "score", _share("tp", "pos_total").alias("tpr"), _share("fp", "neg_total").alias("fpr"))


def pr_points(scored: DataFrame, by: Sequence[str], few_groups: bool = False) -> DataFrame:
    return _cumulated(scored, by, few_groups).select(
        *by, "score", _share("tp", "pos_total").alias("recall"),
        (F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))).alias("precision"))


METRICS = ("accuracy", "precision", "recall", "f1", "log_loss", "roc_auc", "pr_auc")


def binary_metrics(scored: DataFrame, by: Sequence[str], threshold: float = 0.5,
                   few_groups: bool = False) -> DataFrame:
    """Threshold metrics, log loss, ROC AUC (ties count one half) and average precision per group."""
    c = _cumulated(scored, by, few_groups)
    hit = F.col("score") >= threshold
    # same clipping as the usual definition: a score of 0 or 1 stays finite
    p = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-15)), F.lit(1e-15))
    pairs = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    steps = F.col("pos") * F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    sums = c.groupBy(*by).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp_n"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp_n"),
        F.sum("pos").alias("p_n"), F.sum("neg").alias("n_n"),
        F.sum(-F.col("pos") * F.ln(p) - F.col("neg") * F.ln(1 - p)).alias("loss"),
        F.sum(pairs).alias("pairs"), F.sum(steps).alias("steps"))
    tp, fp, pos, neg = (F.col(x).cast("double") for x in ("tp_n", "fp_n", "p_n", "n_n"))

    def safe(x):
        return F.nullif(x, F.lit(0.0))

    metrics = {
        "accuracy": (tp + neg - fp) / (pos + neg), "precision": tp / safe(tp + fp), "recall": tp / safe(pos),
        "f1": 2 * tp / safe(tp + fp + pos), "log_loss": F.col("loss") / (pos + neg),
        "roc_auc": F.col("pairs") / safe(pos * neg), "pr_auc": F.col("steps") / safe(pos),
    }
    return sums.select(*by, (F.col("p_n") + F.col("n_n")).alias("n_rows"),
                       *[m.alias(n) for n, m in metrics.items()])


def schema_problems(df: DataFrame, contract: T.StructType) -> list[str]:
    """Missing columns and other types than the model was trained on; column case is ignored."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = []
    for f in contract.fields:
        got = have.get(f.name.lower())
        if got is None:
            out.append(f"{f.name}: missing")
        elif got != f.dataType:
            out.append(f"{f.name}: {got.simpleString()} instead of {f.dataType.simpleString()}")
    return out


def validation_gate(scored: DataFrame, contract: T.StructType, slices: Sequence[str],
                    threshold: float = 0.55) -> DataFrame:
    """One row: schema check, accuracy above the threshold in *every* slice, and the verdict."""
    by_name = {c.lower(): c for c in scored.columns}
    unknown = [s for s in slices if s.lower() not in by_name]
    if unknown:
        raise ValueError(f"unknown slice columns: {unknown}")
    problems = schema_problems(scored, contract)
    per_slice = slice_accuracy(scored, [by_name[s.lower()] for s in slices])
    verdict = per_slice.agg(
        F.count(F.lit(1)).alias("n_slices"), F.min("accuracy").alias("worst_accuracy"),
        F.coalesce(F.bool_and(F.col("accuracy") > threshold), F.lit(False)).alias("slices_ok"))
    ok = F.lit(not problems)
    return verdict.select(
        ok.cast("int").alias("schema_ok"), F.lit("; ".join(problems)).alias("problems"), "n_slices", "worst_accuracy",
        F.col("slices_ok").cast("int").alias("slices_ok"),
        F.when(ok & F.col("slices_ok"), "pass").otherwise("fail").alias("verdict"))
