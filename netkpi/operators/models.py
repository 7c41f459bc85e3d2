"""Training and scoring on pyspark.ml; SQL-callable scoring; permutation importance."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netkpi.operators.scoring import binary_metrics
from netkpi.sources.tables import materialize, scratch_root


def encode_labels(train: DataFrame, df: DataFrame, column: str, output: str) -> DataFrame:
    """Alphabetical label codes learned on train; NULL and unseen labels get the next code.

    Labels are numbered where they are: in ranges of their order, shifted by the labels of the ranges before.
    """
    levels = train.select(F.col(column).cast("string").alias("_level")).filter("_level is not null").distinct()
    placed = materialize(levels.repartitionByRange("_level").withColumn("_range", F.spark_partition_id()), "label-levels")
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_level")) - 1
    # one row per partition of the labels
    codes = placed.withColumn("_no", inside).join(F.broadcast(starts), "_range").select(
        "_level", (F.col("_no") + F.col("_start")).cast("double").alias(output))
    unseen = placed.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    out = df.join(codes, F.col(column).cast("string") == F.col("_level"), "left")
    return out.withColumn(output, F.coalesce(output, unseen)).drop("_level")


def assemble(df: DataFrame, inputs: Sequence[str], label: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and label, separated from everything else."""
    out = VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="keep").transform(df)
    cols = [*keep, "features"] + ([F.col(label).cast("double").alias("label")] if label else [])
    return out.select(*cols)


# fixed values: depth, rounds and step of the baseline classifier; the sampling rate is this package's own
BASELINE_TREES = {"maxDepth": 2, "maxIter": 546, "subsamplingRate": 0.7, "stepSize": 0.1}


def fit_trees(train: DataFrame, validate: DataFrame, inputs: Sequence[str], label: str,
              settings: Mapping[str, float], seed: int = 0, features_per_split: str = "0.7") -> PipelineModel:
    """Boosted trees; growth stops when the validation rows no longer improve."""
    mark = "is_validation"
    rows = train.withColumn(mark, F.lit(False)).unionByName(validate.withColumn(mark, F.lit(True)))
    trees = GBTClassifier(
        featuresCol="features", labelCol=label, validationIndicatorCol=mark, seed=seed,
        featureSubsetStrategy=features_per_split, **settings)
    if train.sparkSession.sparkContext.getCheckpointDir() is None:  # long boosting cuts its lineage in the shared folder
        train.sparkSession.sparkContext.setCheckpointDir(scratch_root(train.sparkSession))
    stages = [VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="keep"), trees]
    return Pipeline(stages=stages).fit(rows)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Probability of the positive class and the 0/1 prediction: 1 from the threshold on, as in the metrics.

    Taken from the score, because the model itself gives 0 to a row right on the threshold.
    """
    positive = vector_to_array("probability")[1]
    return model.transform(df).select(*keep, positive.alias("score"), (positive >= threshold).cast("int").alias("prediction"))


def search_trees(train: DataFrame, validate: DataFrame, inputs: Sequence[str], label: str,
                 grid: Sequence[Mapping[str, float]], seed: int = 0,
                 parallelism: int = 4) -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """Fit every setting, keep the one with the highest validation F1; the first of equals wins.

    Each fit and each evaluation is a Spark job, `parallelism` of them at a time, so that the short
    stages of one fit fill the gaps of another; one number per setting comes back.
    """
    spark = train.sparkSession
    train, validate = train.persist(), validate.persist()

    def run(settings: Mapping[str, float]) -> tuple[PipelineModel, float]:
        model = fit_trees(train, validate, inputs, label, settings, seed)
        scored = score(model, validate, [F.col(label).alias("label")]).withColumn("split", F.lit("validate"))
        f1 = binary_metrics(scored, ["split"], few_groups=True).first()["f1"]
        return model, 0.0 if f1 is None else float(f1)

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            done = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), s) for s in grid]]
    finally:
        train.unpersist()
        validate.unpersist()
    best = max(range(len(done)), key=lambda i: (done[i][1], -i))
    return done[best][0], [(dict(s), f1) for s, (_, f1) in zip(grid, done)]


def tree_importance(spark: SparkSession, model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(n, float(w)) for n, w in zip(inputs, weights)], "feature string, importance double")


#: Rows that one sorted bucket of a permutation should hold.
BUCKET_ROWS = 200_000


def permuted(df: DataFrame, columns: str | Sequence[str], key: str, seed: int, buckets: int | None = None) -> DataFrame:
    """Give each row the values of the next row in a hash order of the keys: a repeatable shuffle.

    Rows are spread over hash buckets of about BUCKET_ROWS rows, counted first, so a task sees as many rows at any size.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    out = _with_next(df, columns, key, seed, buckets)
    return out.select(*[c for c in df.columns if c not in columns], *[F.col("_next")[c].alias(c) for c in columns])


def _with_next(df: DataFrame, columns: Sequence[str], key: str, seed: int, buckets: int | None = None) -> DataFrame:
    """Adds `_next`, the struct of the columns' values in the next row."""
    buckets = buckets or max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // BUCKET_ROWS)
    order, held = F.xxhash64(F.col(key), F.lit(seed)), F.struct(*columns)
    ring = Window.partitionBy("_bucket").orderBy(order, key)
    # the last row of a bucket has no next one and takes the first, which every row so far has in sight
    first = F.first(held).over(ring.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        df.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(buckets)))
        .withColumn("_next", F.coalesce(F.lead(held).over(ring), first)).drop("_bucket")
    )


def permutation_importance(model: PipelineModel, df: DataFrame, inputs: Sequence[str], label: str, key: str,
                           seed: int = 0) -> DataFrame:
    """Loss of ROC AUC when one input is permuted: one sort for all inputs, then a copy of each row per input, scored in one job."""
    mixed = _with_next(df.select(key, label, *inputs), inputs, key, seed)

    def variant(name: str) -> Column:
        return F.struct(F.lit(name).alias("feature"), *[(F.col("_next")[c] if c == name else F.col(c)).alias(c) for c in inputs])

    rows = mixed.select(F.col(label).alias("label"), F.inline(F.array(*[variant(n) for n in ("", *inputs)])))
    auc = binary_metrics(score(model, rows, ["feature", "label"]), ["feature"], few_groups=True).select("feature", "roc_auc")
    whole = auc.filter(F.col("feature") == "").select("roc_auc").scalar()
    return auc.filter(F.col("feature") != "").select("feature", (whole - F.col("roc_auc")).alias("importance"))


def fit_elastic_net(train: DataFrame, inputs: Sequence[str], label: str, alpha: float = 0.05,
                    l1_ratio: float = 0.05):
    """Elastic-net regression on the inputs as they are (no standardisation)."""
    net = LinearRegression(regParam=alpha, elasticNetParam=l1_ratio, standardization=False)
    return net.fit(assemble(train, inputs, label))


def linear_score(inputs: Sequence[str], coefficients: Sequence[float], intercept: float) -> Column:
    """A fitted linear model as a plain expression: stays in generated code."""
    out = F.lit(float(intercept))
    for name, w in zip(inputs, coefficients):
        out = out + F.col(name).cast("double") * F.lit(float(w))
    return out


def register_linear_scorer(spark: SparkSession, name: str, coefficients: Sequence[float], intercept: float) -> str:
    """Make the model callable in SQL as name(array(inputs)); an expression, NULL for a NULL array or input."""
    weights = ", ".join(f"{float(w)!r}D" for w in coefficients)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(inputs ARRAY<DOUBLE>) RETURNS DOUBLE RETURN
        aggregate(zip_with(inputs, array({weights}), (x, w) -> x * w), {float(intercept)!r}D, (total, part) -> total + part)""")
    return name
