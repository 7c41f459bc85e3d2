"""Shapley values of single predictions of boosted trees (path-dependent tree explanation, Lundberg et al. 2018).

A leaf gives its value to a row that keeps all conditions on the way to it. With some inputs unknown, a condition on an
unknown input is kept with the share of training rows that kept it. The Shapley value of an input is then a sum over
leaves, for each a weighted sum over the subsets of the few inputs on its path; the subsets' products are the coefficients
of a polynomial, so no subset is listed. Values of a row add up to its margin less the base value, exactly.

The leaves are the model, a few thousand numbers; their size is checked before they go to all tasks. Rows are explained where
they are, an Arrow batch at a time.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from netkpi.sources.tables import fresh_path

#: Conditions that may be sent to all tasks (about 40 bytes each).
MOST_CONDITIONS = 1_000_000


@dataclass(frozen=True)
class Leaf:
    """value: of the tree, times its weight. kept: input -> (share of training rows that keep its conditions, the conditions)."""
    value: float
    kept: dict[int, tuple[float, list[tuple[float | frozenset, bool]]]]

    @property
    def reach(self) -> float:
        return math.prod(share for share, _ in self.kept.values())


def tree_nodes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Nodes of a fitted tree model, as it stores them: tree, weight, id, left, right, prediction, rows, input, threshold or left values."""
    path = fresh_path(spark, "tree-model")
    trees = model.stages[-1]
    trees.write().save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(trees.treeWeights)], "treeID int, weight double")
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").join(F.broadcast(weights), "treeID").select(
        F.col("treeID").alias("tree"), "weight", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["prediction"].alias("prediction"), node["rawCount"].alias("rows"), node["split"]["featureIndex"].alias("input"),
        node["split"]["leftCategoriesOrThreshold"].alias("cut"), node["split"]["numCategories"].alias("categories"))


def leaves(nodes: DataFrame) -> list[Leaf]:
    """All leaves of all trees with the conditions on the way to them."""
    if (n := nodes.count()) > MOST_CONDITIONS:
        raise ValueError(f"the model has {n} nodes, more than the {MOST_CONDITIONS} that go to all tasks")
    trees: dict[int, dict[int, T.Row]] = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["id"]] = r
    out = []
    for held in trees.values():
        todo = [(held[0], {})]
        while todo:
            node, kept = todo.pop()
            if node["left"] < 0:
                out.append(Leaf(node["prediction"] * node["weight"], kept))
                continue
            cut = node["cut"][0] if node["categories"] < 0 else frozenset(node["cut"])
            for child, goes_left in ((node["left"], True), (node["right"], False)):
                share, conditions = kept.get(node["input"], (1.0, []))
                part = held[child]["rows"] / node["rows"] if node["rows"] else 0.5
                todo.append((held[child], {**kept, node["input"]: (share * part, [*conditions, (cut, goes_left)])}))
    return out


def base_value(model: Sequence[Leaf]) -> float:
    """The expected margin: every leaf by the share of rows that reach it."""
    return sum(leaf.value * leaf.reach for leaf in model)


def _keeps(x: np.ndarray, conditions: list[tuple[float | frozenset, bool]]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for cut, goes_left in conditions:
        left = np.isin(x, list(cut)) if isinstance(cut, frozenset) else x <= cut  # not a number goes right, as in the model
        out &= left if goes_left else ~left
    return out


def explained(model: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley values of the rows of x, one column per input."""
    phi = np.zeros(x.shape)
    for leaf in model:
        inputs, m = list(leaf.kept), len(leaf.kept)
        one = [_keeps(x[:, i], leaf.kept[i][1]).astype(float) for i in inputs]
        zero = [leaf.kept[i][0] for i in inputs]
        weights = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
        for a, i in enumerate(inputs):
            # coefficient of t^k: the subsets of k other inputs, each of them known, the rest by its share
            sums = np.zeros((m, len(x)))
            sums[0] = 1.0
            for b in range(m):
                if b != a:
                    sums[1:] = sums[1:] * zero[b] + sums[:-1] * one[b]
                    sums[0] = sums[0] * zero[b]
            phi[:, i] += leaf.value * (one[a] - zero[a]) * (np.asarray(weights) @ sums)
    return phi


def shapley_values(spark: SparkSession, model: PipelineModel, df: DataFrame, inputs: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """`keep`, base, margin (of the model itself, before the link) and `shapley`, an array in the order of inputs."""
    held = leaves(tree_nodes(spark, model))
    base, n = base_value(held), len(inputs)
    rows = model.transform(df.select(*dict.fromkeys([*keep, *inputs]))).select(
        *keep, F.lit(base).alias("base"), vector_to_array("rawPrediction")[1].alias("margin"), vector_to_array("features").alias("_x"))
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "_x"), T.StructField("shapley", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            phi = explained(held, x)
            lists = pa.ListArray.from_arrays(np.arange(0, phi.size + 1, n, dtype=np.int32), pa.array(phi.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in schema.fields[:-1]), lists], schema.fieldNames())

    return rows.mapInArrow(run, schema)


def long_form(values: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """One row per row and input: what is kept, input, shapley."""
    kept = [c for c in values.columns if c != "shapley"]
    return values.select(*kept, F.posexplode("shapley").alias("_i", "shapley")).withColumn(
        "input", F.element_at(F.array(*[F.lit(i) for i in inputs]), F.col("_i") + 1)).select(*kept, "input", "shapley")


def shapley_importance(values: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Mean absolute value per input: one aggregate, no row is copied per input."""
    means = values.agg(*[F.avg(F.abs(F.col("shapley")[i])).alias(f"_{i}") for i in range(len(inputs))])
    return means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("input"), F.col(f"_{i}").alias("mean_abs_shapley")) for i, c in enumerate(inputs)])))
