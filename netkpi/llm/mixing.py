"""Mixing sources to target weights by Pareto order sampling (built-in functions only).

A source of N words with target T gets every document floor(T / N) times for certain. For the rest each document is to
come once more with probability p = T / N - floor(T / N): documents are ranked by q = [u / (1 - u)] / [p / (1 - p)],
random odds divided by inclusion odds, and the first ones are taken until the wanted number of words is reached, so the
sample has a fixed size. u comes from the md5 of seed and doc_id, so reruns agree on any number of executors.

Defined results: a null text has 0 words; a null source is a source of its own, the last one; rows that share source and
doc_id (null ids, too) are taken together; a source without words has target 0 and is taken 0 times; an empty table
gives an empty table. `mixed` and `copied` keep all columns but those named like their own (mix_..., bits).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from netkpi.llm.shared import cut_at, slot_of, spread
from netkpi.sources.tables import materialize

WORD = r"[^\x20\x09-\x0D]+"
UNIT = float(1 << 52)


def word_counts(docs: DataFrame, seed: int = 42) -> DataFrame:
    """doc_id, source, size in words and 52 random bits per document, written once so that texts are read once."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return materialize(docs.select("doc_id", "source", size.alias("size"), _bits(seed).alias("bits")), "mix-sizes")


def _bits(seed: int):
    return spread(F.lit(seed), F.col("doc_id"))


def targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: its size and target in words.

    Sources by code point, null last, weigh as listed, repeating. A target stops at `most` times the source; what is
    above is shared out again by weight until none is above. Sources in the order of cap / weight: the first at which
    the common rate (what is left after the caps before it, by the weight from there on) is not above its own cap sets
    the rate. One row per source passes through one task, as sources are what the user lists.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    to_here, before = by_cap.rowsBetween(Window.unboundedPreceding, 0), by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
           .withColumn("weight", F.get(listed, F.col("rank") % len(weights)))
           .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    per = (per.withColumn("wanted", F.sum("source_size").over(whole) * F.lit(float(share)))
           .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("open", F.sum("weight").over(whole) - F.sum("weight").over(to_here) + F.col("weight"))
           .withColumn("rate", (F.col("wanted") - F.col("capped")) / F.col("open"))
           .withColumn("first", F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.col("rate"))))
    rate = F.coalesce(F.first("first", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(float("inf")))
    return per.withColumn("target", F.least("cap", rate * F.col("weight"))).select("source", "rank", "source_size", "target")


def inclusion(plan: DataFrame) -> DataFrame:
    """Certain whole copies and the probability of one more, per source."""
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (plan.withColumn("certain", F.floor(times)).withColumn("p", times - F.col("certain"))
            .withColumn("goal", F.greatest(F.lit(0.0), F.col("target") - F.col("certain") * F.col("source_size"))))


def pareto_rank(bits, p):
    """Random odds over inclusion odds as 52 bits of q / (1 + q); null where nothing is left to chance."""
    u = (bits + F.lit(0.5)) / F.lit(UNIT)
    q = F.when(p > 0, (u / (F.lit(1.0) - u)) / (p / (F.lit(1.0) - p)))
    return F.floor(q / (F.lit(1.0) + q) * F.lit(UNIT)).cast("long")


def mix_plan(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source: source_size, target, certain copies, p, and last_rank, the last Pareto rank that is taken once more."""
    plan = materialize(inclusion(targets(sized, weights, share, most)), "mix-plan")
    open_ = plan.filter("goal > 0").select("source", "rank", "goal", "p")
    rows = sized.join(open_, sized["source"].eqNullSafe(open_["source"])).drop(open_["source"]).withColumn("v", pareto_rank(F.col("bits"), F.col("p")))
    cuts = cut_at(rows.select("rank", "v", "size"), open_.select("rank", "goal"), "rank", ["v"], "size", [])
    near = (rows.drop("goal").withColumns({"_s0": slot_of("v", 0), "_s1": slot_of("v", 1)})
            .join(cuts, ["rank", "_s0", "_s1"]).groupBy("rank", "goal", "_s0", "_s1", "v").agg(F.sum("size").alias("size")))
    order = Window.partitionBy("rank").orderBy("v")
    run = F.sum("size").over(order)
    # the document on which the goal falls is taken if that comes nearer to the goal than leaving it
    taken = run + run - F.col("size") <= F.col("goal") + F.col("goal")
    before = F.shiftleft(F.col("_s1"), 32) - 1
    last = (near.withColumn("ok", taken).groupBy("rank")
            .agg(F.max(F.when(F.col("ok"), F.col("v"))).alias("in"), F.max(before).alias("before"))
            .select("rank", F.coalesce("in", "before").alias("last_rank")))
    none = F.when(F.col("goal") > 0, F.lit((1 << 52) - 1)).otherwise(F.lit(-1)).cast("long")
    return materialize(plan.join(last, "rank", "left").withColumn("last_rank", F.coalesce("last_rank", none)), "mix-cuts")


def mixed(docs: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """The columns of docs with mix_source_size, mix_target and mix_copies, how often the mix takes the row.

    docs needs doc_id and source only; the plan has one row per source, so documents are not moved.
    """
    kept = [c for c in docs.columns if c not in ("mix_source_size", "mix_target", "mix_copies", "bits")]
    chosen = plan.select("source", "source_size", "target", "certain", "p", "last_rank").toDF(
        "_source", "mix_source_size", "mix_target", "_certain", "_p", "_last_rank")
    more = F.coalesce(pareto_rank(_bits(seed), F.col("_p")) <= F.col("_last_rank"), F.lit(False)).cast("long")
    rows = docs.select(kept)
    out = rows.join(chosen, rows["source"].eqNullSafe(chosen["_source"])).withColumn("mix_copies", F.col("_certain") + more)
    return out.select(*kept, "mix_source_size", "mix_target", "mix_copies")


def copied(docs: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: the columns of docs, every row as often as the plan takes it."""
    own = [c if c in ("doc_id", "source") else f"_c{i}" for i, c in enumerate(docs.columns)]  # so that no column can clash
    out = mixed(docs.toDF(*own), plan, seed).filter("mix_copies > 0")
    copies = F.explode(F.array_repeat(F.lit(True), F.col("mix_copies").cast("int"))).alias("_copy")
    return out.select(*own, copies).select(*own).toDF(*docs.columns)
