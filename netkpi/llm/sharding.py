"""K-d tree partitioning into shards of near equal bytes (built-in functions only).

Documents with equal texts form one group, so that they land in one shard. Groups are points with three metadata
dimensions: the logarithm of the size, source and language (names by a checksum, as they have no order). A node that is
to hold several shards is split along its widest dimension at the weighted median (the k / n quantile if its shards are
an odd number), equal values by a hash of the text. Medians come from sums per slot, never from rows in one task.

Defined results: a null text has size 1 and counts as empty, with an empty text it forms a group; null source or
language is a value of its own; rows that repeat an id are rows of their own; an empty table gives an empty table. A
group larger than a shard stays whole, so that shard is larger. Other columns are not carried.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from netkpi.llm.shared import cut_at, discard, slot_of
from netkpi.sources.tables import materialize

DIMENSIONS = ("d_size", "d_source", "d_lang")
#: Rows that one task numbers at once.
SLOT_ROWS = 20_000


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), checksum, text hash and metadata; written once so that texts are read once."""
    text = F.coalesce("text", F.lit(""))
    return materialize(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang")), "shard-rows")


def text_groups(rows: DataFrame) -> DataFrame:
    name = lambda c: F.shiftright(F.coalesce(F.crc32(F.min(c).cast("binary")), F.lit(0)), 22).cast("int")  # noqa: E731  ten bits
    return materialize(rows.groupBy("text_hash", "text_crc32", "size").agg(
        F.sum("size").alias("w"), name("source").alias("d_source"), name("lang").alias("d_lang"))
        .withColumn("d_size", F.least(F.lit(1023), F.floor(F.log2("size") * 32)).cast("int"))
        .withColumn("h", F.shiftrightunsigned("text_hash", 12)), "shard-groups")


def kd_shards(groups: DataFrame, shards: int) -> DataFrame:
    """Groups with `shard`, 0 to shards - 1.

    A row carries the shards its node is to hold: `first` and `held`. Every level splits all nodes at once; the nodes'
    cuts are a small table, so rows are not moved. Each level is written, so that plans stay short.
    """
    at = materialize(groups.withColumns({"first": F.lit(0), "held": F.lit(int(shards))}), "shard-level")
    while shards > 1:
        last, at = at, materialize(_split(at), "shard-level")
        discard(last)
        shards = -(-shards // 2)
    return at.withColumn("shard", F.col("first")).drop("first", "held")


def _split(at: DataFrame) -> DataFrame:
    widths = [(F.max(d) - F.min(d)).alias(f"r_{d}") for d in DIMENSIONS]
    nodes = at.filter("held > 1").groupBy("first", "held").agg(F.sum("w").alias("all"), *widths)
    widest = F.greatest(*[F.col(f"r_{d}") for d in DIMENSIONS])
    axis = F.coalesce(*[F.when(F.col(f"r_{d}") == widest, F.lit(i)) for i, d in enumerate(DIMENSIONS)])
    left = F.floor(F.col("held") / 2).cast("int")
    nodes = materialize(nodes.select("first", axis.alias("axis"), left.alias("left"), (F.col("all") * left / F.col("held")).alias("goal")), "shard-nodes")
    x = F.element_at(F.array(*[F.col(d) for d in DIMENSIONS]), F.col("axis") + 1)
    rows = at.join(nodes.drop("goal"), "first", "left").withColumn("x", F.when(F.col("axis").isNotNull(), x))
    open_ = rows.filter("axis is not null")
    cuts = cut_at(open_.select("first", "x", "h", "w"), nodes.select("first", "goal"), "first", ["x", "h"], "w", [])
    near = (open_.withColumns({"_s0": slot_of("h", 0), "_s1": slot_of("h", 1)}).join(cuts, ["first", "x", "_s0", "_s1"])
            .groupBy("first", "x", "goal", "_s0", "_s1", "h").agg(F.sum("w").alias("w")))
    run = F.sum("w").over(Window.partitionBy("first").orderBy("h"))
    inside = run + run - F.col("w") <= F.col("goal") + F.col("goal")
    before = F.shiftleft(F.col("_s1"), 32) - 1
    ends = (near.withColumn("ok", inside).groupBy("first", F.col("x").alias("x_end"))
            .agg(F.coalesce(F.max(F.when(F.col("ok"), F.col("h"))), F.max(before)).alias("h_end")))
    ends = materialize(ends, "shard-cuts")
    right = (F.col("x") > F.col("x_end")) | ((F.col("x") == F.col("x_end")) & (F.col("h") > F.col("h_end")))
    out = rows.join(ends, "first", "left").withColumn("_right", F.coalesce(right, F.lit(False)))
    return out.select(
        *[c for c in at.columns if c not in ("first", "held")],
        F.when(F.col("_right"), F.col("first") + F.col("left")).otherwise(F.col("first")).alias("first"),
        F.when(F.col("left").isNull(), F.col("held")).when(F.col("_right"), F.col("held") - F.col("left")).otherwise(F.col("left")).cast("int").alias("held"))


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """How many shards bring each to the target size at most, on average."""
    return max(1, -(-int(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))


def numbered(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """`slot`, gapless from 0 inside each shard: parts of a shard are numbered apart, then shifted by the parts before."""
    parts = max(8, -(-n // (SLOT_ROWS * shards)))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = (rows.groupBy("shard", "_part").count()
             .withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    inside = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_no", F.row_number().over(inside) - 1).join(materialize(start, "shard-parts"), ["shard", "_part"])
            .withColumn("slot", (F.col("_no") + F.col("_start")).cast("long")).drop("_part", "_no", "_start"))


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every document."""
    rows = sized_rows(docs)
    found = materialize(kd_shards(text_groups(rows), shards).select("text_hash", "text_crc32", "size", "shard"), "shard-of-group")
    with_shard = rows.select("doc_id", "size", "text_crc32", "text_hash").join(found, ["text_hash", "text_crc32", "size"])
    with_shard = materialize(with_shard.select("doc_id", "size", "text_crc32", "shard"), "shard-assigned")
    return numbered(with_shard, rows.count(), shards).select("doc_id", "size", "text_crc32", "shard", "slot")
