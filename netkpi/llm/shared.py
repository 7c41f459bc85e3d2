"""Reading the given tables, joins behind a size check, and exact cuts of a long weighted order."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netkpi.sources.tables import materialize

#: A joined side of at most so many bytes (by its row and element counts) is broadcast, a larger one is shuffled.
BROADCAST_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach(left: DataFrame, right: DataFrame, key: str, elements: str | None, element_bytes: int, how: str) -> DataFrame:
    """Join a written table whose size is measured first: small, it goes to every executor; beyond that Spark shuffles.

    elements: a list column of `right`, each element counted with element_bytes; each row counts 64 bytes besides.
    """
    held = F.sum(F.size(elements)) if elements else F.lit(0)
    n, m = right.agg(F.count(F.lit(1)), held).first()
    small = 64 * n + element_bytes * (m or 0) <= BROADCAST_BYTES
    return left.join(F.broadcast(right) if small else right.hint("merge"), key, how)


#: Bits per key of a membership filter, and the most bits of one of its blocks (128 MB, so that it may be broadcast; 67
#: million keys). A cell of the built-in bitmap functions has 2^15 bits.
FILTER_BITS, MOST_FILTER_BITS, CELL = 16, 1 << 30, 1 << 15


def with_maybe(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows with `_maybe`: false means that the row's key (evenly spread longs) is certainly not among the written keys.

    The filter grows with the keys. Beyond one block the rows of each block are read and written in turn, so that one
    block at a time is broadcast and the share of rows that pass stays the same.
    """
    n_cells = max(1, -(-FILTER_BITS * keys.count() // CELL))
    blocks = -(-n_cells * CELL // MOST_FILTER_BITS)
    per_block = -(-n_cells // blocks)
    bit = F.pmod(F.col(key), F.lit(blocks * per_block * CELL))
    cells = materialize(keys.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / CELL).alias("_cell"))
                        .agg(F.bitmap_construct_agg(F.col("bit") % CELL).alias("_marks")), "filter")
    at = (bit % CELL).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_marks"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.call_function("shiftright", byte, at % 8).bitwiseAND(1) == 1, F.lit(False))
    placed, out = rows.withColumn("_cell", F.floor(bit / CELL)), []
    for b in range(blocks):
        inside = F.col("_cell").between(b * per_block, (b + 1) * per_block - 1)
        some, side = (placed.filter(inside), cells.filter(inside)) if blocks > 1 else (placed, cells)
        tested = some.join(F.broadcast(side), "_cell", "left").withColumn("_maybe", maybe).select(*rows.columns, "_maybe")
        out.append(materialize(tested, "filter-passed") if blocks > 1 else tested)
    return reduce(DataFrame.unionByName, out)


def discard(written: DataFrame) -> None:
    """Delete the files of a frame from `materialize` that nothing reads any more."""
    spark = written.sparkSession
    for folder in {f.rpartition("/")[0] for f in written.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Slots per round of cut_at; two rounds leave a millionth of a group for the exact order.
SLOTS = 1024


def slot_of(hash_col: Column | str, round_no: int) -> Column:
    """The slot of an evenly spread number from 0 to 2^52 - 1: its first ten bits, then its first twenty."""
    return F.shiftright(F.col(hash_col) if isinstance(hash_col, str) else hash_col, 42 - 10 * round_no)


def spread(*values: Column) -> Column:
    """52 evenly spread bits of the md5 of the values as text, as a number from 0 to 2^52 - 1; null counts as empty."""
    joined = F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("")) for v in values])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def _first_over(sums: DataFrame, group: Sequence[str], slot: str, goal: str) -> DataFrame:
    """Per group the first slot at whose end the running weight is above what is left of the goal.

    sums: group, slot, w, goal. Returns group, slot, and as goal what is left before that slot.
    """
    order = Window.partitionBy(*group).orderBy(slot)
    run = sums.withColumn("_run", F.sum("w").over(order))
    over = run.filter(F.col("_run") > F.col(goal)).withColumn("_rn", F.row_number().over(order)).filter("_rn = 1")
    return over.select(*group, slot, (F.col(goal) - F.col("_run") + F.col("w")).alias(goal))


def cut_at(rows: DataFrame, goals: DataFrame, group: str, keys: Sequence[str], weight: str, tie: Sequence[str]) -> DataFrame:
    """Per group the last place that lies in front of its goal, in the order of `keys`, then `tie`.

    rows: group, integer keys, weight, ties; the last key is an evenly spread number below 2^52. goals: group, goal.
    Weights are summed per slot, first by each leading key, then by the first ten bits of the last one and the first twenty; only the
    rows of the one slot in which the goal falls are put in order. So no task sees a whole group. Returns per group:
    the leading keys, `_s0`, `_s1` of the slot in which the goal falls and `goal`, what is left of it before that slot.
    A group without such a slot (its whole weight is not above the goal) has no row.
    """
    steps = [(k, F.col(k)) for k in keys[:-1]] + [(f"_s{i}", slot_of(keys[-1], i)) for i in (0, 1)]
    left, seen = goals.select(group, F.col("goal").alias("_goal")), []
    at = rows
    for name, value in steps:
        at = at.withColumn(name, value)
        on = [group, *seen]
        sums = at.join(left, on).groupBy(*on, name, "_goal").agg(F.sum(weight).alias("w"))
        left = materialize(_first_over(sums, on, name, "_goal"), "cut")
        seen.append(name)
    return left.withColumnRenamed("_goal", "goal")
