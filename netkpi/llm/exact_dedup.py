"""Exact deduplication by two-pass Bloom filtering (built-in functions only).

First pass: every document sets its bits; a bit that is set more than once is marked in a bit array. Second pass: a row
whose bits are all marked may be repeated and goes on to the exact grouping; all other rows are known to be alone, need
no partner and pass straight through. Only fixed-width numbers move: in the first pass two bit positions per document, in
the second the digests of rows that may be repeated; never a text.

The filter grows with the documents, so that the same share of rows passes at every size. It is cut into blocks of at
most MOST_BITS; all bits of a row lie in one block, and the second pass takes one block at a time, with the rows of that
block only. More documents mean more blocks, each a read of the written digests, and never a larger broadcast.

Defined results: null text counts as empty; equality is that of the SHA-256 of the text without blanks and control
characters 9 to 13; the row with most code points, then smallest doc_id (null ids last), stays; rows that repeat a
doc_id are counted one by one and all carry the same keep_id, `kept` is true for each row with the kept id and length;
an empty table gives an empty table. Other columns are not carried.
"""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from netkpi.sources.tables import materialize

#: Bits of the filter per document, hashes per document, and the most bits of a block (128 MB, so that it may be
#: broadcast; 67 million documents).
BITS_PER_ROW, HASHES, MOST_BITS = 16, 2, 1 << 30
#: A bit array cell of the built-in bitmap functions has 2^15 bits.
CELL = 1 << 15


def normalised(text) -> F.Column:
    out = F.coalesce(text, F.lit(""))
    for c in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, code points of the text and SHA-256 of the normalised text, written once."""
    return materialize(docs.select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n_points"),
        F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256")), "exact-digests")


def _stretch(i: int) -> F.Column:
    """Disjoint stretches of a digest, as numbers."""
    return F.conv(F.substring("text_sha256", 1 + 15 * i, 15), 16, 10).cast("long")


def _tested(rows: DataFrame, marked: DataFrame, bits: list) -> DataFrame:
    """Rows with `repeated`: are all their bits marked. marked: the cells of one block."""
    out, flags = rows, []
    for i, bit in enumerate(bits):
        side = marked.select(F.col("cell").alias(f"_cell{i}"), F.col("marks").alias(f"_marks{i}"))
        out = out.withColumn(f"_bit{i}", bit).withColumn(f"_cell{i}", F.floor(F.col(f"_bit{i}") / CELL))
        out = out.join(F.broadcast(side), f"_cell{i}", "left")  # at most MOST_BITS / 8 bytes
        at = (F.col(f"_bit{i}") % CELL).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"_marks{i}"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        flags.append(F.coalesce(F.call_function("shiftright", byte, at % 8).bitwiseAND(1) == 1, F.lit(False)))
    return out.withColumn("repeated", reduce(and_, flags)).select(*rows.columns, "repeated")


def possibly_repeated(rows: DataFrame, n: int, bits_per_row: int = BITS_PER_ROW, most: int | None = None) -> DataFrame:
    """The n rows of `digests`, written, with `repeated`: false means certainly alone. most: bits of a block, whole cells."""
    cells = max(1, -(-bits_per_row * n // CELL))
    blocks = -(-cells * CELL // (most or MOST_BITS))
    per_block = -(-cells // blocks)
    block = F.pmod(_stretch(HASHES), F.lit(blocks))
    bits = [block * (per_block * CELL) + F.pmod(_stretch(i), F.lit(per_block * CELL)) for i in range(HASHES)]
    hits = rows.select(F.explode(F.array(*bits)).alias("bit")).groupBy("bit").count().filter("count > 1")
    marked = (hits.groupBy(F.floor(F.col("bit") / CELL).alias("cell"))
              .agg(F.bitmap_construct_agg(F.col("bit") % CELL).alias("marks")))
    marked = materialize(marked, "exact-bloom")
    passed = []
    for b in range(blocks):
        here = marked.filter(F.col("cell").between(b * per_block, (b + 1) * per_block - 1))
        passed.append(materialize(_tested(rows.filter(block == b) if blocks > 1 else rows, here, bits), "exact-passed"))
    return reduce(DataFrame.unionByName, passed)


def exact_groups(rows: DataFrame) -> DataFrame:
    """One row per document of `digests`: keep_id, group_size, kept."""
    seen = possibly_repeated(rows, rows.count())
    alone = seen.filter("not repeated").select("doc_id", "n_points", "text_sha256", F.col("doc_id").alias("keep_id"),
                                               F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    again = seen.filter("repeated").select("doc_id", "n_points", "text_sha256")
    # a group is pre-aggregated where its rows are read; per length one smallest id, then the greatest length
    by_length = again.groupBy("text_sha256", "n_points").agg(F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("n"))
    longest = by_length.groupBy("text_sha256").agg(
        F.sum("n").alias("group_size"), F.max(F.struct("n_points", "lowest")).alias("best"))
    keep = longest.select("text_sha256", F.col("best.lowest").alias("keep_id"), F.col("best.n_points").alias("_most"), "group_size")
    keep = materialize(keep, "exact-keep")  # so that Spark can split the join where a group is large
    same = again.join(keep, "text_sha256").select(
        "doc_id", "n_points", "text_sha256", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("_most"))).alias("kept"))
    return alone.unionByName(same)
