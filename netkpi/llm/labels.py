"""Labelled rows for training: held-out rule and bounded samples."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netkpi.llm.shared import spread


def remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def training_sample(labels: DataFrame, label: str, most: int, modulus: int = 5) -> DataFrame:
    """doc_id and y of at most `most` labelled rows that are not held out, the same ones in any run.

    Null labels and ids teach nothing. An id with several labels counts by their mean, rounded up.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(modulus) != 0))
    one = usable.groupBy("doc_id").agg(F.ceil(F.avg(label)).cast("int").alias("y"))
    return one.orderBy(spread(F.lit("sample"), F.col("doc_id")), "doc_id").limit(most)
