"""Suffix-array deduplication: bytes covered by a string of LENGTH bytes that occurs again.

The difference-cover construction of a suffix array sorts the suffixes at sampled positions by triples, recurses on their
names, and places all other suffixes by the sample that follows them. Sampling by position modulo a period needs one byte
in 17 or more here, so the sample, which is shuffled, is content-defined instead (a synchronising set): in each window of LENGTH bytes the position of the smallest hashed run of SEED bytes, one in about 170, has the property that
makes difference covers work: two equal windows have sampled positions at equal distance. Spans between samples
are named by hashes; names that are equal or occur once are settled, and only the rest recurses, on shorter names, down to
single windows, which are placed by their distance to the sample. Names instead of ranks suffice, as all that is asked of
the order is which neighbours share LENGTH bytes (see `repeats`).

Defined results: null counts as empty; matches never cross documents; strings are judged on the input, the first
occurrence goes, too, overlaps count, and so do rows that repeat an id; a text shorter than LENGTH keeps all; an empty
table gives an empty table. Cutting bytes may split a character: `sa_kept` is binary.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from netkpi.llm import repeats
from netkpi.llm.arrays import Rolling

LENGTH, SEED = 400, 64


def units(rolling: Rolling, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return rolling.of_byte[data], offs


def found_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, periodic: bool = False) -> DataFrame:
    """rid and the byte spans that are repeated. periodic: sampled by a difference cover, not by content; equal results."""
    width = length - seed + 1
    sample = repeats.covered if periodic else repeats.anchors
    return repeats.repeated_spans(docs, units, length, seed, (max(1, round(width**0.5)), 1), sample)


def kept(docs: DataFrame, found: DataFrame) -> DataFrame:
    """All columns of docs but the text, and sa_bytes, sa_removed, sa_spans (maximal removed runs) and sa_kept."""
    rows = repeats.with_spans(docs, found)
    own = ("sa_bytes", "sa_removed", "sa_spans", "sa_kept")
    names = [f for f in docs.schema.fields if f.name not in ("text", *own)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, runs, text = [], [], [], []
            for t, spans in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("_spans").to_pylist(), strict=True):
                t, out, to = t or b"", [], 0
                cut = repeats.merged(spans)
                for first, end in cut:
                    out.append(t[to:first])
                    to = end
                out.append(t[to:])
                n.append(len(t))
                text.append(b"".join(out))
                removed.append(len(t) - len(text[-1]))
                runs.append(len(cut))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in names), *(pa.array(x, pa.int64()) for x in (n, removed, runs)), pa.array(text, pa.binary())],
                [*(f.name for f in names), *own])

    return rows.mapInArrow(run, StructType([*names, *(StructField(x, LongType()) for x in own[:3]), StructField(own[3], BinaryType())]))
