"""Substring deduplication by seed and extend, over words.

Documents meet on winnowed anchors: the smallest of the hashed runs of SEED words in each window of WINDOW words. A match
is extended both ways by comparing ever narrower spans around the anchor (see `repeats`), until what is left are the
maximal repeats of at least WINDOW words; every word in one goes, the first occurrence, too.

Defined results: a null or empty text has no words; repeats count wherever they start, in the same document and in rows
that repeat an id, too; a text of fewer than WINDOW words keeps all; an empty table gives an empty table. `kept` keeps all
columns but the text and those named like its own.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from netkpi.llm import repeats
from netkpi.llm.arrays import NOT_BLANK, Rolling, word_spans

WINDOW, SEED = 35, 8


def units(rolling: Rolling, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e, at = word_spans(data, offs, NOT_BLANK)
    return rolling.words(data, s, e), at


def found_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """rid and the word spans that are repeated."""
    return repeats.repeated_spans(docs, units, window, seed, (1,))


def kept(docs: DataFrame, found: DataFrame) -> DataFrame:
    """All columns of docs but the text, and sub_words, sub_removed and sub_text, the words that stay, by one blank."""
    rows = repeats.with_spans(docs, found)
    own = ("sub_words", "sub_removed", "sub_text")
    names = [f for f in docs.schema.fields if f.name not in ("text", *own)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, text = [], [], []
            for t, spans in zip(b.column("text").to_pylist(), b.column("_spans").to_pylist(), strict=True):
                words = (t or "").encode("utf-8", "surrogatepass").split()
                out, to = [], 0
                for first, end in repeats.merged(spans):
                    out += words[to:first]
                    to = end
                out += words[to:]
                n.append(len(words))
                removed.append(len(words) - len(out))
                text.append(b" ".join(out).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in names), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.string())],
                                             [*(f.name for f in names), *own])

    return rows.mapInArrow(run, StructType([*names, StructField(own[0], LongType()), StructField(own[1], LongType()), StructField(own[2], StringType())]))
