"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed words, word pairs and pairs with one word left out (A-Z lower-cased, words of letters and
digits). Each weight has its own learning rate, which falls with the squares of its own gradients, and an L1 bound keeps
all weights at zero whose evidence is small, so the model is a short sorted list of slots and weights that goes to every
task.

The weights are learned on at most TRAIN_ROWS labelled rows (a documented bound): their hashed slots come to the driver,
about 1,500 numbers of 4 bytes each, and are passed over in the order of their ids. Every document is scored whole.

Defined results: null and empty texts score by the bias alone; without labels the score is 0.5; rows that repeat an id
are scored one by one; an empty table gives an empty table. `scored` keeps all columns but one named like its own.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from netkpi.llm.arrays import LETTERS_DIGITS, LOWER, Rolling, mixed, text_slices, word_spans
from netkpi.llm.labels import training_sample

TRAIN_ROWS = 16_000
SLOT_BITS = 22
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 10.0, 0.1, 4


def slots(rolling: Rolling, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, pairs and skip pairs of all texts, and the document of each, in no order."""
    data = LOWER[data]
    s, e, at = word_spans(data, offs, LETTERS_DIGITS)
    h = rolling.words(data, s, e)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(at))
    out, docs = [h], [doc]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            out.append(mixed(h[:-gap] * np.uint64(salt) + h[gap:])[same])
            docs.append(doc[gap:][same])
    return (np.concatenate(out) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), np.concatenate(docs)


def slot_rows(docs: DataFrame) -> DataFrame:
    """doc_id, y and the distinct slots of each text, packed as 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            held = []
            for i, j, data, offs in text_slices(b.column("text")):
                at, doc = slots(rolling, data, offs)
                both = np.unique((doc << 32) | at)
                parts = np.split((both & 0xFFFFFFFF).astype(np.int32), np.searchsorted(both >> 32, np.arange(1, j - i)))
                held += [p.tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(held, pa.binary())], ["doc_id", "y", "slots"])

    rows = docs.select("doc_id", "y", "text")
    return rows.mapInArrow(run, rows.select("doc_id", "y", F.lit(b"").alias("slots")).schema)


class Ftrl:
    """FTRL-proximal: sums z and squared gradients n per slot; weights follow from them when they are needed."""

    def __init__(self) -> None:
        size = 1 << SLOT_BITS
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last slot is the bias, without L1

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        bound = np.where(at == len(self.z) - 1, 0.0, L1)
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= bound, 0.0, -(z - np.sign(z) * bound) / rate)

    def learn(self, at: np.ndarray, y: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g

    def model(self) -> tuple[np.ndarray, np.ndarray, float]:
        every = np.arange(len(self.z))
        w = self.weights(every)
        some = np.flatnonzero(w[:-1])
        return some, w[some], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots with a weight, these weights, and the bias. The sampled ids (at most `most`) are sent to the documents.

    An id teaches once: of rows that repeat it the one whose slots come first, so the driver gets at most `most` lists of at most
    2^SLOT_BITS slots.
    """
    chosen = docs.select("doc_id", "text").join(F.broadcast(training_sample(labels, label, most)), "doc_id")
    held = slot_rows(chosen).groupBy("doc_id").agg(F.min("slots").alias("slots"), F.max("y").alias("y")).toArrow()
    ids, rows, y = held.column("doc_id").to_pylist(), held.column("slots").to_pylist(), held.column("y").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: ids[i])  # it does not depend on where rows were read
    ftrl, shuffled = Ftrl(), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in shuffled.permutation(len(order)):
            k = order[i]
            ftrl.learn(np.frombuffer(rows[k], np.int32).astype(np.int64), y[k])
    return ftrl.model()


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """All columns of docs but the text, and toxic_score."""
    at, weight, bias = model
    kept = [f for f in docs.schema.fields if f.name not in ("text", "toxic_score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, dense = Rolling(), np.zeros(1 << SLOT_BITS)
        dense[at] = weight
        for b in batches:
            out = [np.zeros(0)]
            for i, j, data, offs in text_slices(b.column("text")):
                slot, doc = slots(rolling, data, offs)
                hit = np.flatnonzero(dense[slot])
                # a slot counts once per text
                both = np.unique((doc[hit] << 32) | slot[hit])
                f = bias + np.bincount(both >> 32, dense[both & 0xFFFFFFFF], j - i)
                out.append(1 / (1 + np.exp(-np.clip(f, -30, 30))))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), pa.array(np.concatenate(out))],
                                             [*(f.name for f in kept), "toxic_score"])

    return docs.mapInArrow(run, StructType([*kept, StructField("toxic_score", DoubleType())]))
