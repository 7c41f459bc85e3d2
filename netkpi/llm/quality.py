"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text (shares of character classes, word lengths, repetition of words, word triples and lines) are cut into
bins. Shallow trees over one feature at a time, boosted in turn with small steps, add up to one lookup table per feature;
the pairs that explain most of what is left get a table of two dimensions in the same way. A score is the sum of table
entries through the logistic function, so scoring is indexing and adding.

The model is fitted on at most TRAIN_ROWS labelled rows (features only, a few MB, on the driver); features and scores
are computed for every document. Texts are read once and never moved.

Defined results: null and empty texts have all features zero and get a score like any other; without labels, or with one
class, the score is the share of label 1 (0.5 without labels); rows that repeat an id are scored one by one; an empty
table gives an empty table. `scored` keeps all columns but one named like its own.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from netkpi.llm.arrays import NOT_BLANK, Rolling, byte_table, doc_sums, text_slices, word_spans
from netkpi.llm.labels import training_sample

TRAIN_ROWS = 20_000
BINS, COARSE, ROUNDS, RATE, PAIRS = 64, 16, 120, 0.1, 6
FEATURES = (
    "log_bytes", "upper", "digits", "beyond_ascii", "marks", "symbols", "shouts", "bars", "newlines", "blanks",
    "log_words", "word_length", "word_spread", "wordless", "ends_marked", "distinct_words", "top_word", "same_as_last",
    "same_as_last_but_one", "repeated_triples", "line_length", "repeated_lines",
)


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys per document and the count of its most frequent one."""
    packed = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (keys >> np.uint64(24)))
    first = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1]))) if len(packed) else np.zeros(0, np.int64)
    of = (packed[first] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of, np.diff(np.append(first, len(packed))))
    return np.bincount(of, minlength=n), top


def features(rolling: Rolling, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Documents x FEATURES."""
    n = len(offs) - 1
    size = np.maximum(1, np.diff(offs))
    share = lambda table: doc_sums(table[data], offs) / size
    upper, digits = byte_table(bytes(range(65, 91))), byte_table(b"0123456789")
    marks = byte_table(b".,;:?'\"()-")
    symbols = byte_table(b"#$%&*^~<>{}[]\\=+@_/`")
    beyond = np.arange(256) > 127
    letters = upper | byte_table(bytes(range(97, 123))) | beyond
    s, e, at = word_spans(data, offs, NOT_BLANK)
    length, words = e - s, np.maximum(1, np.diff(at))
    doc = np.repeat(np.arange(n), np.diff(at))
    sums = rolling.sums(rolling.of_byte[data])
    h = rolling.of(sums, s, e)
    lettered = np.zeros(len(data) + 1, np.int64)
    np.cumsum(letters[data], out=lettered[1:])
    mean = doc_sums(length, at) / words
    spread = np.sqrt(np.maximum(0, doc_sums(length * length, at) / words - mean * mean))

    def equal_to(back: int) -> np.ndarray:
        same = np.zeros(len(h), bool)
        same[back:] = (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
        return doc_sums(same, at) / words

    kinds, top = _distinct(h, doc, n)
    triples = rolling.fixed(rolling.sums(h), 3)
    inside = doc[:len(triples)] == doc[2:2 + len(triples)]
    n_triples = np.bincount(doc[:len(triples)][inside], minlength=n)
    triple_kinds, _ = _distinct(triples[inside], doc[:len(triples)][inside], n)
    not_newline = np.arange(256) != 10
    ls, le, lat = word_spans(data, offs, not_newline)
    ldoc = np.repeat(np.arange(n), np.diff(lat))
    lines = np.diff(lat)
    line_kinds, _ = _distinct(rolling.of(sums, ls, le), ldoc, n)
    last = data[e - 1] if len(e) else data[:0]
    return np.column_stack([
        np.log1p(np.diff(offs)), share(upper), share(digits), share(beyond), share(marks), share(symbols),
        share(byte_table(b"!")), share(byte_table(b"|")), share(byte_table(b"\n")), share(~NOT_BLANK),
        np.log1p(np.diff(at)), mean, spread, doc_sums(lettered[e] == lettered[s], at) / words,
        doc_sums((marks | symbols | byte_table(b"!|"))[last], at) / words, kinds / words, top / words,
        equal_to(1), equal_to(2), 1 - triple_kinds / np.maximum(1, n_triples) * (n_triples > 0) - (n_triples == 0),
        doc_sums(le - ls, lat) / np.maximum(1, lines), 1 - line_kinds / np.maximum(1, lines) - (lines == 0),
    ]).astype(np.float32).reshape(n, len(FEATURES))


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id, y and `features`, packed 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            held = [row.tobytes() for _, _, data, offs in text_slices(b.column("text")) for row in features(rolling, data, offs)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(held, pa.binary())], ["doc_id", "y", "features"])

    rows = docs.select("doc_id", "y", "text")
    return rows.mapInArrow(run, rows.select("doc_id", "y", F.lit(b"").alias("features")).schema)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a run of bins and the bin before which it cuts; 0 if none helps."""
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(cg):
        return 0.0, 0
    tg, th = g.sum(), h.sum()
    gain = cg**2 / (ch + 1) + (tg - cg)**2 / (th - ch + 1) - tg**2 / (th + 1)
    gain[(ch < 2) | (th - ch < 2)] = 0
    i = int(gain.argmax())
    return float(gain[i]), i + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Step per bin of a tree of the given depth over one feature."""
    gain, at = _cut(g, h) if depth else (0.0, 0)
    if gain <= 0:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """One cut along one feature, then one along the other on each side; the better of both orders."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        gain, at = _cut(a.sum(axis=1), b.sum(axis=1))
        if gain <= 0:
            at = 0
        out = np.empty_like(a)
        for part in (slice(0, at), slice(at, None)):
            if a[part].size:
                more, _ = _cut(a[part].sum(axis=0), b[part].sum(axis=0))
                gain += more
                out[part] = _tree(a[part].sum(axis=0), b[part].sum(axis=0), 1)
        if gain > best[0]:
            best = (gain, out.T if turned else out)
    return best


class Additive:
    """Bins, one table per feature, and tables of chosen pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.bias = float(np.log(mean / (1 - mean)))
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(y) else np.zeros(0) for c in x.T]
        self.tables = [np.zeros(BINS) for _ in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if not len(y) or y.min() == y.max():
            return
        bins = self.bins(x)
        f = np.full(len(y), self.bias)

        def left_over() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-f))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for k, table in enumerate(self.tables):
                g, h = left_over()
                step = RATE * _tree(np.bincount(bins[k], g, BINS), np.bincount(bins[k], h, BINS), 2)
                table += step
                f += step[bins[k]]
        coarse = bins * COARSE // BINS
        g, h = left_over()
        grid = lambda a, b, v: np.bincount(coarse[a] * COARSE + coarse[b], v, COARSE * COARSE).reshape(COARSE, COARSE)
        ranked = sorted(((_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(len(bins)) for b in range(a)), reverse=True)
        self.pairs = [(a, b, np.zeros((COARSE, COARSE))) for gain, a, b in ranked[:PAIRS] if gain > 0]
        for _ in range(ROUNDS // 2):
            for a, b, table in self.pairs:
                g, h = left_over()
                step = RATE * _pair_tree(grid(a, b, g), grid(a, b, h))[1]
                table += step
                f += step[coarse[a], coarse[b]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.array([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)]).reshape(len(FEATURES), -1)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        coarse = bins * COARSE // BINS
        f = np.full(x.shape[0], self.bias)
        for k, table in enumerate(self.tables):
            f += table[bins[k]]
        for a, b, table in self.pairs:
            f += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-f))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_ROWS) -> Additive:
    """The sampled ids (at most `most`) are sent to the documents; their features come to the driver in a fixed order.

    An id teaches once: of rows that repeat it the one whose features come first, so `most` bounds what the driver gets.
    """
    chosen = docs.select("doc_id", "text").join(F.broadcast(training_sample(labels, label, most)), "doc_id")
    held = feature_rows(chosen).groupBy("doc_id").agg(F.min("features").alias("features"), F.max("y").alias("y")).toArrow()
    x, y = (np.frombuffer(b"".join(held.column("features").to_pylist()), np.float32).reshape(-1, len(FEATURES)),
            held.column("y").to_numpy().astype(np.float64))
    order = np.lexsort((*x.T, y))  # sums then do not depend on where rows were read
    return Additive(x[order], y[order])


def scored(docs: DataFrame, model: Additive, least: float | None = None) -> DataFrame:
    """All columns of docs and quality_score; with `least`, only documents that score so much."""
    kept = [f for f in docs.schema.fields if f.name != "quality_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            parts = [model.score(features(rolling, data, offs)) for _, _, data, offs in text_slices(b.column("text"))]
            score = np.concatenate([np.zeros(0), *parts])
            out = pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), pa.array(score)], [*(f.name for f in kept), "quality_score"])
            yield out if least is None else out.filter(pa.array(score >= least))

    return docs.mapInArrow(run, StructType([*kept, StructField("quality_score", DoubleType())]))
