"""Which fixed-length windows of all texts occur more than once, without a row per window.

Every window of `length` units (bytes or words) picks an anchor in itself: the run of `seed` units with the smallest hash,
the leftmost of equals. The choice depends on the window's content alone, so equal windows pick equal anchors at equal
places: anchors are a synchronising sample of positions, of which few are needed. Windows with one anchor lie side by
side and are one row, a span: `core`, a hash of what all windows at these places have in common (at first the seed), and
`whole`, a hash of all that the span covers.

A round joins spans on their cores. A core that occurs once: none of its windows is repeated. Spans with equal wholes:
all their windows are. Otherwise a match ends somewhere inside, and one span for each different whole is cut into
narrower ones, which are treated in the same way, until spans are single windows. So the rows of later rounds follow the
number of match ends, not the length of matches. Counts are summed where rows are read; frequent cores are no single
task; nothing is capped. Hashes have 64 bits and stand for the units they cover.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from netkpi.llm.arrays import Rolling, mixed, text_slices
from netkpi.llm.shared import discard, with_maybe
from netkpi.sources.tables import materialize

#: (rolling, bytes, byte offsets) to the units of all texts and the unit offsets.
Units = Callable[[Rolling, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
SPAN = "rid long, at int, low int, high int, core long, whole long, seen boolean"
U = np.uint64


def rows_with_id(docs: DataFrame) -> DataFrame:
    """rid and text of every row: rows that repeat an id and text share rid, and count one by one."""
    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text")


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == width else np.minimum(x[:len(x) - (width - span)], x[width - span:])


def _placed(h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of content and of the places of the span relative to its anchor."""
    with np.errstate(over="ignore"):
        return mixed(h ^ ((low.astype(U) << U(32)) ^ (high.astype(U) & U(0xFFFFFFFF))) * U(0xA0761D6478BD642F))


def _batch(rid, at, low, high, core, whole, seen) -> pa.RecordBatch:
    as_int = lambda x: pa.array(x.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(rid), as_int(at), as_int(low), as_int(high), pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(seen)],
        ["rid", "at", "low", "high", "core", "whole", "seen"])


def anchors(units: np.ndarray, offs: np.ndarray, rolling: Rolling, length: int, seed: int):
    """Per anchor: document, anchor, first and last window (in the slice), core and whole."""
    sums = rolling.sums(units)
    width = length - seed + 1
    n = len(units) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none.view(U), none.view(U)
    h = rolling.fixed(sums, seed)
    packed = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U)
    at = (sliding_min(packed, width) & U(0xFFFFFFFF)).astype(np.int64)
    # windows inside one text
    change = np.zeros(n + 1, np.int32)
    begin, end = offs[:-1], offs[1:] - length + 1
    some = end > begin
    np.add.at(change, begin[some], 1)
    np.add.at(change, end[some], -1)
    inside = np.cumsum(change)[:n] > 0
    starts = inside.copy()
    starts[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    starts[begin[some]] = True
    low = np.flatnonzero(starts)
    last = inside.copy()
    last[:-1] &= starts[1:] | ~inside[1:]
    high = np.flatnonzero(last)
    at = at[low]
    doc = np.searchsorted(offs, low, "right") - 1
    whole = _placed(rolling.of(sums, low, high + length), low - at, high - at)
    return doc, at, low, high, h[at], whole


def difference_cover(most: int) -> tuple[int, list[int]]:
    """A period of at most `most` and places in it between which every distance occurs (Colbourn and Ling's rule)."""
    r = 0
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= most:
        r += 1
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return (24 * r * r + 36 * r + 13, np.cumsum([0, *steps]).tolist()) if most >= 13 else (1, [0])


def covered(units: np.ndarray, offs: np.ndarray, rolling: Rolling, length: int, seed: int):
    """As `anchors`, at the places of a difference cover instead: two equal windows have a sampled place at the same distance.

    A sampled place stands for all windows that begin less than a period before it, so windows are in many spans.
    """
    period, places = difference_cover(length - seed + 1)
    sampled = np.zeros(period, bool)
    sampled[places] = True
    begin, lens = offs[:-1], np.diff(offs)
    doc = np.repeat(np.arange(len(lens)), lens)
    at = np.flatnonzero(sampled[(np.arange(len(units)) - begin[doc]) % period])
    doc = doc[at]
    low, high = np.maximum(at - period + 1, begin[doc]), np.minimum(at, offs[1:][doc] - length)
    some = low <= high
    doc, at, low, high = doc[some], at[some], low[some], high[some]
    sums = rolling.sums(units)
    return doc, at, low, high, rolling.of(sums, at, at + seed), _placed(rolling.of(sums, low, high + length), low - at, high - at)


def first_spans(rows: DataFrame, units: Units, length: int, seed: int, sample: Callable = anchors) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            rid = b.column("rid").to_numpy()
            for i, j, data, offs in text_slices(b.column("text")):
                u, at = units(rolling, data, offs)
                doc, a, low, high, core, whole = sample(u, at, rolling, length, seed)
                base = at[doc]
                yield _batch(rid[i:j][doc], a - base, low - a, high - a, core, whole, np.zeros(len(doc), bool))

    return rows.mapInArrow(run, SPAN)


def cut_spans(held: DataFrame, units: Units, length: int, width: int, step: int) -> DataFrame:
    """held: rid, text and spans (at, low, high, seen). Spans on the grid of `step` windows that they cover.

    The core is that of the grid's whole step, wherever the span was cut off, so that all spans of the step share it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            rid, spans = b.column("rid").to_numpy(), b.column("spans")
            n_spans = np.diff(spans.offsets.to_numpy())
            to = np.concatenate(([0], np.cumsum(n_spans)))
            flat = spans.flatten()
            at, low, high, seen = (np.asarray(flat.field(c).to_numpy(zero_copy_only=False)) for c in ("at", "low", "high", "seen"))
            for i, j, data, offs in text_slices(b.column("text")):
                u, uo = units(rolling, data, offs)
                sums = rolling.sums(u)
                part = slice(to[i], to[j])
                a, lo, hi, sn = at[part].astype(np.int64), low[part].astype(np.int64), high[part].astype(np.int64), seen[part]
                doc = np.repeat(np.arange(j - i), n_spans[i:j])
                first, last = (lo + width - 1) // step, (hi + width - 1) // step
                times = last - first + 1
                k = np.repeat(np.arange(len(a)), times)
                cell = first[k] + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                c0 = cell * step - (width - 1)
                c1 = np.minimum(c0 + step - 1, 0)
                low_k, high_k = np.maximum(lo[k], c0), np.minimum(hi[k], c1)
                base = uo[doc[k]] + a[k]
                core = _placed(rolling.of(sums, base + c1, base + c0 + length), c0, c1)
                whole = _placed(rolling.of(sums, base + low_k, base + high_k + length), low_k, high_k)
                yield _batch(rid[i:j][doc[k]], a[k], low_k, high_k, core, whole, sn[k])

    return held.mapInArrow(run, SPAN)


def repeated_spans(docs: DataFrame, units: Units, length: int, seed: int, steps: Sequence[int], sample: Callable = anchors) -> DataFrame:
    """rid and `spans`, a list of (first, end) in units, of what windows that occur again cover; rows without are left out.

    steps: the grid of windows per round; the last is 1. sample: the places that windows meet on, `anchors` or `covered`.
    """
    rows, width = rows_with_id(docs), length - seed + 1
    every = first_spans(rows, units, length, seed, sample)
    if sample is covered:  # many places: only cores move at first, and only spans whose core may occur again are written
        cores = materialize(every.groupBy("core").count().filter("count > 1").select("core"), "repeat-cores")
        every = with_maybe(every, cores, "core").filter("_maybe").drop("_maybe")
    every = materialize(every, "repeat-anchors")
    # most anchors occur once: only those that do not go on, with their other columns. What is joined on a frequent core
    # is written first, so that Spark can split the join
    again = materialize(every.groupBy("core").count().filter("count > 1").select("core"), "repeat-cores")
    spans = materialize(every.join(again.hint("merge"), "core", "left_semi"), "repeat-spans")
    discard(every)
    found = []
    for step in [*steps, None]:
        wholes = materialize(spans.groupBy("core", "whole").agg(
            ((F.count(F.lit(1)) > 1) | F.max("seen")).alias("seen"), F.count(F.lit(1)).alias("n"),
            *[F.first(c).alias(c) for c in ("rid", "at", "low", "high")]), "repeat-wholes")
        open_ = F.max((~F.col("seen")).cast("int"))
        cores = wholes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), open_.alias("open")).filter("kinds > 1 and open = 1")
        cores = materialize(cores.select("core"), "repeat-cores")
        equal = wholes.filter("n > 1").select("core", "whole")
        # seen spans stand for others that are found already
        found.append(spans.filter("not seen").join(equal.hint("merge"), ["core", "whole"], "left_semi")
                     .select("rid", (F.col("at") + F.col("low")).alias("first"), (F.col("at") + F.col("high") + length).alias("end")))
        if step is None:
            break
        next_ = wholes.join(cores.hint("merge"), "core", "left_semi")
        by_row = materialize(next_.groupBy("rid").agg(F.collect_list(F.struct("at", "low", "high", "seen")).alias("spans")), "repeat-open")
        # only texts that may have open spans move; rows that repeat id and text have no open span of their own
        maybe = with_maybe(rows, by_row.select("rid"), "rid").filter("_maybe")
        texts = maybe.join(by_row.hint("merge"), "rid").select("rid", "text", "spans")
        spans = materialize(cut_spans(texts, units, length, width, step), "repeat-spans")
    union = found[0]
    for f in found[1:]:
        union = union.unionAll(f)
    return materialize(union.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans")), "repeat-found")


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """All columns of docs and `_spans`, null where nothing is repeated."""
    found = found.toDF("_rid", "_spans")
    own = [c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(docs.columns)]  # so that no column can clash
    rows = with_maybe(docs.toDF(*own).withColumn("_rid", F.xxhash64("doc_id", "text")), found.select("_rid"), "_rid")
    # texts that certainly have none stay where they are
    alone = rows.filter("not _maybe").withColumn("_spans", F.lit(None).cast(found.schema["_spans"].dataType))
    some = rows.filter("_maybe").join(found.hint("merge"), "_rid", "left")
    kept = [c for c in docs.columns if c != "_spans"]
    both = alone.select(*own, "_spans").unionByName(some.select(*own, "_spans"))
    return both.select(*[F.col(o).alias(c) for o, c in zip(own, docs.columns, strict=True) if c in kept], "_spans")


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of sorted (first, end); touching ones are one."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        first, end = s["first"], s["end"]
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out
