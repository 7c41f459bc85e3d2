"""Benchmark decontamination with training suffix arrays.

Every slice of documents is a shard. Words become 64-bit hashes, and the shard's suffix array sorts its suffixes by their
first 13 words. Suffixes whose first words begin no item suffix are left out of the sort: no search can end at them.
Every item suffix is then binary-searched in the array: its neighbours there give the longest verbatim match of up to 13
words, and the run of suffixes that begin with all words of a window gives the window's locations; locations of an item's
consecutive windows that follow each other in a document join to longer matches, of any length. The set of items is sent
to every task in blocks of ITEM_WORDS words (an item is never cut). More blocks mean more passes over the documents; the
result of a pass is written before the next one, so driver and tasks hold one block, whatever the size of the benchmark.

Defined results: null and empty texts have no words and are not contaminated; an item without words has no window and
hits nothing; equal items all count; rows that repeat an id are judged one by one; an empty benchmark leaves all
documents clean; an empty table gives an empty table. `annotated` keeps all columns of the documents but those named
like its own (bm_...); `clean` keeps all.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from netkpi.llm.arrays import LETTERS_DIGITS, LOWER, Rolling, text_slices, word_spans
from netkpi.llm.shared import discard
from netkpi.sources.tables import materialize

WINDOW = 13
#: Words of items that are sent to the tasks at once (about 60 MB: 13 hashes a word).
ITEM_WORDS = 500_000
#: The words of an item that is not yet lower-cased.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

FOUND = [
    ("bm_words", LongType()), ("bm_hit", LongType()), ("bm_n_items", LongType()), ("bm_items", ArrayType(StringType())),
    ("bm_longest", LongType()), ("bm_spans", ArrayType(LongType())), ("bm_contaminated", BooleanType()),
]


def item_blocks(benchmark: DataFrame, most: int = ITEM_WORDS) -> Iterator[tuple[list[str], list[str]]]:
    """Ids (as text) and texts of the items with words, in blocks; a block ends with the item that fills it."""
    n_words = F.size(F.regexp_extract_all("text", F.lit(ITEM_WORD), F.lit(0)))
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text", n_words.alias("n")).filter("n > 0")
    ids, texts, n = [], [], 0
    for r in rows.toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        n += r[2]
        if n >= most:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def word_hashes(rolling: Rolling, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the word offsets of each text."""
    data = LOWER[data]
    s, e, at = word_spans(data, offs, LETTERS_DIGITS)
    return rolling.words(data, s, e), at


class Items:
    """Suffixes of the items, cut to a window, and how many of their words make a whole window."""

    def __init__(self, ids: list[str], texts: list[str], window: int) -> None:
        rolling = Rolling()
        held = pa.array(texts, pa.large_string())
        rows, need, owner, place = [], [], [], []
        for i, j, data, offs in text_slices(held):
            words, at = word_hashes(rolling, data, offs)
            for k in range(j - i):
                w = words[at[k]:at[k + 1]]
                for p in range(len(w)):
                    suffix = w[p:p + window]
                    rows.append(np.concatenate([suffix, np.zeros(window - len(suffix), np.uint64)]))
                    # a whole window, a whole short item, or else a suffix that only measures the longest match
                    need.append(window if len(suffix) == window else len(w) if p == 0 else 0)
                    owner.append(i + k)
                    place.append(p)
        self.ids, self.window = ids, window
        self.rows = np.array(rows, np.uint64).reshape(-1, window)
        self.need, self.owner, self.place = (np.array(x, np.int64) for x in (need, owner, place))
        lengths = (self.rows != 0).sum(axis=1)
        # what a document suffix must begin with to be met: three words, or all of a shorter item
        self.starts = {k: np.unique(Rolling().fixed_rows(self.rows[lengths >= k][:, :k])) if k == 3
                       else np.unique(Rolling().fixed_rows(self.rows[(lengths == k) & (self.need == k)][:, :k])) for k in (1, 2, 3)}


def suffix_array(words: np.ndarray, at: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions `at`, sorted by their suffixes' first words, and these words; after a text's end come zeros."""
    index = at[:, None] + np.arange(window)
    rows = np.where(index < ends[:, None], words[np.minimum(index, len(words) - 1)], np.uint64(0))
    order = np.lexsort(rows.T[::-1])
    return at[order], rows[order]


def _less(rows: np.ndarray, at: np.ndarray, keys: np.ndarray, upto: np.ndarray, or_equal: bool) -> np.ndarray:
    """Is row `at` below its key, seen over the first `upto` words."""
    seen = np.arange(rows.shape[1]) < upto[:, None]
    differs = (rows[at] != keys) & seen
    first = differs.argmax(axis=1)
    pick = np.arange(len(at))
    return np.where(differs[pick, first], rows[at][pick, first] < keys[pick, first], or_equal)


def search(rows: np.ndarray, keys: np.ndarray, upto: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all keys at once in sorted rows."""
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(rows))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        less = _less(rows, np.minimum(mid, len(rows) - 1), keys, upto, right)
        low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
    return low


def joined_runs(doc: np.ndarray, item: np.ndarray, place: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows found: consecutive windows of an item at consecutive places of a document. Document and windows of each."""
    shift = start - place
    order = np.lexsort((place, shift, item, doc))
    doc, item, place, shift = doc[order], item[order], place[order], shift[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    return doc[first], np.diff(np.append(first, len(doc)))


def matches(items: Items, words: np.ndarray, at: np.ndarray, rolling: Rolling):
    """Per shard: (document, item, first word, words) of all windows found, and the longest match per document."""
    n, docs = len(words), np.repeat(np.arange(len(at) - 1), np.diff(at))
    ends = at[1:][docs]
    sums = rolling.sums(words)
    meets = np.zeros(n, bool)
    for k, starts in items.starts.items():
        if len(starts) and n >= k:
            h = rolling.fixed(sums, k)
            slot = np.minimum(np.searchsorted(starts, h), len(starts) - 1)
            meets[:len(h)] |= (starts[slot] == h) & (np.arange(len(h)) + k <= ends[:len(h)])
    pos = np.flatnonzero(meets)
    longest = np.zeros(len(at) - 1, np.int64)
    if not len(pos) or not len(items.rows):
        return (np.zeros(0, np.int64),) * 4, longest
    pos, rows = suffix_array(words, pos, ends[pos], items.window)
    full = np.full(len(items.rows), items.window)
    place = search(rows, items.rows, full, False)
    for step in (-1, 0):  # the two neighbours have the longest common prefix
        near = np.clip(place + step, 0, len(rows) - 1)
        same = ((rows[near] == items.rows) & (items.rows != 0)).cumprod(axis=1).sum(axis=1)
        np.maximum.at(longest, docs[pos[near]], same)
    ask = np.flatnonzero(items.need > 0)
    low = search(rows, items.rows[ask], items.need[ask], False)
    high = search(rows, items.rows[ask], items.need[ask], True)
    count = high - low
    which = np.repeat(ask, count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = pos[np.repeat(low, count) + inside]
    whole = items.need[which] == items.window
    doc, windows = joined_runs(docs[start[whole]], items.owner[which[whole]], items.place[which[whole]], start[whole])
    np.maximum.at(longest, doc, windows + items.window - 1)
    return (docs[start], items.owner[which], start - at[docs[start]], items.need[which]), longest


def annotated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = 20.0) -> DataFrame:
    """All columns of docs, and: bm_words, bm_hit, bm_n_items, bm_items (sorted as text), bm_longest (words of the longest
    verbatim match; one or two words count only if they are a whole item), bm_spans (first word and length of each window
    found, in turn), bm_contaminated."""
    blocks = item_blocks(benchmark)
    out, held, written = docs, next(blocks, ([], [])), None
    while True:
        after = next(blocks, None)
        out = _pass(out, Items(*held, window), share, written is not None)
        if after is None:
            return out
        out, before = materialize(out, "benchmark-pass"), written
        if before is not None:
            discard(before)
        written, held = out, after


def _pass(docs: DataFrame, items: Items, share: float, again: bool) -> DataFrame:
    """again: docs holds the result for other items, which is added to."""
    names = [n for n, _ in FOUND]
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = StructType([*kept, *(StructField(n, t) for n, t in FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            col = {n: [] for n in names}
            for i, j, data, offs in text_slices(batch.column("text")):
                words, at = word_hashes(rolling, data, offs)
                (doc, item, start, length), longest = matches(items, words, at, rolling)
                order = np.lexsort((start, doc))
                doc, item, start, length = doc[order], item[order], start[order], length[order]
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                for k in range(j - i):
                    b = slice(bounds[k], bounds[k + 1])
                    found = {items.ids[x] for x in np.unique(item[b]).tolist()}
                    pairs = {(s, n) for s, n in zip(start[b].tolist(), length[b].tolist(), strict=True)}
                    most = int(longest[k])
                    if again:
                        old = {n: batch.column(n)[i + k].as_py() for n in ("bm_items", "bm_spans", "bm_longest")}
                        found |= set(old["bm_items"])
                        pairs |= set(zip(old["bm_spans"][::2], old["bm_spans"][1::2], strict=True))
                        most = max(most, old["bm_longest"])
                    spans = sorted(pairs)
                    hit, to = 0, 0
                    for s, n in spans:
                        hit += max(0, s + n - max(s, to))
                        to = max(to, s + n)
                    total = int(at[k + 1] - at[k])
                    row = (total, hit, len(found), sorted(found), most, [x for p in spans for x in p],
                           hit > 0 and share * hit >= total)
                    for n, v in zip(names, row, strict=True):
                        col[n].append(v)
            types = [pa.int64()] * 3 + [pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *(pa.array(col[n], t) for n, t in zip(names, types, strict=True))],
                [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with their own columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*["text" if c == "text" else n for c, n in zip(docs.columns, names, strict=True)])
    return annotated(rows, benchmark).filter("not bm_contaminated").select(*rows.columns).toDF(*docs.columns)
