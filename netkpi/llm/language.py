"""Language identification with interpolated Kneser-Ney character models.

Letters are lower-cased, anything else is a boundary, and runs of it are one. Each language's model holds the counts of
its character 4-grams over all training documents, and from them interpolated Kneser-Ney probabilities of four orders
(lower orders by the number of different continuations). A 4-gram is packed into 64 bits without loss; tables are sorted
arrays of these numbers and are binary-searched. A text gets the language of the lowest cross-entropy per character; the
score is the softmax of the cross-entropies with a sharpness fitted on a sample of training documents, drawn per language,
and `rejected` marks texts whose best cross-entropy is beyond what 99.5 % of that language's training documents have: all of
them, by a quantile whose rank is off by at most one in BOUND_ACCURACY of the language's documents.

Counts come from every training document, are summed where they are read and then by Spark, and none is left out. They
stay in the shared folder. A part of a model are the 4-grams of one language in a range of their two middle letters (third
letter first): orders 4 and 3 are whole in it, order 2 is whole for its third letters, order 1 (at most 65,536 letters a
language) and the discounts are those of the whole language. Parts are packed into blocks of about BLOCK_GRAMS counts, and
texts are scored one block after the other; their sums are written per block and added up. So memory holds one block,
whatever the number of counts, and one block is the whole model as long as it fits.

Defined results: null texts and texts without a letter are `und` with score 0; without training text all are `und`; null
languages teach nothing; rows that repeat an id are judged one by one; letters beyond the 16-bit plane share 16-bit
slots; an empty table gives an empty table. `identified` keeps all columns but the text.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from netkpi.llm.arrays import text_slices
from netkpi.llm.shared import spread
from netkpi.sources.tables import materialize

ORDER = 4
#: Counts that the driver and a worker hold at once; more of them are read in blocks.
BLOCK_GRAMS = 2_000_000
#: Bytes of text that a task scores at once when there is more than one block.
SLICE_BYTES = 16 << 20
#: About so many training documents fit the sharpness, in equal shares per language, but at least LEAST_ROWS of each.
CALIBRATION_ROWS, LEAST_ROWS = 2_000, 20
BOUND_ACCURACY = 10_000
U = np.uint64


def letter_table() -> np.ndarray:
    """For each 16-bit code point its lower-case letter, or 0."""
    points = [c if 0xD800 <= c < 0xE000 else ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(1 << 16)]
    points[0xD800:0xE000] = [0] * 0x800
    return np.array([p if p < 1 << 16 else 0 for p in points], np.uint16)


def grams(letters: np.ndarray, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All 4-grams of all texts (each begins after three boundaries), the document of each, and who has a letter."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    points = np.frombuffer("\n\n\n".join(["", *texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [3 + len(t) for t in texts])
    first = np.concatenate(([0], np.cumsum([3 + len(t) for t in texts])))[:-1]
    c = letters[np.minimum(points, 0xFFFF)].astype(U)
    for i in np.flatnonzero(points > 0xFFFF):
        c[i] = 1 + int(points[i]) % 65521 if chr(int(points[i])).isalpha() else 0
    lead = np.zeros(len(c), bool)
    lead[(first[:, None] + np.arange(3)).ravel()] = True
    keep = lead | (c != 0)
    keep[1:] |= c[:-1] != 0
    c, doc, lead = c[keep], doc[keep], lead[keep]
    if len(c) < ORDER:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(len(texts), bool)
    code = (c[:-3] << U(48)) | (c[1:-2] << U(32)) | (c[2:-1] << U(16)) | c[3:]
    real = ~lead[3:]
    has = np.bincount(doc[c != 0], minlength=len(texts)) > 0
    return code[real], doc[3:][real], has


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of docs (text, lang)."""
    letters = letter_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
            codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

        for b in batches:
            names, which = np.unique(np.array(b.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
            for i, j, data, offs in text_slices(b.column("text")):
                code, doc, _ = grams(letters, data, offs)
                of = which[i:j][doc]
                for k in np.unique(of).tolist():
                    parts = held.setdefault(str(names[k]), [])
                    parts.append(np.unique(code[of == k], return_counts=True))
                    if len(parts) > 16:
                        held[str(names[k])] = [summed(parts)]
        for name, parts in held.items():
            codes, n = summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    rows = docs.select("text", F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discount(ones: int, twos: int) -> float:
    return float(ones / (ones + 2 * twos)) if ones and twos else 0.5


class KneserNey:
    """One language: sorted arrays of seen grams and contexts of orders 1 to 4.

    Of a part of a language, `low` holds codes and counts of orders 1 and 2, and `discounts` those of orders 1 to 4.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, low: dict | None = None, discounts: dict | None = None) -> None:
        self.tables = {}
        order = np.argsort(code)
        code, n = code[order], n[order].astype(np.float64)
        raw = {}
        for m in range(ORDER, 0, -1):
            if low and m in low:
                order = np.argsort(low[m][0])
                code, n = low[m][0][order], low[m][1][order].astype(np.float64)
            raw[m] = (code, n)
            if m > 1:  # below the highest order a gram counts by the different grams that end in it
                code, n = np.unique(code & U((1 << 16 * (m - 1)) - 1), return_counts=True)
                n = n.astype(np.float64)
        for m in range(1, ORDER + 1):
            code, n = raw[m]
            d = discounts[m] if discounts else discount((n == 1).sum(), (n == 2).sum())
            context, at = np.unique(code >> U(16), return_inverse=True)
            total = np.bincount(at, n, len(context))
            rest = d * np.bincount(at, minlength=len(context)) / total
            lower = self._of(code, m - 1) if m > 1 else np.full(len(code), 1 / (len(code) + 1))
            self.tables[m] = (code, np.maximum(n - d, 0) / total[at] + rest[at] * lower, context, rest)

    def _of(self, code: np.ndarray, upto: int) -> np.ndarray:
        p = np.full(len(code), 1 / (len(self.tables[1][0]) + 1))
        for m in range(1, upto + 1):
            seen, prob, context, rest = self.tables[m]
            if not len(seen):  # a part without grams of this order
                continue
            key = code & U((1 << 16 * m) - 1) if m < ORDER else code
            at = np.minimum(np.searchsorted(seen, key), len(seen) - 1)
            to = np.minimum(np.searchsorted(context, key >> U(16)), len(context) - 1)
            weight = np.where(context[to] == key >> U(16), rest[to], 1.0)
            p = np.where(seen[at] == key, prob[at], weight * p)
        return p

    def cost(self, code: np.ndarray) -> np.ndarray:
        """-log of the probability of each 4-gram's last character after the three before it."""
        return -np.log(self._of(code, ORDER))


def middle(code: np.ndarray) -> np.ndarray:
    """The third letter of each 4-gram, then the second, as one number below 2^32."""
    return (((code >> U(16)) & U(0xFFFF)) << U(16)) | ((code >> U(32)) & U(0xFFFF))


def middle_column() -> Column:
    """`middle` of the column `gram`."""
    letter = lambda shift: F.shiftrightunsigned("gram", shift).bitwiseAND(0xFFFF)
    return F.shiftleft(letter(16), 16) + letter(32)


class Languages:
    """Names, discounts and first order of all languages, and blocks of parts (language, from, below) of the written counts."""

    def __init__(self, counts: DataFrame, most: int = BLOCK_GRAMS) -> None:
        """counts: written, with lang, gram and n."""
        self.counts = counts.withColumn("mid", middle_column())
        below = lambda t, mask: t.groupBy("lang", F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        third = below(counts, (1 << 48) - 1)
        self.second = materialize(below(third, (1 << 32) - 1), "language-pairs")
        first = below(self.second, 0xFFFF)
        rows = {m: {r.lang: r for r in t.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.count_if(F.col("n") == 1).alias("ones"),
                                                            F.count_if(F.col("n") == 2).alias("twos")).collect()}
                for m, t in ((1, first), (2, self.second), (3, third), (4, counts))}
        self.names = sorted(rows[4])
        self.discounts = [{m: discount(rows[m][k].ones, rows[m][k].twos) for m in rows} for k in self.names]
        self.first = self._arrays(first)
        self.sharpness, self.bounds = 1.0, np.full(len(self.names), np.inf)
        self.blocks = self._blocks([rows[4][k].size for k in self.names], most)

    def _arrays(self, table: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Codes and counts per language."""
        held = table.select("lang", "gram", "n").toArrow()
        lang = held.column("lang").combine_chunks().dictionary_encode()
        if isinstance(lang, pa.ChunkedArray):
            lang = lang.combine_chunks()
        known, of = lang.dictionary.to_pylist(), lang.indices.to_numpy()
        code, n = held.column("gram").to_numpy().view(U), held.column("n").to_numpy()
        return {self.names.index(k): (code[of == i], n[of == i]) for i, k in enumerate(known)}

    def _blocks(self, sizes: list[int], most: int) -> list[list[tuple[int, int, int]]]:
        """Every middle of every language is in one part; cuts are approximate quantiles, so sizes are, too."""
        part = most if sum(sizes) <= most else max(1, most // 4)
        cuts: dict[str, list[int]] = {k: [] for k in self.names}
        for many in sorted({-(-n // part) for n in sizes} - {0, 1}):
            of = [k for k, n in zip(self.names, sizes, strict=True) if -(-n // part) == many]
            at = F.percentile_approx("mid", [i / many for i in range(1, many)], 20 * many)
            cuts |= {r[0]: sorted(set(r[1])) for r in self.counts.filter(F.col("lang").isin(of)).groupBy("lang").agg(at).collect()}
        blocks, held = [], most
        for x, (k, n) in enumerate(zip(self.names, sizes, strict=True)):
            edges = [0, *(c for c in cuts[k] if c > 0), 1 << 32]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                size = n / (len(edges) - 1)
                if not blocks or held + size > most:
                    blocks.append([])
                    held = 0
                blocks[-1].append((x, lo, hi))
                held += size
        return blocks

    def parts(self, block: list[tuple[int, int, int]]) -> list[tuple[int, int, int, KneserNey]]:
        """The models of one block, read from the written counts."""
        inside, pairs = F.lit(False), F.lit(False)
        for x, lo, hi in block:
            own = F.col("lang") == self.names[x]
            inside |= own & (F.col("mid") >= lo) & (F.col("mid") < hi)
            pairs |= own & (F.col("gram") >= lo >> 16 << 16) & (F.col("gram") < ((hi - 1 >> 16) + 1) << 16)
        none = (np.zeros(0, U), np.zeros(0, np.int64))
        four, two, out = self._arrays(self.counts.filter(inside)), self._arrays(self.second.filter(pairs)), []
        for x, lo, hi in block:
            code, n = four.get(x, none)
            pair, pair_n = two.get(x, none)
            mid, third = middle(code), pair >> U(16)
            here, near = (mid >= U(lo)) & (mid < U(hi)), (third >= U(lo >> 16)) & (third <= U(hi - 1 >> 16))
            low = {1: self.first[x], 2: (pair[near], pair_n[near])}
            out.append((x, lo, hi, KneserNey(code[here], n[here], low, self.discounts[x])))
        return out


def block_sums(docs: DataFrame, parts: list[tuple[int, int, int, KneserNey]], k: int) -> DataFrame:
    """All columns of docs but the text, and `costs`: per language the mean over the text's 4-grams of the costs that the
    parts know (0 for 4-grams of other parts); null without a letter."""
    letters = letter_table()
    kept = [f for f in docs.schema.fields if f.name not in ("text", "costs")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, costs = np.zeros(0, U), np.zeros((0, k))

        def looked_up(code: np.ndarray) -> np.ndarray:
            of, mid = np.zeros((len(code), k)), middle(code)
            for x, lo, hi, model in parts:
                here = (mid >= U(lo)) & (mid < U(hi))
                of[here, x] = model.cost(code[here])
            return of

        for b in batches:
            out = []
            for i, j, data, offs in text_slices(b.column("text"), 1 << 20):
                code, doc, has = grams(letters, data, offs)
                distinct, at = np.unique(code, return_inverse=True)
                if k and len(distinct):
                    # each 4-gram is looked up in the models once per task
                    new = np.setdiff1d(distinct, known, assume_unique=True)
                    if len(new):
                        every = np.concatenate([known, new])
                        order = np.argsort(every)
                        costs = np.concatenate([costs, looked_up(new)])[order]
                        known = every[order]
                    of = costs[np.searchsorted(known, distinct)]
                    n = np.bincount(doc, minlength=j - i)
                    mean = np.column_stack([np.bincount(doc, of[:, x][at], j - i) / np.maximum(1, n) for x in range(k)])
                else:
                    mean = np.zeros((j - i, k))
                out += [m.tolist() if ok and k else None for m, ok in zip(mean, has, strict=True)]
                if len(known) > 1_000_000:
                    known, costs = np.zeros(0, U), np.zeros((0, k))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), pa.array(out, pa.list_(pa.float64()))],
                                             [*(f.name for f in kept), "costs"])

    schema = StructType([*kept, *docs.sparkSession.createDataFrame([], "costs array<double>").schema.fields])
    return docs.mapInArrow(run, schema)


def asked_grams(texts: DataFrame) -> DataFrame:
    """slice and gram: the different 4-grams of each slice of texts (slice, text)."""
    letters = letter_table()

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = [np.zeros(0, U)]
        for b in rows.to_batches():
            for _, _, data, offs in text_slices(b.column("text"), 1 << 20):
                found.append(np.unique(grams(letters, data, offs)[0]))
        code = np.unique(np.concatenate(found)).view(np.int64)
        return pa.table({"slice": pa.array(np.full(len(code), key[0].as_py(), np.int64)), "gram": pa.array(code)})

    return texts.filter("text is not null").select("slice", "text").groupBy("slice").applyInArrow(run, "slice long, gram long")


def block_costs(asked: DataFrame, parts: list[tuple[int, int, int, KneserNey]]) -> DataFrame:
    """gram, language number and cost for the 4-grams (gram, mid) that belong to the parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = b.column("gram").to_numpy().view(U)
            mid = middle(code)
            for x, lo, hi, model in parts:
                own = code[(mid >= U(lo)) & (mid < U(hi))]
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(np.full(len(own), x, np.int32)), pa.array(model.cost(own))],
                                                 ["gram", "lang", "cost"])

    inside = F.lit(False)
    for _, lo, hi, _ in parts:
        inside |= (F.col("mid") >= lo) & (F.col("mid") < hi)
    return asked.filter(inside).select("gram").mapInArrow(run, "gram long, lang int, cost double")


def gram_costs(asked: DataFrame, model: Languages) -> DataFrame:
    """gram and costs (one per language) of the different 4-grams in `asked`, with one block in memory at a time.

    The 4-grams are written in the order of their middles, so that the pass of a block reads its own share of them.
    """
    distinct = asked.select("gram").distinct().withColumn("mid", middle_column())
    distinct = materialize(distinct.repartitionByRange("mid").sortWithinPartitions("mid"), "language-asked")
    passes = [materialize(block_costs(distinct, model.parts(block)), "language-gram-costs") for block in model.blocks]
    listed = F.array_sort(F.collect_list(F.struct("lang", "cost")))
    return reduce(DataFrame.unionAll, passes).groupBy("gram").agg(F.transform(listed, lambda c: c["cost"]).alias("costs"))


def cross_entropies(docs: DataFrame, model: Languages) -> DataFrame:
    """All columns of docs but the text, and `costs`: cross-entropy per character and language; null without a letter.

    Beyond one block the texts are read twice, however many blocks there are: they are dealt into slices of about
    SLICE_BYTES, the slices ask for their different 4-grams, each different one is priced once, and the slices get the
    prices back.
    """
    k = len(model.names)
    if len(model.blocks) < 2:
        return block_sums(docs, model.parts(model.blocks[0]) if model.blocks else [], k)
    kept, letters = [c for c in docs.columns if c not in ("text", "costs")], letter_table()
    slices = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE_BYTES
    # rows are dealt by number, so that copies of a text do not meet in one slice, and written, so that a lost task deals alike
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slices))
    held = F.struct(F.lit(0).alias("none"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)])
    texts = materialize(docs.select(number.alias("slice"), held.alias("kept"), "text"), "language-slices")
    asked = materialize(asked_grams(texts), "language-slice-grams")
    priced = asked.join(gram_costs(asked, model), "gram")
    schema = StructType([texts.schema["kept"], StructField("costs", ArrayType(DoubleType()))])

    def run(key: tuple, rows: pa.Table, prices: pa.Table) -> pa.Table:
        known = prices.column("gram").to_numpy().view(U)
        order = np.argsort(known)
        costs = np.concatenate([np.zeros(0), *(c.flatten().to_numpy() for c in prices.column("costs").chunks)]).reshape(-1, k)[order]
        known, out = known[order], []
        for b in rows.to_batches():
            for i, j, data, offs in text_slices(b.column("text"), 1 << 20):
                code, doc, has = grams(letters, data, offs)
                at, n = np.searchsorted(known, code), np.maximum(1, np.bincount(doc, minlength=j - i))
                mean = np.column_stack([np.bincount(doc, costs[at, x], j - i) / n for x in range(k)])
                out += [m.tolist() if ok else None for m, ok in zip(mean, has, strict=True)]
        return pa.table({"kept": rows.column("kept"), "costs": pa.array(out, pa.list_(pa.float64()))})

    out = texts.groupBy("slice").cogroup(priced.groupBy("slice")).applyInArrow(run, schema)
    return out.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], "costs")


def probabilities(costs: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-sharpness * (costs - costs.min(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, most: int = BLOCK_GRAMS) -> Languages:
    """docs: the training rows, with doc_id, text and lang. All of them are counted; `most` counts are in memory at once."""
    docs = docs.filter("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    model = Languages(materialize(gram_counts(docs), "language-counts"), most)
    if not model.names:
        return model
    sizes = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}
    each = max(LEAST_ROWS, CALIBRATION_ROWS // len(sizes))
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, each / n) * (1 << 52)))])
    drawn = spread(F.lit("calibrate"), F.col("doc_id"), F.col("text")) < shares[F.col("lang")]
    rows = cross_entropies(docs.select("text", "lang", drawn.alias("drawn")), model).filter("costs is not null")
    own = F.get("costs", F.array_position(F.array(*[F.lit(k) for k in model.names]), F.col("lang")).cast("int") - 1)
    held = materialize(rows.select("lang", own.alias("own"), F.when(F.col("drawn"), F.col("costs")).alias("costs")), "language-costs")
    bounds = {r[0]: r[1] for r in held.groupBy("lang").agg(F.percentile_approx("own", 0.995, BOUND_ACCURACY)).collect()}
    model.bounds = np.array([bounds.get(k, np.inf) for k in model.names])
    some = held.filter("costs is not null").select("lang", "costs").toArrow()
    if some.num_rows:
        costs = np.array(some.column("costs").to_pylist())
        right = np.array([model.names.index(x) for x in some.column("lang").to_pylist()])
        loss = lambda s: -np.log(np.maximum(1e-12, probabilities(costs, s)[np.arange(len(right)), right])).mean()
        model.sharpness = min((1.0, 2.0, 5.0, 10.0, 20.0, 50.0), key=loss)
    return model


def identified(docs: DataFrame, model: Languages) -> DataFrame:
    """All columns of docs but the text, and lang_pred, lang_score, lang_rejected."""
    names, sharpness, bounds = model.names, model.sharpness, model.bounds
    rows = cross_entropies(docs, model)
    own = ("costs", "lang_pred", "lang_score", "lang_rejected")
    kept = [f for f in rows.schema.fields if f.name not in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column("costs").to_pylist()
            pred, score, rejected = ["und"] * len(held), np.zeros(len(held)), np.zeros(len(held), bool)
            some = [i for i, c in enumerate(held) if c is not None]
            if some:
                costs = np.array([held[i] for i in some])
                best = costs.argmin(axis=1)
                p = probabilities(costs, sharpness)
                for x, i in enumerate(some):
                    pred[i], score[i], rejected[i] = names[best[x]], p[x, best[x]], costs[x, best[x]] > bounds[best[x]]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in kept), pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)],
                [*(f.name for f in kept), *own[1:]])

    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType()), StructField("lang_rejected", BooleanType())])
    return rows.mapInArrow(run, schema)
