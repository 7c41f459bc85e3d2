"""Hard-negative mining over an inverted multi-index.

Two codebooks, one for each half of the vectors, form cells. All rows are put into their cells, and each code knows the
greatest distance of its rows (radius). For a query q, half a code c can add at most q.c + |q| * radius to a score, so the sum
of two such bounds holds for every row of a cell. A heap visits cells by falling bounds (multi-sequence order). A search is
over for a query when the next cell's bound is below what all its windows still need; cells that lie wholly above a window are
not read. So results are exact, whatever the codebooks are.

Cells are packed on shelves of a bounded number of rows, a large cell on several; queries are packed in groups. In a round each
group names the shelves that its heaps reach, one row for each with a bit per query and cell; shelf and groups are brought together,
and block products score them. Rounds grow by a factor, so that few are needed; a later round only sends what beats the best so far.
The heap names the first cells of a search; where it goes further, one sort of all bounds gives the rest of the same order.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; shorter vectors count as
filled up with zeros; components are floor(256 * x), and scores are right while they stay below 2^53; rows with the query's id are
the query itself and neither positive nor negative; rows that repeat an id count one by one, queries that repeat one, too; null
ids are no queries and come last among equal scores; ties go to the smaller id; an empty table gives no rows. Only id, vector and
label are read, so extra columns may have any name.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from netkpi.llm.shared import discard
from netkpi.sources.tables import materialize

#: Codebooks are fitted on at most so many rows (the same ones in any run), with at most so many codes; all rows are indexed.
SAMPLE_ROWS, MOST_CODES = 20_000, 512
#: Components on a shelf and rows of a shelf at most, queries of a group about.
SHELF_VALUES, SHELF_ROWS, GROUP = 1 << 21, 32768, 256
#: Cells that a query visits in the first round; each later round has GROWTH times as many.
FIRST_CELLS, GROWTH = 16, 64
#: Of all cells, one in so many comes from the heap; beyond them, sorting the bounds takes less time.
HEAPED = 32
#: Groups that meet a shelf at once; queries that are multiplied with it at once.
MET, MULTIPLIED = 256, 32
#: Lists of one group that are merged at once.
MERGED = 64

LOW, HIGH = -(1 << 62), 1 << 62


def quantised(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label (long), q (list of floor(256 * x)) of the rows that take part, each with a number of its own. Written."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    q = F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("long"))
    used = rows.filter(F.col(label).isNotNull() & x.isNotNull() & finite)
    return materialize(used.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), q.alias("q"),
                                   F.monotonically_increasing_id().alias("uid")), "multi-rows")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's means, from rows drawn with a fixed seed."""
    draw = np.random.default_rng(7)
    means = x[draw.choice(len(x), codes, replace=len(x) < codes)].astype(float)
    for _ in range(rounds):
        near = nearest(x, means)[0]
        count = np.bincount(near, minlength=codes)
        sums = np.zeros_like(means)
        np.add.at(sums, near, x)
        means = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], x[draw.choice(len(x), codes)])
    return means


def nearest(x: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest code of each row, and its distance."""
    far = (means ** 2).sum(axis=1) - 2.0 * (x @ means.T)
    code = far.argmin(axis=1)
    return code, np.sqrt(((x - means[code]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Index:
    """books, radii: of both halves. counts: rows per cell; first, parts: its first shelf, and on how many it lies. kind: number type;
    sums: one that holds all sums of products."""
    shelves: DataFrame
    dims: int
    kind: str
    sums: str
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    first: np.ndarray
    parts: np.ndarray


def _packed(kind: str, dims: int, by: str):
    """A group of rows as one row: lists, and all vectors as bytes."""
    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("cell").to_numpy(), kind="stable") if "cell" in table.column_names else np.arange(len(table))
        table = table.take(pa.array(order))
        one = {by: pa.array([table.column(by)[0].as_py()], pa.int64())}
        for c in ("cell", "label", "uid"):
            if c in table.column_names:
                one[c] = pa.array([table.column(c).to_pylist()], pa.list_(pa.int64()))
        one["id"] = pa.array([table.column("id").fill_null(0).to_pylist()], pa.list_(pa.int64()))
        one["unnamed"] = pa.array([table.column("id").is_null().to_pylist()], pa.list_(pa.bool_()))
        one["vectors"] = pa.array([matrix(table.column("q"), dims).astype(kind).tobytes()], pa.binary())
        return pa.table(one)
    return pack


def index(rows: DataFrame, codes: int | None = None) -> Index:
    """Fit the codebooks and put every row of `quantised` on a shelf."""
    n, dims, top, low = rows.agg(F.count(F.lit(1)), F.max(F.size("q")), F.max(F.array_max("q")), F.min(F.array_min("q"))).first()
    dims = dims or 1
    most = max(abs(top or 0), abs(low or 0))
    kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64"
    codes = codes or int(2 ** min(np.log2(MOST_CODES), max(1, round(np.log2(max(1, n) ** 0.5 / 8)))))
    half = (dims + 1) // 2
    sample = rows.select("q", "uid").orderBy(F.xxhash64("q"), "uid").limit(SAMPLE_ROWS).select("q").toArrow()
    x = matrix(sample.column("q"), dims) if len(sample) else np.zeros((1, dims), np.int64)
    books = tuple(codebook(x[:, s], codes) for s in (slice(0, half), slice(half, dims)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("q"), dims)
            (c1, d1), (c2, d2) = nearest(v[:, :half], books[0]), nearest(v[:, half:], books[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(c1 * codes + c2, pa.int64()), pa.array(d1), pa.array(d2)], [*batch.schema.names, "cell", "d1", "d2"])

    schema = StructType([*rows.schema.fields, *StructType.fromDDL("cell long, d1 double, d2 double").fields])
    put = materialize(rows.mapInArrow(assign, schema), "multi-cells")
    # at most codes * codes rows, the bound of the codebooks
    found = put.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).toArrow()
    cell = found.column("cell").to_numpy()
    counts, radii = np.zeros(codes * codes, np.int64), (np.zeros(codes), np.zeros(codes))
    counts[cell] = found.column("n").to_numpy()
    np.maximum.at(radii[0], cell // codes, found.column("d1").to_numpy())
    np.maximum.at(radii[1], cell % codes, found.column("d2").to_numpy())
    held = max(64, min(SHELF_ROWS, SHELF_VALUES // dims, n // 64))
    parts = np.maximum(1, -(-counts // held))
    first, at, room = np.zeros(codes * codes, np.int64), -1, 0
    for c in np.flatnonzero(counts):
        if parts[c] > 1 or counts[c] > room:
            at, room = at + 1, held
        first[c] = at
        room -= counts[c]
        if parts[c] > 1:
            at, room = at + int(parts[c]) - 1, 0
    places = rows.sparkSession.createDataFrame(
        [(int(c), int(first[c]), int(parts[c])) for c in np.flatnonzero(counts)], "cell long, first long, parts long")
    shelf = (F.col("first") + F.pmod(F.xxhash64("uid"), F.col("parts"))).alias("shelf")
    shelves = (put.join(F.broadcast(places), "cell").select(shelf, "cell", "id", "label", "q")
               .groupBy("shelf").applyInArrow(_packed(kind, dims, "shelf"), "shelf long, cell array<long>, label array<long>, "
                                              "id array<long>, unnamed array<boolean>, vectors binary"))
    return Index(materialize(shelves, "multi-shelves"), dims, kind, "float32" if dims * most ** 2 < 1 << 24 else "float64", books, radii, counts, first, parts)


def _row(rows: pa.RecordBatch | pa.Table, at: int) -> dict:
    """One row, its lists (without nulls) as arrays."""
    one = {n: rows.column(n)[at] for n in rows.schema.names}
    return {n: v.values.to_numpy(zero_copy_only=False) if v.is_valid and pa.types.is_list(v.type) else v.as_py() for n, v in one.items()}


def _lists(row: dict, *names: str) -> list[np.ndarray]:
    return [np.array(row[n], np.int64) for n in names]


LONGS, FLAGS = ArrayType(LongType()), ArrayType(BooleanType())
#: A group of queries in a search. Request lists: who (query), low, high (window of scores); what is found: best (of which request), score,
#: found (id), unnamed (id is null). seen: cells that each query's heap has given.
STATE = StructType([StructField("grp", LongType()), *(StructField(n, LONGS) for n in ("uid", "id", "label")), StructField("vectors", BinaryType()),
                    *(StructField(n, LONGS) for n in ("who", "low", "high", "best", "score", "found")), StructField("unnamed", FLAGS),
                    StructField("seen", LONGS)])
STATE_NAMES = STATE.fieldNames()


#: What a group asks in a round: its own row, with what each request needs; a row for each shelf that it visits, with the cells
#: and a bit per query and cell.
TURN = StructType([*STATE.fields, StructField("need", LONGS), StructField("shelf", LongType()), StructField("cells", LONGS),
                   StructField("marks", BinaryType())])


def _arrow(schema: StructType) -> list[pa.Field]:
    kinds = {LongType(): pa.int64(), BinaryType(): pa.binary(), LONGS: pa.list_(pa.int64()), FLAGS: pa.list_(pa.bool_())}
    return [pa.field(f.name, kinds[f.dataType]) for f in schema.fields]


def _state_table(rows: list[dict], schema: StructType = STATE) -> pa.Table:
    """Rows of a schema; what a row does not name is null."""
    return pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in _arrow(schema)})


def cells_in_turn(bounds: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """Bound and codes of all cells by falling sums of half bounds: the multi-sequence walk over two sorted lists."""
    order = [np.argsort(-b, kind="stable") for b in bounds]
    one, two = (b[o].tolist() for b, o in zip(bounds, order, strict=True))
    first, second = order[0].tolist(), order[1].tolist()
    heap = [(-(one[0] + two[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, first[i], second[j]
        if j + 1 < len(two):
            heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))


def cells_at_once(bounds: tuple[np.ndarray, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first part of what `cells_in_turn` gives, all bounds of `least` and more: equal sums come by their places in both lists there, too."""
    order = [np.argsort(-b, kind="stable") for b in bounds]
    sums = np.add.outer(*(b[o] for b, o in zip(bounds, order, strict=True))).ravel()
    held = np.flatnonzero(sums >= least)
    held = held[np.argsort(-sums[held], kind="stable")]
    i, j = np.divmod(held, len(bounds[1]))
    return sums[held], order[0][i], order[1][j]


def _walk(bounds: tuple[np.ndarray, np.ndarray], least: float, seen: int, more: int, step: int = 64) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Place of the first, bounds and codes of cells in turn, many at once: from the `seen`-th or before, down to `least` or below.

    more: how many are asked for. A heap that can't have given them before its part ends is not begun.
    """
    few = len(bounds[0]) * len(bounds[1]) // HEAPED
    if seen + more <= few:
        heap = cells_in_turn(bounds)
        for at in range(0, few, step):
            some = list(islice(heap, min(step, few - at)))
            bound, i, j = np.array([c[0] for c in some]), np.array([c[1] for c in some]), np.array([c[2] for c in some])
            yield at, bound, i, j
            if bound[-1] < least:
                return
    at = few if seen + more <= few else 0
    yield at, *(x[at:] for x in cells_at_once(bounds, least))


def _needs(who: np.ndarray, low: np.ndarray, high: np.ndarray, best: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Per request the score that a row must reach at least: the k-th best so far, or the window's low end. Empty windows need nothing."""
    lowest = np.full(len(who), HIGH)
    np.minimum.at(lowest, best, score)
    need = np.where(np.bincount(best, minlength=len(who)) >= k, np.maximum(low, lowest), low)
    return np.where(low > high, HIGH, need)


def _advance(ix: Index, k: int, cells: int):
    """Each query's next cells by its heap, as TURN rows: none but the group's own when all windows are certified."""
    books, radii, counts, first, parts, kind, dims = ix.books, ix.radii, ix.counts, ix.first, ix.parts, ix.kind, ix.dims
    codes, half = len(books[0]), books[0].shape[1]
    filled = np.flatnonzero(counts)
    starts = np.flatnonzero(np.diff(first[filled], prepend=-1))  # cells lie in their order, so those of a shelf follow each other

    def visited(v: np.ndarray, mine: np.ndarray, need: np.ndarray, high: np.ndarray, seen: int) -> tuple[np.ndarray, int]:
        """The next cells of the query v with the requests `mine`, and how many cells its walk has given."""
        least, top, asked = need[mine].min(), high[mine], need[mine]
        halves = (slice(0, half), slice(half, dims))
        mids = [b @ v[s] for b, s in zip(books, halves, strict=True)]
        wide = [np.linalg.norm(v[s]) * r for r, s in zip(radii, halves, strict=True)]
        slack = 1.0 + 1e-9 * sum(np.abs(m).max() + w.max() for m, w in zip(mids, wide, strict=True))
        found, left, taken = [], cells, 0
        for at, bound, i, j in _walk((mids[0] + wide[0], mids[1] + wide[1]), least - slack, seen, cells):
            inside = int((bound >= least - slack).sum())
            new = slice(min(max(seen - at, 0), inside), inside)
            bound, i, j = bound[new], i[new], j[new]
            under = mids[0][i] - wide[0][i] + mids[1][j] - wide[1][j] - slack
            wanted = (counts[i * codes + j] > 0) & ((bound[:, None] >= asked - slack) & (under[:, None] <= top)).any(axis=1)
            hit = np.flatnonzero(wanted)[:left]
            found.append((i * codes + j)[hit])
            left -= len(hit)
            taken = at + (new.start + int(hit[-1]) + 1 if not left else inside)
            if not left:
                break
        return np.concatenate(found) if found else np.zeros(0, np.int64), max(seen, taken)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = _row(batch, at)
                v = np.frombuffer(row["vectors"], kind).reshape(-1, dims).astype(float)
                who, low, high, best, score, seen = _lists(row, "who", "low", "high", "best", "score", "seen")
                need = _needs(who, low, high, best, score, k)
                marks = np.zeros((len(v), len(filled)), bool)
                for a in np.unique(who[need < HIGH]).tolist():
                    found, seen[a] = visited(v[a], np.flatnonzero((who == a) & (need < HIGH)), need, high, seen[a])
                    marks[a, np.searchsorted(filled, found)] = True
                out = [row | {"seen": seen, "need": need}]
                for one, end in zip(starts, [*starts[1:], len(filled)], strict=True):
                    hit = one + np.flatnonzero(marks[:, one:end].any(axis=0))
                    if len(hit):
                        asked = {"grp": row["grp"], "cells": filled[hit], "marks": np.packbits(marks[:, hit]).tobytes()}
                        out += [asked | {"shelf": int(first[filled[one]]) + p} for p in range(parts[filled[one]])]
                yield from _state_table(out, TURN).to_batches()
    return run


def _top(request: np.ndarray, score: np.ndarray, found: np.ndarray, unnamed: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each request, by request, falling score, ids (null last)."""
    order = np.lexsort((found, unnamed, -score, request))
    ranked = request[order]
    return order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < k]


def _scored(kind: str, sums: str, dims: int, k: int, same: bool):
    """Per shelf and group: what the visited cells hold for each request, at most k rows each."""
    names = ["best", "score", "found", "unnamed"]

    def run(asked: pa.Table, shelf: pa.Table) -> pa.Table:
        out: list[dict] = []
        if len(shelf):
            side = _row(shelf, 0)
            x = np.frombuffer(side["s_vectors"], kind).reshape(-1, dims).astype(sums).T
            ids, label, cell = _lists(side, "s_id", "s_label", "cell")
            unnamed = np.asarray(side["s_unnamed"], bool)
            held, slot = np.unique(cell, return_inverse=True)
            room = np.empty((MULTIPLIED, len(ids)), sums)  # used again by each product
            for at in range(len(asked)):
                lists = scored(_row(asked, at), x, ids, label, unnamed, held, slot, room)
                if lists.shape[1]:
                    out.append({"grp": asked.column("grp")[at].as_py(), "shelf": side["shelf"]} | dict(zip(names, lists, strict=True)))
        return pa.table({n: pa.array([r[n] for r in out], pa.int64()) for n in ("grp", "shelf")}
                        | {n: pa.array([r[n].astype(bool) if n == "unnamed" else r[n] for r in out], pa.list_(pa.bool_() if n == "unnamed" else pa.int64()))
                           for n in names})

    def scored(row: dict, x: np.ndarray, ids: np.ndarray, label: np.ndarray, unnamed: np.ndarray, held: np.ndarray, slot: np.ndarray,
               room: np.ndarray) -> np.ndarray:
        v = np.frombuffer(row["vectors"], kind).reshape(-1, dims).astype(sums)
        who, high, need, own, own_label, cells = _lists(row, "who", "high", "need", "id", "label", "cells")
        marks = np.unpackbits(np.frombuffer(row["marks"], np.uint8), count=len(v) * len(cells)).reshape(len(v), -1).astype(bool)
        visit = np.zeros((len(v), len(held)), bool)
        inside = np.isin(cells, held)  # a cell on several shelves may have no row on one of them
        visit[:, np.searchsorted(held, cells[inside])] = marks[:, inside]
        asks: dict[int, list[int]] = {}
        for r in np.flatnonzero(need < HIGH).tolist():
            asks.setdefault(int(who[r]), []).append(r)
        mine = [q for q in asks if visit[q].any()]
        out = [np.zeros((4, 0), np.int64)]
        for begin in range(0, len(mine), MULTIPLIED):
            some = mine[begin:begin + MULTIPLIED]
            for q, product in zip(some, np.matmul(v[some], x, out=room[:len(some)]), strict=True):
                rows = np.flatnonzero(product >= float(need[asks[q]].min()))
                rows = rows[visit[q][slot[rows]] & ((label[rows] == own_label[q]) == same) & (unnamed[rows] | (ids[rows] != own[q]))]
                s = product[rows].astype(np.int64)
                for r in asks[q]:
                    ok = np.flatnonzero((s >= need[r]) & (s <= high[r]))
                    if len(ok) > k:
                        ok = ok[s[ok] >= np.partition(s[ok], -k)[-k]]
                        ok = ok[np.lexsort((ids[rows[ok]], unnamed[rows[ok]], -s[ok]))[:k]]
                    if len(ok):
                        out.append(np.stack([np.full(len(ok), r), s[ok], ids[rows[ok]], unnamed[rows[ok]].astype(np.int64)]))
        return np.concatenate(out, axis=1)
    return run


LISTS = "grp long, shelf long, best array<long>, score array<long>, found array<long>, unnamed array<boolean>"


def _joined(table: pa.Table, k: int) -> list[np.ndarray]:
    best, score, found = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("best", "score", "found"))
    unnamed = table.column("unnamed").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
    keep = _top(best, score, found, unnamed, k)
    return [x[keep] for x in (best, score, found, unnamed)]


def _merged_lists(k: int):
    def run(table: pa.Table) -> pa.Table:
        lists = _joined(table, k)
        return pa.table({"grp": table.column("grp")[:1], "shelf": table.column("shelf")[:1]}
                        | {n: pa.array([x], pa.list_(pa.bool_() if n == "unnamed" else pa.int64()))
                           for n, x in zip(("best", "score", "found", "unnamed"), lists, strict=True)})
    return run


def _merged(k: int):
    """The state of a group with what the round has found."""
    def run(state: pa.Table, more: pa.Table) -> pa.Table:
        names = ["best", "score", "found", "unnamed"]
        row = _row(state, 0)
        row |= dict(zip(names, _joined(pa.concat_tables([state.select(names), more.select(names)]), k), strict=True))
        return _state_table([row])
    return run


def search(ix: Index, state: DataFrame, k: int, same: bool) -> DataFrame:
    """STATE rows with the first k rows of each request, of the query's label or of others. Exact."""
    cells, groups, spark = FIRST_CELLS, max(1, state.count()), state.sparkSession
    # what a group holds is small beside its work, so tasks go by groups
    tasks, lots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups), -(-groups // MET)
    side = ix.shelves.select("shelf", "cell", F.col("label").alias("s_label"), F.col("id").alias("s_id"), F.col("unnamed").alias("s_unnamed"),
                             F.col("vectors").alias("s_vectors")).withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    lot = F.pmod(F.xxhash64("grp"), F.lit(lots)).cast("int").alias("lot")
    while True:
        turn = materialize(state.repartition(tasks, "grp").mapInArrow(_advance(ix, k, cells), TURN), "multi-visits")
        state, ask = turn.filter(F.col("shelf").isNull()), turn.filter(F.col("shelf").isNotNull()).select("grp", "shelf", "cells", "marks")
        most = ask.groupBy("grp").count().agg(F.max("count")).first()[0]
        if not most:
            return state.select(*STATE_NAMES)
        ask = ask.join(state.select("grp", "id", "label", "vectors", "who", "high", "need"), "grp").select("*", lot)
        lists = ask.groupBy("shelf", "lot").cogroup(side.groupBy("shelf", "lot")).applyInArrow(_scored(ix.kind, ix.sums, ix.dims, k, same), LISTS)
        while most > MERGED:  # so that a task never holds more lists of a group
            most = -(-most // MERGED)
            lists = (lists.withColumn("_part", F.pmod(F.xxhash64("shelf"), F.lit(most))).groupBy("grp", "_part")
                     .applyInArrow(_merged_lists(k), LISTS))
        state = materialize(state.select(*STATE_NAMES).groupBy("grp").cogroup(lists.groupBy("grp")).applyInArrow(_merged(k), STATE), "multi-state")
        discard(turn)
        cells *= GROWTH


def queries(ix: Index, rows: DataFrame, chosen: Column) -> DataFrame:
    """Groups of the chosen rows, each row asking for the best of all scores. Written."""
    own = rows.filter(chosen)
    groups = max(1, -(-own.count() // GROUP))
    packed = own.select(F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("grp"), "uid", "id", "label", "q").groupBy("grp").applyInArrow(
        _packed(ix.kind, ix.dims, "grp"), "grp long, label array<long>, uid array<long>, id array<long>, unnamed array<boolean>, vectors binary")
    none, size = F.expr("cast(array() as array<long>)"), F.size("id")
    each = F.transform("id", lambda _, i: i.cast("long"))
    return materialize(packed.select(
        "grp", "uid", "id", "label", "vectors", each.alias("who"), F.transform("id", lambda _: F.lit(LOW)).alias("low"),
        F.transform("id", lambda _: F.lit(HIGH - 1)).alias("high"), none.alias("best"), none.alias("score"), none.alias("found"),
        F.expr("cast(array() as array<boolean>)").alias("unnamed"), F.array_repeat(F.lit(0).cast("long"), size).alias("seen")), "multi-queries")


#: The positives of a group's requests.
PAIRS = StructType([StructField("p_score", LONGS), StructField("p_id", LONGS)])


def _windows(low: int, high: int):
    """From found positives to requests for negatives: one window of scores for each positive, in their order."""
    schema = StructType([*STATE.fields, *PAIRS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                pairs = list(zip(row["best"], row["score"], row["found"], row["unnamed"], strict=True))
                extra = {"p_score": [p[1] for p in pairs], "p_id": [None if p[3] else p[2] for p in pairs]}
                row |= {"who": [p[0] for p in pairs], "low": [-(-low * p[1] // 100) for p in pairs], "high": [high * p[1] // 100 for p in pairs],
                        "best": [], "score": [], "found": [], "unnamed": [], "seen": [0] * len(row["id"])}
                yield from _state_table([row | extra], schema).to_batches()
    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            best = np.asarray(row["best"], np.int64)
            rank = np.arange(len(best)) - np.searchsorted(best, best) + 1  # lists are in order
            cols = ([row["id"][row["who"][r]] for r in best], [row["p_id"][r] for r in best], rank.tolist(),
                    [None if u else f for f, u in zip(row["found"], row["unnamed"], strict=True)], [row["p_score"][r] for r in best], row["score"])
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)


def hard_negatives(rows: DataFrame, chosen: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   codes: int | None = None) -> DataFrame:
    """For each chosen row (a condition on `id`) and each of its best rows of the same label, the first rows of other labels whose score
    is from `low` to `high` percent of the positive's. rows: those of `quantised`.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    ix = index(rows, codes)
    found = search(ix, queries(ix, rows, chosen & F.col("id").isNotNull()), positives, True)
    asked = materialize(found.mapInArrow(_windows(low, high), StructType([*STATE.fields, *PAIRS.fields])), "multi-windows")
    out = search(ix, asked.select(*STATE_NAMES), negatives, False)
    named = out.join(asked.select("grp", "p_score", "p_id"), "grp")
    return named.mapInArrow(_listed, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def relabelled(rows: DataFrame, key: str = "vec_id", label: str = "label") -> DataFrame:
    """Where 7 divides the key, the next of ten labels takes the label's place."""
    return rows.withColumn(label, F.when(F.col(key) % 7 == 0, (F.col(label).cast(LongType()) + 1) % 10).otherwise(F.col(label).cast(LongType())))
