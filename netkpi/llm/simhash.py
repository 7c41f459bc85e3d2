"""SimHash near-deduplication with bit-sliced comparison of fingerprints.

A text's fingerprint holds, bit by bit, what more than half of the XXH64 values of its word shingles hold. Fingerprints
within `RADIUS` bits are linked; a component is what links reach. Of 4 bands of 16 bits at least two are equal in linked
fingerprints, so each distinct fingerprint goes to 6 blocks, one per pair of bands, and only blocks of two or more
are compared. Inside a block fingerprints are bit planes: one machine word holds one bit of 64 fingerprints, two
carry-save counters add up differing bits, and a block is left once all its distances exceed the radius. A block beyond
`TILE` is compared in pairs of tiles, each a task's row, so no block is too large and no link is lost.

Defined results: null and empty texts have fingerprint 0; fingerprints, not rows, are compared, so copies and repeated
rows cost one row; component_id is the smallest non-null doc_id reachable, null if there is none; an empty table gives
an empty table. Other columns are not carried.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from netkpi.sources.tables import materialize

RADIUS = 2
TILE = 4096
#: Ordered pairs of fingerprints that a task compares, about: a whole tile.
COMPARED = TILE * TILE


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Of one text, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    pairs = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    h = np.array([xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in pairs], np.uint64)
    set_in = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype("<u8").view(np.uint8)
        set_in += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * set_in > len(h)).tolist()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (a signed 64-bit number) per document, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id", F.lit(0).cast("long").alias("fp")).schema
    return materialize(rows.mapInArrow(run, schema), "simhash-fingerprints")


def planes(fps: np.ndarray) -> np.ndarray:
    """64 x words: plane i holds bit i of 64 fingerprints per word; short of 64, the rest are zeros."""
    n = -(-len(fps) // 64) * 64
    bits = np.zeros((n, 64), np.uint8)
    bits[:len(fps)] = np.unpackbits(fps.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within_radius(queries: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, member) at most 2 bits apart.

    ones and twos count differing bits of 64 members at once; over is set beyond three. Words of a query whose 64
    members are all beyond the radius are left behind every eight planes.
    """
    sliced, full = planes(block), np.uint64(0xFFFFFFFFFFFFFFFF)
    q = np.repeat(np.arange(len(queries)), sliced.shape[1])
    w = np.tile(np.arange(sliced.shape[1]), len(queries))
    ones, twos, over = (np.zeros(len(q), np.uint64) for _ in range(3))
    for i in range(64):
        differs = sliced[i][w] ^ (np.uint64(0) - (queries[q] >> np.uint64(i) & np.uint64(1)))
        carry = ones & differs
        ones ^= differs
        over |= twos & carry
        twos ^= carry
        if i % 8 == 7:
            open_ = (over | (ones & twos)) != full
            if not open_.all():
                q, w, ones, twos, over = q[open_], w[open_], ones[open_], twos[open_], over[open_]
            if not len(q):
                break
    near = ~(over | (ones & twos))
    hit = np.flatnonzero(near)
    bits = np.unpackbits(near[hit].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    at, bit = np.nonzero(bits)
    member = w[hit][at] * 64 + bit
    real = member < len(block)
    return q[hit][at][real], member[real]


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between 0 .. n - 1: each linked item with the smallest item of its component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    item = np.flatnonzero(root != np.arange(n))
    return item, root[item]


def _links_of(left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links inside one block, or of two tiles of one block."""
    every = left if right is None else np.concatenate([left, right])
    block = every if right is None else right
    found_a, found_b = [], []
    step = max(1, (1 << 20) // max(1, len(block) // 64))
    for i in range(0, len(left), step):
        q, m = within_radius(left[i:i + step], block)
        found_a.append(q + i)
        found_b.append(m + (0 if right is None else len(left)))
    item, root = spanning(len(every), np.concatenate(found_a), np.concatenate(found_b))
    return every[item], every[root]


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints to spanning links (a, b) that join what is within the radius, block by block."""
    band = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF)
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    keys = [F.struct(F.lit(n).alias("pair"), (F.shiftleft(band(i), 16) + band(j)).alias("value")) for n, (i, j) in enumerate(pairs)]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.pair", "k.value")
    many = materialize(keyed.groupBy("pair", "value").count().filter("count > 1"), "simhash-blocks")
    tiles = F.ceil(F.col("count") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    # a tile meets each other tile of its block once: rows of tile t go to the pairs (t, u) and (u, t)
    spread = F.transform(F.sequence(F.lit(0), tiles - 1), lambda u: F.struct(F.least(own, u).alias("t"), F.greatest(own, u).alias("u")))
    rows = (keyed.join(many, ["pair", "value"]).select("pair", "value", own.alias("own"), F.explode(spread).alias("p"), "fp")
            .select("pair", "value", "p.t", "p.u", "own", "fp"))
    # comparisons grow with the square of a block, which sizes in bytes don't show, so the number of tasks is given
    work = many.agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0
    tasks = min(16 * int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, -(-work // COMPARED)))
    rows = rows.repartition(tasks, "pair", "value", "t", "u").sortWithinPartitions("pair", "value", "t", "u", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of a block whose end is not yet seen

        def solve(part: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((part[1:, :4] != part[:-1, :4]).any(axis=1)) + 1
            a, b = [], []
            for block in np.split(part, cut):
                fp, own, t, u = block[:, 5].view(np.uint64), block[:, 4], block[0, 2], block[0, 3]
                left, right = (fp, None) if t == u else (fp[own == t], fp[own == u])
                if len(left) and (right is None or len(right)):
                    x, y = _links_of(left, right)
                    a.append(x)
                    b.append(y)
            cat = lambda x: pa.array(np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64))
            return pa.RecordBatch.from_arrays([cat(a), cat(b)], ["a", "b"])

        for batch in batches:
            part = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("pair", "value", "t", "u", "own", "fp")])
            if not len(part):
                continue
            last = (part[:, :4] == part[-1, :4]).all(axis=1)
            first = len(part) - int(np.argmin(last[::-1])) if not last.all() else 0
            if first:
                yield solve(np.concatenate([*held, part[:first]]))
                held = []
            held.append(part[first:])
        if held:
            yield solve(np.concatenate(held))

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """Node and the smallest node it is connected to, by alternating large-star and small-star steps.

    Nodes without edges are not returned. Every step writes its links to the shared folder; a step groups links by node
    with partial minima, so a node with very many links is no single task.
    """
    edges = materialize(edges.filter("a <> b").distinct(), "star")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = materialize(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .filter("a <> b").distinct(), "star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(low, "a")
        small = joined.select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low.select("a", F.col("m").alias("b"))).distinct()
        small = materialize(small, "star")
        # done when every node has one link and no node that is linked to has one itself
        if small.join(small.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty() \
                and small.groupBy("a").count().filter("count > 1").isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = small


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id for every document."""
    prints = fingerprints(docs)
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = components(links(distinct.select("fp")))
    known = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    known = materialize(known, "simhash-roots")
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = materialize(known.join(lowest, "root").select("fp", "component_id"), "simhash-components")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")
