"""Hard negatives against all scores; the order of cells; a search that ends before it has seen everything."""
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from netkpi.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    used = []
    for i, v, y in rows:
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, np.array([math.floor(256 * float(np.float32(x))) for x in v], dtype=object), (y + 1) % 10 if i is not None and i % 7 == 0 else y))
    out = []
    for i, v, y in used:
        if i is None or i % 100:
            continue
        scored = sorted(((int(sum(a * b for a, b in zip(v, w))), j, z) for j, w, z in used if j != i), key=lambda t: (-t[0], t[1] is None, t[1] or 0))
        for p, j, _ in [t for t in scored if t[2] == y][:positives]:
            near = [t for t in scored if t[2] != y and low * p <= 100 * t[0] <= high * p][:negatives]
            out += [(i, j, k + 1, t[1], p, t[0]) for k, t in enumerate(near)]
    return sorted(out, key=str)


def vectors(n, dims, seed, clustered=False):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dims))
    if clustered:
        x = 0.02 * x + draw.normal(size=(20, dims))[draw.integers(0, 20, n)]
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).tolist()


def odd_rows():
    """Nulls, ties, repeats, ragged and large vectors, and a third of all rows equal."""
    x = vectors(600, 8, 1)
    rows = [(i, x[i], i % 4) for i in range(600)]
    rows += [(1000 + i, x[100], i % 2) for i in range(300)] + [(300, x[5], 1), (300, x[5], 1), (7, x[7], 3), (None, x[9], 2), (None, x[9], 1)]
    rows += [(2000, None, 1), (2100, x[3], None), (2200, [float("nan")] + x[3][1:], 1), (2300, [None] + x[3][1:], 1), (2400, [float("inf")] * 8, 1)]
    rows += [(2500, x[3][:5], 0), (2600, [], 1), (2700, [300.0] * 8, 2), (-700, x[11], 2), (2800, [0.0] * 8, 3)]
    return rows


@pytest.mark.parametrize("codes, merged", [(None, 256), (2, 256), (8, 2)])
def test_equals_all_scores(spark, monkeypatch, codes, merged):
    monkeypatch.setattr(multi_index, "MERGED", merged)
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(4)
    df = df.withColumns({c: F.lit("mine") for c in ("id", "q", "uid", "cell", "shelf", "grp", "d1", "low", "best", "seen")})
    rows = multi_index.quantised(multi_index.relabelled(df), "vec_id", "embedding", "label")
    got = multi_index.hard_negatives(rows, F.col("id") % 100 == 0, codes=codes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(odd_rows())


def test_few_rows_and_none(spark):
    few = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.25, 0.0], 2), (3, [0.45, 0.1], 2), (4, [0.44, 1.0], 2)]
    for rows in (few, few[:1], []):
        table = multi_index.quantised(multi_index.relabelled(spark.createDataFrame(rows, SCHEMA)), "vec_id", "embedding", "label")
        assert sorted((tuple(r) for r in multi_index.hard_negatives(table, F.col("id") % 100 == 0).collect()), key=str) == plain(rows)


def test_cells_come_by_falling_bounds():
    one, two = np.array([3.0, 9.0, 5.0]), np.array([1.0, 1.0, 8.0, -2.0])
    walk = list(multi_index.cells_in_turn((one, two)))
    assert [w[0] for w in walk] == sorted((a + b for a in one for b in two), reverse=True)
    assert len({w[1:] for w in walk}) == 12 and all(w[0] == one[w[1]] + two[w[2]] for w in walk)


@pytest.mark.parametrize("heaped", [1, 4, 1 << 30])
def test_sorted_bounds_go_on_where_the_heap_ends(monkeypatch, heaped):
    """Equal sums, too, come in the heap's order; a walk ends at `least`, and one that was seen in part goes on from there."""
    monkeypatch.setattr(multi_index, "HEAPED", heaped)
    bounds = tuple(np.random.default_rng(3).integers(0, 6, n).astype(float) for n in (13, 17))
    walk = list(multi_index.cells_in_turn(bounds))
    for least, seen, more in ((-1.0, 0, 1), (4.0, 0, 300), (4.0, 30, 10), (7.0, 220, 1)):
        got = {at + n: (b, i, j) for at, *cols in multi_index._walk(bounds, least, seen, more, 5) for n, (b, i, j) in enumerate(zip(*cols, strict=True))}
        reached = [n for n, cell in enumerate(walk) if cell[0] >= least]
        assert set(reached[seen:]) <= set(got) and all(got[n] == walk[n] for n in got)


@pytest.mark.parametrize("met, heaped, first", [(1, 1, 2), (2, 1 << 30, 2)])
def test_equals_all_scores_in_many_groups(spark, monkeypatch, met, heaped, first):
    for name, value in {"MET": met, "HEAPED": heaped, "FIRST_CELLS": first, "GROUP": 2, "MULTIPLIED": 1, "MERGED": 3}.items():
        monkeypatch.setattr(multi_index, name, value)
    rows = multi_index.quantised(multi_index.relabelled(spark.createDataFrame(odd_rows(), SCHEMA)), "vec_id", "embedding", "label")
    got = multi_index.hard_negatives(rows, F.col("id") % 100 == 0, codes=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(odd_rows())


def test_visits_of_a_group_take_a_bit_each(spark):
    """A round in which all queries visit all cells: no row has more than a bit per query and cell, and a number per cell."""
    x = vectors(3000, 8, 5)
    table = multi_index.quantised(spark.createDataFrame([(i, x[i], 0) for i in range(3000)], SCHEMA), "vec_id", "embedding", "label")
    ix = multi_index.index(table, 16)
    state = multi_index.queries(ix, table, F.col("id") % 20 == 0).toArrow()
    turn = pa.Table.from_batches(list(multi_index._advance(ix, 5, 1 << 20)(state.to_batches())))
    cells = int((ix.counts > 0).sum())
    own = max(state.slice(i, 1).nbytes for i in range(len(state)))
    assert len(state) == 1 and max(turn.slice(i, 1).nbytes for i in range(len(turn))) < 2 * own + cells * (150 // 8 + 9)
    marks = [np.unpackbits(np.frombuffer(m, np.uint8)).sum() for m in turn.column("marks").to_pylist() if m is not None]
    assert sum(marks) == 150 * cells  # no cell lies on two shelves here


def test_search_ends_when_certified(spark, monkeypatch):
    """Clustered rows: the best of the same label lie in few cells, and a query does not visit the others."""
    monkeypatch.setattr(multi_index, "FIRST_CELLS", 2)
    x = vectors(4000, 16, 3, clustered=True)
    rows = [(i, x[i], 0) for i in range(4000)]
    table = multi_index.quantised(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    ix = multi_index.index(table, 16)
    found = multi_index.search(ix, multi_index.queries(ix, table, F.col("id") % 100 == 0), 5, True).collect()
    q = np.floor(256 * np.array(x, np.float32).astype(float)).astype(int)
    for row in found:
        for a, own in enumerate(row["id"]):
            s = q @ q[own]
            want = sorted(((-s[j], j) for j in range(4000) if j != own))[:5]
            assert [(-v, j) for b, v, j in zip(row["best"], row["score"], row["found"]) if b == a] == want
    assert sum(sum(r["seen"]) for r in found) < 0.5 * 16 * 16 * sum(len(r["seen"]) for r in found)
