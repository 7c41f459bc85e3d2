"""Merkle manifest and octopus proofs against a plain version, and the proofs of a few rows."""
import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from netkpi.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    out = [(i, f"Text {i} Über {'x' * (i % 7)}", "en" if i % 3 else None, "hot", i) for i in range(600)]
    out += [(1000 + i, f"other {i}", "de", "sixteen", i) for i in range(16)] + [(2000 + i, f"More {i}", "de", "seventeen", i) for i in range(17)]
    out += [(3000, "LONE", None, "lone", None), (3001, None, None, None, None), (None, "NO ID", "en", None, 5), (None, "no id", "en", "hot", 5)]
    out += [(7, "Twice", "en", "hot", 1)] * 3 + [(3002, "", "", "", 0), (3005, "LONG " * 200000, "en", "é", 1)]
    return out + [(4000 + i, f"S {i}", "en", f"source {i}", i) for i in range(20)]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r):
    i, text, lang, source, n = r
    fields = [None if v is None else str(v) for v in (i, source, lang, n, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[i:i + 16])) for i in range(0, len(at), 16)])
    return levels


def path(levels, pos, told):
    proof = ""
    for at in levels[:-1]:
        run, k = at[pos - pos % 16:pos - pos % 16 + 16], pos % 16
        proof += "".join(run[:k] + run[k + 1:])
        told, pos = sha("".join(run[:k]) + told + "".join(run[k + 1:])), pos // 16
    return proof, told


def plain(data):
    by = defaultdict(list)
    for r in data:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for pos, r in enumerate(by[s]):
            told = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                told = (r[0], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            low, sub = path(trees[s], pos, leaf(told))
            high, root = path(top, g, sub)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(low + high), root, root == top[-1][0]))
    return sorted(out, key=str)


def told():
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
            F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("part", [40, 100_000])
def test_equals_plain_version(spark, part):
    when, text = told()
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(5).withColumns({c: F.lit("mine") for c in ("g", "k", "h", "told", "part", "pos", "n", "_tie", "_at")})
    got = merkle.verified(docs, when, text=text, part_leaves=part)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows())


def test_empty_table_has_no_root(spark):
    when, text = told()
    assert merkle.verified(spark.createDataFrame([], SCHEMA), when, text=text).collect() == []


def test_one_row_is_its_own_root(spark):
    when, text = told()
    one = [(1, "only", "en", "a", 4)]
    got = merkle.verified(spark.createDataFrame(one, SCHEMA), when, text=text).collect()
    assert [tuple(r) for r in got] == plain(one) and got[0].root == leaf(one[0]) and got[0].proof_sha256 == sha("")


def test_partition_fetches_the_fewest_nodes():
    # leaves 0 to 31 of 600: two whole runs, so nothing at the lowest level, and 14 + 2 nodes above
    assert sorted(merkle.lacking(range(32), 600)) == [(1, p) for p in range(2, 16)] + [(2, 1), (2, 2)]
    assert merkle.lacking(range(600), 600) == [] and merkle.lacking([0], 1) == []
    both, one = merkle.lacking([3, 9], 600), merkle.lacking([3], 600)
    assert len(both) == len(one) - 1  # siblings that two leaves share are asked for once


def test_proofs_of_a_few_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    made = merkle.manifest(docs.select(merkle.group_key(F.col("source")).alias("g"), F.col("doc_id").alias("k"),
                                       merkle.leaf([F.col(c) for c in merkle.FIELDS]).alias("h")), 50)
    some = merkle.proofs(made, made.leaves.filter("k in (3, 5, 3000)")).collect()
    want = {r[0]: r for r in plain(rows())}
    assert len(some) == 3 and all(r.folded_root == made.root and r.proof_sha256 == want[r.k][4] for r in some)
