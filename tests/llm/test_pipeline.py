"""Rows of every pipeline stage against plain versions: nulls, empty and long texts, ties, repeated ids, clashing columns, no rows."""
import hashlib
import itertools
import math
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from netkpi.llm import quality
from netkpi.llm.arrays import Rolling
from netkpi.llm.shared import table
from tests.llm.test_operators import plain_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("quality_score", "fp", "component_id", "bm_hit", "bits", "mix_copies", "size", "_c0", "root")


def prose(n, salt):
    words = ["river", "stone", "garden", "winter", "letter", "morning", "people", "story", "bridge", "music", "window", "market"]
    picked = [words[int(hashlib.md5(f"{salt}-{i}".encode()).hexdigest(), 16) % 12] + ("." if i % 9 == 8 else "") for i in range(n)]
    return " ".join(picked).capitalize()


def junk(n, salt):
    return " ".join("$$$ CLICK!!! ||" if (i + salt) % 2 else "BUY #### 99999" for i in range(n))


ITEM = " ".join(f"item{i}" for i in range(20))
TEXTS = [
    *[(i, prose(60 + 7 * i, i), "abc"[i % 3]) for i in range(1, 60)], *[(i, junk(20 + i % 9, i), "abc"[i % 3]) for i in range(100, 150)],
    (200, prose(67, 1), "a"), (201, prose(67, 1), "b"), (202, prose(67, 1) + " end", "c"),  # copies and a near copy of document 1
    (210, prose(100, 71) + " " + ITEM, "a"), (211, prose(900, 72) + " " + ITEM, "b"), (212, ITEM[:40], None), (213, ITEM.upper(), None),
    (220, None, "a"), (221, "", "b"), (222, " \n\t", None), (223, "Ünïcödé ñandú 語", "é"), (224, prose(30_000, 73), "c"),
    (230, prose(50, 74), "a"), (230, prose(55, 75), "a"), (230, prose(55, 75), "a"), (None, prose(50, 76), "b"), (None, None, None), (None, prose(67, 1), "a"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in TEXTS], SCHEMA).withColumns({c: F.lit("mine") for c in CLASHING})
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1) for i in range(1, 60)] + [(i, 0) for i in range(100, 150)] + [(None, 1), (230, None), (1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    items = [("i1", ITEM), ("i2", "garden winter"), ("i3", None), ("i4", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def key(r):
    return (str(r["doc_id"]), str(r["text"]), str(r["source"]))


def placed(r):
    """What the sharding stage returns of a row."""
    data = (r["text"] or "").encode()
    return str(r["doc_id"]), len(data) + 1, zlib.crc32(data)


def staged(spark, folder, rows, stage):
    """The stage's rows for the given rows; every other column must come back as it was."""
    docs = table(spark, folder, "documents")
    given = spark.createDataFrame(rows, docs.schema).repartition(3)
    out = stage(spark, given, folder)
    assert out.columns == docs.columns
    got = out.collect()
    assert all(r[c] == "mine" for r in got for c in CLASHING) and all(r["lang"] == "en" for r in got)
    return got


def plain_score(model, text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    x = quality.features(Rolling(), data, np.array([0, len(data)], np.int64))[0]
    bins = [bisect_right(e.tolist(), v) for e, v in zip(model.edges, x.tolist(), strict=True)]
    total = model.bias + sum(float(t[b]) for t, b in zip(model.tables, bins, strict=True))
    per = quality.BINS // quality.COARSE
    total += sum(float(t[bins[a] // per, bins[b] // per]) for a, b, t in model.pairs)
    return 1 / (1 + math.exp(-total))


def plain_components(rows):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    group = {p: {p} for p in prints}
    for a, b in itertools.combinations(list(group), 2):
        if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return [min((r["doc_id"] for r, q in zip(rows, prints, strict=True) if q in group[p] and r["doc_id"] is not None), default=None) for p in prints]


def plain_contaminated(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit = words(text), set()
    for item in map(words, items):
        n = min(13, len(item))
        windows = {tuple(item[p:p + n]) for p in range(len(item) - n + 1)} if item else set()
        for q in range(len(w) - n + 1):
            if tuple(w[q:q + n]) in windows:
                hit |= set(range(q, q + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def plain_copies(rows):
    """Copies per row: whole ones for certain, then the first ones by odds until the target is reached as nearly as can be."""
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    total = defaultdict(int)
    for r in rows:
        total[r["source"]] += size(r)
    names = sorted((s for s in total if s is not None)) + [s for s in total if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(total.values()), set(names)
    while left > 1e-9 and open_:
        shares = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / shares
        over = {s for s in open_ if target[s] > 2 * total[s]}
        left = sum(target[s] - 2 * total[s] for s in over)
        target |= {s: 2.0 * total[s] for s in over}
        open_ -= over
    out = {}
    for s in names:
        times = target[s] / total[s] if total[s] else 0.0
        certain, p = math.floor(times), times - math.floor(times)
        goal, by_odds = max(0.0, target[s] - certain * total[s]), defaultdict(int)
        for r in rows:
            if r["source"] == s:
                out[key(r)] = certain
                u = (int(hashlib.md5(f"42|{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                by_odds[u / (1 - u), str(r["doc_id"])] += size(r)
        run, taken = 0, set()
        for (odds, i), words in sorted(by_odds.items()):
            run += words
            if p > 0 and 2 * run - words <= 2 * goal:
                taken.add(i)
        for r in rows:
            if r["source"] == s and str(r["doc_id"]) in taken and goal > 0:
                out[key(r)] += 1
    return out


def test_rows_of_every_stage(spark, folder):
    rows = table(spark, folder, "documents").collect()
    model = quality.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
    want = [r for r in rows if plain_score(model, r["text"]) >= corpus_pipeline.LEAST_QUALITY]
    got = staged(spark, folder, rows, corpus_pipeline.reject_low_quality)
    assert Counter(map(key, got)) == Counter(map(key, want))
    ids = {r["doc_id"] for r in got}
    assert ids >= set(range(1, 60)) and not ids & set(range(100, 150))

    # the other stages are given all rows, so that each meets every case
    lowest = plain_components(rows)
    want = [r for r, low in zip(rows, lowest, strict=True) if r["doc_id"] is None or r["doc_id"] not in
            {x["doc_id"] for x, y in zip(rows, lowest, strict=True) if x["doc_id"] is not None and x["doc_id"] != y}]
    got = staged(spark, folder, rows, corpus_pipeline.drop_near_duplicates)
    assert Counter(map(key, got)) == Counter(map(key, want))
    assert {1, 200, 201} & {r["doc_id"] for r in got} == {1}

    items = [r["text"] for r in table(spark, folder, "benchmark").collect()]
    want = [r for r in rows if not plain_contaminated(r["text"], items)]
    got = staged(spark, folder, rows, corpus_pipeline.remove_contaminated)
    assert Counter(map(key, got)) == Counter(map(key, want))
    ids = {r["doc_id"] for r in got}
    assert not ids & {210, 213} and 211 in ids

    got = Counter(map(key, staged(spark, folder, rows, corpus_pipeline.mix_sources)))
    copies = plain_copies(rows)
    repeats = Counter(map(key, rows))
    assert got == Counter({k: n * repeats[k] for k, n in copies.items() if n})

    given = spark.createDataFrame(rows, table(spark, folder, "documents").schema)
    out = corpus_pipeline.assign_shards(spark, given, folder).collect()
    assert Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == Counter(map(placed, rows))
    shards = defaultdict(list)
    for r in out:
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(corpus_pipeline.SHARDS))
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    assert all(len({r["shard"] for r in out if r["text_crc32"] == c}) == 1 for c in {r["text_crc32"] for r in out})


def test_run_is_the_chain_of_its_stages(spark, folder):
    rows = table(spark, folder, "documents").collect()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = staged(spark, folder, rows, stage)
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == Counter(map(placed, rows)) and len(out) > 40
    assert {name for name, _ in corpus_pipeline.STAGES} == {"quality", "near_duplicates", "decontamination", "mixing", "sharding"}


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
