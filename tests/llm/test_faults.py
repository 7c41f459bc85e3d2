"""Constructed cases: long words with equal polynomial hashes, ids that repeat very often, columns named like internal ones."""
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from netkpi.llm import decontaminate, exact_dedup, mixing, quality, repeats, shared, substring_dedup, suffix_dedup, toxicity
from netkpi.llm.labels import remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


LONG = thue_morse(11)
OTHER = LONG.translate(str.maketrans("ab", "ba"))


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in texts], SCHEMA)


def test_unequal_long_words_are_not_taken_as_equal(spark):
    words = [f"w{i}" for i in range(34)]
    both = docs(spark, [(1, " ".join([*words, LONG])), (2, " ".join([*words, OTHER]))])
    kept = substring_dedup.kept(both, substring_dedup.found_spans(both))
    assert [r["sub_removed"] for r in kept.orderBy("doc_id").collect()] == [0, 0]
    same = docs(spark, [(1, " ".join([*words, LONG])), (2, " ".join([*words, LONG]))])
    assert [r["sub_removed"] for r in substring_dedup.kept(same, substring_dedup.found_spans(same)).collect()] == [35, 35]
    bench = spark.createDataFrame([(1, " ".join([*words[:12], LONG]))], "item_id long, text string")
    for word, hit in ((OTHER, 0), (LONG, 13)):
        one = decontaminate.annotated(docs(spark, [(1, " ".join([*words[:12], word]))]), bench).first()
        assert (one["bm_hit"], one["bm_contaminated"]) == (hit, hit > 0)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_an_id_that_repeats_teaches_once(spark, monkeypatch, module):
    rows = docs(spark, [(i, f"text {i} good" if i % 2 else f"text {i} bad !!!") for i in range(40)])
    often = rows.filter("doc_id = 1").crossJoin(spark.range(30_000)).select(*rows.columns)
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    arrow, seen = type(rows).toArrow, []
    monkeypatch.setattr(type(rows), "toArrow", lambda self: seen.append(arrow(self)) or seen[-1])
    module.fit(rows.unionByName(often).withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string"))), labels)
    usable = rows.filter(remainder(5) != 0).count()
    assert [t.num_rows for t in seen] == [usable]


def clashing(df, *names):
    return df.withColumns({n: F.lit("mine") for n in names})


def test_mixing_keeps_columns_of_internal_names(spark):
    names = ("_p", "_source", "_certain", "_last_rank", "_copy", "bits", "mix_copies", "mix_target", "mix_source_size", "_c0")
    rows = clashing(docs(spark, [(i, "a b c") for i in range(30)]), *names)
    out = mixing.copied(rows, mixing.mix_plan(mixing.word_counts(rows)))
    assert out.columns == rows.columns and out.count() > 0 and all(r[n] == "mine" for r in out.collect() for n in names)


def test_repeat_removal_keeps_columns_of_internal_names(spark):
    names = ("_rid", "_maybe", "_cell", "_marks", "_c0", "rid", "core")
    passage = " ".join(f"word{i}" for i in range(90))
    rows = clashing(docs(spark, [(1, "x " + passage), (2, passage + " y"), (3, None), (4, "z")]), *names)
    for module, column in ((suffix_dedup, "sa_removed"), (substring_dedup, "sub_removed")):
        out = module.kept(rows, module.found_spans(rows)).collect()
        assert {r["doc_id"]: r[column] > 0 for r in out} == {1: True, 2: True, 3: False, 4: False}
    spans = repeats.with_spans(clashing(rows, "_spans"), suffix_dedup.found_spans(rows))
    assert spans.columns == [*rows.columns, "_spans"] and all(r[n] == "mine" for r in spans.collect() for n in names)


def test_quality_stage_keeps_a_column_named_like_the_score(spark, tmp_path):
    rows = clashing(docs(spark, [(i, "a fine long text about many things and people " * 5) for i in range(30)]), "quality_score", "_c0")
    path = str(tmp_path)
    spark.range(30).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).write.parquet(f"{path}/labels.parquet")
    out = corpus_pipeline.reject_low_quality(spark, rows, path)
    assert out.columns == rows.columns and out.count() > 0 and {r["quality_score"] for r in out.collect()} == {"mine"}


def test_byte_repeats_on_both_sides_of_the_length(spark):
    """Passages of at least 400 bytes go, each byte of them; those of 300 to 399 bytes stay."""
    def passage(i, n):
        text = ""
        while len(text) < n:
            text += hashlib.sha256(f"{i}-{len(text)}".encode()).hexdigest()
        return text[:n]

    lengths = [300, 350, 398, 399, 400, 401, 450, 700, 1500, 5000]
    rows = []
    for i, n in enumerate(lengths):
        for k in range(3):
            rows.append((10 * i + k, passage(f"own{i}{k}", 200 + 37 * k) + "XYZ"[k] + passage(i, n) + "UVW"[k] + passage(f"end{i}{k}", 150)))
    out = suffix_dedup.kept(docs(spark, rows), suffix_dedup.found_spans(docs(spark, rows))).collect()
    assert {r["doc_id"]: r["sa_removed"] for r in out} == {10 * i + k: n if n >= 400 else 0 for i, n in enumerate(lengths) for k in range(3)}


@pytest.mark.parametrize("blocks", [1, 2, 6])
def test_the_share_that_passes_does_not_depend_on_the_blocks(spark, blocks):
    """All rows are alone: of 40,000 some 1 to 2 % pass the filter, in one block as in many, where one block alone lets all pass."""
    n, cell = 40_000, exact_dedup.CELL
    rows = exact_dedup.digests(spark.range(n).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")))
    most = -(-20 // blocks) * cell
    seen = exact_dedup.possibly_repeated(rows, n, most=most)
    assert seen.count() == n and seen.select("doc_id").distinct().count() == n
    assert 0 < seen.filter("repeated").count() < 0.03 * n
    again = exact_dedup.possibly_repeated(rows.unionAll(rows.filter("doc_id < 500")), n, most=most)
    assert again.filter("repeated and doc_id < 500").count() == 1000


def test_exact_groups_in_blocks(spark, monkeypatch):
    rows = docs(spark, [(i, f"text {i % 9000}") for i in range(12_000)])
    want = {(i, i % 9000, 2 if i % 9000 < 3000 else 1) for i in range(12_000)}
    for most in (exact_dedup.CELL, exact_dedup.MOST_BITS):
        monkeypatch.setattr(exact_dedup, "MOST_BITS", most)
        out = exact_dedup.exact_groups(exact_dedup.digests(rows)).collect()
        assert {(r.doc_id, r.keep_id, r.group_size) for r in out} == want and len(out) == len(want)


def test_membership_filter_in_blocks(spark, monkeypatch, tmp_path):
    rows = spark.range(60_000).select(F.xxhash64("id").alias("k"), "id")
    rows.filter("id % 6 = 0").select("k").write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    for most in (shared.CELL, 2 * shared.CELL, shared.MOST_FILTER_BITS):
        monkeypatch.setattr(shared, "MOST_FILTER_BITS", most)
        out = shared.with_maybe(rows, keys, "k")
        assert out.columns == ["k", "id", "_maybe"] and out.count() == 60_000
        assert out.filter("id % 6 = 0 and not _maybe").isEmpty()
        assert out.filter("id % 6 <> 0 and _maybe").count() < 0.08 * 50_000


def test_longest_match_is_joined_over_windows_and_blocks(spark, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    rows = docs(spark, [
        (1, "x " + " ".join(words[100:150]) + " y"), (2, " ".join([*words[:20], "z", *words[20:47]])), (3, "a w5 w6 w7 b"), (4, None), (8, "w5 w6"),
        (5, " ".join([*words[:13], *words[:13]])), (6, "one TWO"), (7, " ".join(["r"] * 40))])
    bench = spark.createDataFrame([("a", " ".join(words)), ("b", "one\ntwo"), ("c", " ".join(words[90:140])), ("d", " ".join(["r"] * 15)), ("e", None)],
                                  "item_id string, text string").repartition(1)
    monkeypatch.setattr(Items := decontaminate.Items, "__init__", _counted(Items.__init__, seen := []))
    for most, passes in ((500_000, 1), (30, 3), (1, 4)):
        seen.clear()
        monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (most,))
        out = decontaminate.annotated(rows, bench).collect()
        assert {r.doc_id: r.bm_longest for r in out} == {1: 50, 2: 27, 3: 3, 4: 0, 5: 13, 6: 2, 7: 15, 8: 0}
        assert {r.doc_id: r.bm_hit for r in out} == {1: 50, 2: 47, 3: 0, 4: 0, 5: 26, 6: 2, 7: 40, 8: 0}
        assert len(seen) >= passes and max(map(len, seen)) <= 4


def _counted(init, seen):
    def counting(self, ids, texts, window):
        seen.append(ids)
        init(self, ids, texts, window)
    return counting
