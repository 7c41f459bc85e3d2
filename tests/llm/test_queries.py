"""The registered queries on a given table: rows, held-out accuracy, and the pipeline against its stages' rules."""
import __spark_entry__ as entry
import corpus_pipeline
from netkpi.llm.shared import table

SF = "/root/testdata/sf0.001"
SF_HELD = "/root/testdata/sf0.01"


def test_all_queries_are_registered():
    names = {q for q in entry.queries() if q.startswith("op")}
    assert {int(n[2:].split("_")[0]) for n in names} >= set(range(1, 14)) and "pipeline" in entry.queries()


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_HELD, "documents"), table(spark, SF_HELD, "labels")
    lang = entry.queries()["op3_language"](spark, SF_HELD).join(docs, "doc_id").filter("held_out")
    assert lang.filter("lang = lang_pred").count() >= 0.97 * lang.count()
    good = entry.queries()["op5_quality"](spark, SF_HELD).join(labels, "doc_id").filter("held_out")
    assert good.filter("predicted = quality").count() >= 0.95 * good.count()
    bad = entry.queries()["op9_toxicity"](spark, SF_HELD).join(labels, "doc_id").filter("held_out")
    assert bad.filter("predicted = 1 and toxic = 0").count() <= 0.02 * bad.count()


def test_pipeline_stages(spark):
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert sorted(out.columns) == sorted(docs.columns)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.count())
    total = table(spark, SF, "documents").count()
    assert total > seen[0] >= seen[1] >= seen[2] > 0 and seen[3] > seen[2]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == seen[3]
    assert corpus_pipeline.run(spark, SF).count() == seen[3]


def test_sql_is_given_where_it_can_be():
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {
        "op1_pareto_mix", "op4_decontaminate", "op8_exact_dedup", "op10_substring_dedup", "op11_hard_negatives", "op12_merkle_proofs",
        "op13_template_html"}
