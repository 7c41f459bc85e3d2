"""Encoding, imputation, scaling and splits of the labelled rows."""
from pyspark.sql import functions as F

from netkpi.functions.scalar import in_range, split_bucket
from netkpi.operators import features, kpi, models
from netkpi.plans import oracle_parts as o
from netkpi.plans.registry import register, rounded
from netkpi.sources import adapters, tables

SHARES = {"train": 60, "validate": 20, "test": 20}

_BUCKET = "((((doc_id % 2147483647) + 11) * 48271) % 2147483647) % 100"
_SPLIT = f"""{o.LABELLED}, rows AS (
  SELECT *, CASE WHEN {_BUCKET} < 60 THEN 'train' WHEN {_BUCKET} < 80 THEN 'validate' ELSE 'test' END AS split FROM labelled)"""
_LANGS = ("de", "en", "es", "fr")


def split_rows(spark, sf_dir):
    return features.with_split(adapters.labelled_rows(spark, sf_dir), F.col("doc_id"), SHARES, seed=11)


def _train(rows):
    return rows.filter(F.col("split") == "train")


@register("one_hot_levels", "B16 I5", o.with_(o.LABELLED) + f"""
SELECT doc_id, quality, {', '.join(f"coalesce(lang = '{v}', FALSE)::BIGINT AS lang_{v}" for v in _LANGS)},
  {', '.join(f"coalesce(source = 'src{i}', FALSE)::BIGINT AS source_src{i}" for i in range(20))} FROM labelled""")
def one_hot_levels(spark, sf_dir):
    rows = adapters.labelled_rows(spark, sf_dir).select("doc_id", "quality", "lang", "source")
    return features.one_hot(rows, features.fit_levels(rows, ["lang", "source"]))


@register("one_hot_long", "B16 I5", o.with_(o.LABELLED) + """
SELECT doc_id, 'lang_' || lang AS feature FROM labelled WHERE lang IS NOT NULL
UNION ALL SELECT doc_id, 'source_' || source FROM labelled WHERE source IS NOT NULL""")
def one_hot_long(spark, sf_dir):
    return features.one_hot_long(adapters.labelled_rows(spark, sf_dir), ["doc_id"], ["lang", "source"])


@register("one_hot_drop_first", "B24", o.with_(_SPLIT) + f"""
SELECT doc_id, {', '.join(f"(lang = '{v}')::BIGINT AS lang_{v}" for v in _LANGS[1:])} FROM rows""")
def one_hot_drop_first(spark, sf_dir):
    """Levels come from the training rows; the first one is left out."""
    rows = split_rows(spark, sf_dir).select("doc_id", "lang", "split")
    levels = features.fit_levels(_train(rows), ["lang"])
    return features.one_hot(rows.drop("split"), levels, drop_first=True)


@register("impute_mean", "B22", o.with_(_SPLIT) + """
, n AS (SELECT doc_id, split, CASE WHEN toxic = 0 THEN n_chars::DOUBLE END AS chars FROM rows)
SELECT doc_id, split, round(coalesce(chars, (SELECT avg(chars) FROM n WHERE split = 'train')), 6) AS chars FROM n""")
def impute_mean(spark, sf_dir):
    rows = split_rows(spark, sf_dir).select(
        "doc_id", "split", F.when(F.col("toxic") == 0, F.col("n_chars").cast("double")).alias("chars"))
    return rounded(features.impute_mean(_train(rows), rows, ["chars"]), "chars")


@register("standardise", "B23", o.with_(_SPLIT) + """
SELECT doc_id, round((n_chars - (SELECT avg(n_chars) FROM rows WHERE split = 'train'))
  / coalesce(nullif((SELECT stddev_pop(n_chars) FROM rows WHERE split = 'train'), 0), 1), 6) AS n_chars FROM rows""")
def standardise(spark, sf_dir):
    rows = split_rows(spark, sf_dir).select("doc_id", "split", "n_chars")
    return rounded(features.standardise(_train(rows), rows, ["n_chars"]).select("doc_id", "n_chars"), "n_chars")


@register("model_inputs", "B25", o.with_(o.LABELLED) + "SELECT lang, n_chars, doc_id FROM labelled")
def model_inputs(spark, sf_dir):
    return features.require_columns(adapters.labelled_rows(spark, sf_dir), ["lang", "n_chars", "doc_id"])


@register("three_way_split", "G1", o.with_(_SPLIT) + "SELECT doc_id, split FROM rows")
def three_way_split(spark, sf_dir):
    return split_rows(spark, sf_dir).select("doc_id", "split")


@register("two_way_split", "G1", o.with_(o.LABELLED) + """
SELECT doc_id, ((((doc_id % 2147483647) + 3) * 48271) % 2147483647) % 100 AS bucket,
  CASE WHEN ((((doc_id % 2147483647) + 3) * 48271) % 2147483647) % 100 < 75 THEN 'train' ELSE 'test' END AS split FROM labelled""")
def two_way_split(spark, sf_dir):
    rows = adapters.labelled_rows(spark, sf_dir).select("doc_id")
    rows = features.with_split(rows, F.col("doc_id"), {"train": 75, "test": 25}, seed=3)
    return rows.withColumn("bucket", split_bucket(F.col("doc_id"), 3).cast("long"))


@register("label_encoding", "G3", o.with_(_SPLIT) + """
, codes AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS code FROM (SELECT DISTINCT lang FROM rows WHERE split = 'train'))
SELECT doc_id, lang, coalesce(code, (SELECT count(*) FROM codes))::DOUBLE AS code FROM rows LEFT JOIN codes USING (lang)""")
def label_encoding(spark, sf_dir):
    rows = split_rows(spark, sf_dir).select("doc_id", "lang", "split")
    return models.encode_labels(_train(rows), rows, "lang", "code").select("doc_id", "lang", "code")


@register("feature_table", "A11 B17 B18 B20", o.with_(o.LABELLED) + f"""
SELECT doc_id, quality, n_chars, {', '.join(f"(lang = '{v}')::BIGINT AS lang_{v}" for v in _LANGS)} FROM labelled
WHERE doc_id IS NOT NULL AND n_chars IS NOT NULL""")
def feature_table(spark, sf_dir):
    """Encode, clean names, drop incomplete rows, write under a primary key, read back."""
    rows = adapters.labelled_rows(spark, sf_dir).select("doc_id", "quality", "n_chars", "lang")
    wide = features.clean_features(features.one_hot(rows, features.fit_levels(rows, ["lang"]))).dropna(how="any")
    return tables.write_feature_table(
        wide, tables.fresh_name("features"), ["doc_id"], tables.fresh_path(spark, "features"))


@register("hourly_feature_table", "A11 D8", o.with_(o.EVENT, o.MINUTE, o.HOUR) + """
SELECT * FROM hour_kpi WHERE datetime >= TIMESTAMP '2024-01-08' AND datetime < TIMESTAMP '2024-01-22'""")
def hourly_feature_table(spark, sf_dir):
    """Hour KPI of two weeks under the key (entity, hour), written, audited and read back."""
    records = adapters.event_records(spark, sf_dir).filter(in_range(F.col("event_ts"), "2024-01-08", "2024-01-22"))
    hours = kpi.event_kpi(records, "1 hour")
    return tables.write_feature_table(
        hours, tables.fresh_name("hourly_features"), ["entity_id", "datetime"], tables.fresh_path(spark, "hourly-features"))
