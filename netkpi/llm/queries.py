"""The registered queries of the subpackage, one per operator, and their SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from netkpi.llm import decontaminate, exact_dedup, html, language, merkle, mixing, multi_index, quality, sharding, simhash, substring_dedup, suffix_dedup, toxicity
from netkpi.llm.labels import remainder
from netkpi.llm.shared import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.word_counts(table(spark, sf_dir, "documents"))
    out = mixing.mixed(sized, mixing.mix_plan(sized))
    return out.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                      (F.col("size") * F.col("mix_copies")).alias("taken"))


@register
def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.sharded(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@register
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.digests(table(spark, sf_dir, "documents"))
    return exact_dedup.exact_groups(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.annotated(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("bm_words").alias("n_words"), F.col("bm_hit").alias("n_hit"), F.col("bm_n_items").alias("n_items"),
                      F.sha2(F.array_join("bm_items", ",").cast("binary"), 256).alias("items_sha256"),
                      F.col("bm_contaminated").alias("contaminated"))


@register
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = F.col("quality_score")
    return quality.scored(docs, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


@register
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(remainder(3) != 1))
    return language.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"))


@register
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    score = F.col("toxic_score")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@register
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.kept(docs, suffix_dedup.found_spans(docs))
    return out.select("doc_id", F.col("sa_bytes").alias("n_bytes"), F.col("sa_removed").alias("n_removed"),
                      F.col("sa_spans").alias("n_spans"), F.sha2("sa_kept", 256).alias("kept_sha256"))


@register
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.kept(docs, substring_dedup.found_spans(docs))
    return out.select("doc_id", F.col("sub_words").alias("n_words"), F.col("sub_removed").alias("n_removed"),
                      F.sha2(F.col("sub_text").cast("binary"), 256).alias("kept_sha256"))


@register
def op12_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    told = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.verified(docs, told, text=F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@register
def op13_template_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multi_index.quantised(multi_index.relabelled(table(spark, sf_dir, "embeddings")), "vec_id", "embedding", "label")
    return multi_index.hard_negatives(rows, F.col("id") % 100 == 0)


ORACLES["op8_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""

ORACLES["op1_pareto_mix"] = r"""
WITH n AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         CAST('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS bits
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM n GROUP BY source
), w AS (
  SELECT *, ([5.0::DOUBLE, 2.0, 1.0])[rank % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM s
), r AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM w
), t AS (
  SELECT source, source_size, least(cap, weight * coalesce(
           (SELECT arg_min(rate, (cap / weight, rank)) FROM r WHERE rate * weight <= cap), 'inf'::DOUBLE)) AS target
  FROM r
), c AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS certain,
         CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS p
  FROM t
), v AS (
  SELECT n.doc_id, n.size, c.source, source_size, target, certain, greatest(0, target - certain * source_size) AS goal,
         CASE WHEN p > 0 THEN ((bits + 0.5::DOUBLE) / 4503599627370496 / (1 - (bits + 0.5::DOUBLE) / 4503599627370496)) / (p / (1 - p)) END AS q
  FROM n JOIN c ON n.source IS NOT DISTINCT FROM c.source
), o AS (
  SELECT *, floor(q / (1 + q) * 4503599627370496) AS place FROM v
), run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place) AS run, sum(size) OVER (PARTITION BY source, place) AS together FROM o
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (certain + CASE WHEN place IS NOT NULL AND goal > 0 AND run + run - together <= goal + goal THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""

ORACLES["op4_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS n,
         unnest(list_transform(range(1, greatest(1, len(words) - 12) + 1), lambda i: array_to_string(words[i:i + 12], ' '))) AS seq
  FROM b WHERE len(words) > 0
), lengths AS (
  SELECT DISTINCT n FROM wanted
), windows AS (
  SELECT rid, n, unnest(range(1, len(words) - n + 2)) AS k,
         unnest(list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))) AS seq
  FROM d, lengths WHERE len(words) >= n
), found AS (
  SELECT rid, k, n, item_id FROM windows JOIN wanted USING (n, seq)
), hit AS (
  SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(k, k + n)) AS word FROM found) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

ORACLES["op10_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT rid, unnest(range(1, len(words) - 33)) AS k,
         unnest(list_transform(range(1, len(words) - 33), lambda i: md5(array_to_string(words[i:i + 34], ' ')))) AS seq
  FROM d WHERE len(words) >= 35
), gone AS (
  SELECT rid, k, lead(k) OVER (PARTITION BY rid ORDER BY k) AS next
  FROM (SELECT rid, k, count(*) OVER (PARTITION BY seq) AS n FROM windows) WHERE n > 1
), words AS (
  SELECT DISTINCT rid, unnest(range(k, least(k + 35, coalesce(next, k + 35)))) AS word FROM gone
), marked AS (
  SELECT rid, list(word) AS removed FROM words GROUP BY rid
), flat AS (
  SELECT d.rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM d
), kept AS (
  SELECT f.rid, string_agg(f.word, ' ' ORDER BY f.k) AS text
  FROM flat f LEFT JOIN words w ON w.rid = f.rid AND w.word = f.k WHERE w.rid IS NULL GROUP BY f.rid
)
SELECT doc_id, len(d.words) AS n_words, coalesce(len(removed), 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN marked USING (rid) LEFT JOIN kept USING (rid)
"""


def merkle_sql(within: int, over: int) -> str:
    """within, over: levels of the tree of a source and of that over the subroots, at least as many as the table needs."""
    def enc(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def climb(name, levels, group):
        """name_0 has (group, pos, h); name_L has a level's nodes, name_Lr its runs."""
        out = []
        for k in range(levels):
            out.append(f"""{name}_{k}r AS (
  SELECT {group}, pos // 16 AS up, list(h ORDER BY pos) AS run, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {name}_{k}) GROUP BY {group}, pos // 16
), {name}_{k + 1} AS (
  SELECT {group}, up AS pos, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM {name}_{k}r
)""")
        return out

    def fold(source, name, levels, group, place):
        """Adds the siblings of each level and folds the told digest."""
        out = []
        for k in range(levels):
            here = f"({place} // {16 ** k})"
            at = f"CAST({here} % 16 AS INTEGER)"
            out.append(f"""{name}_f{k} AS (
  SELECT p.* EXCLUDE (proof, told),
         CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(list_concat(run[1:{at}], run[{at} + 2:]), '') END AS proof,
         CASE WHEN r.n = 1 THEN told ELSE sha256(array_to_string(run[1:{at}], '') || told || array_to_string(run[{at} + 2:], '')) END AS told
  FROM {source} p JOIN {name}_{k}r r ON r.up = {place} // {16 ** (k + 1)}{group}
)""")
            source = f"{name}_f{k}"
        return out, source

    inside, last = fold("placed", "own", within, " AND r.g = p.g", "p.pos")
    above, last = fold("pathed", "top", over, "", "p.gpos")
    parts = [f"""crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), coded AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 5 = 0 AS tampered
  FROM documents, crc
), hashed AS (
  SELECT doc_id, coalesce('+' || source, '') AS g, sha256({" || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS h,
         sha256({" || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {enc("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lowered, tampered
  FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, '' AS proof,
         CASE WHEN tampered THEN lowered ELSE h END AS told FROM hashed
), own_0 AS (SELECT g, pos, h FROM placed)""", *climb("own", within, "g"), f"""top_0 AS (
  SELECT 1 AS one, g, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, h FROM own_{within}
)""", *climb("top", over, "one"), *inside, f"""pathed AS (
  SELECT p.*, t.pos AS gpos, t.h AS subroot FROM own_f{within - 1} p JOIN top_0 t USING (g)
)""", *above]
    return "WITH " + ", ".join(parts) + f"""
SELECT doc_id, p.h AS leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, told AS folded_root, told = t.h AS verified
FROM {last} p, top_{over} t"""


#: Enough for a million rows of a source and 4,096 sources.
ORACLES["op12_merkle_proofs"] = merkle_sql(5, 3)

#: For pages with one article of headings, paragraphs and unclosed inline elements, as in the given tables.
ORACLES["op13_template_html"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, string_split_regex(body, '</?(p|h1)>') AS blocks FROM a
), c AS (
  SELECT page_id, url, list_transform(blocks, lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')) AS blocks FROM b
), d AS (
  SELECT page_id, url, list_transform(blocks, lambda x: trim(regexp_replace(replace(replace(replace(
           regexp_replace(x, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&#x27;', chr(39)), '\s+', ' ', 'g'))) AS blocks FROM c
), e AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda x: regexp_replace(x, '&amp;?', '&', 'g')),
                                                   lambda x: x <> ''), chr(10)) AS text FROM d
)
SELECT page_id, url, text, length(text) AS n_chars FROM e
"""

ORACLES["op11_hard_negatives"] = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), n AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
         other AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM n WHERE rank <= 10
"""
