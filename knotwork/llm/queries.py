"""Registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.llm import chat, divergence, fingerprints, importance, neardup, neighbours, packing, piece_ids, quality, secret_tags, setsketch, token_files, toxicity
from knotwork.session import scratch_path

Run = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_chat_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair(_table(spark, folder, "conversations")).drop("place")


def op2_simhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.edited_fingerprints(_table(spark, folder, "documents"))
    return fingerprints.with_near_counts(found).drop("hi", "lo")


def op3_quality_co_training(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, folder, "labels")))


def op4_toxicity_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op5_elias_fano_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = _table(spark, folder, "documents"), scratch_path(spark, "token-files")
    manifest = token_files.write_id_files(docs, target, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_id_files(manifest)


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op7_nn_descent_search(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_sentencepiece_words(spark: SparkSession, folder: str) -> DataFrame:
    return piece_ids.encode_decode(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), as_read=True)


def op9_secret_scan_crf(spark: SparkSession, folder: str) -> DataFrame:
    return secret_tags.scan(_table(spark, folder, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicate_groups(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


OP11_SQL = r"""
WITH bits AS (
    SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), v::BIGINT)) AS steps
), words AS (
    SELECT d.doc_id, unnest(regexp_extract_all(translate(coalesce(d.text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w
    FROM documents d
), target_words AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w
    FROM benchmark
), distinct_words AS (
    SELECT DISTINCT w FROM (SELECT w FROM words UNION ALL SELECT w FROM target_words)
), hashed AS (
    SELECT w, list_reduce(
        list_transform(range(length(hex(encode(w))) // 2), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]), 4294967295::BIGINT) AS inverted
    FROM distinct_words, bits
), buckets AS (SELECT w, (xor(inverted, 4294967295::BIGINT) % 10000)::BIGINT AS bucket FROM hashed),
held AS (SELECT bucket, count(*) AS n FROM words JOIN buckets USING (w) GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS n FROM target_words JOIN buckets USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM held)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM wanted)::DOUBLE AS t),
gains AS (
    SELECT b.bucket, floor(1000 * ln((coalesce(wanted.n, 0) + 1.0::DOUBLE) * (sums.s + 10000) / ((coalesce(held.n, 0) + 1.0::DOUBLE) * (sums.t + 10000))))::BIGINT AS gain
    FROM (SELECT DISTINCT bucket FROM buckets) b LEFT JOIN held USING (bucket) LEFT JOIN wanted USING (bucket), sums
), found AS (
    SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM words JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN found USING (doc_id)
), placed AS (
    SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id) AS place,
        10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM placed
"""


def op12_setsketch_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, folder, "documents"), words=3, similarity=0.85)


OP12_SQL = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingled AS MATERIALIZED (
    SELECT no, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM words
), shingles AS MATERIALIZED (SELECT no, len(s) AS n, unnest(s) AS g FROM shingled),
links AS MATERIALIZED (
    SELECT a.no AS a, b.no AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.no <> b.no
    GROUP BY a.no, b.no HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
    SELECT no, doc_id AS least FROM shingled
    UNION
    SELECT l.a, r.least FROM reached r JOIN links l ON l.b = r.no
), components AS (SELECT no, min(least) AS component_id FROM reached GROUP BY no)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM shingled JOIN components USING (no)
"""


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


OP13_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
    FROM documents
), found AS (
    SELECT no, lang, source, unnest(regexp_extract_all(line, '[a-z\x{80}-\x{10FFFF}]+')) AS term FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM found GROUP BY lang, term HAVING count(DISTINCT no) >= 30
), langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (
    SELECT g.lang, g.source, coalesce(v, 0)::HUGEINT AS v, coalesce(langs.total, 0)::HUGEINT AS lang_total,
        coalesce((SELECT sum(c.n) FROM counts c JOIN kept k USING (lang, term) WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs USING (lang)
), priced AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + 1000000000 * (coalesce(c.n, 0)::HUGEINT + 5) // (g.total + 5 * g.v) AS p,
        1 + 1000000000 * (k.n + 5) // (g.lang_total + 5 * g.v) AS q
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM priced WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 50
"""


QUERIES: dict[str, Run] = {
    "op1_chat_role_repair": op1_chat_role_repair,
    "op2_simhash_fingerprints": op2_simhash_fingerprints,
    "op3_quality_co_training": op3_quality_co_training,
    "op4_toxicity_string_kernel": op4_toxicity_string_kernel,
    "op5_elias_fano_token_files": op5_elias_fano_token_files,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_nn_descent_search": op7_nn_descent_search,
    "op8_sentencepiece_words": op8_sentencepiece_words,
    "op9_secret_scan_crf": op9_secret_scan_crf,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_setsketch_near_dedup": op12_setsketch_near_dedup,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES: dict[str, str] = {
    "op11_importance_resampling": OP11_SQL,
    "op12_setsketch_near_dedup": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
