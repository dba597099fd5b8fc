"""The queries of this package, each over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    credentials,
    decontamination,
    language,
    manifest,
    neardup,
    packing,
    quality,
    ranked,
    repeats,
    rules,
    topk,
    toxicity,
    url_filter,
)
from millrace.llm.common import fold_is, table

QUERIES = {}
ORACLE_SQL = {}

#: The rules that decide a page's url.
URL_RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)
TOKENIZER = "byte_bpe_50k.json"


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language.train(docs.where(~fold_is("doc_id", 3, 1)))
    held = fold_is("doc_id", 3, 1).alias("held_out")
    return language.identify_language(docs.select("doc_id", "text"), net).select("doc_id", held, "lang_pred", "score")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~fold_is("doc_id", 5, 0)))
    return _graded(toxicity.score_toxicity(docs.select("doc_id", "text"), model), 0.5)


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 20)


ORACLE_SQL["op7_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").where(~fold_is("doc_id", 5, 0)))
    return _graded(quality.score_quality(docs.select("doc_id", "text"), model), 0.3)


def _graded(scored: DataFrame, threshold: float) -> DataFrame:
    held = fold_is("doc_id", 5, 0).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(table(spark, sf_dir, "documents"))


@query
def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


ORACLE_SQL["op11_ranked"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
), sizes AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
    FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (r), total GROUP BY item_id, doc_id, r
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query
def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge_texts(table(spark, sf_dir, "documents"))


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))
