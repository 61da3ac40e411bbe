"""Queries of the corpus operators with production parameters, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationtide.llm import bpe, covertree, curve, decontaminate, exact, language, licences, merkle, quality, simhash, spelling, tokencount, warc
from stationtide.llm.common import importable_on_workers, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Tokenizer file of the encoding query.
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Word pieces of the token counts.
WORD_PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Pieces of the language models.
PIECE_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable_on_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return add


@query()
def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return bpe.digest_documents(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


@query()
def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, links at two differing bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage with at most eight edits for each hundred characters."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM e
           WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
          WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
reach(id, other) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM e JOIN least l ON l.id = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
""")
def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every vector, at a cosine of 0.9 or more."""
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the labelled rows of the other folds."""
    docs = table(spark, sf_dir, "documents")
    return language.predict_documents(docs, language.train(docs, PIECE_VOCABULARY))


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from trusted positives and unlabelled text of the other folds."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), WORD_PIECES)


@query("""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS code FROM pages),
d AS (SELECT page_id, payload_bytes, code, array_to_string(list_transform(range(32), lambda i:
          substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(code, 1 + 10 * (i // 8), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest FROM p),
f AS (SELECT code, min(page_id) AS first FROM d GROUP BY code)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d JOIN f ON f.code = d.code
""")
def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through archives of segmented records and back."""
    found = warc.archived_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards, runs of a Hilbert curve through language, source and size."""
    return curve.shard_documents(table(spark, sf_dir, "documents"), 24)


@query(licences.oracle_sql())
def op6_licence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and wording in every document."""
    return licences.scan_files(table(spark, sf_dir, "documents"))


@query(exact.oracle_sql())
def op13_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts and the row that stays, for every document."""
    return exact.mark_repeats(table(spark, sf_dir, "documents"))


@query(merkle.oracle_sql())
def op11_merkle_multiproof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document against the manifest of all."""
    return merkle.audit(table(spark, sf_dir, "documents"), merkle.tampered_text())


@query(spelling.oracle_sql())
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and near words of every word of the documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))
