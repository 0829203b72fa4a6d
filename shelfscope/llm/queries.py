"""The registered queries of the training-data operators: each applies one
operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import embedding_dedup, hilbert, mixing, nn_descent, oracles, prior_factors, quality, runs, simhash, toxicity, trie, warc
from .bpe import encode_documents
from .common import read, stored
from .token_counts import count_tokens

#: Target shares of the languages in the mix.
MIX_WEIGHTS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}
#: No document is repeated more often, no language grows beyond half of it.
MIX_MOST = 8.0


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"), shared_dir(spark, "warc"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, radius=3)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mixing.document_rates(docs, mixing.labelled_by(docs, read(spark, sf_dir, "labels"), "lang"), MIX_WEIGHTS, most=MIX_MOST)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = encode_documents(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        decode=True,
    )
    return e.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard(read(spark, sf_dir, "documents"), {"lang": "hash", "source": "hash", "size": "log"}, bits=6, shards=16)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.learn_and_score(docs, read(spark, sf_dir, "labels"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(read(spark, sf_dir, "embeddings"), every=20, top=20)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(trie.ordered_turns(read(spark, sf_dir, "conversations")), "trie-turns")
    return trie.prefix_trie(trie.rebuilt(turns))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prior_factors.remove_repeats(read(spark, sf_dir, "documents"), least=50)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(read(spark, sf_dir, "documents"), planted=True).drop("n_words")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_quality": op8_quality,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Cosines of all pairs of a label, and smallest reachable ids by recursion.
OP10_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT vec_id AS node, vec_id AS top FROM embeddings
    UNION
    SELECT l.b, r.top FROM reach r JOIN links l ON l.a = r.node WHERE r.top < l.b
), least AS (SELECT node, min(top) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN least c ON c.node = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
"""

OP1_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
    SELECT payload_digest AS d, max(page_id) AS first, count(*) AS n FROM p WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN m ON m.d = p.payload_digest
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op11_prefix_trie": oracles.OP11,
    "op12_suffix_dedup": oracles.OP12,
    "op13_periodic_runs": oracles.OP13,
}
