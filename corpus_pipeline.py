"""The corpus pipeline: documents that pass quality and toxicity, one of each
near-duplicate group, mixed to target weights and encoded to token ids.

Every stage is written as Parquet in the shared folder and read again by the
next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm import bpe, mixing, quality, simhash, toxicity
from shelfscope.llm.common import read, stored
from shelfscope.llm.queries import MIX_MOST, MIX_WEIGHTS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; null and empty texts
    do not.  Repeated rows are judged alike, other columns pass through."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.with_scores(docs, model, "text", "__score")
    return scored.where(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic."""
    chain = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, chain, "text", "__p_")
    return scored.where(F.col(f"__p_{chain.names[-1]}") < toxicity.THRESHOLD).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, words=3, radius=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the rates that bring the languages to their
    target weights; targets lie where no language has to shrink, and no
    document is repeated more than ``MIX_MOST`` times.  Null and empty texts are
    kept at the prior's rate."""
    return mixing.mix(docs, mixing.labelled_by(docs, read(spark, sf_dir, "labels"), "lang"), MIX_WEIGHTS, most=MIX_MOST)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian unsigned 32 bits) of every document."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: Classifiers and tokenizers cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
