"""The pipeline against its stages done one by one in plain Python."""

from __future__ import annotations

import base64
import struct
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import tiktoken

import corpus_pipeline
from shelfscope.llm import quality, toxicity
from shelfscope.llm.queries import MIX_WEIGHTS
from tests.conftest import MEDIUM
from tests.llm.test_mixing import brute as brute_rates
from tests.llm.test_simhash import brute as brute_groups


def test_pipeline_equals_its_stages_in_plain_python(spark):
    got = Counter((r.doc_id, bytes(r.token_ids)) for r in corpus_pipeline.run(spark, MEDIUM).collect())
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    q = quality.fit(docs, labels)
    rows = [d for d in rows if q.scores(quality.measures(d["text"])[None])[0] >= 0.3]
    left = docs.where(docs.doc_id.isin([d["doc_id"] for d in rows]))
    chain = toxicity.fit(left, labels)
    rows = [d for d, p in zip(rows, chain.predict([d["text"] for d in rows])) if p[-1] < 0.5]
    least = {i: c for i, _, c in brute_groups([(d["doc_id"], d["text"]) for d in rows])}
    rows = [d for d in rows if least[d["doc_id"]] == d["doc_id"]]
    ids = set(pq.read_table(f"{MEDIUM}/labels.parquet").column("doc_id").to_pylist())
    *_, rate, _ = brute_rates([(d["doc_id"], d["text"]) for d in rows], [(d["text"], d["lang"]) for d in rows if d["doc_id"] in ids], MIX_WEIGHTS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    packed = {d["doc_id"]: struct.pack(f"<{len(t)}I", *t) for d in rows for t in [library.encode_ordinary(d["text"])]}
    assert {i for i, _ in got} == set(packed)
    for d, r in zip(rows, rate):
        n = got[d["doc_id"], packed[d["doc_id"]]]
        assert n in (int(r), int(r) + 1)
    assert 0.6 * docs.count() < len(rows) < docs.count()


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    base = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-1, "", "en", "s", 0), (-2, "x " * 50_000, None, None, 1)], base.schema)
    docs = base.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, MEDIUM)
        assert out.columns == base.columns, name
        assert 0 < out.count()
        assert stage(spark, base.limit(0), MEDIUM).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, MEDIUM).count() == docs.count()


def test_few_clean_documents_go(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    clean = labels.where("quality = 1 and toxic = 0").select("doc_id").collect()
    left = corpus_pipeline.toxicity_stage(spark, corpus_pipeline.quality_stage(spark, docs, MEDIUM), MEDIUM)
    kept = {r.doc_id for r in left.select("doc_id").collect()}
    assert sum(r.doc_id in kept for r in clean) >= 0.98 * len(clean)
