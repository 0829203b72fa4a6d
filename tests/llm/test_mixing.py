"""Mixing rates against the same descent in numpy, targets, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import mixing, queries
from tests.conftest import MEDIUM


def plain_counts(text: str) -> tuple[float, list[float]]:
    group = {}
    for i, g in enumerate(mixing.GROUPS):
        for c in g + g.upper():
            group.setdefault(c, i)
    counts = [0.0] * (len(mixing.GROUPS) + 1)
    blanks = sum(c in " \t\n\r" for c in text)
    for c in text:
        if c not in " \t\n\r":
            counts[group.get(c, len(mixing.GROUPS))] += 1
    return (blanks + 1.0 if text else 0.0), counts


def brute(docs, labelled, weights):
    """ids -> (tokens, posteriors, rate)."""
    names = sorted({d for _, d in labelled if d is not None})
    letters, prior = [], []
    for n in names:
        g = np.sum([plain_counts(t or "")[1] for t, d in labelled if d == n], axis=0) + 1
        letters.append(np.log(g / g.sum()))
        prior.append(math.log(sum(d == n for _, d in labelled) / sum(d is not None for _, d in labelled)))
    tokens, post = [], []
    for _, t in docs:
        n, c = plain_counts(t or "")
        c = np.array(c)
        z = np.array(prior) + (min(mixing.TEMPER, c.sum()) / c.sum() * (np.array(letters) @ c) if c.sum() else 0)
        p = np.exp(z - z.max())
        tokens.append(n)
        post.append(p / p.sum())
    tokens, post = np.array(tokens), np.array(post)
    s = tokens @ post
    w = np.array([weights.get(n, 0.0) for n in names])
    target = w / w.sum() * max(s / (w / w.sum()))
    r = np.ones(len(tokens))
    for _ in range(mixing.ROUNDS):
        e = (tokens * r) @ post - target
        if max(abs(e) / target) < mixing.TOLERANCE:
            break
        r = np.maximum(0, r - post @ (e / s))
    return tokens, post, r, target


def test_op3_equals_the_descent_in_numpy(spark):
    docs = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    ids = set(pq.read_table(f"{MEDIUM}/labels.parquet").column("doc_id").to_pylist())
    labelled = [(d["text"], d["lang"]) for d in docs if d["doc_id"] in ids]
    tokens, post, rate, target = brute([(d["doc_id"], d["text"]) for d in docs], labelled, queries.MIX_WEIGHTS)
    got = {r.doc_id: r for r in queries.op3_mixing(spark, MEDIUM).collect()}
    names = sorted(queries.MIX_WEIGHTS)
    for d, n, p, r in zip(docs, tokens, post, rate):
        x = got.pop(d["doc_id"])
        assert x.n_tokens == n
        assert [x[f"p_{k}"] for k in names] == pytest.approx(p.tolist(), abs=1e-9)
        assert x.rate == pytest.approx(r, abs=1e-6)
        assert x.copies in (math.floor(x.rate), math.floor(x.rate) + 1)
    assert not got
    assert ((tokens * rate) @ post) == pytest.approx(target, rel=2 * mixing.TOLERANCE)


def test_rates_reach_targets_that_need_less(spark):
    """A given total below the present tokens: rates fall, never below 0."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 400)
    rows = spark.createDataFrame([(i, float(rng.integers(1, 50)), x.tolist()) for i, x in enumerate(p)], "id long, __tokens double, p array<double>")
    rates = mixing.fit_rates(rows, ("a", "b", "c"), {"a": 0.8, "b": 0.1, "c": 0.1}, total=3000.0)
    r = rows.withColumn("r", rates.rate(F.col("p"))).collect()
    assert min(x.r for x in r) == 0.0
    now = np.sum([np.array(x.p) * x["__tokens"] * x.r for x in r], axis=0)
    assert now == pytest.approx([2400, 300, 300], rel=0.05)
    assert now == pytest.approx(rates.reached, rel=1e-9)


def test_mix_keeps_columns_and_copies(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    labelled = mixing.labelled_by(docs, labels, "lang")
    out = mixing.mix(docs, labelled, queries.MIX_WEIGHTS)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    want = {r.doc_id: r.copies for r in mixing.document_rates(docs, labelled, queries.MIX_WEIGHTS).collect() if r.copies}
    assert got == want and len(got) == docs.count()


def test_odd_rows(spark):
    rows = [(1, "the white whale", "en", "x"), (2, None, "en", "x"), (3, "", None, "x"), (None, "año ñandú ó", "es", "x"), (4, "año ñandú ó", "es", "x"), (4, "año ñandú ó", "es", "x"), (5, "q " * 100_000, "es", "x"), (6, "日本 🙂", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, rate string")
    labelled = df.select("doc_id", F.col("lang").alias("domain")).unionByName(df.limit(1).select(F.lit(6).cast("long").alias("doc_id"), F.lit("en").alias("domain"))).unionByName(
        df.limit(1).select(F.lit(6).cast("long").alias("doc_id"), F.lit("es").alias("domain"))
    )
    got = mixing.document_rates(df, labelled, {"en": 0.5, "es": 0.5, "xx": 3.0}).collect()
    tokens, post, rate, _ = brute([(i, t) for i, t, *_ in rows], [(t, d) for i, t, d, _ in rows if i is not None], {"en": 0.5, "es": 0.5})
    assert sorted((str(r.doc_id), r.n_tokens, round(r.p_es, 6), round(r.rate, 4)) for r in got) == sorted(
        (str(x[0]), n, round(p[1], 6), round(r, 4)) for x, n, p, r in zip(rows, tokens, post, rate)
    )
    assert {r.rate for r in mixing.document_rates(df, labelled.limit(0), {"en": 1.0}).collect()} == {1.0}
    assert {r.rate for r in mixing.document_rates(df, labelled, {"zz": 1.0}).collect()} == {1.0}
    assert mixing.document_rates(df.limit(0), labelled, {"en": 1.0}).count() == 0
    assert mixing.mix(df, labelled.limit(0), {"en": 1.0}).count() == len(rows)


def test_many_tags_without_weight_are_one_domain(spark):
    rows = [(i, "the white whale " * (1 + i % 3), "en") for i in range(6)] + [(10 + i, "año ñandú ó " * (1 + i % 2), "es") for i in range(4)]
    rows += [(100 + i, "zz kk qq jj " * (1 + i % 4), f"t{i:02}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tags = df.select("doc_id", F.col("lang").alias("domain"))
    folded = tags.withColumn("domain", F.when(F.col("domain").startswith("t"), "other").otherwise(F.col("domain")))
    weights = {"en": 0.5, "es": 0.5}
    got, want = (mixing.document_rates(df, t, weights) for t in (tags, folded))
    assert got.columns == ["doc_id", "n_tokens", "p_en", "p_es", "p_other", "rate", "copies"] == want.columns
    assert sorted(map(tuple, got.collect())) == [pytest.approx(tuple(r)) for r in sorted(want.collect())]


def test_a_rare_domain_does_not_set_the_size(spark):
    rows = [(i, "the white whale swam away", "en") for i in range(2000)] + [(5000 + i, "año ñandú ó mañana señor niño", "es") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tags = df.select("doc_id", F.col("lang").alias("domain"))
    weights = {"en": 0.55, "es": 0.45}
    out = mixing.document_rates(df, tags, weights, most=8.0).collect()
    assert all(0 <= r.rate <= 8.0 and r.copies <= 8 for r in out)
    assert min(r.copies for r in out) >= 1 and sum(r.copies for r in out) <= 2000 * 2
    assert all(r.rate > 2 for r in out if r.doc_id >= 5000)
    mixed = mixing.mix(df, tags, weights, most=8.0)
    assert mixed.count() == sum(r.copies for r in out)
    with pytest.raises(ValueError):
        mixing.document_rates(df, tags, weights, most=1.0)


def test_bounded_targets():
    assert mixing.bounded_targets([10.0, 20.0, 5.0], [0.25, 0.5, 0.25], 4.0) == [10.0, 20.0, 10.0]
    assert mixing.bounded_targets([2000.0, 2.0, 9.0], [0.5, 0.5, 0.0], 4.0) == [2000.0, 8.0, 0.0]
    got = mixing.bounded_targets([1000.0, 400.0, 1.0], [0.4, 0.4, 0.2], 4.0)
    assert got == [1000.0, 1000.0, 4.0]
    assert mixing.bounded_targets([3.0, 0.0], [1.0, 0.0], 4.0) == [3.0, 0.0]
