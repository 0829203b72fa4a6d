"""Repeats across documents against a plain search of all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from shelfscope.llm import prior_factors as pf
from shelfscope.llm import queries
from tests.conftest import SMALL

SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "doc_id" else T.StringType()) for c in ("doc_id", "text", "doc", "copy", "spans", "block")])


def brute(rows, least: int = 50) -> list[tuple]:
    first: dict[bytes, int] = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        if d is not None:
            for i in range(len(t) - least + 1):
                s = t[i : i + least]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        if d is not None:
            for i in range(len(t) - least + 1):
                if first[t[i : i + least]] < d:
                    gone[i : i + least] = b"\1" * least
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=repr)


def corpus(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé🙂") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(4, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 4))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts.insert(rng.randint(0, len(parts)), rng.choice([p, p[a:b]]))
        if rng.random() < 0.4:
            parts.append(passages[0])  # a passage of very many documents
        rows.append((rng.choice([i, i, i - 50, 10**15 + i]), "".join(parts)))
    rows += [(i, rows[3][1]) for i in range(5_000, 5_040)]  # copies
    rows += [(7, rows[3][1]), (7, rows[3][1]), (7, rows[4][1] + "x"), (None, rows[3][1]), (None, None), (8, None), (9, "")]
    rows += [(60, "ab" * 400), (61, "ab" * 300 + "c"), (59, "a" * 49), (62, "a" * 50), (63, "a" * 51)]
    return rows


def test_block_work_equals_a_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(200):
        data = rng.integers(0, 2, rng.integers(60, 400)).astype(np.uint8)
        at = np.sort(rng.choice(len(data) - 24, min(60, len(data) - 24), replace=False))
        owner = rng.integers(0, 5, len(at))
        for least in (16, 21, 24):
            firsts: dict = {}
            for a, o in zip(at, owner):
                s = data[a : a + least].tobytes()
                firsts[s] = min(firsts.get(s, o), o)
            want = [firsts[data[a : a + least].tobytes()] < o for a, o in zip(at, owner)]
            assert pf.repeats(pf._eights(data), at, owner, least).tolist() == want


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_a_plain_search(spark, monkeypatch, small):
    if small:  # many pieces and blocks, and blocks settled in between
        for name, value in (("PIECE_BYTES", 3_000), ("BLOCK_BYTES", 2_000), ("HELD_BYTES", 500), ("HASH_BYTES", 64)):
            monkeypatch.setattr(pf, name, value)
    rows = corpus(4, 150)
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(5)
    assert rows_of(pf.remove_repeats(df)) == brute(rows)
    assert rows_of(pf.remove_repeats(df, least=16)) == brute(rows, 16)
    kept = pf.remove_repeats(df, with_text=True).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in kept)


def test_a_long_text_and_its_copy(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_500_000))
    df = spark.createDataFrame([(1, long, *"xyzw"), (2, "other " + long[7:] + "é", *"xyzw"), (3, "a" * 1_000_000, *"xyzw")], SCHEMA)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in pf.remove_repeats(df).collect()}
    assert got == {1: (0, 0), 2: (1_499_993, 1), 3: (0, 0)}


def test_no_documents(spark):
    assert pf.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_a_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op12_suffix_dedup(spark, SMALL)) == brute(rows)
