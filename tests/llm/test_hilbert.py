"""Hilbert sharding: the curve itself, and the laws of the query."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import hilbert, queries
from tests.conftest import MEDIUM


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_unit_steps(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(dims)))
    got = df.withColumn("h", hilbert.hilbert_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()
    order = [tuple(r)[:dims] for r in sorted(got, key=lambda r: r.h)]
    assert sorted(r.h for r in got) == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(order, order[1:]))


def check_rows(rows, shards, n):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sum(map(len, by.values())) == n
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert all(a.curve <= b.curve for a, b in zip(ordered, ordered[1:]))


def test_op7_on_the_table(spark):
    docs = {d["doc_id"]: d["text"] for d in pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()}
    rows = queries.op7_hilbert_shards(spark, MEDIUM).collect()
    check_rows(rows, 16, len(docs))
    for r in rows:
        data = docs.pop(r.doc_id).encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert not docs


def test_shards_prune(spark):
    s = queries.op7_hilbert_shards(spark, MEDIUM)
    m = hilbert.manifest(s).collect()
    assert sum(r.rows for r in m) == s.count()
    spread = [r.max_dim_size - r.min_dim_size for r in m]
    whole = s.agg(F.max("dim_size") - F.min("dim_size")).first()[0]
    assert sum(spread) / len(spread) < 0.7 * whole


def test_odd_rows(spark):
    rows = [(i % 7 if i % 5 else None, "x" * (i % 3) if i % 4 else None, None if i % 6 == 0 else "hot", i, "s") for i in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, curve long, size string")
    out = hilbert.shard(df.withColumnRenamed("size", "shard"), {"lang": "hash", "size": "log"}, shards=16).collect()
    check_rows(out, 16, 70)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, len(t or "") + 1) for i, t, *_ in rows)
    assert {r.text_crc32 for r in out if r.size == 1} == {0}
    few = hilbert.shard(df.limit(3), {"lang": "hash", "curve": "log"}, shards=16).collect()
    check_rows(few, 16, 3)
    assert hilbert.shard(df.limit(0), {"lang": "hash", "size": "log"}).count() == 0


def test_written_shards_hold_every_row(spark, tmpdir_path):
    df = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    s = queries.op7_hilbert_shards(spark, MEDIUM)
    hilbert.write_shards(df, s, f"{tmpdir_path}/shards")
    back = spark.read.parquet(f"{tmpdir_path}/shards")
    assert back.count() == df.count()
    assert back.groupBy("shard").count().count() == 16
