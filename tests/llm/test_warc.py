"""WARC bundles: exact round trip, revisits, seek table, lookups."""

from __future__ import annotations

import hashlib
import io
import os

import pyarrow.parquet as pq
import zstandard
from pyspark.sql import types as T

from shelfscope.llm import queries, warc
from tests.conftest import MEDIUM

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("url", "html", "digest", "first")]])


def brute(rows, least=1000):
    """(id, bytes, digest, type, refers_to) for rows of (id, html)."""
    data = [(i, (h or "").encode()) for i, h in rows]
    best = {}
    for i, p in data:
        if i is not None and len(p) >= least:
            best[p] = max(i, best.get(p, i))
    many = [p for _, p in data]
    out = []
    for i, p in data:
        first = best.get(p) if len(p) >= least and many.count(p) > 1 else None
        revisit = first is not None and i != first
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


def key(r):
    return tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in r)


def test_op1_on_the_table(spark):
    pages = pq.read_table(f"{MEDIUM}/pages.parquet").to_pylist()
    got = [tuple(r) for r in queries.op1_warc(spark, MEDIUM).collect()]
    assert sorted(got, key=key) == sorted(brute([(p["page_id"], p["html"]) for p in pages]), key=key)


ROWS = [
    (1, "http://a/ b\r\nX: y", "x" * 1000), (2, None, "x" * 1000), (9, "u", "x" * 1000), (9, "v", "x" * 1000), (None, "w", "x" * 1000),
    (3, "u", "x" * 999), (4, "u", "x" * 999), (5, "u", None), (6, "é", ""), (7, "u", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40),
    (None, "u", "n" * 2000), (None, "u", "n" * 2000), (8, "u", "L" * 3_000_000), (10, "u", "L" * 3_000_000),
]


def test_odd_rows_and_lookups(spark, tmpdir_path):
    df = spark.createDataFrame([(*r, "d", "f") for r in ROWS], SCHEMA).repartition(2)
    got = [tuple(r) for r in warc.round_trip(df, f"{tmpdir_path}/b").collect()]
    assert sorted(got, key=key) == sorted(brute([(i, h) for i, _, h in ROWS]), key=key)
    wanted = spark.createDataFrame([(7,), (10,), (1,), (404,), (None,)], "page_id long")
    found = {r.record_id: r for r in warc.fetch(spark, f"{tmpdir_path}/b", wanted).collect()}
    assert set(found) == {"urn:x-page:7", "urn:x-page:10", "urn:x-page:1"}
    assert bytes(found["urn:x-page:7"].payload).decode() == ROWS[9][2]
    assert len(found["urn:x-page:10"].payload) == 3_000_000
    assert found["urn:x-page:1"].refers_to == "urn:x-page:9" and found["urn:x-page:1"].payload is None
    assert warc.round_trip(df.limit(0), f"{tmpdir_path}/none").count() == 0


def test_exported_files_are_plain_zstandard(spark, tmpdir_path):
    df = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 300, "", "") for i in range(200)], SCHEMA).repartition(3)
    warc.archive(df, f"{tmpdir_path}/b", frame_bytes=20_000, bundle_bytes=3_000)
    names = [r.bundle for r in warc.export(spark, f"{tmpdir_path}/b", f"{tmpdir_path}/files").collect()]
    assert len(names) > 3 and len(set(names)) == len(names)
    total = 0
    for n in names:
        content = open(f"{tmpdir_path}/files/{n}.warc.zst", "rb").read()
        parts = [warc.unpack(content, f) for f in warc.frames(content)]
        stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content[: sum(f[1] for f in warc.frames(content))]), read_across_frames=True)
        assert stream.read() == b"".join(parts)
        total += b"".join(parts).count(b"WARC-Type: response")
    assert total == 200
    assert sorted(os.listdir(f"{tmpdir_path}/files")) == sorted(f"{n}.warc.zst" for n in names)


def test_index_gives_the_record(spark, tmpdir_path):
    df = spark.createDataFrame([(i, None, f"{i}-" * 800, "", "") for i in range(50)], SCHEMA)
    warc.archive(df, f"{tmpdir_path}/b", frame_bytes=9_000)
    for b in warc.bundles(spark, f"{tmpdir_path}/b").collect():
        table = warc.frames(b.content)
        for r in b.records:
            data = warc.unpack(b.content, table[r.frame])[r.offset : r.offset + r.length]
            assert warc.parse(data)["record_id"] == r.record_id
