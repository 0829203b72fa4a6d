"""SimHash near-duplicates against a brute-force version."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from shelfscope.llm import queries, simhash
from shelfscope.llm.components import components
from tests.conftest import MEDIUM

SCHEMA = T.StructType([T.StructField(c, T.StringType() if c != "doc_id" else T.LongType()) for c in ("doc_id", "text", "fp", "root", "id")])


def plain_fingerprint(text: str) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(rows: list[tuple]) -> list[tuple]:
    """(id, hex, smallest reachable id) for rows of (id, text)."""
    fp = np.array([plain_fingerprint(t or "") for _, t in rows], np.uint64)
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp[i] ^ fp[:i]) <= 3):
            a, b = find(i), find(int(j))
            group[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{int(f):016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fp))]


def key(r):
    return tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in r)


def test_fingerprint_equals_the_definition():
    rng = random.Random(3)
    for t in ["", " \t\n", "One", "one two", "ÀB c\x0bd\x1ce\xa0f", "É É É É", *(" ".join(rng.choice(["a", "B", "ñ", "c\n"]) for _ in range(n)) for n in range(3, 60))]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_op2_on_the_table(spark):
    docs = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    want = brute([(d["doc_id"], d["text"]) for d in docs])
    got = [tuple(r) for r in queries.op2_simhash(spark, MEDIUM).collect()]
    assert sorted(got) == sorted(want)
    assert any(a != c for a, _, c in got)


def test_radius_and_small_blocks(spark):
    """Fingerprints a few bits apart, in blocks of a few rows: no link lost."""
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(30)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.fp: r.root for r in simhash.classes(df, radius=3, block=3).collect()}
    arr = np.array(signed, np.int64).view(np.uint64)
    root = {x: x for x in signed}
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(signed):
            m = min(root[signed[j]] for j in np.flatnonzero(np.bitwise_count(arr[i] ^ arr) <= 3))
            changed, root[x] = changed or m < root[x], min(m, root[x])
    assert got == root


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(90_000))
    rows = [(0, ""), (5, None), (7, " \n"), (3, "a b c d e"), (2, "A b C d e"), (9, long), (9, long), (8, long), (None, long), (None, "only here"), (4, "x")]
    df = spark.createDataFrame([(i, t, "1", "2", None) for i, t in rows], SCHEMA)
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted([(0, ""), (2, "A b C d e"), (4, "x"), (8, long), (None, "only here")], key=key)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(8)
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(500, i) for i in range(400, 480)]
    loops = [(900, 900), (901, 902), (902, 901), (901, 902)]
    edges = path + star + loops
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {i: 400 for i in [*range(401, 480), 500]} | {902: 901}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
