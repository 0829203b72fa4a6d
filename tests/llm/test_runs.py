"""Periodic runs against a direct search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

from pyspark.sql import types as T

from shelfscope.llm import queries, runs
from tests.conftest import SMALL


def brute(words: list, shortest: int = 24) -> list:
    """Every period at every place; a stretch counts if no smaller period fits it."""
    n, found = len(words), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(shortest, 3 * p):
                s = words[i : j + p]
                if not any(all(s[x] == s[x + q] for x in range(len(s) - q)) for q in range(1, p)):
                    found.append((i, j - i + p, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text) -> dict:
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) & 0xFFFFFFFF
    if doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    drop = {i for a, k, p in found for i in range(a + p, a + k)}
    best = sorted(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    start, length, period = best[0] if best else (None, None, None)
    return {
        "doc_id": doc_id, "n_runs": len(found), "start": start, "length": length, "period": period,
        "exponent_milli": 1000 * length // period if best else None,
        "runs_sha256": hashlib.sha256("".join(f"{a},{k},{p}\n" for a, k, p in found).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest(),
    }


def test_minimizer_runs_equal_the_direct_search():
    rng, total, longest = random.Random(3), 0, 0
    for _ in range(400):
        words: list = []
        for _ in range(rng.randint(1, 7)):
            k = rng.choice([1, 2, 3, 5, 8, 9, 13, 14, 20, 21, 40, 70])
            unit = [rng.randrange(rng.choice([1, 2, 3, 1000])) for _ in range(k)]
            words += [unit[i % k] for i in range(int(k * rng.choice([1, 1, 2, 3, 3.2, 4, 6])))]
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = 7
        found = runs.find_runs(words)
        assert found == brute(words), words
        total += len(found)
        longest = max([longest, *[p for _, _, p in found]])
    assert total > 300 and longest >= 40


def test_nested_and_thue_morse_words():
    square = ([0, 1] * 12 + [2]) * 4  # runs of period 2 inside a run of period 25
    assert runs.find_runs(square) == brute(square)
    assert {p for _, _, p in runs.find_runs(square)} == {2, 25}
    morse = [bin(i).count("1") % 2 for i in range(2048)]  # no cube anywhere
    assert runs.find_runs(morse) == []
    # a unit without repeats of its own, three times exactly, and one word short
    unit = list(range(100))
    assert runs.find_runs(unit * 3) == [(0, 300, 100)]
    assert runs.find_runs((unit * 3)[:-1]) == []


def test_a_long_text_of_one_word():
    assert runs.find_runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    long = [b"%d" % (i % 40_000) for i in range(130_000)]
    assert runs.find_runs(long) == [(0, 130_000, 40_000)]


def test_greatest_by_exact_exponent():
    assert runs.greatest([(0, 31, 10), (50, 62, 20), (5, 30, 10)]) == (0, 31, 10)
    assert runs.greatest([]) is None


SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "doc_id" else T.StringType()) for c in ("doc_id", "text", "id", "runs", "start")])


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, None, "x", "y", "z"), (2, "", "x", "y", "z"), (None, "a b " * 20, None, None, None), (3, "a b " * 20, "x", "y", "z"),
        (3, "a b " * 20, "x", "y", "z"), (4, "  \x1c é ü " * 30, "x", "y", "z"), (5, "w\x0bw\x0cw\tw\rw\n" * 6, None, None, None),
        *[(i, " ".join(str(j * i % 7) for j in range(60)), None, None, None) for i in range(10, 60)],
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.asDict() for r in runs.periodic_runs(df, planted=True).drop("n_words").collect()), key=repr)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert runs.periodic_runs(df.limit(0)).count() == 0
    kept = {r["doc_id"]: r for r in runs.periodic_runs(df, with_text=True).collect()}
    assert kept[3]["collapsed"] == "a b" and [tuple(x) for x in kept[3]["runs"]] == [(0, 40, 2)]
    assert kept[1]["collapsed"] == "" and kept[1]["runs"] == []


def test_query_equals_the_direct_search(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in queries.op13_periodic_runs(spark, SMALL).collect()}
    assert got == {d: expected(d, t) for d, t in docs}
    assert sum(r["n_runs"] for r in got.values()) > 0
