"""Embedding near-dedup against all pairs."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

from shelfscope.llm import embedding_dedup, queries, vectors
from tests.conftest import MEDIUM


def brute(rows, threshold):
    """(id, n_links, component_id, kept) for rows of (id, vec, label)."""

    def good(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if good(a, la) and good(b, lb) and la == lb and len(a) == len(b):
                a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for k in links[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        seen |= group
        least = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        for k in group:
            d = rows[k][0]
            out[k] = (d, len(links[k]), least, None if d is None or least is None else d == least)
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_op10_on_the_table(spark):
    t = pq.read_table(f"{MEDIUM}/embeddings.parquet").to_pylist()
    want = brute([(r["vec_id"], r["embedding"], r["label"]) for r in t], 0.93)
    got = [tuple(r) for r in queries.op10_embedding_dedup(spark, MEDIUM).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("threshold,cell_rows,block", [(0.93, 20, 7), (0.6, 10, 16), (0.99, 5, 3)])
def test_links_across_cells_and_blocks(spark, threshold, cell_rows, block):
    rng = np.random.default_rng(int(threshold * 100))
    base = rng.normal(size=(25, 6))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.3, base + rng.normal(size=base.shape) * 0.12, base[:4] * 2, rng.normal(size=(60, 6))])
    rows = [(i, [float(c) for c in v], i % 2) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in embedding_dedup.near_duplicates(df, threshold, cell_rows=cell_rows, block=block).collect()]
    assert sorted(got) == sorted(brute(rows, threshold))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (3, [2.0, 0.01], 1), (2, [1.0, 0.0], 2), (1, [1.0, 0.0], None),
        (6, None, 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.001], 1), (None, [0.0, 1.0], 3), (13, [-1.0, 0.0], 1), (14, [1e300, 0.0], 1), (15, [-0.0, 5.0], 3),
    ]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "vec_id long, embedding array<double>, label int, cls string, n string, id string")
    got = [tuple(r) for r in embedding_dedup.near_duplicates(df).collect()]
    safe = [(i, None if v and any(c is not None and abs(c) > 1e200 for c in v) and not any(c is None or not np.isfinite(c) for c in v) else v, la) for i, v, la in rows]
    want = brute([(i, [1.0, 0.0] if i == 14 else v, la) for i, v, la in safe], 0.93)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_spherical_kmeans_centroids_are_unit():
    x = np.random.default_rng(1).normal(size=(300, 5))
    c = vectors.spherical_kmeans(x, 7)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and len(c) == 7
