"""NN-descent search against brute force: recall, exact scores, odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq

from shelfscope.llm import nn_descent, queries, vectors
from tests.conftest import MEDIUM


def brute(rows, every, top):
    """query_id -> [(vec_id, score)] for rows of (id, vec), repeats once."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    lengths = [len(v) for _, v in good]
    if not good:
        return {}
    usual = max(set(lengths), key=lambda n: (lengths.count(n), -n))
    good = [(i, np.array(v, np.float64)) for i, v in good if len(v) == usual]
    out = {}
    for q, a in good:
        if q % every == 0:
            out[q] = sorted(((i, float(a @ b)) for i, b in good if i != q), key=lambda x: (-x[1], x[0]))[:top]
    return out


def test_op9_recall_and_scores_on_the_table(spark):
    t = pq.read_table(f"{MEDIUM}/embeddings.parquet").to_pylist()
    want = brute([(r["vec_id"], r["embedding"]) for r in t], 20, 20)
    got: dict = {}
    for r in queries.op9_nearest_neighbours(spark, MEDIUM).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    vec = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in t}
    hit = 0
    for q, rows in got.items():
        assert [n for n, _, _ in rows] == list(range(1, 21))
        assert all(abs(s - vec[q] @ vec[v]) < 1e-12 for _, v, s in rows)
        assert [(v, s) for _, v, s in rows] == sorted(((v, s) for _, v, s in rows), key=lambda x: (-x[1], x[0]))
        hit += len({v for _, v, _ in rows} & {v for v, _ in want[q]})
    assert hit / (20 * len(want)) >= 0.95


def test_recall_over_many_blocks(spark, monkeypatch):
    """Several cells and blocks, a crowd of near copies and one of copies."""
    monkeypatch.setattr(nn_descent, "BLOCK", 150)
    monkeypatch.setattr(nn_descent, "SEARCH_BLOCK", 200)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 16))
    x[:200] = x[0] + rng.normal(size=(200, 16)) * 0.05
    x[200:300] = x[200]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    want = brute(rows, 20, 10)
    got: dict = {}
    for r in nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, top=10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    share = [len(got[q] & {v for v, _ in w}) / 10 for q, w in want.items()]
    assert np.mean(share) >= 0.93
    assert all(got[q] == {v for v, _ in want[q]} for q in (200, 220, 240, 260, 280))


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [2.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (40, [1.0]), (None, [1.0, 1.0]), (60, [-1.0, 0.5]), (9, [0.0, 1.0]), (80, [])]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, node string, rank int")
    got: dict = {}
    for r in nn_descent.nearest(df, every=20, top=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 20, 3)
    assert {q: [(v, s) for _, v, s in sorted(r)] for q, r in got.items()} == want
    assert nn_descent.nearest(df.limit(0)).count() == 0
    assert nn_descent.nearest(df.where("vec_id = 20")).count() == 0


def test_descent_goes_on_until_the_graph_settles(spark, monkeypatch):
    """Vectors without cluster structure, from a poor first graph."""
    monkeypatch.setattr(nn_descent, "BLOCK", 64)
    x = np.random.default_rng(4).normal(size=(2500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vec array<double>")
    nn_descent.common.ship(spark)
    coded = nn_descent._coded(nodes, vectors.spherical_kmeans(x, 40))
    got: dict = {}
    for r in nn_descent.build_graph(coded, 16).collect():
        got.setdefault(r.u, set()).add(r.v)
    sim = x @ x.T
    np.fill_diagonal(sim, -np.inf)
    near = np.argsort(-sim, axis=1)[:, :16]
    share = np.mean([len(got[i] & set(row.tolist())) / 16 for i, row in enumerate(near)])
    assert share >= 0.9, share
