"""Vector helpers: validity, spherical k-means on a bounded sample, and the
Arrow views used by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floats(df: DataFrame, col: str) -> Column:
    """The vector column as it is if of float or double, else as doubles."""
    return df[col] if df.schema[col].dataType.simpleString() in ("array<float>", "array<double>") else df[col].cast("array<double>")


def usable(vec: str) -> Column:
    """Neither null nor zero, with finite components only."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vec).isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(lists: pa.Array) -> np.ndarray:
    """A list array of equally long vectors as rows, in double precision."""
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(lists), -1)


def unit(x: np.ndarray) -> np.ndarray:
    if not x.size:
        return x
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def sample(df: DataFrame, key: str, vec: str, most: int) -> np.ndarray:
    """At most ``most`` vectors of the commonest length, chosen by a hash of
    ``key``: what the centroids are fitted on."""
    top = df.groupBy(F.size(vec).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if top is None:
        return np.zeros((0, 0))
    rows = df.where(F.size(vec) == top["n"]).select(vec, F.xxhash64(key).alias("h")).orderBy("h").limit(most).select(vec)
    got = rows.toArrow().column(0).combine_chunks()
    return matrix(got) if len(got) else np.zeros((0, 0))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Unit centroids (at most ``k``) that maximise the cosine to the nearest."""
    x = unit(x)
    if not x.size:
        return x
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 1e-9, total / np.maximum(norm, 1e-9)[:, None], c)
    return c
