"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over
word and word-beginning features; each model also sees the probabilities of
the categories before it.  For training these are out-of-fold predictions, so
a later model learns from inputs of the quality it will meet.  The last
category is the decision.

A category's label is a 0/1 label column, or weak: the decision's label and a
seed term in the text.  Features are chosen on the learning sample by how far
their count among positive rows lies above chance.  Fitting reads a bounded
sample of labelled rows (``MOST_POSITIVE`` and ``MOST_NEGATIVE``, smallest
hashed ids, remainder 0 left out); scoring reads every whole text once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .labelled import sample_texts

MOST_POSITIVE = 6_000
MOST_NEGATIVE = 12_000
MOST_FEATURES = 2_048
LEAST_ROWS = 2
LEAST_Z = 3.0
BEGINNINGS = (4, 5, 6, 7, 8, 9)
FOLDS = 5
THRESHOLD = 0.5

WORD = re.compile(r"[^\W\d_]+")

#: (category, label column or seed terms); the last is the decision.
CHAIN: tuple[tuple[str, str | tuple[str, ...]], ...] = (
    ("junk", "-quality"),
    ("insult", ("idiot", "moron", "clown", "loser", "stupid")),
    ("contempt", ("worthless", "pathetic", "trash", "scum", "disgusting")),
    ("toxic", "toxic"),
)


def features(text: str) -> set[str]:
    """The distinct words of a whole text and their beginnings (marked)."""
    words = set(WORD.findall(text.lower()))
    out = set(words)
    for n in BEGINNINGS:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


@dataclass(frozen=True)
class Sparse:
    """Rows of 0/1 features, and some dense columns beside them."""

    rows: np.ndarray
    cols: np.ndarray
    n: int
    width: int
    dense: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        z = np.bincount(self.rows, w[self.cols], self.n) if len(self.rows) else np.zeros(self.n)
        return z + self.dense @ w[self.width :]

    def back(self, r: np.ndarray) -> np.ndarray:
        g = np.bincount(self.cols, r[self.rows], self.width) if len(self.rows) else np.zeros(self.width)
        return np.concatenate([g, self.dense.T @ r])

    def take(self, keep: np.ndarray) -> Sparse:
        at = np.cumsum(keep) - 1
        ok = keep[self.rows]
        return Sparse(at[self.rows[ok]], self.cols[ok], int(keep.sum()), self.width, self.dense[keep])


def logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, l2: float = 0.05, rounds: int = 150) -> np.ndarray:
    """Weights (features, dense columns; the last dense column is constant and
    not shrunk) by Adam on the weighted logistic loss."""
    w = np.zeros(x.width + x.dense.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    shrink = np.full(len(w), l2)
    shrink[-1] = 0
    total = max(1e-9, weight.sum())
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w), -30, 30)))
        g = (x.back(weight * (p - y)) + shrink * w) / total
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _probability(x: Sparse, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.dot(w), -30, 30)))


@dataclass(frozen=True)
class Chain:
    names: tuple[str, ...]
    vocabulary: dict[str, int] = field(repr=False)
    weights: tuple[np.ndarray, ...] = field(repr=False)

    def hits(self, text: str) -> list[int]:
        """Numbers of the model's features that the text has."""
        known, out = self.vocabulary, []
        for w in set(WORD.findall(text.lower())):
            if w in known:
                out.append(known[w])
            for n in BEGINNINGS:
                if len(w) > n and (b := w[:n] + "*") in known:
                    out.append(known[b])
        return list(set(out))

    def predict(self, texts: list[str]) -> np.ndarray:
        """Probabilities, a column per category in chain order."""
        hits = [self.hits(t) for t in texts]
        rows = np.repeat(np.arange(len(texts)), [len(h) for h in hits])
        cols = np.array([c for h in hits for c in h], np.int64)
        done = np.zeros((len(texts), 0))
        for w in self.weights:
            x = Sparse(rows, cols, len(texts), len(self.vocabulary), np.hstack([done, np.ones((len(texts), 1))]))
            done = np.hstack([done, _probability(x, w)[:, None]])
        return done


def fit_chain(hits: list[list[int]], vocabulary: dict[str, int], labels: np.ndarray, names: tuple[str, ...], weight: np.ndarray) -> Chain:
    """labels: a 0/1 column per category; folds go round by row number."""
    n = len(hits)
    rows = np.repeat(np.arange(n), [len(h) for h in hits])
    cols = np.array([c for h in hits for c in h], np.int64)
    fold = np.arange(n) % FOLDS
    seen, weights = np.zeros((n, 0)), []
    for k in range(len(names)):
        x = Sparse(rows, cols, n, len(vocabulary), np.hstack([seen, np.ones((n, 1))]))
        weights.append(logistic(x, labels[:, k], weight))
        out = np.zeros(n)
        for f in range(FOLDS if k + 1 < len(names) else 0):
            part = logistic(x.take(fold != f), labels[fold != f, k], weight[fold != f])
            out[fold == f] = _probability(x.take(fold == f), part)
        seen = np.hstack([seen, out[:, None]])
    return Chain(names, vocabulary, tuple(weights))


def choose_features(sample: DataFrame) -> dict[str, int]:
    """Features of ``sample`` (text, stratum 0 positive or 1 negative) whose
    positive rows exceed chance by ``LEAST_Z`` standard deviations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for b in batches:
            for text, stratum in zip(b.column(0), b.column(1).to_pylist()):
                for f in features(text.as_py()):
                    counts.setdefault(f, [0, 0])[stratum] += 1
                if len(counts) > 300_000:
                    yield pack(counts)
                    counts = {}
        yield pack(counts)

    def pack(counts: dict[str, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *[pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1)]], names=["f", "a", "b"]
        )

    n = {r["stratum"]: r["count"] for r in sample.groupBy("stratum").count().collect()}
    pos, neg = n.get(0, 0), n.get(1, 0)
    if not pos or not neg:
        return {}
    share = pos / (pos + neg)
    both = sample.select("text", "stratum").mapInArrow(run, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows = F.col("a") + F.col("b")
    z = (F.col("a") - rows * share) / F.sqrt(rows * share * (1 - share))
    top = both.where(F.col("a") >= LEAST_ROWS).withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "f").limit(MOST_FEATURES)
    return {r["f"]: i for i, r in enumerate(top.select("f").collect())}


def fit(docs: DataFrame, labels: DataFrame, chain=CHAIN, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The chain learned from labelled documents outside remainder 0.  Without
    both classes of the decision every decision is 0."""
    common.ship(docs.sparkSession)
    decision = chain[-1][1]
    names = tuple(name for name, _ in chain)
    columns = sorted({s.lstrip("-") for _, s in chain if isinstance(s, str)})
    strata = [(F.col(decision) == 1, MOST_POSITIVE), (F.col(decision) == 0, MOST_NEGATIVE)]
    sample = common.stored(sample_texts(docs, labels, columns, strata, id_col, text_col), "toxicity-sample")
    vocabulary = choose_features(sample)
    empty = Chain(names, vocabulary, ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(0).to_pylist()
            found = [sorted(empty.hits(x)) for x in t]
            seeds = [[1 if not isinstance(s, str) and words & set(s) else 0 for _, s in chain] for words in (set(WORD.findall(x.lower())) for x in t)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), pa.array(seeds, pa.list_(pa.int32())), *b.columns[1:]], names=["hits", "seeds", *b.schema.names[1:]])

    schema = T.StructType([T.StructField("hits", T.ArrayType(T.IntegerType())), T.StructField("seeds", T.ArrayType(T.IntegerType())), *sample.select("id", *columns).schema.fields])
    got = sample.select("text", "id", *columns).mapInArrow(run, schema).orderBy(F.xxhash64("id"), "id").toArrow().to_pylist()
    y = np.array([r[decision] == 1 for r in got], float)
    if not len(y) or y.min() == y.max():
        never = np.zeros(len(vocabulary))
        return Chain(names, vocabulary, tuple(np.concatenate([never, np.zeros(k), [-30.0]]) for k in range(len(chain))))
    target = np.zeros((len(got), len(chain)))
    for k, (_, source) in enumerate(chain):
        if isinstance(source, str):
            target[:, k] = [r[source.lstrip("-")] == (0 if source[0] == "-" else 1) for r in got]
        else:
            target[:, k] = y * np.array([r["seeds"][k] for r in got])
    known = labels.where(F.col(decision).isin(0, 1)).agg(F.avg(decision)).first()[0]
    share = float(np.clip(known or y.mean(), 1e-3, 1 - 1e-3))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return fit_chain([r["hits"] for r in got], vocabulary, target, names, weight)


def with_scores(df: DataFrame, chain: Chain, text_col: str, prefix: str) -> DataFrame:
    """``df`` with a double column ``<prefix><category>`` per category."""
    spark = df.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(chain)
    at = df.columns.index(text_col)
    new = [prefix + n for n in chain.names]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            p = model.predict([t.as_py() or "" for t in b.column(at)])
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(p[:, k].copy()) for k in range(p.shape[1])]], names=[*b.schema.names, *new])

    return df.mapInArrow(run, schema)


def score(df: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, ``p_<category>`` in chain order and
    ``toxic`` (1 where the last probability reaches ``threshold``).  Null texts
    score as empty ones; null or repeated ids keep their rows; other columns
    are not read."""
    rows = with_scores(df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")), chain, "text", "p_")
    return rows.select(
        F.col("id").alias(id_col), *[f"p_{n}" for n in chain.names], (F.col(f"p_{chain.names[-1]}") >= threshold).cast("int").alias("toxic")
    )
