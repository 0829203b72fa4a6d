"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled 1) and unlabelled web text (every document of the
learning folds, labels ignored) are told apart by minimising the non-negative
unbiased risk

    pi E_P[loss(g)] + max(0, E_U[loss(-g)] - pi E_P[loss(-g)])

with logistic loss and a linear score ``g``.  No negative label is read.  The
measures of a text are shares of defects (weights at most 0), evidence of
running prose (letters, plain words, words in sentences, distinct words;
weights at least 0) and the shares of its words' shapes in hashed buckets,
whose meaning only the fit decides.  The score is the sigmoid of ``g`` times the
amount of text, which is full from four words in a sentence (or eight without)
on: an empty text reaches at most 0.28, one word 0.37.

The class prior ``pi`` is estimated from positives and unlabelled text alone: a plain
positive-against-unlabelled fit ranks both, and over all thresholds the ratio
of the unlabelled to the positive share above it is least, with a margin for
the number of rows, where only positives are left.

Nothing is sampled: a text's measures are a short byte string, stored once, and
every step of the fit (Newton steps with a line search) sums over all of them;
the driver sees sums whose number does not depend on the rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .labelled import remainder

THRESHOLD = 0.3
ROUNDS = 40
#: Variance of the Gaussian prior of a weight; it fades with the positives.
VARIANCE = 3.0
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01)
BINS = 2_000
#: Sums travel as multiples of this, so that their order does not matter.
UNIT = 2.0**-24

DEFECTS = ["symbols", "bars", "capitals", "shouts", "top_word", "same_as_last", "digits", "long_words", "short_words", "no_letter", "same_lines", "bigrams"]
EVIDENCE = ["letters", "plain", "sentences", "distinct"]
#: Hashed buckets of word shapes, and the share at which one is half saturated.
SHAPES, SHAPE_HALF = 32, 0.05
SIZE = len(DEFECTS) + len(EVIDENCE) + SHAPES
SIGNS = np.repeat([-1, 1, 0], [len(DEFECTS), len(EVIDENCE), SHAPES + 1])
#: Where each defect is half saturated.
HALF = np.array([0.03, 0.05, 0.3, 0.05, 0.2, 0.05, 0.2, 0.2, 0.5, 0.2, 0.5, 0.3])
#: Words that evidence needs to count in full.
FULL = 4

_CLASS = np.zeros(256, np.uint8)
_CLASS[[ord(c) for c in "#$%&*@^~<>={}[]\\_+"]] = 1
_CLASS[ord("|")] = 2
_CLASS[ord("!")] = 3
_CLASS[ord("0") : ord("9") + 1] = 4
_CLASS[[ord(c) for c in " \t\n\r\x0b\x0c"]] = 5
#: Shape classes of bytes: blanks, lower case and beyond ASCII (a), upper case
#: (A), digits (0), sentence marks (.), quotes and joints (-), other (#).
_SHAPE = bytes(
    32 if c < 33 else ord("a") if c >= 128 or chr(c).islower() else ord("A") if chr(c).isupper()
    else ord("0") if chr(c).isdigit() else ord(".") if chr(c) in ".,;:?" else ord("-") if chr(c) in "'\"()-/" else ord("#")
    for c in range(256)
)
_ENDS = frozenset(".?!…。？！")


def shape_shares(classes: bytes) -> np.ndarray:
    """Shares of the words in each bucket of shapes; a shape is the word's
    byte classes with repeats collapsed ("Hello," is upper, lower, mark)."""
    kind = np.frombuffer(classes, np.uint8)
    shapes = Counter(kind[np.append(True, kind[1:] != kind[:-1])].tobytes().split())
    out = np.zeros(SHAPES)
    for shape, k in shapes.items():
        out[zlib.crc32(shape[:12]) % SHAPES] += k
    return out / max(1, shapes.total())


def _amount(n: int, in_sentences: int) -> np.uint8:
    return np.uint8(round(255 * min(1.0, (1.5 + n / 2 + in_sentences / 2) / (1.5 + FULL))))


def measures(text: str) -> np.ndarray:
    """The measures of a whole text and last the amount of text, 0 to 1 in steps
    of 1/255 as bytes; the measures of a text without words are 0."""
    words = text.split()
    if not words:
        return np.append(np.zeros(SIZE, np.uint8), _amount(0, 0))
    utf8 = text.encode("utf-8", "replace")
    data, classes = np.frombuffer(utf8, np.uint8), utf8.translate(_SHAPE)
    kinds = np.bincount(_CLASS[data], minlength=6)
    chars, n = max(1, len(data) - int(kinds[5])), len(words)
    counts = Counter(words)
    caps = long = short = signs = plain = 0
    for w, k in counts.items():
        if len(w) > 20:
            long += k
        elif len(w) == 1:
            short += k
        upper = w.isupper()
        if upper:
            caps += k
        core = w.strip(".,;:?'\"()")
        if not core.isalpha():
            if not any(map(str.isalpha, w)):
                signs += k
        elif not upper or len(core) == 1:
            plain += k
    last = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    raw = np.array(
        [
            kinds[1] / chars,
            kinds[2] / n,
            caps / n if n >= 3 else 0.0,
            kinds[3] / n,
            max(counts.values()) / n if n >= 10 else 0.0,
            last / n,
            kinds[4] / chars,
            long / n,
            max(0.0, short / n - 0.2),
            signs / n,
            1 - len(set(lines)) / max(1, len(lines)) if len(lines) > 2 else 0.0,
            1 - pairs / (n - 1) if n >= 10 else 0.0,
        ]
    )
    ends = np.flatnonzero([w[-1] in _ENDS for w in words])
    stretch = np.diff(ends, prepend=-1)
    stretch = stretch[(stretch >= FULL) & (stretch <= 80)].sum()
    full = min(1.0, n / FULL)
    evidence = np.array(
        [
            full * (classes.count(b"a") + classes.count(b"A")) / chars,
            full * plain / n,
            stretch / n,
            full * min(1.0, len(counts) / min(n, 20)),
        ]
    )
    shares = shape_shares(classes)
    got = np.concatenate([raw / (raw + HALF), np.clip(evidence, 0, 1), full * shares / (shares + SHAPE_HALF)])
    return np.append(np.rint(got * 255).astype(np.uint8), _amount(n, int(stretch)))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / 255.0 if x.dtype == np.uint8 else x.astype(np.float64)


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of measures; a further last column is the amount."""
        x = np.atleast_2d(_unit(x))
        d = len(self.weights)
        if not d:
            return np.full(len(x), 0.5)
        p = _sigmoid(x[:, :d] @ np.array(self.weights) + self.bias)
        return p * x[:, d] if x.shape[1] > d else p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Sums:
    """Means over positives (0) and unlabelled text (1): the losses of g and -g
    for every weight vector asked, and for the first one the sums that
    gradients and curvatures need."""

    n: np.ndarray
    plus: np.ndarray
    minus: np.ndarray
    x: np.ndarray
    sx: np.ndarray
    sxx: np.ndarray


def partial_sums(x: np.ndarray, kind: np.ndarray, ws: np.ndarray) -> np.ndarray:
    """The sums over some rows as one vector (two halves, one per kind)."""
    x = np.hstack([_unit(x), np.ones((len(x), 1))])
    parts = []
    for k in (0, 1):
        xk = x[kind == k]
        g = xk @ ws.T
        s = _sigmoid(g[:, 0])
        plus, minus = np.logaddexp(0, -g).sum(0), np.logaddexp(0, g).sum(0)
        parts += [[len(xk)], plus, minus, xk.sum(0), s @ xk, ((xk * (s * (1 - s))[:, None]).T @ xk).ravel()]
    return np.concatenate([np.asarray(v, np.float64) for v in parts])


def unpack(v: np.ndarray, k: int, d: int) -> Sums:
    halves = v.reshape(2, -1)
    n = np.maximum(halves[:, :1], 1)
    a = np.split(halves / n, np.cumsum([1, k, k, d, d]), axis=1)
    return Sums(halves[:, 0], a[1], a[2], a[3], a[4], a[5].reshape(2, d, d))


Total = Callable[[np.ndarray], Sums]


def risk(s: Sums, prior: float, i: int = 0) -> float:
    return float(prior * s.plus[0, i] + max(0.0, s.minus[1, i] - prior * s.minus[0, i]))


def _slopes(s: Sums, prior: float) -> tuple[np.ndarray, np.ndarray]:
    if s.minus[1, 0] >= prior * s.minus[0, 0]:
        return s.sx[1] - prior * s.x[0], s.sxx[1]
    return prior * (s.sx[0] - s.x[0]), prior * s.sxx[0]


def plain_risk(s: Sums, _: float, i: int = 0) -> float:
    return float(s.plus[0, i] + s.minus[1, i]) / 2


def _plain_slopes(s: Sums, _: float) -> tuple[np.ndarray, np.ndarray]:
    return (s.sx[0] - s.x[0] + s.sx[1]) / 2, (s.sxx[0] + s.sxx[1]) / 2


def minimise(total: Total, d: int, prior: float, plain: bool = False, signs: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias last) of least risk plus half their squares over ``VARIANCE``
    and the number of positives, by projected Newton steps; of each step the best of ``STEPS`` lengths is taken,
    until none lowers the risk by a millionth.  A weight keeps its sign where
    ``signs`` is 1 or -1.  ``plain``: positives against unlabelled text as if
    the latter were negative."""
    signs = np.zeros(d) if signs is None else signs
    value, slopes = (plain_risk, _plain_slopes) if plain else (risk, _slopes)
    w = np.zeros(d)
    s = total(w[None])
    ridge = np.append(np.full(d - 1, 1 / (VARIANCE * max(1, s.n[0]))), 1e-9)
    now = value(s, prior)
    for _ in range(ROUNDS):
        grad, curve = slopes(s, prior)
        grad = grad + ridge * w
        free = ~((signs != 0) & (w == 0) & (grad * signs >= 0))
        step = np.zeros(d)
        step[free] = np.linalg.solve((curve + np.diag(ridge + 1e-6))[np.ix_(free, free)], grad[free])
        tried = np.array([w - t * step for t in STEPS])
        tried = np.where(tried * signs < 0, 0.0, tried)
        s = total(tried)
        values = [value(s, prior, i) + float(ridge @ t**2) / 2 for i, t in enumerate(tried)]
        best = int(np.argmin(values))
        if not values[best] < now - 1e-6 * max(now, 1e-3):
            break
        w, now = tried[best], values[best]
        if best:
            s = total(w[None])
    return w


def least_ratio(positive: np.ndarray, unlabelled: np.ndarray, sure: float = 0.1) -> float:
    """The class prior from histograms of a ranking score (ascending bins)."""
    p, u = (np.cumsum(h[::-1]) for h in (positive, unlabelled))
    margin = sum(np.sqrt(np.log(4 / sure) / (2 * max(1, c[-1]))) for c in (p, u))
    qp, qu = p / max(1, p[-1]), u / max(1, u[-1])
    seen = qp > 0
    if not seen.any():
        return 0.5
    ratio = qu[seen] / qp[seen]
    at = int(np.argmin(ratio + margin / qp[seen]))
    return float(np.clip(ratio[at], 0.02, 0.98))


def _bins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    g = _unit(x) @ w[:-1] + w[-1]
    return np.clip(((g + 10) * (BINS / 20)).astype(int), 0, BINS - 1)


def _model(w: np.ndarray, prior: float) -> Model:
    w = np.round(w, 5)
    return Model(tuple(map(float, w[:-1])), float(w[-1]), prior)


def nn_pu(p: np.ndarray, u: np.ndarray, prior: float) -> Model:
    """The fit over rows in memory."""
    x, kind = np.vstack([p, u]), np.repeat([0, 1], [len(p), len(u)])
    d = x.shape[1] + 1
    return _model(minimise(lambda ws: unpack(partial_sums(x, kind, ws), len(ws), d), d, prior), prior)


def _summed(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """``part`` summed over all rows (``kind``, ``x``): one vector per task, added up
    by position in Spark; the driver gets ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(size)
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                few = b.slice(i, 4096)
                x = np.frombuffer(b"".join(few.column(1).to_pylist()), np.uint8).reshape(few.num_rows, SIZE + 1)[:, :SIZE]
                acc += part(x, few.column(0).to_numpy(zero_copy_only=False))
        at = np.flatnonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.rint(acc[at] / UNIT).astype(np.int64))], names=["at", "v"])

    got = rows.select("kind", "x").mapInArrow(run, "at int, v long").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[got.column("at").to_numpy()] = got.column("v").to_numpy() * UNIT
    return out


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and measures ``x`` (binary) of every row; null texts are empty."""
    common.ship(docs.sparkSession)
    rows = docs.select(docs[text_col].cast("string").alias("text"), docs[id_col].alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [measures(t.as_py() or "").tobytes() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.binary())], names=["id", "x"])

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("x", T.BinaryType())]))


def fit_measured(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """The model learned from stored measures of the folds whose remainder is
    not 0.  Positives are the ids labelled 1 and nothing else, each once (of a
    repeated id the row with the smallest measures); unlabelled text is every
    row.  Without a positive every score is 0.5."""
    learn = rows.where(remainder(F.col("id")) != 0)
    trusted = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
    trusted = trusted.where("low = 1 and high = 1").select("id")
    once = learn.groupBy("id").agg(F.min("x").alias("x")).join(trusted, "id", "left_semi")
    both = common.stored(
        once.select(F.lit(0).alias("kind"), "x").unionByName(learn.select(F.lit(1).alias("kind"), "x")), "quality-rows"
    )
    d = SIZE + 1

    def total(ws: np.ndarray) -> Sums:
        size = 2 * (1 + 2 * len(ws) + 2 * d + d * d)
        return unpack(_summed(both, lambda x, kind: partial_sums(x, kind, ws), size), len(ws), d)

    if not total(np.zeros((1, d))).n[0]:
        return Model((), 0.0, 0.5)
    rank = minimise(total, d, 0.5, plain=True, signs=SIGNS)
    hist = _summed(both, lambda x, kind: np.bincount(kind * BINS + _bins(x, rank), minlength=2 * BINS).astype(float), 2 * BINS)
    prior = least_ratio(hist[:BINS], hist[BINS:])
    return _model(minimise(total, d, prior, signs=SIGNS), prior)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """``fit_measured`` over the measures of all ``docs``."""
    return fit_measured(common.stored(measured(docs, id_col, text_col), "quality-measures"), labels, id_col, label_col)


def with_scores(df: DataFrame, model: Model, text_col: str, out: str) -> DataFrame:
    """``df`` with a double column ``out``; null texts are scored as empty ones."""
    common.ship(df.sparkSession)
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([measures(t.as_py() or "") for t in b.column(at)], np.uint8).reshape(b.num_rows, SIZE + 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.scores(x))], names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def score_measured(rows: DataFrame, model: Model, id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per measured row: id, ``held_out``, ``score`` (0 to 1, higher:
    label 1 likelier) and ``predicted`` (1 from ``threshold`` on)."""
    schema = T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, SIZE + 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], names=["id", "score"])

    return rows.select("id", "x").mapInArrow(run, schema).select(
        F.col("id").alias(id_col),
        F.coalesce(remainder(F.col("id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``score_measured`` of the measures of ``df``.

    Null texts score as empty ones.  A row without id is never held out and
    never learned from.  Repeated rows score alike; other columns are not
    read, so labels, language, source and id cannot reach the score.
    """
    return score_measured(measured(df, id_col, text_col), model, id_col, threshold)


def learn_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``fit`` and ``score`` of the same documents; every text is measured once."""
    rows = common.stored(measured(docs, id_col, text_col), "quality-measures")
    return score_measured(rows, fit_measured(rows, labels, id_col, label_col), id_col)
