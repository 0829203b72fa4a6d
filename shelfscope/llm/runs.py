"""Periodic runs in the words of whole texts, found by multi-scale minimizers.

A *run* is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are identical) and at least ``max(shortest, 3 * q)`` words that no
neighbouring word extends keeping period ``q``.

* Periods up to ``DIRECT`` are found by comparing the words with themselves at
  each lag.
* Longer periods are sought per scale, a range ``low..high`` of periods with
  ``high <= 1.5 * low``.  At a scale, ``high`` consecutive words are one gram
  and the smallest gram of ``2 * low - high + 1`` neighbouring grams is a
  minimizer, so a window spans ``2 * low`` words.  In a run of period ``p`` some
  window and its copy ``p`` words on both lie inside the run (it has ``3 * p``
  words), so both choose the same gram, ``p`` apart; and no equal gram lies
  between, as a gram is at least as long as the period.  Hence every run gives
  a pair of neighbouring equal minimizers at its period's distance.  The pairs
  are seeds that are extended word by word; chance pairs do not extend.
* Grams are compared exactly: words are numbered per text, and the number of a
  gram is the pair of numbers of its two overlapping power-of-two halves.

A stretch found at a multiple of its smallest period lies inside the run of
that smaller period and is dropped.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

SHORTEST = 24
DIRECT = 8
BATCH_BYTES = 4 << 20

Run = tuple[int, int, int]  # start, length, period


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 (null: none)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def scales(most: int) -> Iterator[tuple[int, int]]:
    """Ranges of periods that cover ``DIRECT + 1 .. most``."""
    low = DIRECT + 1
    while low <= most:
        high = low + low // 2
        yield low, high
        low = high + 1


def _stretches(same: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """(start, number) of maximal stretches of at least ``least`` true values."""
    if np.count_nonzero(same) < least:
        return
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    for i in np.flatnonzero(ends - starts >= least):
        yield int(starts[i]), int(ends[i] - starts[i])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minima of all windows of ``w`` values."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


def _mix(x: np.ndarray) -> np.ndarray:
    """An order of the grams that does not follow the text (one to one)."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _seeds(halves: np.ndarray, half: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(position, distance) of neighbouring equal minimizers of one scale.
    ``halves`` numbers the ``half`` words from each position on."""
    n = len(halves) + half - 1  # words
    m = n - high + 1
    window = 2 * low - high + 1
    if m < window:
        return
    grams = _mix(halves[:m].astype(np.uint64) * np.uint64(n + 1) + halves[high - half : high - half + m].astype(np.uint64))
    least = _window_min(grams, window)
    # a gram is a minimizer when it is the minimum of a window that holds it
    cover = np.full(m + window - 1, 0, np.uint64)
    cover[window - 1 : window - 1 + len(least)] = least
    if window > 1:
        cover[: window - 1] = least[0]
        cover[window - 1 + len(least) :] = least[-1]
    top = ~_window_min(~cover, window)[:m]  # the largest of the minima of its windows
    at = np.flatnonzero(top == grams)
    order = np.argsort(grams[at], kind="stable")
    at = at[order]
    gap = np.diff(at)
    near = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (gap >= low) & (gap <= high))
    for i in near:
        yield int(at[i]), int(gap[i])


def _reach(ids: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The maximal stretch around ``i`` in which words equal those ``p`` on:
    (start, end) over positions of the earlier word."""
    end, step = i, 64
    last = len(ids) - p
    while end < last:
        to = min(last, end + step)
        differ = np.flatnonzero(ids[end:to] != ids[end + p : to + p])
        if len(differ):
            end += int(differ[0])
            break
        end, step = to, step * 2
    start, step = i, 64
    while start > 0:
        frm = max(0, start - step)
        differ = np.flatnonzero(ids[frm:start] != ids[frm + p : start + p])
        if len(differ):
            start = frm + int(differ[-1]) + 1
            break
        start, step = frm, step * 2
    return start, end


def find_runs(words: list, shortest: int = SHORTEST) -> list[Run]:
    """Every run of the words as (start, length, period), by start, then
    period.  Fewer than ``shortest`` words have none."""
    n = len(words)
    if n < max(shortest, 3):
        return []
    number = dict(zip(dict.fromkeys(words), range(n)))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    found: set[Run] = set()
    for p in range(1, min(DIRECT, n // 3) + 1):
        for start, k in _stretches(ids[p:] == ids[:-p], max(shortest, 3 * p) - p):
            found.add((start, k + p, p))
    half, halves = 1, ids
    for low, high in scales(n // 3):
        while half * 2 <= high:
            m = len(halves) - half
            pair = halves[:m] * np.int64(n + 1) + halves[half:]
            distinct, halves = np.unique(pair, return_inverse=True)
            half *= 2
            if len(distinct) == m:  # no stretch of ``half`` words occurs twice
                return _primitive(found)
        done: dict[int, list[tuple[int, int]]] = {}  # period -> sorted stretches
        for i, p in _seeds(halves, half, low, high):
            known = done.setdefault(p, [])
            j = bisect_right(known, (i, n))
            if not (j and i < known[j - 1][1]):
                a, b = _reach(ids, i, p)
                known.insert(j, (a, b))
                if b - a + p >= max(shortest, 3 * p):
                    found.add((a, b - a + p, p))
    return _primitive(found)


def _primitive(found: set[Run]) -> list[Run]:
    """Without stretches inside a found one of smaller period (a divisor)."""
    kept: dict[int, tuple[list[int], list[int]]] = {}  # period -> starts, ends
    for p, start, length in sorted((p, start, length) for start, length, p in found):
        for q, (starts, ends) in kept.items():
            i = bisect_right(starts, start) - 1
            if q < p and p % q == 0 and i >= 0 and start + length <= ends[i]:
                break
        else:
            starts, ends = kept.setdefault(p, ([], []))
            starts.append(start)
            ends.append(start + length)
    return sorted(((a, b - a, p) for p, (x, y) in kept.items() for a, b in zip(x, y)), key=lambda r: (r[0], r[2]))


def greatest(runs: list[Run]) -> Run | None:
    """The run of greatest exact length / period (ties: smallest start, then
    period)."""

    def order(a: Run, b: Run) -> int:
        return (b[1] * a[2] - a[1] * b[2]) or (a[0] - b[0]) or (a[2] - b[2])

    return min(runs, key=cmp_to_key(order)) if runs else None


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, length, p in runs:
        drop[start + p : start + length] = True
    return [words[i] for i in np.flatnonzero(~drop)]


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth document (by the crc32 of its decimal id) repeats a stretch
    of its own words from some word on; a null id repeats nothing."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


FIELDS = [
    ("n_words", pa.int64(), T.LongType()),
    ("n_runs", pa.int64(), T.LongType()),
    ("start", pa.int64(), T.LongType()),
    ("length", pa.int64(), T.LongType()),
    ("period", pa.int64(), T.LongType()),
    ("exponent_milli", pa.int64(), T.LongType()),
    ("runs_sha256", pa.string(), T.StringType()),
    ("collapsed_sha256", pa.string(), T.StringType()),
]
SPANS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _row(words: list[bytes], runs: list[Run], collapsed: bytes) -> tuple:
    best = greatest(runs)
    start, length, period = best or (None, None, None)
    listed = "".join(f"{a},{k},{p}\n" for a, k, p in runs)
    return (
        len(words), len(runs), start, length, period, 1000 * length // period if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(),
    )


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False, with_text: bool = False, shortest: int = SHORTEST
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_runs``, the greatest run (``start``,
    ``length``, ``period``, ``exponent_milli``; nulls without a run), digests of
    all runs and of the collapsed words; with ``with_text`` also ``runs`` (every
    run) and ``collapsed`` (the kept words joined by a blank).  ``planted``
    repeats words of every tenth document first.

    Null and empty texts have no words.  Null or repeated ids keep their rows;
    other columns are not read; an empty table gives none.  A text is one task's
    work, whatever its length; no shuffle.
    """
    common.ship(df.sparkSession)
    fields = [T.StructField("id", common.id_type(df, id_col)), *[T.StructField(n, t) for n, _, t in FIELDS]]
    if with_text:
        fields += [T.StructField("runs", SPANS), T.StructField("collapsed", T.StringType())]
    spans = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in b.column(1)]
            for x, y in common.slices(sizes, BATCH_BYTES):
                ids = b.column(0).slice(x, y - x)
                rows, lists, texts = [], [], []
                for doc_id, text in zip(ids.to_pylist(), b.column(1).slice(x, y - x).to_pylist()):
                    words = words_of(text)
                    if planted:
                        words = plant(words, doc_id)
                    found = find_runs(words, shortest)
                    kept = b" ".join(collapse(words, found))
                    rows.append(_row(words, found, kept))
                    if with_text:
                        lists.append([dict(zip(("start", "length", "period"), r)) for r in found])
                        texts.append(kept.decode())
                cols = [ids, *[pa.array(c, t) for c, (_, t, _) in zip(zip(*rows), FIELDS)]]
                if with_text:
                    cols += [pa.array(lists, spans), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    narrow = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_col)
