"""Repeats of at least ``least`` bytes across documents, removed by
longest-previous-factor arrays.

A byte goes if some string of ``least`` bytes that covers it also starts in a
document with a smaller id; the first document keeps it.  Suffixes are compared
in suffix order, block by block:

* Every window of ``least`` bytes belongs to the block of its *minimizer*, the
  smallest hash of its ``GRAM``-byte grams, so equal windows meet in one block
  whatever document they are in.  Neighbouring windows with the same minimizer
  travel as one stretch of text.
* In a block the windows are sorted as suffixes to a depth of ``least`` bytes.
  For every suffix the previous and the next entry of a smaller document in
  suffix order hold its longest earlier match; the window is a repeat if either
  shares ``least`` bytes with it.
* Texts are packed into *pieces* of several MB, one row each.  A piece first
  tells the blocks which minimizers it holds (48-bit hashes, four bytes each
  after compression); a block answers with a bit for every one that another
  piece holds too.  Only stretches whose minimizer is shared travel as text, so
  what is shuffled beyond that follows the repeats.
* A piece merges equal stretches of its own: all but the first document's are
  repeats at once, and only the first's travels.  Grams that very many documents
  hold come last in the hash order, so a window that holds anything rarer goes
  elsewhere.  So a passage that a third of all documents share reaches its block
  about once per piece.
* A block that holds much text is compared in between and goes on without the
  windows found, as their first holder stays.
* The windows found are merged to byte ranges, which meet the pieces once.

The number of blocks follows the bytes of the table, so a block's size does not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

GRAM = 16
PIECE_BYTES = 4 << 20
HASH_BYTES = 1 << 20
BLOCK_BYTES = 2 << 20  # text bytes per block
HELD_BYTES = 24 << 20
COMMON_BITS = 20
COMMON_SHARE = 0.005  # a gram in this share of the sampled documents is common
SAMPLED = 20_000  # expected number of documents that the common grams are taken from


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    return np.array(np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)))


def gram_hashes(data: np.ndarray, common_grams: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every position on; grams marked in
    the table of common ones are larger than all others."""
    e = _eights(data)
    x = _mix(e[:-8] ^ _mix(e[8:])) >> np.uint64(1)
    return x | (common_grams[x & np.uint64(len(common_grams) - 1)].astype(np.uint64) << np.uint64(63))


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


def stretches(text: bytes, least: int, common_grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring windows with one minimizer: minimizer, first
    window, last window.  Long texts are hashed in slices."""
    data = np.frombuffer(text, np.uint8)
    n = len(data) - least + 1
    parts = []
    for a in range(0, n, HASH_BYTES):
        b = min(n, a + HASH_BYTES)
        parts.append(window_min(gram_hashes(data[a : b + least - 1], common_grams), least - GRAM + 1))
    mins = np.concatenate(parts) if len(parts) > 1 else parts[0]
    cut = np.flatnonzero(mins[1:] != mins[:-1]) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [n])) - 1
    return mins[first], first, last


# ---------------------------------------------------------------- one block


def _starts_and_counts(counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``offsets[i] + 0 .. counts[i] - 1`` for every i, one after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(offsets - before, counts)


def suffix_order(words: np.ndarray, at: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices into ``at`` of the suffixes whose first ``least`` bytes start
    with different owners too, in suffix order, and the bytes (0 or ``least``)
    that each shares with the one before it.

    ``words`` holds the eight bytes from every position on.  Eight bytes are
    sorted at a time; a suffix in a group of a single owner has no earlier match
    and goes no deeper.
    """
    index = np.arange(len(at))
    group = np.zeros(len(at), np.int64)
    new = np.zeros(len(at), bool)
    for depth in sorted({*range(0, least - 7, 8), least - 8}):
        if not len(index):
            break
        key = words[at[index] + depth].byteswap()
        order = np.argsort(key) if depth == 0 else np.lexsort((key, group))
        index, group, key = index[order], group[order], key[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        who = owner[index]
        mixed = (np.minimum.reduceat(who, heads) != np.maximum.reduceat(who, heads))[group]
        index, group, new = index[mixed], group[mixed], new[mixed]
    return index, np.where(new, 0, least)


def earlier_match(owner: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Whether the previous entry with a smaller owner shares ``least`` bytes.
    ``lcp`` is the prefix shared with the entry before.  An entry that is no
    smaller is passed by following its own pointer, taking the least prefix on
    the way."""
    prev = np.arange(-1, len(owner) - 1)
    shared = lcp.copy()
    todo = np.flatnonzero(shared >= least)  # the first entry shares nothing
    while len(todo):
        todo = todo[owner[prev[todo]] >= owner[todo]]
        p = prev[todo]
        shared[todo] = np.minimum(shared[todo], shared[p])
        prev[todo] = prev[p]
        todo = todo[shared[todo] >= least]
    return shared >= least


def repeats(words: np.ndarray, at: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """Which windows have a longest previous factor of at least ``least``."""
    index, lcp = suffix_order(words, at, owner, least)
    who = owner[index]
    found = np.zeros(len(at), bool)
    if len(index):
        back = earlier_match(who[::-1], np.concatenate(([0], lcp[:0:-1])), least)[::-1]
        found[index] = earlier_match(who, lcp, least) | back
    return found


class Block:
    """Stretches of one block: text, and per stretch its document's id, piece
    and row in the piece, and its start and length."""

    def __init__(self, least: int, common_grams: np.ndarray):
        self.least, self.common = least, common_grams
        self.texts: list[bytes] = []
        self.facts: list[np.ndarray] = []
        self.size = 0

    def add(self, facts: np.ndarray, text: bytes) -> None:
        self.texts.append(text)
        self.facts.append(facts)
        self.size += len(text)

    def settle(self) -> np.ndarray:
        """Ranges (piece, row, span) of the windows found; the others stay as
        the block's stretches."""
        data, facts, equal = self._merge()
        doc, piece, row, start, length = facts
        begin = np.cumsum(length) - length
        # only minimizers that different documents hold
        h = gram_hashes(data, self.common)
        inner = length - GRAM + 1
        least_gram = np.minimum.reduceat(h[_starts_and_counts(inner, begin)], np.cumsum(inner) - inner)
        _, kind = np.unique(least_gram, return_inverse=True)
        low, high = np.full(kind.max() + 1, np.iinfo(np.int64).max), np.full(kind.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, kind, doc)
        np.maximum.at(high, kind, doc)
        some = np.flatnonzero((low != high)[kind])
        counts = length[some] - self.least + 1
        at = _starts_and_counts(counts, begin[some])
        of = np.repeat(some, counts)
        found = repeats(_eights(data), at, doc[of], self.least)
        hit = at[found] - begin[of[found]]
        ranges = _ranges(piece[of[found]], row[of[found]], start[of[found]] + hit, of[found], self.least)
        self.texts, self.facts, self.size = [data.tobytes()], [facts], len(data)
        if found.any():
            self._keep(data, begin, facts, at[found])
        return np.concatenate((equal, ranges), axis=1)

    def _merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text and facts of the stretches without those that equal one of a
        smaller document, and these as ranges."""
        text, facts = b"".join(self.texts), np.concatenate(self.facts, axis=1)
        doc, piece, row, start, length = facts
        ends = np.cumsum(length)
        order = np.argsort(doc, kind="stable")
        seen: dict[bytes, int] = {}
        gone = np.zeros(len(doc), bool)
        gone[order] = [seen.setdefault(text[a:b], d) < d for d, a, b in zip(doc[order].tolist(), (ends - length)[order].tolist(), ends[order].tolist())]
        equal = np.array([piece[gone], row[gone], _span(start[gone], (start + length)[gone])])
        facts, stay = facts[:, ~gone], np.repeat(~gone, length)
        return np.frombuffer(text, np.uint8)[stay], facts, equal

    def _keep(self, data: np.ndarray, begin: np.ndarray, facts: np.ndarray, gone: np.ndarray) -> None:
        """Go on with the stretches of windows that were not found."""
        start, length = facts[3:]
        counts = length - self.least + 1
        at = _starts_and_counts(counts, begin)
        of = np.repeat(np.arange(len(length)), counts)
        stay = np.ones(len(data), bool)
        stay[gone] = False
        keep = stay[at]
        at, of = at[keep], of[keep]
        if not len(at):
            self.texts, self.facts, self.size = [], [], 0
            return
        heads = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1))))
        n = np.diff(np.concatenate((heads, [len(at)]))) + self.least - 1
        o, a = of[heads], at[heads]
        text = data[_starts_and_counts(n, a)].tobytes()
        self.texts, self.size = [text], len(text)
        self.facts = [np.concatenate((facts[:3, o], [start[o] + a - begin[o], n]))]


def _ranges(piece: np.ndarray, row: np.ndarray, at: np.ndarray, of: np.ndarray, least: int) -> np.ndarray:
    """Neighbouring windows of a stretch as ranges: piece, row, span."""
    if not len(at):
        return np.empty((3, 0), np.int64)
    heads = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1))))
    tails = np.concatenate((heads[1:], [len(at)])) - 1
    return np.array([piece[heads], row[heads], _span(at[heads], at[tails] + least)])


def _span(start, end):
    """A byte range as one number (texts are shorter than 2 GiB)."""
    return (start << 31) | end


# ---------------------------------------------------------------- pieces

FOUND_HERE = -1  # block number of rows that hold ranges found within a piece


def pack_stretches(doc: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray, text: bytes, zip_) -> bytes:
    parts = np.array([len(doc)], "<i8"), np.diff(doc, prepend=0).astype("<i8"), row.astype("<u4"), start.astype("<u4"), length.astype("<u4")
    return zip_.compress(b"".join(x.tobytes() for x in parts) + text)


def unpack_stretches(piece: int, data: bytes, unzip) -> tuple[np.ndarray, bytes]:
    raw = unzip.decompress(data)
    m = int(np.frombuffer(raw, "<i8", 1)[0])
    doc = np.cumsum(np.frombuffer(raw, "<i8", m, 8))
    row, start, length = np.frombuffer(raw, "<u4", 3 * m, 8 + 8 * m).reshape(3, m).astype(np.int64)
    return np.array([doc, np.full(m, piece), row, start, length]), raw[8 + 20 * m :]


def pack_hashes(sorted_hashes: np.ndarray, zip_) -> bytes:
    """Ascending 48-bit numbers: steps between them, byte by byte."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return zip_.compress(np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes())


def unpack_hashes(data: bytes, unzip) -> np.ndarray:
    planes = np.frombuffer(unzip.decompress(data), np.uint8).reshape(6, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :6] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def pack_texts(docs: list[tuple[int | None, bytes]]) -> bytes:
    """Texts with their ids, ascending (without an id last)."""
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    ids = np.array([d or 0 for d, _ in docs], "<i8")
    null = np.array([d is None for d, _ in docs], np.uint8)
    length = np.array([len(t) for _, t in docs], "<u4")
    head = np.array([len(docs)], "<i8")
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*(x.tobytes() for x in (head, ids, null, length)), *(t for _, t in docs)]))


def unpack_texts(data: bytes) -> list[tuple[int | None, bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ids = np.frombuffer(raw, "<i8", n, 8).tolist()
    null = np.frombuffer(raw, np.uint8, n, 8 + 8 * n).tolist()
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 8 + 9 * n).astype(np.int64)) + 8 + 13 * n
    starts = [8 + 13 * n, *ends.tolist()]
    return [(None if x else i, raw[a:b]) for i, x, a, b in zip(ids, null, starts, starts[1:])]


class Piece:
    """The stretches of a piece's texts, and the hashes of their minimizers."""

    def __init__(self, data: bytes, least: int, blocks: int, common_grams: np.ndarray):
        self.least, self.docs = least, unpack_texts(data)
        self.rows = [i for i, (d, t) in enumerate(self.docs) if d is not None and len(t) >= least]
        self.found = [stretches(self.docs[i][1], least, common_grams) for i in self.rows]
        mins = np.concatenate([m for m, _, _ in self.found]) if self.found else np.empty(0, np.uint64)
        self.hashes, self.which = np.unique(_mix(mins) >> np.uint64(16), return_inverse=True)
        self.block = ((self.hashes >> np.uint64(16)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)

    def hash_rows(self) -> Iterator[tuple[int, bytes]]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for block, a, b in _slices(self.block):
            yield block, pack_hashes(self.hashes[a:b], zip_)

    def shared(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """Which of the hashes another piece or two ids of this one hold."""
        doc = np.repeat([self.docs[i][0] for i in self.rows], [len(m) for m, _, _ in self.found])
        low, high = np.zeros((2, len(self.hashes)), np.int64)
        high[self.which] = doc  # ids ascend, so the last one stays
        low[self.which[::-1]] = doc[::-1]
        flag = low != high
        for block, bits in answers:
            a, b = np.searchsorted(self.block, [block, block + 1])
            flag[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        return flag

    def stretch_rows(self, answers: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        shared = self.shared(answers)[self.which]
        zip_ = zstandard.ZstdCompressor(level=3)
        seen: dict[bytes, int] = {}
        blocks, docs, rows, starts, texts = [], [], [], [], []
        ranges: list[tuple[int, int]] = []
        done = 0
        for row, (mins, first, last) in zip(self.rows, self.found):
            doc, text = self.docs[row]
            mine = np.flatnonzero(shared[done : done + len(mins)])
            number = self.block[self.which[done : done + len(mins)][mine]]
            done += len(mins)
            n, at, end = len(texts), None, None
            for block, a, b in zip(number.tolist(), first[mine].tolist(), (last[mine] + self.least).tolist()):
                s = text[a:b]
                if seen.setdefault(s, doc) >= doc:
                    blocks.append(block)
                    starts.append(a)
                    texts.append(s)
                elif at is not None and a <= end:
                    end = b
                else:
                    if at is not None:
                        ranges.append((row, _span(at, end)))
                    at, end = a, b
            if at is not None:
                ranges.append((row, _span(at, end)))
            docs += [doc] * (len(texts) - n)
            rows += [row] * (len(texts) - n)
        if ranges:
            yield FOUND_HERE, zip_.compress(np.array(ranges, "<i8").tobytes())
        order = np.argsort(np.array(blocks, np.int64), kind="stable")
        block, doc, row, start = (np.array(x, np.int64)[order] for x in (blocks, docs, rows, starts))
        texts = [texts[i] for i in order]
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        for number, a, b in _slices(block):
            yield number, pack_stretches(doc[a:b], row[a:b], start[a:b], length[a:b], b"".join(texts[a:b]), zip_)


def _slices(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of equal values."""
    heads = np.flatnonzero(np.diff(x, prepend=-1)).tolist()
    for a, b in zip(heads, [*heads[1:], len(x)]):
        yield int(x[a]), a, b


# ---------------------------------------------------------------- on Spark

LONG, BYTES = T.LongType(), T.BinaryType()
TEXTS = T.StructType([T.StructField("piece", LONG), T.StructField("texts", BYTES)])
PACKED = T.StructType([T.StructField("piece", LONG), T.StructField("block", LONG), T.StructField("data", BYTES)])
FOUND = T.StructType([T.StructField(c, LONG) for c in ("piece", "row", "span")])


def _arrow(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if isinstance(c[0], bytes) else pa.int64()) for c in zip(*rows)], names=names)


def _common_grams(texts: DataFrame, least: int, n_docs: int) -> np.ndarray:
    """A table of hash endings of grams that many documents hold, from a
    sample of about ``SAMPLED`` documents.  It only orders the grams, so any
    table gives the same repeats."""
    none = np.zeros(1 << COMMON_BITS, bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                text = t.encode("utf-8", "surrogatepass")
                if len(text) >= least:
                    mins = np.unique(stretches(text, least, none)[0]) & np.uint64(len(none) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(mins).astype(np.int64))], names=["gram"])

    share = min(1.0, SAMPLED / max(1, n_docs))
    held = texts.select("text").sample(share, seed=7).mapInArrow(run, "gram long").groupBy("gram").count()
    rows = held.where(F.col("count") > max(8, COMMON_SHARE * share * n_docs)).select("gram").collect()  # at most all endings
    table = none.copy()
    table[[r[0] for r in rows]] = True
    return table


def _pieces(docs: DataFrame) -> DataFrame:
    """Texts packed as they lie in the table: piece number, packed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                text = t.as_buffer().to_pybytes()
                held.append((doc, text))
                size += len(text) + 16
                if size >= PIECE_BYTES:
                    yield _arrow([(base + n, pack_texts(held))], TEXTS.names)
                    n, held, size = n + 1, [], 0
        if held:
            yield _arrow([(base + n, pack_texts(held))], TEXTS.names)

    return docs.select("doc", "text").mapInArrow(run, TEXTS)


def _answers(pieces: DataFrame, least: int, blocks: int, table) -> DataFrame:
    """Per piece and block with shared minimizers: a bit for each of the
    piece's hashes there, in ascending order."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows = [(number, *r) for r in Piece(data.as_py(), least, blocks, table.value).hash_rows()]
                if rows:
                    yield _arrow(rows, PACKED.names)

    def answer(block: int, held: list[tuple[int, np.ndarray]]) -> list[tuple]:
        every = np.sort(np.concatenate([h for _, h in held]))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        out = []
        for piece, h in held:
            if len(twice):
                i = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
                bits = twice[i] == h
                if bits.any():
                    out.append((piece, block, np.packbits(bits).tobytes()))
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, at, held = zstandard.ZstdDecompressor(), None, []
        for b in batches:
            rows = []
            for piece, block, data in zip(*(c.to_pylist() for c in b.columns)):
                if block != at:
                    rows += answer(at, held) if held else []
                    at, held = block, []
                held.append((piece, unpack_hashes(data, unzip)))
            if rows:
                yield _arrow(rows, PACKED.names)
        rows = answer(at, held) if held else []
        if rows:
            yield _arrow(rows, PACKED.names)

    sent = pieces.mapInArrow(hashes, PACKED)
    return sent.repartition("block").sortWithinPartitions("block").mapInArrow(compare, PACKED)


def _found(pieces: DataFrame, answers: DataFrame, least: int, blocks: int, table) -> DataFrame:
    """Ranges of repeats: piece, row in the piece, span."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, data, told in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                piece = Piece(data.as_py(), least, blocks, table.value)
                rows = [(number, *r) for r in piece.stretch_rows([(x["block"], x["data"]) for x in told or []])]
                if rows:
                    yield _arrow(rows, PACKED.names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, block, at = zstandard.ZstdDecompressor(), None, None

        def batch(ranges: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in ranges], names=FOUND.names)

        for b in batches:
            for piece, number, data in zip(*(c.to_pylist() for c in b.columns)):
                if number == FOUND_HERE:
                    row, span = np.frombuffer(unzip.decompress(data), "<i8").reshape(-1, 2).T
                    yield batch(np.array([np.full(len(row), piece), row, span]))
                    continue
                if number != at or block.size >= HELD_BYTES:
                    if block and block.texts:
                        yield batch(block.settle())
                    if number != at:
                        block, at = Block(least, table.value), number
                block.add(*unpack_stretches(piece, data, unzip))
        if block and block.texts:
            yield batch(block.settle())

    told = answers.groupBy("piece").agg(F.collect_list(F.struct("block", "data")).alias("told"))  # a bit per hash of the piece
    packed = pieces.join(told, "piece", "left").select("piece", "texts", "told").mapInArrow(send, PACKED)
    # ranges found in pieces pass through, dealt by piece
    deal = F.when(F.col("block") < 0, F.xxhash64("piece")).otherwise(F.col("block"))
    return packed.repartition(deal).sortWithinPartitions("block").mapInArrow(compare, FOUND)


def _cut(text: bytes, spans: list[int]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the remaining bytes."""
    kept, gone, n, end = [], 0, 0, 0
    at = None  # start of the open run
    for span in sorted(spans):
        a, b = span >> 31, span & 0x7FFFFFFF
        if at is None or a > end:
            if at is not None:
                gone += end - at
            kept.append(text[end:a])
            n += 1
            at, end = a, b
        else:
            end = max(end, b)
    if at is not None:
        gone += end - at
    kept.append(text[end:])
    return gone, n, b"".join(kept)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50, with_text: bool = False) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` and, with ``with_text``, ``kept`` (the remaining
    bytes, which may cut a character).

    Null texts count as empty.  Rows of one id are no earlier than each other
    and are judged each by its own text; rows without an id keep all and make
    nothing a repeat.  An empty table gives no rows; other columns are not read.
    ``least`` is at least ``GRAM``; ids are of an integer type.
    """
    kind = common.id_type(df, id_col)
    if least < GRAM or not isinstance(kind, T.IntegralType):
        raise ValueError(f"least must be at least {GRAM} and {id_col} of an integer type")
    spark = df.sparkSession
    common.ship(spark)
    docs = df.select(df[id_col].cast("long").alias("doc"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    table = spark.sparkContext.broadcast(_common_grams(docs, least, size["n"]))
    blocks = 1 + (size["bytes"] or 0) // BLOCK_BYTES
    pieces = common.stored(_pieces(docs), "repeat-pieces")
    found = _found(pieces, _answers(pieces, least, blocks, table), least, blocks, table)
    spans = found.groupBy("piece").agg(F.collect_list(F.struct("row", "span")).alias("spans"))  # of one piece's texts

    fields = [T.StructField("id", LONG), T.StructField("n_bytes", LONG), T.StructField("n_removed", LONG), T.StructField("n_spans", LONG)]
    fields.append(T.StructField("kept_sha256", T.StringType()))
    if with_text:
        fields.append(T.StructField("kept", BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, told in zip(b.column(0), b.column(1).to_pylist()):
                gone: dict[int, list[int]] = {}
                for x in told or []:
                    gone.setdefault(x["row"], []).append(x["span"])
                rows = []
                for i, (doc, text) in enumerate(unpack_texts(data.as_py())):
                    n, runs, kept = _cut(text, gone[i]) if i in gone else (0, 0, text)
                    rows.append((doc, len(text), n, runs, hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)][: len(fields)]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    out = pieces.join(spans, "piece", "left").select("texts", "spans").mapInArrow(run, T.StructType(fields))
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
