"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end the BPE
encoding of that prefix: the suffix token whose pair with the last token of
the prefix before it is itself a BPE result.  Storing that token per prefix
makes appends exact (the stored prefixes never change) and makes an edit local
(prefixes before it stay; after it the stored tokens are taken over as soon as
they repeat over a whole window of the longest token).  Walking back from the
end gives the encoding.

A text is first cut into pieces by the split pattern; pieces are encoded on
their own.  A piece that is itself a token is that token, as in the tiktoken
library.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

#: Encoded pieces that a worker remembers twice over: when the memory is full it
#: becomes the older one, and what is met again in the older one moves back.
CACHE_PIECES = 300_000
#: Bytes of a piece's beginning whose prefixes are remembered by themselves.
STEM_BYTES = 5
#: Text bytes per output batch.
BATCH_BYTES = 4 << 20


class Vocabulary:
    """Ranks of a byte-level BPE (lines of base64 token and rank)."""

    def __init__(self, lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values(), default=-1) + 1)
        #: Lengths of the tokens that can end where three or four bytes do, longest first.
        ends: dict[bytes, set[int]] = {}
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
            if len(token) >= 3:
                ends.setdefault(token[-4:], set()).add(len(token))
        self.lengths = {e: tuple(sorted(n | self.short(e), reverse=True)) for e, n in ends.items()}
        self.longest = max(map(len, self.ranks), default=0)
        self._pairs: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}

    def short(self, data: bytes) -> set[int]:
        """Lengths up to three of the tokens that end ``data``."""
        return {n for n in (3, 2, 1) if data[-n:] in self.ranks}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: join the neighbouring pair of lowest rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def pair(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens ``a`` and ``b`` side by side."""
        key = a << 32 | b
        got = self._pairs.get(key)
        if got is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            got = self._pairs[key] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return got

    def alone(self, a: int) -> bool:
        got = self._alone.get(a)
        if got is None:
            got = self._alone[a] = self.merge(self.tokens[a]) == [a]
        return got

    def extend(self, data: bytes, last: list[int], end: int) -> None:
        """Append to ``last``, the last tokens of the prefixes of ``data``, up
        to the prefix of ``end`` bytes: each is the one token that can end it."""
        rank, lengths, known = self.ranks.get, self.lengths.get, self._pairs.get
        for i in range(len(last) + 1, end + 1):
            for n in i > 3 and lengths(data[i - 4 : i]) or i > 2 and lengths(data[i - 3 : i]) or (2, 1):
                if n > i or (t := rank(data[i - n : i])) is None:
                    continue
                if n == i:
                    if self.alone(t):
                        break
                elif known((a := last[i - n - 1]) << 32 | t) or self.pair(a, t):
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[i - 1]}")
            last.append(t)


class Piece:
    """A piece with the last token of each of its prefixes."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last = vocab, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocab.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes ``start:end`` and return how many prefixes were
        encoded anew; the rest is taken over once a window of the longest
        token's length repeats (a token depends on no earlier prefix)."""
        old, shift = self.last, start + len(new) - end
        self.data = self.data[:start] + new + self.data[end:]
        last, same, work = old[:start], 0, 0
        for i in range(start + 1, len(self.data) + 1):
            if same >= self.vocab.longest:
                last += old[i - 1 - shift :]
                break
            self.vocab.extend(self.data, last, i)
            work += 1
            was = i - 1 - shift
            same = same + 1 if i > start + len(new) and was >= 0 and old[was] == last[-1] else 0
        self.last = last
        return work

    def ids(self) -> list[int]:
        whole = self.vocab.ranks.get(self.data)
        if whole is not None:
            return [whole]
        out, i = [], len(self.data)
        while i:
            t = self.last[i - 1]
            out.append(t)
            i -= len(self.vocab.tokens[t])
        return out[::-1]


class Text:
    """An encoded text that can be appended to and edited.

    The split pattern looks at most two characters past a piece, so pieces
    that end more than two characters before an edit stay; after the edit
    splitting stops at the first old piece boundary that is met again.
    """

    LOOK = 2

    def __init__(self, vocab: Vocabulary, pattern: str, text: str = ""):
        import regex

        self.vocab, self.split, self.text = vocab, regex.compile(pattern), text
        self.starts: list[int] = []
        self.pieces: list[Piece] = []
        for m in self.split.finditer(text):
            self.starts.append(m.start())
            self.pieces.append(Piece(vocab, m.group().encode()))

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        shift = start + len(new) - end
        k = 0
        ends = [*self.starts[1:], len(self.text)][: len(self.starts)]
        while k < len(ends) and ends[k] + self.LOOK < start:
            k += 1
        text = self.text[:start] + new + self.text[end:]
        starts, pieces = self.starts[:k], self.pieces[:k]
        for m in self.split.finditer(text, self.starts[k] if k < len(self.starts) else 0):
            was = m.start() - shift
            if was >= end and m.start() >= start + len(new):
                j = bisect_left(self.starts, was)
                if j < len(self.starts) and self.starts[j] == was:
                    starts += [s + shift for s in self.starts[j:]]
                    pieces += self.pieces[j:]
                    break
            data = m.group().encode()
            at = len(pieces)
            old = self.pieces[at] if m.start() < start and at < len(self.starts) and self.starts[at] == m.start() else None
            if old is not None and data.startswith(old.data):
                old.append(data[len(old.data) :])
                pieces.append(old)
            else:
                pieces.append(Piece(self.vocab, data))
            starts.append(m.start())
        self.text, self.starts, self.pieces = text, starts, pieces

    def ids(self) -> list[int]:
        return [t for p in self.pieces for t in p.ids()]


class Encoder(dict):
    """Piece -> packed ids (little-endian unsigned 32 bits), remembered."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        super().__init__()
        import regex

        self.vocab, self.find = vocab, regex.compile(pattern).findall
        self.older: dict[str, bytes] = {}
        self.stems: dict[bytes, list[int]] = {}

    def piece(self, data: bytes) -> Piece:
        """A new piece that takes over the prefixes of a known beginning."""
        out, stem = Piece(self.vocab), data[:STEM_BYTES]
        known = self.stems.get(stem)
        if known is None:
            if len(self.stems) >= CACHE_PIECES:
                self.stems.clear()
            known = self.stems[stem] = []
            self.vocab.extend(stem, known, len(stem))
        out.last = known.copy()
        out.append(data)
        return out

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            data = piece.encode()
            whole = self.vocab.ranks.get(data)
            ids = [whole] if whole is not None else self.piece(data).ids()
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, packed: bytes) -> bytes:
        tokens = self.vocab.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


_encoders: dict[str, Encoder] = {}


def encoder(lines: bytes, pattern: str) -> Encoder:
    """The encoder of a vocabulary, once per worker."""
    key = hashlib.sha1(lines + pattern.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(Vocabulary(lines), pattern)
    return _encoders[key]


def encode_documents(
    df: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """id, ``n_tokens``, ``token_ids`` (packed little-endian unsigned 32-bit
    ids) and, with ``decode``, ``decoded`` (the bytes that the ids stand for,
    decoded in the same pass).

    Null texts count as empty; null or repeated ids keep their rows; other
    columns are not read.  No shuffle.
    """
    spark = df.sparkSession
    common.ship(spark)
    lines = spark.sparkContext.broadcast(common.read_bytes(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(lines.value, pattern)
        for b in batches:
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in b.column(1)]
            for x, y in common.slices(sizes, BATCH_BYTES):
                ids = [enc.encode(t or "") for t in b.column(1).slice(x, y - x).to_pylist()]
                cols = [b.column(0).slice(x, y - x), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decode:
                    cols.append(pa.array([enc.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [
        T.StructField("id", common.id_type(df, id_col)),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("token_ids", T.BinaryType()),
    ]
    if decode:
        fields.append(T.StructField("decoded", T.BinaryType()))
    names = [f.name for f in fields]
    narrow = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """id and ``decoded`` bytes of packed ids (null ids: no bytes)."""
    spark = df.sparkSession
    common.ship(spark)
    lines = spark.sparkContext.broadcast(common.read_bytes(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(lines.value, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([enc.decode(i or b"") for i in b.column(1).to_pylist()], pa.binary())], names=["id", "decoded"]
            )

    schema = T.StructType([T.StructField("id", common.id_type(df, id_col)), T.StructField("decoded", T.BinaryType())])
    narrow = df.select(df[id_col].alias("id"), df[ids_col].alias("ids"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)

