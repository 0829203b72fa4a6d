"""Token counts of whole texts with a SentencePiece model.

Texts up to ``chunk_chars`` are encoded in one call.  A huge text is encoded
in overlapping chunks with byte offsets, one chunk in memory at a time, and
spliced by *overlap resynchronisation*: inside an overlap, look for a place
where both chunks end the same token and begin the same token.  A BPE
segmentation is valid exactly when every two neighbouring tokens are what BPE
makes of their concatenation; at such a place every neighbouring pair of the
spliced sequence is a neighbouring pair of one of the chunks, so the splice is
the library's segmentation of the whole.  The artificial space that the model
puts before a chunk touches only tokens left of the splice.  Byte-fallback and
unknown tokens never serve as a splice.  Where an overlap holds no such place
it is doubled; past the chunk itself the text is encoded whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
BATCH_CHARS = 1 << 20

_models: dict[str, object] = {}


def load(model: bytes):
    """The SentencePiece processor of serialized ``model``, once per worker."""
    key = hashlib.sha1(model).hexdigest()
    if key not in _models:
        import sentencepiece

        _models[key] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _models[key]


def _tokens(sp, text: str, start: int) -> list[tuple[int, int, int]]:
    """(id, begin, end) with byte offsets shifted by ``start``."""
    return [(p.id, p.begin + start, p.end + start) for p in sp.encode(text, return_type="proto").pieces]


def _splice(sp, left: list, right: list) -> tuple[int, int] | None:
    """Numbers of tokens of ``left`` to keep and of ``right`` to skip at the
    last place where both agree on the token before and the token after."""
    at = {b: j for j, (_, b, _) in enumerate(right) if j}
    plain = lambda t: not (sp.is_byte(t) or sp.is_unknown(t))
    for i in range(len(left) - 1, 0, -1):
        j = at.get(left[i][1])
        if j and left[i] == right[j] and left[i - 1] == right[j - 1] and left[i - 1][2] == left[i][1] and plain(left[i][0]) and plain(left[i - 1][0]):
            return i, j
    return None


def encode_long(sp, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[list[int]]:
    """Ids of ``text`` as the model gives them for the whole, in runs."""
    n, end, skip = len(text), min(len(text), chunk), 0
    left, byte_end = _tokens(sp, text[:end], 0), len(text[:end].encode())
    done: list[list[int]] = []
    while end < n:
        new_end, wide, cut = min(n, end + chunk), overlap, None
        while cut is None and wide <= chunk:
            start = max(0, end - wide)
            byte_start = byte_end - len(text[start:end].encode())
            right = _tokens(sp, text[start:new_end], byte_start)
            cut = _splice(sp, left[skip:], right)
            wide *= 2
        if cut is None:
            yield sp.encode(text)
            return
        done.append([t for t, _, _ in left[skip : skip + cut[0]]])
        left, skip = right, cut[1]
        byte_end += len(text[end:new_end].encode())
        end = new_end
    yield from done
    yield [t for t, _, _ in left[skip:]]


def counts(sp, texts: list[str], chunk: int, overlap: int) -> list[int]:
    out = [0] * len(texts)
    short = [i for i, t in enumerate(texts) if len(t) <= chunk]
    for a, b in common.slices([len(texts[i]) for i in short], BATCH_CHARS):
        part = short[a:b]
        for i, ids in zip(part, sp.encode([texts[i] for i in part], num_threads=1)):
            out[i] = len(ids)
    for i, t in enumerate(texts):
        if len(t) > chunk:
            out[i] = sum(map(len, encode_long(sp, t, chunk, overlap)))
    return out


def count_tokens(
    df: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``,
    ``over_limit`` (more than ``limit`` tokens).

    Null texts count as empty (0 bytes, 0 tokens); null or repeated ids keep
    their rows; other columns are not read.  No shuffle: rows are counted
    where they are read.
    """
    spark = df.sparkSession
    common.ship(spark)
    model = spark.sparkContext.broadcast(common.read_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load(model.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = counts(sp, texts, chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = T.StructType(
        [
            T.StructField("id", common.id_type(df, id_col)),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    narrow = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
