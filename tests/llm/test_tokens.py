"""Byte-level BPE against the tiktoken library, token counts against
sentencepiece."""

from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import types as T

from shelfscope.llm import bpe, queries, token_counts
from tests.conftest import MEDIUM, SMALL

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SP = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("n_tokens", T.StringType())])
ODD = ["", " ", "  a  b\n\n c\t", "don't I'll we've", "日本語 テキスト 🙂🙂", "a" * 700, "---" * 90, "x\x1cy\x85z", "<|endoftext|> <s> </s>", "½²٣ Ⅷ", "́e‍"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(open(BPE, "rb").read())


def texts():
    rng = random.Random(5)
    alphabet = "abcdeéßthe ing \n'.,!0123 日🙂ÿ"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))) for _ in range(200)]


def test_prefix_dp_equals_the_library(vocab, library):
    for t in texts():
        assert bpe.Text(vocab, public_tokenizers.PATTERN, t).ids() == library.encode_ordinary(t), t


def test_appends_and_edits_equal_encoding_anew(vocab, library):
    rng = random.Random(6)
    alphabet = "abcthe 're\n12é"
    for _ in range(40):
        t = "".join(rng.choice(alphabet) for _ in range(60))
        text = bpe.Text(vocab, public_tokenizers.PATTERN, t)
        for _ in range(15):
            a = rng.randint(0, len(t))
            b = min(len(t), a + rng.randint(0, 5))
            if rng.random() < 0.4:
                a = b = len(t)
            new = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 4)))
            t = t[:a] + new + t[b:]
            if a == b == len(t) - len(new):
                text.append(new)
            else:
                text.replace(a, b, new)
            assert text.text == t
            assert text.ids() == library.encode_ordinary(t)


def test_an_edit_of_a_long_piece_is_local(vocab):
    rng = random.Random(7)
    data = bytes(rng.choice(b"abcdefgh") for _ in range(3000))
    piece = bpe.Piece(vocab, data)
    work = piece.replace(1500, 1501, b"zz")
    assert piece.last == bpe.Piece(vocab, data[:1500] + b"zz" + data[1501:]).last
    assert work < 500


def test_op5_on_the_table(spark, library):
    got = {r.doc_id: r for r in queries.op5_byte_bpe(spark, SMALL).collect()}
    for d in pq.read_table(f"{SMALL}/documents.parquet").to_pylist():
        ids = library.encode_ordinary(d["text"])
        r = got.pop(d["doc_id"])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d["text"].encode()).hexdigest()
    assert not got


def test_op5_odd_rows(spark, library):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "a b", None, None), (3, None, None, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(bpe.encode_documents(df, BPE, public_tokenizers.PATTERN, decode=True).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert len(got) == len(rows)
    by = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.decoded)) for r in got) == sorted(
        (str(i), len(library.encode_ordinary(t or "")), (t or "").encode()) for i, t, _, _ in by
    )
    assert bpe.encode_documents(df.limit(0), BPE, public_tokenizers.PATTERN).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(df, BPE, public_tokenizers.PATTERN), BPE, public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for _, t, _, _ in rows)


@pytest.mark.parametrize("chunk,overlap", [(64, 4), (50, 16), (200, 32), (16, 1)])
def test_overlap_resynchronisation_equals_the_whole(chunk, overlap):
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    docs = [d["text"] for d in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()[:60]]
    for t in [x[:4000] for x in docs] + texts() + ["🙂" * 300, "a" * 1000, " " * 500, "ab" * 500]:
        if len(t) > chunk:
            assert [i for run in token_counts.encode_long(sp, t, chunk, overlap) for i in run] == sp.encode(t)


def test_op6_on_the_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op6_token_counts(spark, MEDIUM).collect()}
    want = {}
    for d in pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist():
        n = len(sp.encode(d["text"]))
        want[d["doc_id"]] = (len(d["text"].encode()), n, n > 4096)
    assert got == want


def test_op6_odd_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "a b", None, None), (3, None, None, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = token_counts.count_tokens(df, SP, limit=5, chunk_chars=40, overlap_chars=4).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(i), len((t or "").encode()), n := len(sp.encode(t or "")), n > 5) for i, t, _, _ in rows
    )
    assert token_counts.count_tokens(df.limit(0), SP).count() == 0


def test_common_pieces_outlast_a_full_memory(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    enc = bpe.Encoder(vocab, public_tokenizers.PATTERN)
    made = []
    monkeypatch.setattr(enc, "piece", lambda data, real=enc.piece: made.append(data) or real(data))
    for x in "abcdefghijklmnopqrstuvwxyz" * 2:
        t = f" qzxqzx {x}zzxqzx"
        assert enc.encode(t) == struct.pack(f"<{len(library.encode_ordinary(t))}I", *library.encode_ordinary(t))
    assert made.count(b" qzxqzx") == 1
    assert len(enc) <= 10 and len(enc.older) <= 10


def test_only_lengths_of_tokens_that_can_end_there_are_tried(vocab):
    ends = {(t[-k:], len(t)) for t in vocab.ranks for k in (3, 4) if len(t) >= k}
    for end, lengths in vocab.lengths.items():
        assert list(lengths) == sorted(set(lengths), reverse=True)
        assert all((end, n) in ends or n < 4 and end[-n:] in vocab.ranks for n in lengths), end
