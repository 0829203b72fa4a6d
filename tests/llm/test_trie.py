"""The conversation trie against prefixes counted one by one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from shelfscope.llm import queries, trie
from tests.conftest import SMALL

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("node", T.StringType()), T.StructField("n", T.StringType()), T.StructField("depth", T.StringType()),
])


def original(rows) -> dict[int, list]:
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}


def rebuilt(convs: dict[int, list]) -> dict[int, list]:
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def expected(convs: dict[int, list]) -> list[tuple]:
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                kids[tuple(seq[: d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        value = (len(m) - 1) * (len(node[-1][1]) if node else 0)
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += value
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()
    )


def rows_of(df) -> list[tuple]:
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[c] is None else r[c] for c in cols) for r in df.collect())


def conversations(seed: int, n: int, longest: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for _ in range(n):
        c = rng.choice([rng.randrange(700), -rng.randrange(300), 10**12 + rng.randrange(50)])
        for i in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([i, i, i, None]), rng.choice(["user", "user", None]), rng.choice(["é🙂", "b", "b", "c" * 50, "", None])))
    rows += [(2_000 + i, j, "user", "same") for i in range(60) for j in range(4)]  # one conversation sixty times
    rows += [(3_000 + i, j, "user", f"{j}") for i in range(12) for j in range(i + 1)]  # a log that grows
    rows += [(4_000, j, "bot", f"{j % 3}") for j in range(150)]  # a long one
    rows += [(None, 1, "user", "lost"), (5_000, None, None, None), (5_000, None, None, None), (5_001, 1, "", "")]
    return rows


@pytest.mark.parametrize("bundle_rows", [2, 1_000])
def test_trie_equals_counted_prefixes(spark, bundle_rows):
    rows = conversations(1, 300, 8)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    turns = trie.ordered_turns(df)
    assert rows_of(trie.prefix_trie(trie.sequences(turns), bundle_rows)) == expected(original(rows))
    assert rows_of(trie.prefix_trie(trie.rebuilt(turns), bundle_rows)) == expected(rebuilt(original(rows)))


def test_many_ends_at_one_node_cross_pieces(spark):
    rows = [(i * 1_500 - 9_000, 0, "user", "same") for i in range(30)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert rows_of(trie.prefix_trie(trie.sequences(trie.ordered_turns(df)), 5)) == expected(original(rows))


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rows_of(trie.prefix_trie(trie.rebuilt(trie.ordered_turns(df)))) == []


def test_query_equals_counted_prefixes(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op11_prefix_trie(spark, SMALL)) == expected(rebuilt(original(rows)))
