"""The prefix trie of conversations, by peeling truncations.

A node is a distinct sequence of first ``d`` turns; conversations that start
with it are its members.  Peeling descends from the greatest depth: the nodes of
a depth are the conversations that end there, merged with what survives from
one turn deeper; each hands its sums to itself without its last turn, and these
are regrouped.  So nodes and their subtree sums come out together, and every
conversation's turns are read once.

* A sequence of turns is known by a chained 128-bit digest, so texts are
  shuffled once (to order the turns) and digests from then on.
* Equal conversations are merged before the peel: of those with equal turns the
  one with the smallest id is the representative and carries their number.
* A node with at least two distinct conversations and more than ``bundle_rows``
  turns below is *heavy*, as is the root.  Heavy nodes are peeled by Spark, one
  aggregation a depth.  All other nodes lie in subtrees of at most
  ``bundle_rows`` turns (or of a single conversation), which are peeled whole
  inside tasks, many to a batch, and hand one row to their heavy parent.
* The ids of the conversations that end at a node are joined in pieces of at
  most ``IDS`` consecutive ids and hashed piece by piece, so a node at which
  very many end costs one task few rows and constant memory.

A single conversation is read by one task in order (its digests are a chain),
in constant memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BUNDLE_ROWS = 1_000
BATCH_ROWS = 20_000
IDS = 4_096
SALTS = 16
ROOT = bytes(16)
NOBODY = hashlib.sha256(b"").hexdigest()

SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def ordered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n, turn, chars): every turn's place from 1 by turn (null
    first; ties by role, then text), the digest of role and text (null counts as
    empty), and the text's code points.  Rows without an id take no part."""
    empty = F.lit("")
    t = df.select(
        df[id_col].cast("long").alias("conv_id"), df[turn_col].alias("at"),
        F.coalesce(df[role_col].cast("string"), empty).alias("role"), F.coalesce(df[text_col].cast("string"), empty).alias("text"),
    ).where("conv_id is not null")
    w = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "role", "text")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    digest = F.unhex(F.substring(F.sha2(whole, 256), 1, 32))
    return t.select("conv_id", F.row_number().over(w).cast("long").alias("n"), digest.alias("turn"), F.length("text").cast("long").alias("chars"))


def _with_marks(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Turns in parts 0 and 1, and a mark (part -1) that keeps turnless ones."""
    none = F.lit(None)
    marks = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("n"), none.cast("binary").alias("turn"), none.cast("long").alias("chars"))
    return turns.select("conv_id", "part", "n", "turn", "chars").unionByName(marks)


def sequences(turns: DataFrame) -> DataFrame:
    """Every conversation as it is, for ``prefix_trie``."""
    return _with_marks(turns.withColumn("part", F.lit(1)), turns.where("n = 1"))


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Every conversation ``c`` as the first ``h`` turns of conversation
    ``c - c % every`` (all if it has fewer, none if there is no such), then its
    own turns after its first ``h``; ``h`` is the crc32 of the decimal ``c``
    modulo ``most``.  A base has at most ``every`` takers of ``most - 1`` turns."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = turns.where("n = 1").select("conv_id")
    base = turns.where((F.col("conv_id") % every == 0) & (F.col("n") < most)).withColumnRenamed("conv_id", "base")
    heads = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base")).join(base, "base").where(F.col("n") <= h)
    own = turns.where(F.col("n") > h).withColumn("part", F.lit(1))
    return _with_marks(own.unionByName(heads.withColumn("part", F.lit(0)).drop("base")), ids)


PATHS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()), T.StructField("node", T.BinaryType()),
    T.StructField("parent", T.BinaryType()), T.StructField("chars", T.LongType()), T.StructField("ends", T.BooleanType()),
])


def _columns(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType: pa.int64(), T.BinaryType: pa.binary(), T.BooleanType: pa.bool_(), T.StringType: pa.string()}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema.fields])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _columns(schema))], schema=_columns(schema))


def paths(seq: DataFrame) -> DataFrame:
    """One row per conversation and prefix, the empty one included: digests
    chained over the turns in order, one conversation after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            out = []
            for conv, turn, chars in zip(*(b.column(i).to_pylist() for i in range(3))):
                if turn is None:
                    row = (conv, 0, ROOT, None, 0)
                else:
                    row = (conv, last[1] + 1, hashlib.blake2b(last[2] + turn, digest_size=16).digest(), last[2], chars)
                if last:
                    out.append((*last, last[0] != conv))
                last = row
            if out:
                yield _batch(out, PATHS)
        if last:
            yield _batch([(*last, True)], PATHS)

    in_order = seq.repartition("conv_id").sortWithinPartitions("conv_id", "part", "n")
    return in_order.select("conv_id", "turn", "chars").mapInArrow(run, PATHS)


ENDS = T.StructType([
    T.StructField("node", T.BinaryType()), T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("n_ends", T.LongType()), T.StructField("ends_sha256", T.StringType()),
])


def ends(path: DataFrame) -> DataFrame:
    """Per node at which conversations end: the smallest of their ids, their
    number and the digest of their ascending ids."""
    piece = F.floor(F.col("conv_id") / IDS)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = path.where("ends").groupBy("node", F.col("depth").alias("n_turns"), piece.alias("piece")).agg(
        ids.alias("ids"), F.count("*").alias("n"), F.min("conv_id").alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = row = None
        for b in batches:
            out = []
            for at, n_turns, ids, n, first in zip(*(c.to_pylist() for c in b.columns)):
                if at != node:
                    if row:
                        out.append((*row, digest.hexdigest()))
                    node, row, digest = at, [at, first, n_turns, n], hashlib.sha256(ids.encode())
                else:
                    row[3] += n
                    digest.update(b"," + ids.encode())
            if out:
                yield _batch(out, ENDS)
        if row:
            yield _batch([(*row, digest.hexdigest())], ENDS)

    return pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "n_turns", "ids", "n", "first").mapInArrow(run, ENDS)


def _salted(left: DataFrame, right: DataFrame, on: Column, spread: Column, how: str) -> DataFrame:
    """Join many rows per key of ``left`` with one per key of ``right``, each
    key cut into ``SALTS`` parts.  ``on`` names columns of both."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    right = right.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, on & (F.col("_salt") == F.col("_salt2")), how).drop("_salt", "_salt2")


NODES = T.StructType([
    T.StructField("node", T.BinaryType()), T.StructField("parent", T.BinaryType()), T.StructField("depth", T.LongType()),
    T.StructField("conv_id", T.LongType()), T.StructField("parent_conv_id", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in SUMS], T.StructField("top", T.BooleanType()),
])


def peel(rows: list[tuple]) -> list[tuple]:
    """Peel whole subtrees.  ``rows`` are (conv_id, depth, node, parent, chars,
    number that end here or 0) of their representatives; returns rows of
    ``NODES``, where ``top`` marks those whose parent is not among them."""
    known: dict[bytes, tuple] = {}
    levels: dict[int, dict[bytes, list[int]]] = {}

    def merge(depth: int, node: bytes, conv: int, n: int, children: int, leaves: int, saved: int) -> None:
        level = levels.setdefault(depth, {})
        s = level.get(node)
        if s is None:
            level[node] = [conv, n, children, leaves, saved]
        else:
            s[0] = min(s[0], conv)
            s[1] += n
            s[2] += children
            s[3] += leaves
            s[4] += saved

    for conv, depth, node, parent, chars, n in rows:
        known[node] = (parent, chars)
        if n:
            merge(depth, node, conv, n, 0, 0, 0)
    done: dict[bytes, tuple[int, list[int]]] = {}
    for depth in range(max(levels), -1, -1):
        for node, s in levels.pop(depth, {}).items():
            parent, chars = known[node]
            s[3] = s[3] or 1
            s[4] += (s[1] - 1) * chars
            done[node] = (depth, s)
            if parent in known:
                merge(depth - 1, parent, s[0], s[1], 1, s[3], s[4])
    out = []
    for node, (depth, s) in done.items():
        above = done.get(known[node][0])
        out.append((node, known[node][0], depth, s[0], above[1][0] if above else None, *s[1:], above is None))
    return out


def _light_nodes(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bundle = None
        for b in batches:
            for at, *row in zip(*(c.to_pylist() for c in b.columns)):
                if at != bundle and len(held) >= BATCH_ROWS:
                    yield _batch(peel(held), NODES)
                    held = []
                bundle = at
                held.append(row)
        if held:
            yield _batch(peel(held), NODES)

    cols = ["bundle", "conv_id", "depth", "node", "parent", "chars", "n_ends"]
    return rows.repartition("bundle").sortWithinPartitions("bundle").select(*cols).mapInArrow(run, NODES)


def prefix_trie(seq: DataFrame, bundle_rows: int = BUNDLE_ROWS) -> DataFrame:
    """Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``
    (the parent's ``conv_id``; null for the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes of its subtree),
    ``saved_tokens`` (over its subtree, members but one times code points of the
    last turn's text) and ``ends_sha256`` (ascending ids of the conversations
    that are this node, joined by commas).

    A conversation without turns is a member of the root alone; without
    conversations there is no node.  The number of Spark rounds is the depth of
    the deepest heavy node.
    """
    common.ship(seq.sparkSession)
    path = common.stored(paths(seq), "trie-paths")
    end = common.stored(ends(path), "trie-ends")
    own = path.join(end.select("conv_id", "n_turns", "n_ends"), "conv_id")  # paths of the representatives

    below = F.sum(F.col("n_turns") - F.col("depth") + 1)
    sizes = own.groupBy("node", "parent", "depth", "chars").agg(F.count("*").alias("seqs"), below.alias("rows"))
    heavy = sizes.where((F.col("depth") == 0) | ((F.col("seqs") > 1) & (F.col("rows") > bundle_rows)))
    heavy = common.stored(heavy.select("node", "parent", "depth", "chars"), "trie-heavy")

    flags = heavy.select(F.col("node").alias("_h"))
    flagged = _salted(own, flags, F.col("node") == F.col("_h"), F.col("conv_id"), "left")
    w = Window.partitionBy("conv_id")
    flagged = flagged.withColumn("_deep", F.max(F.when(F.col("_h").isNotNull(), F.col("depth"))).over(w)).where("_h is null")
    light = flagged.withColumn("bundle", F.max(F.when(F.col("depth") == F.col("_deep") + 1, F.col("node"))).over(w))
    light = light.withColumn("n_ends", F.when(F.col("ends"), F.col("n_ends")).otherwise(F.lit(0).cast("long")))
    light = common.stored(_light_nodes(light), "trie-light")

    # What enters the heavy nodes from outside: conversations that end there
    # and subtrees peeled in tasks.
    zero = F.lit(0).cast("long")
    ended = end.join(heavy.select("node"), "node").select("node", "conv_id", F.col("n_ends").alias("n_convs"), *[zero.alias(c) for c in SUMS[1:]])
    handed = light.where("top").select(F.col("parent").alias("node"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    merged = [F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS]]
    entering = common.stored(ended.unionByName(handed).groupBy("node").agg(*merged), "trie-entering")

    tops = []
    deepest = heavy.agg(F.max("depth")).first()[0]
    survivors = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        arrive = entering if survivors is None else entering.unionByName(survivors)
        level = heavy.where(F.col("depth") == depth).join(arrive, "node")
        level = level.groupBy("node", "parent", "depth", "chars").agg(*merged)
        level = level.withColumn("n_leaves", F.when(F.col("n_leaves") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")))
        level = level.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"))
        level = common.stored(level.select("node", "parent", "depth", "conv_id", *SUMS), "trie-level")
        survivors = level.groupBy(F.col("parent").alias("node")).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.count("*").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        )
        tops.append(level)

    cols = ["node", "conv_id", "depth", "parent_conv_id", *SUMS]
    nodes = light.where("not top").select(*cols)
    if tops:
        top = tops[0]
        for level in tops[1:]:
            top = top.unionByName(level)
        loose = light.where("top").select("node", "parent", "depth", "conv_id", *SUMS).unionByName(top)
        above = top.select(F.col("node").alias("_above"), F.col("conv_id").alias("parent_conv_id"))
        nodes = nodes.unionByName(_salted(loose, above, F.col("parent") == F.col("_above"), F.col("node"), "left").select(*cols))
    nodes = nodes.join(end.select("node", "ends_sha256"), "node", "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", *SUMS, F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256")
    )
