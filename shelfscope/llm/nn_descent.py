"""Nearest neighbours by NN-descent and greedy graph search.

A graph with ``k`` neighbours per distinct vector starts from exact products
inside small blocks of k-means cells.  Every round joins each node's
neighbours with each other - neighbours of neighbours - as a Spark join and
aggregation: members of a node's neighbourhood (its neighbours, and a hashed
choice of those that point to it) come together with half-precision codes of
their vectors, and pairs that beat a member's worst neighbour become edges.
Rounds go on until at most ``DELTA`` of the edges are new.  Queries walk the
graph greedily: the best unexpanded nodes of a query's beam hand over their
neighbours, which are scored block by block, until at most ``DELTA`` of the
beams' nodes are unexpanded.  The beam's vectors are scored again in double precision at the end.

Equal vectors are one node.  Of a node's ids only the smallest ``top + 1``
can be among anyone's ``top`` nearest (ties go to smaller ids), so keeping
those loses nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

FIT_ROWS = 20_000
MOST_CELLS = 256
#: Vectors of a block of the first graph, and of a block of the search.
BLOCK = 1024
SEARCH_BLOCK = 2048
CELLS_EACH = 3
NEIGHBOURS = 32
REVERSE = 16
#: Share of new edges at which the descent ends, and of unexpanded beam nodes at
#: which the search ends.
DELTA = 0.01
BEAM = 224
FRONTIER = 56

_EDGE = "u long, v long, s float"
_ARROW_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("s", pa.float32())])


def _edges(u, v, s) -> pa.RecordBatch:
    cols = [np.concatenate(x) if x else np.zeros(0) for x in (u, v, s)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, (np.int64, np.int64, np.float32))], schema=_ARROW_EDGE)


def _codes(scale: pa.Array, code: pa.Array) -> np.ndarray:
    x = np.frombuffer(b"".join(code.to_pylist()), "<f2").reshape(len(code), -1).astype(np.float32)
    return x * np.asarray(scale, np.float32)[:, None]


def _nodes(rows: DataFrame, top: int) -> DataFrame:
    """(node, vec, ids): distinct vectors with their smallest ids."""
    few = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(32)))
    for keys in (["vec", "_salt"], ["vec"]):
        few = few.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).where(F.col("_n") <= top + 1)
    nodes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return common.stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nn-nodes")


def _coded(nodes: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(node, scale, code, cells): half-precision vectors and nearest cells."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)
    each = min(CELLS_EACH, len(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                x = vectors.matrix(b.column(1).slice(i, 4096))
                scale = np.abs(x).max(axis=1)
                scale = scale.astype(np.float32)
                code = (x / np.where(scale > 0, scale, 1).astype(np.float64)[:, None]).astype("<f2")
                near = np.argsort(-(vectors.unit(x) @ shared.value.T), axis=1, kind="stable")[:, :each]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 4096), pa.array(scale), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    names=["node", "scale", "code", "cells"],
                )

    return common.stored(nodes.select("node", "vec").mapInArrow(run, "node long, scale float, code binary, cells array<int>"), "nn-codes")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours of every node; an edge is ``fresh``
    if none of its copies is old."""
    one = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    place = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    return one.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k).drop("_n")


def _first_graph(coded: DataFrame, k: int) -> DataFrame:
    """Exact products inside blocks of cells."""
    placed = coded.select("node", "scale", "code", F.explode("cells").alias("cell"))
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node", "cell"), F.col("parts")).cast("int")
    blocks = placed.join(parts, "cell").groupBy("cell", part.alias("part")).agg(F.collect_list(F.struct("node", "scale", "code")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = b.column(0)[i].values
                ids, x = rows.field("node").to_numpy(), _codes(rows.field("scale"), rows.field("code"))
                if len(ids) < 2:
                    continue
                sim = x @ x.T
                np.fill_diagonal(sim, -np.inf)
                take = min(k, len(ids) - 1)
                at = np.argpartition(-sim, take - 1, axis=1)[:, :take]
                yield _edges([np.repeat(ids, take)], [ids[at].ravel()], [np.take_along_axis(sim, at, axis=1).ravel()])

    return _best(blocks.select("rows").mapInArrow(run, _EDGE).withColumn("fresh", F.lit(True)), k)


def _reverse(graph: DataFrame, most: int, seed: int) -> DataFrame:
    """(c, m): at most ``most`` hashed picks among those that point to c."""
    slot = F.pmod(F.xxhash64("u", F.lit(seed)), F.lit(most))
    return graph.groupBy(F.col("v").alias("c"), slot.alias("_slot")).agg(F.max_by("u", F.xxhash64("u", F.lit(seed + 1))).alias("m")).select("c", "m")


def _round(graph: DataFrame, coded: DataFrame, k: int, seed: int) -> DataFrame:
    """One descent step: neighbourhood members offer each other."""
    worst = graph.groupBy(F.col("u").alias("m")).agg(F.when(F.count("*") >= k, F.min("s")).otherwise(F.lit(float("-inf"))).alias("worst"))
    members = (
        graph.select(F.col("u").alias("c"), F.col("v").alias("m"))
        .unionByName(_reverse(graph, REVERSE, seed))
        .unionByName(coded.select(F.col("node").alias("c"), F.col("node").alias("m")))
        .distinct()
    )
    info = coded.select(F.col("node").alias("m"), "scale", "code").join(worst, "m", "left").fillna(float("-inf"), ["worst"])
    hoods = members.join(info, "m").groupBy("c").agg(F.collect_list(F.struct("m", "scale", "code", "worst")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v, s = [], [], []
            for i in range(b.num_rows):
                rows = b.column(0)[i].values
                ids, x = rows.field("m").to_numpy(), _codes(rows.field("scale"), rows.field("code"))
                sim = x @ x.T
                np.fill_diagonal(sim, -np.inf)
                # A member keeps k edges, so its k best here are all that can matter.
                take = min(k, len(ids) - 1)
                if take < 1:
                    continue
                # Only pairs above a member's worst neighbour are a gain.
                sim[sim <= np.asarray(rows.field("worst"), np.float32)[:, None]] = -np.inf
                at = np.argpartition(-sim, take - 1, axis=1)[:, :take]
                got = np.take_along_axis(sim, at, axis=1)
                a, j = np.nonzero(got > -np.inf)
                u.append(ids[a])
                v.append(ids[at[a, j]])
                s.append(got[a, j])
            yield _edges(u, v, s)

    offers = hoods.select("rows").mapInArrow(run, _EDGE).withColumn("fresh", F.lit(True))
    return _best(graph.withColumn("fresh", F.lit(False)).unionByName(offers), k)


def build_graph(coded: DataFrame, k: int = NEIGHBOURS, delta: float = DELTA) -> DataFrame:
    """(u, v, s): the ``k`` nearest found for every node, by rounds until at
    most ``delta`` of the edges are new.  The driver sees two counts a round."""
    graph = common.stored(_first_graph(coded, k), "nn-graph")
    for r in itertools.count():
        graph = common.stored(_round(graph, coded, k, 2 * r), "nn-graph")
        edges, fresh = graph.agg(F.count("*"), F.count_if("fresh")).first()
        if fresh <= delta * edges:
            return graph.drop("fresh")


def _score(pairs: DataFrame, coded: DataFrame, blocks: int) -> DataFrame:
    """(u, v, s) of the pairs: a query's code goes once to each block of
    vectors that holds some of its candidates."""
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    asked = pairs.groupBy("u", block("v").alias("block")).agg(F.collect_list("v").alias("vs"))
    asked = asked.join(coded.select(F.col("node").alias("u"), F.col("scale").alias("q_scale"), F.col("code").alias("q_code")), "u")
    held = coded.select(block("node").alias("held_block"), "node", "scale", "code")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], _ARROW_EDGE)
        ids = right.column("node").to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], _codes(right.column("scale").combine_chunks(), right.column("code").combine_chunks())[order]
        q = _codes(left.column("q_scale").combine_chunks(), left.column("q_code").combine_chunks())
        lists = left.column("vs").combine_chunks()
        wanted = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
        s = np.concatenate([np.einsum("ij,ij->i", q[row[i : i + 65536]], x[np.searchsorted(ids, wanted[i : i + 65536])]) for i in range(0, len(row), 65536)])
        return pa.Table.from_batches([_edges([left.column("u").to_numpy()[row]], [wanted], [s])])

    return asked.groupBy("block").cogroup(held.groupBy("held_block")).applyInArrow(run, _EDGE)


def search(queries: DataFrame, graph: DataFrame, coded: DataFrame, blocks: int, beam: int = BEAM, delta: float = DELTA, frontier: int = FRONTIER) -> DataFrame:
    """(u, v, s): the beam of every query node (column ``u``) after greedy
    steps from its own neighbours until at most ``delta`` of all beams is left to
    expand."""
    around = graph.select(F.col("u").alias("c"), F.col("v").alias("m")).unionByName(_reverse(graph, REVERSE, 99)).distinct()
    around = common.stored(around, "nn-around")
    state = common.stored(graph.join(queries, "u", "left_semi").withColumn("done", F.lit(False)), "nn-beam")
    while True:
        rows, left = state.agg(F.count("*"), F.count_if(~F.col("done"))).first()
        if left <= delta * rows:
            return state.select("u", "v", "s")
        open_first = Window.partitionBy("u").orderBy("done", F.desc("s"), "v")
        picked = state.withColumn("_n", F.row_number().over(open_first)).withColumn("now", ~F.col("done") & (F.col("_n") <= frontier)).drop("_n")
        picked = common.stored(picked, "nn-picked")
        fresh = picked.where("now").select("u", F.col("v").alias("c")).join(around, "c").select("u", F.col("m").alias("v")).where("u <> v").distinct()
        fresh = fresh.join(picked.select("u", "v"), ["u", "v"], "left_anti")
        scored = _score(fresh, coded, blocks).withColumn("done", F.lit(False))
        both = picked.select("u", "v", "s", (F.col("done") | F.col("now")).alias("done")).unionByName(scored)
        place = Window.partitionBy("u").orderBy(F.desc("s"), "v")
        state = common.stored(both.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= beam).drop("_n"), "nn-beam")


def nearest(
    df: DataFrame,
    every: int = 20,
    top: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    delta: float = DELTA,
    beam: int = BEAM,
) -> DataFrame:
    """For each id divisible by ``every``, its ``top`` nearest other ids by
    inner product: query_id, rank, vec_id, score (double precision, original
    vectors), nearest first, ties to the smaller id.

    Vectors that are null, zero, hold null or non-finite components or do not
    have the commonest length take no part, nor do rows without id; repeated
    rows count once.  Fewer candidates than ``top`` give fewer rows, an empty
    table none.  Other columns are not read.
    """
    common.ship(df.sparkSession)
    rows = df.select(df[id_col].cast("long").alias("id"), vectors.floats(df, vec_col).alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & vectors.usable("vec"))
    fit = vectors.sample(rows, "vec", "vec", FIT_ROWS)
    rows = common.stored(rows.where(F.size("vec") == (fit.shape[1] or -1)).distinct(), "nn-rows")
    nodes = _nodes(rows, top)
    n = nodes.count()
    centroids = vectors.spherical_kmeans(fit, max(1, min(MOST_CELLS, -(-n // BLOCK))))
    coded = _coded(nodes, centroids if centroids.size else np.zeros((1, 1)))
    graph = build_graph(coded, max(NEIGHBOURS, top + 2), delta)
    asked = common.stored(rows.where(F.col("id") % every == 0).join(nodes.select("vec", "node"), "vec").select(F.col("id").alias("query_id"), F.col("node").alias("u")), "nn-queries")
    found = search(asked.select("u").distinct(), graph, coded, max(1, -(-n // SEARCH_BLOCK)), max(beam, top + 2), delta).select("u", "v")
    own = asked.select("u", F.col("u").alias("v")).distinct()
    pairs = found.unionByName(own)
    left = nodes.select(F.col("node").alias("u"), F.col("vec").alias("a"))
    right = nodes.select(F.col("node").alias("v"), F.col("vec").alias("b"), "ids")
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)
    exact = pairs.join(left, "u").join(right, "v").select("u", "ids", product.alias("score"))
    hits = exact.join(asked, "u").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id").distinct()
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
