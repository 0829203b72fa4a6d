"""Embedding near-dedup: spherical k-means cells, blocked cosine products
within cells, one representative per group.

Equal vectors of a label are collapsed first (with their count), so a group of
exact copies is one vector.  Each distinct vector lives in the cell of its
nearest centroid.  Two unit vectors whose cosine is at least ``t`` are at most
``d = sqrt(2 - 2 t)`` apart; if their nearest centroids ``p`` and ``q``
differ, both are within ``d`` of the plane midway between ``p`` and ``q``,
which lies between them.  A vector is therefore also a guest in each cell of a
smaller number whose midway plane is that near, and comparing residents with
residents and guests of their cell meets every possible link exactly once,
whatever the centroids.  Cells are cut into blocks; a pair of blocks is one
matrix product, from which only link counts and a spanning forest leave the
task, and a cell's blocks are dealt to tasks in groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, vectors
from .components import components

#: Vectors that the centroids are fitted on, and the most centroids (beyond
#: MOST_CELLS * CELL_ROWS distinct vectors cells grow instead).
FIT_ROWS = 20_000
MOST_CELLS = 2048
CELL_ROWS = 4096
#: Resident blocks of a cell that one task compares with the cell's other blocks.
GROUP_BLOCKS = 8
EPS = 1e-9


def _cells(x: np.ndarray, centroids: np.ndarray, reach: float) -> list[list[int]]:
    """For each unit vector its own cell, then the cells it is a guest of:
    those of smaller numbers whose midway plane is within ``reach``."""
    sim = x @ centroids.T
    home = sim.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centroids[home] @ centroids.T)))
    gap = sim[np.arange(len(x)), home][:, None] - sim
    near = (gap <= reach * apart + EPS) & (np.arange(len(centroids))[None, :] < home[:, None])
    return [[int(h), *np.flatnonzero(g).tolist()] for h, g in zip(home, near)]


def _assign(classes: DataFrame, centroids: np.ndarray, threshold: float) -> DataFrame:
    """(cls, cell, guest, label, dim, vec): one row per cell that a vector is in."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(centroids)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    schema = T.StructType([T.StructField("cls", T.LongType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])
    dim = centroids.shape[1] if centroids.size else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for i in range(0, b.num_rows, 2048):
                vec = b.column(1).slice(i, 2048)
                got += _cells(vectors.unit(vectors.matrix(vec)), shared.value, reach)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32()))], names=["cls", "cells"])

    regular = classes.where(F.size("vec") == dim).select("cls", "vec").mapInArrow(run, schema)
    other = classes.where(F.size("vec") != dim).select("cls", F.array(F.lit(-1)).alias("cells"))
    placed = regular.unionByName(other).select("cls", F.posexplode("cells").alias("pos", "cell"))
    return placed.join(classes, "cls").select("cls", "cell", (F.col("pos") > 0).alias("guest"), "label", F.size("vec").alias("dim"), "vec")


def _product(ids_a, a, ids_b, b, threshold: float, same: bool):
    """Link counts of both sides and a spanning forest of the links."""
    close = a @ b.T >= threshold
    if same:
        np.fill_diagonal(close, False)
    counts = [(ids_a, close)] if same else [(ids_a, close), (ids_b, close.T)]
    nodes = ids_a if same else np.concatenate([ids_a, ids_b])
    shift = 0 if same else len(ids_a)
    label, edges = np.arange(len(nodes)), []
    for r in np.flatnonzero(close.any(axis=1)):
        groups = np.unique(label[np.flatnonzero(close[r]) + shift])
        groups = groups[groups != label[r]]
        edges += [(nodes[r], nodes[g]) for g in groups]
        if len(groups):
            label[np.isin(label, groups)] = label[r]
    return counts, edges


def _compare(tiles: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): n links' weight for class a, or an edge a - b (n null)."""
    keys = ["label", "dim", "cell"]
    group = F.floor(F.col("block") / F.lit(GROUP_BLOCKS)).cast("int").alias("group")
    home = tiles.where(~F.col("guest")).select(*keys, group, F.col("block").alias("left_block"), F.col("rows").alias("left_rows"))
    # Every group of residents meets all blocks of its cell from its own first on.
    met = tiles.join(home.select(*keys, "group").distinct(), keys).where(F.col("guest") | (F.col("block") >= F.col("group") * GROUP_BLOCKS))
    both = (
        home.join(met, [*keys, "group"])
        .where(F.col("guest") | (F.col("block") >= F.col("left_block")))
        .select("left_rows", "rows", (~F.col("guest") & (F.col("block") == F.col("left_block"))).alias("same"))
    )

    def side(rows: pa.StructArray):
        vec = vectors.unit(vectors.matrix(rows.field("vec")))
        return rows.field("cls").to_numpy(), rows.field("n").to_numpy(), vec

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, same in enumerate(batch.column(2).to_pylist()):
                left, right = batch.column(0)[i].values, batch.column(1)[i].values
                ids_a, n_a, a = side(left)
                ids_b, n_b, b = side(right)
                counts, edges = _product(ids_a, a, ids_b, b, threshold, same)
                weights = [n_b, n_a]
                out_a, out_b, out_n = [], [], []
                for (ids, close), weight in zip(counts, weights):
                    total = close @ weight
                    at = np.flatnonzero(total)
                    out_a += ids[at].tolist()
                    out_b += [None] * len(at)
                    out_n += total[at].tolist()
                out_a += [int(x) for x, _ in edges]
                out_b += [int(y) for _, y in edges]
                out_n += [None] * len(edges)
                if out_a:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()), pa.array(out_n, pa.int64())], names=["a", "b", "n"]
                    )

    return both.mapInArrow(run, "a long, b long, n long")


def near_duplicates(
    df: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    cell_rows: int = CELL_ROWS,
    block: int = 512,
) -> DataFrame:
    """One row per input row: id, ``n_links`` (other rows of the same label at
    a cosine of ``threshold`` or more), ``component_id`` (smallest id that
    links reach, its own included) and ``kept`` (id = component_id).

    Rows with a null label, or a vector that is null, zero or holds null or
    non-finite components, link with nothing and are kept; vectors of
    different lengths never link.  Repeated rows count as others of each
    other; a component without any id has a null component_id and its rows
    have ``kept`` null.  An empty table gives no rows.  Other columns are not
    read.
    """
    if not -1 < threshold <= 1:
        raise ValueError("threshold must lie above -1 and not above 1")
    common.ship(df.sparkSession)
    rows = df.select(df[id_col].alias("id"), df[label_col].alias("label"), vectors.floats(df, vec_col).alias("vec"))
    ok = F.col("label").isNotNull() & vectors.usable("vec")
    good = rows.where(ok)
    classes = common.stored(
        good.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("id").alias("least")).withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes",
    )
    total = classes.count()
    centroids = vectors.spherical_kmeans(vectors.sample(classes, "cls", "vec", FIT_ROWS), max(1, min(MOST_CELLS, total // cell_rows)))
    placed = _assign(classes.select("cls", "label", "vec"), centroids, threshold).join(classes.select("cls", "n"), "cls")
    keys = ["label", "dim", "cell", "guest"]
    parts = placed.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    tiles = (
        placed.join(parts, keys)
        .groupBy(*keys, F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("block"))
        .agg(F.collect_list(F.struct("cls", "n", "vec")).alias("rows"))
    )
    tiles = common.stored(tiles, "vector-tiles")
    found = common.stored(_compare(tiles, threshold), "vector-links")
    linked = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n_others"))
    roots = components(found.where("b is not null"))
    tops = roots.select(F.col("node").alias("cls"), F.col("label").alias("top"))
    info = (
        classes.join(linked, "cls", "left")
        .join(tops, "cls", "left")
        .select("label", "vec", "least", "n", (F.col("n") - 1 + F.coalesce("n_others", F.lit(0))).alias("n_links"), F.coalesce("top", "cls").alias("root"))
    )
    best = info.groupBy("root").agg(F.min("least").alias("component_id"))
    info = common.stored(info.join(best, "root").select("label", "vec", "n", "n_links", "component_id"), "vector-components")
    linked_rows = common.join_by_key(good, info, ["label", "vec"], "n", info.agg(F.sum("n")).first()[0] or 0).select("id", "n_links", "component_id")
    alone = rows.where(~ok).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked_rows.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component_id"), (F.col("id") == F.col("component_id")).alias("kept"))
