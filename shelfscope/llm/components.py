"""Connected components of an edge table by alternating large-star and
small-star steps, each one join and one aggregation on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(e: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = e.select(F.col("v").alias("n"), F.col("u").alias("o")).unionByName(e.select(F.col("u").alias("n"), F.col("v").alias("o")))
    least = both.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"))
    return both.where("o > n").join(least, "n").select(F.col("o").alias("v"), F.col("m").alias("u")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest."""
    least = e.groupBy("v").agg(F.min("u").alias("m"))
    moved = e.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.select("v", F.col("m").alias("u"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): for every node that is not the smallest of its
    component, that smallest node.  Loops and repeated edges are harmless; an
    empty edge table gives no rows.  Edges are written to the shared folder
    after every round; only a row count and a checksum reach the driver."""
    e = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v").distinct()
    e = stored(e, "components")
    state = _state(e)
    while state[0]:
        nxt = stored(_small_star(_large_star(e)), "components")
        was, e, state = state, nxt, _state(nxt)
        if was == state:
            break
    return e.select(F.col("v").alias("node"), F.col("u").alias("label"))
