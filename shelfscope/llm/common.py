"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: A key is hot if it holds more than one in this many rows.
HOT_SHARE = 1000
_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from any
    working folder.  On a cluster the package is installed or passed with
    ``--py-files``, so nothing is done there."""
    sc = spark.sparkContext
    if not sc.master.startswith("local[") or sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="shelfscope-ship-"), "shelfscope_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(PACKAGE):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder of the cluster's shared
    folder and read it back: cuts the lineage, keeps column pruning, and
    survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_by_key(rows: DataFrame, info: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``info``, which has one row per key and in
    ``count`` how many of the ``total`` rows hold it.  Keys that hold over
    1/``HOT_SHARE`` of all rows - fewer than ``HOT_SHARE`` of them - are
    broadcast, so their rows stay where they are; all other rows are shuffled
    by key.  Null keys find nothing."""
    hot = F.col(count) * HOT_SHARE > total
    few = F.broadcast(info.where(hot).drop(count))
    return rows.join(few, keys).unionByName(rows.join(F.broadcast(info.where(hot).select(*keys)), keys, "left_anti").join(info.where(~hot).drop(count), keys))


def id_type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def read_bytes(path: str) -> bytes:
    """A vocabulary or model file on the driver (a few MB at most: the file's
    size is the bound on what is broadcast)."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path}: {len(data)} bytes is more than a vocabulary file should have")
    return data


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive items into runs of about ``most`` in total size."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
