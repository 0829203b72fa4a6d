"""A key with a third of all rows does not put them into one task, also
without adaptive execution and size-based broadcasts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfscope.llm import common, embedding_dedup, simhash, warc
from tests.llm.test_embedding_dedup import brute


@pytest.fixture()
def plain(spark):
    """A session without adaptive execution and without size-based broadcasts."""
    fixed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in fixed}
    for k, v in fixed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _largest_part(df) -> int:
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_a_short_page_on_a_third_of_all_rows(plain):
    n = F.col("id")
    pages = plain.range(9000).select(
        n.alias("page_id"), F.concat(F.lit("http://h/"), n).alias("url"),
        F.when(n % 3 == 0, F.repeat(F.lit("a"), 900)).when(n % 3 == 1, F.repeat(F.lit("b"), 1200)).otherwise(F.concat(F.lit("page "), n)).alias("html"),
    )
    rows = warc.plan_records(pages, "page_id", "url", "html", 1000)
    assert rows.count() == 9000 and rows.where("first is not null").count() == 2999
    assert _largest_part(rows) < 2000  # 8 partitions


def test_rows_of_a_hot_key_stay_where_they_are(plain):
    rows = plain.range(9000).repartition(8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("fp"), "id")
    rows = rows.unionByName(plain.createDataFrame([(None, 7)], "fp long, id long"))
    info = rows.where("fp is not null").groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    got = common.join_by_key(rows, info, ["fp"], "n", 9001)
    assert got.columns == ["fp", "id", "least"]
    assert got.count() == 9000 and got.where("fp = -1 and least = 0").count() == 3000
    assert got.where("fp >= 0 and least <> id").count() == 0
    assert _largest_part(got) < 2000
    assert common.join_by_key(rows.limit(0), info.limit(0), ["fp"], "n", 0).count() == 0


def test_the_largest_tile_class_is_cut_into_groups(plain, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_TILES", 2)
    # One bit in each of two quarters: all in one class, and two bits apart if either bit agrees.
    fps = plain.createDataFrame([((1 << i) | (1 << 16 + j),) for i in range(16) for j in range(16)], "fp long")
    got = simhash.classes(fps, radius=2, block=4)
    assert got.count() == 256 and got.select("root").distinct().collect() == [((1 | 1 << 16),)]


def test_cells_beyond_sixty_four(plain, monkeypatch):
    import numpy as np

    monkeypatch.setattr(embedding_dedup, "GROUP_BLOCKS", 2)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(130, 4))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.2, np.repeat(x[:1], 90, axis=0)])
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    df = plain.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in embedding_dedup.near_duplicates(df, 0.95, cell_rows=3, block=2).collect()]
    assert sorted(got) == sorted(brute(rows, 0.95))
