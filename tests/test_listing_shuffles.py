"""Listings are dealt once, by their own key, however many steps group by it."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfscope.functions.hashing import attr_hash
from shelfscope.operators import dimension
from shelfscope.plans import queries
from shelfscope.session import ALL_KEYS, SHUFFLE_CLEANUP, apply_defaults, materialize
from shelfscope.sinks import tables
from shelfscope.sources import fixtures
from tests.conftest import SMALL
from tests.plan_util import plan_text


@pytest.fixture()
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _tables(spark, path, lines, parts):
    day = datetime(2024, 1, 2)
    li = [(o, p, 1, n, 3.0, "A", "O", day) for o, p, n in lines]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    pa = [(p, f"name of {p}", "Brand#1", "TYPE", 5) for p in parts]
    spark.createDataFrame(pa, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{path}/part.parquet")


def _exchanges(df) -> int:
    return sum("Exchange hashpartitioning" in x for x in plan_text(df, "simple").splitlines())


def test_lines_and_parts_are_the_only_rows_dealt(spark, no_broadcast):
    assert _exchanges(queries.silver_listings(spark, SMALL)) == 2
    assert _exchanges(queries.product_dim(spark, SMALL)) == 2


def test_keys_longer_than_an_asin_and_null_keys_meet_only_their_own_part(spark, no_broadcast, tmpdir_path):
    keys = (7, 1234567890, 1234567891, -5, None)
    _tables(spark, tmpdir_path, [(i, k, 1) for i, k in enumerate(keys)], keys)
    got = fixtures.raw_listings(spark, tmpdir_path).select("source_file", "title").collect()
    assert {r.source_file: r.title for r in got} == {f"details_{i}_1.json": f"name of {k} TYPE" for i, k in enumerate(keys) if k is not None}
    assert len(got) == 4


def test_a_part_with_most_lines_is_split_over_tasks(spark, no_broadcast, tmpdir_path):
    _tables(spark, tmpdir_path, [(i, 7 if i % 3 else i, 1 + i % 2) for i in range(30000)], range(30000))
    conf = {"advisoryPartitionSizeInBytes": "16k", "skewJoin.skewedPartitionThresholdInBytes": "16k", "skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in conf.items():
        spark.conf.set(f"spark.sql.adaptive.{k}", v)
    try:
        part = queries.silver_listings(spark, tmpdir_path, ["asin", "ingested_at", "title"])
        assert len({(r.asin, r.title) for r in part.collect()}) == 10001
        assert "skew=true" in plan_text(part, "simple")
    finally:
        for k in conf:
            spark.conf.unset(f"spark.sql.adaptive.{k}")


def test_versions_open_where_the_hash_changes(spark):
    rows = [(1, "a~", "b"), (2, "a", "~b"), (3, "a~", "b"), (4, None, "b"), (5, "", "b"), (6, "", None), (7, None, None), (8, "x", None)]
    snaps = spark.createDataFrame([("A", "US", date(2024, 1, d), t, b) for d, t, b in rows], "asin string, marketplace string, ingested_at date, title string, brand string")
    tracked = ["title", "brand"]
    got = dimension.scd2_rebuild(snaps, tracked=tracked).orderBy("effective_date").select("effective_date", "expiry_date", "_attr_hash").collect()
    hashes = [r[0] for r in snaps.orderBy("ingested_at").select(attr_hash(tracked)).collect()]
    opened = [i for i, h in enumerate(hashes) if i == 0 or h != hashes[i - 1]]
    assert [r._attr_hash for r in got] == [hashes[i] for i in opened]
    assert [r.effective_date for r in got] == [date(2024, 1, 1 + i) for i in opened] and got[-1].expiry_date is None
    assert [r.expiry_date for r in got[:-1]] == [date(2024, 1, i) for i in opened[1:]]


def test_no_snapshot_carries_its_hash_through_the_exchange(spark):
    snaps = spark.createDataFrame([("A", "US", date(2024, 1, 1), "t")], "asin string, marketplace string, ingested_at date, title string")
    lines = plan_text(dimension.scd2_rebuild(snaps.repartition(3), tracked=["title"]), "simple").splitlines()
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert not any("sha2" in x for x in lines[dealt:])


def test_derived_columns_do_not_travel_and_are_stored_alike(spark, tmpdir_path):
    snaps = spark.createDataFrame(
        [("A", "US", date(2024, 1, d), t) for d, t in ((1, "x"), (2, "y"), (3, None))] + [(None, "US", date(2024, 1, 1), "z"), ("B", "DE", None, "z")],
        "asin string, marketplace string, ingested_at date, title string",
    )
    dim = dimension.scd2_rebuild(snaps, tracked=["title"])
    tables.write_dimension(dim, f"{tmpdir_path}/plain", "2024-01-03")
    tables.write_dimension(dim, f"{tmpdir_path}/late", "2024-01-03", dimension.derived_columns(tracked=["title"]))
    plain, late = (tables.read_dimension(spark, f"{tmpdir_path}/{x}") for x in ("plain", "late"))
    assert plain.schema == late.schema
    assert sorted(map(str, plain.collect())) == sorted(map(str, late.collect())) == sorted(map(str, dim.collect()))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def files() -> int:
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return sum(name.startswith("shuffle_") for d in folders for _, _, names in os.walk(d) for name in names)

    was, before = spark.conf.get(SHUFFLE_CLEANUP), files()
    stored = materialize(spark, spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert files() <= before and stored.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == was


def test_lookup_leaves_listings_where_they_are(spark, no_broadcast):
    dim = spark.createDataFrame([("A", "US", "sk", None, True)], "asin string, marketplace string, product_sk string, expiry_date date, is_current boolean")
    fact = queries.silver_listings(spark, SMALL, ["asin", "marketplace", "ingested_at"])
    found = dimension.lookup_sk(fact, dim)
    was = spark.conf.get(ALL_KEYS)
    stored = materialize(spark, found, partly_dealt=True)
    assert spark.conf.get(ALL_KEYS) == was and stored.count() == fact.count()
    spark.conf.set(ALL_KEYS, "false")
    try:
        assert _exchanges(dimension.lookup_sk(fact, dim)) == 3  # lines, parts and versions
    finally:
        spark.conf.set(ALL_KEYS, was)


def test_partitions_are_small_enough_to_sort_unless_the_caller_sizes_them(spark):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    s = spark.newSession()
    s.conf.unset(advisory)
    apply_defaults(s)
    assert s.conf.get(advisory) == "8m"
    s.conf.set(advisory, "64m")
    apply_defaults(s)
    assert s.conf.get(advisory) == "64m"
