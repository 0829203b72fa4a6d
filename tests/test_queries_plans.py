"""Every query of the lakehouse against its DuckDB oracle (sf0.001; the
training-data queries have tests of their own), the driver entry point, and
plan properties: no Python UDFs, pushed filters, pruned
columns and partitions."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfscope.plans import views
from shelfscope.plans.queries import REGISTRY
from tests.conftest import SMALL
from tests.plan_util import plan_text

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    rows = df.collect()
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, rows) == _bag(dcols, cur.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_products" in df.columns and "sponsored_pct" in df.columns


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_udf_in_plans(spark, name):
    text = plan_text(entry.queries()[name](spark, SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in text


def test_scan_prunes_columns_and_pushes_filters(spark):
    from shelfscope.sources import fixtures

    df = fixtures.raw_cards(spark, SMALL).select("asin", "keyword").filter(F.col("keyword") == "view")
    text = plan_text(df)
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in text


def test_partition_pruning_on_day(spark, tmpdir_path):
    from shelfscope.sinks import tables

    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, d string").select(
        "k", F.col("d").cast("date").alias("ingested_at")
    )
    tables.replace_partitions(df, f"{tmpdir_path}/t")
    scan = views.on_day(spark.read.parquet(f"{tmpdir_path}/t"), "2024-01-02")
    text = plan_text(scan)
    assert "PartitionFilters: [isnotnull(ingested_at" in text and "2024-01-02" in text
    assert [r.k for r in scan.collect()] == ["b"]


def test_price_snapshot_single_shuffle(spark):
    from shelfscope.operators import facts
    from shelfscope.plans.queries import silver_cards

    text = plan_text(facts.price_snapshot_rows(silver_cards(spark, SMALL)))
    # dedup by (asin, keyword, day) and the snapshot aggregation: no self-join for the latest price
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_price_snapshot_takes_the_latest_row(spark):
    from shelfscope.operators import facts
    from shelfscope.plans.queries import silver_cards

    cards = silver_cards(spark, SMALL)
    got = {(r.asin, r.marketplace, r.ingested_at): (r.latest_price, r.discount_pct_latest) for r in facts.price_snapshot_rows(cards).collect()}
    want: dict = {}
    for r in cards.collect():
        key = (r.asin, r.marketplace, r.ingested_at)
        at = (r.source_extracted_at is not None, r.source_extracted_at, r.keyword)
        if key not in want or at > want[key][0]:
            want[key] = (at, (r.price_amount, r.discount_pct))
    assert got == {k: v for k, (_, v) in want.items()}
