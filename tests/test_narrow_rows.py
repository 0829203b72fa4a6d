"""Rows are cut to what their reader needs before they are sorted and shuffled."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import functions as F

from shelfscope.operators import clean, dimension, facts
from shelfscope.sources import fixtures, raw
from tests.conftest import SMALL
from tests.plan_util import plan_text


def test_dedup_carries_only_the_columns_wanted(spark):
    bronze = fixtures.raw_listings(spark, SMALL)
    twice = bronze.unionByName(bronze.withColumn("title", F.concat("title", F.lit("!"))))
    narrow = clean.clean_listings(twice, audit_col=None, columns=dimension.snapshot_columns(dimension.PRODUCT_TRACKED))
    whole = clean.type_listings(clean.latest_raw(twice, clean.LISTING_KEYS)).select(*narrow.columns)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect()))
    dedup = [x for x in plan_text(narrow).splitlines() if "max_by" in x]
    assert dedup and not any("images" in x or "source_extracted_at" in x for x in dedup)


def test_asof_keys_are_those_of_the_versions(spark):
    schema = "asin string, marketplace string, ingested_at date, title string"
    days = [("a", date(2024, 1, 2), "x"), ("a", date(2024, 1, 5), "y"), ("b", None, "x"), ("b", date(2024, 1, 4), "y"), (None, date(2024, 1, 2), "x")]
    snaps = spark.createDataFrame([(a, "US", d, t) for a, d, t in days], schema)
    dim = dimension.scd2_rebuild(snaps, tracked=["title"])
    asked = snaps.select("asin", "marketplace", "ingested_at").unionByName(
        spark.createDataFrame([("a", "US", date(2024, 1, 1)), ("b", "US", date(2024, 1, 1)), ("b", "US", date(2024, 1, 9))], "asin string, marketplace string, ingested_at date")
    )
    rows = lambda df: sorted(map(str, df.select("asin", "ingested_at", "product_sk").collect()))
    got = rows(facts.keyed_performance(asked, dim, lookup="asof", audit_col=None))
    assert got == rows(dimension.asof_lookup(asked, dim)) and len(got) == 8


def test_multi_line_files_are_compressed_and_shuffled_once(spark, tmpdir_path):
    rows = spark.range(6).select(
        F.lit("2024-01-01").alias("d"), (F.col("id") % 2).alias("file"), F.lit("US").alias("marketplace"), F.lit("2024-01-01T00:00:00").alias("extracted_at"),
        F.concat(F.lit('{"asin": "A'), "id", F.lit('"}')).alias("p"), F.lit(False).alias("cut"),
    )
    raw.write_multi_line(rows, tmpdir_path, "details")
    files = [x for x in os.listdir(f"{tmpdir_path}/details/d=2024-01-01") if x.startswith("part-")]
    assert len(files) == 2 and all(x.endswith(".txt.gz") for x in files)
    read, bad = raw.ingest(spark, tmpdir_path, "details", raw.LISTING_RECORD, raw.LISTING_LIFT, layout="{root}/{source}/d={date}/*.txt*")
    assert sorted(r.asin for r in read.collect()) == [f"A{i}" for i in range(6)] and bad.count() == 0
