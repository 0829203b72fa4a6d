"""A key holding a large share of the rows: results stay exact and the heavy
aggregations pre-aggregate inside each map task before the shuffle."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from shelfscope.operators import clean, facts, marts
from shelfscope.operators.dedup import latest_per
from shelfscope.sources import fixtures
from tests.conftest import MEDIUM
from tests.plan_util import plan_text


def _skewed_cards(spark):
    cards = fixtures.raw_cards(spark, MEDIUM)
    # about 40% of all cards move to one keyword: one hot group per day
    hot = F.xxhash64("source_extracted_at") % 5 < 2
    return cards.withColumn("keyword", F.when(hot, F.lit("hot")).otherwise(F.col("keyword")))


def test_hot_keyword_mart_matches_pandas(spark):
    silver = clean.clean_cards(_skewed_cards(spark), audit_col=None)
    mart = marts.keyword_daily(facts.ranking_rows(silver), audit_col=None)
    got = mart.toPandas().set_index(["keyword", "marketplace", "ingested_at"]).sort_index()

    pdf = silver.select("asin", "keyword", "marketplace", "ingested_at", "is_sponsored", "price_amount", "monthly_sales").toPandas()
    g = pdf.groupby(["keyword", "marketplace", "ingested_at"])
    exp = pd.DataFrame(
        {
            "total_products": g["asin"].nunique(),
            "sponsored_count": g["is_sponsored"].sum(),
            "min_price": g["price_amount"].min(),
            "max_price": g["price_amount"].max(),
            "total_monthly_sales_min": g["monthly_sales"].sum(min_count=1),
        }
    ).sort_index()
    share = pdf["keyword"].eq("hot").mean()
    assert share > 0.3
    assert len(got) == len(exp)
    for c in exp.columns:
        a, b = got[c].astype("float64"), exp[c].astype("float64")
        assert ((a - b).abs().fillna(0) < 1e-9).all() and (a.isna() == b.isna()).all(), c


def test_dedup_and_mart_pre_aggregate_before_shuffle(spark):
    silver = clean.clean_cards(_skewed_cards(spark), audit_col=None)
    text = plan_text(marts.keyword_daily(facts.ranking_rows(silver), audit_col=None))
    tree = text.split("\n\n")[0]
    # every Exchange on a grouping key sits above a partial aggregate
    assert "partial_max_by" in text  # grain dedup
    assert "partial_count" in text or "partial_sum" in text  # mart
    assert tree.count("Exchange") >= 2


def test_latest_per_on_hot_key_keeps_every_other_key(spark):
    df = spark.range(0, 50000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ts"),
    )
    out = latest_per(df, ["k"], ["ts"])
    rows = {r.k: r.ts for r in out.collect()}
    assert rows["hot"] == 49999 and len(rows) == 1 + 50000 // 3 + 1
