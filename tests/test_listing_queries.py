"""Queries on listings deal lines and parts, not the listings rendered of them."""

from __future__ import annotations

import re

import pytest

from shelfscope.plans import queries
from tests.conftest import SMALL
from tests.plan_util import plan_text

#: What a query deals by which keys, beside lines and parts: versions, cards, prices.
DEALT = {
    "scd2_apply_last_day": {"_k0, _k1", "_n0, _n1"},
    "price_lookup": {"product_sk", "asin, marketplace", "asin, marketplace, ingested_at", "asin, keyword, ingested_at"},
    "dim_asof": {"asin, marketplace, ingested_at", "asin, keyword, ingested_at", "_k0, _k1, _day", "_k0, _k1"},
    "scd2_rebuild": set(),
    "dq_version_chain": {"product_sk"},
    "dim_current": set(),
    "dim_totals": set(),
    "dq_change_pairs": set(),
    "dq_duplicate_current": set(),
    "listing_ranks": set(),
    "fact_price_snapshot": {"asin, marketplace", "asin, marketplace, ingested_at", "asin, keyword, ingested_at"},
    "dq_null_keys": {"asin, keyword, ingested_at"},
}


@pytest.mark.parametrize("name", DEALT)
def test_rendered_listings_stay_where_lines_met_parts(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "materialize", lambda spark, df, **_: df)  # one plan
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(queries.REGISTRY[name](spark, SMALL), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    keys = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    # every branch that renders listings holds one join, whose two sides are dealt by asin
    assert keys.count("_asin") == keys.count("asin") > 0
    assert set(keys) - {"_asin", "asin"} == DEALT[name]
