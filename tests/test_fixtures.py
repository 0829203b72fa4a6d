"""The fixture adapters keep every row of the driver tables (no sampling, id
subsets or caps)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscope.sources import fixtures
from tests.conftest import SMALL


def test_cards_and_listings_cover_whole_tables(spark):
    events = fixtures.table(spark, SMALL, "events")
    lineitem = fixtures.table(spark, SMALL, "lineitem")
    part = fixtures.table(spark, SMALL, "part")
    assert fixtures.raw_cards(spark, SMALL).count() == events.count()
    matched = lineitem.join(part, lineitem.l_partkey == part.p_partkey).count()
    assert fixtures.raw_listings(spark, SMALL).count() == matched == lineitem.count()
    orders = fixtures.table(spark, SMALL, "orders")
    days = orders.select("o_custkey", F.to_date("o_orderdate")).distinct().count()
    assert fixtures.customer_snapshots(spark, SMALL).count() == days
