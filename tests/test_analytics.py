"""Edge cases of the market-entry definitions (AN-01, AN-03, AN-04, AN-05)."""

from __future__ import annotations

from datetime import date

from shelfscope.operators import analytics

COLS = "keyword string, marketplace string, ingested_at date, total_monthly_sales_min long, sponsored_pct double, " \
       "avg_ratings_count long, best_seller_count long"


def test_opportunity_normalises_per_day_and_constant_inputs(spark):
    d = date(2024, 1, 1)
    mart = spark.createDataFrame(
        [("a", "US", d, 100, 10.0, 50, 0), ("b", "US", d, 300, 10.0, 150, 1), ("c", "DE", d, 5, None, 7, 0)], COLS
    )
    got = {r.keyword: (r.opportunity_score, r.is_target) for r in analytics.opportunity(mart).collect()}
    # a: demand 0, competition constant -> 0, barrier 0; b: 0.5*1 - 0.2*1
    assert got["a"] == (0.0, True) and got["b"] == (0.3, True)
    # a lone keyword in its day: every input constant -> 0; a null input keeps the score null
    assert got["c"] == (None, None)


def test_stability_needs_two_days_and_spread(spark):
    rows = [("k", "US", date(2024, 1, i), v, 0.0, 0, 0) for i, v in [(1, 10), (2, 20), (3, 30)]]
    rows += [("one", "US", date(2024, 1, 1), 10, 0.0, 0, 0), ("flat", "US", date(2024, 1, 1), 5, 0.0, 0, 0),
             ("flat", "US", date(2024, 1, 2), 5, 0.0, 0, 0)]
    got = {r.keyword: (r.n_days, r.stability_score, r.trend_slope) for r in analytics.stability(spark.createDataFrame(rows, COLS)).collect()}
    assert got["k"] == (3, 2.0, 10.0)
    assert got["one"][1] is None and got["flat"][1] is None


def test_ad_band_boundaries(spark):
    d = date(2024, 1, 1)
    vals = [29.99, 30.0, 50.0, 50.01, None]
    mart = spark.createDataFrame([(str(v), "US", d, 0, v, 0, 0) for v in vals], COLS)
    got = {r.keyword: r.ad_band for r in analytics.ad_saturation(mart).collect()}
    assert got == {"29.99": "healthy", "30.0": "competitive", "50.0": "competitive", "50.01": "red_flag", "None": None}


def test_fragmentation_at_or_below_both_medians(spark):
    d = date(2024, 1, 1)
    mart = spark.createDataFrame(
        [("a", "US", d, 0, 0.0, 10, 0), ("b", "US", d, 0, 0.0, 20, 1), ("c", "US", d, 0, 0.0, 30, 2)], COLS
    )
    got = {r.keyword: r.is_fragmented for r in analytics.fragmentation(mart).collect()}
    assert got == {"a": True, "b": True, "c": False}
