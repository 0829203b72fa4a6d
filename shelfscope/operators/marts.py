"""Gold marts (PL-08, PL-09): pre-aggregated daily KPIs.

Exact distinct counts are planned by Spark as a two-level aggregation keyed by
(group, asin) first, so a hot keyword is spread over tasks before its final
merge.  The keyword mart's median is exact at any size: prices are counted per
(group, price), again with map-side partial counts, and the median is the price
at which the running count passes half.  Only distinct prices are ordered, never
the rows of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.numeric import flag_count, flag_rate, guarded_pct, round_to, round_to_long
from shelfscope.operators.dimension import current_only
from shelfscope.operators.medians import exact_median, join_groups

KEYWORD_GRAIN = ("keyword", "marketplace", "ingested_at")
BRAND_GRAIN = ("brand", "category_leaf", "marketplace", "ingested_at")
#: Columns of the performance fact that the brand mart reads.
BRAND_INPUT = (
    "asin", "marketplace", "ingested_at", "bsr_primary_rank", "rating_weighted_avg", "in_stock", "is_fba",
    "variation_count", "size_count", "color_count",
)


def keyword_daily(ranking: DataFrame, audit_col: str | None = "gold_processed_at") -> DataFrame:
    """PL-08: one row per (keyword, marketplace, day) from the ranking fact,
    which is read twice (the median reads four columns): pass a stored table."""
    sums = ranking.groupBy(*KEYWORD_GRAIN).agg(
        F.count_distinct("asin").alias("total_products"),
        flag_count("is_sponsored").alias("sponsored_count"),
        flag_count("is_prime").alias("prime_count"),
        flag_count("is_best_seller").alias("best_seller_count"),
        flag_count("is_amazons_choice").alias("amazons_choice_count"),
        flag_count("has_coupon").alias("coupon_count"),
        round_to(F.avg("price_amount"), 2).alias("avg_price"),
        round_to(F.min("price_amount"), 2).alias("min_price"),
        round_to(F.max("price_amount"), 2).alias("max_price"),
        round_to(F.avg("rating_value"), 2).alias("avg_rating_value"),
        round_to_long(F.avg("ratings_count")).alias("avg_ratings_count"),
        F.sum("monthly_sales_min").alias("total_monthly_sales_min"),
    )
    joined = join_groups(sums, exact_median(ranking, KEYWORD_GRAIN, "price_amount", "_median"), KEYWORD_GRAIN)
    mart = joined.select(
        *KEYWORD_GRAIN, "total_products", "sponsored_count", "prime_count", "best_seller_count", "amazons_choice_count", "coupon_count",
        "avg_price", round_to("_median", 2).alias("median_price"), "min_price", "max_price", "avg_rating_value", "avg_ratings_count",
        "total_monthly_sales_min", guarded_pct("sponsored_count", "total_products").alias("sponsored_pct"),
    )
    return mart.withColumn(audit_col, F.current_timestamp()) if audit_col else mart


def brand_competitive(
    performance: DataFrame,
    dim: DataFrame | None,
    versions: str = "current",
    audit_col: str | None = "gold_processed_at",
) -> DataFrame:
    """PL-09: one row per (brand, leaf category, marketplace, day).

    ``versions="current"`` joins the current dimension (daily-run form: facts
    holding an expired key find no brand and drop out).  ``versions="all"``
    joins every version by surrogate key, which reproduces day-by-day loading
    when a whole history is rebuilt at once.  With ``dim=None`` the facts
    already carry ``brand`` and ``category_leaf`` of their version (attached
    by the as-of lookup), so no second join and shuffle is needed.
    """
    if dim is None:
        joined = performance
    else:
        d = current_only(dim) if versions == "current" else dim
        joined = performance.join(d.select("product_sk", "brand", "category_leaf"), "product_sk", "left")
    mart = (
        joined.filter(F.col("brand").isNotNull())
        .groupBy(*BRAND_GRAIN)
        .agg(
            F.count_distinct("asin").alias("asin_count"),
            round_to_long(F.avg("bsr_primary_rank")).alias("avg_bsr_primary"),
            F.min("bsr_primary_rank").alias("min_bsr_primary"),
            round_to(F.avg("rating_weighted_avg"), 2).alias("avg_rating_weighted"),
            flag_rate("in_stock").alias("in_stock_rate"),
            flag_count("is_fba").alias("fba_count"),
            round_to(F.avg("variation_count"), 1).alias("avg_variation_count"),
            round_to(F.avg("color_count"), 1).alias("avg_color_count"),
            round_to(F.avg("size_count"), 1).alias("avg_size_count"),
        )
    )
    mart = mart.withColumn("fba_pct", guarded_pct("fba_count", "asin_count"))
    return mart.withColumn(audit_col, F.current_timestamp()) if audit_col else mart
