"""Market-entry analytics over the gold marts (AN-01..07).

Per-day reference values (min/max for normalisation, medians for the
fragmentation cut-off) are computed with a ``groupBy`` on (marketplace, day)
and joined back: each task pre-aggregates its own rows, and the joined table
has one row per (marketplace, day).  A window partitioned by day would put
a whole day into one task instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.numeric import round_to
from shelfscope.operators.medians import exact_median, join_groups

DAY_GRAIN = ("marketplace", "ingested_at")

# Thresholds and weights stated by the market-research questions.
OPPORTUNITY_WEIGHTS = (0.5, 0.3, 0.2)  # demand, competition, barrier
TARGET_MAX_SPONSORED_PCT = 30.0
TARGET_MAX_RATINGS_COUNT = 500
FEE_SHARE = 0.30
ADS_SHARE = 0.15
MIN_MEDIAN_PRICE = 20.0
# Ours (the questions give no numbers): price pressure limits of the margin screen.
MAX_DISCOUNT_PCT = 30.0
MAX_COUPON_DENSITY_PCT = 50.0
AD_BANDS = ((30.0, "healthy"), (50.0, "competitive"))  # < 30 healthy, 30..50 competitive, > 50 red_flag


def _minmax(col: str) -> tuple[F.Column, F.Column]:
    return F.min(col).alias(f"_min_{col}"), F.max(col).alias(f"_max_{col}")


def _norm(col: str) -> F.Column:
    lo, hi = F.col(f"_min_{col}"), F.col(f"_max_{col}")
    return F.when(hi > lo, (F.col(col) - lo) / (hi - lo)).when(F.col(col).isNotNull(), F.lit(0.0))


def opportunity(mart: DataFrame, weights: tuple[float, float, float] = OPPORTUNITY_WEIGHTS) -> DataFrame:
    """AN-01: ``w1*demand - w2*competition - w3*barrier`` with each input
    min-max normalised within its (marketplace, day); a constant input
    normalises to 0.  ``is_target``: sponsored_pct < 30 and avg_ratings_count < 500."""
    demand, comp, barrier = "total_monthly_sales_min", "sponsored_pct", "avg_ratings_count"
    stats = mart.groupBy(*DAY_GRAIN).agg(*_minmax(demand), *_minmax(comp), *_minmax(barrier))
    j = mart.join(stats, list(DAY_GRAIN), "left")
    w1, w2, w3 = weights
    score = F.lit(w1) * _norm(demand) - F.lit(w2) * _norm(comp) - F.lit(w3) * _norm(barrier)
    return j.select(
        "keyword",
        "marketplace",
        "ingested_at",
        demand,
        comp,
        barrier,
        round_to(score, 4).alias("opportunity_score"),
        ((F.col(comp) < TARGET_MAX_SPONSORED_PCT) & (F.col(barrier) < TARGET_MAX_RATINGS_COUNT)).alias("is_target"),
    )


def margin(
    mart: DataFrame,
    ranking: DataFrame,
    price_snapshot: DataFrame,
    fee: float = FEE_SHARE,
    ads: float = ADS_SHARE,
    cost: float = 0.0,
    min_median: float = MIN_MEDIAN_PRICE,
    max_discount: float = MAX_DISCOUNT_PCT,
    max_coupon_density: float = MAX_COUPON_DENSITY_PCT,
) -> DataFrame:
    """AN-02: ``median - fee*median - ads*median - cost`` per keyword day, with
    the price pressure of the keyword's products (mean latest discount from
    the price snapshot, reached through the ranking fact) and coupon density.
    ``keep``: median above ``min_median`` and neither discounts nor coupons
    above their limits (a missing discount counts as no discount)."""
    keys = ["asin", "marketplace", "ingested_at"]
    pressure = (
        ranking.select("keyword", *keys)
        .join(price_snapshot.select(*keys, "discount_pct_latest"), keys, "left")
        .groupBy("keyword", "marketplace", "ingested_at")
        .agg(round_to(F.avg("discount_pct_latest"), 2).alias("avg_discount_latest"))
    )
    m = F.col("median_price")
    est = round_to(m - F.lit(fee) * m - F.lit(ads) * m - F.lit(cost), 2)
    density = F.when(F.col("total_products") > 0, round_to(F.col("coupon_count") / F.col("total_products") * 100, 2))
    out = mart.join(pressure, ["keyword", "marketplace", "ingested_at"], "left").select(
        "keyword",
        "marketplace",
        "ingested_at",
        "median_price",
        est.alias("estimated_margin"),
        "avg_discount_latest",
        density.alias("coupon_density_pct"),
        (m > min_median).alias("price_ok"),
    )
    keep = (
        F.coalesce(F.col("price_ok"), F.lit(False))
        & (F.coalesce(F.col("avg_discount_latest"), F.lit(0.0)) <= max_discount)
        & (F.coalesce(F.col("coupon_density_pct"), F.lit(0.0)) <= max_coupon_density)
    )
    return out.withColumn("keep", keep)


def stability(mart: DataFrame) -> DataFrame:
    """AN-03: mean / sample stddev of daily demand per keyword and marketplace
    (null with fewer than 2 days or zero spread), plus the linear trend."""
    y = F.col("total_monthly_sales_min").cast("double")
    x = F.datediff(F.col("ingested_at"), F.lit("1970-01-01").cast("date")).cast("double")
    g = mart.groupBy("keyword", "marketplace").agg(
        F.count(y).alias("n_days"),
        F.avg(y).alias("_avg"),
        F.stddev_samp(y).alias("_sd"),
        F.regr_slope(y, x).alias("_slope"),
    )
    return g.select(
        "keyword",
        "marketplace",
        "n_days",
        round_to(F.col("_avg"), 2).alias("avg_demand"),
        round_to(F.col("_sd"), 2).alias("stddev_demand"),
        F.when((F.col("n_days") >= 2) & (F.col("_sd") > 0), round_to(F.col("_avg") / F.col("_sd"), 4)).alias(
            "stability_score"
        ),
        round_to(F.col("_slope"), 4).alias("trend_slope"),
    )


def ad_saturation(mart: DataFrame) -> DataFrame:
    """AN-04: sponsored share band per keyword day."""
    s = F.col("sponsored_pct")
    (healthy_below, healthy), (competitive_upto, competitive) = AD_BANDS
    band = (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s < healthy_below, F.lit(healthy))
        .when(s <= competitive_upto, F.lit(competitive))
        .otherwise(F.lit("red_flag"))
    )
    return mart.select("keyword", "marketplace", "ingested_at", "sponsored_pct", "best_seller_count", band.alias("ad_band"))


def fragmentation(mart: DataFrame) -> DataFrame:
    """AN-05: a keyword day is fragmented when both its best-seller count and
    its mean review count are at or below that day's median across keywords."""
    j = mart
    for value in ("best_seller_count", "avg_ratings_count"):
        j = join_groups(j, exact_median(mart, DAY_GRAIN, value, f"median_{value}"), DAY_GRAIN)
    return j.select(
        "keyword",
        "marketplace",
        "ingested_at",
        "best_seller_count",
        "avg_ratings_count",
        "median_best_seller_count",
        "median_avg_ratings_count",
        (
            (F.col("best_seller_count") <= F.col("median_best_seller_count"))
            & (F.col("avg_ratings_count") <= F.col("median_avg_ratings_count"))
        ).alias("is_fragmented"),
    )


def rank_moves(performance: DataFrame, keys=("asin", "marketplace"), day: str = "ingested_at", value: str = "bsr_primary_rank") -> DataFrame:
    """AN-06 / WN-04: day-over-day best-seller-rank movement per product
    (positive = moved up).  The fact has one row per product day, so a
    window partition holds at most one row per day."""
    w = Window.partitionBy(*keys).orderBy(day)
    prev = F.lag(value).over(w)
    return performance.select(
        *keys,
        day,
        value,
        F.lag(day).over(w).alias(f"prev_{day}"),
        prev.alias(f"prev_{value}"),
        (prev - F.col(value)).alias("rank_change"),
    )


# Fixed value: plural suffix stripped by the keyword normaliser (words of 4+ letters).
PLURAL_RE = r"^(.*[a-z]{2}[^s\s])s$"


def normalise_keyword(col: str = "keyword") -> F.Column:
    """AN-07: lower case, trimmed, inner whitespace collapsed, simple plural removed."""
    base = F.lower(F.trim(F.regexp_replace(F.col(col), r"\s+", " ")))
    return F.regexp_replace(base, PLURAL_RE, "$1")


def keyword_dimension(mart: DataFrame) -> DataFrame:
    """AN-07: keyword variants grouped under one normalised keyword per day."""
    return (
        mart.withColumn("keyword_norm", normalise_keyword())
        .groupBy("keyword_norm", "marketplace", "ingested_at")
        .agg(
            F.count_distinct("keyword").alias("n_variants"),
            F.sum("total_products").alias("total_products"),
            F.sum("total_monthly_sales_min").alias("total_monthly_sales_min"),
        )
    )
