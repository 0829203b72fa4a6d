"""Silver cleaning jobs (PL-02, PL-03): bronze text -> typed, deduplicated rows.

Each job is one projection of built-in expressions followed by the
skew-tolerant ``latest_per`` dedup; nothing leaves the JVM.  Rows are typed
before the dedup, whose sorts and shuffle then carry the typed columns that the
caller asks for instead of whole raw records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.functions import parse as P
from shelfscope.operators.dedup import latest_per

CARD_KEYS = ("asin", "keyword", "ingested_at")
TS, TIE = "_ts", "_row_hash"
LISTING_KEYS = ("asin", "ingested_at")


def _audit(df: DataFrame, audit_col: str | None) -> DataFrame:
    return df.withColumn(audit_col, F.current_timestamp()) if audit_col else df


def _provenance(bronze: DataFrame) -> tuple[F.Column, F.Column]:
    """PR-17 typed (extraction time, day); reuses the values ``latest_raw``
    already parsed for the dedup instead of parsing the text twice."""
    ts = F.col(TS) if TS in bronze.columns else P.to_ts("source_extracted_at")
    typed_day = isinstance(bronze.schema["ingested_at"].dataType, T.DateType)
    day = F.col("ingested_at") if typed_day else P.to_day("ingested_at")
    return ts.alias("source_extracted_at"), day.alias("ingested_at")


def type_cards(bronze: DataFrame) -> DataFrame:
    """PR-01..06, PR-17, PR-18: typed card columns, one row per bronze row
    (``_source_file`` kept as the dedup tie-break)."""
    price_raw, price_currency, price_amount = P.parse_price("price")
    _, _, original_amount = P.parse_price("original_price")
    has_coupon, coupon = P.parse_coupon("coupon")
    return bronze.select(
        "asin",
        F.trim("title").alias("title"),
        price_raw.alias("price_raw"),
        price_currency.alias("price_currency"),
        price_amount.alias("price_amount"),
        original_amount.alias("original_price_amount"),
        P.discount_pct(original_amount, price_amount).alias("discount_pct"),
        P.parse_rating("rating").alias("rating"),
        P.parse_ratings_count("ratings_count").alias("ratings_count"),
        P.parse_monthly_sales("monthly_sales").alias("monthly_sales"),
        "is_sponsored",
        "is_prime",
        "is_best_seller",
        "is_amazons_choice",
        has_coupon.alias("has_coupon"),
        coupon.alias("coupon"),
        "delivery",
        "url",
        "image_url",
        "keyword",
        "marketplace",
        *_provenance(bronze),
        F.col("source_file").alias("_source_file"),
        *[c for c in (TIE,) if c in bronze.columns],
    )


def ranked(bronze: DataFrame) -> DataFrame:
    """Bronze rows with their typed day and what orders the rows of a grain:
    the typed timestamp and, last, a hash of the whole row."""
    keyed = bronze.withColumn("ingested_at", P.to_day("ingested_at")).withColumn(TS, P.to_ts("source_extracted_at"))
    return keyed.withColumn(TIE, F.xxhash64(*bronze.columns))


def latest_raw(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WN-01/02 on bronze rows: the latest extraction per grain, decided on the
    typed day and timestamp.  Ties (a product twice on one page has one
    extraction time and one file) go by source file and then by a hash of the
    whole row, so the input's order never decides."""
    return latest_per(ranked(bronze), keys, [TS, "source_file", TIE]).drop(TIE)


def latest_typed(
    bronze: DataFrame, typed: Callable[[DataFrame], DataFrame], keys: Sequence[str], columns: Sequence[Column | str] | None = None
) -> DataFrame:
    """WN-01/02: the rows of ``latest_raw``, typed.  Every row is typed (and, by
    ``columns``, reduced to the columns wanted, the keys among them) before it
    is sorted and shuffled, so a raw record never travels."""
    order = ["_rank_ts", "_rank_file", "_rank_hash"]
    rows = typed(ranked(bronze)).withColumnsRenamed({"_source_file": order[1], TIE: order[2]})
    rows = rows.withColumn(order[0], F.col("source_extracted_at"))
    wanted = rows.drop(*order).select(*(columns or ["*"])).columns
    return latest_per(rows.select(*(columns or wanted), *order), keys, order, keep=wanted)


def clean_cards(
    bronze: DataFrame,
    keys: Sequence[str] = CARD_KEYS,
    audit_col: str | None = "silver_processed_at",
    columns: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Search-result cards -> silver (grain ``keys``, latest extraction wins);
    of the silver row only ``columns``, if given."""
    return _audit(latest_typed(bronze, type_cards, keys, columns), audit_col)


def type_listings(bronze: DataFrame) -> DataFrame:
    """PR-07..18: typed listing columns, one row per bronze row.

    ``size(null)`` is null under ANSI (the legacy engine returned -1); that is
    a deliberate change, documented in the README.
    """
    length, width, height, unit = P.parse_dimensions("dimensions")
    weight_value, weight_unit = P.parse_weight("weight")
    return bronze.select(
        "asin",
        "parent_asin",
        F.trim("title").alias("title"),
        P.clean_brand("brand").alias("brand"),
        F.col("category").alias("category_path"),
        P.category_depth("categories").alias("category_depth"),
        P.category_leaf("categories").alias("category_leaf"),
        P.parse_rank_array("best_seller_rank").alias("best_seller_ranks"),
        F.col("dimensions").alias("dimensions_raw"),
        length.alias("dimension_length"),
        width.alias("dimension_width"),
        height.alias("dimension_height"),
        unit.alias("dimension_unit"),
        weight_value.alias("weight_value"),
        weight_unit.alias("weight_unit"),
        P.first_date("date_first_available").alias("date_first_available"),
        "variation_count",
        F.size("available_dimensions.size_name").alias("size_count"),
        F.size("available_dimensions.color_name").alias("color_count"),
        F.get(F.col("images"), 0).alias("main_image_url"),
        F.col("images").alias("all_image_urls"),
        F.size("images").alias("image_count"),
        *P.rating_breakdown("rating_overview"),
        P.in_stock("stock_status").alias("in_stock"),
        "buybox_seller",
        "is_fba",
        "marketplace",
        *_provenance(bronze),
        F.col("source_file").alias("_source_file"),
        *[c for c in (TIE,) if c in bronze.columns],
    )


def clean_listings(
    bronze: DataFrame,
    keys: Sequence[str] = LISTING_KEYS,
    audit_col: str | None = "silver_processed_at",
    columns: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Product-detail listings -> silver (grain ``keys``, latest extraction wins);
    of the silver row only ``columns``, if given."""
    return _audit(latest_typed(bronze, type_listings, keys, columns), audit_col)
