"""Table contracts per layer (DQ-07): column names and types of every
silver and gold table, checked before each write from schema metadata only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# The column contract of each table, in table order.
_RANK = "array<struct<rank:int,category:string>>"

SILVER_SEARCH_RESULTS = [
    ("asin", "string"), ("title", "string"), ("price_raw", "string"), ("price_currency", "string"),
    ("price_amount", "double"), ("original_price_amount", "double"), ("discount_pct", "double"),
    ("rating", "double"), ("ratings_count", "bigint"), ("monthly_sales", "bigint"),
    ("is_sponsored", "boolean"), ("is_prime", "boolean"), ("is_best_seller", "boolean"), ("is_amazons_choice", "boolean"),
    ("has_coupon", "boolean"), ("coupon", "double"), ("delivery", "string"), ("url", "string"), ("image_url", "string"),
    ("keyword", "string"), ("marketplace", "string"), ("source_extracted_at", "timestamp_ntz"), ("ingested_at", "date"),
    ("silver_processed_at", "timestamp"),
]
SILVER_PRODUCT_DETAILS = [
    ("asin", "string"), ("parent_asin", "string"), ("title", "string"), ("brand", "string"),
    ("category_path", "string"), ("category_depth", "int"), ("category_leaf", "string"), ("best_seller_ranks", _RANK),
    ("dimensions_raw", "string"), ("dimension_length", "double"), ("dimension_width", "double"),
    ("dimension_height", "double"), ("dimension_unit", "string"), ("weight_value", "double"), ("weight_unit", "string"),
    ("date_first_available", "date"), ("variation_count", "bigint"), ("size_count", "int"), ("color_count", "int"),
    ("main_image_url", "string"), ("all_image_urls", "array<string>"), ("image_count", "int"),
    ("rating_pct_5", "double"), ("rating_pct_4", "double"), ("rating_pct_3", "double"), ("rating_pct_2", "double"),
    ("rating_pct_1", "double"), ("rating_weighted_avg", "double"), ("in_stock", "boolean"), ("buybox_seller", "string"),
    ("is_fba", "boolean"), ("marketplace", "string"), ("source_extracted_at", "timestamp_ntz"), ("ingested_at", "date"),
    ("silver_processed_at", "timestamp"),
]
DIM_PRODUCT = [
    ("product_sk", "string"), ("asin", "string"), ("marketplace", "string"), ("title", "string"), ("brand", "string"),
    ("category_path", "string"), ("category_leaf", "string"), ("category_depth", "int"), ("bsr_primary_category", "string"),
    ("date_first_available", "date"), ("variation_count", "bigint"), ("size_count", "int"), ("color_count", "int"),
    ("main_image_url", "string"), ("is_fba", "boolean"), ("effective_date", "date"), ("expiry_date", "date"),
    ("is_current", "boolean"), ("_attr_hash", "string"), ("gold_processed_at", "timestamp"),
]
FACT_SEARCH_RANKING = [
    ("product_sk", "string"), ("asin", "string"), ("keyword", "string"), ("marketplace", "string"), ("ingested_at", "date"),
    ("price_amount", "double"), ("original_price_amount", "double"), ("discount_pct", "double"), ("rating_value", "double"),
    ("ratings_count", "bigint"), ("monthly_sales_min", "bigint"), ("is_sponsored", "boolean"), ("is_prime", "boolean"),
    ("is_best_seller", "boolean"), ("is_amazons_choice", "boolean"), ("has_coupon", "boolean"),
    ("coupon_discount_pct", "double"), ("source_extracted_at", "timestamp_ntz"), ("gold_processed_at", "timestamp"),
]
FACT_PRICE_SNAPSHOT = [
    ("product_sk", "string"), ("asin", "string"), ("marketplace", "string"), ("ingested_at", "date"),
    ("min_price", "double"), ("max_price", "double"), ("avg_price", "double"), ("latest_price", "double"),
    ("original_price_latest", "double"), ("discount_pct_latest", "double"), ("has_coupon", "boolean"),
    ("coupon_discount_pct_latest", "double"), ("keyword_appearance_count", "int"), ("gold_processed_at", "timestamp"),
]
FACT_PRODUCT_PERFORMANCE = [
    ("product_sk", "string"), ("asin", "string"), ("marketplace", "string"), ("ingested_at", "date"),
    ("bsr_primary_rank", "int"), ("bsr_primary_category", "string"), ("bsr_secondary_rank", "int"),
    ("bsr_secondary_category", "string"), ("rating_weighted_avg", "double"), ("rating_pct_5", "double"),
    ("rating_pct_4", "double"), ("rating_pct_3", "double"), ("rating_pct_2", "double"), ("rating_pct_1", "double"),
    ("in_stock", "boolean"), ("buybox_seller", "string"), ("is_fba", "boolean"), ("variation_count", "bigint"),
    ("size_count", "int"), ("color_count", "int"), ("image_count", "int"), ("gold_processed_at", "timestamp"),
]
MART_KEYWORD_DAILY = [
    ("keyword", "string"), ("marketplace", "string"), ("ingested_at", "date"), ("total_products", "bigint"),
    ("sponsored_count", "bigint"), ("prime_count", "bigint"), ("best_seller_count", "bigint"),
    ("amazons_choice_count", "bigint"), ("coupon_count", "bigint"), ("avg_price", "double"), ("median_price", "double"),
    ("min_price", "double"), ("max_price", "double"), ("avg_rating_value", "double"), ("avg_ratings_count", "bigint"),
    ("total_monthly_sales_min", "bigint"), ("sponsored_pct", "double"), ("gold_processed_at", "timestamp"),
]
MART_BRAND_COMPETITIVE = [
    ("brand", "string"), ("category_leaf", "string"), ("marketplace", "string"), ("ingested_at", "date"),
    ("asin_count", "bigint"), ("avg_bsr_primary", "bigint"), ("min_bsr_primary", "int"), ("avg_rating_weighted", "double"),
    ("in_stock_rate", "double"), ("fba_count", "bigint"), ("avg_variation_count", "double"), ("avg_color_count", "double"),
    ("avg_size_count", "double"), ("fba_pct", "double"), ("gold_processed_at", "timestamp"),
]

CONTRACTS = {
    "silver/search_results": SILVER_SEARCH_RESULTS,
    "silver/product_details": SILVER_PRODUCT_DETAILS,
    "gold/dim_product": DIM_PRODUCT,
    "gold/fact_search_ranking": FACT_SEARCH_RANKING,
    "gold/fact_price_snapshot": FACT_PRICE_SNAPSHOT,
    "gold/fact_product_performance": FACT_PRODUCT_PERFORMANCE,
    "gold/mart_keyword_daily": MART_KEYWORD_DAILY,
    "gold/mart_brand_competitive": MART_BRAND_COMPETITIVE,
}
# Never allowed past bronze.
FORBIDDEN = ("source_file", "description", "variations")


def schema_issues(df: DataFrame, contract: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) for every mismatch, missing or
    extra column; forbidden lineage columns are reported as extra."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = dict(contract)
    issues = [(n, t, actual.get(n, "missing")) for n, t in contract if actual.get(n) != t]
    issues += [(n, "forbidden" if n in FORBIDDEN else "absent", t) for n, t in actual.items() if n not in expected]
    return issues


def assert_schema(df: DataFrame, table: str) -> DataFrame:
    """Raise before a write when ``df`` breaks the contract of ``table``."""
    issues = schema_issues(df, CONTRACTS[table])
    if issues:
        raise ValueError(f"{table}: schema contract broken: {issues}")
    return df
