"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the documented semantics, not from the Spark code: the raw
fixtures, the text rules as SQL regex, dedup as ``row_number()``, SCD2 as
``lag``/``lead``, as-of lookup as a range join.  Rounding follows the
project rule: fix to 12 decimals, then round half-up (``R2``/``R1``/...).
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"coalesce(CAST(round(TRY_CAST(({expr}) AS DECIMAL(38,12)), {n}) AS DOUBLE), round(CAST(({expr}) AS DOUBLE), {n}))"


def rnd_long(expr: str) -> str:
    return f"CAST(round(TRY_CAST(({expr}) AS DECIMAL(38,12)), 0) AS BIGINT)"


def pct(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN {rnd(f'({num}) / ({den}) * 100', 2)} END"


def num(text: str, typ: str = "DOUBLE") -> str:
    return f"CASE WHEN ({text}) <> '' THEN TRY_CAST(({text}) AS {typ}) END"


def scaled(col: str, pattern: str) -> str:
    g1 = f"regexp_extract({col}, '{pattern}', 1)"
    g2 = f"upper(regexp_extract({col}, '{pattern}', 2))"
    mult = f"(CASE {g2} WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 ELSE 1 END)"
    return f"CASE WHEN {g1} <> '' THEN TRY_CAST(trunc(TRY_CAST({g1} AS DOUBLE) * {mult}) AS BIGINT) END"


MKT = "CASE {k} % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' ELSE 'VN' END"
ASIN = "'B' || lpad(CAST({k} AS VARCHAR), 9, '0')"

CARDS = f"""
cards AS (
  SELECT
    {ASIN.format(k='user_id')} AS asin,
    ' Item ' || CAST(user_id AS VARCHAR) || ' for ' || event_type || ' ' AS title,
    CASE WHEN k % 11 = 0 THEN NULL
         WHEN user_id % 3 = 2 THEN 'VND ' || format('{{:,.2f}}', value * 100)
         ELSE '$' || format('{{:,.2f}}', value * 100) END AS price,
    CASE WHEN k % 3 = 0 THEN '$' || format('{{:,.2f}}', value * 125) END AS original_price,
    CASE WHEN k % 13 = 0 THEN NULL
         ELSE CAST((10 + k % 41) // 10 AS VARCHAR) || '.' || CAST((10 + k % 41) % 10 AS VARCHAR) || ' out of 5 stars' END AS rating,
    CASE WHEN k % 10 = 5 THEN '(' || CAST(k AS VARCHAR) || ',' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || ')'
         WHEN k % 2 = 0 THEN '(' || CAST(k AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) || 'K)'
         ELSE '(' || CAST(k AS VARCHAR) || ')' END AS ratings_count,
    CASE WHEN k % 4 = 0 THEN NULL
         WHEN k % 4 = 1 THEN CAST(k AS VARCHAR) || 'K+ bought in past month'
         ELSE CAST(k AS VARCHAR) || '00+ bought in past month' END AS monthly_sales,
    CASE WHEN k % 7 = 0 THEN 'Save ' || CAST(5 + k % 20 AS VARCHAR) || '%with coupon'
         WHEN k % 7 = 1 THEN 'Coupon available' END AS coupon,
    CASE WHEN k % 2 = 0 THEN 'FREE delivery' END AS delivery,
    'https://shop.example/dp/' || {ASIN.format(k='user_id')} AS url,
    'https://img.example/' || {ASIN.format(k='user_id')} || '.jpg' AS image_url,
    event_id % 5 = 0 AS is_sponsored,
    user_id % 2 = 0 AS is_prime,
    k % 17 = 0 AS is_best_seller,
    k % 19 = 0 AS is_amazons_choice,
    event_type AS keyword,
    {MKT.format(k='user_id')} AS marketplace,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS source_extracted_at,
    strftime(ts, '%Y-%m-%d') AS ingested_at,
    'search_' || event_type || '_' || strftime(ts, '%Y-%m-%d') || '.json' AS source_file
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
)"""

PRICE_AMT = "regexp_replace(regexp_extract({c}, '([\\d,]+(?:\\.\\d+)?)', 1), ',', '', 'g')"

CARDS_TYPED = f"""
cards_typed AS (
  SELECT
    asin,
    trim(title) AS title,
    price AS price_raw,
    trim(regexp_extract(price, '^([^\\d]+)', 1)) AS price_currency,
    {num(PRICE_AMT.format(c='price'))} AS price_amount,
    {num(PRICE_AMT.format(c='original_price'))} AS original_price_amount,
    {num("regexp_extract(rating, '^([\\d.]+)', 1)")} AS rating,
    {scaled('ratings_count', '\\(([\\d.]+)([KkMm]?)\\)')} AS ratings_count,
    CASE WHEN monthly_sales IS NOT NULL THEN {scaled('monthly_sales', '([\\d.]+)([KkMm]?)')} END AS monthly_sales,
    is_sponsored, is_prime, is_best_seller, is_amazons_choice,
    coupon IS NOT NULL AS has_coupon,
    CASE WHEN coupon IS NOT NULL THEN {num("regexp_extract(coupon, 'Save\\s*([\\d.]+)\\s*%', 1)")} END AS coupon,
    delivery, url, image_url, keyword, marketplace,
    TRY_CAST(source_extracted_at AS TIMESTAMP) AS source_extracted_at,
    TRY_CAST(ingested_at AS DATE) AS ingested_at,
    source_file AS _source_file
  FROM cards
)"""

SILVER_CARDS = f"""
silver_cards AS (
  SELECT asin, title, price_raw, price_currency, price_amount, original_price_amount,
    CASE WHEN original_price_amount > 0 AND original_price_amount IS NOT NULL AND price_amount IS NOT NULL
         THEN {rnd('(original_price_amount - price_amount) / original_price_amount * 100', 2)} END AS discount_pct,
    rating, ratings_count, monthly_sales, is_sponsored, is_prime, is_best_seller, is_amazons_choice,
    has_coupon, coupon, delivery, url, image_url, keyword, marketplace, source_extracted_at, ingested_at
  FROM (
    SELECT *, row_number() OVER (PARTITION BY asin, keyword, ingested_at
                                 ORDER BY source_extracted_at DESC NULLS LAST, _source_file DESC NULLS LAST) AS _rn
    FROM cards_typed)
  WHERE _rn = 1
)"""

RANKING_ROWS = """
ranking AS (
  SELECT asin, keyword, marketplace, ingested_at, price_amount, original_price_amount, discount_pct,
         rating AS rating_value, ratings_count, monthly_sales AS monthly_sales_min,
         is_sponsored, is_prime, is_best_seller, is_amazons_choice, has_coupon,
         coupon AS coupon_discount_pct, source_extracted_at
  FROM silver_cards
)"""


def flag_sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS INTEGER)) AS BIGINT)"


KEYWORD_MART = f"""
keyword_mart AS (
  SELECT keyword, marketplace, ingested_at,
    count(DISTINCT asin) AS total_products,
    {flag_sum('is_sponsored')} AS sponsored_count,
    {flag_sum('is_prime')} AS prime_count,
    {flag_sum('is_best_seller')} AS best_seller_count,
    {flag_sum('is_amazons_choice')} AS amazons_choice_count,
    {flag_sum('has_coupon')} AS coupon_count,
    {rnd('avg(price_amount)', 2)} AS avg_price,
    {rnd('quantile_disc(price_amount, 0.5)', 2)} AS median_price,
    {rnd('min(price_amount)', 2)} AS min_price,
    {rnd('max(price_amount)', 2)} AS max_price,
    {rnd('avg(rating_value)', 2)} AS avg_rating_value,
    {rnd_long('avg(ratings_count)')} AS avg_ratings_count,
    CAST(sum(monthly_sales_min) AS BIGINT) AS total_monthly_sales_min,
    {pct(flag_sum('is_sponsored'), 'count(DISTINCT asin)')} AS sponsored_pct
  FROM ranking
  GROUP BY keyword, marketplace, ingested_at
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


CARD_CHAIN = (CARDS, CARDS_TYPED, SILVER_CARDS)
MART_CHAIN = (*CARD_CHAIN, RANKING_ROWS, KEYWORD_MART)

SQL: dict[str, str] = {}

SQL["mart_keyword_daily"] = with_(*MART_CHAIN) + "SELECT * FROM keyword_mart"
SQL["silver_cards"] = with_(*CARD_CHAIN) + "SELECT * FROM silver_cards"


# ------------------------------------------------------------------ listings

RANK1 = "'#' || format('{:,}', l_orderkey) || ' in ' || p_type"
RANK2 = "'#' || CAST(l_linenumber AS VARCHAR) || ' in' || p_name"

LISTINGS = f"""
listings AS (
  SELECT
    {ASIN.format(k='l_partkey')} AS asin,
    p_name || ' ' || p_type AS title,
    CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE 'Brand: ' || p_brand END AS brand,
    p_type AS category,
    CASE WHEN l_linenumber = 7 THEN [{RANK1}, NULL]
         WHEN l_linenumber > 1 THEN [{RANK1}, {RANK2}]
         ELSE [{RANK1}] END AS best_seller_rank,
    CASE WHEN l_linenumber = 7 THEN 'n/a'
         WHEN l_linenumber % 2 = 0 THEN CAST(p_size AS VARCHAR) || ' x ' || CAST(l_linenumber AS VARCHAR) || ' inches'
         ELSE CAST(p_size AS VARCHAR) || '.5 x ' || CAST(l_linenumber AS VARCHAR) || ' x 3.31 inches' END AS dimensions,
    CASE WHEN l_linenumber = 6 THEN 'heavy' ELSE CAST(l_quantity AS VARCHAR) || ' ounces' END AS weight,
    CASE WHEN l_orderkey % 97 = 0 THEN 'unknown'
         WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%B %-d, %Y')
         WHEN l_linenumber % 3 = 1 THEN strftime(l_shipdate, '%b %-d, %Y')
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_first_available,
    'P' || lpad(CAST(l_partkey // 10 AS VARCHAR), 9, '0') AS parent_asin,
    CAST(CASE WHEN l_linenumber > 5 THEN 2 ELSE 1 END AS BIGINT) AS variation_count,
    l_linenumber AS n_sizes,
    p_size % 4 + 1 AS n_colors,
    l_linenumber % 5 AS n_images,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS star5,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 20 END AS star4,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS star3,
    CAST(NULL AS INTEGER) AS star2,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 3 END AS star1,
    CASE WHEN l_linestatus = 'O' THEN 'In Stock' ELSE 'Out of Stock' END AS stock_status,
    'Seller#' || CAST(l_suppkey AS VARCHAR) AS buybox_seller,
    l_returnflag = 'A' AS is_fba,
    string_split(p_name, ' ') AS categories,
    {MKT.format(k='l_partkey')} AS marketplace,
    strftime(l_shipdate + to_seconds(l_orderkey % 86400), '%Y-%m-%dT%H:%M:%S.%f') AS source_extracted_at,
    strftime(l_shipdate, '%Y-%m-%d') AS ingested_at,
    'details_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '.json' AS source_file
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

DIM_RE = "^([\\d.]+)\\s*x\\s*([\\d.]+)(?:\\s*x\\s*([\\d.]+))?\\s*(\\w+)"
WEIGHT_RE = "^([\\d.]+)\\s+(.+)$"
STARS = "(coalesce(CAST(star5 AS DOUBLE), 0.0) + coalesce(CAST(star4 AS DOUBLE), 0.0) + coalesce(CAST(star3 AS DOUBLE), 0.0) + coalesce(CAST(star2 AS DOUBLE), 0.0) + coalesce(CAST(star1 AS DOUBLE), 0.0))"
WSTARS = "(5 * coalesce(CAST(star5 AS DOUBLE), 0.0) + 4 * coalesce(CAST(star4 AS DOUBLE), 0.0) + 3 * coalesce(CAST(star3 AS DOUBLE), 0.0) + 2 * coalesce(CAST(star2 AS DOUBLE), 0.0) + 1 * coalesce(CAST(star1 AS DOUBLE), 0.0))"
RANK_STRUCT = (
    "list_transform(best_seller_rank, lambda x: struct_pack("
    "rank := CASE WHEN x IS NOT NULL THEN TRY_CAST(regexp_replace(regexp_extract(x, '#?([\\d,]+)\\s+in\\s*', 1), ',', '', 'g') AS INTEGER) END, "
    "category := CASE WHEN x IS NOT NULL THEN trim(regexp_extract(x, '#?[\\d,]+\\s+in\\s*(.+)$', 1)) END))"
)
FIRST_DATE = (
    "CAST(coalesce(try_strptime(trim(date_first_available), '%B %-d, %Y'), "
    "try_strptime(trim(date_first_available), '%b %-d, %Y'), "
    "try_strptime(trim(date_first_available), '%Y-%m-%d')) AS DATE)"
)

LISTINGS_TYPED = f"""
listings_typed AS (
  SELECT
    asin, parent_asin, trim(title) AS title,
    trim(regexp_replace(brand, '^Brand:\\s*', '')) AS brand,
    category AS category_path,
    CAST(len(categories) AS INTEGER) AS category_depth,
    categories[-1] AS category_leaf,
    {RANK_STRUCT} AS best_seller_ranks,
    dimensions AS dimensions_raw,
    TRY_CAST(regexp_extract(dimensions, '{DIM_RE}', 1) AS DOUBLE) AS dimension_length,
    TRY_CAST(regexp_extract(dimensions, '{DIM_RE}', 2) AS DOUBLE) AS dimension_width,
    TRY_CAST(regexp_extract(dimensions, '{DIM_RE}', 3) AS DOUBLE) AS dimension_height,
    trim(regexp_extract(dimensions, '{DIM_RE}', 4)) AS dimension_unit,
    TRY_CAST(regexp_extract(weight, '{WEIGHT_RE}', 1) AS DOUBLE) AS weight_value,
    trim(regexp_extract(weight, '{WEIGHT_RE}', 2)) AS weight_unit,
    {FIRST_DATE} AS date_first_available,
    variation_count,
    n_sizes AS size_count,
    n_colors AS color_count,
    CASE WHEN n_images > 0 THEN 'https://img.example/' || asin || '_2.jpg' END AS main_image_url,
    array_to_string(list_transform(range(2, 2 + n_images), lambda i: 'https://img.example/' || asin || '_' || CAST(i AS VARCHAR) || '.jpg'), '|') AS all_image_urls,
    n_images AS image_count,
    coalesce(CAST(star5 AS DOUBLE), 0.0) AS rating_pct_5,
    coalesce(CAST(star4 AS DOUBLE), 0.0) AS rating_pct_4,
    coalesce(CAST(star3 AS DOUBLE), 0.0) AS rating_pct_3,
    coalesce(CAST(star2 AS DOUBLE), 0.0) AS rating_pct_2,
    coalesce(CAST(star1 AS DOUBLE), 0.0) AS rating_pct_1,
    CASE WHEN {STARS} > 0 THEN {rnd(f'{WSTARS} / {STARS}', 2)} END AS rating_weighted_avg,
    lower(stock_status) = 'in stock' AS in_stock,
    buybox_seller, is_fba, marketplace,
    TRY_CAST(source_extracted_at AS TIMESTAMP) AS source_extracted_at,
    TRY_CAST(ingested_at AS DATE) AS ingested_at,
    source_file AS _source_file
  FROM listings
)"""

SILVER_LISTINGS = """
silver_listings AS (
  SELECT * EXCLUDE (_rn, _source_file) FROM (
    SELECT *, row_number() OVER (PARTITION BY asin, ingested_at
                                 ORDER BY source_extracted_at DESC NULLS LAST, _source_file DESC NULLS LAST) AS _rn
    FROM listings_typed)
  WHERE _rn = 1
)"""

LISTING_CHAIN = (LISTINGS, LISTINGS_TYPED, SILVER_LISTINGS)

TRACKED = ["title", "brand", "category_path", "category_leaf", "category_depth", "is_fba", "variation_count"]
ATTRS = [
    "title", "brand", "category_path", "category_leaf", "category_depth", "bsr_primary_category",
    "date_first_available", "variation_count", "size_count", "color_count", "main_image_url", "is_fba",
]


def hash_of(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"sha256(concat_ws('~', {parts}))"


def scd2_sql(name: str, source: str, keys: list[str], day: str, attrs: list[str], tracked: list[str], sk: str) -> str:
    k = ", ".join(keys)
    a = ", ".join(attrs)
    return f"""
{name}_flagged AS (
  SELECT {k}, {day}, {a}, {hash_of(tracked)} AS _attr_hash,
         lag({hash_of(tracked)}) OVER (PARTITION BY {k} ORDER BY {day}) AS _prev
  FROM {source}
),
{name} AS (
  SELECT sha256(concat_ws('~', {k}, CAST({day} AS VARCHAR))) AS {sk}, {k}, {a},
         {day} AS effective_date,
         CAST(lead({day}) OVER w - 1 AS DATE) AS expiry_date,
         lead({day}) OVER w IS NULL AS is_current,
         _attr_hash
  FROM {name}_flagged
  WHERE _prev IS NULL OR _prev <> _attr_hash
  WINDOW w AS (PARTITION BY {k} ORDER BY {day})
)"""


SNAPSHOTS = f"""
snapshots AS (
  SELECT asin, marketplace, ingested_at, title, brand, category_path, category_leaf, category_depth,
         best_seller_ranks[1].category AS bsr_primary_category, date_first_available, variation_count,
         size_count, color_count, main_image_url, is_fba
  FROM silver_listings
)"""

DIM = scd2_sql("dim", "snapshots", ["asin", "marketplace"], "ingested_at", ATTRS, TRACKED, "product_sk")
DIM_CHAIN = (*LISTING_CHAIN, SNAPSHOTS, DIM)

PERFORMANCE = """
performance AS (
  SELECT asin, marketplace, ingested_at,
    best_seller_ranks[1].rank AS bsr_primary_rank,
    best_seller_ranks[1].category AS bsr_primary_category,
    best_seller_ranks[2].rank AS bsr_secondary_rank,
    best_seller_ranks[2].category AS bsr_secondary_category,
    rating_weighted_avg, rating_pct_5, rating_pct_4, rating_pct_3, rating_pct_2, rating_pct_1,
    in_stock, buybox_seller, is_fba, variation_count, size_count, color_count, image_count
  FROM silver_listings
)"""

FACT_PERFORMANCE = """
fact_performance AS (
  SELECT d.product_sk, p.*
  FROM performance p LEFT JOIN dim d
    ON p.asin = d.asin AND p.marketplace = d.marketplace
   AND d.effective_date <= p.ingested_at AND p.ingested_at <= coalesce(d.expiry_date, DATE '9999-12-31')
)"""

BRAND_MART = f"""
brand_mart AS (
  SELECT d.brand, d.category_leaf, f.marketplace, f.ingested_at,
    count(DISTINCT f.asin) AS asin_count,
    {rnd_long('avg(f.bsr_primary_rank)')} AS avg_bsr_primary,
    min(f.bsr_primary_rank) AS min_bsr_primary,
    {rnd('avg(f.rating_weighted_avg)', 2)} AS avg_rating_weighted,
    {rnd('avg(CAST(f.in_stock AS INTEGER)) * 100', 2)} AS in_stock_rate,
    {flag_sum('f.is_fba')} AS fba_count,
    {rnd('avg(f.variation_count)', 1)} AS avg_variation_count,
    {rnd('avg(f.color_count)', 1)} AS avg_color_count,
    {rnd('avg(f.size_count)', 1)} AS avg_size_count,
    {pct(flag_sum('f.is_fba'), 'count(DISTINCT f.asin)')} AS fba_pct
  FROM fact_performance f LEFT JOIN dim d ON f.product_sk = d.product_sk
  WHERE d.brand IS NOT NULL
  GROUP BY d.brand, d.category_leaf, f.marketplace, f.ingested_at
)"""

LISTING_SCALARS = "* EXCLUDE (best_seller_ranks)"

# The same listings as quarterly loads, and without the middle quarter.
QUARTER = "date_trunc('quarter', CAST(ingested_at AS DATE))"
QUARTER_LISTINGS = LISTINGS.replace("listings AS (", "day_listings AS (", 1) + f"""
, quarter_listings AS (SELECT * REPLACE (strftime({QUARTER}, '%Y-%m-%d') AS ingested_at) FROM day_listings)
, quarters AS (SELECT list_sort(list(DISTINCT ingested_at)) AS m FROM quarter_listings)"""
ALL_QUARTERS = QUARTER_LISTINGS + "\n, listings AS (SELECT * FROM quarter_listings)"
QUARTER_GONE = QUARTER_LISTINGS + "\n, listings AS (SELECT l.* FROM quarter_listings l, quarters WHERE l.ingested_at <> m[len(m) // 2 + 1])"

SQL["silver_listings"] = with_(*LISTING_CHAIN) + f"SELECT {LISTING_SCALARS} FROM silver_listings"
SQL["scd2_rebuild"] = with_(*DIM_CHAIN) + "SELECT * FROM dim"
SQL["dim_persisted_load"] = with_(ALL_QUARTERS, *DIM_CHAIN[1:]) + "SELECT * FROM dim"
SQL["rebuild_after_change"] = with_(QUARTER_GONE, *DIM_CHAIN[1:], PERFORMANCE, FACT_PERFORMANCE) + "SELECT * FROM fact_performance"
SQL["fact_product_performance"] = with_(*DIM_CHAIN, PERFORMANCE, FACT_PERFORMANCE) + "SELECT * FROM fact_performance"
SQL["mart_brand_competitive"] = with_(*DIM_CHAIN, PERFORMANCE, FACT_PERFORMANCE, BRAND_MART) + "SELECT * FROM brand_mart"


# ------------------------------------------------------------------ per-rule queries

DISCOUNT = f"""CASE WHEN original_price_amount > 0 AND original_price_amount IS NOT NULL AND price_amount IS NOT NULL
         THEN {rnd('(original_price_amount - price_amount) / original_price_amount * 100', 2)} END"""

SQL["pr_price"] = with_(CARDS, CARDS_TYPED) + f"""
SELECT asin, keyword, source_extracted_at, price_raw, price_currency, price_amount, original_price_amount,
       {DISCOUNT} AS discount_pct
FROM cards_typed"""

SOCIAL = f"""
social AS (
  SELECT asin, keyword, source_extracted_at, rating, ratings_count, monthly_sales, coupon AS coupon_raw,
    {num("regexp_extract(rating, '^([\\d.]+)', 1)")} AS rating_value,
    {scaled('ratings_count', '\\(([\\d.]+)([KkMm]?)\\)')} AS ratings_count_value,
    CASE WHEN monthly_sales IS NOT NULL THEN {scaled('monthly_sales', '([\\d.]+)([KkMm]?)')} END AS monthly_sales_min,
    coupon IS NOT NULL AS has_coupon,
    CASE WHEN coupon IS NOT NULL THEN {num("regexp_extract(coupon, 'Save\\s*([\\d.]+)\\s*%', 1)")} END AS coupon_discount_pct
  FROM cards
)"""
SQL["pr_social_proof"] = with_(CARDS, SOCIAL) + "SELECT * FROM social"

SQL["pr_listing_text"] = with_(LISTINGS, LISTINGS_TYPED) + """
SELECT asin, _source_file AS source_file, brand, category_depth, category_leaf,
       dimension_length, dimension_width, dimension_height, dimension_unit, weight_value, weight_unit,
       date_first_available, in_stock
FROM listings_typed"""

SQL["pr_rating_breakdown"] = with_(LISTINGS, LISTINGS_TYPED) + """
SELECT asin, _source_file AS source_file, rating_pct_5, rating_pct_4, rating_pct_3, rating_pct_2, rating_pct_1,
       rating_weighted_avg, size_count, color_count, main_image_url, image_count
FROM listings_typed"""

SQL["listing_ranks"] = with_(*LISTING_CHAIN) + """
SELECT asin, ingested_at, CAST(pos AS INTEGER) AS pos, r.rank AS rank, r.category AS category
FROM (SELECT asin, ingested_at, unnest(range(len(best_seller_ranks))) AS pos, unnest(best_seller_ranks) AS r
      FROM silver_listings)"""

# ------------------------------------------------------------------ facts, dimension extras

DIM_CURRENT_SK = "(SELECT product_sk, asin, marketplace FROM dim WHERE is_current)"

SQL["fact_search_ranking"] = with_(*DIM_CHAIN, *CARD_CHAIN, RANKING_ROWS) + f"""
SELECT d.product_sk, r.* FROM ranking r LEFT JOIN {DIM_CURRENT_SK} d USING (asin, marketplace)"""

PRICE_ROWS = f"""
price_latest AS (
  SELECT * FROM (
    SELECT asin, marketplace, ingested_at, price_amount AS latest_price, original_price_amount AS original_price_latest,
           discount_pct AS discount_pct_latest, coupon AS coupon_discount_pct_latest,
           row_number() OVER (PARTITION BY asin, marketplace, ingested_at
                              ORDER BY source_extracted_at DESC NULLS LAST, keyword DESC) AS _rn
    FROM silver_cards) WHERE _rn = 1
),
price_aggs AS (
  SELECT asin, marketplace, ingested_at,
    {rnd('min(price_amount)', 2)} AS min_price, {rnd('max(price_amount)', 2)} AS max_price,
    {rnd('avg(price_amount)', 2)} AS avg_price, bool_or(has_coupon) AS has_coupon,
    CAST(count(DISTINCT keyword) AS INTEGER) AS keyword_appearance_count
  FROM silver_cards GROUP BY asin, marketplace, ingested_at
),
price_rows AS (
  SELECT a.asin, a.marketplace, a.ingested_at, min_price, max_price, avg_price, latest_price, original_price_latest,
         discount_pct_latest, has_coupon, coupon_discount_pct_latest, keyword_appearance_count
  FROM price_aggs a JOIN price_latest l USING (asin, marketplace, ingested_at)
)"""

FACT_PRICE = f"""
fact_price AS (
  SELECT d.product_sk, p.* FROM price_rows p LEFT JOIN {DIM_CURRENT_SK} d USING (asin, marketplace)
)"""

SQL["fact_price_snapshot"] = with_(*DIM_CHAIN, *CARD_CHAIN, PRICE_ROWS, FACT_PRICE) + "SELECT * FROM fact_price"

SQL["dim_asof"] = with_(*DIM_CHAIN, *CARD_CHAIN, RANKING_ROWS) + """
SELECT d.product_sk, r.* FROM ranking r LEFT JOIN dim d
  ON r.asin = d.asin AND r.marketplace = d.marketplace
 AND d.effective_date <= r.ingested_at AND r.ingested_at <= coalesce(d.expiry_date, DATE '9999-12-31')"""

SQL["dim_current"] = with_(*DIM_CHAIN) + "SELECT * EXCLUDE (_attr_hash) FROM dim WHERE is_current"
SQL["dim_totals"] = with_(*DIM_CHAIN) + "SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current) AS current_rows FROM dim"
SQL["scd2_apply_last_day"] = SQL["scd2_rebuild"]

CUSTOMER_SNAPSHOTS = """
csnap AS (
  SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS snapshot_date,
         max(o_orderpriority) AS priority, max(o_orderstatus) AS status
  FROM orders GROUP BY 1, 2
)"""
SQL["scd2_customer"] = with_(CUSTOMER_SNAPSHOTS, scd2_sql("cdim", "csnap", ["custkey"], "snapshot_date", ["priority", "status"], ["priority", "status"], "customer_sk")) + "SELECT * FROM cdim"

SQL["new_keys"] = with_(*CARD_CHAIN) + """
SELECT s.asin, s.keyword, s.marketplace, s.ingested_at FROM silver_cards s
WHERE NOT EXISTS (SELECT 1 FROM silver_cards p
                  WHERE p.asin = s.asin AND p.keyword = s.keyword AND p.marketplace = s.marketplace
                    AND p.ingested_at = s.ingested_at - 1)"""

# ------------------------------------------------------------------ query layer

SQL["top_keywords"] = with_(*MART_CHAIN) + """
SELECT * FROM keyword_mart ORDER BY total_products DESC NULLS LAST, keyword, marketplace, ingested_at LIMIT 50"""

SQL["keyword_daily_on"] = with_(*MART_CHAIN) + """
SELECT keyword, marketplace, total_products, avg_price, sponsored_pct FROM keyword_mart
WHERE ingested_at = (SELECT max(ingested_at) FROM keyword_mart)
ORDER BY total_products DESC, keyword, marketplace LIMIT 50"""

SQL["price_lookup"] = with_(*DIM_CHAIN, *CARD_CHAIN, PRICE_ROWS, FACT_PRICE) + """
SELECT p.asin, d.brand, p.avg_price, p.min_price
FROM fact_price p LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON p.product_sk = d.product_sk
WHERE p.ingested_at = (SELECT max(ingested_at) FROM fact_price) AND p.marketplace = 'US'"""

# ------------------------------------------------------------------ analytics


def norm(c: str) -> str:
    return f"CASE WHEN s._max_{c} > s._min_{c} THEN (m.{c} - s._min_{c}) / (s._max_{c} - s._min_{c}) WHEN m.{c} IS NOT NULL THEN 0.0 END"


OPP_COLS = ["total_monthly_sales_min", "sponsored_pct", "avg_ratings_count"]
OPPORTUNITY = f"""
opportunity AS (
  SELECT m.keyword, m.marketplace, m.ingested_at, m.total_monthly_sales_min, m.sponsored_pct, m.avg_ratings_count,
    {rnd(f"CAST(0.5 AS DOUBLE) * {norm('total_monthly_sales_min')} - CAST(0.3 AS DOUBLE) * {norm('sponsored_pct')} - CAST(0.2 AS DOUBLE) * {norm('avg_ratings_count')}", 4)} AS opportunity_score,
    (m.sponsored_pct < 30.0 AND m.avg_ratings_count < 500) AS is_target
  FROM keyword_mart m LEFT JOIN (
    SELECT marketplace, ingested_at, {', '.join(f'min({c}) AS _min_{c}, max({c}) AS _max_{c}' for c in OPP_COLS)}
    FROM keyword_mart GROUP BY marketplace, ingested_at) s
  ON m.marketplace = s.marketplace AND m.ingested_at = s.ingested_at
)"""
SQL["opportunity"] = with_(*MART_CHAIN, OPPORTUNITY) + "SELECT * FROM opportunity"
SQL["opportunity_top"] = with_(*MART_CHAIN, OPPORTUNITY) + """
SELECT * FROM opportunity ORDER BY opportunity_score DESC NULLS LAST, keyword, marketplace, ingested_at LIMIT 50"""

SQL["margin"] = with_(*MART_CHAIN, PRICE_ROWS) + f"""
, pressure AS (
  SELECT r.keyword, r.marketplace, r.ingested_at, {rnd('avg(p.discount_pct_latest)', 2)} AS avg_discount_latest
  FROM ranking r LEFT JOIN price_rows p USING (asin, marketplace, ingested_at)
  GROUP BY r.keyword, r.marketplace, r.ingested_at
)
SELECT m.keyword, m.marketplace, m.ingested_at, m.median_price,
  {rnd('m.median_price - CAST(0.3 AS DOUBLE) * m.median_price - CAST(0.15 AS DOUBLE) * m.median_price - CAST(0.0 AS DOUBLE)', 2)} AS estimated_margin,
  p.avg_discount_latest,
  CASE WHEN m.total_products > 0 THEN {rnd('m.coupon_count / m.total_products * 100', 2)} END AS coupon_density_pct,
  m.median_price > 20.0 AS price_ok
FROM keyword_mart m LEFT JOIN pressure p USING (keyword, marketplace, ingested_at)"""
SQL["margin"] = f"""SELECT *, coalesce(price_ok, false) AND coalesce(avg_discount_latest, 0.0) <= 30.0
                AND coalesce(coupon_density_pct, 0.0) <= 50.0 AS keep
FROM ({SQL["margin"]})"""

SQL["stability"] = with_(*MART_CHAIN) + f"""
SELECT keyword, marketplace, count(y) AS n_days,
  {rnd('avg(y)', 2)} AS avg_demand, {rnd('stddev_samp(y)', 2)} AS stddev_demand,
  CASE WHEN count(y) >= 2 AND stddev_samp(y) > 0 THEN {rnd('avg(y) / stddev_samp(y)', 4)} END AS stability_score,
  {rnd('regr_slope(y, x)', 4)} AS trend_slope
FROM (SELECT keyword, marketplace, CAST(total_monthly_sales_min AS DOUBLE) AS y,
             CAST(ingested_at - DATE '1970-01-01' AS DOUBLE) AS x FROM keyword_mart)
GROUP BY keyword, marketplace"""

SQL["ad_saturation"] = with_(*MART_CHAIN) + """
SELECT keyword, marketplace, ingested_at, sponsored_pct, best_seller_count,
  CASE WHEN sponsored_pct IS NULL THEN NULL WHEN sponsored_pct < 30.0 THEN 'healthy'
       WHEN sponsored_pct <= 50.0 THEN 'competitive' ELSE 'red_flag' END AS ad_band
FROM keyword_mart"""

SQL["fragmentation"] = with_(*MART_CHAIN) + """
SELECT m.keyword, m.marketplace, m.ingested_at, m.best_seller_count, m.avg_ratings_count,
  s.median_best_seller_count, s.median_avg_ratings_count,
  (m.best_seller_count <= s.median_best_seller_count AND m.avg_ratings_count <= s.median_avg_ratings_count) AS is_fragmented
FROM keyword_mart m LEFT JOIN (
  SELECT marketplace, ingested_at, quantile_disc(best_seller_count, 0.5) AS median_best_seller_count,
         quantile_disc(avg_ratings_count, 0.5) AS median_avg_ratings_count
  FROM keyword_mart GROUP BY marketplace, ingested_at) s
ON m.marketplace = s.marketplace AND m.ingested_at = s.ingested_at"""

SQL["rank_moves"] = with_(*LISTING_CHAIN, PERFORMANCE) + """
SELECT asin, marketplace, ingested_at, bsr_primary_rank,
  lag(ingested_at) OVER w AS prev_ingested_at,
  lag(bsr_primary_rank) OVER w AS prev_bsr_primary_rank,
  lag(bsr_primary_rank) OVER w - bsr_primary_rank AS rank_change
FROM performance WINDOW w AS (PARTITION BY asin, marketplace ORDER BY ingested_at)"""

SQL["keyword_dimension"] = with_(*MART_CHAIN) + """
SELECT keyword_norm, marketplace, ingested_at, count(DISTINCT keyword) AS n_variants,
  CAST(sum(total_products) AS BIGINT) AS total_products,
  CAST(sum(total_monthly_sales_min) AS BIGINT) AS total_monthly_sales_min
FROM (SELECT *, regexp_replace(lower(trim(regexp_replace(keyword, '\\s+', ' ', 'g'))), '^(.*[a-z]{2}[^s\\s])s$', '\\1') AS keyword_norm
      FROM keyword_mart)
GROUP BY keyword_norm, marketplace, ingested_at"""

# ------------------------------------------------------------------ data quality

SQL["dq_duplicate_current"] = with_(*DIM_CHAIN) + """
SELECT 'duplicate_current' AS check_name, count(*) AS failures FROM (
  SELECT asin, marketplace FROM dim WHERE is_current GROUP BY asin, marketplace HAVING count(*) > 1)"""

SQL["dq_null_keys"] = with_(*CARD_CHAIN, RANKING_ROWS, PERFORMANCE) + """
SELECT 'ranking_null_keys' AS check_name,
       count(*) FILTER (WHERE asin IS NULL OR keyword IS NULL OR marketplace IS NULL OR ingested_at IS NULL) AS failures
FROM ranking
UNION ALL
SELECT 'performance_null_keys', count(*) FILTER (WHERE asin IS NULL OR marketplace IS NULL OR ingested_at IS NULL)
FROM performance"""
SQL["dq_null_keys"] = SQL["dq_null_keys"].replace("WITH ", "WITH " + LISTINGS.strip() + ",\n" + LISTINGS_TYPED.strip() + ",\n" + SILVER_LISTINGS.strip() + ",\n", 1)

SQL["dq_version_chain"] = with_(*DIM_CHAIN) + """
, v AS (SELECT product_sk, effective_date, expiry_date, is_current,
               lead(effective_date) OVER (PARTITION BY asin, marketplace ORDER BY effective_date) AS nxt FROM dim)
SELECT 'chain_gap' AS check_name, count(*) FILTER (WHERE nxt IS NOT NULL AND expiry_date IS DISTINCT FROM CAST(nxt - 1 AS DATE)) AS failures FROM v
UNION ALL SELECT 'open_not_last', count(*) FILTER (WHERE nxt IS NOT NULL AND is_current) FROM v
UNION ALL SELECT 'last_not_open', count(*) FILTER (WHERE nxt IS NULL AND NOT is_current) FROM v
UNION ALL SELECT 'inverted', count(*) FILTER (WHERE effective_date > expiry_date) FROM v
UNION ALL SELECT 'duplicate_sk', count(product_sk) - count(DISTINCT product_sk) FROM v"""

SQL["dq_change_pairs"] = with_(*DIM_CHAIN) + """
SELECT count(*) AS changed_keys,
       count(*) FILTER (WHERE current_versions <> 1 OR closed_versions <> versions - 1) AS failures
FROM (SELECT asin, marketplace, count(*) AS versions,
             count(*) FILTER (WHERE is_current) AS current_versions,
             count(*) FILTER (WHERE NOT is_current AND expiry_date IS NOT NULL) AS closed_versions
      FROM dim GROUP BY asin, marketplace)
WHERE versions >= 2"""


def profile_sql(source: str, cols: list[str], pairs: dict[str, str]) -> str:
    parts = []
    for c in cols:
        raw = next((r for r, p in pairs.items() if p == c), None)
        rnn = f"count(*) FILTER (WHERE {raw} IS NOT NULL)" if raw else "CAST(NULL AS BIGINT)"
        ok = f"count(*) FILTER (WHERE {raw} IS NOT NULL AND {c} IS NOT NULL)" if raw else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
            f"{rnn} AS raw_non_null, {ok} AS parsed FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


_PROFILE_INNER = (
    profile_sql("(SELECT price_raw AS price, price_amount FROM cards_typed)", ["price", "price_amount"], {"price": "price_amount"})
    + "\nUNION ALL\n"
    + profile_sql(
        "social",
        ["rating", "ratings_count", "monthly_sales", "coupon_raw", "rating_value", "ratings_count_value", "monthly_sales_min",
         "has_coupon", "coupon_discount_pct"],
        {"rating": "rating_value", "ratings_count": "ratings_count_value", "monthly_sales": "monthly_sales_min",
         "coupon_raw": "coupon_discount_pct"},
    )
)
SQL["dq_profile"] = with_(CARDS, CARDS_TYPED, SOCIAL) + f"""
SELECT *, CASE WHEN rows > 0 THEN {rnd('nulls / rows * 100', 2)} END AS null_pct,
          CASE WHEN raw_non_null > 0 THEN {rnd('parsed / raw_non_null * 100', 2)} END AS parse_pct
FROM ({_PROFILE_INNER})"""

SQL["dq_rerun_identical"] = with_(*CARD_CHAIN) + """
SELECT 'silver_cards' AS check_name, count(*) AS rows, CAST(0 AS BIGINT) AS failures FROM silver_cards"""

# ------------------------------------------------------------------ sources and sinks

SQL["bronze_roundtrip"] = with_(CARDS) + "SELECT * EXCLUDE (source_file) FROM cards"
SQL["replace_partition_rerun"] = SQL["silver_cards"]
SQL["bronze_stream_roundtrip"] = with_(CARDS) + "SELECT * EXCLUDE (source_file, ingested_at), CAST(ingested_at AS DATE) AS ingested_at FROM cards"

SQL["write_modes"] = with_(*CARD_CHAIN) + "SELECT * FROM silver_cards WHERE marketplace = 'US'"

# Detail files: a product's line number is its number of sizes.
SQL["ingest_details"] = with_(LISTINGS) + """
SELECT asin, title, brand, category, dimensions, weight, date_first_available, parent_asin, variation_count, stock_status, buybox_seller, is_fba,
       marketplace, ingested_at[1:4] || '-01-01T00:00:00' AS source_extracted_at, ingested_at[1:4] || '-01-01' AS ingested_at,
       CAST(star5 AS DOUBLE) + CASE WHEN n_sizes % 3 = 0 THEN 0.5 ELSE 0 END AS star5, CAST(star4 AS DOUBLE) AS star4,
       CAST(star3 AS DOUBLE) AS star3, CAST(NULL AS DOUBLE) AS star2, CAST(star1 AS DOUBLE) AS star1,
       best_seller_rank[1] AS first_rank, CAST(len(best_seller_rank) AS INTEGER) AS n_ranks, CAST(n_sizes AS INTEGER) AS n_sizes,
       CAST(n_images AS INTEGER) AS n_images, categories[-1] AS leaf, len(categories)::BIGINT AS depth
FROM listings"""

SQL["quarantine"] = with_(LISTINGS) + """
, l AS (
  SELECT make_date(CAST(ingested_at[1:4] AS INTEGER), 1, 1) AS ingested_at, marketplace, n_sizes,
         CAST(regexp_extract(source_file, 'details_([0-9]+)_', 1) AS BIGINT) AS o
  FROM listings
), f AS (SELECT *, o // 4096 AS file, (o // 4096 + year(ingested_at)) % 5 = 4 AS cut FROM l)
, r AS (
  SELECT ingested_at, CASE WHEN n_sizes = 7 AND o % 5 = 0 THEN 'not an object' ELSE 'kept' END AS reason, count(*) AS rows
  FROM f WHERE NOT cut GROUP BY ALL
  UNION ALL
  SELECT ingested_at, 'not json', count(DISTINCT (file, marketplace)) FROM f WHERE cut GROUP BY ALL
)
SELECT * FROM r UNION ALL SELECT CAST(NULL AS DATE), 'read', CAST(sum(rows) AS BIGINT) FROM r"""

SQL["ingest_discovered"] = """
SELECT event_id AS id, CAST(NULL AS VARCHAR) AS never,
       CASE event_id % 3 WHEN 0 THEN floor(value) WHEN 1 THEN value END AS amount,
       CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN 'u' || CAST(user_id AS VARCHAR) END AS who,
       CASE WHEN event_id % 3 = 2 THEN event_type END AS kind, CASE WHEN event_id % 3 = 2 THEN event_type || '|x' END AS tags,
       CAST(event_id % 3 AS VARCHAR) AS shape, strftime(date_trunc('month', ts), '%Y-%m-%d') AS ingested_at
FROM events"""

# ------------------------------------------------------------------ variants and planted faults

SQL["keyword_variants"] = """
WITH RECURSIVE e AS (
  SELECT event_id, user_id, event_type || ' case' AS w, event_id % 7 AS kind,
         CAST(event_id % length(event_type || ' case') + 1 AS INTEGER) AS i FROM events
), typed AS (
  SELECT user_id, CASE kind WHEN 1 THEN upper(w) WHEN 2 THEN w || 's' WHEN 3 THEN '  ' || replace(w, ' ', '  ')
    WHEN 4 THEN substr(w, 1, i - 1) || substr(w, i + 1) WHEN 5 THEN substr(w, 1, i - 1) || 'q' || substr(w, i + 1)
    WHEN 6 THEN substr(w, 1, i - 1) || 'qq' || substr(w, i + 1) ELSE w END AS keyword
  FROM e
), named AS (
  SELECT *, regexp_replace(lower(trim(regexp_replace(keyword, '\\s+', ' ', 'g'))), '^(.*[a-z]{2}[^s\\s])s$', '\\1') AS stem FROM typed
), stems AS (SELECT DISTINCT stem FROM named),
links AS (
  SELECT a.stem AS a, b.stem AS b FROM stems a JOIN stems b ON a.stem <> b.stem
  WHERE length(a.stem) >= 6 AND length(b.stem) >= 6 AND levenshtein(a.stem, b.stem) = 1
), reach AS (
  SELECT stem AS node, stem AS top FROM stems
  UNION
  SELECT l.b, r.top FROM reach r JOIN links l ON l.a = r.node WHERE r.top < l.b
), groups AS (SELECT node AS stem, min(top) AS keyword_group FROM reach GROUP BY node)
SELECT keyword_group, user_id % 3 AS part, count(*) AS cards, count(DISTINCT keyword) AS n_keywords
FROM named JOIN groups USING (stem) GROUP BY ALL"""

FAULTY = CARDS.replace("cards AS (", "good_cards AS (", 1) + """
, cards AS (SELECT * REPLACE (
    CASE WHEN is_best_seller THEN '7.9 out of 5 stars' ELSE rating END AS rating,
    CASE WHEN is_amazons_choice THEN 'many bought' ELSE monthly_sales END AS monthly_sales,
    CASE WHEN is_amazons_choice THEN 'Save 150%with coupon' ELSE coupon END AS coupon,
    CASE WHEN is_amazons_choice AND is_prime THEN 'XX' ELSE marketplace END AS marketplace,
    CASE WHEN is_best_seller AND is_sponsored THEN NULL ELSE keyword END AS keyword) FROM good_cards)"""


def rule_sql(name: str, kind: str, column: str, looks: str, fails: str, tolerance: float = 0.0) -> str:
    return (
        f"SELECT '{name}' AS rule, '{kind}' AS kind, '{column}' AS column_name, count(*) FILTER (WHERE {looks}) AS rows, "
        f"count(*) FILTER (WHERE {looks} AND {fails}) AS failures, {tolerance} AS t FROM typed"
    )


_known = "{0} IS NOT NULL".format
_RULES = "\nUNION ALL\n".join([
    rule_sql("rating in stars", "range", "rating_value", _known("rating_value"), "(rating_value < 1 OR rating_value > 5)"),
    rule_sql("coupon share", "range", "coupon_discount_pct", _known("coupon_discount_pct"), "coupon_discount_pct > 100"),
    rule_sql("coupon share, mostly", "range", "coupon_discount_pct", _known("coupon_discount_pct"), "coupon_discount_pct > 100", 0.9),
    rule_sql("reviews not negative", "range", "ratings_count_value", _known("ratings_count_value"), "ratings_count_value < 0"),
    rule_sql("sales read", "parsed", "monthly_sales_min", _known("monthly_sales"), "monthly_sales_min IS NULL"),
    rule_sql("rating read", "parsed", "rating_value", _known("rating"), "rating_value IS NULL"),
    rule_sql("keyword known", "known", "keyword", "true", "keyword IS NULL"),
    rule_sql("asin known", "known", "asin", "true", "asin IS NULL"),
    rule_sql("marketplace", "one_of", "marketplace", _known("marketplace"), "marketplace NOT IN ('US', 'DE', 'VN')"),
])
SQL["dq_rules"] = with_(FAULTY, f"""typed AS (
  SELECT asin, keyword, marketplace, rating, monthly_sales,
    {num("regexp_extract(rating, '^([\\d.]+)', 1)")} AS rating_value,
    {scaled('ratings_count', '\\(([\\d.]+)([KkMm]?)\\)')} AS ratings_count_value,
    CASE WHEN monthly_sales IS NOT NULL THEN {scaled('monthly_sales', '([\\d.]+)([KkMm]?)')} END AS monthly_sales_min,
    CASE WHEN coupon IS NOT NULL THEN {num("regexp_extract(coupon, 'Save\\s*([\\d.]+)\\s*%', 1)")} END AS coupon_discount_pct
  FROM cards
)""") + f"""
SELECT rule, kind, column_name, rows, failures, coalesce({rnd('failures / nullif(rows, 0) * 100', 2)}, 0.0) AS failure_pct,
       coalesce(failures / nullif(rows, 0), 0) <= t AS holds
FROM ({_RULES})"""

SQL["dq_faulty_dimension"] = with_(*DIM_CHAIN) + """
, f AS (
  SELECT CASE WHEN marketplace = 'VN' AND is_fba THEN NULL ELSE asin END AS asin, marketplace, is_current, effective_date, product_sk,
         CASE WHEN marketplace = 'US' AND NOT is_current THEN CAST(expiry_date - 1 AS DATE) ELSE expiry_date END AS expiry_date
  FROM dim
  UNION ALL
  SELECT asin, marketplace, is_current, effective_date, product_sk, expiry_date FROM dim WHERE marketplace = 'DE' AND is_current
), v AS (
  SELECT *, lead(effective_date) OVER (PARTITION BY asin, marketplace ORDER BY effective_date) AS nxt FROM f WHERE marketplace = 'US'
)
SELECT 'duplicate_current' AS check_name, count(*) AS failures FROM (
  SELECT 1 FROM f WHERE is_current AND asin IS NOT NULL GROUP BY asin, marketplace HAVING count(*) > 1)
UNION ALL SELECT 'null_keys', count(*) FILTER (WHERE asin IS NULL OR marketplace IS NULL) FROM f
UNION ALL SELECT 'chain_gap', count(*) FILTER (WHERE nxt IS NOT NULL AND expiry_date IS DISTINCT FROM CAST(nxt - 1 AS DATE)) FROM v
UNION ALL SELECT 'open_not_last', count(*) FILTER (WHERE nxt IS NOT NULL AND is_current) FROM v
UNION ALL SELECT 'last_not_open', count(*) FILTER (WHERE nxt IS NULL AND NOT is_current) FROM v
UNION ALL SELECT 'inverted', count(*) FILTER (WHERE effective_date > expiry_date) FROM v
UNION ALL SELECT 'duplicate_sk', count(product_sk) - count(DISTINCT product_sk) FROM v"""

# ------------------------------------------------------------------ served views, stored reads and writes

PERF_CURRENT = f"""
perf_current AS (
  SELECT d.product_sk, p.* FROM performance p LEFT JOIN {DIM_CURRENT_SK} d USING (asin, marketplace)
)"""
BRAND_DAILY = BRAND_MART.replace("fact_performance f LEFT JOIN dim d", "perf_current f LEFT JOIN (SELECT * FROM dim WHERE is_current) d")
SQL["mart_brand_daily"] = with_(*DIM_CHAIN, PERFORMANCE, PERF_CURRENT, BRAND_DAILY) + "SELECT * FROM brand_mart"

SQL["served_views"] = with_(*DIM_CHAIN, *CARD_CHAIN, RANKING_ROWS, KEYWORD_MART, PRICE_ROWS, PERFORMANCE, PERF_CURRENT, BRAND_DAILY) + """
SELECT 'dim_product' AS name, false AS was_missing, 1 AS place, count(*) AS rows FROM dim WHERE is_current
UNION ALL SELECT 'fact_price_snapshot', false, 2, count(*) FROM price_rows
UNION ALL SELECT 'fact_product_performance', true, 3, count(*) FROM performance
UNION ALL SELECT 'fact_search_ranking', false, 4, count(*) FROM ranking
UNION ALL SELECT 'mart_brand_competitive', true, 5, count(*) FROM brand_mart
UNION ALL SELECT 'mart_keyword_daily', true, 6, count(*) FROM keyword_mart"""

SQL["day_reads"] = with_(*CARD_CHAIN) + """
, newest AS (SELECT max(ingested_at) AS d FROM silver_cards)
SELECT w.way, s.* FROM silver_cards s, newest, (VALUES ('partition'), ('equality'), ('sql')) w(way) WHERE s.ingested_at = d
UNION ALL SELECT 'rest', s.* FROM silver_cards s, newest WHERE s.ingested_at < d"""

SQL["write_appends"] = with_(*CARD_CHAIN) + """
SELECT 'appended' AS step, * FROM silver_cards UNION ALL SELECT 'appended', * FROM silver_cards
UNION ALL SELECT 'overwritten', * FROM silver_cards WHERE marketplace = 'DE'"""

SQL["write_reports"] = with_(*CARD_CHAIN) + """
, n AS (SELECT count(*) AS a, count(*) FILTER (WHERE marketplace = 'US') AS us,
               count(*) FILTER (WHERE ingested_at = (SELECT max(ingested_at) FROM silver_cards)) AS d FROM silver_cards)
SELECT step::INTEGER AS step, mode, rows, 23 AS n_columns, skipped, a AS stored_rows FROM n, LATERAL (VALUES
  (0, 'append', a, false), (1, 'append', 0, true), (2, 'ignore', 0, true), (3, 'overwrite', us, false), (4, 'overwrite', 0, true),
  (5, 'overwrite', d, false), (6, 'overwrite', 0, true), (7, 'overwrite', a, false)) v(step, mode, rows, skipped)"""
