"""Column-level functions: parsing rules, rounding, hashing."""

from shelfscope.functions.hashing import attr_hash, row_fingerprint, surrogate_key  # noqa: F401
from shelfscope.functions.numeric import (  # noqa: F401
    flag_count,
    flag_rate,
    guarded_pct,
    round_to,
    round_to_long,
)
from shelfscope.functions.parse import (  # noqa: F401
    category_depth,
    category_leaf,
    clean_brand,
    discount_pct,
    first_date,
    in_stock,
    parse_coupon,
    parse_dimensions,
    parse_monthly_sales,
    parse_price,
    parse_rank_array,
    parse_rating,
    parse_ratings_count,
    parse_weight,
    rating_breakdown,
    to_day,
    to_ts,
)
