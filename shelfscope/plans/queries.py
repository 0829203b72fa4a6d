"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` runs a reference
operator or pipeline over the whole driver tables (via the fixture
adapters), with audit timestamps left out so results are comparable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.functions import parse
from shelfscope.operators import analytics, clean, dimension, facts, marts, quality, topk, variants
from shelfscope.plans import views
from shelfscope.plans.day import Lake, rebuild, run_bronze
from shelfscope.session import apply_defaults, materialize, shared_dir
from shelfscope.sinks import tables
from shelfscope.sources import fixtures, raw
from shelfscope.streaming.ingest import start_bronze_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return deco


# ---------------------------------------------------------------- silver


def silver_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_cards(fixtures.raw_cards(spark, sf_dir), audit_col=None)


def silver_listings(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return clean.clean_listings(fixtures.raw_listings(spark, sf_dir), audit_col=None, columns=columns)


def listing_snapshots(spark: SparkSession, sf_dir: str, attrs=dimension.PRODUCT_ATTRS) -> DataFrame:
    """DM-02 on the silver listings: only the snapshot's columns are shuffled."""
    return silver_listings(spark, sf_dir, dimension.snapshot_columns(attrs))


def performance_rows(spark: SparkSession, sf_dir: str, only=None) -> DataFrame:
    """PR-19 on the silver listings: only the fact's columns are shuffled."""
    return silver_listings(spark, sf_dir, facts.performance_columns(only))


def performance_listings(spark: SparkSession, sf_dir: str, only=facts.PERFORMANCE_COLS) -> DataFrame:
    """Stored silver listings as the performance fact and the versions it is
    keyed to read them: fact columns and tracked attributes."""
    tracked = [c for c in dimension.PRODUCT_TRACKED if c not in only]
    return materialize(spark, silver_listings(spark, sf_dir, [*facts.performance_columns(only), *tracked]))


@register("silver_cards")
def q_silver_cards(spark, sf_dir):
    """PL-02: PR-01..06, PR-17/18, WN-01."""
    return silver_cards(spark, sf_dir)


# ---------------------------------------------------------------- marts


def ranking_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking fact as stored, which the mart reads twice."""
    return materialize(spark, facts.ranking_rows(silver_cards(spark, sf_dir)))


def keyword_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.keyword_daily(ranking_fact(spark, sf_dir), audit_col=None)


@register("mart_keyword_daily")
def q_mart_keyword_daily(spark, sf_dir):
    """PL-08 (flagship): keyword x marketplace x day KPIs."""
    return keyword_mart(spark, sf_dir)


# ---------------------------------------------------------------- dimension


def product_dim(spark: SparkSession, sf_dir: str, attrs=dimension.PRODUCT_ATTRS) -> DataFrame:
    return dimension.scd2_rebuild(listing_snapshots(spark, sf_dir, attrs))


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension with the tracked attributes only, for readers of
    keys, days and flags."""
    return product_dim(spark, sf_dir, dimension.PRODUCT_TRACKED)


@register("silver_listings")
def q_silver_listings(spark, sf_dir):
    """PL-03: PR-07..18, WN-02; image URLs as one text (ranks: listing_ranks)."""
    s = silver_listings(spark, sf_dir).drop("best_seller_ranks")
    return s.withColumn("all_image_urls", F.array_join("all_image_urls", "|"))


@register("scd2_rebuild")
def q_scd2_rebuild(spark, sf_dir):
    """DM-01..03, DM-08: every product version from the whole listing history."""
    return product_dim(spark, sf_dir)


@register("fact_product_performance")
def q_fact_product_performance(spark, sf_dir):
    """PL-07 with the as-of version key (JN-06).  Silver is materialized once
    and read by both the dimension and the fact, as the persisted table is."""
    listings = performance_listings(spark, sf_dir)
    dim = dimension.scd2_rebuild(listings.select(*dimension.snapshot_columns(dimension.PRODUCT_TRACKED)))
    return facts.keyed_performance(listings.select(*facts.PERFORMANCE_COLS), dim, lookup="asof", audit_col=None)


@register("mart_brand_competitive")
def q_mart_brand_competitive(spark, sf_dir):
    """PL-09 over the rebuilt history: facts keyed to the version valid on
    their day, carrying that version's brand and leaf category."""
    listings = performance_listings(spark, sf_dir, marts.BRAND_INPUT)
    dim = dimension.scd2_rebuild(listings.select(*dimension.snapshot_columns(dimension.PRODUCT_TRACKED)))
    perf = dimension.asof_lookup(listings.select(*marts.BRAND_INPUT), dim, cols=("brand", "category_leaf"))
    return marts.brand_competitive(perf, None, audit_col=None)


# ---------------------------------------------------------------- per-rule parsing


@register("pr_price")
def q_pr_price(spark, sf_dir):
    """PR-01, PR-06 on every card."""
    t = clean.type_cards(fixtures.raw_cards(spark, sf_dir))
    return t.select("asin", "keyword", "source_extracted_at", "price_raw", "price_currency", "price_amount",
                    "original_price_amount", "discount_pct")


@register("pr_social_proof")
def q_pr_social_proof(spark, sf_dir):
    """PR-02..05: rating, ratings count, monthly sales floor, coupon."""
    cards = fixtures.raw_cards(spark, sf_dir)
    P = parse
    has_coupon, coupon = P.parse_coupon("coupon")
    return cards.select(
        "asin", "keyword", "source_extracted_at", "rating", "ratings_count", "monthly_sales", F.col("coupon").alias("coupon_raw"),
        P.parse_rating("rating").alias("rating_value"),
        P.parse_ratings_count("ratings_count").alias("ratings_count_value"),
        P.parse_monthly_sales("monthly_sales").alias("monthly_sales_min"),
        has_coupon.alias("has_coupon"),
        coupon.alias("coupon_discount_pct"),
    )


@register("pr_listing_text")
def q_pr_listing_text(spark, sf_dir):
    """PR-07, PR-09, PR-10, PR-12, PR-13, PR-16 on every listing."""
    listings = fixtures.raw_listings(spark, sf_dir)
    P = parse
    length, width, height, unit = P.parse_dimensions("dimensions")
    wv, wu = P.parse_weight("weight")
    return listings.select(
        "asin", "source_file",
        P.clean_brand("brand").alias("brand"),
        P.category_depth("categories").alias("category_depth"),
        P.category_leaf("categories").alias("category_leaf"),
        length.alias("dimension_length"), width.alias("dimension_width"), height.alias("dimension_height"),
        unit.alias("dimension_unit"), wv.alias("weight_value"), wu.alias("weight_unit"),
        P.first_date("date_first_available").alias("date_first_available"),
        P.in_stock("stock_status").alias("in_stock"),
    )


@register("pr_rating_breakdown")
def q_pr_rating_breakdown(spark, sf_dir):
    """PR-11, PR-14, PR-15: star shares, weighted mean, variation and media counts."""
    listings = fixtures.raw_listings(spark, sf_dir)
    return listings.select(
        "asin", "source_file", *parse.rating_breakdown("rating_overview"),
        F.size("available_dimensions.size_name").alias("size_count"),
        F.size("available_dimensions.color_name").alias("color_count"),
        F.get(F.col("images"), 0).alias("main_image_url"),
        F.size("images").alias("image_count"),
    )


@register("listing_ranks")
def q_listing_ranks(spark, sf_dir):
    """PR-08: every rank entry of every silver listing, one row each."""
    s = silver_listings(spark, sf_dir, ["asin", "ingested_at", "best_seller_ranks"])
    return s.select("asin", "ingested_at", F.posexplode("best_seller_ranks").alias("pos", "r")).select(
        "asin", "ingested_at", "pos", "r.rank", "r.category"
    )


# ---------------------------------------------------------------- facts


@register("fact_search_ranking")
def q_fact_search_ranking(spark, sf_dir):
    """PL-05: cards with the current product key (JN-01)."""
    return facts.fact_search_ranking(silver_cards(spark, sf_dir), product_versions(spark, sf_dir), audit_col=None)


@register("fact_price_snapshot")
def q_fact_price_snapshot(spark, sf_dir):
    """PL-06: AG-01..03, AG-09, WN-03, JN-01."""
    return facts.fact_price_snapshot(silver_cards(spark, sf_dir), product_versions(spark, sf_dir), audit_col=None)


@register("dim_asof")
def q_dim_asof(spark, sf_dir):
    """JN-06: ranking rows keyed to the version valid on their day, from the
    stored silver table."""
    cards = materialize(spark, silver_cards(spark, sf_dir))
    return facts.fact_search_ranking(cards, product_versions(spark, sf_dir), lookup="asof", audit_col=None)


# ---------------------------------------------------------------- dimension extras


@register("dim_current")
def q_dim_current(spark, sf_dir):
    """DM-07: active versions, change hash hidden."""
    return dimension.current_view(product_dim(spark, sf_dir))


@register("dim_totals")
def q_dim_totals(spark, sf_dir):
    """DM-09: total and current version counts."""
    return dimension.dim_totals(product_versions(spark, sf_dir))


@register("scd2_customer")
def q_scd2_customer(spark, sf_dir):
    """DM-08 with other keys and tracked columns: customer order profile history."""
    snaps = fixtures.customer_snapshots(spark, sf_dir)
    return dimension.scd2_rebuild(
        snaps, keys=["custkey"], day="snapshot_date", tracked=["priority", "status"], attrs=["priority", "status"], sk="customer_sk"
    )


@register("scd2_apply_last_day")
def q_scd2_apply_last_day(spark, sf_dir):
    """DM-04/05: rebuild up to the day before the last day, then load the last
    day incrementally; equals the rebuild of the whole history."""
    snaps = materialize(spark, listing_snapshots(spark, sf_dir))
    last = snaps.agg(F.max("ingested_at")).first()[0]
    before = dimension.scd2_rebuild(snaps.filter(F.col("ingested_at") < F.lit(last)))
    incoming = dimension.shape_incoming(snaps.filter(F.col("ingested_at") == F.lit(last)), last)
    return dimension.scd2_apply(before, incoming, last)


def quarterly(raw_rows: DataFrame) -> DataFrame:
    """The same scrapes as quarterly loads: every row is ingested on the first
    day of its quarter."""
    return raw_rows.withColumn("ingested_at", F.date_format(F.trunc(F.to_date("ingested_at"), "quarter"), "yyyy-MM-dd"))


@register("dim_persisted_load")
def q_dim_persisted_load(spark, sf_dir):
    """PL-04, SK-03..05, DM-04..06: the stored dimension through a first
    generation with wrong titles, a load cut off before its commit, a rebuild, a
    day loaded twice (first with wrong titles) and another cut-off load; what is
    read back is the history of right rows."""
    path = shared_dir(spark, "dim")
    raw_rows = quarterly(fixtures.raw_listings(spark, sf_dir))
    snaps = materialize(spark, clean.clean_listings(raw_rows, audit_col=None, columns=dimension.snapshot_columns()))
    wrong = snaps.withColumn("title", F.concat(F.lit("wrong "), "title"))
    days = [r[0] for r in snaps.select("ingested_at").distinct().orderBy("ingested_at").collect()]

    def on(rows, day):
        return dimension.shape_incoming(rows.where(F.col("ingested_at") == F.lit(day)), day)

    def cut_off(day):
        state = tables.dim_state(spark, path)
        loaded = dimension.scd2_apply(tables.read_dimension(spark, path, current_only=True), on(wrong, day), day)
        tables.stage_load(loaded, path, state.generation, state.last_load + 1)

    before = F.col("ingested_at") < F.lit(days[-2])
    tables.write_dimension(dimension.scd2_rebuild(wrong.where(before)), path, derived=dimension.derived_columns())
    cut_off(days[-2])
    tables.write_dimension(dimension.scd2_rebuild(snaps.where(before)), path, days[-3], dimension.derived_columns())
    for rows, day in ((wrong, days[-2]), (snaps, days[-2])):
        tables.scd2_load_day(spark, path, on(rows, day), day)
    cut_off(days[-1])
    tables.scd2_load_day(spark, path, on(snaps, days[-1]), days[-1])
    return tables.read_dimension(spark, path)


@register("rebuild_after_change")
def q_rebuild_after_change(spark, sf_dir):
    """PL-10: a lake rebuilt from its whole bronze history, and again after the
    middle quarter of listings is gone: no table keeps it, versions that
    ended there end later.  Returns the performance fact of the second
    generation, keyed as-of by its dimension."""
    lake = Lake(shared_dir(spark, "raw"), shared_dir(spark, "lake"))
    sources = {"search_results": fixtures.raw_cards(spark, sf_dir), "product_details": fixtures.raw_listings(spark, sf_dir)}
    for name, rows in sources.items():
        rows = quarterly(rows).withColumn("ingested_at", F.col("ingested_at").cast("date"))
        tables.replace_partitions(rows, lake.path("bronze", name), whole=True)
    rebuild(spark, lake)
    listings = lake.path("bronze", "product_details")
    quarters = [r[0] for r in spark.read.parquet(listings).select("ingested_at").distinct().orderBy("ingested_at").collect()]
    tables.delete_folder(spark, f"{listings}/ingested_at={quarters[len(quarters) // 2]}")
    rebuild(spark, lake)
    return spark.read.parquet(lake.at(spark).path("gold", "fact_product_performance")).drop("gold_processed_at")


@register("new_keys")
def q_new_keys(spark, sf_dir):
    """JN-04: card keys present on a day but absent the day before."""
    s = silver_cards(spark, sf_dir).select("asin", "keyword", "marketplace", "ingested_at")
    return dimension.new_keys(s, ["asin", "keyword", "marketplace"])


# ---------------------------------------------------------------- query layer


def brand_daily(spark, sf_dir, dim: DataFrame) -> DataFrame:
    """The brand mart as day runs build it: facts keyed by the current
    dimension and joined to it."""
    perf = facts.keyed_performance(performance_rows(spark, sf_dir, marts.BRAND_INPUT), dim, audit_col=None)
    return marts.brand_competitive(perf, dim, audit_col=None)


@register("mart_brand_daily")
def q_mart_brand_daily(spark, sf_dir):
    """PL-09, JN-03, FL-04 in the daily form: the current version's brand."""
    current = dimension.current_only(product_versions(spark, sf_dir))
    return brand_daily(spark, sf_dir, materialize(spark, current.drop("_attr_hash")))


def _gold_views(spark, sf_dir, names, frames: dict[str, DataFrame] | None = None):
    """Register the named served views, built only when named.  Gold frames a
    view query reads more than once (the latest-day subquery and the main
    scan; the dimension feeding both the price fact and the view join) are
    materialized once, as the stored tables are in the pipeline; ``frames``
    holds those of an earlier call.  The dimension is stored with its current
    versions, which are what the view shows and the facts look up."""
    frames = {} if frames is None else frames

    def dim() -> DataFrame:
        if "dim" not in frames:
            frames["dim"] = materialize(spark, dimension.current_only(product_dim(spark, sf_dir)))
        return frames["dim"]

    build = {
        "dim_product": dim,
        "fact_price_snapshot": lambda: materialize(
            spark, facts.fact_price_snapshot(silver_cards(spark, sf_dir), dim(), audit_col=None)
        ),
        "fact_search_ranking": lambda: materialize(
            spark, facts.fact_search_ranking(silver_cards(spark, sf_dir), dim(), audit_col=None)
        ),
        "fact_product_performance": lambda: materialize(
            spark, facts.keyed_performance(performance_rows(spark, sf_dir), dim(), audit_col=None), partly_dealt=True
        ),
        "mart_keyword_daily": lambda: materialize(spark, keyword_mart(spark, sf_dir)),
        "mart_brand_competitive": lambda: materialize(spark, brand_daily(spark, sf_dir, dim()), partly_dealt=True),
    }
    for n in names:
        if n not in frames:
            frames[n] = build[n]()
    views.register_views(spark, {n: frames[n] for n in names})


@register("top_keywords")
def q_top_keywords(spark, sf_dir):
    """SL-02/03: the 50 keyword days with most products over the whole mart."""
    mart = keyword_mart(spark, sf_dir)
    return topk.top_k(mart, ["total_products"], 50, ties=["keyword", "marketplace", "ingested_at"])


@register("keyword_daily_on")
def q_keyword_daily_on(spark, sf_dir):
    """QL-04: the latest day's keyword list through the SQL view."""
    _gold_views(spark, sf_dir, ["mart_keyword_daily"])
    return views.keyword_daily_on(spark)


@register("price_lookup")
def q_price_lookup(spark, sf_dir):
    """QL-05: latest day's US prices with brand through the SQL views."""
    _gold_views(spark, sf_dir, ["dim_product", "fact_price_snapshot"])
    return views.price_lookup(spark, "US")


@register("served_views")
def q_served_views(spark, sf_dir):
    """QL-01..03, SL-04, SO-02: half of the views served first, then all; per
    view whether it was missing before, whether it is listed now, its place in
    the listing and its rows as SQL counts them."""
    names = [v.name for v in views.describe_views()]
    for name in names:
        spark.catalog.dropTempView(name)
    frames: dict[str, DataFrame] = {}
    _gold_views(spark, sf_dir, names[:3], frames)
    missing = set(views.missing_views(spark))
    _gold_views(spark, sf_dir, names, frames)
    listed = [n for n in views.list_views(spark) if n in names]
    if views.missing_views(spark):
        raise RuntimeError(f"views not served: {views.missing_views(spark)}")
    rows = [spark.sql(f"SELECT '{n}' AS name, {n in missing} AS was_missing, {listed.index(n) + 1} AS place, count(*) AS rows FROM {n}") for n in names]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# ---------------------------------------------------------------- analytics


@register("opportunity")
def q_opportunity(spark, sf_dir):
    """AN-01: opportunity score and target flag for every keyword day."""
    return analytics.opportunity(materialize(spark, keyword_mart(spark, sf_dir)))


@register("opportunity_top")
def q_opportunity_top(spark, sf_dir):
    """AN-01 + SL-03: shortlist of the 50 best keyword days."""
    return topk.top_k(analytics.opportunity(materialize(spark, keyword_mart(spark, sf_dir))), ["opportunity_score"], 50,
                      ties=["keyword", "marketplace", "ingested_at"])


@register("margin")
def q_margin(spark, sf_dir):
    """AN-02: margin screen with discount pressure and coupon density."""
    cards = materialize(spark, silver_cards(spark, sf_dir))
    ranking = facts.ranking_rows(cards)
    return analytics.margin(marts.keyword_daily(ranking, audit_col=None), ranking, facts.price_snapshot_rows(cards))


@register("stability")
def q_stability(spark, sf_dir):
    """AN-03: demand stability per keyword and marketplace."""
    return analytics.stability(keyword_mart(spark, sf_dir))


@register("ad_saturation")
def q_ad_saturation(spark, sf_dir):
    """AN-04: sponsored-share band per keyword day."""
    return analytics.ad_saturation(keyword_mart(spark, sf_dir))


@register("fragmentation")
def q_fragmentation(spark, sf_dir):
    """AN-05: fragmented keyword days."""
    return analytics.fragmentation(materialize(spark, keyword_mart(spark, sf_dir)))


@register("rank_moves")
def q_rank_moves(spark, sf_dir):
    """AN-06 / WN-04: day-over-day primary rank movement per product."""
    return analytics.rank_moves(performance_rows(spark, sf_dir))


@register("keyword_dimension")
def q_keyword_dimension(spark, sf_dir):
    """AN-07: normalised keyword groups."""
    return analytics.keyword_dimension(keyword_mart(spark, sf_dir))


def spelled_cards(spark, sf_dir):
    """Every card with its keyword as people type it: in capitals, plural, with
    blanks, with a letter missing, replaced or added."""
    e = fixtures.table(spark, sf_dir, "events")
    word = F.concat("event_type", F.lit(" case"))
    at = (F.col("event_id") % F.length(word) + 1).cast("int")
    left, right = F.expr("substring(word, 1, at - 1)"), F.expr("substring(word, at + 1)")
    kind = F.col("event_id") % 7
    typed = (
        F.when(kind == 1, F.upper("word")).when(kind == 2, F.concat("word", F.lit("s"))).when(kind == 3, F.concat(F.lit("  "), F.replace("word", F.lit(" "), F.lit("  "))))
        .when(kind == 4, F.concat(left, right)).when(kind == 5, F.concat(left, F.lit("q"), right)).when(kind == 6, F.concat(left, F.lit("qq"), right))
        .otherwise(F.col("word"))
    )
    return e.select("event_id", "user_id", word.alias("word"), at.alias("at")).select("event_id", "user_id", typed.alias("keyword"))


@register("keyword_variants")
def q_keyword_variants(spark, sf_dir):
    """AN-07: cards per group of keyword variants and user's remainder."""
    cards = spelled_cards(spark, sf_dir)
    groups = variants.keyword_variants(cards)
    return cards.join(groups, "keyword").groupBy("keyword_group", (F.col("user_id") % 3).alias("part")).agg(
        F.count("*").alias("cards"), F.count_distinct("keyword").alias("n_keywords")
    )


# ---------------------------------------------------------------- data quality


def faulty_cards(spark, sf_dir):
    """Every card, some with faults: unreadable sales, ratings above five,
    coupons above the price, unknown marketplaces, no keyword."""
    c = fixtures.raw_cards(spark, sf_dir)
    best, choice = F.col("is_best_seller"), F.col("is_amazons_choice")
    return c.withColumns({
        "rating": F.when(best, F.lit("7.9 out of 5 stars")).otherwise(F.col("rating")),
        "monthly_sales": F.when(choice, F.lit("many bought")).otherwise(F.col("monthly_sales")),
        "coupon": F.when(choice, F.lit("Save 150%with coupon")).otherwise(F.col("coupon")),
        "marketplace": F.when(choice & F.col("is_prime"), F.lit("XX")).otherwise(F.col("marketplace")),
        "keyword": F.when(best & F.col("is_sponsored"), F.lit(None)).otherwise(F.col("keyword")),
    })


CARD_RULES = (
    quality.Rule("rating in stars", "range", "rating_value", 1, 5),
    quality.Rule("coupon share", "range", "coupon_discount_pct", 0, 100),
    quality.Rule("coupon share, mostly", "range", "coupon_discount_pct", 0, 100, tolerance=0.9),
    quality.Rule("reviews not negative", "range", "ratings_count_value", 0),
    quality.Rule("sales read", "parsed", "monthly_sales_min", raw="monthly_sales"),
    quality.Rule("rating read", "parsed", "rating_value", raw="rating"),
    quality.Rule("keyword known", "known", "keyword"),
    quality.Rule("asin known", "known", "asin"),
    quality.Rule("marketplace", "one_of", "marketplace", values=("US", "DE", "VN")),
)


@register("dq_rules")
def q_dq_rules(spark, sf_dir):
    """DQ-06: the card rules over every card with planted faults."""
    cards = faulty_cards(spark, sf_dir)
    _, coupon = parse.parse_coupon("coupon")
    typed = cards.select(
        "asin", "keyword", "marketplace", "rating", "monthly_sales", parse.parse_rating("rating").alias("rating_value"),
        parse.parse_ratings_count("ratings_count").alias("ratings_count_value"), parse.parse_monthly_sales("monthly_sales").alias("monthly_sales_min"),
        coupon.alias("coupon_discount_pct"),
    )
    return quality.check_rules(typed, CARD_RULES)


@register("dq_faulty_dimension")
def q_dq_faulty_dimension(spark, sf_dir):
    """DQ-01, DQ-02, DQ-05 on a dimension with planted faults: current rows of
    one marketplace twice, keys lost in another, closed versions that end too
    early."""
    read = ("product_sk", "asin", "marketplace", "is_fba", *dimension.VERSION_COLS)
    dim = materialize(spark, product_versions(spark, sf_dir).select(*read))
    early = F.when((F.col("marketplace") == "US") & ~F.col("is_current"), F.date_sub("expiry_date", 1)).otherwise(F.col("expiry_date"))
    lost = F.when((F.col("marketplace") == "VN") & F.col("is_fba"), F.lit(None)).otherwise(F.col("asin"))
    faulty = dim.withColumns({"expiry_date": early, "asin": lost}).unionByName(dim.where((F.col("marketplace") == "DE") & F.col("is_current")))
    keys = ["asin", "marketplace"]
    chain = quality.version_chain(faulty.where("marketplace = 'US'"), keys)
    return quality.duplicate_current(faulty.where("asin is not null"), keys).unionByName(quality.null_keys(faulty, keys)).unionByName(chain)


@register("dq_duplicate_current")
def q_dq_duplicate_current(spark, sf_dir):
    """DQ-01 on the product dimension."""
    return quality.duplicate_current(product_versions(spark, sf_dir), ["asin", "marketplace"])


@register("dq_null_keys")
def q_dq_null_keys(spark, sf_dir):
    """DQ-02 on the ranking and performance facts."""
    cards = silver_cards(spark, sf_dir)
    a = quality.null_keys(facts.ranking_rows(cards), ["asin", "keyword", "marketplace", "ingested_at"], "ranking_null_keys")
    b = quality.null_keys(performance_rows(spark, sf_dir), ["asin", "marketplace", "ingested_at"],
                          "performance_null_keys")
    return a.unionByName(b)


@register("dq_version_chain")
def q_dq_version_chain(spark, sf_dir):
    """DQ-05 on the product dimension."""
    return quality.version_chain(product_versions(spark, sf_dir), ["asin", "marketplace"])


@register("dq_change_pairs")
def q_dq_change_pairs(spark, sf_dir):
    """DQ-04 on the product dimension."""
    return quality.change_pairs(product_versions(spark, sf_dir), ["asin", "marketplace"])


CARD_PARSE_PAIRS = {
    "price": "price_amount",
    "rating": "rating_value",
    "ratings_count": "ratings_count_value",
    "monthly_sales": "monthly_sales_min",
    "coupon_raw": "coupon_discount_pct",
}


@register("dq_profile")
def q_dq_profile(spark, sf_dir):
    """DQ-06: null shares and parse rates of the card text rules."""
    sp = q_pr_social_proof(spark, sf_dir)
    pr = q_pr_price(spark, sf_dir).select(F.col("price_raw").alias("price"), "price_amount")
    a = quality.profile(pr, {"price": "price_amount"})
    b = quality.profile(sp.drop("asin", "keyword", "source_extracted_at"), {k: v for k, v in CARD_PARSE_PAIRS.items() if k != "price"})
    return a.unionByName(b)


@register("dq_rerun_identical")
def q_dq_rerun_identical(spark, sf_dir):
    """DQ-03: two runs of the silver card job, each stored, have identical content."""
    first, second = (materialize(spark, silver_cards(spark, sf_dir)) for _ in range(2))
    return quality.rerun_identical(first, second, "silver_cards")


# ---------------------------------------------------------------- sources and sinks


@register("bronze_roundtrip")
def q_bronze_roundtrip(spark, sf_dir):
    """SC-01..08, PL-01: cards written as scraper envelopes to the shared
    folder, read back by the raw ingest (all days at once)."""
    root = shared_dir(spark, "raw")
    raw.write_card_envelopes(fixtures.raw_cards(spark, sf_dir), root)
    rows, _bad = raw.ingest(spark, root, "search", raw.CARD_RECORD, raw.CARD_LIFT, layout="{root}/{source}/d={date}", multi_line=False)
    return rows.drop("source_file")


RAW_FILES = "{root}/{source}/d={date}/*.txt*"  # compressed or not


def listing_files(spark, sf_dir, root: str, faults: bool) -> None:
    """Every listing in multi-line detail files, one file per year and range of
    4096 order keys, with values of other types than their columns: star shares
    as fractions and texts, counts and flags as texts, a single rank without its
    list.  With ``faults`` some products are no objects and every fifth file ends
    in the middle."""
    li = fixtures.raw_listings(spark, sf_dir)
    line = F.size("available_dimensions.size_name")
    order = F.regexp_extract("source_file", r"details_(\d+)_", 1).cast("long")
    five = F.col("rating_overview")["5"]
    share = F.when(line % 3 == 0, (five + 0.5).cast("string")).when(line % 3 == 1, F.concat(F.lit('"'), five, F.lit('"'))).otherwise(five.cast("string"))
    rest = F.to_json(F.col("rating_overview").dropFields("`5`"))
    stars = F.concat(F.lit('{"5": '), share, F.lit(", "), F.substring(rest, 2, 200))
    count = F.when(line % 2 == 0, F.concat(F.lit('"'), "variation_count", F.lit('"'))).otherwise(F.col("variation_count").cast("string"))
    rank = F.when(line == 1, F.to_json(F.struct(F.get("best_seller_rank", F.lit(0)).alias("best_seller_rank")))).otherwise(F.to_json(F.struct("best_seller_rank")))
    plain = [c for c in li.columns if c not in ("rating_overview", "variation_count", "best_seller_rank", "is_fba", "marketplace", "source_extracted_at", "ingested_at", "source_file")]
    body = F.to_json(F.struct(*plain, F.col("is_fba").cast("string").alias("is_fba")))
    year = F.substring("ingested_at", 1, 4)
    # the JSON texts are rendered once and then taken apart
    rendered = li.select(
        F.concat(year, F.lit("-01-01")).alias("d"), F.floor(order / 4096).alias("file"), "marketplace",
        F.concat(year, F.lit("-01-01T00:00:00")).alias("extracted_at"), line.alias("line"), order.alias("order"),
        body.alias("body"), rank.alias("rank"), count.alias("count"), F.coalesce(F.concat(F.lit(', "rating_overview": '), stars), F.lit("")).alias("stars"),
    )
    text = F.concat(
        F.substring("body", F.lit(1), F.length("body") - 1), F.lit(', "variation_count": '), F.col("count"), F.lit(", "),
        F.substring("rank", F.lit(2), F.length("rank") - 2), F.col("stars"), F.lit("}"),
    )
    rows = rendered.select("d", "file", "marketplace", "extracted_at", text.alias("p"), "line", "order")
    if faults:
        rows = rows.withColumn("p", F.when((F.col("line") == 7) & (F.col("order") % 5 == 0), F.concat(F.lit('"gone '), "order", F.lit('"'))).otherwise(F.col("p")))
        rows = rows.withColumn("cut", (F.col("file") + F.col("d").substr(1, 4).cast("int")) % 5 == 4)
    else:
        rows = rows.withColumn("cut", F.lit(False))
    raw.write_multi_line(rows, root, "details")


@register("ingest_details")
def q_ingest_details(spark, sf_dir):
    """SC-01..05, SC-08, PL-01: multi-line detail files with values of other
    types than their columns, decoded without losing a product."""
    root = shared_dir(spark, "raw")
    listing_files(spark, sf_dir, root, faults=False)
    rows, _ = raw.ingest(spark, root, "details", raw.LISTING_RECORD, raw.LISTING_LIFT, layout=RAW_FILES)
    flat = ("asin", "title", "brand", "category", "dimensions", "weight", "date_first_available", "parent_asin", "variation_count",
            "stock_status", "buybox_seller", "is_fba", "marketplace", "source_extracted_at", "ingested_at")
    return rows.select(
        *flat, *[F.col("rating_overview")[str(n)].alias(f"star{n}") for n in (5, 4, 3, 2, 1)],
        F.get("best_seller_rank", F.lit(0)).alias("first_rank"), F.size("best_seller_rank").alias("n_ranks"),
        F.size("available_dimensions.size_name").alias("n_sizes"), F.size("images").alias("n_images"),
        F.element_at("categories", -1)["name"].alias("leaf"), F.element_at("categories", -1)["level"].alias("depth"),
    )


@register("quarantine")
def q_quarantine(spark, sf_dir):
    """SC-07: detail files with products that are no objects and files that end
    in the middle, loaded and loaded again, then their first day once more: rows
    of the bronze and the quarantine table per day and reason, and what the load
    reports to have read."""
    lake = Lake(shared_dir(spark, "raw"), shared_dir(spark, "lake"), raw_layout=RAW_FILES)
    listing_files(spark, sf_dir, lake.raw_root, faults=True)
    only = ("product_details",)
    run_bronze(spark, lake, None, only)
    report = run_bronze(spark, lake, None, only)["product_details"]
    bronze, aside = (spark.read.parquet(lake.path("bronze", t)) for t in ("product_details", "_quarantine_product_details"))
    run_bronze(spark, lake, str(bronze.agg(F.min("ingested_at")).first()[0]), only)
    bronze, aside = (spark.read.parquet(lake.path("bronze", t)) for t in ("product_details", "_quarantine_product_details"))
    a = bronze.groupBy("ingested_at").count().select("ingested_at", F.lit(raw.KEPT).alias("reason"), F.col("count").alias("rows"))
    b = aside.groupBy("ingested_at", "reason").count().select("ingested_at", "reason", F.col("count").alias("rows"))
    read = spark.createDataFrame([(None, "read", report.source_rows)], "ingested_at date, reason string, rows long")
    return a.unionByName(b).unionByName(read)


@register("ingest_discovered")
def q_ingest_discovered(spark, sf_dir):
    """SC-06, SO-01: every event in files of three shapes without a declared
    schema: columns that only some files have, that are null everywhere, whole
    here and fractional or text there come out with merged types."""
    root = shared_dir(spark, "raw")
    e = fixtures.table(spark, sf_dir, "events").withColumn("shape", F.col("event_id") % 3)
    common = F.struct(F.col("event_id").alias("id"), F.lit(None).cast("string").alias("never"), F.floor("value").alias("amount"), F.col("user_id").alias("who"))
    shapes = (
        F.to_json(common, {"ignoreNullFields": "false"}),
        F.to_json(common.withField("amount", F.col("value")).withField("who", F.concat(F.lit("u"), F.col("user_id"))), {"ignoreNullFields": "false"}),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.array("event_type", F.lit("x")).alias("tags"))),
    )
    product = F.when(F.col("shape") == 0, shapes[0]).when(F.col("shape") == 1, shapes[1]).otherwise(shapes[2])
    line = F.concat(F.lit('{"metadata": {"shape": '), F.col("shape").cast("string"), F.lit('}, "products": ['), product, F.lit("]}"))
    e.select(F.date_format(F.trunc("ts", "MM"), "yyyy-MM-dd").alias("d"), line.alias("value"), "shape").repartition("d", "shape").select("d", "value").write.partitionBy("d").text(f"{root}/events")
    rows, _ = raw.ingest(spark, root, "events", None, {"shape": "shape"}, layout=RAW_FILES, multi_line=False)
    return rows.withColumn("tags", F.array_join("tags", "|")).drop("source_file")


@register("replace_partition_rerun")
def q_replace_partition_rerun(spark, sf_dir):
    """SK-02/07: silver cards written as day partitions with wrong and missing
    rows on the last day, which is then re-run twice; the re-read table is what
    one right run gives."""
    path = shared_dir(spark, "silver_cards")
    s = silver_cards(spark, sf_dir)
    newest = s.agg(F.max("ingested_at")).first()[0]
    wrong = (F.col("ingested_at") == F.lit(newest)) & (F.col("marketplace") == "US")
    missing = (F.col("ingested_at") == F.lit(newest)) & (F.col("marketplace") == "DE")
    tables.replace_partitions(s.where(~missing).withColumn("title", F.when(wrong, F.lit("wrong")).otherwise(F.col("title"))), path)
    tables.replace_partition(s.filter(F.col("ingested_at") == F.lit(newest)), path, newest)
    last = spark.read.parquet(path).agg(F.max("ingested_at")).first()[0]
    tables.replace_partition(s.filter(F.col("ingested_at") == F.lit(last)), path, last)
    return spark.read.parquet(path)


@register("day_reads")
def q_day_reads(spark, sf_dir):
    """SC-09..12, FL-01: the newest day of the stored silver cards, read as a
    partition, by a typed equality and by SQL on the folder, and the other days
    by a lazy scan."""
    path = shared_dir(spark, "silver_cards")
    tables.replace_partitions(silver_cards(spark, sf_dir), path, whole=True)
    table = tables.read_table(spark, path)
    day = str(table.agg(F.max("ingested_at")).first()[0])
    ways = {
        "partition": tables.read_table(spark, path, ("ingested_at", day)),
        "equality": views.on_day(table, day),
        "sql": views.path_scan(spark, path, f"ingested_at = DATE '{day}'"),
        "rest": table.where(F.col("ingested_at") < F.lit(day).cast("date")),
    }
    out = None
    for way, rows in ways.items():
        rows = rows.select(F.lit(way).alias("way"), *table.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


@register("write_appends")
def q_write_appends(spark, sf_dir):
    """SK-01: the rows of two whole-table appends and of the overwrite that
    follows, each read back when it was written."""
    path = shared_dir(spark, "appends")
    s = materialize(spark, silver_cards(spark, sf_dir))
    for _ in range(2):
        tables.write_table(s, path, "append", partition_by=["ingested_at"])
    appended = materialize(spark, spark.read.parquet(path))
    tables.write_table(s.where("marketplace = 'DE'"), path, "overwrite", partition_by=["ingested_at"])
    last = spark.read.parquet(path)
    return appended.select(F.lit("appended").alias("step"), *s.columns).unionByName(last.select(F.lit("overwritten").alias("step"), *s.columns))


@register("write_reports")
def q_write_reports(spark, sf_dir):
    """SK-01, SK-02, SK-06, SK-07: what each kind of write of the silver cards
    reports, in the order written."""
    path = shared_dir(spark, "reports")
    s = materialize(spark, silver_cards(spark, sf_dir))
    day = s.agg(F.max("ingested_at")).first()[0]
    only = s.where(F.col("ingested_at") == F.lit(day))
    done = [tables.write_table(df, path, mode, partition_by=["ingested_at"]) for df, mode in (
        (s, "append"), (s.limit(0), "append"), (s, "ignore"), (s.where("marketplace = 'US'"), "overwrite"), (s.limit(0), "overwrite"),
    )]
    done += [tables.replace_partition(only, path, day), tables.replace_partition(only.limit(0), path, day), tables.replace_partitions(s, path)]
    stored = spark.read.parquet(path).count()
    rows = [(i, r.mode, r.rows, r.n_columns, r.skipped, stored) for i, r in enumerate(done)]
    return spark.createDataFrame(rows, "step int, mode string, rows long, n_columns int, skipped boolean, stored_rows long")


@register("write_modes")
def q_write_modes(spark, sf_dir):
    """SK-01/06/07: two appends, a partitioned overwrite with fewer rows, an
    ignored write and an empty append leave the overwrite's rows."""
    path = shared_dir(spark, "modes")
    s = materialize(spark, silver_cards(spark, sf_dir))
    us = s.filter(F.col("marketplace") == "US")
    for df, mode in ((s, "append"), (s, "append"), (us, "overwrite"), (s, "ignore"), (s.limit(0), "append"), (s.limit(0), "overwrite")):
        tables.write_table(df, path, mode, partition_by=["ingested_at"])
    return spark.read.parquet(path)


@register("bronze_stream_roundtrip")
def q_bronze_stream_roundtrip(spark, sf_dir):
    """Streaming PL-01: the same envelopes ingested by the Structured Streaming
    file source into a bronze Parquet table (exactly-once file sink)."""
    root, bronze, ckpt = shared_dir(spark, "raw"), shared_dir(spark, "bronze"), shared_dir(spark, "stream-ckpt")
    raw.write_card_envelopes(fixtures.raw_cards(spark, sf_dir), root)
    stream = start_bronze_stream(
        spark, root, "search", raw.CARD_RECORD, raw.CARD_LIFT, bronze, ckpt, layout="{root}/{source}/d={date}", multi_line=False
    )
    stream.awaitTermination()
    return spark.read.parquet(bronze).drop("source_file")
