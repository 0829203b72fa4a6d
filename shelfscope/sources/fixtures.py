"""Adapters from the driver's TPC-H-style tables to the two raw record shapes
the pipeline ingests (search-result cards and product-detail listings).

They are whole-table projections (no sampling, no id subsets), so every
downstream query grows with the input tables.  ``duckdb_oracle`` holds the
same expressions in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_DAY = "yyyy-MM-dd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as its files lie: the same plan at every size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _asin(key) -> F.Column:
    return F.concat(F.lit("B"), F.lpad(key.cast("string"), 9, "0"))


def _marketplace(key) -> F.Column:
    m = key % 3
    return F.when(m == 0, "US").when(m == 1, "DE").otherwise("VN")


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-result cards (bronze shape: all text fields as scraped)."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")
    u, eid = F.col("user_id"), F.col("event_id")
    e = e.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    k = F.col("k")
    asin = _asin(u)
    fmt = F.format_number(F.col("value") * 100, 2)
    r = 10 + k % 41
    return e.select(
        asin.alias("asin"),
        F.concat(F.lit(" Item "), u.cast("string"), F.lit(" for "), F.col("event_type"), F.lit(" ")).alias("title"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(u % 3 == 2, F.concat(F.lit("VND "), fmt))
        .otherwise(F.concat(F.lit("$"), fmt))
        .alias("price"),
        F.when(k % 3 == 0, F.concat(F.lit("$"), F.format_number(F.col("value") * 125, 2))).alias("original_price"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat((r / 10).cast("int").cast("string"), F.lit("."), (r % 10).cast("string"), F.lit(" out of 5 stars")))
        .alias("rating"),
        F.when(k % 10 == 5, F.concat(F.lit("("), k.cast("string"), F.lit(","), F.lpad((eid % 1000).cast("string"), 3, "0"), F.lit(")")))
        .when(k % 2 == 0, F.concat(F.lit("("), k.cast("string"), F.lit("."), (eid % 10).cast("string"), F.lit("K)")))
        .otherwise(F.concat(F.lit("("), k.cast("string"), F.lit(")")))
        .alias("ratings_count"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.concat(k.cast("string"), F.lit("K+ bought in past month")))
        .otherwise(F.concat(k.cast("string"), F.lit("00+ bought in past month")))
        .alias("monthly_sales"),
        F.when(k % 7 == 0, F.concat(F.lit("Save "), (5 + k % 20).cast("string"), F.lit("%with coupon")))
        .when(k % 7 == 1, F.lit("Coupon available"))
        .alias("coupon"),
        F.when(k % 2 == 0, F.lit("FREE delivery")).alias("delivery"),
        F.concat(F.lit("https://shop.example/dp/"), asin).alias("url"),
        F.concat(F.lit("https://img.example/"), asin, F.lit(".jpg")).alias("image_url"),
        (eid % 5 == 0).alias("is_sponsored"),
        (u % 2 == 0).alias("is_prime"),
        (k % 17 == 0).alias("is_best_seller"),
        (k % 19 == 0).alias("is_amazons_choice"),
        F.col("event_type").alias("keyword"),
        _marketplace(u).alias("marketplace"),
        F.date_format("ts", ISO_TS).alias("source_extracted_at"),
        F.date_format("ts", ISO_DAY).alias("ingested_at"),
        F.concat(F.lit("search_"), F.col("event_type"), F.lit("_"), F.date_format("ts", ISO_DAY), F.lit(".json")).alias("source_file"),
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-detail listings (bronze shape) from lineitem x part.

    Columns that depend only on the part (identity, names, breadcrumbs,
    image URLs) are built once per part row and joined, not once per line.
    Lines and parts are dealt by asin, the listings' own key, so that readers who
    group by it need not deal the rendered rows again; keys longer than an asin
    holds are told apart by the range condition.
    """
    pk = F.col("p_partkey")
    asin = _asin(pk)
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_type",
        "p_name",
        "p_size",
        asin.alias("asin"),
        _marketplace(pk).alias("marketplace"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("title"),
        F.when(pk % 23 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Brand: "), F.col("p_brand"))).alias("brand"),
        F.concat(F.lit("P"), F.lpad((pk / 10).cast("long").cast("string"), 9, "0")).alias("parent_asin"),
        F.array_repeat(F.lit("C"), F.col("p_size") % 4 + 1).alias("_colors"),
        F.transform(
            F.split(F.col("p_name"), " "),
            lambda w, i: F.struct(w.alias("name"), F.concat(F.lit("/c/"), w).alias("url"), (i + 1).cast("long").alias("level")),
        ).alias("categories"),
        # image urls _2.._5; a line shows the first (line % 5) of them
        F.array(*[F.concat(F.lit("https://img.example/"), asin, F.lit(f"_{i}.jpg")) for i in range(2, 6)]).alias("_imgs"),
    )
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("_asin", _asin(F.col("l_partkey")))
    j = li.join(parts, (li._asin == parts.asin) & li.l_partkey.between(parts.p_partkey, parts.p_partkey))
    ln = F.col("l_linenumber")
    first_rank = F.concat(F.lit("#"), F.format_number(F.col("l_orderkey"), 0), F.lit(" in "), F.col("p_type"))
    second_rank = F.concat(F.lit("#"), ln.cast("string"), F.lit(" in"), F.col("p_name"))
    extracted = F.expr("timestampadd(SECOND, l_orderkey % 86400, l_shipdate)")
    return j.select(
        "asin",
        "title",
        "brand",
        F.col("p_type").alias("category"),
        F.lit("n/a").alias("description"),
        F.when(ln == 7, F.array(first_rank, F.lit(None).cast("string")))
        .when(ln > 1, F.array(first_rank, second_rank))
        .otherwise(F.array(first_rank))
        .alias("best_seller_rank"),
        F.when(ln == 7, F.lit("n/a"))
        .when(ln % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit(" x "), ln.cast("string"), F.lit(" inches")))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5 x "), ln.cast("string"), F.lit(" x 3.31 inches")))
        .alias("dimensions"),
        F.when(ln == 6, F.lit("heavy")).otherwise(F.concat(F.col("l_quantity").cast("string"), F.lit(" ounces"))).alias("weight"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("unknown"))
        .when(ln % 3 == 0, F.date_format("l_shipdate", "MMMM d, yyyy"))
        .when(ln % 3 == 1, F.date_format("l_shipdate", "MMM d, yyyy"))
        .otherwise(F.date_format("l_shipdate", ISO_DAY))
        .alias("date_first_available"),
        "parent_asin",
        F.when(ln > 5, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("variation_count"),
        F.struct(F.array_repeat(F.lit("S"), ln).alias("size_name"), F.col("_colors").alias("color_name")).alias("available_dimensions"),
        F.slice("_imgs", 1, ln % 5).alias("images"),
        F.when(ln == 7, F.lit(None))
        .otherwise(
            F.struct(
                F.col("l_quantity").cast("int").alias("5"),
                F.lit(20).alias("4"),
                ln.alias("3"),
                F.lit(None).cast("int").alias("2"),
                F.lit(3).alias("1"),
            )
        )
        .alias("rating_overview"),
        F.when(F.col("l_linestatus") == "O", F.lit("In Stock")).otherwise(F.lit("Out of Stock")).alias("stock_status"),
        F.concat(F.lit("Seller#"), F.col("l_suppkey").cast("string")).alias("buybox_seller"),
        (F.col("l_returnflag") == "A").alias("is_fba"),
        "categories",
        "marketplace",
        F.date_format(extracted, ISO_TS).alias("source_extracted_at"),
        F.date_format("l_shipdate", ISO_DAY).alias("ingested_at"),
        F.concat(F.lit("details_"), F.col("l_orderkey").cast("string"), F.lit("_"), ln.cast("string"), F.lit(".json")).alias("source_file"),
    )


def customer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second history input: one snapshot per (customer, order day) with two
    tracked attributes.  Used to show the SCD2 operators are key-generic."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("snapshot_date")
    ).agg(
        F.max("o_orderpriority").alias("priority"),
        F.max("o_orderstatus").alias("status"),
    )
