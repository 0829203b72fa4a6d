"""Query layer (QL-01..05): named SQL views over the gold tables and the
parameterised BI queries that run on them through ``spark.sql``.

Views are lazy: a query on a view is planned together with the table scan, so
its filters reach the Parquet reader (partition pruning on ``ingested_at``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators.dimension import current_view
from shelfscope.sinks import tables


@dataclass(frozen=True)
class ViewDef:
    name: str
    description: str
    current_only: bool = False


# The six served views and their grains.
VIEWS = (
    ViewDef("dim_product", "Current product dimension (SCD2): one row per active (asin, marketplace); change hash hidden.", True),
    ViewDef("fact_search_ranking", "One row per (asin, keyword, marketplace, ingested_at): card price, rating, badges, coupon."),
    ViewDef("fact_price_snapshot", "One row per (asin, marketplace, ingested_at): min/max/avg/latest price and coupon."),
    ViewDef("fact_product_performance", "One row per (asin, marketplace, ingested_at): rank, rating breakdown, stock, FBA."),
    ViewDef("mart_keyword_daily", "One row per (keyword, marketplace, ingested_at): product count, badge shares, price stats."),
    ViewDef("mart_brand_competitive", "One row per (brand, category_leaf, marketplace, ingested_at): brand benchmarks."),
)


def _frame(spark: SparkSession, src: DataFrame | str, scd2: bool = False) -> DataFrame:
    if not isinstance(src, str):
        return src
    return tables.read_dimension(spark, src) if scd2 else spark.read.parquet(src)


def register_views(spark: SparkSession, sources: dict[str, DataFrame | str]) -> list[str]:
    """QL-01/02: create or replace every view whose table is given (a
    DataFrame or a table path).  Idempotent; returns the created names."""
    created = []
    for v in VIEWS:
        if v.name not in sources:
            continue
        df = _frame(spark, sources[v.name], scd2=v.current_only)
        if v.current_only:
            df = current_view(df)
        df.createOrReplaceTempView(v.name)
        created.append(v.name)
    return created


def list_views(spark: SparkSession) -> list[str]:
    """QL-03: names of the session's temporary views, sorted."""
    return sorted(t.name for t in spark.catalog.listTables() if t.isTemporary)


def describe_views() -> list[ViewDef]:
    return list(VIEWS)


def missing_views(spark: SparkSession) -> list[str]:
    """QL-03 / SO-02: expected view names minus the visible ones."""
    visible = set(list_views(spark))
    return [v.name for v in VIEWS if v.name not in visible]


LATEST_DAY = "(SELECT max(ingested_at) FROM {table})"


def keyword_daily_on(spark: SparkSession, day: str | None = None, k: int = 50) -> DataFrame:
    """QL-04 / SL-02: the day's keywords by product count (top ``k``).
    ``day=None`` means the latest loaded day."""
    where = "ingested_at = CAST(:day AS DATE)" if day else f"ingested_at = {LATEST_DAY.format(table='mart_keyword_daily')}"
    q = f"""
        SELECT keyword, marketplace, total_products, avg_price, sponsored_pct
        FROM mart_keyword_daily
        WHERE {where}
        ORDER BY total_products DESC, keyword, marketplace
        LIMIT {int(k)}
    """
    return spark.sql(q, args={"day": day}) if day else spark.sql(q)


def price_lookup(spark: SparkSession, marketplace: str, day: str | None = None) -> DataFrame:
    """QL-05: one day's canonical prices in a marketplace, with the brand from
    the product dimension (the snapshot fact itself has no brand)."""
    where = "p.ingested_at = CAST(:day AS DATE)" if day else f"p.ingested_at = {LATEST_DAY.format(table='fact_price_snapshot')}"
    q = f"""
        SELECT p.asin, d.brand, p.avg_price, p.min_price
        FROM fact_price_snapshot p
        LEFT JOIN dim_product d ON p.product_sk = d.product_sk
        WHERE {where} AND p.marketplace = :mkt
    """
    args = {"mkt": marketplace}
    if day:
        args["day"] = day
    return spark.sql(q, args=args)


def path_scan(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """SC-12: query a table folder directly in SQL without registering it."""
    q = f"SELECT * FROM parquet.`{path}`" + (f" WHERE {where}" if where else "")
    return spark.sql(q)


def on_day(df: DataFrame, day: str, col: str = "ingested_at") -> DataFrame:
    """FL-01: partition equality with a typed DATE literal (keeps pruning)."""
    return df.filter(F.col(col) == F.lit(day).cast("date"))
