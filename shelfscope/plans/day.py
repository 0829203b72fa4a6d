"""PL-01..10: the lakehouse jobs in dependency order.

``run_day`` loads one day: raw -> bronze -> silver -> dimension -> facts ->
marts, each step reading only its day partition and replacing only its day
partition, so any step can be re-run.  ``rebuild`` processes a whole history
in one pass per table (window-based SCD2, as-of fact keys), which is the
scalable way to backfill: one job per table instead of one job per day.

Silver and gold tables belong to a *generation* of the lake.  Day runs replace
day partitions of the current generation; a rebuild writes all tables into a new
one and then commits it by appending its manifest (the days and rows of every
table).  Until then readers see the old generation whole, and after it nothing
of it: days that the rebuild no longer produces are gone in the same commit, and
a rebuild that was cut off has changed nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators import clean, dimension, facts, marts
from shelfscope.schemas import assert_schema
from shelfscope.session import apply_defaults, freed_shuffles, shared_dir
from shelfscope.sinks import tables
from shelfscope.sources import raw


@dataclass(frozen=True)
class Lake:
    """Where raw files and the layered tables live."""

    raw_root: str
    root: str
    raw_layout: str = "{root}/{source}/{date}"
    raw_multi_line: bool = True
    # "replace": a re-run replaces the day (idempotent); "append": every run adds
    # its rows and the silver dedup removes the repeats.
    bronze_mode: str = "replace"
    # Generation of the silver and gold tables; None until ``at`` looks it up.
    generation: int | None = None

    @property
    def manifest(self) -> str:
        return f"{self.root.rstrip('/')}/manifest"

    def path(self, layer: str, name: str) -> str:
        inside = f"gen={self.generation}/" if self.generation and layer != "bronze" else ""
        return f"{self.root.rstrip('/')}/{inside}{layer}/{name}"

    def at(self, spark: SparkSession) -> Lake:
        """This lake at its newest committed generation (0 before the first
        rebuild)."""
        if self.generation is not None:
            return self
        newest = read_manifest(spark, self).agg(F.max("generation")).first()[0]
        return replace(self, generation=newest or 0)


MANIFEST = "generation long, layer string, name string, day date, rows long"


def read_manifest(spark: SparkSession, lake: Lake) -> DataFrame:
    """Days and rows of every table, per rebuild."""
    if not tables.table_exists(spark, lake.manifest):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(lake.manifest)


SOURCES = {
    "search_results": ("search", raw.CARD_RECORD, raw.CARD_LIFT),
    "product_details": ("details", raw.LISTING_RECORD, raw.LISTING_LIFT),
}


def run_bronze(spark: SparkSession, lake: Lake, day: str | None, sources: tuple[str, ...] = tuple(SOURCES)) -> dict:
    """PL-01: the raw sources of ``day`` -> bronze partitions, and quarantine
    partitions for what cannot be a record.  ``day`` None loads all days there
    are, as the whole tables.

    The raw files are read once into tagged rows, of which each table's days
    are then replaced, so a rerun repeats neither; a day without bad texts has no
    quarantine partition.  The report's ``source_rows`` counts both sides.
    """
    out = {}
    for table in sources:
        source, record, lift = SOURCES[table]
        texts = raw.read_texts(spark, lake.raw_root, source, day, lake.raw_layout, lake.raw_multi_line)
        staged = shared_dir(spark, f"ingest-{table}")
        with freed_shuffles(spark):
            raw.tagged(texts, record, lift, day).write.parquet(staged)
        rows = spark.read.parquet(staged).withColumn("ingested_at", F.col("ingested_at").cast("date"))
        found = {r[raw.STATUS]: r["count"] for r in rows.groupBy(raw.STATUS).count().collect()}  # two rows
        path, aside = lake.path("bronze", table), lake.path("bronze", f"_quarantine_{table}")

        def put(part: DataFrame, to: str):
            return tables.replace_partition(part, to, day) if day else tables.replace_partitions(part, to, whole=True)

        if lake.bronze_mode == "append":
            out[table] = tables.write_table(raw.kept(rows), path, mode="append", partition_by=["ingested_at"])
        else:
            out[table] = put(raw.kept(rows), path)
        if found.get(raw.QUARANTINED):
            put(raw.quarantined(rows), aside)
        else:
            tables.delete_folder(spark, f"{aside}/ingested_at={day}" if day else aside)
        out[table].source_rows = sum(found.values())
        tables.delete_folder(spark, staged)
    return out


def run_silver(spark: SparkSession, lake: Lake, day: str) -> dict:
    """PL-02/03: bronze day -> typed, deduplicated silver day."""
    lake = lake.at(spark)
    out = {}
    for table, job in (("search_results", clean.clean_cards), ("product_details", clean.clean_listings)):
        src = lake.path("bronze", table)
        if not tables.table_exists(spark, src):
            continue
        bronze = tables.read_table(spark, src, ("ingested_at", day)).withColumn("ingested_at", F.lit(day))
        source = Observation()  # bronze rows, counted inside the write job
        silver = assert_schema(job(bronze.observe(source, F.count(F.lit(1)).alias("rows"))), f"silver/{table}")
        report = tables.replace_partition(silver, lake.path("silver", table), day)
        report.source_rows = int(source.get.get("rows", 0))
        out[table] = report
    return out


def run_dim(spark: SparkSession, lake: Lake, day: str) -> dict:
    """PL-04: the day's listings -> SCD2 product dimension."""
    lake = lake.at(spark)
    src = lake.path("silver", "product_details")
    if not tables.table_exists(spark, src):
        return {"skipped": True}
    snaps = dimension.product_snapshots(tables.read_table(spark, src, ("ingested_at", day)))
    incoming = dimension.shape_incoming(snaps, day).withColumn("gold_processed_at", F.current_timestamp())
    report = tables.scd2_load_day(spark, lake.path("gold", "dim_product"), incoming, day)
    assert_schema(tables.read_dimension(spark, lake.path("gold", "dim_product")), "gold/dim_product")
    return report


def _dim(spark: SparkSession, lake: Lake) -> DataFrame | None:
    p = lake.path("gold", "dim_product")
    return tables.read_dimension(spark, p) if tables.dim_state(spark, p) else None


def run_facts(spark: SparkSession, lake: Lake, day: str) -> dict:
    """PL-05..07: silver day + current dimension -> fact partitions."""
    lake = lake.at(spark)
    dim = _dim(spark, lake)
    out = {}
    cards_p, listings_p = lake.path("silver", "search_results"), lake.path("silver", "product_details")
    if tables.table_exists(spark, cards_p):
        cards = tables.read_table(spark, cards_p, ("ingested_at", day))
        ranking = facts.fact_search_ranking(cards, dim)
        price = facts.fact_price_snapshot(cards, dim)
        out["fact_search_ranking"] = tables.replace_partition(
            assert_schema(ranking, "gold/fact_search_ranking"), lake.path("gold", "fact_search_ranking"), day
        )
        out["fact_price_snapshot"] = tables.replace_partition(
            assert_schema(price, "gold/fact_price_snapshot"), lake.path("gold", "fact_price_snapshot"), day
        )
    if tables.table_exists(spark, listings_p):
        listings = tables.read_table(spark, listings_p, ("ingested_at", day))
        perf = facts.fact_product_performance(listings, dim)
        out["fact_product_performance"] = tables.replace_partition(
            assert_schema(perf, "gold/fact_product_performance"), lake.path("gold", "fact_product_performance"), day
        )
    return out


def run_marts(spark: SparkSession, lake: Lake, day: str) -> dict:
    """PL-08/09: fact day -> mart partitions."""
    lake = lake.at(spark)
    out = {}
    rank_p, perf_p = lake.path("gold", "fact_search_ranking"), lake.path("gold", "fact_product_performance")
    if tables.table_exists(spark, rank_p):
        ranking = tables.read_table(spark, rank_p, ("ingested_at", day))
        mart = assert_schema(marts.keyword_daily(ranking), "gold/mart_keyword_daily")
        out["mart_keyword_daily"] = tables.replace_partition(mart, lake.path("gold", "mart_keyword_daily"), day)
    dim = _dim(spark, lake)
    if tables.table_exists(spark, perf_p) and dim is not None:
        perf = tables.read_table(spark, perf_p, ("ingested_at", day))
        brand = assert_schema(marts.brand_competitive(perf, dim), "gold/mart_brand_competitive")
        out["mart_brand_competitive"] = tables.replace_partition(brand, lake.path("gold", "mart_brand_competitive"), day)
    return out


def run_day(spark: SparkSession, lake: Lake, day: str, bronze: bool = True) -> dict:
    """PL-10: one day through every layer, dimension before facts before marts."""
    apply_defaults(spark)
    lake = lake.at(spark)
    report = {}
    if bronze:
        report["bronze"] = run_bronze(spark, lake, day)
    report["silver"] = run_silver(spark, lake, day)
    report["dim"] = run_dim(spark, lake, day)
    report["facts"] = run_facts(spark, lake, day)
    report["marts"] = run_marts(spark, lake, day)
    return report


def days(start: str, end: str) -> list[str]:
    a, b = date.fromisoformat(start), date.fromisoformat(end)
    return [(a + timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def run_range(spark: SparkSession, lake: Lake, start: str, end: str, bronze: bool = True) -> list[dict]:
    """PL-10: days in date order (a backfill older than the dimension is refused;
    use ``rebuild`` for history)."""
    return [run_day(spark, lake, d, bronze) for d in days(start, end)]


DAY_TABLES = {
    "silver": ("search_results", "product_details"),
    "gold": ("fact_search_ranking", "fact_price_snapshot", "fact_product_performance", "mart_keyword_daily", "mart_brand_competitive"),
}


def stored_days(spark: SparkSession, lake: Lake) -> DataFrame:
    """(layer, name, day, rows) of every day table as it lies."""
    out = spark.createDataFrame([], "layer string, name string, day date, rows long")
    for layer, names in DAY_TABLES.items():
        for name in names:
            if tables.table_exists(spark, lake.path(layer, name)):
                t = spark.read.parquet(lake.path(layer, name)).groupBy(F.col("ingested_at").cast("date").alias("day")).count()
                out = out.unionByName(t.select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), "day", F.col("count").alias("rows")))
    return out


def rebuild(spark: SparkSession, lake: Lake) -> dict:
    """Whole-history load from bronze in one job per table: silver for every
    day, the dimension by ``scd2_rebuild``, facts keyed as-of their day, marts
    joined to the version each fact holds.  Same tables as ``run_range``.

    All tables are written into a new generation and committed together with
    their manifest.  The report holds a write report per table, the generation,
    and ``retired``: the (layer, table, day) that the old generation had and
    the new one has not.
    """
    apply_defaults(spark)
    old = lake.at(spark)
    new = replace(old, generation=old.generation + 1)
    out = {}

    def write(df: DataFrame, layer: str, name: str):
        out[name] = tables.replace_partitions(assert_schema(df, f"{layer}/{name}"), new.path(layer, name), whole=True)
        return spark.read.schema(df.schema).parquet(new.path(layer, name))

    cards = write(clean.clean_cards(spark.read.parquet(new.path("bronze", "search_results"))), "silver", "search_results")
    listings = write(clean.clean_listings(spark.read.parquet(new.path("bronze", "product_details"))), "silver", "product_details")
    dim = dimension.scd2_rebuild(dimension.product_snapshots(listings)).withColumn("gold_processed_at", F.current_timestamp())
    last = listings.agg(F.max("ingested_at")).first()[0]
    dim_path = new.path("gold", "dim_product")
    tables.write_dimension(assert_schema(dim, "gold/dim_product"), dim_path, last, dimension.derived_columns())
    dim = tables.read_dimension(spark, dim_path)
    ranking = write(facts.fact_search_ranking(cards, dim, lookup="asof"), "gold", "fact_search_ranking")
    write(facts.fact_price_snapshot(cards, dim, lookup="asof"), "gold", "fact_price_snapshot")
    perf = write(facts.fact_product_performance(listings, dim, lookup="asof"), "gold", "fact_product_performance")
    write(marts.keyword_daily(ranking), "gold", "mart_keyword_daily")
    write(marts.brand_competitive(perf, dim, versions="all"), "gold", "mart_brand_competitive")

    had = stored_days(spark, old)
    rows = stored_days(spark, new).withColumn("generation", F.lit(new.generation).cast("long"))
    rows.select("generation", "layer", "name", "day", "rows").coalesce(1).write.mode("append").parquet(lake.manifest)
    produced = read_manifest(spark, lake).where(F.col("generation") == new.generation)
    gone = had.join(produced, ["layer", "name", "day"], "left_anti").select("layer", "name", "day").collect()  # tables x days
    out["generation"] = new.generation
    out["retired"] = sorted((r["layer"], r["name"], str(r["day"])) for r in gone)
    return out


def vacuum(spark: SparkSession, lake: Lake) -> list[str]:
    """Delete the silver and gold tables of generations before the current one
    and what cut-off rebuilds left.  Returns the deleted folders."""
    now = lake.at(spark)
    root = lake.root.rstrip("/")
    keep = f"gen={now.generation}"
    gone = [f"{root}/{x}" for x in tables.folders(spark, root) if (x.startswith("gen=") and x != keep) or (now.generation and x in DAY_TABLES)]
    for folder in gone:
        tables.delete_folder(spark, folder)
    return gone + [x for x in tables.vacuum_dimension(spark, now.path("gold", "dim_product"))]
