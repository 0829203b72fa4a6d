"""Sources, sinks, the day pipeline and the streaming ingest (SC-*, SK-*,
PL-01..10) on temporary folders."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shelfscope.operators import clean
from shelfscope.plans import day as plans
from shelfscope.plans import views
from shelfscope.plans.queries import silver_cards
from shelfscope.sinks import tables
from shelfscope.sources import fixtures, raw
from shelfscope.streaming.ingest import read_ingested, start_bronze_stream, start_ingest_stream
from tests.conftest import SMALL


def _cards(spark):
    return fixtures.raw_cards(spark, SMALL)


def test_raw_ingest_quarantine_and_empty(spark, tmpdir_path):
    root = tmpdir_path
    cards = _cards(spark)
    raw.write_card_envelopes(cards, root)
    day = cards.agg(F.min("ingested_at")).first()[0]
    bad_dir = f"{root}/search/d={day}"
    with open(os.path.join(bad_dir, "truncated.json"), "w") as fh:
        fh.write('{"metadata": {"keyword": "view", "mark')
    rows, bad = raw.ingest(spark, root, "search", raw.CARD_RECORD, raw.CARD_LIFT, run_date=day,
                           layout="{root}/{source}/d={date}", multi_line=False)
    assert rows.count() == cards.filter(F.col("ingested_at") == day).count()
    assert bad.count() == 1 and bad.first().source_file.endswith("truncated.json")
    assert set(rows.columns) >= {"asin", "keyword", "marketplace", "source_extracted_at", "ingested_at", "source_file"}
    empty, _ = raw.ingest(spark, root, "nosuchsource", raw.CARD_RECORD, raw.CARD_LIFT, run_date=day)
    assert empty.count() == 0


def test_multiline_envelope(spark, tmpdir_path):
    d = f"{tmpdir_path}/details/2026-03-04"
    os.makedirs(d)
    with open(f"{d}/details_US_1.json", "w") as fh:
        fh.write(
            '{\n "metadata": {"type": "details", "marketplace": "US", "total_products": 1, "extracted_at": "2026-03-04T11:21:36"},\n'
            ' "products": [{"asin": "B0TEST", "brand": "Brand: RUMIA", "weight": "14.25 ounces",\n'
            '   "rating_overview": {"5": 76, "4": 13, "3": 6, "2": 2, "1": 3}, "stock_status": "In Stock",\n'
            '   "best_seller_rank": ["#364 in Clothing, Shoes & Jewelry", "#1 inWomen\'s Fashion Sweatshirts"],\n'
            '   "dimensions": "12.68 x 10.91 x 3.31 inches", "date_first_available": "August 28, 2025",\n'
            '   "categories": [{"name": "Clothing"}, {"name": "Fashion Sweatshirts"}], "images": ["a", "b"]}]\n}\n'
        )
    rows, bad = raw.ingest(spark, tmpdir_path, "details", raw.LISTING_RECORD, raw.LISTING_LIFT, run_date="2026-03-04")
    assert bad.count() == 0
    s = clean.clean_listings(rows, audit_col=None).first()
    assert (s.brand, s.weight_value, s.rating_weighted_avg, s.category_leaf, s.image_count) == ("RUMIA", 14.25, 4.57, "Fashion Sweatshirts", 2)
    assert [tuple(x) for x in s.best_seller_ranks] == [(364, "Clothing, Shoes & Jewelry"), (1, "Women's Fashion Sweatshirts")]
    assert str(s.date_first_available) == "2025-08-28" and s.in_stock is True


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)


def test_wrong_typed_values_cost_neither_record_nor_envelope(spark, tmpdir_path):
    _write(f"{tmpdir_path}/details/2026-03-04", {
        "a.json": '{"metadata": {"marketplace": "US", "extracted_at": "2026-03-04T11:21:36"}, "products": [\n'
        ' {"asin": "A1", "rating_overview": {"5": 76.5, "4": "13", "3": null, "2": "x", "1": 3}, "variation_count": "2.0", "is_fba": "true"},\n'
        ' {"asin": 12, "best_seller_rank": "#1 in Shoes", "images": ["u", null, 3], "variation_count": 2.5, "weight": {"v": 1}, "categories": {"name": "One", "level": "4"}},\n'
        ' 7, null, "text", {"asin": "A3", "rating_overview": "none", "categories": [{"name": "N", "level": 1.0}, "loose"], "is_fba": 3, "new_field": 1}]}',
        "b.json": '{"metadata": ["odd"], "products": [{"asin": "A4"}]}',
        "c.json": '{"metadata": {"marketplace": "US"}, "products": {"asin": "A5"}}',
        "d.json": '{"metadata": {"marketplace": "US"}, "products": [{"asin": "A6"}, {"asin": "A7"',
    })
    rows, bad = raw.ingest(spark, tmpdir_path, "details", raw.LISTING_RECORD, raw.LISTING_LIFT, "2026-03-04")
    got = {r.asin: r for r in rows.collect()}
    assert sorted(got) == ["12", "A1", "A3", "A4"]
    assert tuple(got["A1"].rating_overview) == (76.5, 13.0, None, None, 3.0) and got["A1"].variation_count == 2 and got["A1"].is_fba is True
    odd = got["12"]
    assert odd.best_seller_rank == ["#1 in Shoes"] and odd.images == ["u", None, "3"] and odd.variation_count is None and odd.weight == '{"v":1}'
    assert [tuple(c) for c in odd.categories] == [("One", None, 4)]
    assert got["A3"].rating_overview is None and [c and tuple(c) for c in got["A3"].categories] == [("N", None, 1), None]
    assert got["A4"].marketplace is None and got["A1"].marketplace == "US"
    lost = sorted((r.source_file, -1 if r.record is None else r.record, r.reason, r.raw_text) for r in bad.collect())
    assert [x[:3] for x in lost] == [
        ("a.json", 2, "not an object"), ("a.json", 3, "not an object"), ("a.json", 4, "not an object"), ("c.json", -1, "not json"), ("d.json", -1, "not json"),
    ]
    assert [x[3] for x in lost[:3]] == ["7", None, "text"] and lost[4][3].endswith('{"asin": "A7"')


def test_columns_are_discovered_over_all_files(spark, tmpdir_path):
    from pyspark.sql import types as T

    _write(f"{tmpdir_path}/s/2026-03-04", {
        "a.json": '{"metadata": {"m": "US"}, "products": [{"id": 1, "n": 1, "x": null, "t": 5, "f": true, "o": {"5": 1, "k": null}, "l": [1]}]}',
        "b.json": '{"metadata": {"m": "DE"}, "products": [{"id": 2, "n": 2.5, "t": "five", "o": {"5": 0.5}, "l": ["a"], "only": "b"}, 9]}',
        "c.json": "no json",
    })
    rows, bad = raw.ingest(spark, tmpdir_path, "s", None, {"market": "m"}, "2026-03-04")
    assert rows.drop("source_file", "ingested_at").schema.simpleString() == (
        "struct<f:boolean,id:bigint,l:array<string>,n:double,o:struct<5:double,k:string>,only:string,t:string,x:string,market:string>"
    )
    got = [(r.id, r.n, r.x, r.t, r.f, tuple(r.o), r.l, r.only, r.market) for r in rows.orderBy("id").collect()]
    assert got == [(1, 1.0, None, "5", True, (1.0, None), ["1"], None, "US"), (2, 2.5, None, "five", None, (0.5, None), ["a"], "b", "DE")]
    assert bad.count() == 2
    none = raw.discover(raw.read_texts(spark, tmpdir_path, "absent", "2026-03-04"))
    assert none == T.StructType([])
    assert raw.ingest(spark, tmpdir_path, "absent", None, {"market": "m"}, "2026-03-04")[0].count() == 0


def test_one_stream_keeps_and_quarantines(spark, tmpdir_path):
    root, path, ckpt = f"{tmpdir_path}/raw", f"{tmpdir_path}/t", f"{tmpdir_path}/ckpt"

    def run():
        start_ingest_stream(spark, root, "search", raw.CARD_RECORD, raw.CARD_LIFT, path, ckpt).awaitTermination(120)
        kept, bad = read_ingested(spark, path)
        return sorted(r.asin for r in kept.collect()), sorted((str(r.ingested_at), r.source_file, r.reason) for r in bad.collect())

    _write(f"{root}/search/2026-03-04", {"a.json": '{"metadata": {"keyword": "k"}, "products": [{"asin": "A"}, 3]}', "b.json": " "})
    first = (["A"], [("2026-03-04", "a.json", "not an object"), ("2026-03-04", "b.json", "blank")])
    assert run() == first and run() == first
    _write(f"{root}/search/2026-03-05", {"c.json": '{"products": [{"asin": "C"}]}', "d.json": "{"})
    assert run() == (["A", "C"], [*first[1], ("2026-03-05", "d.json", "not json")])


def test_replace_partition_guard_and_idempotence(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, d string").withColumn(
        "ingested_at", F.col("d").cast("date")
    ).drop("d")
    tables.replace_partitions(df, path)
    rep = tables.replace_partition(df.filter("k = 'a'"), path, "2024-01-01")
    rep = tables.replace_partition(df.filter("k = 'a'"), path, "2024-01-01")
    assert rep.rows == 1 and spark.read.parquet(path).count() == 2
    with pytest.raises(Exception):
        tables.replace_partition(df, path, "2024-01-01")  # a row of another day
    assert spark.read.parquet(path).count() == 2
    assert tables.replace_partition(df.limit(0), path, "2024-01-02").skipped
    assert spark.read.parquet(path).count() == 2


def test_write_modes_and_report(spark, tmpdir_path):
    path = f"{tmpdir_path}/w"
    df = spark.range(5).withColumnRenamed("id", "x")
    assert tables.write_table(df, path, "append").rows == 5
    assert tables.write_table(df, path, "append").rows == 5
    assert spark.read.parquet(path).count() == 10
    assert tables.write_table(df, path, "overwrite").rows == 5
    assert spark.read.parquet(path).count() == 5
    tables.write_table(df, path, "ignore")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        tables.write_table(df, path, "error")
    assert tables.write_table(df.limit(0), path, "append").skipped
    assert tables.table_exists(spark, path) and not tables.table_exists(spark, f"{tmpdir_path}/none")


def _write_listing_envelopes(spark, root, listings):
    rec = F.struct(*[F.col(f.name) for f in raw.LISTING_RECORD.fields if f.name in listings.columns])
    listings.select(
        F.struct(F.lit("details").alias("type"), "marketplace", F.lit(1).cast("long").alias("total_products"),
                 F.col("source_extracted_at").alias("extracted_at")).alias("metadata"),
        F.array(rec).alias("products"), F.col("ingested_at").alias("d"),
    ).write.mode("overwrite").partitionBy("d").json(f"{root}/details")


def test_day_pipeline_matches_batch(spark, tmpdir_path):
    raw_root, lake_root = f"{tmpdir_path}/raw", f"{tmpdir_path}/lake"
    cards = _cards(spark)
    d1, d2 = "2024-01-01", "2024-01-02"
    raw.write_card_envelopes(cards.filter(F.col("ingested_at").isin(d1, d2)), raw_root)
    listings = fixtures.raw_listings(spark, SMALL).withColumn("ingested_at", F.when(F.col("ingested_at") < "1998-01-01", d1).otherwise(d2))
    _write_listing_envelopes(spark, raw_root, listings)
    lake = plans.Lake(raw_root, lake_root, raw_layout="{root}/{source}/d={date}", raw_multi_line=False)
    plans.run_range(spark, lake, d1, d2)
    mart = spark.read.parquet(lake.path("gold", "mart_keyword_daily"))
    assert mart.select("ingested_at").distinct().count() == 2
    dim = tables.read_dimension(spark, lake.path("gold", "dim_product"))
    assert dim.filter("is_current").groupBy("asin", "marketplace").count().filter("count > 1").count() == 0
    # re-running a day changes nothing, also when bronze appends duplicates
    before = sorted(tuple(r) for r in mart.drop("gold_processed_at").collect())
    plans.run_day(spark, lake, d2)
    appending = plans.Lake(raw_root, lake_root, raw_layout=lake.raw_layout, raw_multi_line=False, bronze_mode="append")
    plans.run_day(spark, appending, d2)
    bronze_rows = spark.read.parquet(lake.path("bronze", "search_results")).filter(F.col("ingested_at") == d2).count()
    assert bronze_rows == 2 * cards.filter(F.col("ingested_at") == d2).count()
    after = sorted(tuple(r) for r in spark.read.parquet(lake.path("gold", "mart_keyword_daily")).drop("gold_processed_at").collect())
    assert before == after
    # views over the lake
    names = views.register_views(spark, {v.name: lake.path("gold", v.name) for v in views.VIEWS})
    assert names == [v.name for v in views.VIEWS] and views.missing_views(spark) == []
    assert [v.name for v in views.describe_views()] == names
    assert views.keyword_daily_on(spark, d2, 5).count() <= 5
    assert views.price_lookup(spark, "US", d1).count() > 0
    # whole-history rebuild gives the same marts
    lake2 = plans.Lake(raw_root, f"{tmpdir_path}/lake2")
    for t in ("search_results", "product_details"):
        spark.read.parquet(lake.path("bronze", t)).write.mode("overwrite").partitionBy("ingested_at").parquet(lake2.path("bronze", t))
    report = plans.rebuild(spark, lake2)
    assert report["generation"] == 1 and report["retired"] == []
    lake2 = lake2.at(spark)
    rebuilt = sorted(tuple(r) for r in spark.read.parquet(lake2.path("gold", "mart_keyword_daily")).drop("gold_processed_at").collect())
    assert rebuilt == after
    brand_day = sorted(tuple(r) for r in spark.read.parquet(lake.path("gold", "mart_brand_competitive")).drop("gold_processed_at").collect())
    brand_re = sorted(tuple(r) for r in spark.read.parquet(lake2.path("gold", "mart_brand_competitive")).drop("gold_processed_at").collect())
    assert brand_day == brand_re and len(brand_day) > 0
    # a rebuild of a lake that day runs made drops a day that bronze no longer has
    tables.delete_folder(spark, f"{lake.path('bronze', 'search_results')}/ingested_at={d1}")
    report = plans.rebuild(spark, lake)
    assert {r for r in report["retired"]} == {
        (layer, t, d1) for layer, t in (("silver", "search_results"), ("gold", "fact_search_ranking"), ("gold", "fact_price_snapshot"), ("gold", "mart_keyword_daily"))
    }
    now = lake.at(spark)
    assert now.generation == 1 and [str(r[0]) for r in spark.read.parquet(now.path("silver", "search_results")).select("ingested_at").distinct().collect()] == [d2]
    # the next day run goes on in the new generation; the old tables can go
    plans.run_day(spark, lake, d2)
    gone = plans.vacuum(spark, lake)
    assert f"{lake_root}/silver" in gone and f"{lake_root}/gold" in gone and not tables.table_exists(spark, lake.path("silver", "search_results"))
    assert not tables.read_dimension(spark, now.path("gold", "dim_product"), current_only=True).isEmpty()


def test_streaming_bronze(spark, tmpdir_path):
    root = f"{tmpdir_path}/raw"
    cards = _cards(spark)
    raw.write_card_envelopes(cards, root)
    q = start_bronze_stream(spark, root, "search", raw.CARD_RECORD, raw.CARD_LIFT, f"{tmpdir_path}/bronze",
                            f"{tmpdir_path}/ckpt", layout="{root}/{source}/d={date}", multi_line=False)
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmpdir_path}/bronze")
    assert got.count() == cards.count()
    assert got.select("ingested_at").distinct().count() == cards.select("ingested_at").distinct().count()


def test_path_scan_and_schema_contract(spark, tmpdir_path):
    from pyspark.sql import types as T

    from shelfscope.operators import quality

    path = f"{tmpdir_path}/p"
    cards = clean.clean_cards(_cards(spark), audit_col=None)
    tables.replace_partitions(cards, path)
    day = cards.agg(F.max("ingested_at")).first()[0]
    got = views.path_scan(spark, path, f"ingested_at = DATE '{day}'")
    assert got.count() == cards.filter(F.col("ingested_at") == F.lit(day)).count()
    contract = T.StructType([T.StructField("asin", T.StringType()), T.StructField("price_amount", T.DoubleType()),
                             T.StructField("ingested_at", T.DateType()), T.StructField("rating", T.LongType())])
    issues = quality.schema_contract(spark.read.parquet(path), contract, forbidden=["source_file", "title"])
    assert issues == [("rating", "bigint", "double"), ("title", "absent", "string")]


def test_streaming_restart_is_exactly_once(spark, tmpdir_path):
    root, bronze, ckpt = f"{tmpdir_path}/raw", f"{tmpdir_path}/bronze", f"{tmpdir_path}/ckpt"
    cards = _cards(spark)
    days = sorted(r[0] for r in cards.select("ingested_at").distinct().collect())
    first, rest = cards.filter(F.col("ingested_at") == days[0]), cards.filter(F.col("ingested_at") != days[0])

    def run():
        q = start_bronze_stream(spark, root, "search", raw.CARD_RECORD, raw.CARD_LIFT, bronze, ckpt,
                                layout="{root}/{source}/d={date}", multi_line=False)
        q.awaitTermination(120)

    raw.write_card_envelopes(first, root)
    run()
    run()  # restart without new files: nothing is added twice
    assert spark.read.parquet(bronze).count() == first.count()
    # new day folders arrive; only they are processed by the next run
    for d in days[1:3]:
        rows = rest.filter(F.col("ingested_at") == d)
        rows.select(
            F.struct(F.lit("search").alias("type"), "keyword", "marketplace", F.lit(1).cast("long").alias("total_products"),
                     F.col("source_extracted_at").alias("extracted_at")).alias("metadata"),
            F.array(F.struct(*[F.col(n) for n, _ in raw.CARD_FIELDS])).alias("products"),
        ).write.mode("overwrite").json(f"{root}/search/d={d}")
    run()
    expected = first.count() + rest.filter(F.col("ingested_at").isin(days[1:3])).count()
    assert spark.read.parquet(bronze).count() == expected


def test_bronze_day_quarantines_only_bad_files(spark, tmpdir_path):
    raw_root, lake_root = f"{tmpdir_path}/raw", f"{tmpdir_path}/lake"
    cards = _cards(spark)
    d1, d2 = "2024-01-01", "2024-01-02"
    raw.write_card_envelopes(cards.filter(F.col("ingested_at").isin(d1, d2)), raw_root)
    with open(os.path.join(f"{raw_root}/search/d={d2}", "truncated.json"), "w") as fh:
        fh.write('{"metadata": {"keyword": "view", "mark')
    lake = plans.Lake(raw_root, lake_root, raw_layout="{root}/{source}/d={date}", raw_multi_line=False)
    plans.run_bronze(spark, lake, d1)
    assert not tables.table_exists(spark, lake.path("bronze", "_quarantine_search_results"))
    plans.run_bronze(spark, lake, d2)
    q = spark.read.parquet(lake.path("bronze", "_quarantine_search_results"))
    assert q.count() == 1 and q.first().source_file.endswith("truncated.json")
    report = plans.run_bronze(spark, lake, d2)["search_results"]  # again: the same rows once
    assert spark.read.parquet(lake.path("bronze", "_quarantine_search_results")).count() == 1
    assert report.source_rows == report.rows + 1
    assert spark.read.parquet(lake.path("bronze", "search_results")).count() == cards.filter(F.col("ingested_at").isin(d1, d2)).count()


def _dim(spark, rows):
    return spark.createDataFrame(rows, "product_sk string, asin string, effective_date string, expiry_date string").selectExpr(
        "product_sk", "asin", "cast(effective_date as date) as effective_date", "cast(expiry_date as date) as expiry_date"
    )


def test_whole_dimension_write_leaves_no_stale_version(spark, tmpdir_path):
    path = f"{tmpdir_path}/dim"
    tables.write_dimension(_dim(spark, [("s1", "A", "2026-01-01", "2026-01-05"), ("s2", "A", "2026-01-06", None)]), path)
    tables.write_dimension(_dim(spark, [("s1", "A", "2026-01-01", "2026-01-09"), ("s2", "A", "2026-01-10", None)]), path)
    rows = sorted((r.product_sk, str(r.expiry_date)) for r in tables.read_dimension(spark, path).collect())
    assert rows == [("s1", "2026-01-09"), ("s2", "None")]


def test_partitioned_overwrite_replaces_the_table(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, d string")
    tables.write_table(df, f"{tmpdir_path}/t", "overwrite", partition_by=["d"])
    tables.write_table(df.where("d = 'b'"), f"{tmpdir_path}/t", "overwrite", partition_by=["d"])
    assert [r.x for r in spark.read.parquet(f"{tmpdir_path}/t").collect()] == [2]
    assert tables.write_table(df, f"{tmpdir_path}/new", "ignore").rows == 2
    again = tables.write_table(df, f"{tmpdir_path}/new", "ignore")
    assert again.skipped and again.rows == 0


def test_a_folder_that_is_no_table_stops_the_load(spark, tmpdir_path):
    import os

    os.makedirs(f"{tmpdir_path}/empty")
    with pytest.raises(RuntimeError, match="no readable table"):
        tables.table_exists(spark, f"{tmpdir_path}/empty")
    assert not tables.table_exists(spark, f"{tmpdir_path}/absent")


def _day(spark, rows, day):
    from shelfscope.operators import dimension

    snaps = spark.createDataFrame(rows, "asin string, marketplace string, title string")
    return dimension.shape_incoming(snaps, day, tracked=["title"])


def _versions(spark, path):
    rows = tables.read_dimension(spark, path).collect()
    return sorted((r.asin, r.title, str(r.effective_date), str(r.expiry_date), r.is_current) for r in rows)


def test_a_load_cut_off_before_its_commit_is_no_part_of_the_table(spark, tmpdir_path):
    from shelfscope.operators import dimension

    path = f"{tmpdir_path}/dim"
    tables.scd2_load_day(spark, path, _day(spark, [("a", "US", "one"), ("z", "US", "z")], "2026-03-04"), "2026-03-04")
    # day 5 is staged with wrong data and the job ends before the commit
    state = tables.dim_state(spark, path)
    wrong = dimension.scd2_apply(tables.read_dimension(spark, path), _day(spark, [("a", "US", "WRONG")], "2026-03-05"), "2026-03-05")
    tables.stage_load(wrong, path, state.generation, state.last_load + 1)
    first = [("a", "one", "2026-03-04", "None", True), ("z", "z", "2026-03-04", "None", True)]
    assert _versions(spark, path) == first
    # a rebuild comes first, then the next day's load: nothing of the staged folder returns
    snaps = spark.createDataFrame(
        [("a", "US", "one", "2026-03-04"), ("z", "US", "z", "2026-03-04"), ("a", "US", "two", "2026-03-05")], "asin string, marketplace string, title string, d string"
    ).withColumn("ingested_at", F.col("d").cast("date"))
    tables.write_dimension(dimension.scd2_rebuild(snaps, tracked=["title"], attrs=["title"]), path)
    tables.scd2_load_day(spark, path, _day(spark, [("a", "US", "three")], "2026-03-06"), "2026-03-06")
    right = [
        ("a", "one", "2026-03-04", "2026-03-04", False), ("a", "three", "2026-03-06", "None", True),
        ("a", "two", "2026-03-05", "2026-03-05", False), ("z", "z", "2026-03-04", "None", True),
    ]
    assert _versions(spark, path) == right
    # the day again with other data replaces it; vacuum deletes only what no state holds
    tables.scd2_load_day(spark, path, _day(spark, [("a", "US", "two"), ("n", "US", "new")], "2026-03-06"), "2026-03-06")
    again = [right[0], ("a", "two", "2026-03-05", "None", True), ("n", "new", "2026-03-06", "None", True), right[3]]
    assert _versions(spark, path) == again
    assert [x.removeprefix(path) for x in tables.vacuum_dimension(spark, path)] == ["/gen=1", "/gen=2/load=1"]
    assert _versions(spark, path) == again and tables.vacuum_dimension(spark, path) == []


def test_a_first_run_cut_off_does_not_stop_later_loads(spark, tmpdir_path):
    path = f"{tmpdir_path}/dim"
    inc = _day(spark, [("a", "US", "one")], "2026-03-04")
    tables.stage_load(inc.withColumn("product_sk", F.lit("half")), path, 1, 0)
    assert tables.dim_state(spark, path) is None
    with pytest.raises(FileNotFoundError):
        tables.read_dimension(spark, path)
    assert tables.scd2_load_day(spark, path, inc, "2026-03-04")["total_rows"] == 1
    assert _versions(spark, path) == [("a", "one", "2026-03-04", "None", True)]
    tables.write_dimension(tables.read_dimension(spark, path).limit(0), path)  # an empty table stays readable
    assert _versions(spark, path) == []


def test_blank_and_productless_files_are_quarantined(spark, tmpdir_path):
    import os

    folder = f"{tmpdir_path}/search/2026-03-04"
    os.makedirs(folder)
    files = {
        "good.json": '{"metadata": {"keyword": "k", "marketplace": "US", "extracted_at": "2026-03-04T00:00:00"}, "products": [{"asin": "A"}]}',
        "blank.json": " \n",
        "noprod.json": '{"metadata": {"keyword": "k"}}',
        "cut.json": '{"metadata": {"keyw',
    }
    for name, text in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    rows, bad = raw.ingest(spark, tmpdir_path, "search", raw.CARD_RECORD, raw.CARD_LIFT, "2026-03-04")
    assert [r.asin for r in rows.collect()] == ["A"]
    assert sorted((r.source_file, r.reason) for r in bad.collect()) == [
        ("blank.json", "blank"), ("cut.json", "not json"), ("noprod.json", "no products"),
    ]


def test_tied_rows_do_not_depend_on_input_order(spark):
    from shelfscope.operators import clean

    rows = [("A", f"t{i}", "k", "US", "2026-03-04T00:00:00", "2026-03-04", "f.json") for i in range(6)]
    cols = ["asin", "title", "keyword", "marketplace", "source_extracted_at", "ingested_at", "source_file"]
    one, two = (spark.createDataFrame(r, cols) for r in (rows, rows[::-1]))
    keys = ["asin", "keyword", "marketplace", "ingested_at"]
    assert [r.title for r in clean.latest_raw(one, keys).collect()] == [r.title for r in clean.latest_raw(two.repartition(3), keys).collect()]


def test_rounding_decides_on_the_value_itself(spark):
    from shelfscope.functions.numeric import round_to

    df = spark.createDataFrame([(1.0049996,), (2.6749997,), (2.675,), (1e33,)], "x double")
    assert [r.y for r in df.select(round_to("x", 2).alias("y")).collect()] == [1.0, 2.67, 2.68, 1e33]


def test_two_appends_of_whole_tables_keep_every_row_twice(spark, tmpdir_path):
    s, path = silver_cards(spark, SMALL), f"{tmpdir_path}/t"
    for _ in range(2):
        tables.write_table(s, path, "append", partition_by=["ingested_at"])
    got, want = spark.read.parquet(path).select(s.columns), s.unionAll(s)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
