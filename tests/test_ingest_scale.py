"""The raw ingest parses a product once and lists folders, not files; writes of
tables free what they shuffled."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from shelfscope.functions.hashing import attr_hash, surrogate_key
from shelfscope.operators import dimension
from shelfscope.plans.day import Lake, rebuild, run_bronze
from shelfscope.session import SHUFFLE_CLEANUP
from shelfscope.sinks import tables
from shelfscope.sources import fixtures, raw
from tests.conftest import SMALL
from tests.plan_util import plan_text

LAYOUT = "{root}/{source}/{date}"


def _write(root: str, files: dict[str, list]) -> None:
    for name, products in files.items():
        path = f"{root}/details/2024-01-01/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            json.dump({"metadata": {"marketplace": "US", "extracted_at": "2024-01-01T00:00:00"}, "products": products}, f)


def test_a_product_is_parsed_once_and_its_odd_columns_once_more(spark, tmpdir_path):
    _write(tmpdir_path, {"a.json": [{"asin": "A"}]})
    texts = raw.read_texts(spark, tmpdir_path, "details", "2024-01-01")
    fields = raw.LISTING_RECORD.fields
    for rows in (raw.tagged(texts, raw.LISTING_RECORD, raw.LISTING_LIFT), raw.kept(raw.tagged(texts, raw.LISTING_RECORD, raw.LISTING_LIFT))):
        parsed = plan_text(rows, "simple").count("from_json(")
        # envelope, metadata, product, its texts; a parse for each level below
        assert parsed <= 4 + sum(str(f.dataType).count("ArrayType") + str(f.dataType).count("StructType(") for f in fields)


def test_products_in_shape_and_out_of_it_are_decoded_alike(spark, tmpdir_path):
    whole = {
        "asin": "A", "best_seller_rank": ["#1", None], "variation_count": 2, "images": [], "rating_overview": {"5": 76.5, "4": None},
        "available_dimensions": {"size_name": ["S", "M"], "color_name": None}, "variations": [{"asin": "B", "combination_key": "k"}, None],
        "categories": [{"name": "n", "url": "u", "level": 1}, {"level": "2.0"}],
    }
    # each has one column of another type, which sends the whole product the other way
    odd = [
        whole | {"images": "one"}, whole | {"best_seller_rank": "#1"}, whole | {"variations": "none"}, whole | {"categories": [3, {"name": "n", "url": {"a": [1]}}]},
        whole | {"available_dimensions": {"size_name": "S", "color_name": ["r"]}}, whole | {"rating_overview": []}, whole | {"description": {"a": [1, "x"]}},
        {}, {"asin": "B", "available_dimensions": "{\"size_name\": [\"S\"]}"},
    ]
    _write(tmpdir_path, {"a.json": [whole, *odd, 7, None, "text", "{cut"]})
    texts = raw.read_texts(spark, tmpdir_path, "details", "2024-01-01")
    got = {r.record: r for r in raw.tagged(texts, raw.LISTING_RECORD, raw.LISTING_LIFT).collect()}
    names = raw.T.StructType([raw.T.StructField(f.name, raw.S) for f in raw.LISTING_RECORD.fields])
    one_by_one = texts.select(F.posexplode(F.from_json("value", "products array<string>")["products"]).alias("i", "p")).withColumn("_p", F.from_json("p", names))
    columns = [raw.decode(F.col(f"_p.`{f.name}`"), f.dataType).alias(f.name) for f in raw.LISTING_RECORD.fields]
    want = {r.i: r for r in one_by_one.where("p like '{%'").select("i", *columns).collect()}
    assert [i for i in sorted(got) if got[i].status == raw.KEPT] == sorted(want) == [*range(10), 13]
    assert [(got[i].reason, got[i].raw_text) for i in (10, 11, 12)] == [("not an object", "7"), ("not an object", None), ("not an object", "text")]
    for i, r in want.items():
        assert all(got[i][f] == r[f] for f in raw.LISTING_RECORD.names), i
    assert got[0].rating_overview["5"] == 76.5 and [c.level for c in got[0].categories] == [1, 2] and got[0].variations[1] is None
    assert got[1].images == ["one"] and got[1].categories == got[0].categories and got[4].categories[0] is None
    assert got[5].available_dimensions.size_name == ["S"] and got[9].available_dimensions.size_name == ["S"]


def test_folders_are_listed_and_only_their_own_files_read(spark, tmpdir_path):
    _write(tmpdir_path, {f"{i}.json": [{"asin": f"A{i}"}] for i in range(40)} | {"deep/x.json": [{"asin": "D"}], "other.txt": [{"asin": "T"}], "_x.json": [{}]})
    with open(f"{tmpdir_path}/details/stray.json", "w") as f:
        f.write("{}")
    for day in ("2024-01-01", None):
        texts = raw.read_texts(spark, tmpdir_path, "details", day, LAYOUT)
        scan = texts._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation()
        assert scan.location().rootPaths().size() == 1
        assert sorted(os.path.basename(r._file_path) for r in texts.collect()) == sorted(f"{i}.json" for i in range(40))
    assert raw.read_texts(spark, tmpdir_path, "details", "2024-01-02", LAYOUT).count() == 0
    assert raw.read_texts(spark, tmpdir_path, "search", None, LAYOUT).count() == 0


def _shuffles(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name.split("_")[1] for d in folders for _, _, names in os.walk(d) for name in names if name.startswith("shuffle_")}


def test_writes_of_tables_leave_no_shuffle_files(spark, tmpdir_path):
    rows = spark.range(2000).select((F.col("id") % 7).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("ingested_at"))
    was, before = spark.conf.get(SHUFFLE_CLEANUP), _shuffles(spark)
    counted = rows.groupBy("k", "ingested_at").count()
    assert tables.replace_partitions(counted, f"{tmpdir_path}/t", whole=True).rows == 21
    tables.replace_partition(counted.where("ingested_at = '2024-01-01'"), f"{tmpdir_path}/t", "2024-01-01")
    tables.write_table(counted, f"{tmpdir_path}/w", mode="append")
    dim = counted.select("k", F.col("ingested_at").alias("effective_date"), F.lit(None).cast("date").alias("expiry_date"), F.lit(True).alias("is_current"))
    tables.write_dimension(dim, f"{tmpdir_path}/d", "2024-01-03")
    products = spark.range(50).select(
        F.lit("2024-01-01").alias("d"), (F.col("id") % 5).alias("file"), F.lit("US").alias("marketplace"), F.lit("2024-01-01T00:00:00").alias("extracted_at"),
        F.lit("{}").alias("p"), F.lit(False).alias("cut"),
    )
    raw.write_multi_line(products, tmpdir_path, "details")
    assert _shuffles(spark) <= before and spark.conf.get(SHUFFLE_CLEANUP) == was
    assert spark.read.parquet(f"{tmpdir_path}/t").count() == 21 and tables.read_dimension(spark, f"{tmpdir_path}/d").count() == 21


def test_stored_tables_take_zstandard_or_the_callers_codec(spark, tmpdir_path):
    rows = spark.range(10).withColumn("ingested_at", F.lit("2024-01-01").cast("date"))
    tables.replace_partitions(rows, f"{tmpdir_path}/own")
    s = spark.newSession()
    s.conf.set(tables.CODEC, "gzip")
    tables.replace_partitions(s.range(10).withColumn("ingested_at", F.lit("2024-01-01").cast("date")), f"{tmpdir_path}/set")
    for name, ending in (("own", ".zstd.parquet"), ("set", ".gz.parquet")):
        files = os.listdir(f"{tmpdir_path}/{name}/ingested_at=2024-01-01")
        assert all(f.endswith(ending) for f in files if f.startswith("part-")), files


def test_rebuild_computes_hashes_as_versions_are_written(spark, tmpdir_path, monkeypatch):
    seen = []
    monkeypatch.setattr(tables, "stage_load", lambda dim, path, generation, load, derived=None, put=tables.stage_load: (seen.append(sorted(derived)), put(dim, path, generation, load, derived)))
    lake = Lake(f"{tmpdir_path}/raw", f"{tmpdir_path}/lake")
    for name, rows in {"search_results": fixtures.raw_cards(spark, SMALL), "product_details": fixtures.raw_listings(spark, SMALL)}.items():
        rows.withColumn("ingested_at", F.lit("1995-01-01").cast("date")).write.partitionBy("ingested_at").parquet(lake.path("bronze", name))
    rebuild(spark, lake)
    dim = tables.read_dimension(spark, lake.at(spark).path("gold", "dim_product"))
    assert seen == [["_attr_hash", "product_sk"]]
    wrong = dim.where((F.col("product_sk") != surrogate_key(dimension.PRODUCT_KEYS)) | (F.col("_attr_hash") != attr_hash(dimension.PRODUCT_TRACKED)))
    assert dim.count() > 0 and wrong.count() == 0 and dim.where("product_sk is null or _attr_hash is null").count() == 0


def test_loads_of_bronze_repeat_nothing_and_leave_no_shuffle_files(spark, tmpdir_path):
    _write(f"{tmpdir_path}/raw", {f"{i}.json": [{"asin": f"A{i}", "images": "one" if i % 2 else ["one"]}, 7] for i in range(40)})
    lake, only = Lake(f"{tmpdir_path}/raw", f"{tmpdir_path}/lake"), ("product_details",)
    before = _shuffles(spark)
    for day in (None, None, "2024-01-01"):
        report = run_bronze(spark, lake, day, only)["product_details"]
        assert (report.rows, report.source_rows) == (40, 80)
    assert len(_shuffles(spark) - before) <= 3  # a count by status each, freed as the driver drops its frame
    kept, aside = (spark.read.parquet(lake.path("bronze", t)) for t in ("product_details", "_quarantine_product_details"))
    assert {(r.asin, *r.images) for r in kept.collect()} == {(f"A{i}", "one") for i in range(40)} and kept.count() == 40
    assert [(r.reason, r.raw_text, r["count"]) for r in aside.groupBy("reason", "raw_text").count().collect()] == [("not an object", "7", 40)]
