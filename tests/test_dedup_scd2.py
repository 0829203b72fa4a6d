"""Dedup (WN-01..03) and the type-2 dimension (DM-01..09): invariants and
day-by-day versus batch equality."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfscope.operators import dimension, quality
from shelfscope.operators.dedup import latest_per
from shelfscope.sinks import tables
from tests.plan_util import plan_text


def test_latest_per_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "f1", "x"), ("a", None, "f9", "null-ts"), ("a", 1, "f2", "tie-wins"), ("b", None, "f1", "only")],
        "k string, ts int, f string, v string",
    )
    got = {r.k: r.v for r in latest_per(df, ["k"], ["ts", "f"]).collect()}
    assert got == {"a": "tie-wins", "b": "only"}


def test_latest_per_hot_key_equals_window(spark):
    # one key holds most rows: partial aggregation must give the same answer as a window
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 10007).alias("ts"),
        F.col("id").alias("v"),
    ).repartition(8)
    a = {(r.k, r.v) for r in latest_per(df, ["k"], ["ts", "v"]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("v").desc())
    b = {(r.k, r.v) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect()}
    assert a == b


def _history(spark):
    rows = []
    start = date(2024, 1, 1)
    attrs = {
        "p1": ["A", "A", "B", "B", "A"],
        "p2": ["X", None, None, "X", "X"],
        "p3": [None, None, "K", "K", "L"],
    }
    for key, seq in attrs.items():
        for i, v in enumerate(seq):
            if key == "p3" and i < 2:
                continue  # p3 first appears on day 3
            if key == "p2" and i == 3:
                continue  # p2 is absent on day 4 and stays current meanwhile
            rows.append((key, "US", start + timedelta(days=i), v, i))
    return spark.createDataFrame(rows, "asin string, marketplace string, ingested_at date, title string, untracked int")


def _norm(df):
    cols = ["product_sk", "asin", "marketplace", "title", "effective_date", "expiry_date", "is_current", "_attr_hash"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_rebuild_versions(spark):
    dim = dimension.scd2_rebuild(_history(spark), tracked=["title"], attrs=["title", "untracked"])
    p1 = sorted((str(r.effective_date), str(r.expiry_date), r.is_current, r.title) for r in dim.filter("asin = 'p1'").collect())
    assert p1 == [
        ("2024-01-01", "2024-01-02", False, "A"),
        ("2024-01-03", "2024-01-04", False, "B"),
        ("2024-01-05", "None", True, "A"),
    ]
    # null and '' hash alike, so p2 changes X -> null -> X
    assert dim.filter("asin = 'p2'").count() == 3
    assert [r.failures for r in quality.version_chain(dim, ["asin", "marketplace"]).collect()] == [0] * 5
    assert quality.duplicate_current(dim, ["asin", "marketplace"]).first().failures == 0
    assert quality.change_pairs(dim, ["asin", "marketplace"]).first().failures == 0


def test_apply_day_by_day_equals_rebuild(spark):
    hist = _history(spark)
    days = sorted({r.ingested_at for r in hist.select("ingested_at").distinct().collect()})
    dim = None
    for d in days:
        inc = dimension.shape_incoming(hist.filter(F.col("ingested_at") == F.lit(d)), d, tracked=["title"])
        dim = dimension.scd2_first_run(inc) if dim is None else dimension.scd2_apply(dim, inc, d)
        dim = dim.checkpoint()
    batch = dimension.scd2_rebuild(hist, tracked=["title"], attrs=["title", "untracked"])
    assert _norm(dim) == _norm(batch)


def test_persisted_load_equals_rebuild_and_refuses_backfill(spark, tmpdir_path):
    hist = _history(spark)
    path = f"{tmpdir_path}/dim_product"
    days = sorted({r.ingested_at for r in hist.select("ingested_at").distinct().collect()})
    for d in days:
        inc = dimension.shape_incoming(hist.filter(F.col("ingested_at") == F.lit(d)), d, tracked=["title"])
        rep = tables.scd2_load_day(spark, path, inc, d.isoformat())
    assert rep["total_rows"] == 8 and rep["current_rows"] == 3
    batch = dimension.scd2_rebuild(hist, tracked=["title"], attrs=["title", "untracked"])
    assert _norm(tables.read_dimension(spark, path)) == _norm(batch)
    with pytest.raises(ValueError):
        old = dimension.shape_incoming(hist.filter(F.col("ingested_at") == F.lit(days[0])), days[0], tracked=["title"])
        tables.scd2_load_day(spark, path, old, days[0].isoformat())


def test_change_gives_closed_and_open_version(spark):
    # DQ-04 scenario: change a title on a later day -> two versions for the key
    d1, d2 = date(2024, 3, 1), date(2024, 3, 5)
    h = spark.createDataFrame([("x", "US", d1, "old"), ("x", "US", d2, "new")], "asin string, marketplace string, ingested_at date, title string")
    dim = dimension.scd2_rebuild(h, tracked=["title"], attrs=["title"])
    rows = sorted((str(r.effective_date), str(r.expiry_date), r.is_current) for r in dim.collect())
    assert rows == [("2024-03-01", "2024-03-04", False), ("2024-03-05", "None", True)]


def test_asof_lookup_matches_range_join(spark):
    hist = _history(spark)
    dim = dimension.scd2_rebuild(hist, tracked=["title"], attrs=["title", "untracked"])
    facts = hist.select("asin", "marketplace", "ingested_at").union(
        spark.createDataFrame([("p3", "US", date(2023, 12, 1)), ("zz", "US", date(2024, 1, 2))], "asin string, marketplace string, ingested_at date")
    )
    got = sorted(tuple(r) for r in dimension.asof_lookup(facts, dim).collect())
    cond = (
        (facts.asin == dim.asin) & (facts.marketplace == dim.marketplace)
        & (dim.effective_date <= facts.ingested_at) & (facts.ingested_at <= F.coalesce(dim.expiry_date, F.lit("9999-12-31").cast("date")))
    )
    exp = sorted(tuple(r) for r in facts.join(dim, cond, "left").select(facts.asin, facts.marketplace, facts.ingested_at, dim.product_sk).collect())
    assert got == exp


def _range_join(fact, dim):
    met = [
        fact.asin == dim.asin, fact.marketplace == dim.marketplace, dim.effective_date <= fact.ingested_at,
        fact.ingested_at <= F.coalesce(dim.expiry_date, F.lit("9999-12-31").cast("date")),
    ]
    return fact.join(dim, met, "left").select(fact["*"], dim.product_sk, dim.title)


def test_asof_lookup_with_a_hot_key_repeats_gaps_and_nulls(spark):
    # one product holds two thirds of the facts and changes every fifth day; another has a gap between versions
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), c.cast("int"))
    hot = spark.range(40).select(F.lit("hot").alias("asin"), F.lit("US").alias("marketplace"), day(F.col("id") * 5).alias("effective_date"),
                                 F.when(F.col("id") < 39, day(F.col("id") * 5 + 4)).alias("expiry_date"), F.concat(F.lit("v"), "id").alias("title"))
    schema = "asin string, marketplace string, effective_date date, expiry_date date, title string"
    gap = spark.createDataFrame([("gap", "US", date(2024, 1, 3), date(2024, 1, 5), "a"), ("gap", "US", date(2024, 1, 20), None, "b"),
                                 (None, "US", date(2024, 1, 1), None, "no key")], schema)
    dim = hot.unionByName(gap).withColumn("product_sk", F.concat_ws("-", "asin", "title"))
    n = F.col("id")
    fact = spark.range(6000).select(
        F.when(n % 3 < 2, "hot").when(n % 6 == 2, "gap").when(n % 60 == 5, F.lit(None)).otherwise("absent").alias("asin"),
        F.lit("US").alias("marketplace"), F.when(n % 97 != 0, day(n % 211 - 4)).alias("ingested_at"), (n % 50).alias("row"),
    )
    order = lambda r: tuple((x is None, x) for x in map(lambda y: None if y is None else str(y), r))
    got = sorted(map(tuple, dimension.asof_lookup(fact, dim, cols=("product_sk", "title")).collect()), key=order)
    assert got == sorted(map(tuple, _range_join(fact, dim).collect()), key=order)
    assert len(got) == 6000 and any(r[-1] == "v39" for r in got) and any(r[0] == "gap" and r[-1] is None for r in got)
    none = dimension.asof_lookup(fact, dim.limit(0))
    assert none.count() == 6000 and none.where("product_sk is not null").count() == 0
    assert dimension.asof_lookup(fact.limit(0), dim).count() == 0


def test_asof_lookup_meets_the_facts_once(spark):
    """No month copies and one join: the versions are scanned once and the
    facts travel once, on key and day."""
    hist = _history(spark)
    dim = dimension.scd2_rebuild(hist, tracked=["title"], attrs=["title", "untracked"])
    text = plan_text(dimension.asof_lookup(hist.select("asin", "marketplace", "ingested_at", "title"), dim)).split("\n\n")[0]
    assert text.count("Join") == 1 and "Generate" not in text


def test_lookup_leaves_the_join_to_the_planner(spark):
    hist = _history(spark)
    dim = dimension.scd2_rebuild(hist, tracked=["title"], attrs=["title", "untracked"])
    fact = hist.select("asin", "marketplace", "ingested_at")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dimension.lookup_sk(fact, dim)
        text = plan_text(found)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        assert found.count() == fact.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_same_day_rerun_is_reported(spark, tmpdir_path):
    # T10: reloading a day with changed attributes closes the old row the day
    # before it started and reuses the surrogate key; DQ-05 reports both.
    path = f"{tmpdir_path}/dim"
    d = date(2024, 5, 1)
    h1 = spark.createDataFrame([("x", "US", d, "one")], "asin string, marketplace string, ingested_at date, title string")
    h2 = spark.createDataFrame([("x", "US", d, "two")], "asin string, marketplace string, ingested_at date, title string")
    tables.scd2_load_day(spark, path, dimension.shape_incoming(h1, d, tracked=["title"]), d.isoformat())
    tables.scd2_load_day(spark, path, dimension.shape_incoming(h2, d, tracked=["title"]), d.isoformat())
    checks = {r.check_name: r.failures for r in quality.version_chain(tables.read_dimension(spark, path), ["asin", "marketplace"]).collect()}
    assert checks["inverted"] == 1 and checks["duplicate_sk"] == 1


def test_update_untracked_type1(spark):
    d1, d2 = date(2024, 6, 1), date(2024, 6, 2)
    schema = "asin string, marketplace string, ingested_at date, title string, main_image_url string"
    day1 = spark.createDataFrame([("x", "US", d1, "t", "img1")], schema)
    day2 = spark.createDataFrame([("x", "US", d2, "t", "img2")], schema)
    dim = dimension.scd2_first_run(dimension.shape_incoming(day1, d1, tracked=["title"]))
    inc = dimension.shape_incoming(day2, d2, tracked=["title"])
    keep = dimension.scd2_apply(dim, inc, d2).collect()
    upd = dimension.scd2_apply(dim, inc, d2, update_untracked=True).collect()
    assert [(r.main_image_url, str(r.effective_date)) for r in keep] == [("img1", "2024-06-01")]
    assert [(r.main_image_url, str(r.effective_date)) for r in upd] == [("img2", "2024-06-01")]


def test_current_lookup_prunes_to_the_current_partition(spark, tmpdir_path):
    hist = _history(spark)
    dim = dimension.scd2_rebuild(hist, tracked=["title"], attrs=["title", "untracked"])
    tables.write_dimension(dim, f"{tmpdir_path}/dim")
    stored = tables.read_dimension(spark, f"{tmpdir_path}/dim")
    text = plan_text(dimension.lookup_sk(hist.select("asin", "marketplace", "ingested_at"), stored))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line and "expiry_date" in line]
    assert len(filters) == 1 and "isnull(expiry_date" in filters[0]
    assert dimension.current_view(stored).count() == 3
