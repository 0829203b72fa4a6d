"""Rule tables, schema differences, exact medians, keyword variants and the
one-join dimension load on small inputs."""

from __future__ import annotations

import random
from statistics import median_low

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.operators import dimension, marts, variants
from shelfscope.operators.medians import exact_median
from shelfscope.operators.quality import Rule, check_rules, schema_difference
from tests.plan_util import plan_text


def test_rules_count_planted_faults(spark):
    df = spark.createDataFrame([(1.0, "a", "1"), (9.0, None, "x"), (None, "c", None), (-1.0, "a", "2")], "x double, s string, raw string")
    df = df.withColumn("n", F.col("raw").try_cast("int"))
    rules = [
        Rule("both", "range", "x", 0, 5), Rule("low", "range", "x", low=0), Rule("open", "range", "x"), Rule("known", "known", "s", tolerance=0.25),
        Rule("one", "one_of", "s", values=("a",)), Rule("read", "parsed", "n", raw="raw", tolerance=0.3),
    ]
    got = {r.rule: (r.rows, r.failures, r.failure_pct, r.holds) for r in check_rules(df, rules).collect()}
    assert got == {
        "both": (3, 2, 66.67, False), "low": (3, 1, 33.33, False), "open": (3, 0, 0.0, True), "known": (4, 1, 25.0, True),
        "one": (3, 1, 33.33, False), "read": (3, 1, 33.33, False),
    }
    assert all(r.holds and r.rows == 0 for r in check_rules(df.limit(0), rules).collect())
    assert plan_text(check_rules(df, rules)).count("HashAggregate") <= 4  # one aggregation for all rules


def test_schema_difference_reaches_nested_fields():
    want = T.StructType.fromDDL("a int, r array<struct<rank: int, name: string>>, m map<string, struct<x: int>>, gone string")
    has = T.StructType.fromDDL("a int, r array<struct<rank: bigint, extra: int>>, m map<int, struct<x: date>>, new double")
    assert schema_difference(has, want) == [
        ("r[].rank", "int", "bigint"), ("r[].name", "string", "missing"), ("r[].extra", "absent", "int"), ("m{key}", "string", "int"),
        ("m{}.x", "int", "date"), ("gone", "string", "missing"), ("new", "absent", "double"),
    ]
    assert schema_difference(want, want) == []


def test_exact_median_at_any_size(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 60_013).cast("double").alias("x"))
    df = df.unionByName(spark.createDataFrame([(7, None), (8, 5.0), (8, None), (8, 1.0), (None, 2.0)], "g long, x double"))
    got = {r.g: r.m for r in exact_median(df, ["g"], "x", "m").collect()}
    want: dict = {}
    for r in df.where("x is not null").collect():
        want.setdefault(r.g, []).append(r.x)
    assert got == {g: median_low(v) for g, v in want.items()}


def test_mart_plans_no_sketch(spark):
    cols = "asin string, keyword string, marketplace string, ingested_at date, price_amount double, rating_value double, ratings_count long, monthly_sales_min long"
    flags = ", ".join(f"{c} boolean" for c in ("is_sponsored", "is_prime", "is_best_seller", "is_amazons_choice", "has_coupon"))
    text = plan_text(marts.keyword_daily(spark.createDataFrame([], f"{cols}, {flags}"), audit_col=None))
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text and "percentile" not in text


def _brute_groups(words, least):
    def near(a, b):
        if min(len(a), len(b)) < least:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        s, t = sorted((a, b), key=len)
        return len(t) == len(s) + 1 and any(t[:i] + t[i + 1 :] == s for i in range(len(t)))

    group = {w: w for w in words}
    moved = True
    while moved:
        moved = False
        for a in words:
            for b in words:
                if near(a, b) and group[b] < group[a]:
                    group[a], moved = group[b], True
    return group


def test_keyword_variants_equal_all_pairs(spark):
    rng = random.Random(8)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(4, 9))) for _ in range(60)} | {"phone case", "phonecase", "fone case", "phone cas", "wall"}
    df = spark.createDataFrame([(w,) for w in words] + [(None,), ("  Phone   CASES ",), ("phone case",)], "keyword string")
    got = {r.keyword: r.keyword_group for r in variants.keyword_variants(df).collect()}
    assert got.pop("  Phone   CASES ") == got["phone case"]
    stems = {w: w for w in words}
    want = _brute_groups(sorted(words), variants.MIN_LENGTH)
    assert got == {w: want[stems[w]] for w in words}
    assert variants.keyword_variants(df.limit(0)).count() == 0


def test_day_load_is_one_join(spark):
    schema = "asin string, marketplace string, ingested_at date, title string"
    snaps = spark.createDataFrame([], schema)
    dim = dimension.scd2_rebuild(snaps, tracked=["title"], attrs=["title"])
    inc = dimension.shape_incoming(snaps, "2026-03-04", tracked=["title"])
    cut = spark.createDataFrame([], dim.schema)  # the rebuild's windows are not part of the load
    text = plan_text(dimension.scd2_apply(cut, inc, "2026-03-04"), "simple")
    assert text.count("FullOuter") == 1 and "LeftAnti" not in text and text.count("Exchange hashpartitioning") <= 2
