"""Type-2 slowly changing dimension (DM-01..09) and dimension lookups
(JN-01, JN-04, JN-06).

Batch rebuild (``scd2_rebuild``) turns a whole snapshot history into versions
with two window passes that share one shuffle and one sort: ``lag`` flags a
change, ``lead`` closes a version.  After dedup a key has at most one
snapshot per day, so a window partition is bounded by the number of days, not
by the data volume.  ``scd2_apply`` is the incremental one-day step with the
same result, expressed as joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.hashing import attr_hash, attr_text, surrogate_key

# Attributes whose change opens a new product version, and the
# projection of the product dimension.
PRODUCT_KEYS = ("asin", "marketplace")
PRODUCT_TRACKED = (
    "title",
    "brand",
    "category_path",
    "category_leaf",
    "category_depth",
    "is_fba",
    "variation_count",
)
PRODUCT_ATTRS = (
    "title",
    "brand",
    "category_path",
    "category_leaf",
    "category_depth",
    "bsr_primary_category",
    "date_first_available",
    "variation_count",
    "size_count",
    "color_count",
    "main_image_url",
    "is_fba",
)
VERSION_COLS = ("effective_date", "expiry_date", "is_current")


def snapshot_columns(attrs: Sequence[str] = PRODUCT_ATTRS) -> list[Column]:
    """DM-02: what a snapshot row takes from a silver listing."""
    primary = F.get(F.col("best_seller_ranks"), 0).getField("category").alias("bsr_primary_category")
    return [F.col(c) for c in (*PRODUCT_KEYS, "ingested_at")] + [primary if c == "bsr_primary_category" else F.col(c) for c in attrs]


def product_snapshots(silver_listings: DataFrame) -> DataFrame:
    """DM-02 projection: silver listings -> one snapshot row per product day."""
    return silver_listings.select(*snapshot_columns())


def shape_incoming(
    snapshots: DataFrame, run_date: str | date, tracked: Sequence[str] = PRODUCT_TRACKED, day: str = "ingested_at"
) -> DataFrame:
    """DM-02: one day's snapshots as candidate current versions (day column dropped)."""
    d = F.lit(str(run_date)).cast("date")
    if day in snapshots.columns:
        snapshots = snapshots.drop(day)
    return (
        snapshots.withColumn("effective_date", d)
        .withColumn("expiry_date", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(True))
        .withColumn("_attr_hash", attr_hash(tracked))
    )


def scd2_rebuild(
    snapshots: DataFrame,
    keys: Sequence[str] = PRODUCT_KEYS,
    day: str = "ingested_at",
    tracked: Sequence[str] = PRODUCT_TRACKED,
    attrs: Sequence[str] | None = None,
    sk: str = "product_sk",
) -> DataFrame:
    """DM-08: all versions from a snapshot history, in one job.

    ``snapshots`` holds one row per (keys, day).  A snapshot opens a version
    when the text that the tracked-attribute hash is taken of differs from the
    previous snapshot's of the same key; the version ends the day before the next
    opening.  Equal to applying ``scd2_apply`` day by day in date order.

    Only versions are hashed: the hash is as wide as a row's texts and does not
    compress, so no snapshot carries it through the exchange and the sort.
    """
    keys = list(keys)
    attrs = list(attrs) if attrs is not None else [c for c in snapshots.columns if c not in keys and c != day]
    w = Window.partitionBy(*keys).orderBy(F.col(day))
    rows = snapshots.select(*keys, day, *dict.fromkeys([*attrs, *tracked]))
    prev = {c: f"_prev_{c}" for c in tracked}
    seen = rows.select("*", F.lag(F.lit(True)).over(w).alias("_seen"), *[F.lag(c).over(w).alias(p) for c, p in prev.items()])
    opened = seen.filter(F.col("_seen").isNull() | (attr_text(tracked) != attr_text(prev.values())))
    nxt = F.lead(F.col(day)).over(w)
    versions = opened.select(
        *keys,
        *attrs,
        F.col(day).alias("effective_date"),
        F.date_sub(nxt, 1).alias("expiry_date"),
        nxt.isNull().alias("is_current"),
        attr_hash(tracked).alias("_attr_hash"),
    )
    return versions.select(surrogate_key(keys).alias(sk), *versions.columns)


def derived_columns(keys: Sequence[str] = PRODUCT_KEYS, tracked: Sequence[str] = PRODUCT_TRACKED, sk: str = "product_sk") -> dict[str, Column]:
    """DM-01, DM-03: the columns of rebuilt versions that follow from their others."""
    return {sk: surrogate_key(list(keys)), "_attr_hash": attr_hash(tracked)}


def scd2_apply(
    dim: DataFrame,
    incoming: DataFrame,
    run_date: str | date,
    keys: Sequence[str] = PRODUCT_KEYS,
    sk: str = "product_sk",
    update_untracked: bool = False,
) -> DataFrame:
    """DM-04 + DM-05 (JN-05): the dimension after loading one day.

    Current rows whose hash differs from today's are closed (expiry = day-1,
    not current); changed and new keys get a version starting today; keys
    absent today stay current.  With ``update_untracked`` an unchanged current
    row takes today's untracked attributes in place (Type-1 behaviour).
    Returns the full new state (closed rows of ``dim`` as they are, then the
    rest).

    One full outer join on the key meets each side once and gives one row per
    key; a changed key then yields its closed and its new version.
    """
    keys = list(keys)
    cols = dim.columns
    d = F.lit(str(run_date)).cast("date")
    today = incoming.withColumn(sk, surrogate_key(keys))
    held = dim.where(F.col("is_current")).select(F.struct(*cols).alias("_old"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    came = today.select(F.struct(*cols).alias("_new"), *[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)])
    both = held.join(came, [F.col(f"_k{i}") == F.col(f"_n{i}") for i in range(len(keys))], "full")
    old, new = F.col("_old"), F.col("_new")
    same = old.isNotNull() & new.isNotNull() & old["_attr_hash"].eqNullSafe(new["_attr_hash"])
    changed = old.isNotNull() & new.isNotNull() & ~same
    kept = old
    if update_untracked:
        fixed = {*keys, *VERSION_COLS, "_attr_hash", sk}
        taken = F.struct(*[(old if c in fixed else new)[c].alias(c) for c in cols])
        kept = F.when(same, taken).otherwise(old)
    ends = {"expiry_date": F.date_sub(d, 1), "is_current": F.lit(False)}
    closed = F.struct(*[ends.get(c, old[c]).alias(c) for c in cols])
    rows = F.when(changed, F.array(closed, new)).when(old.isNull(), F.array(new)).otherwise(F.array(kept))
    loaded = both.select(F.explode(rows).alias("_v")).select(*[F.col(f"_v.{c}").alias(c) for c in cols])
    return dim.where(~F.col("is_current")).unionByName(loaded)


def scd2_first_run(incoming: DataFrame, keys: Sequence[str] = PRODUCT_KEYS, sk: str = "product_sk") -> DataFrame:
    """DM-06: every incoming row becomes version 1."""
    return incoming.select(surrogate_key(list(keys)).alias(sk), *incoming.columns)


def current_only(dim: DataFrame) -> DataFrame:
    """FL-02: current versions.  ``expiry_date IS NULL`` is equivalent (a
    version is current exactly while it has no expiry) and is the partition
    column of the stored dimension, so the scan reads only that partition."""
    return dim.filter(F.col("expiry_date").isNull() & F.col("is_current"))


def current_view(dim: DataFrame) -> DataFrame:
    """DM-07: active versions only, change hash hidden."""
    return current_only(dim).drop("_attr_hash")


def dim_totals(dim: DataFrame) -> DataFrame:
    """DM-09: total and current version counts."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_current")).alias("current_rows"),
    )


def lookup_sk(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str] = PRODUCT_KEYS,
    cols: Sequence[str] = ("product_sk",),
) -> DataFrame:
    """JN-01: attach the current version's columns; unmatched rows keep nulls.

    No hint is given: the planner decides from statistics and AQE from
    runtime sizes whether the current versions are broadcast.
    """
    return fact.join(current_only(dim).select(*keys, *cols), list(keys), "left")


def asof_lookup(
    fact: DataFrame,
    dim: DataFrame,
    at: str = "ingested_at",
    keys: Sequence[str] = PRODUCT_KEYS,
    cols: Sequence[str] = ("product_sk",),
) -> DataFrame:
    """JN-06: attach the version valid on ``at``
    (``effective_date <= at <= coalesce(expiry_date, +inf)``).

    A merge scan instead of a range join: the days on which a key has facts
    and the key's versions lie on one timeline, and a window carries the last
    version forward along it.  A timeline has one point per day and version of
    its key, however many facts the key has, because equal (key, day) pairs
    are combined before the shuffle.  The facts then meet their own (key, day)
    once, so a hot key is spread over its days.  Rows with a null key or day
    find nothing; versions of a key do not overlap.  ``fact`` is read twice:
    its keys and days, and the rows.
    """
    keys = list(keys)
    key_cols = [f"_k{i}" for i in range(len(keys))]
    named = [F.col(k).alias(n) for k, n in zip(keys, key_cols)]
    found = F.struct(F.col("expiry_date").alias("until"), *[F.col(c).alias(f"_d_{c}") for c in cols])
    versions = dim.select(*named, F.col("effective_date").alias("_day"), F.lit(False).alias("_asked"), found.alias("_found"))
    asked = fact.select(*named, F.col(at).alias("_day")).distinct()
    asked = asked.select(*key_cols, "_day", F.lit(True).alias("_asked"), F.lit(None).cast(versions.schema["_found"].dataType).alias("_found"))
    so_far = Window.partitionBy(*key_cols).orderBy("_day", "_asked", F.col("_found.until").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    carried = versions.unionByName(asked).withColumn("_found", F.last("_found", ignorenulls=True).over(so_far))
    valid = F.col("_asked") & (F.col("_found.until").isNull() | (F.col("_day") <= F.col("_found.until")))
    points = carried.where(valid).select(*key_cols, "_day", "_found.*").drop("until")
    met = [fact[k] == points[n] for k, n in zip(keys, key_cols)] + [fact[at] == points["_day"]]
    return fact.join(points, met, "left").select(*[fact[c] for c in fact.columns], *[F.col(f"_d_{c}").alias(c) for c in cols])


def new_or_changed(incoming: DataFrame, current_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-04: incoming rows whose key is not (still) current."""
    return incoming.join(current_keys.select(*keys), list(keys), "left_anti")


def new_keys(df: DataFrame, keys: Sequence[str], day: str = "ingested_at") -> DataFrame:
    """JN-04 over a history: rows whose key was absent the previous day."""
    prev = df.select(*keys, F.date_add(F.col(day), 1).alias(day))
    return df.join(prev, [*keys, day], "left_anti")
