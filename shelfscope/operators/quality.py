"""Data-quality checks as aggregations (DQ-01..07).

Every check is a one-pass aggregate returning ``(check, failures)`` rows (or a
profile table), so it runs distributed next to the data instead of pulling
rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.functions.hashing import row_fingerprint
from shelfscope.functions.numeric import round_to


def _check(name: str, failures: F.Column) -> list[F.Column]:
    return [F.lit(name).alias("check_name"), failures.cast("long").alias("failures")]


def duplicate_current(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-01: keys with more than one current version (HAVING count > 1)."""
    dup = dim.filter(F.col("is_current")).groupBy(*keys).count().filter(F.col("count") > 1)
    return dup.agg(*_check("duplicate_current", F.count(F.lit(1))))


def null_keys(df: DataFrame, keys: Sequence[str], name: str = "null_keys") -> DataFrame:
    """DQ-02: rows with any null business key."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.agg(*_check(name, F.count_if(cond)))


def content_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DQ-03: order-free row count and content hash sum of a table; two runs of
    the same job must give identical values."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_fingerprint(cols).cast("decimal(38,0)")).alias("fingerprint"))


def rerun_identical(first: DataFrame, second: DataFrame, name: str) -> DataFrame:
    """DQ-03: compare the fingerprints of two runs; failures = 1 when they differ."""
    both = content_fingerprint(first).unionByName(content_fingerprint(second))
    return both.agg(
        F.lit(name).alias("check_name"),
        F.max("rows").alias("rows"),
        (F.count_distinct(F.struct("rows", "fingerprint")) - 1).cast("long").alias("failures"),
    )


def version_chain(dim: DataFrame, keys: Sequence[str], sk: str = "product_sk") -> DataFrame:
    """DQ-04 + DQ-05 on a type-2 dimension, one pass with ``lead``:
    - ``chain_gap``: a closed version whose expiry is not the day before the next version starts
    - ``open_not_last``: a current version followed by another version
    - ``last_not_open``: the newest version of a key is not current
    - ``inverted``: effective date after expiry date
    - ``duplicate_sk``: surrogate keys used more than once
    """
    w = Window.partitionBy(*keys).orderBy("effective_date")
    nxt = F.lead("effective_date").over(w)
    v = dim.select(sk, "effective_date", "expiry_date", "is_current", nxt.alias("_next"))
    agg = v.agg(
        F.count_if(F.col("_next").isNotNull() & ~F.col("expiry_date").eqNullSafe(F.date_sub("_next", 1))).alias("chain_gap"),
        F.count_if(F.col("_next").isNotNull() & F.col("is_current")).alias("open_not_last"),
        F.count_if(F.col("_next").isNull() & ~F.col("is_current")).alias("last_not_open"),
        F.count_if(F.col("effective_date") > F.col("expiry_date")).alias("inverted"),
        (F.count(sk) - F.count_distinct(sk)).alias("duplicate_sk"),
    )
    names = ["chain_gap", "open_not_last", "last_not_open", "inverted", "duplicate_sk"]
    return agg.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).cast("long").alias("failures")) for n in names])).alias("c")).select("c.*")


def change_pairs(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-04: keys whose history holds a change (>= 2 versions) and whether it
    is well formed: exactly one current version, all others closed."""
    g = dim.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("is_current")).alias("current_versions"),
        F.count_if(~F.col("is_current") & F.col("expiry_date").isNotNull()).alias("closed_versions"),
    )
    changed = g.filter(F.col("versions") >= 2)
    return changed.agg(
        F.count(F.lit(1)).alias("changed_keys"),
        F.count_if((F.col("current_versions") != 1) | (F.col("closed_versions") != F.col("versions") - 1)).alias("failures"),
    )


def profile(df: DataFrame, parse_pairs: dict[str, str] | None = None) -> DataFrame:
    """DQ-06: per column null count and null share; for (raw -> parsed) pairs the
    parse rate = parsed non-null / raw non-null.  One aggregation pass."""
    parse_pairs = parse_pairs or {}
    n = F.count(F.lit(1))
    aggs = [n.alias("_rows")]
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n__{c}"))
    for raw, parsed in parse_pairs.items():
        aggs.append(F.count_if(F.col(raw).isNotNull()).alias(f"r__{parsed}"))
        aggs.append(F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNotNull()).alias(f"p__{parsed}"))
    a = df.agg(*aggs)
    entries = []
    for c in df.columns:
        raw_nn = F.col(f"r__{c}") if c in parse_pairs.values() else F.lit(None).cast("long")
        ok = F.col(f"p__{c}") if c in parse_pairs.values() else F.lit(None).cast("long")
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("rows"),
                F.col(f"n__{c}").cast("long").alias("nulls"),
                raw_nn.cast("long").alias("raw_non_null"),
                ok.cast("long").alias("parsed"),
            )
        )
    out = a.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return out.select(
        "*",
        F.when(F.col("rows") > 0, round_to(F.col("nulls") / F.col("rows") * 100, 2)).alias("null_pct"),
        F.when(F.col("raw_non_null") > 0, round_to(F.col("parsed") / F.col("raw_non_null") * 100, 2)).alias("parse_pct"),
    )


@dataclass(frozen=True)
class Rule:
    """One row of a rule table (DQ-06).

    ``range``: known values lie in ``low .. high`` (None: open).  ``known``: no
    value is null.  ``one_of``: known values are among ``values``.  ``parsed``:
    where the text ``raw`` is known, the value read from it is known too.  A rule
    holds while at most ``tolerance`` (a share) of the rows it looks at fail.
    """

    name: str
    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    raw: str | None = None
    tolerance: float = 0.0

    def looks_at(self) -> F.Column:
        if self.kind == "known":
            return F.lit(True)
        return F.col(self.raw if self.kind == "parsed" else self.column).isNotNull()

    def fails(self) -> F.Column:
        value = F.col(self.column)
        if self.kind in ("known", "parsed"):
            return value.isNull()
        if self.kind == "one_of":
            return ~value.isin(*self.values)
        if self.kind != "range":
            raise ValueError(f"unknown rule kind {self.kind}")
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low)
        return outside if self.high is None else outside | (value > self.high)


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """DQ-06: a rule table over a table, compiled into one aggregation; per
    rule the rows it looks at, those that fail, their share and whether it holds
    (an empty table breaks no rule)."""
    aggs = []
    for i, r in enumerate(rules):
        aggs += [F.count_if(r.looks_at()).alias(f"n{i}"), F.count_if(r.looks_at() & r.fails()).alias(f"f{i}")]
    entries = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.column).alias("column_name"),
            F.col(f"n{i}").alias("rows"), F.col(f"f{i}").alias("failures"), F.lit(float(r.tolerance)).alias("_t"),
        )
        for i, r in enumerate(rules)
    ]
    out = df.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    share = F.when(F.col("rows") > 0, F.col("failures") / F.col("rows")).otherwise(F.lit(0.0))
    return out.select("rule", "kind", "column_name", "rows", "failures", round_to(share * 100, 2).alias("failure_pct"), (share <= F.col("_t")).alias("holds"))


def schema_difference(actual: T.DataType, expected: T.DataType, path: str = "") -> list[tuple[str, str, str]]:
    """DQ-07: (path, expected type, actual type) of every difference, down to
    fields of structs (``a.b``), elements of arrays (``a[]``) and values of maps
    (``a{}``); a field on one side only is ``missing`` or ``absent``."""
    if isinstance(actual, T.StructType) and isinstance(expected, T.StructType):
        has, wants = ({f.name: f.dataType for f in t.fields} for t in (actual, expected))
        out = []
        for name in [*wants, *(n for n in has if n not in wants)]:
            at = f"{path}.{name}" if path else name
            if name not in has:
                out.append((at, wants[name].simpleString(), "missing"))
            elif name not in wants:
                out.append((at, "absent", has[name].simpleString()))
            else:
                out += schema_difference(has[name], wants[name], at)
        return out
    if isinstance(actual, T.ArrayType) and isinstance(expected, T.ArrayType):
        return schema_difference(actual.elementType, expected.elementType, f"{path}[]")
    if isinstance(actual, T.MapType) and isinstance(expected, T.MapType):
        keys = schema_difference(actual.keyType, expected.keyType, f"{path}{{key}}")
        return keys + schema_difference(actual.valueType, expected.valueType, f"{path}{{}}")
    return [] if actual == expected else [(path, expected.simpleString(), actual.simpleString())]


def schema_contract(df: DataFrame, expected: T.StructType, forbidden: Sequence[str] = ()) -> list[tuple[str, str, str]]:
    """DQ-07: differences between a table's schema and its contract as (path,
    expected, actual).  Further columns are allowed unless ``forbidden``, further
    fields inside a column are not.  No data is read."""
    found = schema_difference(df.schema, expected)
    return [x for x in found if x[1] != "absent" or x[0] in forbidden or x[0] not in df.columns]
