"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata dimensions are quantised to a few bits each, every row gets
its index on the Hilbert curve through that grid, and the rows in curve order
are cut into runs of equal length.  Neighbouring rows are then close in every
dimension, so a file's minimum and maximum of each dimension prune well.

The global order needs no global sort: rows are dealt into curve ranges
(index, and inside a cell a hash of the id so that a hot cell is many ranges),
ranges are counted, the few counts are summed up in order, and rows are
numbered inside their own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Ranges that a curve cell is cut into by the hash of the id.
SPLITS = 256


def _tables(dims: int) -> tuple[list[int], list[int], list[int]]:
    """Per child of a cell, in binary order: its place on the curve, and per
    place the entry corner and the direction inside that child."""
    size = 1 << dims
    place = [0] * size
    for i in range(size):
        place[i ^ (i >> 1)] = i
    ones = lambda x: (x ^ (x + 1)).bit_length() - 1  # noqa: E731  trailing set bits
    entry = [0] + [(g := 2 * ((w - 1) // 2)) ^ (g >> 1) for w in range(1, size)]
    turn = [0] + [(ones(w) if w % 2 else ones(w - 1)) % dims for w in range(1, size)]
    return place, entry, turn


def hilbert_index(coords: list[Column], bits: int) -> Column:
    """Index (long) on the Hilbert curve of non-negative integer coordinates
    of ``bits`` bits each; up to 62 bits together, two dimensions at least."""
    n = len(coords)
    if n < 2 or bits < 1 or n * bits > 62:
        raise ValueError("two or more dimensions and at most 62 bits together")
    place, entry, turn = ([F.lit(x) for x in t] for t in _tables(n))
    place, entry, turn = F.array(*place), F.array(*entry), F.array(*turn)
    all_ones = F.lit((1 << n) - 1)

    def shl(x: Column, k: Column) -> Column:
        return F.call_function("shiftleft", x, k)

    def shr(x: Column, k: Column) -> Column:
        return F.call_function("shiftright", x, k)

    def step(acc: Column, bit: Column) -> Column:
        child = F.lit(0)
        for i, c in enumerate(coords):
            child = child + shl(shr(c.cast("int"), bit).bitwiseAND(F.lit(1)), F.lit(i))
        back = (acc["d"] + 1) % n
        x = child.bitwiseXOR(acc["e"])
        local = shr(x, back).bitwiseOR(shl(x, F.lit(n) - back)).bitwiseAND(all_ones)
        w = F.get(place, local)
        e = F.get(entry, w)
        turned = shl(e, back).bitwiseOR(shr(e, F.lit(n) - back)).bitwiseAND(all_ones)
        return F.struct(
            acc["e"].bitwiseXOR(turned).cast("int").alias("e"),
            ((acc["d"] + F.get(turn, w) + 1) % n).cast("int").alias("d"),
            F.shiftleft(acc["h"], n).bitwiseOR(w.cast("long")).alias("h"),
        )

    start = F.struct(F.lit(0).alias("e"), F.lit(0).alias("d"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)]), start, step, lambda acc: acc["h"])


def hashed(col: Column, bits: int) -> Column:
    """A label as a coordinate: equal labels fall together (null is a label)."""
    return F.pmod(F.xxhash64(F.coalesce(col.cast("string"), F.lit("\0null"))), F.lit(1 << bits)).cast("int")


def log_scaled(col: Column, bits: int, most: float = 2.0**31) -> Column:
    """A size as a coordinate on a logarithmic scale (null and negative: 0)."""
    top = (1 << bits) - 1
    x = F.log1p(F.greatest(F.coalesce(col.cast("double"), F.lit(0.0)), F.lit(0.0))) / F.log1p(F.lit(most))
    return F.least(F.floor(x * (top + 1)), F.lit(top)).cast("int")


def in_order(df: DataFrame, curve: str, key: str) -> DataFrame:
    """``df`` with ``rank`` (0, 1, ... along the curve, then by a hash of
    ``key``) and ``total``, without a global sort."""
    h = F.pmod(F.xxhash64(key), F.lit(SPLITS)).cast("int")
    dealt = stored(df.withColumn("_split", h), "hilbert-rows")
    counts = dealt.groupBy(curve, "_split").agg(F.count("*").alias("n"))
    # Sums in two steps, the outer one over as many rows as the curve has
    # prefixes (1024 at most), the inner one per prefix.
    top = counts.agg(F.max(curve)).first()[0] or 0
    shift = max(0, int(top).bit_length() - 10)
    counts = counts.withColumn("_prefix", F.shiftright(curve, shift))
    prefixes = counts.groupBy("_prefix").agg(F.sum("n").alias("pn"))
    before = Window.unboundedPreceding
    run = Window.orderBy("_prefix").rowsBetween(before, -1)
    prefixes = prefixes.withColumn("_base", F.coalesce(F.sum("pn").over(run), F.lit(0))).drop("pn")
    inner = Window.partitionBy("_prefix").orderBy(curve, "_split").rowsBetween(before, -1)
    starts = counts.join(prefixes, "_prefix").select(
        curve, "_split", (F.col("_base") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("_start")
    )
    total = dealt.count()
    place = Window.partitionBy(curve, "_split").orderBy(F.xxhash64(key), *[c for c in df.columns if c != curve])
    return (
        dealt.join(starts, [curve, "_split"])
        .withColumn("rank", F.col("_start") + F.row_number().over(place) - 1)
        .withColumn("total", F.lit(total).cast("long"))
        .drop("_split", "_start")
    )


def cut(df: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``slot`` from ``rank`` and ``total``: shard s takes the
    ranks from ceil(s total / shards) on, so counts differ by one at most."""
    shard = F.expr(f"(rank * {shards}L) div total").cast("int")
    first = F.expr(f"(shard * total + {shards - 1}L) div {shards}L")
    return df.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).drop("rank", "total")


def shard(
    df: DataFrame,
    dims: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = 6,
    shards: int = 16,
) -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes of the text plus 1),
    ``text_crc32`` (unsigned), ``law`` ('rows': shard counts differ by one at
    most), ``shard``, ``slot`` (gapless from 0 in a shard), ``grown_shard``
    (null under this law), ``curve`` (the Hilbert index) and ``dim_<name>``
    (the quantised coordinates).

    ``dims`` names metadata columns and how each is quantised: ``hash`` for
    labels, ``log`` for sizes; ``size`` may be named for the text's own size.
    A null text has size 1 and the check sum of an empty one; null labels are
    a label; rows with null ids and repeated rows keep a place of their own
    (equal rows are interchangeable).  An empty table gives no rows.
    """
    if not 1 <= shards <= 1 << 20:
        raise ValueError("between 1 and 2^20 shards")
    size = (F.coalesce(F.octet_length(df[text_col].cast("string")), F.lit(0)) + 1).cast("long")
    code = {"hash": hashed, "log": log_scaled}
    coords = {k: code[how](size if k == "size" else df[k], bits) for k, how in dims.items()}
    rows = df.select(
        df[id_col].alias("id"),
        size.alias("size"),
        F.crc32(F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        *[c.alias(f"dim_{k}") for k, c in coords.items()],
    )
    rows = rows.withColumn("curve", hilbert_index([F.col(f"dim_{k}") for k in coords], bits))
    out = cut(in_order(rows, "curve", "id"), shards)
    return out.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
        *[f"dim_{k}" for k in coords],
    )


def manifest(sharded: DataFrame) -> DataFrame:
    """Per shard: rows, bytes, and the least and greatest value of each
    dimension - what a reader needs to skip whole shards."""
    dims = [c for c in sharded.columns if c.startswith("dim_")]
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"),
        F.sum("size").alias("bytes"),
        *[f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))],
    )


def write_shards(df: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``df`` into a folder per shard, in curve order inside
    each file; ids must be unique and not null."""
    place = sharded.select(F.col(id_col).alias("_id"), "shard", "slot")
    rows = df.join(place, df[id_col] == F.col("_id")).drop("_id")
    rows.repartition("shard", F.expr("slot div 1000000")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("error").parquet(path)
