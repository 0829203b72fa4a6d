"""SimHash near-duplicates by tiled exact comparison.

Fingerprints that occur are compared all against all, exactly, but in tiles: a
fingerprint belongs to the tile class of the population counts of its four
16-bit quarters.  Two fingerprints within ``radius`` bits have quarter counts
that differ by at most ``radius`` in sum, so tile pairs beyond that are never
formed.  Classes are cut into blocks of about ``block`` fingerprints; a tile
pair is one exclusive-or and bit count over two numpy arrays and gives back a
spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components

SEED = 42
#: Shingles hashed at a time, and fingerprint pairs compared at a time.
SHINGLE_RUN = 1 << 16
PAIR_RUN = 1 << 20
#: Tiles of a class that one task compares with the tiles of other classes.
GROUP_TILES = 8


def fingerprint(text: str, words: int = 3) -> int:
    """Unsigned 64-bit SimHash: A-Z lower-cased, words between ASCII blanks,
    ``words``-word shingles with repeats (a shorter text is one shingle, no
    word at all gives 0), XXH64, majority per bit."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    stops = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, SHINGLE_RUN):
        h = [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[i : min(n, i + SHINGLE_RUN)].tolist(), stops[i : i + SHINGLE_RUN].tolist())]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text_col: str, out: str, words: int = 3) -> DataFrame:
    """``df`` with a long column ``out`` (the fingerprint's 64 bits); a null
    text counts as empty."""
    common.ship(df.sparkSession)
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py() or "", words) for t in b.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def _offsets(radius: int) -> list[int]:
    """Steps between the codes of tile classes to compare, each unordered
    pair of classes once.  A class code has six bits for each count, shifted
    so that no step borrows from the next count."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]
    return [sum(x << (6 * (3 - i)) for i, x in enumerate(d)) for d in steps]


def _class_code(radius: int) -> F.Column:
    code = F.lit(0)
    for q in range(4):
        count = F.bit_count(F.shiftrightunsigned(F.col("fp"), 16 * (3 - q)).bitwiseAND(F.lit(0xFFFF)))
        code = code + F.shiftleft(count + F.lit(radius + 1), 6 * (3 - q))
    return code.cast("int")


def _forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between (or, if ``same``, within) two
    arrays of fingerprints."""
    nodes = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    label = np.arange(len(nodes))
    out = []
    rows = max(1, PAIR_RUN // max(1, len(b)))
    for i in range(0, len(a), rows):
        close = np.bitwise_count(a[i : i + rows, None] ^ b[None, :]) <= radius
        for r in np.flatnonzero(close.any(axis=1)):
            at = i + r
            hit = np.flatnonzero(close[r]) + shift
            groups = np.unique(label[hit])
            groups = groups[groups != label[at]]
            for g in groups:
                out.append((int(nodes[at]), int(nodes[g])))
            if len(groups):
                label[np.isin(label, groups)] = label[at]
    return out


def links(fps: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """Edges (a, b) between distinct values of the long column ``fp`` that
    join exactly those within ``radius`` bits into the same components."""
    if not 0 <= radius <= 16:
        raise ValueError("radius must lie between 0 and 16")
    common.ship(fps.sparkSession)
    cells = fps.select("fp").withColumn("cell", _class_code(radius))
    parts = cells.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    tiles = common.stored(
        cells.join(parts, "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"))
        .agg(F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    # A class meets its neighbour classes group by group of its tiles, so the
    # largest class is the work of many tasks.
    group = F.floor(F.col("part") / F.lit(GROUP_TILES)).cast("int").alias("group")
    groups = tiles.select("cell", group).distinct()
    steps = tiles.select(F.col("cell").alias("_from")).distinct().withColumn("step", F.explode(F.array(*map(F.lit, _offsets(radius)))))
    reach = steps.select("_from", (F.col("_from") + F.col("step")).cast("int").alias("cell"), (F.col("step") == 0).alias("own")).join(groups, "cell")
    guests = tiles.select(F.col("cell").alias("_from"), F.col("part").alias("_part"), F.col("fps").alias("others")).join(reach, "_from").drop("_from")
    pairs = (
        tiles.select("*", group).join(guests, ["cell", "group"])
        .where(~F.col("own") | (F.col("_part") >= F.col("part")))
        .select("fps", "others", (F.col("own") & (F.col("_part") == F.col("part"))).alias("same"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            found = []
            for i, same in enumerate(batch.column(2).to_pylist()):
                a = left[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = right[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                found += _forest(a, b, radius, same)
            got = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def classes(fps: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """(fp, root): every distinct fingerprint of ``fps`` (column ``fp``, long)
    and the smallest fingerprint (as a signed number) of its component."""
    distinct = common.stored(fps.select("fp").distinct(), "simhash-fps")
    joined = components(links(distinct, radius, block))
    return distinct.join(joined, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3, block: int = 2048) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 lower-case hex digits)
    and ``component_id``, the smallest id that links of at most ``radius``
    bits reach.

    Null and empty texts have fingerprint 0 and link like any other.  Null
    ids keep their row and their links; a component without any id has a null
    ``component_id``.  Repeated rows stay, with equal results.  Other columns
    are not read.
    """
    narrow = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    docs = common.stored(with_fingerprints(narrow, "text", "fp", words).select("id", "fp"), "simhash-docs")
    roots = classes(docs, radius, block)
    smallest = docs.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    known = smallest.join(roots, "fp")
    best = known.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = common.stored(known.join(best, "root").select("fp", "component_id", "n"), "simhash-components")
    return common.join_by_key(docs, by_fp, ["fp"], "n", docs.count()).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3, block: int = 2048) -> DataFrame:
    """The rows of ``df`` with one row of each near-duplicate group left: the
    one with the smallest id (rows with an id go before rows without), and of
    repeated rows any one.  Columns stay as they are."""
    fp = "__simhash_fp"
    wide = common.stored(with_fingerprints(df, text_col, fp, words), "simhash-wide")
    ids = wide.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"))
    roots = classes(ids, radius, block)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"))
    first = ids.groupBy("fp").agg(F.min(order).alias("k")).join(roots, "fp").groupBy("root").agg(F.min("k").alias("k"))
    winners = first.select(F.col("k.fp").alias("_wfp"), F.col("k.id").alias("_wid"))
    kept = wide.join(winners, (F.col(fp) == F.col("_wfp")) & F.col(id_col).eqNullSafe(F.col("_wid")), "left_semi")
    return kept.dropDuplicates([fp, id_col]).select(*df.columns)
