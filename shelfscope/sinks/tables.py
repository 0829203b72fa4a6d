"""Table writes (SK-01..07) and the persisted SCD2 load (DM-04..06).

Day tables are Parquet folders partitioned by day.  A day load replaces exactly
its own partition (dynamic partition overwrite), so a re-run is idempotent.
Row counts for the write report are collected with ``observe`` during the
write itself, not by a second pass over the data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.operators import dimension
from shelfscope.session import freed_shuffles

CODEC = "spark.sql.parquet.compression.codec"
MODES = ("append", "overwrite", "error", "ignore")


@dataclass
class WriteReport:
    """SK-07: what a write did."""

    path: str
    mode: str
    rows: int
    columns: list[str] = field(default_factory=list)
    skipped: bool = False
    source_rows: int | None = None

    @property
    def n_columns(self) -> int:
        return len(self.columns)


def _writer(df: DataFrame, mode: str, overwrite: str):
    """A writer of stored tables: Zstandard unless the session names a codec, as
    hashes (surrogate keys) and rows dealt by a hash leave the default nothing to find."""
    codec = df.sparkSession.conf.get(CODEC, None) or "zstd"
    return df.write.mode(mode).option("partitionOverwriteMode", overwrite).option("compression", codec)


def table_exists(spark: SparkSession, path: str) -> bool:
    """SK-05: a Parquet table is present at ``path``.  Only a missing path
    counts as absent; a folder that cannot be read as a table is an error, so
    no load takes it for a first run and overwrites it."""
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop):
        return False
    try:
        spark.read.parquet(path).schema  # noqa: B018 - metadata only
        return True
    except (AnalysisException, Py4JJavaError) as e:
        raise RuntimeError(f"{path} exists but is no readable table") from e


def read_table(spark: SparkSession, path: str, partition: tuple[str, str] | None = None) -> DataFrame:
    """SC-10/11: lazy scan; an optional (column, day) filter is a typed DATE
    equality so it prunes partitions at planning time."""
    df = spark.read.parquet(path)
    if partition and partition[0] in df.columns:
        col, day = partition
        df = df.filter(F.col(col) == F.lit(day).cast("date"))
    return df


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    skip_empty: bool = True,
) -> WriteReport:
    """SK-01/06/07: write with one of the four save modes.

    Only a static ``overwrite`` of an empty input would destroy data, so only
    that mode probes for a first row before writing (``skip_empty``); the
    other modes write directly and report the row count observed during the
    write, so the input plan runs once.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if skip_empty and mode == "overwrite" and df.isEmpty():
        return WriteReport(path, mode, 0, df.columns, skipped=True)
    if mode == "ignore" and table_exists(df.sparkSession, path):
        return WriteReport(path, mode, 0, df.columns, skipped=True)
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = _writer(observed, mode, "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        w.parquet(path)
    rows = int(obs.get.get("rows", 0))
    return WriteReport(path, mode, rows, df.columns, skipped=rows == 0)


def replace_partition(
    df: DataFrame,
    path: str,
    run_date: str | date,
    col: str = "ingested_at",
) -> WriteReport:
    """SK-02: replace one day partition, idempotently.

    Every row must carry ``col == run_date``; a row that does not fails the
    write job before any file is committed (the check is part of the write
    plan, not a separate pass).  Other partitions are untouched.  An empty
    input touches no partition (dynamic overwrite), so the existing day stays
    as it is without a separate emptiness probe.
    """
    d = F.lit(str(run_date)).cast("date")
    guarded = df.withColumn(
        col,
        F.when(F.col(col) == d, F.col(col)).otherwise(
            F.raise_error(F.concat(F.lit(f"row outside partition {run_date}: {col}="), F.coalesce(F.col(col).cast("string"), F.lit("null"))))
        ).cast("date"),
    )
    obs = Observation()
    out = guarded.observe(obs, F.count(F.lit(1)).alias("rows"))
    with freed_shuffles(df.sparkSession):
        _writer(out, "overwrite", "dynamic").partitionBy(col).parquet(path)
    rows = int(obs.get.get("rows", 0))
    return WriteReport(path, "overwrite", rows, df.columns, skipped=rows == 0)


def replace_partitions(df: DataFrame, path: str, col: str = "ingested_at", whole: bool = False) -> WriteReport:
    """SK-02 for a range: every day present in ``df`` is replaced in one job;
    with ``whole`` the table then holds no other day.

    Rows are range-partitioned by (day, row hash) first: each task then writes
    into one or two day folders instead of every task writing a file into
    every day (tasks x days small files), and a day holding a large share of
    the rows is still split over several tasks by the hash.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns if c != col])
    obs = Observation()
    out = df.repartitionByRange(F.col(col), spread).observe(obs, F.count(F.lit(1)).alias("rows"))
    with freed_shuffles(df.sparkSession):
        _writer(out, "overwrite", "static" if whole else "dynamic").partitionBy(col).parquet(path)
    return WriteReport(path, "overwrite", int(obs.get.get("rows", 0)), df.columns)


# ---------------------------------------------------------------- SCD2 table
#
# A stored type-2 table never rewrites what a reader may hold:
#
#   <path>/gen=G/load=L/expiry_date=D/   what load L wrote: the versions it closed,
#                                        and (null expiry) all current versions
#   <path>__log                          one row per committed load
#
# The newest log row is the pointer: its generation and load name the current
# versions, and its chain of parents the loads whose closed versions count.  A
# load writes its folder first and commits by appending its row (one file, put
# in place by one rename).  Folders without a row are not part of the table, so
# a load that was cut off leaves nothing to repair, and nothing that a later load
# or a rebuild could bring back; its folder is overwritten or vacuumed.  One
# writer at a time.

EXPIRY = "expiry_date"  # null for current versions
LOG = "seq long, generation long, load long, parent long, run_date string, columns string"


@dataclass(frozen=True)
class DimState:
    """What the newest commit of a stored type-2 table points to."""

    seq: int
    generation: int
    load: int
    run_date: str | None
    schema: T.StructType
    chain: tuple[int, ...]  # loads whose closed versions count, oldest first
    last_load: int  # greatest load number of the generation

    @property
    def before(self) -> int | None:
        """The load before this one."""
        return self.chain[-2] if len(self.chain) > 1 else None


def dim_state(spark: SparkSession, path: str) -> DimState | None:
    """SK-05: the committed state, or None for a table without a commit."""
    if not table_exists(spark, f"{path}__log"):
        return None
    log = spark.read.schema(LOG).parquet(f"{path}__log")
    newest = log.orderBy(F.desc("seq")).first()
    if newest is None:
        return None
    # one row per load since the last rebuild
    rows = log.where(F.col("generation") == newest["generation"]).select("load", "parent").collect()
    parent = {r["load"]: r["parent"] for r in rows}
    chain, load = [], newest["load"]
    while load is not None:
        chain.append(load)
        load = parent[load]
    schema = T.StructType.fromJson(json.loads(newest["columns"]))
    return DimState(newest["seq"], newest["generation"], newest["load"], newest["run_date"], schema, tuple(reversed(chain)), max(parent))


def stage_load(dim: DataFrame, path: str, generation: int, load: int, derived: Mapping[str, Column] | None = None) -> None:
    """Write the folder of a load, not yet part of the table.  Range
    partitioning by (expiry date, row hash) first keeps each task to a few
    expiry days, so files per day follow rows per day; the large current (null)
    partition is spread by the hash.  ``derived``: columns of ``dim`` that follow
    from its others; they neither travel nor are sorted, but are computed as the
    rows are written."""
    rows = dim.drop(*(derived or {}))
    spread = F.xxhash64(*[F.col(c) for c in rows.columns if c != EXPIRY])
    dealt = rows.repartitionByRange(F.col(EXPIRY), spread).sortWithinPartitions(EXPIRY)
    out = dealt.withColumns(dict(derived or {})).select(*dim.columns)
    with freed_shuffles(dim.sparkSession):
        _writer(out, "overwrite", "static").partitionBy(EXPIRY).parquet(f"{path}/gen={generation}/load={load}")


def _commit(dim: DataFrame, path: str, seq: int, generation: int, load: int, parent: int | None, run_date: str | None) -> None:
    row = [(seq, generation, load, parent, run_date, dim.schema.json())]
    dim.sparkSession.createDataFrame(row, LOG).coalesce(1).write.mode("append").parquet(f"{path}__log")


def write_dimension(
    dim: DataFrame, path: str, run_date: str | date | None = None, derived: Mapping[str, Column] | None = None
) -> None:
    """SK-03: write a whole type-2 table (first run, rebuild) as a generation
    of its own.  Its commit voids all loads of earlier generations, committed or
    not; until then readers see the old generation.  ``run_date`` is the last
    day it covers (by default that of its newest version); ``derived`` as in
    ``stage_load``."""
    was = dim_state(dim.sparkSession, path)
    seq, generation = (was.seq + 1, was.generation + 1) if was else (1, 1)
    stage_load(dim, path, generation, 0, derived)
    if run_date is None:
        staged = read_dimension(dim.sparkSession, path, state=DimState(seq, generation, 0, None, dim.schema, (0,), 0))
        run_date = staged.agg(F.max("effective_date")).first()[0]
    _commit(dim, path, seq, generation, 0, None, None if run_date is None else str(run_date))


def read_dimension(
    spark: SparkSession, path: str, current_only: bool = False, state: DimState | None = None, as_of_load: int | None = None
) -> DataFrame:
    """The committed state of a stored type-2 table (``as_of_load``: as it was
    after that load of the chain).  Which loads count and whether a version is
    current are partition filters, so ``current_only`` scans one folder."""
    state = state or dim_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"{path} holds no committed type-2 table")
    load = state.load if as_of_load is None else as_of_load
    columns = [f for f in state.schema.fields if f.name != EXPIRY]
    folders = [T.StructField("gen", T.LongType()), T.StructField("load", T.LongType()), T.StructField(EXPIRY, T.DateType())]
    rows = spark.read.schema(T.StructType(columns + folders)).parquet(path).where(F.col("gen") == state.generation)
    current = F.col(EXPIRY).isNull() & (F.col("load") == load)
    loads = list(state.chain[: state.chain.index(load) + 1])
    keep = current if current_only else current | (F.col(EXPIRY).isNotNull() & F.col("load").isin(loads))
    return rows.where(keep).select(*state.schema.names)


def vacuum_dimension(spark: SparkSession, path: str) -> list[str]:
    """Delete what no state of the chain holds: other generations and loads
    outside the chain.  Returns the deleted folders."""
    state = dim_state(spark, path)
    gone = []
    for gen in folders(spark, path) if state else []:
        if gen != f"gen={state.generation}":
            gone.append(f"{path}/{gen}")
            continue
        gone += [f"{path}/{gen}/{x}" for x in folders(spark, f"{path}/{gen}") if int(x.split("=")[1]) not in state.chain]
    for folder in gone:
        delete_folder(spark, folder)
    return gone


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted (none if it does not exist)."""
    fs, hadoop = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory()) if fs.exists(hadoop) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    fs.delete(hadoop, True)


def scd2_load_day(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    run_date: str | date,
    keys: Sequence[str] = dimension.PRODUCT_KEYS,
    sk: str = "product_sk",
    allow_backfill: bool = False,
    update_untracked: bool = False,
) -> dict:
    """DM-04/05/06 + SK-03/04/05 + DM-09: load one day into the stored type-2
    dimension.

    A load reads the current versions only and writes the new current ones and
    those it closed, then commits.  Loading the day of the newest load again
    starts from the state before that load, so corrected data replaces it whole
    (the day of a first run or rebuild has no state before it: it is applied on
    top).  An older day would invert history and is refused unless
    ``allow_backfill``; rebuild with ``scd2_rebuild`` instead.
    """
    run_date = str(run_date)
    if incoming.isEmpty():
        return {"skipped": True, "total_rows": None, "current_rows": None}
    state = dim_state(spark, path)
    if state is None:
        write_dimension(dimension.scd2_first_run(incoming, keys, sk), path, run_date)
    else:
        newest = state.run_date or run_date
        if newest > run_date and not allow_backfill:
            raise ValueError(f"run_date {run_date} is older than the newest load {newest}; use scd2_rebuild")
        again = newest == run_date and state.before is not None
        parent = state.before if again else state.load
        current = read_dimension(spark, path, current_only=True, state=state, as_of_load=parent)
        load = state.last_load + 1
        stage_load(dimension.scd2_apply(current, incoming, run_date, keys, sk, update_untracked), path, state.generation, load)
        _commit(current, path, state.seq + 1, state.generation, load, parent, max(run_date, newest))
    totals = dimension.dim_totals(read_dimension(spark, path)).first()
    return {"skipped": False, "total_rows": totals["total_rows"], "current_rows": totals["current_rows"]}
