"""Continuous raw ingest with Structured Streaming.

The batch jobs are triggered per day; this is the streaming form of the
bronze step (PL-01): a file source watches the raw folders, each micro-batch
decodes the new envelopes and the Parquet file sink appends them partitioned by
day.  The sink's commit log makes the append exactly-once across restarts and
lost executors; the downstream day jobs read the bronze partitions as usual.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfscope.sources import raw


def _tagged(spark, raw_root, source, record, lift, layout, multi_line, max_files_per_trigger) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    text = reader.text(raw.raw_path(raw_root, source, None, layout), wholetext=multi_line)
    rows = raw.tagged(text.select("value", F.col("_metadata.file_path").alias(raw.LINEAGE)), record, lift)
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("date"))


def start_ingest_stream(
    spark: SparkSession,
    raw_root: str,
    source: str,
    record: T.StructType,
    lift: Mapping[str, str],
    path: str,
    checkpoint: str,
    layout: str = "{root}/{source}/{date}",
    multi_line: bool = True,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """SC-07 in one pass: every product and every envelope without products as
    tagged rows of one Parquet table, partitioned by status and day; read the
    sides with ``read_ingested``.

    ``available_now`` processes every file present and stops (scheduled
    catch-up); otherwise the query keeps running and picks up new files.
    """
    rows = _tagged(spark, raw_root, source, record, lift, layout, multi_line, max_files_per_trigger)
    return _start(rows.writeStream.partitionBy(raw.STATUS, "ingested_at"), path, checkpoint, available_now)


def read_ingested(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, quarantined texts) of an ingest stream's table; the status
    is a partition, so each side scans only its folders."""
    rows = spark.read.parquet(path)
    return raw.kept(rows), raw.quarantined(rows)


def start_bronze_stream(
    spark: SparkSession,
    raw_root: str,
    source: str,
    record: T.StructType,
    lift: Mapping[str, str],
    bronze_path: str,
    checkpoint: str,
    layout: str = "{root}/{source}/{date}",
    multi_line: bool = True,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """The raw -> bronze stream alone: the kept rows, partitioned by day."""
    rows = raw.kept(_tagged(spark, raw_root, source, record, lift, layout, multi_line, max_files_per_trigger))
    return _start(rows.writeStream.partitionBy("ingested_at"), bronze_path, checkpoint, available_now)


def _start(writer, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
