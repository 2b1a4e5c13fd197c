"""Incremental file ingest (T1-T3) with Structured Streaming.

The reference reacts to an object-created event and processes the new file.  The
Spark form is a file stream: the checkpoint's file log remembers which files were
processed (T2, nothing is ingested twice, a restarted query resumes), and
``trigger(availableNow=True)`` drains whatever has landed and stops, so the same job
runs as a scheduled batch or as a long-running stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.dates import date_from_path
from cinelake.plans.trusted import trusted_details
from cinelake.sources.schemas import RAW_DETAILS_SCHEMA
from cinelake.streaming.landing import LandingTarget, with_source_file


def _reader(spark: SparkSession, schema: T.StructType | str, fmt: str, glob: str | None, max_files: int | None, options: dict):
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    for k, v in options.items():
        r = r.option(k, v)
    return r


def stream_ingest(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | str,
    out_dir: str,
    checkpoint_dir: str,
    fmt: str = "json",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Ingest every file that has landed (once each) into Parquet; returns the
    ingested table as a batch DataFrame."""
    stream = _reader(spark, schema, fmt, glob, max_files_per_trigger, options).load(source_dir)
    if transform is not None:
        stream = transform(stream)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(out_dir)
    query.awaitTermination()
    return spark.read.parquet(out_dir)


def stream_dedup(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | str,
    keys: Sequence[str],
    out_dir: str,
    checkpoint_dir: str,
    fmt: str = "json",
    watermark: tuple[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """De-duplicate by key across arriving batches.  Without a watermark the
    state keeps every key seen (grows with distinct keys); with (event-time column,
    delay) ``dropDuplicatesWithinWatermark`` evicts keys older than the watermark."""
    stream = _reader(spark, schema, fmt, None, max_files_per_trigger, options).load(source_dir)
    if watermark:
        col, delay = watermark
        stream = stream.withWatermark(col, delay).dropDuplicatesWithinWatermark(list(keys))
    else:
        stream = stream.dropDuplicates(list(keys))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out_dir)
    )
    query.awaitTermination()
    return spark.read.parquet(out_dir)


def idempotent_partition_writer(target: str, partition_by: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """T2 for foreachBatch: each micro-batch overwrites only the partitions it holds
    (dynamic partition overwrite), so a retried batch replaces instead of appending."""

    def write(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001 - foreachBatch signature
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(target)
        )

    return write


def stream_with_batches(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | str,
    checkpoint_dir: str,
    batch_fn: Callable[[DataFrame, int], None],
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
    **options,
) -> None:
    """Run ``batch_fn`` on each micro-batch of newly landed files (foreachBatch)."""
    stream = _reader(spark, schema, fmt, None, max_files_per_trigger, options).load(source_dir)
    query = (
        stream.writeStream.foreachBatch(batch_fn)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_trusted_details(
    spark: SparkSession,
    raw_dir: str,
    trusted_dir: str,
    checkpoint_dir: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The event-triggered enrichment landing as a stream: every newly landed JSON
    file under ``raw_dir`` (dated folders) is cleaned with the trusted-details rules
    and equals what the batch job makes of all files so far.

    The target remembers its source files and records (``LandingTarget``), so a lost checkpoint, a
    replayed batch or another number of files a trigger changes nothing, duplicates are removed across
    files and batches, and a batch reads only the dates it holds."""
    schema = schema or RAW_DETAILS_SCHEMA
    stream = _reader(spark, schema, "json", None, max_files_per_trigger, {"recursiveFileLookup": True})
    stream = with_source_file(stream.load(raw_dir)).withColumn("extraction_date", date_from_path(F.col("source_file")))
    target = LandingTarget(spark, trusted_dir)

    def batch(df: DataFrame, epoch_id: int) -> None:  # noqa: ARG001 - foreachBatch signature
        target.land(df, lambda rows: trusted_details(rows, stamp=False), schema.fieldNames())

    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return target.rows()
