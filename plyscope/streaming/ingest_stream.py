"""The daily incremental load as a Structured Streaming job over the landing folder.

The file source's checkpoint remembers which archive files were already read (it replaces the
archive-URL high-water mark); the per-player ``end_time``
high-water mark of what is already stored (S8) is taken once, when the run starts, and written to the
shared folder; each micro-batch is parsed, filtered against it and appended as a dated snapshot, with its rejects and
an account of its files beside it.
A run may therefore be split into any number of micro-batches, in any order of months.
``trigger(availableNow=True)`` gives the daily-batch behaviour: read what landed, then stop.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope import schemas
from plyscope.session import checkpoint_dir
from plyscope.sources import ingest, quarantine


def line_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed archive lines as a stream: file, username, archive, value."""
    reader = spark.readStream.schema(quarantine.LINES_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(landing).select(F.col("_metadata.file_path").alias("file"), "username", "archive", "value")


def ingest_stream(spark: SparkSession, landing: str, games_root: str, checkpoint: str,
                  archive_base: str = ingest.ARCHIVE_BASE, clock=None, files_per_batch: int | None = None):
    """Start the stream; returns the StreamingQuery (call ``awaitTermination()``)."""
    clock = clock or _dt.datetime.now
    marks = f"{checkpoint_dir(spark)}/marks-{uuid.uuid4().hex}"
    ingest.load_history(ingest.read_snapshots(spark, games_root, schemas.GAMES)).write.parquet(marks)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        now = clock()
        history = batch.sparkSession.read.schema(schemas.HISTORY).parquet(marks)
        ingest.append_lines(batch, history, games_root, now, f"{ingest.load_suffix(now)}_{epoch_id}", archive_base)

    return (line_stream(spark, landing, files_per_batch).writeStream
            .foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
