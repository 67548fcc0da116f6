"""Incremental loads with Structured Streaming.

New feed files dropped into a folder are picked up by a file stream; each
micro-batch runs the same extend/upsert steps as a batch run
(``load_app_records`` / ``load_permission_rows``), so

* lookup and dimension ids stay stable across batches (extend, never
  renumber), APP is upserted by ``App_Id`` and the bridge appended with its
  key enforced;
* a micro-batch replayed after a failure (the stream's checkpoint records
  which files were committed) yields the same tables, since every step is
  idempotent -- foreachBatch's at-least-once delivery becomes exactly-once
  table contents.

``trigger(availableNow=True)`` processes whatever has arrived and stops,
which is how a daily scheduled load runs; a processing-time trigger keeps
the stream running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.app_store import (NAMES, Options, keep_rejects, load_app_records, load_fact_layer,
                               load_permission_rows, refresh_fact_layer)
from ..sources.lake import table_exists
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.documents import CORRUPT, PERMISSION_SCHEMA, explode_documents, split_corrupt
from ..sources.text import APP_COLUMNS, APP_HEADER_PREFIX, parse_quoted_lines


def _refresh_fact(spark: SparkSession, root: str, opts: Options) -> None:
    """Bring APP_FACT up to its three inputs once they all exist: the touched
    groups only with ``opts.fact_buckets``, else the whole fact.

    One stream should refresh it: of two that publish the fact at once, one
    fails (and its batch runs again)."""
    inputs = (NAMES.app, NAMES.app_permission, NAMES.permission)
    if all(table_exists(spark, f"{root.rstrip('/')}/{n}") for n in inputs):
        if opts.fact_buckets:
            refresh_fact_layer(spark, root, opts.fact_buckets)
        else:
            load_fact_layer(spark, root)


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool,
           interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stream_app_feed(spark: SparkSession, feed_dir: str, root: str, checkpoint: str,
                    opts: Options = Options(), refresh_fact: bool = False,
                    available_now: bool = True, interval: str | None = None,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Incrementally load app feed files (quoted lines) into the lake."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(feed_dir).select("value", F.col("_metadata.file_path").alias("file"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        records, rejects = parse_quoted_lines(batch, APP_COLUMNS, APP_HEADER_PREFIX)
        load_app_records(batch.sparkSession, records, root, opts)
        keep_rejects(rejects, f"{root.rstrip('/')}/{NAMES.app_rejects}")
        if refresh_fact:
            _refresh_fact(batch.sparkSession, root, opts)

    return _start(lines, handle, checkpoint, available_now, interval)


def stream_permission_feed(spark: SparkSession, feed_dir: str, root: str, checkpoint: str,
                           opts: Options = Options(), refresh_fact: bool = False,
                           available_now: bool = True, interval: str | None = None,
                           multiline: bool = True) -> StreamingQuery:
    """Incrementally load permission documents (JSON) into the lake."""
    whole = StructType([*PERMISSION_SCHEMA.fields, StructField(CORRUPT, StringType())])
    docs = (spark.readStream.schema(whole).option("multiLine", multiline)
            .option("columnNameOfCorruptRecord", CORRUPT).json(feed_dir)
            .select("*", F.col("_metadata.file_path").alias("file")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        whole, rejects = split_corrupt(batch)
        perms = explode_documents(whole, "allPermissions", ["appId", "appName"])
        load_permission_rows(batch.sparkSession, perms, root, opts)
        keep_rejects(rejects, f"{root.rstrip('/')}/{NAMES.permission_rejects}")
        if refresh_fact:
            _refresh_fact(batch.sparkSession, root, opts)

    return _start(docs, handle, checkpoint, available_now, interval)
