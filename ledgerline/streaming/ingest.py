"""Structured Streaming ingest of one source's inbound folder into Bronze.

The stream carries file records (path, size, time), not rows: ``trigger(availableNow=True)`` takes
every file not yet seen (the checkpoint records them) and stops.  Each micro-batch hands
its files to the batch load, so that headers, column orders, file types, rejected and empty files are treated
alike, and both write one registry: what the stream has taken a batch load doesn't take
again, and the other way round.  Scans leave out zero-byte files; each batch lists those.

Spark may hand a batch over again after a failure.  The load's GUID therefore
follows from the query and the batch number: a repeat overwrites the Bronze
partition of its first try, and adds quarantined rows and dispositions only where
the first try recorded none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.layout import Layout
from ledgerline.plans.bronze import load_files_to_bronze, source_configuration
from ledgerline.plans.runlog import RunLog
from ledgerline.sources import config as config_source
from ledgerline.sources.files import LISTING_SCHEMA, mkdirs, qualify
from ledgerline.sources.inbound import discover, with_source

FILE_RECORD = "path string, modificationTime timestamp, length bigint, content binary"


def batch_guid(query_id: str, batch_id: int) -> str:
    """The same for every try of a batch; another query's batches get other ones."""
    return str(uuid.uuid5(uuid.UUID(query_id), str(batch_id)))


def file_records(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    """A stream of the files of a source, as ``discover`` lists them; contents are not read."""
    mkdirs(spark, f"{layout.bronze_inbound}/{source}")
    root = qualify(spark, layout.bronze_inbound).rstrip("/") + "/"
    files = spark.readStream.format("binaryFile").schema(FILE_RECORD).option("recursiveFileLookup", True) \
        .load(f"{layout.bronze_inbound}/{source}")
    path = F.regexp_replace("path", r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
    files = files.select(path.alias("path"), path.alias("uri"), F.substring(path, len(root) + 1, 1 << 20).alias("relative"),
                         F.regexp_extract(path, "([^/]*)$", 1).alias("file_name"), F.col("length").alias("size"),
                         F.unix_millis("modificationTime").alias("modified"))
    return with_source(files.select(*[f.name for f in LISTING_SCHEMA.fields]))


def start_bronze_stream(spark: SparkSession, layout: Layout, source: str,
                        available_now: bool = True) -> StreamingQuery:
    cf, cc = config_source.load(spark, layout.admin)
    if source_configuration(cf, cc).where((F.col("Source") == source) & F.col("expected").isNotNull()).isEmpty():
        raise ValueError(f"no configuration for source {source!r}")

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        guid = batch_guid(spark.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        empty = discover(spark, layout.bronze_inbound, source).where(F.col("size") == 0)
        log = RunLog("stream")
        load_files_to_bronze(spark, layout, log, source=source, listed=batch.unionByName(empty), guid=guid)
        log.write(spark, layout.log)

    writer = (file_records(spark, layout, source).writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", f"{layout.admin}/_streams/{source}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
