"""Continuous intake of landed feed files (S7) with Structured Streaming.

readStream (explicit schema, one document per file or per line) -> explode
features -> strict flatten -> foreachBatch(raw upsert -> incremental curate ->
tsunami refresh).  Rows of a later feed win: rows carry their file's time and
path and their place in it, whatever order tasks read them in.

Every micro-batch writes the next table version after the newest complete one
and marks it with the stream's name and the epoch.  A replayed epoch finds its
own version by the mark and writes that one again; a new stream on an old table
goes on after its newest version.  With ``in_place`` the tables are kept by date
instead and a micro-batch writes only its own dates (``jobs.ingest_in_place``,
``jobs.curate_pending``); a replayed epoch finds its rows unchanged.  The stream's checkpoint lies beside the tables
unless another place is given, so a restart goes on where the last run ended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import jobs
from ..schema import FEED_SCHEMA
from ..sources import sinks as SINK
from ..sources.feed import exploded, flatten


def feed_stream(spark: SparkSession, source_dir: str, multi_line: bool = True,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(FEED_SCHEMA).option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten(exploded(reader.json(source_dir)), strict=True, tracked=True)


def stream_feed(spark: SparkSession, source_dir: str, table_root: str, checkpoint: str | None = None,
                multi_line: bool = True, available_now: bool = True, max_files_per_trigger: int | None = None,
                stamp=None, in_place: bool = False) -> StreamingQuery:
    """Start the intake stream; tables live under ``table_root``/{raw,final,tsunami}."""
    raw_dir, final_dir, tsu_dir = (f"{table_root.rstrip('/')}/{t}" for t in ("raw", "final", "tsunami"))
    checkpoint = checkpoint or f"{table_root.rstrip('/')}/_stream"
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def process(batch: DataFrame, epoch_id: int) -> None:
        mark = f"_epoch-{stream}-{epoch_id}"
        version = SINK.marked_version(spark, raw_dir, mark)
        if version is None:
            version = max([0, *SINK.versions(spark, raw_dir), *SINK.versions(spark, final_dir)]) + 1
        jobs.ingest_batch(spark, batch, raw_dir, version, stamp=stamp)
        SINK.mark_version(spark, raw_dir, version, mark)
        jobs.curate(spark, raw_dir, final_dir, tsu_dir, version, stamp=stamp)

    def process_in_place(batch: DataFrame, epoch_id: int) -> None:
        jobs.ingest_in_place(spark, batch, raw_dir, stamp=stamp)
        jobs.curate_pending(spark, raw_dir, final_dir, tsu_dir, stamp=stamp)

    writer = feed_stream(spark, source_dir, multi_line, max_files_per_trigger).writeStream.foreachBatch(process_in_place if in_place else process)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="12 hours")
    return writer.start()
