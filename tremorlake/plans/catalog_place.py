"""Registered queries of the tables in place: the stream, its revisions and the run summaries at batch cost."""

from __future__ import annotations

from ..session import scratch_path
from ..sources import sinks as SINK
from ..sources import tables as T
from ..schema import TSUNAMI_COLUMNS
from . import jobs
from . import oracle as O
from .catalog import _RUNS_SQL, ORACLE, STAMP_1, _doubles, _halves, register
from .catalog_more import revised_feeds


@register("stream_intake_in_place", ORACLE["stream_intake"])
def q_stream_intake_in_place(spark, sf_dir):
    """Three micro-batches; each writes only its own dates of the raw, curated and tsunami tables."""
    from ..streaming.intake import stream_feed

    src, root = scratch_path(spark, "landed"), scratch_path(spark, "tables")
    docs = SINK.feed_documents(T.derived_raw(spark, sf_dir, T.AS_OF))
    files = SINK.land_in_batches(docs, src, 3, T.table(spark, sf_dir, "events").count())
    stream_feed(spark, src, root, multi_line=False, max_files_per_trigger=files, stamp=T.AS_OF, in_place=True).awaitTermination()
    return _doubles(spark.read.parquet(f"{root}/final").select("usgs_id", *O.FINAL_DATA))


@register("stream_intake_revisions_in_place", ORACLE["stream_intake_revisions"])
def q_stream_intake_revisions_in_place(spark, sf_dir):
    root = revised_feeds(spark, sf_dir, in_place=True)
    return _doubles(spark.read.parquet(f"{root}/final").select("usgs_id", *O.FINAL_DATA))


@register("tsunami_events_in_place", "SELECT usgs_id, mag, place, time, depth, longitude, latitude FROM (" + ORACLE["stream_intake_revisions"] + ") _f WHERE tsunami = 1")
def q_tsunami_events_in_place(spark, sf_dir):
    """K5 kept from the changed rows of each batch, after two runs with revisions."""
    root = revised_feeds(spark, sf_dir, in_place=True)
    return _doubles(spark.read.parquet(f"{root}/tsunami").select(*[c for c in TSUNAMI_COLUMNS if c != "id"]))


@register("run_summaries_in_place", _RUNS_SQL + " WHERE usgs_id IN (SELECT usgs_id FROM bat)")
def q_run_summaries_in_place(spark, sf_dir):
    """A batch's own keys are read: rows that were dropped for their coordinates are not read again with every batch."""
    cur, bat = _halves(spark, sf_dir)
    root = scratch_path(spark, "runs")
    raw_dir, final_dir, tsunami_dir = (f"{root}/{t}" for t in ("raw", "final", "tsunami"))
    rows = []
    for version, batch, stamp in ((1, cur, T.AS_OF), (2, bat, STAMP_1)):
        ing = jobs.ingest_in_place(spark, batch, raw_dir, stamp=stamp)
        done = jobs.curate_pending(spark, raw_dir, final_dir, tsunami_dir, stamp=stamp)
        rows.append((version, "ingest", "upsert", ing["events"], ing["events"], ing["inserted"]))
        rows.append((version, "curate", done["mode"], done["read"], done["transformed"], done["loaded"]))
    return spark.createDataFrame(rows, "version int, stage string, mode string, read long, transformed long, loaded long")
