"""Batch jobs over versioned tables: ingest (feed -> raw) and curate (raw -> final).

The first two keep versions; those at the end keep tables in place, by date, at
the cost of the batch (``sources.place``).

Each run reads the newest complete version, computes the next one as a pure
DataFrame plan and writes it to a new version folder; rerunning a version
rewrites the same folder from the same inputs, so a lost executor or a replay
does not duplicate anything.  Returned dicts are the run summaries (K9); the
row counts ride on the jobs that run anyway (Observation metrics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import upsert as U
from ..operators.clean import clean
from ..operators.constraints import check_schema, observed, require, require_observed, row_checks
from ..schema import (CURATE_INPUT_COLUMNS, FINAL_SCHEMA, FINAL_TEXT_LIMITS, RAW_COLUMNS, RAW_SCHEMA, RAW_TEXT_LIMITS,
                      RAW_UPDATE_COLUMNS)
from ..sources import place as PLACE
from ..sources import sinks as SINK
from ..session import broadcast_checked
from ..sources.feed import ARRIVAL, UNFIT, in_arrival_order
from ..sources.tables import read_raw, ts_literal


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def ingest_batch(spark: SparkSession, batch: DataFrame, raw_dir: str, version: int, stamp=None) -> dict:
    """K1 + K9: upsert one flattened feed batch into the raw table.

    With ARRIVAL in the batch, later feeds win.  A batch with values that do not
    fit the table (UNFIT), or with a text over its limit, is not loaded: the job
    raises, as the load into a database would."""
    stamp_col = ts_literal(stamp)
    current = SINK.read_latest(spark, raw_dir, before=version)
    fresh = current is None
    folded, read = _folded(batch, stamp_col)
    new_raw = U.raw_upsert(_empty(spark, RAW_SCHEMA) if fresh else current, folded, stamp=stamp_col, folded=True, fresh=fresh)
    SINK.write_version(new_raw, raw_dir, version)
    return {"events": read, "inserted": read, "version": version}


def _folded(batch: DataFrame, stamp: Column) -> tuple[DataFrame, int]:
    """A feed batch with one row per key, and its number of rows.  One pass parses,
    checks, counts and folds; a batch that breaks constraints raises."""
    numeric = {c: t.simpleString() for c, t in RAW_COLUMNS if isinstance(t, (T.DecimalType, T.IntegerType))}
    checks, order = row_checks(batch, "usgs_id", RAW_TEXT_LIMITS, numeric), None
    if ARRIVAL in batch.columns:
        batch, order = in_arrival_order(batch), F.col(ARRIVAL)
    seen = Observation("ingest")
    batch = batch.observe(seen, F.count(F.lit(1)).alias("rows"), *observed(checks)).drop(UNFIT).withColumn("ingested_at", stamp)
    folded = U.fold_batch(batch, "usgs_id", RAW_UPDATE_COLUMNS, order).checkpoint()
    require_observed(checks, seen.get, "raw")
    return folded, seen.get["rows"]


def curate(spark: SparkSession, raw_dir: str, final_dir: str, tsunami_dir: str, version: int,
           full: bool = False, stamp=None) -> dict:
    """J1 + clean + K2/K3 + K5 + K9: bring the curated table up to the newest raw version."""
    stamp_col = ts_literal(stamp)
    raw = SINK.read_latest(spark, raw_dir, before=version + 1)
    final = SINK.read_latest(spark, final_dir, before=version)
    if raw is None:
        return {"mode": "full" if full else "incremental", "read": 0, "transformed": 0, "loaded": 0}
    if full or final is None:
        todo = read_raw(raw)
    else:
        todo = U.changed(raw, final).select(*CURATE_INPUT_COLUMNS)
    seen = Observation("curate")
    todo = todo.observe(seen, F.count(F.lit(1)).alias("rows"))
    cleaned = clean(todo).checkpoint(eager=True)   # one job reads, cleans and counts
    read = seen.get["rows"]
    transformed = cleaned.count()                  # a count over the checkpoint
    if transformed == 0:
        return {"mode": "full" if full else "incremental", "read": read, "transformed": 0, "loaded": 0}
    if final is None:
        new_final = U.first_load(cleaned, stamp=stamp_col)
    else:
        new_final = U.curated_upsert(final, cleaned, stamp=stamp_col)
    new_final = new_final.withColumn("event_date", F.to_date("time"))
    require(check_schema(cleaned, "usgs_id", FINAL_TEXT_LIMITS), "curated")
    SINK.write_version(new_final, final_dir, version, partition_by=["event_date"],
                       sort_within=SINK.spatial_sort_keys() + [F.col("time")], bloom_columns=["usgs_id"])
    latest = SINK.read_latest(spark, final_dir)
    SINK.write_version(U.refresh_tsunami(latest), tsunami_dir, version, sort_within=[F.col("time").desc()])
    return {"mode": "full" if full else "incremental", "read": read, "transformed": transformed,
            "loaded": transformed, "version": version}


# --- Tables in place: a batch reads and rewrites only its own keys and dates -----------------------

_DATE = T.StructField("event_date", T.DateType())
_RAW_KEYS = T.StructType([RAW_SCHEMA["usgs_id"], _DATE])
_FINAL_KEYS = T.StructType([RAW_SCHEMA["usgs_id"], RAW_SCHEMA["updated"], RAW_SCHEMA["time"], _DATE])
_PENDING = T.StructType([RAW_SCHEMA["usgs_id"], T.StructField("batch", T.LongType())])
_DATED_RAW = T.StructType([*RAW_SCHEMA.fields, _DATE])
_DATED_FINAL = T.StructType([*FINAL_SCHEMA.fields, _DATE])


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("time"))


def _layout() -> list:
    return SINK.spatial_sort_keys() + [F.col("time")]


def _pending_path(raw_dir: str) -> str:
    return f"{raw_dir}/{PLACE.STATE}/pending"


def ingest_in_place(spark: SparkSession, batch: DataFrame, raw_dir: str, stamp=None, buckets: int = PLACE.BUCKETS) -> dict:
    """K1 + K9 over a raw table that is kept in place, partitioned by event date.

    The key index names the dates on which the batch's keys stand; these and the
    batch's own dates are read and written again, all other files stay.  The
    batch's keys are left in the same commit for ``curate_pending``, which may
    run at any later time.  Constraints are checked as in ``ingest_batch``.
    """
    raw_dir, stamp_col = raw_dir.rstrip("/"), ts_literal(stamp)
    PLACE.finish(spark, raw_dir)
    state = PLACE.numbers(spark, raw_dir) or {"buckets": buckets, "batch": 0}
    folded, read = _folded(batch, stamp_col)
    keys = _dated(folded).select("usgs_id", "event_date")
    known = PLACE.index_rows(spark, raw_dir, _RAW_KEYS, keys, "usgs_id", state["buckets"])
    known = known.join(broadcast_checked(keys.select("usgs_id")), "usgs_id", "left_semi").select("usgs_id", "event_date").checkpoint()
    dates = PLACE.distinct_values(known.select("event_date").unionByName(keys.select("event_date")), "event_date")
    if not dates:
        return {"events": read, "inserted": read, "dates": []}
    touched = PLACE.read(spark, raw_dir, _DATED_RAW).filter(PLACE.within("event_date", dates)).drop("event_date")
    fresh = not {PLACE.folder("event_date", d) for d in dates} & set(PLACE.folders(spark, raw_dir))
    merged = _dated(U.raw_upsert(touched, folded, stamp=stamp_col, folded=True, fresh=fresh))
    was = known.select("usgs_id", F.struct("event_date").alias("was"))
    placed = keys.join(was, "usgs_id", "left").filter(F.col("was").isNull() | ~F.col("event_date").eqNullSafe(F.col("was.event_date"))).drop("was").checkpoint()
    number = state["batch"] + 1
    pending = keys.select("usgs_id").withColumn("batch", F.lit(number).cast("long"))
    PLACE.commit(spark, raw_dir, [
        PLACE.Part("rows", merged, raw_dir, "event_date", dates, _layout(), ["usgs_id"]),
        *PLACE.index_parts(spark, raw_dir, _RAW_KEYS, placed, "usgs_id", state["buckets"]),
        PLACE.Part("pending", pending, _pending_path(raw_dir), "batch", [number])], state | {"batch": number})
    return {"events": read, "inserted": read, "dates": dates}


def curate_pending(spark: SparkSession, raw_dir: str, table_dir: str, tsunami_dir: str | None = None, full: bool = False, stamp=None,
                   buckets: int = PLACE.BUCKETS) -> dict:
    """J1 + clean + K2/K3 + K5 + K9 for the keys that ``ingest_in_place`` left since the last run.

    Only the dates of those keys are read from the raw table.  The keys are
    forgotten after the curated table's commit; a run that stopped between the
    two finds its rows unchanged.  ``full`` curates every raw row again.
    """
    raw_dir = raw_dir.rstrip("/")
    PLACE.finish(spark, raw_dir)
    waiting = PLACE.folders(spark, _pending_path(raw_dir))
    raw = PLACE.read(spark, raw_dir, _DATED_RAW)
    first = full or PLACE.numbers(spark, table_dir.rstrip("/")) is None
    if not first:
        keys = PLACE.read(spark, _pending_path(raw_dir), _PENDING).filter(
            PLACE.within("batch", [int(name.split("=")[1]) for name in waiting])).select("usgs_id").distinct().checkpoint()
        small = broadcast_checked(keys)
        state = PLACE.numbers(spark, raw_dir) or {"buckets": buckets}
        at = PLACE.index_rows(spark, raw_dir, _RAW_KEYS, keys, "usgs_id", state["buckets"]).join(small, "usgs_id", "left_semi")
        raw = raw.filter(PLACE.within("event_date", PLACE.distinct_values(at, "event_date"))).join(small, "usgs_id", "left_semi")
    done = curate_in_place(spark, raw.drop("event_date"), table_dir, stamp=stamp, tsunami_dir=tsunami_dir, full=full, buckets=buckets)
    for name in waiting:
        PLACE._delete(spark, f"{_pending_path(raw_dir)}/{name}")
        PLACE.after("forgotten")
    return done


def curate_in_place(spark: SparkSession, raw_batch: DataFrame, table_dir: str, stamp=None, tsunami_dir: str | None = None,
                    full: bool = False, buckets: int = PLACE.BUCKETS) -> dict:
    """J1 + clean + K2/K3 (+ K5) for one batch of raw rows over a table that is kept
    in place, partitioned by event date.

    The key index gives the version and date of the batch's own keys, its
    numbers the last serial id; no scan of the table is needed.  Only dates of
    changed rows are read and written again; the tsunami table (K5), where one
    is kept, gets the same dates from the same rows.  Table, tsunami table,
    index and last id change in one commit (``sources.place``), so a stop at any
    point loses, doubles or renumbers no row.  A batch that is run again finds
    its rows unchanged and writes nothing.
    """
    table_dir, stamp_col = table_dir.rstrip("/"), ts_literal(stamp)
    PLACE.finish(spark, table_dir)
    state = PLACE.numbers(spark, table_dir)
    if state is None and PLACE.folders(spark, table_dir):
        state = _adopt(spark, table_dir, buckets)
    batch = read_raw(raw_batch)
    if state is None:
        state, known = {"buckets": buckets, "last_id": 0}, None
        todo = batch
    else:
        keys = broadcast_checked(batch.select("usgs_id").distinct().checkpoint())
        known = PLACE.index_rows(spark, table_dir, _FINAL_KEYS, keys, "usgs_id", state["buckets"]).join(keys, "usgs_id", "left_semi").checkpoint()
        todo = batch if full else U.changed(raw_batch, known).select(*CURATE_INPUT_COLUMNS)
    mode = "full" if full or known is None else "incremental"
    seen = Observation("curate")
    todo = clean(todo.observe(seen, F.count(F.lit(1)).alias("rows"))).checkpoint()
    done = todo.count()
    summary = {"mode": mode, "read": seen.get["rows"], "transformed": done, "loaded": done, "rows": done}
    if not done:
        return summary | {"dates": []}
    report = check_schema(todo, "usgs_id", FINAL_TEXT_LIMITS)
    require(report if known is None else report.filter("check_name <> 'unique'"), "curated")
    if known is None:  # rows are unique, so ids run from 1 to their number
        dates, last = [], done
        merged = entries = _dated(U.first_load(todo, stamp=stamp_col))
    else:
        moved = known.join(todo.select("usgs_id"), "usgs_id", "left_semi").select("event_date")
        dates = PLACE.distinct_values(moved.unionByName(_dated(todo).select("event_date")), "event_date")
        touched = PLACE.read(spark, table_dir, _DATED_FINAL).filter(PLACE.within("event_date", dates)).drop("event_date")
        merged = _dated(U.curated_upsert(touched, todo, stamp=stamp_col, start=state["last_id"])).checkpoint()
        entries = merged.join(broadcast_checked(todo.select("usgs_id").distinct()), "usgs_id", "left_semi").checkpoint()
        last = max(state["last_id"], merged.agg(F.max("id")).first()[0])
    parts = [PLACE.Part("rows", merged, table_dir, "event_date", dates, _layout(), ["usgs_id"]),
             *PLACE.index_parts(spark, table_dir, _FINAL_KEYS, entries, "usgs_id", state["buckets"])]
    if tsunami_dir:
        warned = U.refresh_tsunami(merged)
        parts.append(PLACE.Part("tsunami", _dated(warned), tsunami_dir.rstrip("/"), "event_date", dates, [F.col("time").desc()]))
    PLACE.commit(spark, table_dir, parts, state | {"last_id": last})
    return summary | {"dates": None if known is None else dates}


def _adopt(spark: SparkSession, table_dir: str, buckets: int) -> dict:
    """Index and numbers of a table by date that has none yet: the one scan of its keys."""
    table = PLACE.read(spark, table_dir, _DATED_FINAL)
    state = {"buckets": buckets, "last_id": table.agg(F.max("id")).first()[0] or 0}
    PLACE.commit(spark, table_dir, PLACE.index_parts(spark, table_dir, _FINAL_KEYS, table.select(*_FINAL_KEYS.names), "usgs_id", buckets), state)
    return state
