"""Keyed upserts, serial ids, incremental change detection, tsunami refresh.

K1/K2 upsert, K3 serial ids, K4 defaults, K5 tsunami table, J1 changed rows.

An upsert is a pure DataFrame -> DataFrame operator; the caller writes the
result to a new version directory (parquet has no MERGE).  A small batch is
broadcast (after its size is proven) so the big current table is scanned
without a shuffle; a batch beyond the bound is joined by shuffle, once for the
rows that stay and once, on keys alone, for the new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FINAL_DATA_COLUMNS, RAW_UPDATE_COLUMNS, TSUNAMI_COLUMNS
from ..session import BROADCAST_ROW_LIMIT, proven_small

ARRIVAL = "_arrival"


def fold_batch(batch: DataFrame, key: str, update_cols: list[str], order: Column | str | None = None) -> DataFrame:
    """Collapse several batch rows of one key as successive upserts would:
    update columns from the last row, the other columns from the first.

    ``order`` is the arrival order (default: position in the batch).  One
    aggregate with map-side partial aggregation, so a hot key is cheap.
    """
    if order is None:
        batch = batch.withColumn(ARRIVAL, F.monotonically_increasing_id())
        order = F.col(ARRIVAL)
    elif isinstance(order, str):
        order = F.col(order)
    cols = [c for c in batch.columns if c not in (key, ARRIVAL)]
    last = [c for c in cols if c in update_cols]
    first = [c for c in cols if c not in update_cols]
    aggs = []
    if last:
        aggs.append(F.max_by(F.struct(*last), order).alias("_last"))
    if first:
        aggs.append(F.min_by(F.struct(*first), order).alias("_first"))
    g = batch.groupBy(key).agg(*aggs)
    return g.select(key, *[F.col(f"_last.{c}" if c in update_cols else f"_first.{c}").alias(c) for c in cols])


def upsert(current: DataFrame, batch: DataFrame, key: str, update_cols: list[str], stamp_col: str | None = None,
           stamp: Column | None = None, order: Column | str | None = None, keep_cols: list[str] | None = None,
           broadcast_limit: int = BROADCAST_ROW_LIMIT, folded: bool = False, fresh: bool = False) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols = EXCLUDED.*, stamp = now.

    Nulls in the batch overwrite (no coalesce).  Inserted rows take every batch
    column; ``keep_cols`` (e.g. a serial id) are left null on insert for the
    caller to fill.  ``folded`` says that the batch is folded and materialised
    already, ``fresh`` that ``current`` has no rows: nothing is joined then.
    Returns rows with the column order of ``current`` plus ``_inserted``
    (true for new keys).
    """
    keep_cols = keep_cols or []
    # The folded batch feeds the size proof and two or three joins: materialise
    # it once (it is the small side; this also cuts its lineage).
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(current.sparkSession)
    once = batch if folded else fold_batch(batch, key, update_cols, order).checkpoint(eager=True)
    b_cols = [c for c in once.columns if c != key]
    b = once.select(F.col(key), F.lit(True).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in b_cols])
    stamp = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")

    def merged(cur_present: Column, b_present: Column) -> list[Column]:
        out = []
        for c in current.columns:
            if c == key:
                out.append(F.col(key))
            elif c == stamp_col:
                out.append(F.when(b_present, stamp).otherwise(F.col(c)).alias(c))
            elif c in update_cols and c in b_cols:
                out.append(F.when(b_present, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c))
            elif c in b_cols and c not in keep_cols:
                out.append(F.when(cur_present, F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c))
            else:
                out.append(F.col(c))
        return out + [(~cur_present).alias("_inserted")]

    # Rows that stay (updated or not) and rows that are new are two joins on the
    # key, so a caller that needs only one kind runs only that one.
    if fresh:
        return _blank(b, b_cols, current, key).select(*merged(F.lit(False), F.lit(True)))
    small = proven_small(once, broadcast_limit)
    ship = F.broadcast if small else (lambda df: df)
    kept = current.join(ship(b), key, "left").select(*merged(F.lit(True), F.col("_b").isNotNull()))
    known = current.select(key)
    if small:  # only the batch's own keys of the current table, at most as many as the batch has
        known = F.broadcast(known.join(F.broadcast(once.select(key)), key, "left_semi").distinct())
    new_rows = b.join(known, key, "left_anti")
    return kept.unionByName(_blank(new_rows, b_cols, current, key).select(*merged(F.lit(False), F.lit(True))))


def _blank(new_rows: DataFrame, b_cols: list[str], current: DataFrame, key: str) -> DataFrame:
    """New rows beside null columns of the current table."""
    return new_rows.select(F.col(key), *[F.lit(None).cast(current.schema[c].dataType).alias(c)
                                         for c in current.columns if c != key], "_b", *[f"_b_{c}" for c in b_cols])


def raw_upsert(current: DataFrame, batch: DataFrame, stamp: Column | None = None, order=None, folded: bool = False,
               fresh: bool = False) -> DataFrame:
    """K1: raw table upsert on usgs_id; conflicts overwrite only the feed's
    changing columns and stamp ``ingested_at``."""
    return upsert(current, batch, "usgs_id", RAW_UPDATE_COLUMNS, "ingested_at", stamp, order, folded=folded, fresh=fresh).drop("_inserted")


# --- K3 -------------------------------------------------------------------------------

def assign_ids(df: DataFrame, order: list[Column | str], start: int = 0, out: str = "id",
               partitions: int | None = None) -> DataFrame:
    """Serial numbers start+1, start+2, ... in ``order`` without a single-partition window.

    Range-partition and sort, checkpoint (fixes the partitions and cuts the
    lineage; the folder is the session's spark.checkpoint.dir), count rows per
    partition (one small row per partition), turn the counts into offsets and
    add the row's position within its partition.
    """
    spark = df.sparkSession
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    ck = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    ck = ck.checkpoint(eager=True)
    counts = sorted((r["_pid"], r["count"]) for r in ck.groupBy("_pid").count().collect())
    offsets, acc = {}, 0
    for pid, cnt in counts:
        offsets[pid] = acc
        acc += cnt
    if not offsets:
        return ck.drop("_pid", "_mono").withColumn(out, F.lit(None).cast("long"))
    # One small row per partition, as a joined table: it may be thousands of partitions.
    starts = spark.createDataFrame(sorted(offsets.items()), "_pid int, _start long")
    within = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return ck.join(F.broadcast(starts), "_pid").withColumn(
        out, F.lit(int(start)) + F.col("_start") + within + 1).drop("_pid", "_mono", "_start")


# --- J1 --------------------------------------------------------------------------------

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def changed(raw: DataFrame, final: DataFrame, key: str = "usgs_id") -> DataFrame:
    """Raw rows with both coordinates that are new or strictly newer than
    the curated row (coalesce(updated, time, epoch) on both sides)."""
    e = final.select(F.col(key), F.coalesce(F.col("updated"), F.col("time"), _epoch()).alias("_e_version"),
                     F.lit(True).alias("_e"))
    r = raw.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    j = r.join(e, key, "left")
    newer = F.coalesce(F.col("updated"), F.col("time"), _epoch()) > F.col("_e_version")
    return j.filter(F.col("_e").isNull() | newer).drop("_e", "_e_version")


# --- K2 ---------------------------------------------------------------------------------

def curated_upsert(final: DataFrame, cleaned: DataFrame, stamp: Column | None = None,
                   id_order: list[str] | None = None, start: int | None = None) -> DataFrame:
    """K2: curated upsert on usgs_id; conflicts overwrite every data column and
    stamp ``processed_at``; existing ids stay, new rows get the next serial ids
    (K3) in ``id_order``, after ``start`` (default: the largest id of ``final``)."""
    id_order = id_order or ["time", "usgs_id"]
    merged = upsert(final, cleaned, "usgs_id", FINAL_DATA_COLUMNS, "processed_at", stamp, keep_cols=["id"])
    # No checkpoint of ``merged``: that would copy the whole curated table per
    # batch.  Its inputs are a table version and a checkpointed batch, so it is
    # deterministic; kept rows stream into the write and only the inserted rows
    # are materialised (inside assign_ids).
    old = merged.filter(~F.col("_inserted")).drop("_inserted")
    new = merged.filter(F.col("_inserted")).drop("_inserted", "id")
    if start is None:
        start = final.agg(F.max("id")).first()[0] or 0
    new = assign_ids(new, [F.col(c) for c in id_order], start=start)
    return old.unionByName(new.select(*old.columns))


def first_load(cleaned: DataFrame, stamp: Column | None = None, id_order: list[str] | None = None) -> DataFrame:
    """Curated table from scratch: K3 ids over the cleaned rows, K4 stamp."""
    id_order = id_order or ["time", "usgs_id"]
    stamp = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")
    cols = ["usgs_id", *FINAL_DATA_COLUMNS]
    with_ids = assign_ids(cleaned.select(*cols), [F.col(c) for c in id_order], start=0)
    return with_ids.select("id", *cols, stamp.alias("processed_at"))


# --- K5 -----------------------------------------------------------------------------------

def refresh_tsunami(final: DataFrame) -> DataFrame:
    """K5: events with tsunami = 1 (written sorted by time descending within files)."""
    return final.filter(F.col("tsunami") == 1).select(*TSUNAMI_COLUMNS)
