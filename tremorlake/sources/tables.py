"""Table sources: the given parquet tables, derived point events, raw/curated scans.

The given tables carry no coordinates, so point events are derived from
``events`` joined to ``nation`` with one fixed rule (FIXTURES.md section 2).
The rule is stated once here as DataFrame expressions; the DuckDB oracle states
the same rule in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CURATE_INPUT_COLUMNS, RAW_COLUMNS, RAW_STAMP

# Fixed value: the reference instant of the derived events (last event 2024-01-30).
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
NATIONS = 25


def ts_literal(value: dt.datetime | str | None) -> Column:
    """A timestamp_ntz literal (UTC wall clock); None -> the current instant."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hundredths(c: Column, scale: int, out: str) -> Column:
    """Exact decimal from an integer count of 10^-scale units (|units| < 2^53).

    The quotient goes through a double: its shortest decimal form is exactly
    units / 10^scale, and the cast avoids a BigDecimal division per row."""
    return (c.cast("double") / F.lit(float(10 ** scale))).cast(out)


def derived_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point events derived from ``events`` and ``nation`` (one row per event).

    Columns: seq (event_id), usgs_id, mag, place, time, updated, magType,
    tsunami, alert, status, sig, depth, longitude, latitude, event_type.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    # A source of fewer files than the cluster has cores is spread round-robin; a
    # large source scans as thousands of splits and is left alone (no extra shuffle).
    cores = spark.sparkContext.defaultParallelism
    if len(ev.inputFiles()) < cores:
        ev = ev.repartition(cores)
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension; the planner broadcasts it from its
    # file statistics (autoBroadcastJoinThreshold), no hint needed.
    j = ev.join(na, (ev.user_id % NATIONS) == na.n_nationkey, "inner")
    e = F.col("event_id")
    k = F.col("user_id") % NATIONS
    place = (
        F.when(e % 10 == 0, F.lit(None).cast("string"))
        .when(e % 10 == 1, F.lit(""))
        .when(e % 10 == 2, F.lit("Mid-ocean ridge"))
        .when(e % 10 == 3, F.concat(F.lit("12 km S of "), F.col("n_name")))
        .otherwise(F.concat((e % 200).cast("string"), F.lit(" km NE of Town, Province, "), F.col("n_name")))
    )
    return j.select(
        e.alias("seq"),
        F.concat(F.lit("ev"), e.cast("string")).alias("usgs_id"),
        F.when(e % 97 == 0, F.lit(None)).otherwise(_hundredths(e * 37 % 1100 - 150, 2, "decimal(6,2)"))
        .cast("decimal(6,2)").alias("mag"),
        place.alias("place"),
        F.col("ts").alias("time"),
        F.when(e % 11 == 0, F.lit(None)).otherwise(F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("updated"),
        F.when(e % 4 == 0, "ml").when(e % 4 == 1, "mb").when(e % 4 == 2, "mww").alias("magType"),
        F.when(e % 53 == 0, F.lit(None)).when(e % 50 == 0, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("tsunami"),
        F.when(e % 7 == 0, "green").when(e % 7 == 1, "yellow").when(e % 7 == 2, "orange")
        .when(e % 7 == 3, "red").alias("alert"),
        F.when(e % 3 == 0, "reviewed").when(e % 3 == 1, "automatic").alias("status"),
        F.when(e % 59 == 0, F.lit(None)).otherwise((e % 1000).cast("int")).cast("int").alias("sig"),
        F.when(e % 89 == 0, F.lit(None)).otherwise(_hundredths(e * 131 % 70000, 2, "decimal(10,2)"))
        .cast("decimal(10,2)").alias("depth"),
        F.when(e % 101 == 0, F.lit(None)).otherwise(
            _hundredths((k * 53 % 360 - 180) * 1000 + (e * 7919 % 6001 - 3000), 3, "decimal(10,6)"))
        .cast("decimal(10,6)").alias("longitude"),
        _hundredths((k * 37 % 160 - 80) * 1000 + (e * 104729 % 6001 - 3000), 3, "decimal(10,6)").alias("latitude"),
        F.col("event_type"),
    )


def derived_raw(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    """The raw table (31 columns) as the feed would have filled it from derived events."""
    d = derived_events(spark, sf_dir)
    filled = {
        "id": F.col("usgs_id"),
        "code": F.col("seq").cast("string"),
        "net": F.col("event_type"),
        "ids": F.concat(F.lit(","), F.col("usgs_id"), F.lit(",")),
        "sources": F.concat(F.lit(","), F.col("event_type"), F.lit(",")),
        "geometry_type": F.lit("Point"),
    }
    present = set(d.columns)
    cols = []
    for name, dtype in RAW_COLUMNS:
        if name in filled:
            c = filled[name]
        elif name in present:
            c = F.col(name)
        else:
            c = F.lit(None)
        cols.append(c.cast(dtype).alias(name))
    return d.select(F.col("seq"), *cols, ts_literal(as_of).alias(RAW_STAMP))


def read_raw(raw: DataFrame) -> DataFrame:
    """Full scan of the raw table for curation - rows with both coordinates."""
    return raw.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).select(*CURATE_INPUT_COLUMNS)


def quakes(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    """The curated table over derived events.

    Ids follow event order (``seq + 1``); like a serial they have gaps where a
    raw row was not curated.
    """
    from ..operators.clean import clean  # local import: operators depend on sources

    raw = derived_raw(spark, sf_dir, as_of)
    kept = raw.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    cleaned = clean(kept.select("seq", *CURATE_INPUT_COLUMNS))
    return cleaned.select((F.col("seq") + 1).alias("id"), *[c for c in cleaned.columns if c != "seq"],
                          ts_literal(as_of).alias("processed_at"))


def read_quakes(spark: SparkSession, path: str) -> DataFrame:
    """S6 over a stored curated table (parquet, partitioned by event date).

    ``event_date`` stays in the frame so that the time window also becomes a
    partition filter (see ``query.since``)."""
    return spark.read.parquet(path)
