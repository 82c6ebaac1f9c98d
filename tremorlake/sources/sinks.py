"""Sinks: records JSON (K6), GeoJSON lines (K7), feed documents, versioned tables.

Tables are written to a new version directory per load (parquet has no
MERGE); readers take the newest complete version.  Curated tables are
partitioned by event date so the time-window filter prunes whole folders.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSS"
FEATURES_PER_DOCUMENT = 1000


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: JSON lines with ISO timestamps."""
    df.write.mode(mode).option("timestampNTZFormat", ISO_NTZ).option("timestampFormat", ISO_NTZ).json(path)


def feature_json(df: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON Feature text per row (``value``)."""
    props = F.struct(*[F.col(c) for c in properties])
    geom = F.struct(F.lit("Point").alias("type"),
                    F.array(F.col("longitude").cast("double"), F.col("latitude").cast("double")).alias("coordinates"))
    feat = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), geom.alias("geometry"))
    return df.select(F.to_json(feat, {"ignoreNullFields": "false", "timestampNTZFormat": ISO_NTZ}).alias("value"))


def write_geojson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K7: cleaned points as GeoJSON Features, one per line."""
    props = [c for c in df.columns if c not in ("longitude", "latitude")]
    feature_json(df, props).write.mode(mode).text(path)


def feed_documents(raw: DataFrame, order_col: str = "seq", per_document: int = FEATURES_PER_DOCUMENT,
                   omit_depth_when_null: bool = True) -> DataFrame:
    """Raw rows -> FeatureCollection texts (``value``), ``per_document`` features each.

    Times are epoch milliseconds; a null depth leaves the coordinates at two
    numbers, as feeds do when depth is unknown.  Groups are bounded by
    ``per_document``, so no group grows with the data.
    """
    props = F.struct(
        F.col("mag").cast("double").alias("mag"), F.col("place"),
        F.unix_millis(F.col("time").cast("timestamp")).alias("time"),
        F.unix_millis(F.col("updated").cast("timestamp")).alias("updated"),
        F.col("tz"), F.col("url"), F.col("detail"), F.col("felt"),
        F.col("cdi").cast("double").alias("cdi"), F.col("mmi").cast("double").alias("mmi"),
        F.col("alert"), F.col("status"), F.col("tsunami"), F.col("sig"), F.col("net"), F.col("code"),
        F.col("ids"), F.col("sources"), F.col("types"), F.col("nst"),
        F.col("dmin").cast("double").alias("dmin"), F.col("rms").cast("double").alias("rms"),
        F.col("gap").cast("double").alias("gap"), F.col("magType"),
    )
    xy = [F.col("longitude").cast("double"), F.col("latitude").cast("double")]
    xyz = F.array(*xy, F.col("depth").cast("double"))
    coords = F.when(F.col("depth").isNull() & F.lit(omit_depth_when_null), F.array(*xy)).otherwise(xyz)
    geom = F.struct(F.col("geometry_type").alias("type"), coords.alias("coordinates"))
    feat = F.struct(F.lit("Feature").alias("type"), F.col("usgs_id").alias("id"), props.alias("properties"),
                    geom.alias("geometry"))
    feats = raw.select((F.col(order_col) / per_document).cast("long").alias("_doc"),
                       F.to_json(feat, {"ignoreNullFields": "false"}).alias("_feat"))
    docs = feats.groupBy("_doc").agg(F.array_join(F.collect_list("_feat"), ",").alias("_body"))
    return docs.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col("_body"),
                                F.lit("]}")).alias("value"), "_doc")


def land_in_batches(docs: DataFrame, path: str, batches: int, events: int, per_file: int = 100_000) -> int:
    """Land documents of about so many events as gzipped files, as many for each of the batches; returns that number.

    A compressed file is read by one task, so its size is bounded."""
    files = max(1, -(-events // (batches * per_file)))
    at = (F.col("_doc") % (batches * files)).cast("int")
    docs.repartitionById(batches * files, at).select("value").write.mode("overwrite").text(path, compression="gzip")
    return files


def write_feed_documents(docs: DataFrame, path: str) -> None:
    """One document per line (JSON lines of FeatureCollections)."""
    docs.select("value").write.mode("overwrite").text(path)


# --- Versioned tables ----------------------------------------------------------------------

_VERSION = re.compile(r"v(\d{8})$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Complete versions (those with a _SUCCESS marker), oldest first."""
    fs, p = _fs(spark, table_dir)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.search(st.getPath().getName())
        if m and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def mark_version(spark: SparkSession, table_dir: str, version: int, mark: str) -> None:
    """Leave an empty file ``mark`` (its name starts with _, so readers skip it) in a version's folder."""
    fs, p = _fs(spark, f"{version_path(table_dir, version)}/{mark}")
    fs.create(p, True).close()


def marked_version(spark: SparkSession, table_dir: str, mark: str) -> int | None:
    for version in reversed(versions(spark, table_dir)):
        fs, p = _fs(spark, f"{version_path(table_dir, version)}/{mark}")
        if fs.exists(p):
            return version
    return None


def version_path(table_dir: str, version: int) -> str:
    return f"{table_dir.rstrip('/')}/v{version:08d}"


def spatial_sort_keys(lat: str = "latitude", lon: str = "longitude", band_deg: float = 1.0) -> list:
    """Sort keys that make parquet row groups spatially compact: latitude band,
    then longitude band.  Row-group min/max of the coordinates then prune the
    decimal bounding box of a radius search (partitions already serve time)."""
    return [F.floor((F.col(lat) + F.lit(90)) / F.lit(band_deg)), F.floor((F.col(lon) + F.lit(180)) / F.lit(band_deg))]


def write_version(df: DataFrame, table_dir: str, version: int, partition_by: list[str] | None = None,
                  sort_within: list | None = None, bloom_columns: list[str] | None = None) -> str:
    """Write one table version; rewriting the same version is idempotent.

    ``bloom_columns`` get parquet bloom filters, so equality lookups on them
    (a key lookup) skip row groups."""
    path = version_path(table_dir, version)
    # Rows of one partition value are gathered before the write, else every task
    # writes a file into every folder.  A large date is spread over several tasks
    # by the first sort key, so no task holds a date that is too large for it.
    # Partition columns lead the sort: the writer needs that order anyway and
    # would otherwise re-sort by them alone, losing the layout order.
    w = df
    if partition_by:
        w = w.repartitionByRange(*partition_by, *(sort_within or [])[:1])
    if sort_within:
        w = w.sortWithinPartitions(*(partition_by or []), *sort_within)
    writer = w.write.mode("overwrite")
    for c in bloom_columns or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_latest(spark: SparkSession, table_dir: str, before: int | None = None, layout: bool = False) -> DataFrame | None:
    """The newest complete version (older than ``before``).  ``layout`` keeps the
    partition column, which queries use to skip folders (see ``query.since``)."""
    vs = [v for v in versions(spark, table_dir) if before is None or v < before]
    if not vs:
        return None
    df = spark.read.parquet(version_path(table_dir, vs[-1]))
    return df if layout or "event_date" not in df.columns else df.drop("event_date")
