"""Table schemas: the GeoJSON feed, the raw table, the curated table, tsunami view.

Column names and numeric precisions are fixed values that results depend on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw table columns, in table order (name, Spark type) -----
RAW_COLUMNS: list[tuple[str, T.DataType]] = [
    ("id", T.StringType()),
    ("usgs_id", T.StringType()),
    ("mag", T.DecimalType(6, 2)),
    ("place", T.StringType()),
    ("time", T.TimestampNTZType()),
    ("updated", T.TimestampNTZType()),
    ("tz", T.IntegerType()),
    ("url", T.StringType()),
    ("detail", T.StringType()),
    ("felt", T.IntegerType()),
    ("cdi", T.DecimalType(4, 2)),
    ("mmi", T.DecimalType(4, 2)),
    ("alert", T.StringType()),
    ("status", T.StringType()),
    ("tsunami", T.IntegerType()),
    ("sig", T.IntegerType()),
    ("net", T.StringType()),
    ("code", T.StringType()),
    ("ids", T.StringType()),
    ("sources", T.StringType()),
    ("types", T.StringType()),
    ("nst", T.IntegerType()),
    ("dmin", T.DecimalType(10, 4)),
    ("rms", T.DecimalType(10, 4)),
    ("gap", T.DecimalType(8, 2)),
    ("magType", T.StringType()),
    ("geometry_type", T.StringType()),
    ("longitude", T.DecimalType(10, 6)),
    ("latitude", T.DecimalType(10, 6)),
    ("depth", T.DecimalType(10, 2)),
]
RAW_STAMP = "ingested_at"

# Columns a raw conflict overwrites; every other column keeps its first value.
RAW_UPDATE_COLUMNS = [
    "mag", "place", "time", "updated", "alert", "status", "tsunami", "sig",
    "magType", "geometry_type", "longitude", "latitude", "depth",
]

# Text length limits of the raw and curated tables (VARCHAR(n)).
RAW_TEXT_LIMITS = {
    "id": 50, "usgs_id": 100, "alert": 20, "status": 20, "net": 10, "code": 30,
    "magType": 20, "geometry_type": 20,
}
FINAL_TEXT_LIMITS = {"usgs_id": 100, "magType": 20, "alert": 20, "status": 20}

# --- Fixed values: curated table columns (name, Spark type) ----------------
FINAL_COLUMNS: list[tuple[str, T.DataType]] = [
    ("id", T.LongType()),
    ("usgs_id", T.StringType()),
    ("mag", T.DecimalType(6, 2)),
    ("place", T.StringType()),
    ("time", T.TimestampNTZType()),
    ("updated", T.TimestampNTZType()),
    ("magType", T.StringType()),
    ("tsunami", T.IntegerType()),
    ("alert", T.StringType()),
    ("status", T.StringType()),
    ("sig", T.IntegerType()),
    ("depth", T.DecimalType(10, 2)),
    ("longitude", T.DecimalType(10, 6)),
    ("latitude", T.DecimalType(10, 6)),
]
FINAL_STAMP = "processed_at"
FINAL_DATA_COLUMNS = [c for c, _ in FINAL_COLUMNS if c not in ("id", "usgs_id")]

# Columns the curate step reads from raw (magType keeps its raw spelling).
CURATE_INPUT_COLUMNS = [
    "usgs_id", "mag", "place", "time", "updated", "magType", "tsunami", "alert",
    "status", "sig", "depth", "longitude", "latitude",
]

TSUNAMI_COLUMNS = ["id", "usgs_id", "mag", "place", "time", "depth", "longitude", "latitude"]


def struct_of(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns])


RAW_SCHEMA = struct_of(RAW_COLUMNS + [(RAW_STAMP, T.TimestampNTZType())])
FINAL_SCHEMA = struct_of(FINAL_COLUMNS + [(FINAL_STAMP, T.TimestampNTZType())])

# --- GeoJSON feed: properties of one feature --------------------------------
FEED_PROPERTIES = T.StructType([
    T.StructField("mag", T.DoubleType()),
    T.StructField("place", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("tz", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("felt", T.LongType()),
    T.StructField("cdi", T.DoubleType()),
    T.StructField("mmi", T.DoubleType()),
    T.StructField("alert", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tsunami", T.LongType()),
    T.StructField("sig", T.LongType()),
    T.StructField("net", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("ids", T.StringType()),
    T.StructField("sources", T.StringType()),
    T.StructField("types", T.StringType()),
    T.StructField("nst", T.LongType()),
    T.StructField("dmin", T.DoubleType()),
    T.StructField("rms", T.DoubleType()),
    T.StructField("gap", T.DoubleType()),
    T.StructField("magType", T.StringType()),
])

FEED_GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
])

# Properties are read as raw JSON text so that a missing key and an explicit
# null can be told apart (tsunami); they are parsed with FEED_PROPERTIES later.
FEED_FEATURE_RAW = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("properties", T.StringType()),
    T.StructField("geometry", FEED_GEOMETRY),
])

FEED_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(FEED_FEATURE_RAW)),
])
