"""GeoJSON feed sources (S1-S3) and flattening.

A feed document is a FeatureCollection; one file (or one JSON line) holds one
document.  Documents are read with an explicit schema (no inference), the
features array is exploded to one row per feature, and every field is a
native expression.  ``properties`` is read as raw JSON text so that a missing
``tsunami`` key (-> 0) and an explicit null (-> null) stay distinguishable.

Every row can carry ARRIVAL, the order in which feeds were landed: file time,
file path and the split's start in the file.  A split is read by one task in
order, so ``in_arrival_order`` makes it total.  Rows of a later feed win over
rows of an earlier one however files are packed into tasks.
No value is nulled in silence.  A value that does not fit the table's type stops
the scan, as it stops a load into a database; ``tracked`` notes its column in
UNFIT instead; ``screen_feed`` takes every feature, notes all reasons against it
in REJECTS, and ``split`` parts what can be loaded from what can't, in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import epoch_ms
from ..schema import FEED_PROPERTIES, FEED_SCHEMA, RAW_COLUMNS, RAW_TEXT_LIMITS
from ..session import ensure_checkpoint_dir

_RAW_TYPES = dict(RAW_COLUMNS)
ARRIVAL = "_arrival"
UNFIT = "_unfit"
REJECTS = "_rejects"
REASON = "struct<reason:string,column_name:string,value:string>"


def exploded(docs: DataFrame) -> DataFrame:
    """Documents of a file source -> (f, _arrival), one row per feature."""
    meta = F.col("_metadata")
    arrival = F.struct(meta["file_modification_time"].alias("time"), meta["file_path"].alias("path"), meta["file_block_start"].alias("block"))
    return docs.select(F.explode("features").alias("f"), arrival.alias(ARRIVAL))


def in_arrival_order(rows: DataFrame) -> DataFrame:
    """ARRIVAL with the row's place among those of its split, for rows as the scan gave them."""
    at = F.col(ARRIVAL)
    return rows.withColumn(ARRIVAL, F.struct(at["time"].alias("time"), at["path"].alias("path"), at["block"].alias("block"),
                                             F.monotonically_increasing_id().alias("row")))


def read_feed_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per feature: (feature struct, arrival)."""
    docs = spark.read.schema(FEED_SCHEMA).option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)
    return exploded(docs)


def flatten(features: DataFrame, strict: bool = True, tracked: bool = False, screened: bool = False) -> DataFrame:
    """Feature rows -> raw columns; ``tracked`` adds ARRIVAL (if there) and UNFIT.
    Untracked, a value that does not fit its column's type is an error.

    strict: skip features without id, with a null/0 time, without properties,
    or with fewer than 3 coordinates; updated null/0 -> time; tsunami missing -> 0.
    lenient: nothing is skipped; missing times -> epoch 0; coordinates may be null.
    """
    f = F.col("f")
    props_text = f["properties"]
    # A generator's output is not computed again in every filter and column that reads it.
    p = F.explode(F.array(F.from_json(props_text, FEED_PROPERTIES)))
    has_tsunami = F.coalesce(F.array_contains(F.json_object_keys("_props"), "tsunami"), F.lit(False))
    coords = f["geometry"]["coordinates"]
    carried = [ARRIVAL] if (tracked or screened) and ARRIVAL in features.columns else []
    d = features.select(f["id"].alias("_fid"), p.alias("p"), props_text.alias("_props"), coords.alias("_xyz"),
                        f["geometry"]["type"].alias("_gtype"), props_text.isNull().alias("_noprops"), *carried)
    # Keys are read only where no value tells that the key is there.
    tsunami = F.when(F.col("p.tsunami").isNotNull(), F.col("p.tsunami"))
    pt, pu = F.col("p.time"), F.col("p.updated")
    has_coords = F.col("_xyz").isNotNull() & (F.size("_xyz") >= 3)
    skipped = {"id": F.col("_fid").isNull() | (F.col("_fid") == ""), "properties": F.col("_noprops"),
               "time": ~F.col("_noprops") & (pt.isNull() | (pt == 0)), "coordinates": ~F.coalesce(has_coords, F.lit(False))}
    if strict:
        if not screened:
            for broken in skipped.values():
                d = d.filter(~broken)
        time_ms, updated_ms = pt, F.when(pu.isNull() | (pu == 0), pt).otherwise(pu)
        tsunami = tsunami.when(has_tsunami, F.lit(None)).otherwise(F.lit(0))
        xyz = F.col("_xyz")
    else:
        time_ms, updated_ms = F.coalesce(pt, F.lit(0)), F.coalesce(pu, F.lit(0))
        tsunami = tsunami.when(F.json_object_keys("_props").isNull() | has_tsunami, F.lit(None)).otherwise(F.lit(0))
        xyz = F.when(F.size("_xyz") >= 1, F.col("_xyz"))

    def typed(name: str, c: Column) -> Column:
        dtype = _RAW_TYPES[name]
        if tracked or screened or not _can_overflow(dtype):
            return c.try_cast(dtype).alias(name)
        what = F.concat(F.lit(f"{name} of event "), F.coalesce(F.col("_fid"), F.lit("?")), F.lit(f" does not fit {dtype.simpleString()}: "), c.cast("string"))
        return F.when(c.isNotNull() & c.try_cast(dtype).isNull(), F.raise_error(what)).otherwise(c.try_cast(dtype)).alias(name)

    cols = {
        "id": F.col("_fid"), "usgs_id": F.col("_fid"), "time": epoch_ms(time_ms), "updated": epoch_ms(updated_ms),
        "tsunami": tsunami, "geometry_type": F.col("_gtype"),
        "longitude": F.get(xyz, 0), "latitude": F.get(xyz, 1), "depth": F.get(xyz, 2),
    }
    out, unfit = [], []
    for name, dtype in RAW_COLUMNS:
        if name == "id" and not strict:
            continue
        value = cols.get(name, F.col(f"p.{name}"))
        out.append(typed(name, value))
        if _can_overflow(dtype):
            unfit.append((name, dtype.simpleString(), value.isNotNull() & value.try_cast(dtype).isNull(), value))
    if screened:
        reasons = [_reason("missing", part, F.lit(None), broken) for part, broken in skipped.items()]
        reasons += [_reason(f"does not fit {kind}", name, value, broken) for name, kind, broken, value in unfit]
        texts = {name: cols.get(name, F.col(f"p.{name}")) for name in RAW_TEXT_LIMITS}
        reasons += [_reason(f"longer than {n}", name, texts[name], F.length(texts[name]) > n) for name, n in RAW_TEXT_LIMITS.items()]
        return d.select(*out, *carried, F.array_compact(F.array(*reasons)).alias(REJECTS))
    if not tracked:
        return d.select(*out)
    return d.select(*out, *carried, F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, _, broken, _ in unfit])).alias(UNFIT))


def _can_overflow(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DecimalType, T.IntegerType))


def _reason(reason: str, column: str, value: Column, broken: Column) -> Column:
    made = F.struct(F.lit(reason).alias("reason"), F.lit(column).alias("column_name"), value.cast("string").alias("value"))
    return F.when(broken, made.cast(REASON))


def screen_feed(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every feature of landed feed files as a raw row with REJECTS: why it can't be
    loaded (empty if it can).  A part that is missing, a number that does not fit,
    a text over its column's limit; what does not fit is null in its own column."""
    return flatten(read_feed_documents(spark, path, multi_line), strict=True, screened=True)


def split(screened: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be loaded, rejected rows one per reason: usgs_id, reason, column_name, value).

    One scan: the screened rows are checkpointed and both frames read those files."""
    ensure_checkpoint_dir(screened.sparkSession)
    rows = screened.checkpoint()
    rejected = rows.select("usgs_id", F.explode(REJECTS).alias("r")).select("usgs_id", "r.*")
    return rows.filter(F.size(REJECTS) == 0).drop(REJECTS), rejected


def read_feed(spark: SparkSession, path: str, strict: bool = True, multi_line: bool = True, tracked: bool = False) -> DataFrame:
    """S1 (strict) / S2 (lenient): landed feed files -> raw rows."""
    return flatten(read_feed_documents(spark, path, multi_line), strict, tracked)


def read_records(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    """S3: records JSON (JSON lines, or one JSON array with multi_line=True)."""
    from ..schema import RAW_SCHEMA

    schema = schema or RAW_SCHEMA
    return (spark.read.schema(schema).option("multiLine", multi_line)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]").json(path))


def read_geojson(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """GeoJSON lines (one Feature per line, as ``sinks.write_geojson`` writes them)
    -> one row per feature: the properties plus longitude and latitude."""
    from ..sources.sinks import ISO_NTZ

    schema = T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", properties),
        T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()),
                                                T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
    ])
    feats = spark.read.schema(schema).option("timestampNTZFormat", ISO_NTZ).json(path)
    xy = F.col("geometry.coordinates")
    return feats.select("properties.*", xy[0].alias("longitude"), xy[1].alias("latitude"))
