"""Curation: coercion, defaults, coordinate validity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S

# Defaults the curated table gives to missing values.
DEFAULTS = {"place": "Unknown", "status": "unknown", "magType": "unknown", "alert": ""}
INT_DEFAULTS = {"tsunami": 0, "sig": 0}
NUMERIC_TYPES = {"mag": "decimal(6,2)", "depth": "decimal(10,2)",
                 "longitude": "decimal(10,6)", "latitude": "decimal(10,6)"}
LON_RANGE, LAT_RANGE = (-180, 180), (-90, 90)


COORDINATES = ("longitude", "latitude")


def _number(dtype: T.DataType, name: str):
    c = F.col(name)
    return S.to_number(c) if isinstance(dtype, (T.StringType, T.DoubleType, T.FloatType)) else c


def _fitting(value, name: str, target: str, kept):
    """A number in its column's type.  What is no number is null already; a number
    that does not fit stops the load, unless its row is dropped anyway."""
    made = value.try_cast(target)
    what = F.concat(F.lit(f"{name} does not fit {target}: "), value.cast("string"))
    return F.when(kept & value.isNotNull() & made.isNull(), F.raise_error(what)).otherwise(made)


def _within(c, bounds):
    return F.coalesce(c.between(*bounds), F.lit(False))


def _time(dtype: T.DataType, name: str):
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dtype, T.TimestampType):
        return F.col(name).cast("timestamp_ntz")
    return S.to_time(F.col(name))


def valid_coords(df: DataFrame) -> DataFrame:
    """Both coordinates present and inside [-180,180] x [-90,90], inclusive."""
    lon, lat = F.col("longitude"), F.col("latitude")
    return df.filter(lon.isNotNull() & lat.isNotNull()
                     & lon.between(*LON_RANGE) & lat.between(*LAT_RANGE))


def clean(df: DataFrame) -> DataFrame:
    """Curate raw rows: numbers coerced (no number -> null, never 0; a number
    that does not fit its column is an error), text defaults, int defaults,
    timestamps coerced, invalid coordinates dropped.  Extra columns pass through
    untouched."""
    out = []
    types = {f.name: f.dataType for f in df.schema.fields}
    at = {c: _number(types[c], c).try_cast(NUMERIC_TYPES[c]) for c in COORDINATES}
    kept = _within(at["longitude"], LON_RANGE) & _within(at["latitude"], LAT_RANGE)
    for name in df.columns:
        if name in COORDINATES:
            out.append(at[name].alias(name))
        elif name in NUMERIC_TYPES:
            value = _number(types[name], name)
            same = types[name].simpleString() == NUMERIC_TYPES[name]
            out.append((value if same else _fitting(value, name, NUMERIC_TYPES[name], kept)).alias(name))
        elif name in DEFAULTS:
            out.append(F.coalesce(F.col(name).cast("string"), F.lit(DEFAULTS[name])).alias(name))
        elif name in INT_DEFAULTS:
            v = F.col(name) if isinstance(types[name], T.IntegerType) else _fitting(S.to_number(F.col(name)), name, "int", kept)
            out.append(F.coalesce(v, F.lit(INT_DEFAULTS[name])).alias(name))
        elif name in ("time", "updated"):
            out.append(_time(types[name], name).alias(name))
        else:
            out.append(F.col(name))
    return valid_coords(df.select(*out))


def analysis_frame(df: DataFrame) -> DataFrame:
    """Rows with a magnitude, plus binned class, stripped region and day label."""
    mag = S.to_number(F.col("mag"))
    return (
        df.withColumn("mag", mag)
        .withColumn("depth", S.to_number(F.col("depth")))
        .withColumn("time", S.to_time(F.col("time")))
        .filter(F.col("mag").isNotNull())
        .withColumn("category", S.mag_class(F.col("mag"), closed="right"))
        .withColumn("region", S.region(F.coalesce(F.col("place"), F.lit(S.NO_PLACE)), keep_tail=True))
        .withColumn("day", S.period_label(F.col("time"), "day"))
    )
