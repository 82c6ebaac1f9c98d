"""Report projections: event table (P29), map points.

One native ``select`` each; labels come from the scalar functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def event_report(df: DataFrame) -> DataFrame:
    """Table rows: UTC date/hour/month/year, display class, cleaned labels,
    numbers rounded to 2 places the way the display table rounds floats
    (half to even on the binary value), distance when present."""
    t = S.to_time(F.col("time"))
    cols = [
        "usgs_id",
        S.round_float("mag", 2).alias("magnitude"),
        S.mag_class("mag", null_as_zero=True).alias("category"),
        S.clean_text("place", S.NO_PLACE).alias("place"),
        F.date_format(t, "yyyy-MM-dd").alias("date_utc"),
        F.date_format(t, "HH:mm").alias("hour_utc"),
        F.date_format(t, "yyyy-MM").alias("month_utc"),
        F.date_format(t, "yyyy").alias("year_utc"),
        S.round_float("depth", 2).alias("depth_km"),
        S.round_float("latitude", 2).alias("latitude"),
        S.round_float("longitude", 2).alias("longitude"),
        S.clean_text("magType").alias("mag_type"),
        S.alert_label("alert").alias("alert"),
        S.status_label("status").alias("status"),
    ]
    if "distance_km" in df.columns:
        cols.append(S.round_float("distance_km", 2).alias("distance_km"))
    return df.select(*cols)


def map_points(df: DataFrame) -> DataFrame:
    """Marker colour by display class, marker size max(4, min(6 + 2.2 mag, 24))
    (null magnitude counts as 0), and the label parts."""
    t = S.to_time(F.col("time"))
    cols = [
        "usgs_id",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.coalesce(F.col("mag").cast("double"), F.lit(0.0)).alias("mag"),
        S.mag_colour("mag").alias("colour"),
        S.marker_size("mag").alias("size"),
        F.coalesce(F.col("place"), F.lit(S.NO_PLACE)).alias("place_label"),
        S.number_text("depth").alias("depth_label"),
        F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit("--")).alias("date_label"),
        F.coalesce(F.concat(F.date_format(t, "HH:mm"), F.lit(" UTC")), F.lit("--")).alias("hour_label"),
        F.coalesce(F.date_format(t, "yyyy-MM"), F.lit("--")).alias("month_label"),
        F.coalesce(F.date_format(t, "yyyy"), F.lit("--")).alias("year_label"),
    ]
    if "distance_km" in df.columns:
        cols.append(S.number_text("distance_km").alias("distance_label"))
    return df.select(*cols)
