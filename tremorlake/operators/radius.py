"""Radius predicate and radius search.

Plan shape: a decimal bounding-box filter on latitude/longitude (pushed to the
parquet scan, splits at the date line, opens up at the poles), then the exact
test.  With ``method='spheroid'`` the sphere decides every row outside a thin
ring around the radius and the spheroid distance decides the ring; the search
output needs the spheroid distance anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geodesic as G
from . import query as Q


def _distance(df: DataFrame, lat: float, lon: float, method: str, out: str = "distance_m") -> DataFrame:
    plat, plon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    if method == "sphere":
        return df.withColumn(out, G.haversine_m(plon, plat, F.lit(float(lon)), F.lit(float(lat))))
    return df.withColumn(out, G.geodesic_m(plon, plat, float(lon), float(lat)))


def within_km(df: DataFrame, lat: float, lon: float, dist_km: float, method: str = "spheroid") -> DataFrame:
    """Rows whose point lies within ``dist_km`` of (lat, lon), inclusive."""
    r = float(dist_km) * 1000.0
    boxed = df.filter(G.box_filter(F.col("latitude"), F.col("longitude"), G.bounding_box(lat, lon, r)))
    plat, plon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    hav = G.haversine_m(plon, plat, F.lit(float(lon)), F.lit(float(lat)))
    if method == "sphere":
        return boxed.filter(hav <= F.lit(r))
    inner = hav <= F.lit(r * (1 - G.SPHERE_MARGIN))
    in_ring = ~inner & (hav <= F.lit(r * (1 + G.SPHERE_MARGIN)))
    # Only ring rows carry coordinates into the spheroid distance; the rest are
    # decided by the sphere and pass nulls (masked, no work).
    geo = G.geodesic_m(F.when(in_ring, plon), F.when(in_ring, plat), float(lon), float(lat))
    return boxed.filter(inner | (in_ring & (geo <= F.lit(r))))


def distance_km_rounded(col: str = "distance_m"):
    """Metres -> km rounded half away from zero to 2 places, as double."""
    return F.round((F.col(col) / F.lit(1000.0)).cast("decimal(38,10)"), 2).cast("double")


def radius_search(df: DataFrame, lat: float, lon: float, dist_km: float = 10, min_mag: float = -2,
                  max_mag: float = 10, days_back: int = 30, limit: int = 100, offset: int = 0,
                  all_time: bool = False, sort: str = "distance", as_of=None, method: str = "spheroid") -> DataFrame:
    """Events within the radius, mag range and window, with ``distance_km``
    (rounded to 2 places), sorted (the rounded distance is the sort key) and
    paged; ``total_count`` on each row.

    The count needs no distances: the sphere decides all but a thin ring."""
    Q.check_args(min_mag, max_mag, limit, offset, days_back, lat=lat, lon=lon, dist_km=dist_km, radius_required=True)
    f = Q.filtered_events(df, min_mag, max_mag, days_back, all_time, as_of)
    r = float(dist_km) * 1000.0
    boxed = f.filter(G.box_filter(F.col("latitude"), F.col("longitude"), G.bounding_box(lat, lon, r)))
    with_d = _distance(boxed, lat, lon, method).filter(F.col("distance_m") <= F.lit(r))
    with_d = with_d.withColumn("distance_km", distance_km_rounded()).drop("distance_m")
    mode = Q.sort_mode(sort, radius=True)
    page = Q.page_rows(with_d, Q.sort_columns(mode), offset, limit, mode)
    return Q.with_total(Q.list_columns(page, ["distance_km"]), within_km(f, lat, lon, dist_km, method))
