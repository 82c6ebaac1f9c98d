"""Named zones (G7, G8) and the events-near-zones distance join.

The distance join never compares every event with every zone: zones expand to
the grid cells their bounding boxes cover (zones of similar radius on a grid
whose cell is as wide as they are, so a zone covers a handful of cells), events
take one cell key for each grid, and the equi-join on the cell key is followed by the exact
radius test.  The expanded zone table is small and broadcast once its size is
proven; beyond the bound it is shuffled like any join side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geodesic as G
from ..functions import scalar as S
from ..session import broadcast_checked


def country_zones(countries: DataFrame) -> DataFrame:
    """Country rows (name, native_name, name_es, iso_code, lat, lon, area, ord) ->
    zone candidates: display name (Spanish, else native, else name; blanks
    collapsed; first letter upper-cased), radius from area, code, order."""
    raw = F.coalesce(F.nullif(F.col("name_es"), F.lit("")), F.nullif(F.col("native_name"), F.lit("")),
                     F.col("name"))
    collapsed = F.regexp_replace(F.trim(raw), r"\s+", " ")
    display = F.concat(F.upper(F.substring(collapsed, 1, 1)), F.substring(collapsed, 2, 1 << 20))
    return countries.select(
        display.alias("name"), S.to_number(F.col("lat")).alias("lat"), S.to_number(F.col("lon")).alias("lon"),
        S.radius_from_area(F.col("area")).alias("radius_km"), F.col("iso_code").alias("code"), F.col("ord"))


def build_zones(static: DataFrame, countries: DataFrame) -> DataFrame:
    """Static zones win; a country is added when its name key is new and
    its code was not seen on an earlier country row (added or not); among
    countries with one name key the first added wins.  (name, lat, lon,
    radius_km, name_key) ordered by name key."""
    st = static.select("name", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
                       F.col("radius_km").cast("int").alias("radius_km"))
    c = country_zones(countries)
    c = c.withColumn("key", S.name_key("name"))
    code_first = F.row_number().over(Window.partitionBy("code").orderBy("ord"))
    c = c.withColumn("_code_rank", F.when(F.col("code").isNull(), F.lit(1)).otherwise(code_first))
    valid = F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.length(F.col("name")) > 0)
    cand = c.filter(valid & (F.col("_code_rank") == 1))
    st_keys = st.select(S.name_key("name").alias("key"))
    cand = cand.join(st_keys, "key", "left_anti")
    first_key = F.row_number().over(Window.partitionBy("key").orderBy("ord"))
    added = cand.withColumn("_k", first_key).filter(F.col("_k") == 1).select("name", "lat", "lon", "radius_km")
    out = st.unionByName(added)
    return out.withColumn("name_key", S.name_key("name")).orderBy("name_key", "name")


def _grid_cells(max_span_deg: float) -> tuple[float, int]:
    """Cell side (degrees) >= ``max_span_deg`` that tiles 360 exactly, and the count."""
    n = max(1, int(360 // max(max_span_deg, 1e-6)))
    return 360.0 / n, n


#: Classes of zones by radius: class c holds radii up to 2 ** c km; the last one all that are wider.
CLASSES = 15


def zone_class(radius_km: Column) -> Column:
    return F.least(F.ceil(F.log2(F.greatest(radius_km, F.lit(1.0)))).cast("int"), F.lit(CLASSES))


def _grids() -> list[tuple[float, int]]:
    """(cell, number of cells around the globe) for each class: cells as wide as its zones."""
    return [_grid_cells(2 * (2.0 ** c * 1000.0 / G.MIN_DEGREE_M * 1.0001) + 1e-6) for c in range(CLASSES + 1)]


def _of_class(c: Column) -> tuple[Column, Column]:
    grids = _grids()
    return (F.element_at(F.array(*[F.lit(cell) for cell, _ in grids]), c + 1),
            F.element_at(F.array(*[F.lit(n) for _, n in grids]), c + 1))


def zone_cells(zones: DataFrame) -> DataFrame:
    """Each zone exploded to the cells (class, ilat, ilon) of its class's grid that its bounding box covers."""
    zones = zones.withColumn("class", zone_class(F.col("radius_km")))
    cell, n_lon = _of_class(F.col("class"))
    r = F.col("radius_km").cast("double") * F.lit(1000.0)
    dlat = r / F.lit(G.MIN_DEGREE_M) * F.lit(1.0001) + F.lit(1e-9)
    lat_lo, lat_hi = F.col("lat") - dlat, F.col("lat") + dlat
    pole = (lat_lo <= -90) | (lat_hi >= 90)
    ang = r * F.lit(1 + G.SPHERE_MARGIN) / F.lit(G.MEAN_RADIUS_M)
    edge = F.greatest(F.abs(lat_lo), F.abs(lat_hi))
    ratio = F.sin(ang) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-12))
    full = pole | (ratio >= 1)
    dlon = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * F.lit(1.0001) + F.lit(1e-9)
    lon_lo = F.when(full, F.lit(-180.0)).otherwise(F.col("lon") - dlon)
    lon_hi = F.when(full, F.lit(180.0 - 1e-9)).otherwise(F.col("lon") + dlon)
    lat_cells = F.sequence(F.floor(F.greatest(lat_lo, F.lit(-90.0)) / cell).cast("int"),
                           F.floor(F.least(lat_hi, F.lit(90.0)) / cell).cast("int"))
    lon_cells = F.sequence(F.floor((lon_lo + F.lit(180.0)) / cell).cast("int"),
                           F.floor((lon_hi + F.lit(180.0)) / cell).cast("int"))
    return zones.select("*", F.explode(lat_cells).alias("ilat"), F.explode(F.array_distinct(
        F.transform(lon_cells, lambda k: F.pmod(k, n_lon)))).alias("ilon"))


def near_zones(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Every (zone, event) pair with the event within the zone's radius
    (spheroid), with ``distance_km`` rounded to 2 places.

    Zones of similar radius (a factor of two) share a grid whose cells are as wide
    as they are, so one wide zone does not coarsen the cells of small ones.  An
    event takes one cell key, class and cell, for each class that occurs (at most
    CLASSES + 1); all keys meet all zones in one join, so events are scanned once.
    """
    zones = zones.select("name", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
                         F.col("radius_km").cast("double").alias("radius_km")).filter("radius_km is not null")
    cells = broadcast_checked(zone_cells(zones).select(
        F.col("name").alias("zone"), F.col("lat").alias("zlat"), F.col("lon").alias("zlon"), F.col("radius_km").alias("zr"),
        F.col("class").alias("_class"), F.col("ilat").alias("_ilat"), F.col("ilon").alias("_ilon")))
    occurring = zones.agg(F.collect_set(zone_class(F.col("radius_km")))).scalar()
    plat, plon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    rm = F.col("zr") * F.lit(1000.0)
    located = events.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    keyed = located.select("*", F.explode(occurring).alias("_class"))
    cell, n_lon = _of_class(F.col("_class"))
    keyed = keyed.select("*", F.floor(plat / cell).cast("int").alias("_ilat"),
                         F.pmod(F.floor((plon + F.lit(180.0)) / cell).cast("int"), n_lon).alias("_ilon"))
    near = keyed.join(cells, ["_class", "_ilat", "_ilon"]).drop("_class", "_ilat", "_ilon")
    near = near.filter(G.haversine_m(plon, plat, F.col("zlon"), F.col("zlat")) <= rm * F.lit(1 + G.SPHERE_MARGIN))
    with_d = near.withColumn("_d", G.geodesic_m(plon, plat, F.col("zlon"), F.col("zlat"))).filter(F.col("_d") <= rm)
    return with_d.select("zone", *events.columns,
                         F.round((F.col("_d") / F.lit(1000.0)).cast("decimal(38,10)"), 2).cast("double").alias("distance_km"))


def zone_summary(pairs: DataFrame) -> DataFrame:
    """Per zone: events, average magnitude, nearest distance."""
    return pairs.groupBy("zone").agg(F.count(F.lit(1)).alias("events"), S.avg_rounded("mag").alias("avg_magnitude"),
                                     F.min("distance_km").alias("nearest_km"))
