"""DuckDB oracle texts: the same derived events and query semantics in plain SQL.

Used by ``__spark_entry__.oracle_sql`` and the tests.  Nothing here runs on
Spark; it is the independent statement each Spark plan is checked against.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

DERIVED_EVENTS = """
ev AS (
 SELECT event_id AS seq,
 concat('ev', CAST(event_id AS VARCHAR)) AS usgs_id,
 CASE WHEN event_id % 97 = 0 THEN NULL
      ELSE CAST((event_id * 37 % 1100 - 150) / 100.0 AS DECIMAL(6,2)) END AS mag,
 CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Mid-ocean ridge'
  WHEN 3 THEN concat('12 km S of ', n_name)
  ELSE concat(CAST(event_id % 200 AS VARCHAR), ' km NE of Town, Province, ', n_name) END AS place,
 ts AS time,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts + INTERVAL 3 HOURS END AS updated,
 CASE event_id % 4 WHEN 0 THEN 'ml' WHEN 1 THEN 'mb' WHEN 2 THEN 'mww' ELSE NULL END AS magtype,
 CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS tsunami,
 CASE event_id % 7 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' WHEN 2 THEN 'orange'
  WHEN 3 THEN 'red' ELSE NULL END AS alert,
 CASE event_id % 3 WHEN 0 THEN 'reviewed' WHEN 1 THEN 'automatic' ELSE NULL END AS status,
 CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST(event_id % 1000 AS INT) END AS sig,
 CASE WHEN event_id % 89 = 0 THEN NULL
      ELSE CAST((event_id * 131 % 70000) / 100.0 AS DECIMAL(10,2)) END AS depth,
 CASE WHEN event_id % 101 = 0 THEN NULL
      ELSE CAST((((user_id % 25) * 53 % 360 - 180) * 1000
                 + (event_id * 7919 % 6001 - 3000)) / 1000.0 AS DECIMAL(10,6)) END AS longitude,
 CAST((((user_id % 25) * 37 % 160 - 80) * 1000
       + (event_id * 104729 % 6001 - 3000)) / 1000.0 AS DECIMAL(10,6)) AS latitude,
 event_type
 FROM events JOIN nation ON n_nationkey = user_id % 25
)"""

QUAKES = """
quakes AS (
 SELECT seq + 1 AS id, usgs_id, mag, coalesce(place, 'Unknown') AS place, time, updated,
  coalesce(magtype, 'unknown') AS "magType", coalesce(tsunami, 0) AS tsunami,
  coalesce(alert, '') AS alert, coalesce(status, 'unknown') AS status, coalesce(sig, 0) AS sig,
  depth, longitude, latitude
 FROM ev
 WHERE longitude IS NOT NULL AND latitude IS NOT NULL
   AND longitude BETWEEN -180 AND 180 AND latitude BETWEEN -90 AND 90
)"""


def with_ctes(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([DERIVED_EVENTS.strip(), QUAKES.strip(), *[c.strip() for c in ctes]]) + "\n"


def window(days: int | None, col: str = "time") -> str:
    if days is None:
        return "TRUE"
    return f"{col} > {AS_OF_SQL} - INTERVAL {int(days)} DAY"


def mag_range(lo: float = -2, hi: float = 10) -> str:
    return f"mag BETWEEN {lo} AND {hi}"


# Labels and limits of magnitude classes, regions and depth classes.
CATEGORY = ("CASE WHEN mag < 2 THEN 'Micro' WHEN mag < 4 THEN 'Leve' "
            "WHEN mag < 6 THEN 'Fuerte' ELSE 'Severo' END")
REGION = (r"CASE WHEN place IS NULL OR trim(place) = '' THEN 'Sin ubicación' "
          r"WHEN place LIKE '%,%' THEN trim(regexp_replace(place, '(?s)^.*,\s*', '')) "
          r"WHEN position(' of ' IN place) > 0 THEN trim(regexp_replace(place, '(?s)^.* of\s+', '')) "
          r"ELSE place END")
DEPTH_GROUP = ("CASE WHEN depth < 70 THEN 'Superficial' WHEN depth < 300 THEN 'Intermedia' "
               "ELSE 'Profunda' END")


def avg_exact(col: str, in_scale: int = 2, out_scale: int = 2) -> str:
    """Average of a decimal column rounded half away from zero, as DOUBLE."""
    units = f"CAST({col} * {10 ** in_scale} AS HUGEINT)"
    q = 10 ** (in_scale - out_scale)
    s, n = f"sum({units})", f"count({col})"
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((2 * abs({s}) + {q} * {n}) // (2 * {q} * {n})) AS DOUBLE)"
            f" / {float(10 ** out_scale)} END")


def filtered(days: int | None = 30, lo: float = -2, hi: float = 10, extra: str = "TRUE") -> str:
    return (f"filtered AS (SELECT *, {CATEGORY} AS category, {REGION} AS region FROM quakes "
            f"WHERE {mag_range(lo, hi)} AND {window(days)} AND {extra})")


LIST_SELECT = ('id, usgs_id, CAST(mag AS DOUBLE) AS mag, place, time, "magType", tsunami, alert, status, sig, '
               'CAST(depth AS DOUBLE) AS depth, CAST(longitude AS DOUBLE) AS longitude, '
               'CAST(latitude AS DOUBLE) AS latitude')

SORTS = {
    "recent": "time DESC NULLS FIRST, id DESC NULLS FIRST, usgs_id",
    "mag_desc": "mag DESC NULLS LAST, time DESC NULLS FIRST, usgs_id",
    "mag_asc": "mag ASC NULLS LAST, time DESC NULLS FIRST, usgs_id",
    "distance": "distance_km ASC NULLS LAST, time DESC NULLS FIRST, usgs_id",
}


# --- Geodesic distance (same method as the Spark plan: Vincenty, fixed steps) ------

WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
MEAN_RADIUS_M = (2 * WGS84_A + WGS84_B) / 3


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (f"(2 * {MEAN_RADIUS_M!r} * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))")


def vincenty_sql(source: str, lon1: str, lat1: str, lon2: str, lat2: str, out: str = "distance_m",
                 steps: int = 12) -> str:
    """SELECT *, <spheroid distance> AS out FROM (source) - one nested level per step."""
    a, b, f = WGS84_A, WGS84_B, WGS84_F
    q = (f"SELECT *, radians({lon2} - {lon1}) AS _gL, sin(atan({1 - f!r} * tan(radians({lat1})))) AS _gs1, "
         f"cos(atan({1 - f!r} * tan(radians({lat1})))) AS _gc1, sin(atan({1 - f!r} * tan(radians({lat2})))) AS _gs2, "
         f"cos(atan({1 - f!r} * tan(radians({lat2})))) AS _gc2 FROM ({source}) _s0")
    q = f"SELECT *, _gL AS _glam FROM ({q}) _s1"

    def state(inner: str, k: int) -> str:
        ss = "sqrt(pow(_gc2 * sin(_glam), 2) + pow(_gc1 * _gs2 - _gs1 * _gc2 * cos(_glam), 2))"
        cs = "(_gs1 * _gs2 + _gc1 * _gc2 * cos(_glam))"
        s = f"SELECT *, {ss} AS _gss{k}, {cs} AS _gcs{k} FROM ({inner}) _a{k}"
        sa = f"(CASE WHEN _gss{k} = 0 THEN 0.0 ELSE _gc1 * _gc2 * sin(_glam) / _gss{k} END)"
        s = f"SELECT *, atan2(_gss{k}, _gcs{k}) AS _gsig{k}, {sa} AS _gsa{k}, 1.0 - {sa} * {sa} AS _gcsa{k} FROM ({s}) _b{k}"
        c2 = f"(CASE WHEN _gcsa{k} = 0 THEN 0.0 ELSE _gcs{k} - 2.0 * _gs1 * _gs2 / _gcsa{k} END)"
        return f"SELECT *, {c2} AS _gc2m{k} FROM ({s}) _c{k}"

    for k in range(steps):
        q = state(q, k)
        C = f"({f / 16!r} * _gcsa{k} * (4.0 + {f!r} * (4.0 - 3.0 * _gcsa{k})))"
        lam = (f"_gL + (1.0 - {C}) * {f!r} * _gsa{k} * (_gsig{k} + {C} * _gss{k} * (_gc2m{k} + {C} * _gcs{k} "
               f"* (-1.0 + 2.0 * _gc2m{k} * _gc2m{k})))")
        q = f"SELECT * REPLACE ({lam} AS _glam) FROM ({q}) _d{k}"
    k = steps
    q = state(q, k)
    usq = f"(_gcsa{k} * {(a * a - b * b) / (b * b)!r})"
    A = f"(1.0 + {usq} / 16384 * (4096.0 + {usq} * (-768.0 + {usq} * (320.0 - 175.0 * {usq}))))"
    B = f"({usq} / 1024 * (256.0 + {usq} * (-128.0 + {usq} * (74.0 - 47.0 * {usq}))))"
    c2m, ss, cs = f"_gc2m{k}", f"_gss{k}", f"_gcs{k}"
    dsig = (f"({B} * {ss} * ({c2m} + {B} / 4 * ({cs} * (-1.0 + 2.0 * {c2m} * {c2m}) - {B} / 6 * {c2m} "
            f"* (-3.0 + 4.0 * {ss} * {ss}) * (-3.0 + 4.0 * {c2m} * {c2m}))))")
    dist = f"(CASE WHEN {ss} = 0 THEN 0.0 ELSE {b!r} * {A} * (_gsig{k} - {dsig}) END)"
    return f"SELECT *, {dist} AS {out} FROM ({q}) _e"


def radius_rows(source: str, lat: float, lon: float, dist_km: float, method: str = "spheroid") -> str:
    """Rows of ``source`` within the radius, with a ``distance_m`` column (plus helper columns)."""
    lon_c, lat_c = "CAST(longitude AS DOUBLE)", "CAST(latitude AS DOUBLE)"
    if method == "sphere":
        inner = f"SELECT *, {haversine_sql(lon_c, lat_c, repr(float(lon)), repr(float(lat)))} AS distance_m FROM ({source}) _h"
    else:
        inner = vincenty_sql(source, lon_c, lat_c, repr(float(lon)), repr(float(lat)))
    return f"SELECT * FROM ({inner}) _r WHERE distance_m <= {float(dist_km) * 1000.0!r}"


# --- Raw table, upserts, curation -----------------------------------------------------

RAW_OUT = [  # (name, DuckDB expression over ev)
    ("id", "usgs_id"), ("usgs_id", "usgs_id"), ("mag", "mag"), ("place", "place"), ("time", "time"),
    ("updated", "updated"), ("tz", "CAST(NULL AS INTEGER)"), ("url", "CAST(NULL AS VARCHAR)"),
    ("detail", "CAST(NULL AS VARCHAR)"), ("felt", "CAST(NULL AS INTEGER)"), ("cdi", "CAST(NULL AS DECIMAL(4,2))"),
    ("mmi", "CAST(NULL AS DECIMAL(4,2))"), ("alert", "alert"), ("status", "status"), ("tsunami", "tsunami"),
    ("sig", "sig"), ("net", "event_type"), ("code", "CAST(seq AS VARCHAR)"), ("ids", "concat(',', usgs_id, ',')"),
    ("sources", "concat(',', event_type, ',')"), ("types", "CAST(NULL AS VARCHAR)"), ("nst", "CAST(NULL AS INTEGER)"),
    ("dmin", "CAST(NULL AS DECIMAL(10,4))"), ("rms", "CAST(NULL AS DECIMAL(10,4))"),
    ("gap", "CAST(NULL AS DECIMAL(8,2))"), ("magType", "magtype"), ("geometry_type", "'Point'"),
    ("longitude", "longitude"), ("latitude", "latitude"), ("depth", "depth"),
]
RAW_NAMES = [n for n, _ in RAW_OUT]
RAW_CTE = ("raw AS (SELECT seq, " + ", ".join(f'{e} AS "{n}"' for n, e in RAW_OUT)
           + f", {AS_OF_SQL} AS ingested_at FROM ev)")
HALVES = ("cur AS (SELECT * FROM raw WHERE seq % 3 < 2)",
          "bat AS (SELECT * REPLACE (CAST(mag + 0.1 AS DECIMAL(6,2)) AS mag, updated + INTERVAL 1 HOUR AS updated) "
          "FROM raw WHERE seq % 3 > 0)")
DECIMAL_OUT = {"mag", "cdi", "mmi", "dmin", "rms", "gap", "longitude", "latitude", "depth"}


def out_col(name: str, alias: str | None = None) -> str:
    q = f'"{name}"'
    return f"CAST({q} AS DOUBLE) AS {q}" if name in DECIMAL_OUT else q


def raw_upsert_cte(update_cols: list[str], stamp_sql: str, name: str = "up") -> str:
    sel = []
    for n in RAW_NAMES:
        if n == "usgs_id":
            sel.append("coalesce(c.usgs_id, b.usgs_id) AS usgs_id")
        elif n in update_cols:
            sel.append(f'CASE WHEN b.usgs_id IS NOT NULL THEN b."{n}" ELSE c."{n}" END AS "{n}"')
        else:
            sel.append(f'CASE WHEN c.usgs_id IS NOT NULL THEN c."{n}" ELSE b."{n}" END AS "{n}"')
    sel.append(f"CASE WHEN b.usgs_id IS NOT NULL THEN {stamp_sql} ELSE c.ingested_at END AS ingested_at")
    return f"{name} AS (SELECT {', '.join(sel)} FROM cur c FULL OUTER JOIN bat b ON c.usgs_id = b.usgs_id)"


CLEAN_SELECT = ("usgs_id, mag, coalesce(place, 'Unknown') AS place, time, updated, "
                "coalesce(\"magType\", 'unknown') AS \"magType\", coalesce(tsunami, 0) AS tsunami, "
                "coalesce(alert, '') AS alert, coalesce(status, 'unknown') AS status, coalesce(sig, 0) AS sig, "
                "depth, longitude, latitude")
VALID = ("longitude IS NOT NULL AND latitude IS NOT NULL AND longitude BETWEEN -180 AND 180 "
         "AND latitude BETWEEN -90 AND 90")
FINAL_DATA = ["mag", "place", "time", "updated", "magType", "tsunami", "alert", "status", "sig", "depth",
              "longitude", "latitude"]


def first_load_cte(name: str, source: str, stamp_sql: str) -> str:
    return (f"{name} AS (SELECT row_number() OVER (ORDER BY time, usgs_id) AS id, *, {stamp_sql} AS processed_at "
            f"FROM (SELECT {CLEAN_SELECT} FROM {source} WHERE {VALID}) _c)")
