"""Registered queries: one Spark plan per operator of the survey, with its oracle.

Each query takes (spark, sf_dir), reads the given tables (events, nation) and
returns a DataFrame; ``ORACLE[name]`` is the matching DuckDB text.  Parameters
are fixed per query so both sides answer the same question.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import scalar as S
from ..operators import analysis as A
from ..operators import cluster as CL
from ..operators import query as Q
from ..operators import report as R
from ..operators import upsert as U
from ..operators import zones as Z
from ..operators.clean import clean
from ..operators.constraints import check_schema
from ..schema import CURATE_INPUT_COLUMNS, RAW_TEXT_LIMITS, RAW_UPDATE_COLUMNS
from ..session import scratch_path
from ..sources import feed as FEED
from ..sources import sinks as SINK
from ..sources import tables as T
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _quakes(spark, sf_dir):
    return T.quakes(spark, sf_dir, T.AS_OF)


# --- Curated table ------------------------------------------------------------------

@register("clean_events", O.with_ctes() + """
SELECT usgs_id, CAST(mag AS DOUBLE) AS mag, place, time, updated, "magType", tsunami, alert, status, sig,
 CAST(depth AS DOUBLE) AS depth, CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM quakes""")
def q_clean_events(spark, sf_dir):
    q = _quakes(spark, sf_dir)
    return q.select("usgs_id", *[F.col(c).cast("double").alias(c) if c in ("mag", "depth", "longitude", "latitude")
                                 else F.col(c) for c in ["mag", "place", "time", "updated", "magType", "tsunami",
                                                         "alert", "status", "sig", "depth", "longitude", "latitude"]])


# --- Lists and pages ----------------------------------------------------------------------

def _list_sql(sort: str, days: int | None = 7, limit: int = 100, offset: int = 0) -> str:
    return O.with_ctes(f"f AS (SELECT * FROM quakes WHERE {O.mag_range()} AND {O.window(days)})") + f"""
SELECT {O.LIST_SELECT}, CAST((SELECT count(*) FROM f) AS INTEGER) AS total_count
FROM f ORDER BY {O.SORTS[sort]} LIMIT {limit} OFFSET {offset}"""


for _mode in ("recent", "mag_desc", "mag_asc"):
    def _make(mode):
        def fn(spark, sf_dir):
            return Q.list_events(_quakes(spark, sf_dir), sort=mode, as_of=T.AS_OF)
        return fn
    register(f"event_list_{_mode}", _list_sql(_mode))(_make(_mode))

PAGE_NO = 3


@register("event_page", O.with_ctes(f"f AS (SELECT * FROM quakes WHERE {O.mag_range()})") + f"""
SELECT {O.LIST_SELECT}, CAST((SELECT count(*) FROM f) AS INTEGER) AS total_count,
 {PAGE_NO} AS page, CAST(greatest(1, ceil(greatest((SELECT count(*) FROM f), 1) / 250.0)) AS INTEGER) AS pages
FROM f ORDER BY {O.SORTS['recent']} LIMIT 250 OFFSET {(PAGE_NO - 1) * 250}""")
def q_event_page(spark, sf_dir):
    return Q.event_page(_quakes(spark, sf_dir), PAGE_NO, as_of=T.AS_OF)


DETAIL_ID = "ev123"


@register("event_detail", O.with_ctes() + f"""
SELECT id, usgs_id, mag, place, time, updated, "magType", tsunami, alert, status, sig, depth, longitude, latitude
FROM quakes WHERE usgs_id = '{DETAIL_ID}'""")
def q_event_detail(spark, sf_dir):
    return Q.detail(_quakes(spark, sf_dir), DETAIL_ID)


# --- Summaries ---------------------------------------------------------------------------

@register("table_summary", O.with_ctes() + f"""
SELECT count(*) AS total_events, {O.avg_exact('mag')} AS avg_magnitude,
 CAST(max(mag) AS DOUBLE) AS max_magnitude, CAST(min(mag) AS DOUBLE) AS min_magnitude,
 CAST(sum(tsunami) AS BIGINT) AS total_tsunami, max(time) AS last_update,
 (SELECT place FROM quakes ORDER BY mag DESC NULLS FIRST, usgs_id LIMIT 1) AS most_active_place
FROM quakes""")
def q_table_summary(spark, sf_dir):
    return A.table_summary(_quakes(spark, sf_dir))


def _analysis_frame(spark, sf_dir):
    return A.analysis_filter(_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF)


@register("analysis_summary", O.with_ctes(O.filtered()) + f"""
SELECT CAST(count(*) AS INTEGER) AS total_events, {O.avg_exact('mag')} AS avg_magnitude,
 {O.avg_exact('depth')} AS avg_depth, CAST(max(mag) AS DOUBLE) AS max_magnitude,
 CAST(min(mag) AS DOUBLE) AS min_magnitude, max(time) AS last_update
FROM filtered""")
def q_analysis_summary(spark, sf_dir):
    return A.summary(_analysis_frame(spark, sf_dir))


_CATEGORY_SQL = O.with_ctes(O.filtered(), "labels AS (SELECT * FROM (VALUES ('Micro'), ('Leve'), ('Fuerte'), "
                             "('Severo')) t(category))") + """
SELECT l.category, CAST(count(f.category) AS INTEGER) AS events
FROM labels l LEFT JOIN filtered f ON f.category = l.category GROUP BY l.category"""


@register("category_counts", _CATEGORY_SQL)
def q_category_counts(spark, sf_dir):
    return A.category_counts(_analysis_frame(spark, sf_dir))


@register("dominant_category", O.with_ctes(O.filtered(), "labels AS (SELECT * FROM (VALUES ('Micro', 0), ('Leve', 1), "
                                           "('Fuerte', 2), ('Severo', 3)) t(category, rnk))",
                                           "counts AS (SELECT l.category, l.rnk, count(f.category) AS events FROM labels l "
                                           "LEFT JOIN filtered f ON f.category = l.category GROUP BY l.category, l.rnk)") + f"""
SELECT CASE WHEN sum(events) > 0 THEN arg_max(category, events * 10 - rnk) ELSE '--' END AS dominant_category,
 CAST(sum(events) AS BIGINT) AS total_events,
 CASE WHEN sum(events) <= 0 THEN '{S.INSIGHT_TEXT['none']}'
      WHEN sum(events) FILTER (WHERE category = 'Severo') > 0 THEN '{S.INSIGHT_TEXT['severe']}'
      WHEN sum(events) FILTER (WHERE category = 'Fuerte') > 0 THEN '{S.INSIGHT_TEXT['strong']}'
      ELSE '{S.INSIGHT_TEXT['low']}' END AS insight
FROM counts""")
def q_dominant_category(spark, sf_dir):
    return A.dominant_category(A.category_counts(_analysis_frame(spark, sf_dir)))


@register("top_regions", O.with_ctes(O.filtered()) + f"""
SELECT region, CAST(count(*) AS INTEGER) AS events, {O.avg_exact('mag')} AS avg_magnitude
FROM filtered GROUP BY region ORDER BY events DESC, avg_magnitude DESC NULLS FIRST, region LIMIT 8""")
def q_top_regions(spark, sf_dir):
    return A.top_regions(_analysis_frame(spark, sf_dir))


@register("depth_groups", O.with_ctes(O.filtered()) + f"""
SELECT {O.DEPTH_GROUP} AS depth_group, CAST(count(*) AS INTEGER) AS events, {O.avg_exact('mag')} AS avg_magnitude
FROM filtered GROUP BY 1 ORDER BY events DESC, depth_group""")
def q_depth_groups(spark, sf_dir):
    return A.depth_groups(_analysis_frame(spark, sf_dir))


@register("strongest_events", O.with_ctes(O.filtered()) + """
SELECT usgs_id, CAST(round(mag, 2) AS DOUBLE) AS mag, place, time, CAST(round(depth, 2) AS DOUBLE) AS depth,
 CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM filtered ORDER BY mag DESC NULLS FIRST, time DESC NULLS FIRST, usgs_id LIMIT 5""")
def q_strongest(spark, sf_dir):
    return Q.strongest(_analysis_frame(spark, sf_dir))


_PERIOD_FMT = {"day": "%Y-%m-%d", "month": "%Y-%m", "year": "%Y"}
for _unit, _name in (("day", "daily_counts"), ("month", "monthly_counts"), ("year", "yearly_counts")):
    def _make_period(unit):
        def fn(spark, sf_dir):
            return A.period_counts(_analysis_frame(spark, sf_dir), unit)
        return fn
    register(_name, O.with_ctes(O.filtered()) + f"""
SELECT strftime(date_trunc('{_unit}', time), '{_PERIOD_FMT[_unit]}') AS period, CAST(count(*) AS INTEGER) AS events,
 {O.avg_exact('mag')} AS avg_magnitude
FROM filtered GROUP BY date_trunc('{_unit}', time) ORDER BY date_trunc('{_unit}', time)""")(_make_period(_unit))


_GS_PARTS = {
    "category": "category",
    "region": "region",
    "depth_group": O.DEPTH_GROUP,
    "day": "strftime(time, '%Y-%m-%d')",
    "month": "strftime(time, '%Y-%m')",
    "year": "strftime(time, '%Y')",
}
_GS_SQL = O.with_ctes(O.filtered()) + "\nUNION ALL\n".join(
    [f"SELECT '{p}' AS part, {e} AS key, CAST(count(*) AS INTEGER) AS events, {O.avg_exact('mag')} AS avg_magnitude "
     f"FROM filtered GROUP BY 2" for p, e in _GS_PARTS.items()]
    + [f"SELECT 'all' AS part, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS INTEGER) AS events, "
       f"{O.avg_exact('mag')} AS avg_magnitude FROM filtered"])


@register("analysis_grouping_sets", _GS_SQL)
def q_analysis_grouping_sets(spark, sf_dir):
    return A.analysis_grouping_sets(_analysis_frame(spark, sf_dir))


@register("mean_centre", O.with_ctes(O.filtered(days=7)) + f"""
SELECT {O.avg_exact('latitude', 6, 6)} AS centre_lat, {O.avg_exact('longitude', 6, 6)} AS centre_lon,
 count(latitude) AS points FROM filtered""")
def q_mean_centre(spark, sf_dir):
    q = _quakes(spark, sf_dir)
    return A.mean_centre(Q.filtered_events(q, days_back=7, as_of=T.AS_OF))


# --- Radius search ---------------------------------------------------------------------

RADIUS = {"lat": 31.0, "lon": -21.0, "dist_km": 300.0}


def _radius_sql(method: str, sort: str = "distance") -> str:
    src = f"SELECT * FROM quakes WHERE {O.mag_range()} AND {O.window(30)}"
    rows = O.radius_rows(src, RADIUS["lat"], RADIUS["lon"], RADIUS["dist_km"], method)
    return O.with_ctes(f"r AS (SELECT *, CAST(round(CAST(distance_m / 1000.0 AS DECIMAL(38,10)), 2) AS DOUBLE) "
                       f"AS distance_km FROM ({rows}) _x)") + f"""
SELECT {O.LIST_SELECT}, distance_km, CAST((SELECT count(*) FROM r) AS INTEGER) AS total_count
FROM r ORDER BY {O.SORTS[sort]} LIMIT 100"""


for _method, _name in (("spheroid", "radius_search"), ("sphere", "radius_search_sphere")):
    def _make_radius(method):
        def fn(spark, sf_dir):
            from ..operators.radius import radius_search

            return radius_search(_quakes(spark, sf_dir), method=method, as_of=T.AS_OF, **RADIUS)
        return fn
    register(_name, _radius_sql(_method))(_make_radius(_method))


# --- Raw upsert, curation, tsunami table ---------------------------------------------------



STAMP_1 = T.AS_OF + _dt.timedelta(days=1)
STAMP_2 = T.AS_OF + _dt.timedelta(days=2)
STAMP_1_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
STAMP_2_SQL = "TIMESTAMP '2024-02-02 00:00:00'"


def _halves(spark, sf_dir):
    raw = T.derived_raw(spark, sf_dir, T.AS_OF)
    cur = raw.filter(F.col("seq") % 3 < 2).drop("seq")
    bat = (raw.filter(F.col("seq") % 3 > 0).drop("seq")
           .withColumn("mag", (F.col("mag") + F.lit(0.1).cast("decimal(2,1)")).cast("decimal(6,2)"))
           .withColumn("updated", F.col("updated") + F.expr("INTERVAL 1 HOUR")))
    return cur, bat


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in O.DECIMAL_OUT else F.col(c) for c in df.columns])


@register("raw_upsert", O.with_ctes(O.RAW_CTE, *O.HALVES, O.raw_upsert_cte(RAW_UPDATE_COLUMNS, STAMP_1_SQL)) + """
SELECT """ + ", ".join(O.out_col(n) for n in O.RAW_NAMES) + """, ingested_at FROM up""")
def q_raw_upsert(spark, sf_dir):
    cur, bat = _halves(spark, sf_dir)
    return _doubles(U.raw_upsert(cur, bat, stamp=T.ts_literal(STAMP_1)))


def _final_cols_sql(prefix: str = "") -> str:
    return ", ".join(O.out_col(n) for n in ["id", "usgs_id", *O.FINAL_DATA]) + ", processed_at"


_INCR_SQL = O.with_ctes(
    O.RAW_CTE, *O.HALVES, O.raw_upsert_cte(RAW_UPDATE_COLUMNS, STAMP_1_SQL),
    O.first_load_cte("f0", "cur", O.AS_OF_SQL),
    "ch AS (SELECT r.* FROM up r LEFT JOIN f0 e ON e.usgs_id = r.usgs_id WHERE r.longitude IS NOT NULL "
    "AND r.latitude IS NOT NULL AND (e.usgs_id IS NULL OR coalesce(r.updated, r.time, TIMESTAMP '1970-01-01') "
    "> coalesce(e.updated, e.time, TIMESTAMP '1970-01-01')))",
    f"cl AS (SELECT {O.CLEAN_SELECT} FROM ch WHERE {O.VALID})",
    "f1 AS (SELECT e.id, e.usgs_id, " + ", ".join(
        f'CASE WHEN c.usgs_id IS NOT NULL THEN c."{n}" ELSE e."{n}" END AS "{n}"' for n in O.FINAL_DATA)
    + f", CASE WHEN c.usgs_id IS NOT NULL THEN {STAMP_2_SQL} ELSE e.processed_at END AS processed_at "
    "FROM f0 e LEFT JOIN cl c ON c.usgs_id = e.usgs_id "
    "UNION ALL SELECT (SELECT max(id) FROM f0) + row_number() OVER (ORDER BY time, usgs_id) AS id, usgs_id, "
    + ", ".join(f'"{n}"' for n in O.FINAL_DATA) + f", {STAMP_2_SQL} AS processed_at "
    "FROM cl WHERE usgs_id NOT IN (SELECT usgs_id FROM f0))") + f"SELECT {_final_cols_sql()} FROM f1"


@register("curate_incremental", _INCR_SQL)
def q_curate_incremental(spark, sf_dir):
    cur, bat = _halves(spark, sf_dir)
    f0 = U.first_load(clean(T.read_raw(cur)), stamp=T.ts_literal(T.AS_OF))
    raw1 = U.raw_upsert(cur, bat, stamp=T.ts_literal(STAMP_1))
    ch = U.changed(raw1, f0)
    f1 = U.curated_upsert(f0, clean(ch.select(*CURATE_INPUT_COLUMNS)), stamp=T.ts_literal(STAMP_2))
    return _doubles(f1)


@register("curate_full", O.with_ctes(O.RAW_CTE, *O.HALVES, O.raw_upsert_cte(RAW_UPDATE_COLUMNS, STAMP_1_SQL),
                                     O.first_load_cte("f", "up", STAMP_2_SQL)) + f"SELECT {_final_cols_sql()} FROM f")
def q_curate_full(spark, sf_dir):
    cur, bat = _halves(spark, sf_dir)
    raw1 = U.raw_upsert(cur, bat, stamp=T.ts_literal(STAMP_1))
    return _doubles(U.first_load(clean(T.read_raw(raw1)), stamp=T.ts_literal(STAMP_2)))


@register("tsunami_events", O.with_ctes() + """
SELECT id, usgs_id, CAST(mag AS DOUBLE) AS mag, place, time, CAST(depth AS DOUBLE) AS depth,
 CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM quakes WHERE tsunami = 1""")
def q_tsunami_events(spark, sf_dir):
    return _doubles(U.refresh_tsunami(_quakes(spark, sf_dir)))


# --- Feed scan --------------------------------------------------------------------------------


_MS = "make_timestamp(epoch_us(\"{c}\") // 1000 * 1000)"


def _feed_select() -> str:
    sel = []
    for n in O.RAW_NAMES:
        if n == "time":
            sel.append(f'{_MS.format(c="time")} AS "time"')
        elif n == "updated":
            sel.append(f'coalesce({_MS.format(c="updated")}, {_MS.format(c="time")}) AS "updated"')
        else:
            sel.append(O.out_col(n))
    return f"SELECT {', '.join(sel)} FROM raw WHERE depth IS NOT NULL"


def _feed_sql() -> str:
    return O.with_ctes(O.RAW_CTE) + _feed_select()


def landed_feed(spark, sf_dir) -> str:
    """Write the derived events as feed documents to a fresh scratch folder."""
    path = scratch_path(spark, "feed")
    SINK.write_feed_documents(SINK.feed_documents(T.derived_raw(spark, sf_dir, T.AS_OF)), path)
    return path


@register("feed_scan", _feed_sql())
def q_feed_scan(spark, sf_dir):
    return _doubles(FEED.read_feed(spark, landed_feed(spark, sf_dir), strict=True, multi_line=False))


# --- Clusters -----------------------------------------------------------------------------------


CLUSTER_KM = 50.0


def _cluster_ctes(radius_km: float = CLUSTER_KM) -> list[str]:
    eps = CL.eps_from_km(radius_km)
    return [
        f"pts AS (SELECT id, usgs_id, mag, longitude, latitude, CAST(longitude AS DOUBLE) AS x, "
        f"CAST(latitude AS DOUBLE) AS y FROM quakes WHERE {O.window(7)})",
        f"e AS (SELECT a.id AS s, b.id AS d FROM pts a JOIN pts b "
        f"ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps * eps!r})",
        "reach(node, lbl) AS (SELECT id, id FROM pts UNION SELECT e.d, r.lbl FROM reach r JOIN e ON e.s = r.node)",
        "comp AS (SELECT node, min(lbl) AS cid FROM reach GROUP BY node)",
    ]


@register("clusters", O.with_ctes(*_cluster_ctes(), recursive=True) + f"""
SELECT cid AS cluster_id, {O.avg_exact('latitude', 6, 4)} AS centroid_lat, {O.avg_exact('longitude', 6, 4)} AS centroid_lng,
 count(*) AS earthquake_count, {O.avg_exact('mag')} AS avg_mag, CAST(max(mag) AS DOUBLE) AS max_mag
FROM pts JOIN comp ON comp.node = pts.id GROUP BY cid ORDER BY earthquake_count DESC, cluster_id""")
def q_clusters(spark, sf_dir):
    return CL.clusters(_quakes(spark, sf_dir), CLUSTER_KM, as_of=T.AS_OF)


@register("cluster_members", O.with_ctes(*_cluster_ctes(), recursive=True) + """
SELECT id, usgs_id, cid AS cluster_id FROM pts JOIN comp ON comp.node = pts.id""")
def q_cluster_members(spark, sf_dir):
    recent = Q.since(_quakes(spark, sf_dir), T.AS_OF, 7)
    labelled = CL.cluster_dbscan(recent.select("id", "usgs_id", "longitude", "latitude"), CL.eps_from_km(CLUSTER_KM))
    return labelled.select("id", "usgs_id", "cluster_id")


CORE_KM, CORE_POINTS = 20.0, 4


def _core_sql() -> str:
    pts, pairs = _cluster_ctes(CORE_KM)[:2]
    return O.with_ctes(
        pts, pairs, f"core AS (SELECT s AS id FROM e GROUP BY s HAVING count(*) >= {CORE_POINTS})",
        "ce AS (SELECT s, d FROM e WHERE s IN (SELECT id FROM core) AND d IN (SELECT id FROM core))",
        "reach(node, lbl) AS (SELECT id, id FROM core UNION SELECT ce.d, r.lbl FROM reach r JOIN ce ON ce.s = r.node)",
        "comp AS (SELECT node, min(lbl) AS cid FROM reach GROUP BY node)",
        "near AS (SELECT e.s AS id, min(c.cid) AS cid FROM e JOIN comp c ON c.node = e.d GROUP BY e.s)", recursive=True) + """
SELECT p.id, p.usgs_id, coalesce(c.cid, n.cid) AS cluster_id
FROM pts p LEFT JOIN comp c ON c.node = p.id LEFT JOIN near n ON n.id = p.id"""


@register("cluster_members_core", _core_sql())
def q_cluster_members_core(spark, sf_dir):
    """DBSCAN with four points to a core: border points join a cluster, noise has none."""
    recent = Q.since(_quakes(spark, sf_dir), T.AS_OF, 7)
    return CL.cluster_dbscan(recent.select("id", "usgs_id", "longitude", "latitude"), CL.eps_from_km(CORE_KM), min_points=CORE_POINTS)\
        .select("id", "usgs_id", "cluster_id")


# --- Zones and the zone distance join ---------------------------------------------------------



def nation_zones(spark, sf_dir) -> DataFrame:
    """One zone per nation (FIXTURES.md): lon = k*53 % 360 - 180, lat = k*37 % 160 - 80, radius 200 + 40k km."""
    k = F.col("n_nationkey")
    return T.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), (k * 37 % 160 - 80).cast("double").alias("lat"),
        (k * 53 % 360 - 180).cast("double").alias("lon"), (k * 40 + 200).cast("int").alias("radius_km"))


def derived_countries(spark, sf_dir) -> DataFrame:
    """Country rows derived from nation (same names, other spelling -> must be
    skipped) and region (codes repeat -> later rows skipped)."""
    k = F.col("n_nationkey")
    nat = T.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("  "), F.lower(F.col("n_name"))).alias("name"), F.lit(None).cast("string").alias("native_name"),
        F.lit(None).cast("string").alias("name_es"), F.concat(F.lit("N"), k.cast("string")).alias("iso_code"),
        (k * 37 % 160 - 80).cast("double").alias("lat"), (k * 53 % 360 - 180).cast("double").alias("lon"),
        (k * 250000).cast("double").alias("area"), k.cast("long").alias("ord"))
    r = F.col("r_regionkey")
    reg = T.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("name"), F.lit(None).cast("string").alias("native_name"),
        F.concat(F.lit("Región  "), F.initcap(F.col("r_name"))).alias("name_es"),
        F.concat(F.lit("R"), (r % 3).cast("string")).alias("iso_code"),
        (r * 17 - 40).cast("double").alias("lat"), (r * 61 - 150).cast("double").alias("lon"),
        (r * 600000).cast("double").alias("area"), (r + 100).cast("long").alias("ord"))
    return nat.unionByName(reg)


_ZONE_KEY = "strip_accents(lower(regexp_replace(trim({c}), '\\s+', ' ', 'g')))"
_ZONES_SQL = f"""
WITH st AS (SELECT n_name AS name, CAST(n_nationkey * 37 % 160 - 80 AS DOUBLE) AS lat,
  CAST(n_nationkey * 53 % 360 - 180 AS DOUBLE) AS lon, CAST(200 + n_nationkey * 40 AS INTEGER) AS radius_km FROM nation),
co AS (
  SELECT '  ' || lower(n_name) AS name, NULL AS name_es, 'N' || CAST(n_nationkey AS VARCHAR) AS code,
   CAST(n_nationkey * 37 % 160 - 80 AS DOUBLE) AS lat, CAST(n_nationkey * 53 % 360 - 180 AS DOUBLE) AS lon,
   CAST(n_nationkey * 250000 AS DOUBLE) AS area, n_nationkey AS ord FROM nation
  UNION ALL
  SELECT r_name, 'Región  ' || upper(r_name[1]) || lower(r_name[2:]), 'R' || CAST(r_regionkey % 3 AS VARCHAR),
   CAST(r_regionkey * 17 - 40 AS DOUBLE), CAST(r_regionkey * 61 - 150 AS DOUBLE),
   CAST(r_regionkey * 600000 AS DOUBLE), r_regionkey + 100 FROM region),
disp AS (SELECT regexp_replace(trim(coalesce(nullif(name_es, ''), name)), '\\s+', ' ', 'g') AS d, * FROM co),
cz AS (SELECT upper(d[1]) || d[2:] AS name, lat, lon,
   CASE WHEN area IS NULL OR area <= 0 THEN 700
        ELSE CAST(trunc(greatest(250, least(2500, sqrt(area / pi()) * 1.35))) AS INTEGER) END AS radius_km,
   code, ord, row_number() OVER (PARTITION BY code ORDER BY ord) AS code_rank FROM disp),
cand AS (SELECT * FROM cz WHERE code_rank = 1 AND lat IS NOT NULL AND lon IS NOT NULL AND length(name) > 0
   AND {_ZONE_KEY.format(c='name')} NOT IN (SELECT {_ZONE_KEY.format(c='name')} FROM st)),
added AS (SELECT name, lat, lon, radius_km FROM (SELECT *, row_number() OVER
   (PARTITION BY {_ZONE_KEY.format(c='name')} ORDER BY ord) AS k FROM cand) WHERE k = 1)
SELECT name, lat, lon, radius_km FROM st UNION ALL SELECT * FROM added"""


@register("zones", _ZONES_SQL)
def q_zones(spark, sf_dir):
    return Z.build_zones(nation_zones(spark, sf_dir), derived_countries(spark, sf_dir)).select(
        "name", "lat", "lon", "radius_km")


def _near_sql() -> str:
    src = (f"SELECT q.usgs_id, q.longitude, q.latitude, z.* FROM quakes q JOIN z ON TRUE "
           f"WHERE {O.mag_range()} AND {O.window(30)}")
    d = O.vincenty_sql(src, "CAST(longitude AS DOUBLE)", "CAST(latitude AS DOUBLE)", "zlon", "zlat")
    return O.with_ctes(
        "z AS (SELECT n_name AS zone, CAST(n_nationkey * 53 % 360 - 180 AS DOUBLE) AS zlon, "
        "CAST(n_nationkey * 37 % 160 - 80 AS DOUBLE) AS zlat, CAST(200 + n_nationkey * 40 AS DOUBLE) AS zr FROM nation)"
    ) + (f"SELECT zone, usgs_id, CAST(round(CAST(distance_m / 1000.0 AS DECIMAL(38,10)), 2) AS DOUBLE) AS distance_km "
         f"FROM ({d}) _n WHERE distance_m <= zr * 1000.0")


@register("near_zones", _near_sql())
def q_near_zones(spark, sf_dir):
    ev = Q.filtered_events(_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF).select(
        "usgs_id", "mag", "longitude", "latitude")
    return Z.near_zones(ev, nation_zones(spark, sf_dir)).select("zone", "usgs_id", "distance_km")


# --- Report projections, normalised points, constraints ------------------------------------------



def _clean_sql(c: str, fallback: str) -> str:
    t = f"regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' OR lower({t}) IN ('nan', 'none', 'null') THEN '{fallback}' ELSE {t} END)"


def _label_sql(c: str, fallback: str, mapping: dict[str, str]) -> str:
    t = _clean_sql(c, fallback)
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE lower({t}) {cases} ELSE {t} END)"


def _rint_sql(c: str, k: int = 100) -> str:
    y = f"(CAST({c} AS DOUBLE) * {float(k)})"
    return (f"((CASE WHEN {y} - floor({y}) = 0.5 THEN floor({y}) + (abs(floor({y})) % 2) ELSE round({y}) END) "
            f"/ {float(k)})")


_MAG0 = "coalesce(mag, 0)"
_DISPLAY_CLASS = (f"CASE WHEN {_MAG0} < 2 THEN 'Micro' WHEN {_MAG0} < 4 THEN 'Leve' "
                  f"WHEN {_MAG0} < 6 THEN 'Fuerte' ELSE 'Severo' END")


@register("event_report", O.with_ctes(O.filtered(days=7)) + f"""
SELECT usgs_id, {_rint_sql('mag')} AS magnitude, {_DISPLAY_CLASS} AS category,
 {_clean_sql('place', S.NO_PLACE)} AS place, strftime(time, '%Y-%m-%d') AS date_utc, strftime(time, '%H:%M') AS hour_utc,
 strftime(time, '%Y-%m') AS month_utc, strftime(time, '%Y') AS year_utc, {_rint_sql('depth')} AS depth_km,
 {_rint_sql('latitude')} AS latitude, {_rint_sql('longitude')} AS longitude,
 {_clean_sql('"magType"', S.NO_VALUE)} AS mag_type, {_label_sql('alert', S.NO_ALERT, S.ALERT_LABELS)} AS alert,
 {_label_sql('status', S.NO_VALUE, S.STATUS_LABELS)} AS status
FROM filtered""")
def q_event_report(spark, sf_dir):
    return R.event_report(Q.filtered_events(_quakes(spark, sf_dir), days_back=7, as_of=T.AS_OF))


_COLOUR = (f"CASE WHEN {_MAG0} < 2 THEN '{S.MAG_COLOURS['low']}' WHEN {_MAG0} < 4 THEN '{S.MAG_COLOURS['mid']}' "
           f"WHEN {_MAG0} < 6 THEN '{S.MAG_COLOURS['high']}' ELSE '{S.MAG_COLOURS['severe']}' END")


@register("map_points", O.with_ctes(O.filtered(days=7)) + f"""
SELECT usgs_id, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
 coalesce(CAST(mag AS DOUBLE), 0.0) AS mag, {_COLOUR} AS colour,
 greatest(CAST(4.0 AS DOUBLE), least(CAST(6.0 AS DOUBLE) + coalesce(CAST(mag AS DOUBLE), 0.0) * CAST(2.2 AS DOUBLE), CAST(24.0 AS DOUBLE))) AS size,
 coalesce(place, '{S.NO_PLACE}') AS place_label,
 CASE WHEN depth IS NULL THEN '--' WHEN depth = floor(depth) THEN format('{{:,}}', CAST(depth AS BIGINT))
      ELSE format('{{:,.2f}}', CAST(depth AS DOUBLE)) END AS depth_label,
 strftime(time, '%Y-%m-%d') AS date_label, strftime(time, '%H:%M') || ' UTC' AS hour_label,
 strftime(time, '%Y-%m') AS month_label, strftime(time, '%Y') AS year_label
FROM filtered""")
def q_map_points(spark, sf_dir):
    return R.map_points(Q.filtered_events(_quakes(spark, sf_dir), days_back=7, as_of=T.AS_OF))


@register("normalize_points", O.with_ctes(
    "p AS (SELECT usgs_id, CAST(latitude AS DOUBLE) AS lat, "
    "CAST(longitude + 360 * (seq % 3 - 1) AS DOUBLE) AS lon_in FROM ev WHERE longitude IS NOT NULL)") + """
SELECT usgs_id, lat, (CASE WHEN fmod(lon_in + 180.0, 360.0) < 0 THEN fmod(fmod(lon_in + 180.0, 360.0) + 360.0, 360.0)
  ELSE fmod(lon_in + 180.0, 360.0) END) - 180.0 AS lon FROM p WHERE lat BETWEEN -90 AND 90""")
def q_normalize_points(spark, sf_dir):
    d = T.derived_events(spark, sf_dir).filter(F.col("longitude").isNotNull())
    shifted = d.select("usgs_id", F.col("latitude"),
                       (F.col("longitude") + F.lit(360) * (F.col("seq") % 3 - 1)).cast("double").alias("lon_in"))
    p = shifted.select("usgs_id", S.normalize_point("latitude", "lon_in").alias("pt"))
    return p.filter(F.col("pt").isNotNull()).select("usgs_id", F.col("pt.lat").alias("lat"), F.col("pt.lon").alias("lon"))


def _constraint_sql() -> str:
    parts = ["SELECT 'not_null' AS check_name, 'usgs_id' AS column_name, "
             "CAST(count(*) FILTER (WHERE usgs_id IS NULL) AS BIGINT) AS violations FROM u"]
    for c, n in sorted(RAW_TEXT_LIMITS.items()):
        parts.append(f"SELECT 'max_length_{n}', '{c}', CAST(count(*) FILTER (WHERE length(\"{c}\") > {n}) AS BIGINT) FROM u")
    for c, t in sorted({"mag": "decimal(6,2)", "cdi": "decimal(4,2)", "mmi": "decimal(4,2)", "dmin": "decimal(10,4)",
                        "rms": "decimal(10,4)", "gap": "decimal(8,2)", "longitude": "decimal(10,6)",
                        "latitude": "decimal(10,6)", "depth": "decimal(10,2)"}.items()):
        parts.append(f"SELECT 'fits_{t}', '{c}', CAST(count(*) FILTER (WHERE \"{c}\" IS NOT NULL "
                     f"AND TRY_CAST(\"{c}\" AS {t.upper()}) IS NULL) AS BIGINT) FROM u")
    parts.append("SELECT 'unique', 'usgs_id', CAST(count(*) AS BIGINT) FROM "
                 "(SELECT usgs_id FROM u WHERE usgs_id IS NOT NULL GROUP BY usgs_id HAVING count(*) > 1)")
    return O.with_ctes(O.RAW_CTE, *O.HALVES, "u AS (SELECT * FROM cur UNION ALL SELECT * FROM bat)") + \
        "\nUNION ALL ".join(parts)


@register("constraint_report", _constraint_sql())
def q_constraint_report(spark, sf_dir):
    cur, bat = _halves(spark, sf_dir)
    return check_schema(cur.unionByName(bat), "usgs_id", RAW_TEXT_LIMITS)


# --- Stream intake ----------------------------------------------------------------------------------

def _stream_sql() -> str:
    clean_cols = ("usgs_id, CAST(mag AS DOUBLE) AS mag, coalesce(place, 'Unknown') AS place, time, updated, "
                  "coalesce(\"magType\", 'unknown') AS \"magType\", coalesce(tsunami, 0) AS tsunami, "
                  "coalesce(alert, '') AS alert, coalesce(status, 'unknown') AS status, coalesce(sig, 0) AS sig, "
                  "depth, longitude, latitude")
    return O.with_ctes(O.RAW_CTE, f"fs AS ({_feed_select()})") + f"SELECT {clean_cols} FROM fs WHERE {O.VALID}"


@register("stream_intake", _stream_sql())
def q_stream_intake(spark, sf_dir):
    from ..streaming.intake import stream_feed

    src = scratch_path(spark, "landed")
    docs = SINK.feed_documents(T.derived_raw(spark, sf_dir, T.AS_OF))
    files = SINK.land_in_batches(docs, src, 3, T.table(spark, sf_dir, "events").count())
    root = scratch_path(spark, "tables")
    q = stream_feed(spark, src, root, multi_line=False, max_files_per_trigger=files, stamp=T.AS_OF)
    q.awaitTermination()
    final = SINK.read_latest(spark, f"{root}/final")
    return _doubles(final.select("usgs_id", *O.FINAL_DATA))


@register("radius_search_recent", _radius_sql("spheroid", "recent"))
def q_radius_search_recent(spark, sf_dir):
    from ..operators.radius import radius_search

    return radius_search(_quakes(spark, sf_dir), sort="recent", as_of=T.AS_OF, **RADIUS)


RADIUS_ANALYSIS = {"lat": -55.0, "lon": 85.0, "dist_km": 350.0}


def _radius_analysis_sql() -> str:
    src = f"SELECT * FROM quakes WHERE {O.mag_range()} AND {O.window(30)}"
    rows = O.radius_rows(src, RADIUS_ANALYSIS["lat"], RADIUS_ANALYSIS["lon"], RADIUS_ANALYSIS["dist_km"])
    return O.with_ctes(f"filtered AS (SELECT * FROM ({rows}) _r)") + f"""
SELECT CAST(count(*) AS INTEGER) AS total_events, {O.avg_exact('mag')} AS avg_magnitude,
 {O.avg_exact('depth')} AS avg_depth, CAST(max(mag) AS DOUBLE) AS max_magnitude,
 CAST(min(mag) AS DOUBLE) AS min_magnitude, max(time) AS last_update
FROM filtered"""


@register("analysis_radius_summary", _radius_analysis_sql())
def q_analysis_radius_summary(spark, sf_dir):
    f = A.analysis_filter(_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF, **RADIUS_ANALYSIS)
    return A.summary(f)


def _lenient_select() -> str:
    sel = []
    for n in O.RAW_NAMES:
        if n == "id":
            continue
        if n == "time":
            sel.append(f'{_MS.format(c="time")} AS "time"')
        elif n == "updated":
            sel.append(f"coalesce({_MS.format(c='updated')}, TIMESTAMP '1970-01-01 00:00:00') AS \"updated\"")
        else:
            sel.append(O.out_col(n))
    return f"SELECT {', '.join(sel)} FROM raw"


def _lenient_sql() -> str:
    return O.with_ctes(O.RAW_CTE) + _lenient_select()


@register("feed_scan_lenient", _lenient_sql())
def q_feed_scan_lenient(spark, sf_dir):
    return _doubles(FEED.read_feed(spark, landed_feed(spark, sf_dir), strict=False, multi_line=False))


# --- Picks and the analysis frame (A12, A13, P33) ------------------------------------------

@register("average_depth", O.with_ctes(O.filtered()) + """
SELECT CAST(sum(depth) AS DOUBLE) / count(depth) AS average_depth FROM filtered""")
def q_average_depth(spark, sf_dir):
    return A.average_depth(_analysis_frame(spark, sf_dir))


@register("most_active_region", O.with_ctes(O.filtered()) + f"""
SELECT coalesce((SELECT region FROM filtered GROUP BY region
                 ORDER BY count(*) DESC, {O.avg_exact('mag')} DESC NULLS FIRST, region LIMIT 1), '--')
       AS most_active_region""")
def q_most_active_region(spark, sf_dir):
    return A.most_active_region(_analysis_frame(spark, sf_dir))


@register("strongest_event", O.with_ctes(O.filtered()) + """
SELECT usgs_id, CAST(mag AS DOUBLE) AS mag, place, CAST(depth AS DOUBLE) AS depth, time
FROM filtered ORDER BY coalesce(CAST(mag AS DOUBLE), 0.0) DESC, time DESC NULLS LAST, id DESC LIMIT 1""")
def q_strongest_event(spark, sf_dir):
    return _doubles(A.strongest_event(_analysis_frame(spark, sf_dir)))


_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
_P18_TEXT = _STRIP.format(x="place")
_P18_TAIL = {sep: _STRIP.format(x=f"string_split({_P18_TEXT}, '{sep}')[-1]") for sep in (",", " of ")}
_P18_REGION = (f"CASE WHEN place IS NULL OR place = '' THEN '{S.NO_PLACE}' "
               f"WHEN {_P18_TEXT} LIKE '%,%' THEN coalesce(nullif({_P18_TAIL[',']}, ''), {_P18_TEXT}) "
               f"WHEN {_P18_TEXT} LIKE '% of %' THEN coalesce(nullif({_P18_TAIL[' of ']}, ''), {_P18_TEXT}) "
               f"ELSE {_P18_TEXT} END")
_P15_CLASS = ("CASE WHEN mag >= -10 AND mag <= 2 THEN 'Micro' WHEN mag > 2 AND mag <= 4 THEN 'Leve' "
              "WHEN mag > 4 AND mag <= 6 THEN 'Fuerte' WHEN mag > 6 AND mag <= 10 THEN 'Severo' ELSE 'nan' END")


@register("analysis_frame", O.with_ctes() + f"""
SELECT usgs_id, CAST(mag AS DOUBLE) AS mag, CAST(depth AS DOUBLE) AS depth, time, place,
 {_P15_CLASS} AS category, {_P18_REGION} AS region, strftime(time, '%Y-%m-%d') AS day
FROM quakes WHERE mag IS NOT NULL""")
def q_analysis_frame(spark, sf_dir):
    from ..operators.clean import analysis_frame

    f = analysis_frame(_quakes(spark, sf_dir).select("usgs_id", "mag", "depth", "time", "place"))
    return f.select("usgs_id", F.col("mag").cast("double").alias("mag"), F.col("depth").cast("double").alias("depth"),
                    "time", "place", "category", "region", "day")


# --- Extract -> transform: lenient scan, records, cleaning, GeoJSON (S2, K6, S3, P3-P6, K7) ----------

@register("transform_geojson", O.with_ctes(O.RAW_CTE, f"len AS ({_lenient_select()})") + """
SELECT usgs_id, CAST(mag AS DOUBLE) AS mag, coalesce(place, 'Unknown') AS place, time, updated,
 coalesce("magType", 'unknown') AS "magType", coalesce(tsunami, 0) AS tsunami, coalesce(alert, '') AS alert,
 coalesce(status, 'unknown') AS status, coalesce(sig, 0) AS sig, CAST(depth AS DOUBLE) AS depth,
 CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM len WHERE """ + O.VALID)
def q_transform_geojson(spark, sf_dir):
    extracted = FEED.read_feed(spark, landed_feed(spark, sf_dir), strict=False, multi_line=False)
    records = scratch_path(spark, "records")
    SINK.write_records(extracted, records)
    cleaned = clean(FEED.read_records(spark, records).select(*CURATE_INPUT_COLUMNS))
    points = scratch_path(spark, "geojson")
    SINK.write_geojson(cleaned, points)
    props = T_.StructType([f for f in cleaned.schema.fields if f.name not in ("longitude", "latitude")])
    return _doubles(FEED.read_geojson(spark, points, props))


# --- Run summaries of the versioned jobs (K9) ---------------------------------------------------

_RUNS_SQL = O.with_ctes(
    O.RAW_CTE, *O.HALVES, O.raw_upsert_cte(RAW_UPDATE_COLUMNS, STAMP_1_SQL),
    O.first_load_cte("f0", "cur", O.AS_OF_SQL),
    "ch AS (SELECT r.* FROM up r LEFT JOIN f0 e ON e.usgs_id = r.usgs_id WHERE r.longitude IS NOT NULL "
    "AND r.latitude IS NOT NULL AND (e.usgs_id IS NULL OR coalesce(r.updated, r.time, TIMESTAMP '1970-01-01') "
    "> coalesce(e.updated, e.time, TIMESTAMP '1970-01-01')))") + f"""
SELECT 1 AS version, 'ingest' AS stage, 'upsert' AS mode, count(*) AS "read", count(*) AS transformed,
 count(*) AS loaded FROM cur
UNION ALL SELECT 1, 'curate', 'full', count(*) FILTER (WHERE longitude IS NOT NULL AND latitude IS NOT NULL),
 count(*) FILTER (WHERE {O.VALID}), count(*) FILTER (WHERE {O.VALID}) FROM cur
UNION ALL SELECT 2, 'ingest', 'upsert', count(*), count(*), count(*) FROM bat
UNION ALL SELECT 2, 'curate', 'incremental', count(*), count(*) FILTER (WHERE {O.VALID}),
 count(*) FILTER (WHERE {O.VALID}) FROM ch"""


@register("run_summaries", _RUNS_SQL)
def q_run_summaries(spark, sf_dir):
    from . import jobs

    cur, bat = _halves(spark, sf_dir)
    root = scratch_path(spark, "runs")
    raw_dir, final_dir, tsu_dir = (f"{root}/{t}" for t in ("raw", "final", "tsunami"))
    rows = []
    for version, batch, full, stamp in ((1, cur, True, T.AS_OF), (2, bat, False, STAMP_1)):
        ing = jobs.ingest_batch(spark, batch, raw_dir, version, stamp=stamp)
        cur_run = jobs.curate(spark, raw_dir, final_dir, tsu_dir, version, full=full, stamp=stamp)
        rows.append((version, "ingest", "upsert", ing["events"], ing["events"], ing["inserted"]))
        rows.append((version, "curate", cur_run["mode"], cur_run["read"], cur_run["transformed"], cur_run["loaded"]))
    return spark.createDataFrame(rows, "version int, stage string, mode string, read long, transformed long, "
                                       "loaded long")
