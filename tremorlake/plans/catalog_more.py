"""More registered queries: stored tables, revised feeds, broken loads, the whole
analysis bundle, events over several years, and the small text and number rules."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import analysis as A
from ..operators import query as Q
from ..operators import upsert as U
from ..operators import zones as Z
from ..operators.constraints import check_schema
from ..operators.radius import radius_search
from ..schema import RAW_TEXT_LIMITS
from ..session import scratch_path
from ..sources import feed as FEED
from ..sources import sinks as SINK
from ..sources import tables as T
from . import oracle as O
from . import jobs
from .catalog import _INCR_SQL, ORACLE, RADIUS, RADIUS_ANALYSIS, STAMP_1, STAMP_2, _doubles, _halves, _feed_select, _list_sql, _quakes, _radius_analysis_sql, _radius_sql, register

# --- The stored curated table (S6) ------------------------------------------------------------


def stored_quakes(spark, sf_dir) -> DataFrame:
    """The curated table written as the jobs write it, read back with its layout."""
    root = scratch_path(spark, "stored")
    SINK.write_version(_quakes(spark, sf_dir).withColumn("event_date", F.to_date("time")), root, 1, partition_by=["event_date"],
                       sort_within=SINK.spatial_sort_keys() + [F.col("time")], bloom_columns=["usgs_id"])
    return SINK.read_latest(spark, root, layout=True)


@register("stored_event_list", _list_sql("recent"))
def q_stored_event_list(spark, sf_dir):
    return Q.list_events(stored_quakes(spark, sf_dir), as_of=T.AS_OF)


@register("stored_event_detail", ORACLE["event_detail"])
def q_stored_event_detail(spark, sf_dir):
    return Q.detail(stored_quakes(spark, sf_dir), "ev123")


@register("stored_radius_search", _radius_sql("spheroid"))
def q_stored_radius_search(spark, sf_dir):
    return radius_search(stored_quakes(spark, sf_dir), as_of=T.AS_OF, **RADIUS)


@register("stored_analysis_radius_summary", _radius_analysis_sql())
def q_stored_analysis(spark, sf_dir):
    return A.summary(A.analysis_filter(stored_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF, **RADIUS_ANALYSIS))


# --- Revised feeds (S7, K1): later feeds win, also after a restart ------------------------------


def _revision_sql() -> str:
    shifts = "CASE WHEN seq % 5 = 0 THEN 2 WHEN seq % 3 = 0 THEN 1 ELSE 0 END"
    mag = f"CAST(mag + 0.1 * ({shifts}) AS DECIMAL(6,2))"
    updated = f"CASE WHEN {shifts} > 0 THEN time + (3 + 2 * ({shifts})) * INTERVAL 1 HOUR ELSE updated END"
    return O.with_ctes(
        O.RAW_CTE, f"rev AS (SELECT * REPLACE ({mag} AS mag, {updated} AS updated) FROM raw)",
        f"fs AS ({_feed_select().replace('FROM raw', 'FROM rev')})") + (
        "SELECT usgs_id, mag, coalesce(place, 'Unknown') AS place, time, updated, "
        "coalesce(\"magType\", 'unknown') AS \"magType\", coalesce(tsunami, 0) AS tsunami, coalesce(alert, '') AS alert, "
        f"coalesce(status, 'unknown') AS status, coalesce(sig, 0) AS sig, depth, longitude, latitude FROM fs WHERE {O.VALID}")


def _revised(raw: DataFrame, n: int) -> DataFrame:
    return raw.withColumn("mag", (F.col("mag") + F.lit(n).cast("decimal(2,0)") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(6,2)")).withColumn(
        "updated", F.col("time") + F.make_dt_interval(hours=F.lit(3 + 2 * n)))


def revised_feeds(spark, sf_dir, in_place: bool = False) -> str:
    """The folder of the tables after two runs: one micro-batch reads an older
    small landing and a newer large one with revisions of its events; a second
    run, after a stop, reads later revisions."""
    from ..streaming.intake import stream_feed

    src, root = scratch_path(spark, "landed"), scratch_path(spark, "tables")
    raw = T.derived_raw(spark, sf_dir, T.AS_OF)

    def land(rows: DataFrame) -> None:
        SINK.feed_documents(rows).select("value").write.mode("append").text(src, compression="gzip")
        time.sleep(1.1)  # file times of one second apart, as feeds that are landed one after another have

    def run() -> None:
        stream_feed(spark, src, root, multi_line=False, stamp=T.AS_OF, in_place=in_place).awaitTermination()

    third = F.col("seq") % 3 == 0
    land(raw.filter(third))
    land(raw.filter(~third).unionByName(_revised(raw.filter(third), 1)))
    run()
    land(_revised(raw.filter(F.col("seq") % 5 == 0), 2))
    run()
    return root


@register("stream_intake_revisions", _revision_sql())
def q_stream_intake_revisions(spark, sf_dir):
    root = revised_feeds(spark, sf_dir)
    return _doubles(SINK.read_latest(spark, f"{root}/final").select("usgs_id", *O.FINAL_DATA))


# --- The curated table in place (J1, K2, K3) ------------------------------------------------------


@register("curate_in_place", _INCR_SQL)
def q_curate_in_place(spark, sf_dir):
    cur, bat = _halves(spark, sf_dir)
    path = scratch_path(spark, "in-place")
    jobs.curate_in_place(spark, cur, path, stamp=T.AS_OF)
    jobs.curate_in_place(spark, U.raw_upsert(cur, bat, stamp=T.ts_literal(STAMP_1)), path, stamp=STAMP_2)
    return _doubles(spark.read.parquet(path).drop("event_date"))


# --- Constraints of a broken load (K8) ------------------------------------------------------------

_BROKEN = {  # column -> (which events, SQL value)
    "mag": ("seq % 13 = 0", "123456.5"), "nst": ("seq % 17 = 0", "99999999999"), "code": ("seq % 19 = 0", "repeat('9', 40)"),
    "alert": ("seq % 23 = 0", "repeat('r', 25)"), "gap": ("seq % 29 = 0", "12345678.5"),
}
_BROKEN_TYPES = {"mag": "decimal(6,2)", "gap": "decimal(8,2)", "nst": "int", "depth": "decimal(10,2)"}


def _broken_sql() -> str:
    parts = ["SELECT 'not_null' AS check_name, 'usgs_id' AS column_name, CAST(0 AS BIGINT) AS violations"]
    for c, n in sorted(RAW_TEXT_LIMITS.items()):
        hit = _BROKEN[c][0] if c in _BROKEN else "FALSE"
        parts.append(f"SELECT 'max_length_{n}', '{c}', CAST(count(*) FILTER (WHERE {hit}) AS BIGINT) FROM u")
    for c, t in sorted(_BROKEN_TYPES.items()):
        hit = _BROKEN[c][0] if c in _BROKEN else "FALSE"
        parts.append(f"SELECT 'fits_{t}', '{c}', CAST(count(*) FILTER (WHERE {hit}) AS BIGINT) FROM u")
    parts.append("SELECT 'unique', 'usgs_id', CAST(count(*) AS BIGINT) FROM (SELECT usgs_id FROM u GROUP BY usgs_id HAVING count(*) > 1)")
    return O.with_ctes("d AS (SELECT * FROM ev WHERE depth IS NOT NULL)", "u AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE seq % 31 = 0)") + "\nUNION ALL ".join(parts)


def _broken_feed(spark, sf_dir) -> str:
    raw = T.derived_raw(spark, sf_dir, T.AS_OF)
    raw = raw.unionByName(raw.filter("seq % 31 = 0"))
    for c, (hit, value) in _BROKEN.items():
        wide = {"mag": "double", "gap": "double", "nst": "long"}.get(c, "string")
        raw = raw.withColumn(c, F.expr(f"CASE WHEN {hit} THEN CAST({value} AS {wide}) ELSE CAST({c} AS {wide}) END"))
    path = scratch_path(spark, "broken")
    SINK.write_feed_documents(SINK.feed_documents(raw), path)
    return path


@register("constraint_report_broken", _broken_sql())
def q_constraint_report_broken(spark, sf_dir):
    read = FEED.read_feed(spark, _broken_feed(spark, sf_dir), strict=True, multi_line=False, tracked=True)
    return check_schema(read, "usgs_id", RAW_TEXT_LIMITS, _BROKEN_TYPES)


# --- A load that reports what it could not take (S1) ------------------------------------------------

_REASONS = {"mag": "does not fit decimal(6,2)", "gap": "does not fit decimal(8,2)", "nst": "does not fit int",
            "code": f"longer than {RAW_TEXT_LIMITS['code']}", "alert": f"longer than {RAW_TEXT_LIMITS['alert']}"}


def _rejects_sql() -> str:
    missing = "depth IS NULL"
    hits = [("coordinates", "missing", missing), *[(c, _REASONS[c], _BROKEN[c][0]) for c in _BROKEN]]
    parts = [f"SELECT '{reason}' AS reason, '{c}' AS column_name, CAST(count(*) AS BIGINT) AS events FROM u WHERE {hit}" for c, reason, hit in hits]
    none = " AND ".join(f"NOT ({hit})" for _, _, hit in hits)
    parts.append(f"SELECT 'loaded', NULL, CAST(count(*) AS BIGINT) FROM u WHERE {none}")
    return O.with_ctes("u AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE seq % 31 = 0)") + "\nUNION ALL ".join(parts)


@register("feed_rejects", _rejects_sql())
def q_feed_rejects(spark, sf_dir):
    loaded, rejected = FEED.split(FEED.screen_feed(spark, _broken_feed(spark, sf_dir), multi_line=False))
    taken = loaded.agg(F.count(F.lit(1)).alias("events")).select(F.lit("loaded").alias("reason"), F.lit(None).cast("string").alias("column_name"), "events")
    return rejected.groupBy("reason", "column_name").agg(F.count(F.lit(1)).alias("events")).unionByName(taken)


# --- The analysis bundle (A10), with and without a radius ---------------------------------------


def _bundle_sql(source: str) -> str:
    def part(name, key, extra=""):
        return f"SELECT '{name}' AS part, {key} AS key, CAST(count(*) AS INTEGER) AS events, {O.avg_exact('mag')} AS avg_magnitude FROM filtered GROUP BY {key} {extra}"
    top = part("region", "region", f"ORDER BY count(*) DESC, {O.avg_exact('mag')} DESC NULLS FIRST, region LIMIT 8")
    return O.with_ctes(source) + f"""
SELECT 'summary' AS part, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS INTEGER) AS events, {O.avg_exact('mag')} AS avg_magnitude FROM filtered
UNION ALL SELECT 'category', l, CAST(count(category) AS INTEGER), NULL FROM (VALUES ('Micro'), ('Leve'), ('Fuerte'), ('Severo')) t(l)
 LEFT JOIN filtered ON category = l GROUP BY l
UNION ALL SELECT * FROM ({top}) _t
UNION ALL {part("depth", O.DEPTH_GROUP, "")}
UNION ALL {part("day", "strftime(time, '%Y-%m-%d')")}
UNION ALL {part("month", "strftime(time, '%Y-%m')")}
UNION ALL {part("year", "strftime(time, '%Y')")}"""


def _bundle(df: DataFrame, **filters) -> DataFrame:
    parts = A.analysis(df, **filters)
    nothing = F.lit(None).cast("string")
    def long(frame, part, key, avg="avg_magnitude", events="events"):
        return frame.select(F.lit(part).alias("part"), key.alias("key"), F.col(events).cast("int").alias("events"),
                            (F.col(avg) if avg else F.lit(None)).cast("double").alias("avg_magnitude"))
    out = long(parts["summary"], "summary", nothing, events="total_events")
    out = out.unionByName(long(parts["category_counts"], "category", F.col("category"), avg=None))
    out = out.unionByName(long(parts["top_regions"], "region", F.col("region")))
    out = out.unionByName(long(parts["depth_groups"], "depth", F.col("depth_group")))
    for unit, name in (("day", "daily_counts"), ("month", "monthly_counts"), ("year", "yearly_counts")):
        out = out.unionByName(long(parts[name], unit, F.col("period")))
    return out


@register("analysis_bundle", _bundle_sql(O.filtered()))
def q_analysis_bundle(spark, sf_dir):
    return _bundle(_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF)


def _radius_filtered() -> str:
    rows = O.radius_rows(f"SELECT * FROM quakes WHERE {O.mag_range()} AND {O.window(30)}",
                         RADIUS_ANALYSIS["lat"], RADIUS_ANALYSIS["lon"], RADIUS_ANALYSIS["dist_km"])
    return f"filtered AS (SELECT *, {O.CATEGORY} AS category, {O.REGION} AS region FROM ({rows}) _r)"


@register("analysis_bundle_radius", _bundle_sql(_radius_filtered()))
def q_analysis_bundle_radius(spark, sf_dir):
    return _bundle(_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF, **RADIUS_ANALYSIS)


# --- Months and years (A7, A8): the events spread over three years -------------------------------

_SPREAD = "filtered AS (SELECT * REPLACE (time + CAST(seq AS INTEGER) % 1000 * INTERVAL 1 DAY AS time) FROM (SELECT id - 1 AS seq, * FROM quakes))"


def _spread(spark, sf_dir) -> DataFrame:
    return _quakes(spark, sf_dir).withColumn("time", F.col("time") + F.make_dt_interval(((F.col("id") - 1) % 1000).cast("int")))


for _unit, _format in (("month", "%Y-%m"), ("year", "%Y")):
    def _make(unit):
        return lambda spark, sf_dir: A.period_counts(_spread(spark, sf_dir), unit)
    register(f"{_unit}ly_counts_spread", O.with_ctes(_SPREAD) + f"""
SELECT strftime(time, '{_format}') AS period, CAST(count(*) AS INTEGER) AS events, {O.avg_exact('mag')} AS avg_magnitude
FROM filtered GROUP BY 1 ORDER BY 1""")(_make(_unit))


# --- Zones of very different radius (G9) ----------------------------------------------------------

WIDE_ZONE = ("Wide", 25.0, 60.0, 18000.0)


def _mixed_sql() -> str:
    src = f"SELECT q.usgs_id, q.longitude, q.latitude, z.* FROM quakes q JOIN z ON TRUE WHERE {O.mag_range()} AND {O.window(30)}"
    d = O.vincenty_sql(src, "CAST(longitude AS DOUBLE)", "CAST(latitude AS DOUBLE)", "zlon", "zlat")
    name, lat, lon, radius = WIDE_ZONE
    return O.with_ctes(
        "z AS (SELECT n_name AS zone, CAST(n_nationkey * 53 % 360 - 180 AS DOUBLE) AS zlon, CAST(n_nationkey * 37 % 160 - 80 AS DOUBLE) AS zlat, "
        f"CAST(50 AS DOUBLE) AS zr FROM nation UNION ALL SELECT '{name}', {lon}, {lat}, {radius})") + (
        f"SELECT zone, usgs_id, CAST(round(CAST(distance_m / 1000.0 AS DECIMAL(38,10)), 2) AS DOUBLE) AS distance_km FROM ({d}) _n WHERE distance_m <= zr * 1000.0")


@register("near_zones_mixed", _mixed_sql())
def q_near_zones_mixed(spark, sf_dir):
    k = F.col("n_nationkey")
    zones = T.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), (k * 37 % 160 - 80).cast("double").alias("lat"), (k * 53 % 360 - 180).cast("double").alias("lon"),
        F.lit(50.0).alias("radius_km")).unionByName(spark.createDataFrame([WIDE_ZONE], "name string, lat double, lon double, radius_km double"))
    ev = Q.filtered_events(_quakes(spark, sf_dir), days_back=30, as_of=T.AS_OF).select("usgs_id", "mag", "longitude", "latitude")
    return Z.near_zones(ev, zones).select("zone", "usgs_id", "distance_km")


# --- Small rules (P7, P23, P28, L2, L7) -------------------------------------------------------------


@register("wkt_points", O.with_ctes() + """
SELECT usgs_id, concat('POINT (', CAST(longitude AS VARCHAR), ' ', CAST(latitude AS VARCHAR), ')') AS wkt FROM quakes""")
def q_wkt_points(spark, sf_dir):
    return _quakes(spark, sf_dir).select("usgs_id", S.wkt_point("longitude", "latitude").alias("wkt"))


_DIRTY = ("CASE seq % 7 WHEN 0 THEN 'x1' WHEN 1 THEN 'NaN' WHEN 2 THEN 'Infinity' WHEN 3 THEN '' ELSE {number} END")


@register("finite_numbers", O.with_ctes("t AS (SELECT usgs_id, TRY_CAST(" + _DIRTY.format(number="CAST(mag AS VARCHAR)") + " AS DOUBLE) AS v FROM ev)") + """
SELECT usgs_id, CASE WHEN isfinite(v) THEN v END AS value, CASE WHEN isfinite(v) THEN v ELSE -1.0 END AS filled FROM t""")
def q_finite_numbers(spark, sf_dir):
    text = F.expr(_DIRTY.format(number="CAST(mag AS STRING)"))
    return T.derived_events(spark, sf_dir).select("usgs_id", S.finite(text).alias("value"), S.finite(text, -1.0).alias("filled"))


@register("time_texts", O.with_ctes() + """
SELECT usgs_id, coalesce(strftime(updated, '%Y-%m-%d %H:%M') || ' UTC', '--') AS updated_text FROM ev""")
def q_time_texts(spark, sf_dir):
    return T.derived_events(spark, sf_dir).select("usgs_id", S.time_text("updated").alias("updated_text"))


@register("event_list_fallback", f"SELECT 'distance' AS asked, * FROM ({_list_sql('recent')}) _a UNION ALL SELECT 'unknown', * FROM ({_list_sql('recent')}) _b")
def q_event_list_fallback(spark, sf_dir):
    q, out = _quakes(spark, sf_dir), None
    for asked in ("distance", "unknown"):
        page = Q.list_events(q, sort=asked, as_of=T.AS_OF).select(F.lit(asked).alias("asked"), "*")
        out = page if out is None else out.unionByName(page)
    return out


@register("tsunami_newest", O.with_ctes() + """
SELECT id, usgs_id, CAST(mag AS DOUBLE) AS mag, place, time, CAST(depth AS DOUBLE) AS depth,
 CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM quakes WHERE tsunami = 1 ORDER BY time DESC, id DESC LIMIT 50""")
def q_tsunami_newest(spark, sf_dir):
    newest = U.refresh_tsunami(_quakes(spark, sf_dir)).orderBy(F.col("time").desc(), F.col("id").desc()).limit(50)
    return _doubles(newest)
