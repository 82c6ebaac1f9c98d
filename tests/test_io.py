"""Sinks, records round trip, versioned jobs (replay), WKT at the edge."""

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from tremorlake.functions import scalar as S
from tremorlake.plans import jobs
from tremorlake.schema import RAW_SCHEMA
from tremorlake.sources import sinks as SINK
from tremorlake.sources.feed import read_feed, read_records
from tremorlake.sources.tables import derived_raw

SF = "/root/testdata/sf0.001"


def fresh(name):
    return os.path.join(tempfile.mkdtemp(prefix="tremor-io-"), name)


def test_records_round_trip(spark):
    raw = derived_raw(spark, SF).filter(F.col("seq") < 50).drop("seq")
    path = fresh("records")
    SINK.write_records(raw, path)
    back = read_records(spark, path)
    cols = ["usgs_id", "mag", "longitude", "latitude", "depth", "tsunami",
            # ISO text carries milliseconds, as the records format does
            F.date_trunc("millisecond", "time").cast("timestamp_ntz"),
            F.date_trunc("millisecond", "updated").cast("timestamp_ntz")]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, raw.select(cols).collect()))


def test_geojson_lines(spark):
    df = spark.createDataFrame([("a", Decimal("1.50"), Decimal("10.000000"), Decimal("20.000000"))],
                               "usgs_id string, mag decimal(6,2), longitude decimal(10,6), latitude decimal(10,6)")
    path = fresh("geojson")
    SINK.write_geojson(df, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert lines[0]["type"] == "Feature"
    assert lines[0]["geometry"]["coordinates"] == [10.0, 20.0]
    assert lines[0]["properties"]["usgs_id"] == "a"


def test_feed_documents_round_trip(spark):
    raw = derived_raw(spark, SF)
    path = fresh("feed")
    SINK.write_feed_documents(SINK.feed_documents(raw, per_document=100), path)
    back = read_feed(spark, path, multi_line=False)
    # rows without depth have two coordinates and are skipped by the strict scan
    assert back.count() == raw.filter(F.col("depth").isNotNull()).count()


def test_wkt_point(spark):
    df = spark.createDataFrame([(Decimal("-79.519900"), Decimal("8.982400"))], "lon decimal(10,6), lat decimal(10,6)")
    assert df.select(S.wkt_point("lon", "lat")).first()[0] == "POINT (-79.519900 8.982400)"


def test_jobs_versions_and_replay(spark):
    raw = derived_raw(spark, SF).drop("seq")
    root = fresh("tables")
    raw_dir, final_dir, tsu_dir = (f"{root}/{t}" for t in ("raw", "final", "tsunami"))
    b1 = raw.filter(F.col("usgs_id") < "ev5").drop("ingested_at")
    b2 = raw.filter(F.col("usgs_id") >= "ev5").drop("ingested_at")
    stamp = dt.datetime(2024, 2, 1)
    s1 = jobs.ingest_batch(spark, b1, raw_dir, 1, stamp=stamp)
    c1 = jobs.curate(spark, raw_dir, final_dir, tsu_dir, 1, stamp=stamp)
    jobs.ingest_batch(spark, b2, raw_dir, 2, stamp=stamp)
    c2 = jobs.curate(spark, raw_dir, final_dir, tsu_dir, 2, stamp=stamp)
    first = sorted(map(tuple, SINK.read_latest(spark, final_dir).collect()))
    # replaying version 2 rewrites the same folders from the same inputs
    jobs.ingest_batch(spark, b2, raw_dir, 2, stamp=stamp)
    again = jobs.curate(spark, raw_dir, final_dir, tsu_dir, 2, stamp=stamp)
    second = sorted(map(tuple, SINK.read_latest(spark, final_dir).collect()))
    assert first == second
    assert s1["events"] == b1.count() and c1["loaded"] > 0 and again == c2
    assert SINK.versions(spark, final_dir) == [1, 2]
    ids = [r.id for r in SINK.read_latest(spark, final_dir).select("id").collect()]
    assert len(ids) == len(set(ids))
    tsu = SINK.read_latest(spark, tsu_dir)
    assert tsu.filter(F.col("id").isNull()).count() == 0


def test_time_window_prunes_date_partitions(spark):
    from tremorlake.operators import query as Q
    from tremorlake.sources.tables import AS_OF, quakes, read_quakes

    path = fresh("curated")
    q = quakes(spark, SF).withColumn("event_date", F.to_date("time"))
    q.write.partitionBy("event_date").parquet(path)
    stored = read_quakes(spark, path)
    f = Q.since(stored, AS_OF, 7)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan.split("PartitionFilters")[1]
    assert f.count() == Q.since(quakes(spark, SF), AS_OF, 7).count()
    top = Q.list_events(stored, as_of=AS_OF).collect()
    assert len(top) == 100


def test_stored_layout_prunes_row_groups(spark):
    import glob

    import pyarrow.parquet as pq

    from tremorlake.operators import query as Q
    from tremorlake.sources.tables import quakes, read_quakes

    q = quakes(spark, SF).withColumn("event_date", F.to_date("time")).coalesce(1)
    root = fresh("layout")
    path = SINK.write_version(q, root, 1, partition_by=["event_date"],
                              sort_within=SINK.spatial_sort_keys() + [F.col("time")], bloom_columns=["usgs_id"])
    f = sorted(glob.glob(f"{path}/event_date=*/*.parquet"))[0]
    lat = pq.read_table(f, columns=["latitude"]).column(0).to_pylist()
    assert lat == sorted(lat, key=lambda v: int((float(v) + 90) // 1))   # latitude bands ascending
    stored = read_quakes(spark, path)
    assert Q.detail(stored, "ev123").count() == 1


def test_geojson_read_back(spark):
    from pyspark.sql import types as T

    from tremorlake.operators.clean import clean
    from tremorlake.schema import CURATE_INPUT_COLUMNS
    from tremorlake.sources.feed import read_geojson

    cleaned = clean(derived_raw(spark, SF).select(*CURATE_INPUT_COLUMNS))
    path = fresh("points")
    SINK.write_geojson(cleaned, path)
    props = [f for f in cleaned.schema.fields if f.name not in ("longitude", "latitude")]
    back = read_geojson(spark, path, T.StructType(props))
    cols = [F.col(c).cast("double").alias(c) if c in ("mag", "depth", "longitude", "latitude") else F.col(c)
            for c in CURATE_INPUT_COLUMNS]
    # ISO text carries milliseconds; compare at that precision
    trunc = [F.date_trunc("millisecond", c).cast("timestamp_ntz").alias(c) for c in ("time", "updated")]
    want = cleaned.select(*cols)
    want = want.select(*[c for c in want.columns if c not in ("time", "updated")], *trunc)
    got = back.select(*cols).select(*[c for c in want.columns if c not in ("time", "updated")], *trunc)
    assert got.count() == cleaned.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
