"""Intake order, versions after a restart, loads that break constraints, table layout, size proofs."""

import datetime as dt
import glob
import json
import os
import tempfile
import types
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tremorlake import session as SESSION
from tremorlake.operators import cluster as CL
from tremorlake.operators.constraints import ConstraintError, check_schema
from tremorlake.operators.zones import near_zones
from tremorlake.plans import jobs
from tremorlake.sources import sinks as SINK
from tremorlake.sources import tables as T
from tremorlake.sources.feed import read_feed
from tremorlake.streaming.intake import stream_feed

MS = 1706000000000


def feature(fid, mag, updated, **props):
    return {"type": "Feature", "id": fid, "properties": {"time": MS, "updated": updated, "mag": mag, **props},
            "geometry": {"type": "Point", "coordinates": [10.0, 20.0, 5.0]}}


def land(folder, name, features, mtime):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh)
    os.utime(path, (mtime, mtime))


def run(spark, src, root, **kw):
    stream_feed(spark, src, root, stamp=T.AS_OF, **kw).awaitTermination()
    return {r["usgs_id"]: r for r in SINK.read_latest(spark, f"{root}/final").collect()}


def test_later_feed_wins_whatever_its_size_and_a_restart_goes_on(spark):
    src, root = tempfile.mkdtemp(prefix="landed-"), tempfile.mkdtemp(prefix="tables-")
    filler = [feature(f"f{i}", 1.0, MS) for i in range(300)]
    land(src, "z_old.json", [feature("a", 1.0, MS + 1)], 1_700_000_000)
    land(src, "a_new.json", [feature("a", 2.0, MS + 2), *filler], 1_700_000_100)
    first = run(spark, src, root)
    assert first["a"]["mag"] == Decimal("2.00") and len(first) == 301
    assert SINK.versions(spark, f"{root}/raw") == [1]
    land(src, "later.json", [feature("b", 3.0, MS), feature("a", 2.5, MS + 3)], 1_700_000_200)
    second = run(spark, src, root)
    assert len(second) == 302 and second["b"]["mag"] == Decimal("3.00") and second["a"]["mag"] == Decimal("2.50")
    assert SINK.versions(spark, f"{root}/raw") == [1, 2] and SINK.versions(spark, f"{root}/final") == [1, 2]


def test_a_new_stream_goes_on_after_the_newest_version(spark):
    src, root = tempfile.mkdtemp(prefix="landed-"), tempfile.mkdtemp(prefix="tables-")
    land(src, "one.json", [feature("a", 1.0, MS)], 1_700_000_000)
    run(spark, src, root, checkpoint=tempfile.mkdtemp(prefix="ck-"))
    other = tempfile.mkdtemp(prefix="landed-")
    land(other, "two.json", [feature("b", 1.0, MS)], 1_700_000_050)
    both = run(spark, other, root, checkpoint=tempfile.mkdtemp(prefix="ck-"))
    assert set(both) == {"a", "b"} and SINK.versions(spark, f"{root}/raw") == [1, 2]


def test_values_that_do_not_fit_stop_the_load(spark):
    src, root = tempfile.mkdtemp(prefix="landed-"), tempfile.mkdtemp(prefix="tables-")
    land(src, "bad.json", [feature("a", 123456.5, MS, nst=99999999999), feature("b", 1.0, MS)], 1_700_000_000)
    batch = read_feed(spark, src, tracked=True)
    assert sorted(batch.filter("usgs_id = 'a'").first()["_unfit"]) == ["mag", "nst"]
    report = {(r[0], r[1]): r[2] for r in check_schema(batch, "usgs_id", {}, {"mag": "decimal(6,2)", "nst": "int"}).collect()}
    assert report["fits_decimal(6,2)", "mag"] == 1 and report["fits_int", "nst"] == 1
    with pytest.raises(ConstraintError, match="mag"):
        jobs.ingest_batch(spark, batch, f"{root}/raw", 1, stamp=T.AS_OF)
    assert SINK.versions(spark, f"{root}/raw") == []


def test_files_of_a_partitioned_write_stay_few(spark):
    days = spark.range(6000, numPartitions=8).select(
        F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("event_date"),
        (F.col("id") % 180 - 90).cast("double").alias("latitude"), F.lit(0.0).alias("longitude"))
    root = tempfile.mkdtemp(prefix="layout-")
    SINK.write_version(days, root, 1, partition_by=["event_date"], sort_within=SINK.spatial_sort_keys())
    assert len(glob.glob(f"{root}/v00000001/*/*.parquet")) <= 30 + 8
    assert "event_date" in SINK.read_latest(spark, root, layout=True).columns


def stamps(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/event_date=*/*.parquet")}


def test_a_batch_in_place_rewrites_only_its_dates(spark):
    raw = T.derived_raw(spark, "/root/testdata/sf0.001", T.AS_OF).drop("seq")
    root = tempfile.mkdtemp(prefix="place-")
    assert jobs.curate_in_place(spark, raw, root, stamp=T.AS_OF)["mode"] == "full"
    before, rows = stamps(root), spark.read.parquet(root).count()
    one = spark.read.parquet(root).filter("longitude is not null").orderBy("id").first()
    later = raw.filter(F.col("usgs_id") == one["usgs_id"]).withColumn("updated", F.lit(T.AS_OF).cast("timestamp_ntz")).withColumn("mag", F.lit(7).cast("decimal(6,2)"))
    new = later.withColumn("usgs_id", F.lit("fresh"))
    done = jobs.curate_in_place(spark, later.unionByName(new), root, stamp=T.AS_OF)
    after = stamps(root)
    day = f"event_date={one['event_date']}"
    assert done["dates"] == [one["event_date"]] and done["rows"] == 2
    assert {f: t for f, t in before.items() if day not in f} == {f: t for f, t in after.items() if day not in f}
    got = spark.read.parquet(root)
    assert got.count() == rows + 1 and got.select("id").distinct().count() == rows + 1
    assert got.filter(F.col("usgs_id") == one["usgs_id"]).first()["mag"] == Decimal("7.00")
    # the same batch again writes nothing
    assert jobs.curate_in_place(spark, later.unionByName(new), root, stamp=T.AS_OF)["rows"] == 0 and stamps(root) == after
    # a row whose date moves leaves its old date
    away = later.withColumn("time", F.lit(dt.datetime(2030, 5, 5)).cast("timestamp_ntz")).withColumn("updated", F.lit(dt.datetime(2030, 5, 6)).cast("timestamp_ntz"))
    jobs.curate_in_place(spark, away, root, stamp=T.AS_OF)
    moved = spark.read.parquet(root).filter(F.col("usgs_id") == one["usgs_id"]).collect()
    assert len(moved) == 1 and moved[0]["event_date"] == dt.date(2030, 5, 5) and moved[0]["id"] == one["id"]
    back = away.withColumn("time", F.lit(one["time"]).cast("timestamp_ntz")).withColumn("updated", F.lit(dt.datetime(2030, 5, 7)).cast("timestamp_ntz"))
    jobs.curate_in_place(spark, back, root, stamp=T.AS_OF)
    assert not glob.glob(f"{root}/event_date=2030-05-05") and spark.read.parquet(root).count() == rows + 1


def test_a_table_that_grew_is_read_anew(spark):
    root = tempfile.mkdtemp(prefix="grow-")
    spark.range(10).write.parquet(f"{root}/x.parquet")
    assert T.table(spark, root, "x").count() == 10
    spark.range(25).write.mode("append").parquet(f"{root}/x.parquet")
    assert T.table(spark, root, "x").count() == 35


def test_no_temporary_checkpoint_folder_on_a_cluster():
    conf = types.SimpleNamespace(get=lambda *a: None)
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SESSION.ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=context, conf=conf))


def test_size_proof_counts_rows_and_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    rows, size = SESSION.estimated_size(wide)
    assert rows == 100 and size >= 1_000_000
    assert not SESSION.proven_small(wide, 1000, 500_000) and SESSION.proven_small(wide, 1000, 2_000_000)
    assert not SESSION.proven_small(wide, 99)


def test_components_of_a_long_chain_have_one_label(spark):
    nodes = spark.range(400).select(F.col("id").alias("node"))
    edges = spark.range(399).select(F.col("id").alias("na"), (F.col("id") + 1).alias("nb"))
    labels = CL.connected_components(nodes, edges)
    assert labels.select("label").distinct().count() == 1 and labels.count() == 400


def test_zone_join_of_mixed_radius_stays_small_and_runs_the_distance_once(spark):
    rows = [(f"e{i}", Decimal("1.00"), Decimal(f"{(i * 37 % 3600) / 10 - 180:.6f}"), Decimal(f"{(i * 53 % 1700) / 10 - 85:.6f}")) for i in range(600)]
    events = spark.createDataFrame(rows, "usgs_id string, mag decimal(6,2), longitude decimal(10,6), latitude decimal(10,6)")
    zones = spark.createDataFrame([(f"z{i}", float(i % 160 - 80), float(i * 7 % 360 - 180), 50.0) for i in range(200)] + [("wide", 0.0, 0.0, 20000.0)],
                                  "name string, lat double, lon double, radius_km double")
    pairs = near_zones(events, zones)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("geodesic_m(") == 1
    got = pairs.groupBy("zone").count().collect()
    assert {r["zone"]: r["count"] for r in got}["wide"] >= 590
    assert near_zones(events, zones.limit(0)).count() == 0


def test_as_of_is_fixed():
    assert T.AS_OF == dt.datetime(2024, 1, 31)


def test_zone_join_scans_events_once_for_all_classes(spark):
    root = tempfile.mkdtemp(prefix="zones-")
    spark.range(500).select(F.concat(F.lit("e"), "id").alias("usgs_id"), F.lit(1).cast("decimal(6,2)").alias("mag"),
                            (F.col("id") * 37 % 360 - 180).cast("decimal(10,6)").alias("longitude"),
                            (F.col("id") * 17 % 180 - 90).cast("decimal(10,6)").alias("latitude")).write.parquet(f"{root}/events")
    events = spark.read.parquet(f"{root}/events")
    zones = spark.createDataFrame([(f"z{r}", 10.0, 20.0, float(r)) for r in (0, 1, 30, 700, 5000, 20000, 40000)] + [("none", 1.0, 1.0, None)],
                                  "name string, lat double, lon double, radius_km double")
    pairs = near_zones(events, zones)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    got = {r["zone"]: r["count"] for r in pairs.groupBy("zone").count().collect()}
    assert got["z40000"] == 500 and got["z20000"] > got["z5000"] > got["z700"] > 0 and "none" not in got
