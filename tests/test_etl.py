"""Feed scans, upserts, serial ids, incremental curation (FIXTURES.md section 3)."""

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from tremorlake.operators import upsert as U
from tremorlake.operators.clean import clean
from tremorlake.schema import RAW_SCHEMA
from tremorlake.sources.feed import read_feed
from tremorlake.sources.tables import ts_literal

MS = 1706000000000


def feature(fid, props, coords=(10.0, 20.0, 5.0), geometry=True):
    f = {"type": "Feature", "id": fid, "properties": props}
    f["geometry"] = {"type": "Point", "coordinates": list(coords)} if geometry else None
    return f


def write_doc(features):
    d = tempfile.mkdtemp(prefix="feed-")
    with open(os.path.join(d, "doc.json"), "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh, indent=1)
    return d


def test_strict_scan_skips_and_fallbacks(spark):
    feats = [
        feature("ok1", {"time": MS, "updated": 0, "mag": 1.5}),
        feature("ok2", {"time": MS, "updated": None, "tsunami": None}),
        feature("ok3", {"time": MS, "updated": MS + 5, "tsunami": 1}),
        feature("t_null", {"time": None}),
        feature("t_zero", {"time": 0}),
        feature("", {"time": MS}),
        feature("two", {"time": MS}, coords=(1.0, 2.0)),
        feature("nogeom", {"time": MS}, geometry=False),
    ]
    rows = {r.usgs_id: r for r in read_feed(spark, write_doc(feats)).collect()}
    assert set(rows) == {"ok1", "ok2", "ok3"}
    assert rows["ok1"].updated == rows["ok1"].time
    assert rows["ok2"].updated == rows["ok2"].time
    assert rows["ok1"].tsunami == 0 and rows["ok2"].tsunami is None and rows["ok3"].tsunami == 1
    assert rows["ok1"].mag == Decimal("1.50") and rows["ok1"].depth == Decimal("5.00")
    assert rows["ok1"].time == dt.datetime(2024, 1, 23, 8, 53, 20)


def test_lenient_scan_keeps_everything(spark):
    feats = [feature("a", {"mag": 1.0}), feature("b", {"time": MS}, geometry=False)]
    rows = {r.usgs_id: r for r in read_feed(spark, write_doc(feats), strict=False).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].time == dt.datetime(1970, 1, 1)
    assert rows["b"].longitude is None
    assert "id" not in read_feed(spark, write_doc(feats), strict=False).columns


def raw_rows(spark, rows):
    base = {f.name: None for f in RAW_SCHEMA.fields}
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        data.append(tuple(d[f.name] for f in RAW_SCHEMA.fields))
    return spark.createDataFrame(data, RAW_SCHEMA)


T0 = dt.datetime(2024, 1, 10)


def test_upsert_null_overwrites_and_first_last(spark):
    cur = raw_rows(spark, [{"id": "k1", "usgs_id": "k1", "alert": "green", "url": "old", "mag": Decimal("1.00")}])
    rows = [
        {"id": "k1", "usgs_id": "k1", "alert": None, "url": "u9", "mag": Decimal("9.00")},
        {"id": "k2", "usgs_id": "k2", "url": "u1", "mag": Decimal("1.00")},
        {"id": "k2", "usgs_id": "k2", "url": "u2", "mag": Decimal("2.00")},
    ]
    bat = raw_rows(spark, rows).withColumn("_o", F.when(F.col("url") == "u9", 0).when(F.col("url") == "u1", 1).otherwise(2))
    out = {r.usgs_id: r for r in U.raw_upsert(cur, bat, stamp=ts_literal(T0), order="_o").collect()}
    assert out["k1"].alert is None            # a null in the batch overwrites
    assert out["k1"].url == "old"             # url is not an update column
    assert out["k1"].mag == Decimal("9.00")
    assert out["k2"].url == "u1" and out["k2"].mag == Decimal("2.00")
    assert out["k1"].ingested_at == T0


def test_upsert_twice_is_once(spark):
    cur = raw_rows(spark, [{"id": f"k{i}", "usgs_id": f"k{i}", "mag": Decimal(i)} for i in range(5)])
    bat = raw_rows(spark, [{"id": f"k{i}", "usgs_id": f"k{i}", "mag": Decimal(10 + i)} for i in range(3, 8)])
    once = U.raw_upsert(cur, bat, stamp=ts_literal(T0))
    twice = U.raw_upsert(once, bat, stamp=ts_literal(T0))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_shuffle_path_equals_broadcast_path(spark):
    cur = raw_rows(spark, [{"id": f"k{i}", "usgs_id": f"k{i}", "mag": Decimal(i), "url": "c"} for i in range(6)])
    bat = raw_rows(spark, [{"id": f"k{i}", "usgs_id": f"k{i}", "mag": Decimal(i + 1), "url": "b"} for i in range(3, 9)])
    a = U.upsert(cur, bat, "usgs_id", ["mag"], "ingested_at", ts_literal(T0))
    b = U.upsert(cur, bat, "usgs_id", ["mag"], "ingested_at", ts_literal(T0), broadcast_limit=0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_assign_ids_contiguous_in_order(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"))
    out = U.assign_ids(df, ["k"], start=10, partitions=7).collect()
    got = sorted((r.k, r.id) for r in out)
    assert [i for _, i in got] == list(range(11, 511))


def test_incremental_change_detection(spark):
    final = spark.createDataFrame(
        [("a", T0, T0), ("b", T0, T0), ("c", T0, None)], "usgs_id string, time timestamp_ntz, updated timestamp_ntz")
    raw = raw_rows(spark, [
        {"usgs_id": "a", "time": T0, "updated": T0, "longitude": Decimal("1"), "latitude": Decimal("1")},
        {"usgs_id": "b", "time": T0, "updated": T0 + dt.timedelta(1), "longitude": Decimal("1"), "latitude": Decimal("1")},
        {"usgs_id": "c", "time": T0 + dt.timedelta(1), "updated": None, "longitude": Decimal("1"), "latitude": Decimal("1")},
        {"usgs_id": "d", "time": T0, "longitude": Decimal("1"), "latitude": Decimal("1")},
        {"usgs_id": "e", "time": T0, "longitude": None, "latitude": Decimal("1")},
    ])
    assert sorted(r.usgs_id for r in U.changed(raw, final).collect()) == ["b", "c", "d"]


def test_clean_defaults_and_coordinates(spark):
    rows = [
        {"usgs_id": "a", "longitude": Decimal("180"), "latitude": Decimal("90"), "tsunami": None},
        {"usgs_id": "b", "longitude": Decimal("-180"), "latitude": Decimal("0")},
        {"usgs_id": "c", "longitude": Decimal("180.000001"), "latitude": Decimal("0")},
    ]
    raw = raw_rows(spark, rows).select("usgs_id", "mag", "place", "time", "updated", "magType", "tsunami", "alert",
                                       "status", "sig", "depth", "longitude", "latitude")
    out = {r.usgs_id: r for r in clean(raw).collect()}
    assert set(out) == {"a", "b"}
    a = out["a"]
    assert (a.place, a.status, a.magType, a.alert, a.tsunami, a.sig) == ("Unknown", "unknown", "unknown", "", 0, 0)
    assert a.mag is None and a.depth is None
