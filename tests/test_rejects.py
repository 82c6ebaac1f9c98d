"""What does not fit is reported or stops the load; nothing is nulled in silence."""

import json
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tremorlake.operators.clean import clean
from tremorlake.schema import CURATE_INPUT_COLUMNS, RAW_SCHEMA
from tremorlake.sources import feed as FEED

MS = 1706000000000


def landed(features):
    d = tempfile.mkdtemp(prefix="feed-")
    with open(os.path.join(d, "doc.json"), "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh)
    return d


def feature(fid, coords=(10.0, 20.0, 5.0), **props):
    return {"type": "Feature", "id": fid, "properties": {"time": MS, "mag": 1.5, **props}, "geometry": {"type": "Point", "coordinates": list(coords)}}


def test_a_scan_stops_at_a_value_that_does_not_fit(spark):
    path = landed([feature("a", mag=123456.5), feature("b")])
    for strict in (True, False):
        with pytest.raises(Exception, match=r"mag of event a does not fit decimal\(6,2\): 123456.5"):
            FEED.read_feed(spark, path, strict=strict).collect()
    with pytest.raises(Exception, match="nst of event a does not fit int"):
        FEED.read_feed(spark, landed([feature("a", nst=99999999999)])).collect()
    assert [r.usgs_id for r in FEED.read_feed(spark, landed([feature("b", mag=None)])).collect()] == ["b"]


def test_screening_gives_every_reason_and_splits_in_one_pass(spark):
    path = landed([feature("ok", mag=9999.99), feature("a", mag=123456.5, nst=99999999999), feature("b", code="9" * 40), feature("", time=0),
                   feature("two", coords=(1.0, 2.0)), {"type": "Feature", "id": "bare", "properties": None, "geometry": None}])
    screened = FEED.screen_feed(spark, path)
    assert screened.count() == 6
    loaded, rejected = FEED.split(screened)
    assert [(r["usgs_id"], r["mag"]) for r in loaded.collect()] == [("ok", Decimal("9999.99"))]
    assert loaded.drop(FEED.ARRIVAL).columns == RAW_SCHEMA.names[:-1]
    got = {(r["usgs_id"], r["reason"], r["column_name"], r["value"]) for r in rejected.collect()}
    assert got == {("a", "does not fit decimal(6,2)", "mag", "123456.5"), ("a", "does not fit int", "nst", "99999999999"),
                   ("b", "longer than 30", "code", "9" * 40), ("", "missing", "id", None), ("", "missing", "time", None),
                   ("two", "missing", "coordinates", None), ("bare", "missing", "properties", None), ("bare", "missing", "coordinates", None)}
    for frame in (loaded, rejected):
        assert "Scan json" not in frame._jdf.queryExecution().executedPlan().toString()


def texts(spark, **over):
    base = dict.fromkeys(CURATE_INPUT_COLUMNS) | {"usgs_id": "a", "mag": "1.5", "depth": "3", "longitude": "10", "latitude": "20", "time": "2024-01-01T00:00:00"}
    base |= over
    return spark.createDataFrame([tuple(base[c] for c in CURATE_INPUT_COLUMNS)], ", ".join(f"{c} string" for c in CURATE_INPUT_COLUMNS))


def test_clean_nulls_what_is_no_number_and_stops_at_what_does_not_fit(spark):
    row = clean(texts(spark, mag="x", depth="", sig="what")).first()
    assert row.mag is None and row.depth is None and row.sig == 0
    assert clean(texts(spark, mag="9999.99")).first().mag == Decimal("9999.99")
    with pytest.raises(Exception, match=r"mag does not fit decimal\(6,2\)"):
        clean(texts(spark, mag="123456.5")).collect()
    with pytest.raises(Exception, match="sig does not fit int"):
        clean(texts(spark, sig="99999999999")).collect()
    # a row that is dropped for its coordinates stops nothing, however far they lie
    for far in ("190", "99999999", "Infinity"):
        assert clean(texts(spark, mag="123456.5", longitude=far)).collect() == []
    assert clean(texts(spark).withColumn("mag", F.lit(2.5))).first().mag == Decimal("2.50")
