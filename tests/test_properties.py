"""Property tests: region() against a direct statement of its semantics, and
results that must not depend on partitioning."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremorlake.functions import scalar as S
from tremorlake.operators import analysis as A
from tremorlake.operators import cluster as CL
from tremorlake.operators import query as Q
from tremorlake.sources.tables import AS_OF, quakes

SF = "/root/testdata/sf0.001"


def region_py(place):
    if place is None or place.strip(" ") == "":
        return "Sin ubicación"
    if "," in place:
        return re.sub(r"^.*,\s*", "", place, count=1, flags=re.S).strip(" ")
    if " of " in place:
        return re.sub(r"^.* of\s+", "", place, count=1, flags=re.S).strip(" ")
    return place


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab ,of\n\tO", max_size=14)), min_size=150, max_size=150))
def test_region_matches_semantics(spark, places):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(places)], "i int, p string")
    got = {r.i: r.r for r in df.select("i", S.region("p").alias("r")).collect()}
    assert got == {i: region_py(p) for i, p in enumerate(places)}


def test_rollups_do_not_depend_on_partitioning(spark):
    f = A.analysis_filter(quakes(spark, SF), days_back=30, as_of=AS_OF)
    before = sorted(map(tuple, A.analysis_grouping_sets(f).collect()))
    f2 = A.analysis_filter(quakes(spark, SF).repartition(7, "usgs_id"), days_back=30, as_of=AS_OF)
    assert sorted(map(tuple, A.analysis_grouping_sets(f2).collect())) == before


def test_clusters_do_not_depend_on_partitioning(spark):
    recent = Q.since(quakes(spark, SF), AS_OF, 30).select("id", "longitude", "latitude")
    eps = CL.eps_from_km(150)
    a = {r.id: r.cluster_id for r in CL.cluster_dbscan(recent, eps).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = {r.id: r.cluster_id for r in CL.cluster_dbscan(recent.repartition(5), eps).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b and len(set(a.values())) > 1
