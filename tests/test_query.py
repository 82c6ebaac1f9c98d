"""Lists, pages, windows, sorts, summaries."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tremorlake.operators import analysis as A
from tremorlake.operators import query as Q

AS_OF = dt.datetime(2024, 1, 31)


def quakes(spark, n=600):
    rows = []
    for i in range(n):
        mag = None if i % 13 == 0 else Decimal(i % 900 - 100) / 100
        rows.append((i + 1, f"q{i:04d}", mag, f"{i % 7} km S of R{i % 5}", AS_OF - dt.timedelta(hours=i),
                     Decimal(f"{(i * 37) % 700}.25"), Decimal("1.5"), Decimal("2.5"), i % 2, "ml", "", "reviewed", 1))
    return spark.createDataFrame(rows, "id long, usgs_id string, mag decimal(6,2), place string, time timestamp_ntz, "
                                       "depth decimal(10,2), longitude decimal(10,6), latitude decimal(10,6), "
                                       "tsunami int, magType string, alert string, status string, sig int")


def test_time_window_is_strict(spark):
    df = quakes(spark)
    got = Q.since(df, AS_OF, 1).select(F.min("time")).first()[0]
    assert got == AS_OF - dt.timedelta(hours=23)   # exactly as_of - 1 day is excluded


def test_page_past_end_and_walk(spark):
    df = quakes(spark, 600)
    empty = Q.list_events(df, offset=5000, all_time=True, as_of=AS_OF)
    assert empty.count() == 0
    p = Q.event_page(df, 9, as_of=AS_OF).first()
    assert (p.page, p.pages) == (3, 3)     # 600 - 47 null mags = 553 rows -> 3 pages, page clamped


def test_pages_concatenate_to_whole_list(spark):
    df = quakes(spark, 600)
    whole = [r.usgs_id for r in Q.list_events(df, limit=1000, all_time=True, as_of=AS_OF).collect()]
    pages = []
    for off in range(0, 600, 100):
        pages += [r.usgs_id for r in Q.list_events(df, limit=100, offset=off, all_time=True, as_of=AS_OF).collect()]
    assert pages == whole


def test_deep_page_path_equals_topk(spark, monkeypatch):
    df = quakes(spark, 600)
    topk = [r.usgs_id for r in Q.list_events(df, limit=50, offset=300, all_time=True, sort="mag_desc").collect()]
    monkeypatch.setattr(Q, "TOPK_ROW_LIMIT", 10)
    deep = [r.usgs_id for r in Q.list_events(df, limit=50, offset=300, all_time=True, sort="mag_desc").collect()]
    assert deep == topk


def test_null_mag_sorts_last(spark):
    df = quakes(spark, 40)
    for mode in ("mag_asc", "mag_desc"):
        rows = df.orderBy(*Q.sort_columns(mode)).collect()
        assert rows[-1].mag is None


def test_sort_mode_fallbacks():
    assert Q.sort_mode("bogus") == "recent"
    assert Q.sort_mode("bogus", radius=True) == "distance"
    assert Q.sort_mode("distance") == "recent"


def test_argument_checks():
    with pytest.raises(Q.ArgumentError):
        Q.check_args(5, 1)
    with pytest.raises(Q.ArgumentError):
        Q.check_args(lat=1.0)
    with pytest.raises(Q.ArgumentError):
        Q.check_args(limit=1001)


def test_class_counts_sum_to_total(spark):
    f = A.analysis_filter(quakes(spark), all_time=True)
    counts = {r.category: r.events for r in A.category_counts(f).collect()}
    assert set(counts) == {"Micro", "Leve", "Fuerte", "Severo"}
    assert sum(counts.values()) == A.summary(f).first().total_events


def test_table_summary_place_of_null_mag(spark):
    df = quakes(spark, 40)
    s = A.table_summary(df).first()
    assert s.most_active_place == df.filter(F.col("mag").isNull()).orderBy("usgs_id").first().place


def test_analysis_bundle_and_grouping_sets_agree(spark):
    f = A.analysis_filter(quakes(spark), all_time=True)
    parts = A.analysis(quakes(spark), all_time=True)
    gs = {(r.part, r.key): (r.events, r.avg_magnitude) for r in A.analysis_grouping_sets(f).collect()}
    for r in parts["top_regions"].collect():
        assert gs[("region", r.region)] == (r.events, r.avg_magnitude)
    for r in parts["daily_counts"].collect():
        assert gs[("day", r.period)] == (r.events, r.avg_magnitude)
    assert parts["dominant"].first().dominant_category in {"Micro", "Leve", "Fuerte", "Severo"}


def test_rollups_of_the_cube_equal_those_of_the_events(spark):
    df = quakes(spark).withColumn("depth", F.when(F.col("id") % 7 != 3, F.col("depth")))
    f = A.analysis_filter(df, all_time=True)
    parts = A.analysis(df, all_time=True)
    for name, made in {"summary": A.summary, "category_counts": A.category_counts, "top_regions": A.top_regions, "depth_groups": A.depth_groups,
                       "daily_counts": A.daily_counts, "monthly_counts": A.monthly_counts, "yearly_counts": A.yearly_counts}.items():
        want = made(f)
        assert parts[name].schema == want.schema and parts[name].collect() == want.collect(), name
        assert "FileScan" not in parts[name]._jdf.queryExecution().executedPlan().toString()
    nothing = A.analysis(df.limit(0), all_time=True)
    assert nothing["summary"].collect() == A.summary(f.limit(0)).collect() and nothing["top_regions"].count() == 0
    assert {r.events for r in nothing["category_counts"].collect()} == {0} and nothing["strongest_events"].count() == 0


def test_average_depth_and_picks(spark):
    df = quakes(spark, 40)
    avg = A.average_depth(df).first()[0]
    want = sum(float(r.depth) for r in df.collect()) / 40
    assert abs(avg - want) < 1e-9
    f = A.analysis_filter(df, all_time=True)
    assert A.most_active_region(f).first()[0] == A.top_regions(f).first().region
    assert A.most_active_region(f.limit(0)).first()[0] == "--"
    top = A.strongest_event(df).first()
    rows = df.collect()
    best = max(float(r.mag or 0) for r in rows)
    newest = max(r.time for r in rows if float(r.mag or 0) == best)
    assert float(top.mag or 0) == best and top.time == newest   # a null magnitude counts as 0


def test_strongest_event_ties_and_empty(spark):
    t = AS_OF - dt.timedelta(hours=1)
    rows = [(1, "a", Decimal("5.00"), t), (7, "b", Decimal("5.00"), t), (3, "c", None, t + dt.timedelta(hours=1)),
            (2, "d", Decimal("4.00"), t + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, "id long, usgs_id string, mag decimal(6,2), time timestamp_ntz").select(
        "*", F.lit("p").alias("place"), F.lit(Decimal("1.00")).cast("decimal(10,2)").alias("depth"))
    # equal magnitude and time: the row listed first in recent order (larger id) wins
    assert A.strongest_event(df).first().usgs_id == "b"
    assert A.strongest_event(df.filter(F.col("mag").isNull())).first().usgs_id == "c"   # null counts as 0
    assert A.strongest_event(df.limit(0)).count() == 0


def test_average_depth_exact_sum(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (None,)], "depth decimal(10,2)")
    assert abs(A.average_depth(df).first()[0] - 0.15) < 1e-15      # exact decimal sum, one division
    assert A.average_depth(df.filter("depth IS NULL")).first()[0] is None


@pytest.mark.parametrize("sort", ["recent", "mag_desc", "mag_asc"])
def test_deep_pages_sort_only_their_ranges(spark, monkeypatch, sort):
    # hundreds of rows of one day and of one magnitude, ties in every key, a null time
    hot = quakes(spark, 300).withColumn("mag", F.when(F.col("id") % 3 > 0, F.lit("4.50").cast("decimal(6,2)")).otherwise(F.col("mag")))
    hot = hot.withColumn("time", F.when(F.col("id") % 5 > 2, F.lit(AS_OF).cast("timestamp_ntz")).when(F.col("id") != 44, F.col("time")))
    whole = [r.usgs_id for r in Q.filtered_events(hot, all_time=True).orderBy(*Q.sort_columns(sort)).collect()]
    monkeypatch.setattr(Q, "TOPK_ROW_LIMIT", 60)
    f = Q.filtered_events(hot, all_time=True)
    for offset in (0, 45, 120, 200, len(whole) - 5, len(whole) + 10):
        held, skip = Q.narrowed(f, sort, offset, 20)
        assert skip <= offset and (offset + 20 <= 60 or held.count() < len(whole))
        assert [r.usgs_id for r in Q.page_rows(f, Q.sort_columns(sort), offset, 20, sort).collect()] == whole[offset:offset + 20], offset


def test_a_shallow_page_runs_nothing_while_it_is_built(spark, monkeypatch):
    df = quakes(spark, 600)
    group = "page-build"
    spark.sparkContext.setJobGroup(group, "build")
    page = Q.event_page(df, 2, as_of=AS_OF)
    built = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert built == 0
    shallow = [tuple(r) for n in (1, 2, 3, 7) for r in Q.event_page(df, n, as_of=AS_OF).collect()]
    assert page.columns == [*Q.LIST_COLUMNS, "total_count", "page", "pages"]
    monkeypatch.setattr(Q, "TOPK_ROW_LIMIT", 1)
    assert [tuple(r) for n in (1, 2, 3, 7) for r in Q.event_page(df, n, as_of=AS_OF).collect()] == shallow
    assert Q.event_page(df.limit(0), 2, as_of=AS_OF).collect() == []
