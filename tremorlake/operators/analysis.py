"""Roll-ups over the filtered curated table.

Every aggregate is a native hash aggregate (partial per task, final after the
shuffle), so one hot region or day costs no more than a cold one.  Averages
are exact (integer units, half-away-from-zero), independent of partitioning.

The roll-ups take events or a ``cube`` of them, one row per class, region, depth
class and day with exact counts and sums; both give the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import ensure_checkpoint_dir
from . import query as Q

LABEL_RANK = {label: i for i, label in enumerate(S.MAG_CLASSES)}


def with_classes(df: DataFrame) -> DataFrame:
    """Adds ``category`` (P13) and ``region``."""
    return df.withColumn("category", S.mag_class("mag")).withColumn("region", S.region("place"))


def analysis_filter(df: DataFrame, min_mag=-2.0, max_mag=10.0, days_back=30, all_time=False,
                    lat=None, lon=None, dist_km=None, as_of=None) -> DataFrame:
    """The one filter under every part of the analysis, with an optional radius."""
    Q.check_args(min_mag, max_mag, days_back=days_back, lat=lat, lon=lon, dist_km=dist_km)
    f = Q.filtered_events(df, min_mag, max_mag, days_back, all_time, as_of)
    if dist_km is not None:
        from .radius import within_km

        f = within_km(f, lat, lon, dist_km)
    return with_classes(f)


# --- Cube of A10 --------------------------------------------------------------------

CUBE_KEYS = ["category", "region", "depth_group", "day"]


def cube(f: DataFrame) -> DataFrame:
    """One row per class, region, depth class and day that occur: counts, sums, extremes, newest time."""
    keyed = f.select("category", "region", S.depth_class("depth").alias("depth_group"), S.period_start("time", "day").alias("day"), "mag", "depth", "time")
    return keyed.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("mag").alias("_sum_mag"), F.count("mag").alias("_n_mag"),
        F.sum("depth").alias("_sum_depth"), F.count("depth").alias("_n_depth"),
        F.max("mag").alias("_max_mag"), F.min("mag").alias("_min_mag"), F.max("time").alias("_last"))


def _is_cube(f: DataFrame) -> bool:
    return "_n" in f.columns


def _events(f: DataFrame) -> Column:
    return (F.coalesce(F.sum("_n"), F.lit(0)) if _is_cube(f) else F.count(F.lit(1))).cast("int")


def _avg(f: DataFrame, c: str) -> Column:
    return S.avg_of_sums(f"_sum_{c}", f"_n_{c}") if _is_cube(f) else S.avg_rounded(c)


# --- A1 ---------------------------------------------------------------------------

def summary(f: DataFrame) -> DataFrame:
    high, low, last = ("_max_mag", "_min_mag", "_last") if _is_cube(f) else ("mag", "mag", "time")
    return f.agg(
        _events(f).alias("total_events"),
        _avg(f, "mag").alias("avg_magnitude"),
        _avg(f, "depth").alias("avg_depth"),
        F.max(high).cast("double").alias("max_magnitude"),
        F.min(low).cast("double").alias("min_magnitude"),
        F.max(last).alias("last_update"),
    )


# --- A2 / L6 ------------------------------------------------------------------------

def table_summary(q: DataFrame) -> DataFrame:
    """Whole-table summary.  ``most_active_place`` is the place of the first row
    by magnitude descending with nulls first (the reference's order), ties by
    usgs_id - one min_by, no sort and no second scan."""
    first_key = F.struct(F.col("mag").isNotNull().alias("has_mag"), (-F.col("mag")).alias("neg_mag"),
                         F.col("usgs_id").alias("key"))
    return q.agg(
        F.count(F.lit(1)).alias("total_events"),
        S.avg_rounded("mag").alias("avg_magnitude"),
        F.max("mag").cast("double").alias("max_magnitude"),
        F.min("mag").cast("double").alias("min_magnitude"),
        F.sum("tsunami").cast("long").alias("total_tsunami"),
        F.max("time").alias("last_update"),
        F.min_by("place", first_key).alias("most_active_place"),
    )


# --- A3 / A11 / P31 -----------------------------------------------------------------

def category_counts(f: DataFrame) -> DataFrame:
    """All four classes, zero when absent: one global aggregate, unpivoted."""
    many = F.col("_n") if _is_cube(f) else F.lit(1)
    counts = f.agg(*[F.coalesce(F.sum(F.when(F.col("category") == lab, many)), F.lit(0)).cast("int").alias(lab) for lab in S.MAG_CLASSES])
    pairs = ", ".join(f"'{lab}', `{lab}`" for lab in S.MAG_CLASSES)
    return counts.select(F.expr(f"stack({len(S.MAG_CLASSES)}, {pairs}) AS (category, events)"))


def dominant_category(counts: DataFrame) -> DataFrame:
    """A11 + P31: class with the highest count (first label wins ties; '--' with
    no events) and the activity sentence."""
    rank = F.create_map(*[F.lit(x) for kv in LABEL_RANK.items() for x in kv])
    d = counts.agg(
        F.max_by("category", F.struct(F.col("events"), -rank[F.col("category")])).alias("top"),
        F.sum("events").alias("total"),
        F.sum(F.when(F.col("category") == "Severo", F.col("events"))).alias("severe"),
        F.sum(F.when(F.col("category") == "Fuerte", F.col("events"))).alias("strong"),
    )
    return d.select(
        F.when(F.col("total") > 0, F.col("top")).otherwise(F.lit("--")).alias("dominant_category"),
        F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total_events"),
        insight_text().alias("insight"),
    )


def insight_text():
    t = S.INSIGHT_TEXT
    return (F.when(F.coalesce(F.col("total"), F.lit(0)) <= 0, t["none"])
            .when(F.coalesce(F.col("severe"), F.lit(0)) > 0, t["severe"])
            .when(F.coalesce(F.col("strong"), F.lit(0)) > 0, t["strong"])
            .otherwise(t["low"]))


# --- A4, A5 ---------------------------------------------------------------------------

def top_regions(f: DataFrame, n: int = 8) -> DataFrame:
    g = f.groupBy("region").agg(_events(f).alias("events"), _avg(f, "mag").alias("avg_magnitude"))
    return g.orderBy(F.col("events").desc(), F.col("avg_magnitude").desc_nulls_first(), F.col("region")).limit(n)


def depth_groups(f: DataFrame) -> DataFrame:
    group = F.col("depth_group") if _is_cube(f) else S.depth_class("depth").alias("depth_group")
    g = f.groupBy(group).agg(_events(f).alias("events"), _avg(f, "mag").alias("avg_magnitude"))
    return g.orderBy(F.col("events").desc(), F.col("depth_group"))


# --- A6-A8 ---------------------------------------------------------------------------

def period_counts(f: DataFrame, unit: str) -> DataFrame:
    """Per UTC day / month / year: count and average magnitude, by period."""
    at = "day" if _is_cube(f) else "time"
    g = f.groupBy(S.period_start(at, unit).alias("_start")).agg(_events(f).alias("events"), _avg(f, "mag").alias("avg_magnitude"))
    return g.orderBy(F.col("_start").asc_nulls_last()).select(
        S.period_label("_start", unit).alias("period"), "events", "avg_magnitude")


def daily_counts(f: DataFrame) -> DataFrame:
    return period_counts(f, "day")


def monthly_counts(f: DataFrame) -> DataFrame:
    return period_counts(f, "month")


def yearly_counts(f: DataFrame) -> DataFrame:
    return period_counts(f, "year")


# --- A10 ------------------------------------------------------------------------------

def analysis(df: DataFrame, **filters) -> dict[str, DataFrame]:
    """Every part of the analysis under one filter.

    One scan makes the cube, which is checkpointed (files that go with the
    frame; nothing stays in memory) and is all that the roll-ups read.  Only the
    strongest events read the filtered events themselves, when they are asked for.
    """
    f = analysis_filter(df, **filters)
    ensure_checkpoint_dir(df.sparkSession)
    small = cube(f).checkpoint()
    counts = category_counts(small)
    return {
        "cube": small,
        "summary": summary(small),
        "category_counts": counts,
        "top_regions": top_regions(small),
        "depth_groups": depth_groups(small),
        "strongest_events": Q.strongest(f),
        "daily_counts": daily_counts(small),
        "monthly_counts": monthly_counts(small),
        "yearly_counts": yearly_counts(small),
        "dominant": dominant_category(counts),
    }


GROUPING_PARTS = ["category", "region", "depth_group", "day", "month", "year"]


def analysis_grouping_sets(f: DataFrame) -> DataFrame:
    """A10 in one pass: GROUPING SETS over class, region, depth class, day,
    month, year and the whole, in long form (part, key, events, avg_magnitude).
    One scan and one shuffle instead of seven."""
    keyed = f.select(
        "mag", "category", "region",
        S.depth_class("depth").alias("depth_group"),
        *[S.period_start("time", p).alias(p) for p in ("day", "month", "year")],  # labelled after grouping
    )
    sets = [[F.col(p)] for p in GROUPING_PARTS] + [[]]
    g = keyed.groupingSets(sets, *GROUPING_PARTS).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).cast("int").alias("events"),
        S.avg_rounded("mag").alias("avg_magnitude"),
    )
    n = len(GROUPING_PARTS)
    part = F.when(F.col("_gid") == (1 << n) - 1, F.lit("all"))
    key = F.lit(None).cast("string")
    for i, p in enumerate(GROUPING_PARTS):
        gid = ((1 << n) - 1) ^ (1 << (n - 1 - i))
        part = part.when(F.col("_gid") == gid, F.lit(p))
        label = S.period_label(p, p) if p in ("day", "month", "year") else F.col(p)
        key = F.when(F.col("_gid") == gid, label).otherwise(key)
    return g.select(part.alias("part"), key.alias("key"), "events", "avg_magnitude")


# --- A12, A13 ----------------------------------------------------------------------------

def average_depth(df: DataFrame) -> DataFrame:
    """Mean depth over rows that have one (unrounded; null with none).
    The sum is exact (decimal), so the value does not depend on partitioning."""
    d = F.col("depth").cast("decimal(10,2)")
    return df.agg(F.try_divide(F.sum(d).cast("double"), F.count(d)).alias("average_depth"))


def most_active_region(f: DataFrame) -> DataFrame:
    """The first row of the top-regions ranking ('--' when there is none)."""
    top = top_regions(f, 1)
    return top.agg(F.coalesce(F.first("region"), F.lit("--")).alias("most_active_region"))


def strongest_event(df: DataFrame) -> DataFrame:
    """The strongest event, a null magnitude counting as 0.  Ties go to the
    row that comes first in the list order (newer time, then larger id).  One
    max_by, no sort; no row for an empty input."""
    tie = F.col("id") if "id" in df.columns else F.col("usgs_id")
    key = F.struct(F.coalesce(F.col("mag").cast("double"), F.lit(0.0)).alias("m"), F.col("time").alias("t"),
                   tie.alias("k"))
    best = df.agg(F.max_by(F.struct("usgs_id", "mag", "place", "depth", "time"), key).alias("e"))
    return best.filter(F.col("e").isNotNull()).select("e.*")


# --- G10 ------------------------------------------------------------------------------

def mean_centre(df: DataFrame) -> DataFrame:
    """Mean latitude and longitude of the events (exact, 6 places)."""
    return df.agg(S.avg_rounded("latitude", 6, 6).alias("centre_lat"),
                  S.avg_rounded("longitude", 6, 6).alias("centre_lon"),
                  F.count("latitude").alias("points"))
