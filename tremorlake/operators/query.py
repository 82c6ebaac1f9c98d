"""Filters, sorts, lists and pages over the curated table."""

from __future__ import annotations

from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..sources.tables import ts_literal

# Argument ranges and defaults of the list and search calls.
MAG_LIMITS = (-10.0, 10.0)
LIMIT_RANGE = (1, 1000)
RADIUS_KM_RANGE = (1.0, 20000.0)
PAGE_SIZE = 250
SORT_MODES = ("recent", "mag_desc", "mag_asc", "distance")
# Beyond this many rows up to its end, a page is cut from the ranges of the sort
# key that hold it instead of one top-k.
TOPK_ROW_LIMIT = 100_000

LIST_COLUMNS = ["id", "usgs_id", "mag", "place", "time", "magType", "tsunami", "alert",
                "status", "sig", "depth", "longitude", "latitude"]


class ArgumentError(ValueError):
    """A call argument outside its range (the reference answers 422)."""


# --- P22 ----------------------------------------------------------------------

def check_args(min_mag: float = -2, max_mag: float = 10, limit: int | None = None, offset: int | None = None,
               days_back: int | None = None, lat: float | None = None, lon: float | None = None,
               dist_km: float | None = None, radius_required: bool = False) -> None:
    def bad(msg):
        raise ArgumentError(msg)

    for name, v in (("min_mag", min_mag), ("max_mag", max_mag)):
        if not MAG_LIMITS[0] <= v <= MAG_LIMITS[1]:
            bad(f"{name} outside [-10, 10]")
    if min_mag > max_mag:
        bad("min_mag > max_mag")
    if limit is not None and not LIMIT_RANGE[0] <= limit <= LIMIT_RANGE[1]:
        bad("limit outside [1, 1000]")
    if offset is not None and offset < 0:
        bad("offset < 0")
    if days_back is not None and days_back < 1:
        bad("days_back < 1")
    given = [v is not None for v in (lat, lon, dist_km)]
    if radius_required and not all(given):
        bad("lat, lon and dist_km are required")
    if any(given) and not all(given):
        bad("lat, lon and dist_km go together")
    if all(given):
        if not -90 <= lat <= 90:
            bad("lat outside [-90, 90]")
        if not -180 <= lon <= 180:
            bad("lon outside [-180, 180]")
        if not RADIUS_KM_RANGE[0] <= dist_km <= RADIUS_KM_RANGE[1]:
            bad("dist_km outside [1, 20000]")


# --- P9, P10, P12 ---------------------------------------------------------------

def _mag_bound(x: float, up: bool) -> Column:
    d = Decimal(repr(float(x))).quantize(Decimal("0.01"), rounding=ROUND_CEILING if up else ROUND_FLOOR)
    return F.lit(d)


def mag_between(df: DataFrame, lo: float, hi: float) -> DataFrame:
    """Inclusive magnitude range; null magnitudes drop out.  Bounds are rounded
    inward to the column's two places, which keeps the predicate exact and the
    column uncast (pushed to the scan)."""
    return df.filter((F.col("mag") >= _mag_bound(lo, True)) & (F.col("mag") <= _mag_bound(hi, False)))


def since(df: DataFrame, as_of=None, days: int | None = 7, all_time: bool = False) -> DataFrame:
    """time > as_of - days (strict, no upper end); nothing when ``all_time``."""
    if all_time or days is None:
        return df
    cutoff = ts_literal(as_of) - F.make_dt_interval(F.lit(int(days)))
    cond = F.col("time") > cutoff
    if "event_date" in df.columns:
        # implied by the time test; lets a table partitioned by event date skip folders
        cond = cond & (F.col("event_date") >= F.to_date(cutoff))
    return df.filter(cond)


def detail(df: DataFrame, usgs_id: str) -> DataFrame:
    """One event by key (time and updated as UTC wall clock)."""
    return df.filter(F.col("usgs_id") == F.lit(usgs_id)).select(
        "id", "usgs_id", "mag", "place", "time", "updated", "magType", "tsunami", "alert",
        "status", "sig", "depth", "longitude", "latitude")


# --- L1, L2 -----------------------------------------------------------------------

def sort_mode(name: str | None, radius: bool = False) -> str:
    """Unknown modes fall back to 'recent' in lists and 'distance' in radius
    searches; 'distance' means 'recent' in a list."""
    if name not in SORT_MODES:
        return "distance" if radius else "recent"
    if name == "distance" and not radius:
        return "recent"
    return name


def sort_columns(mode: str) -> list[Column]:
    """Sort keys with the reference's null placement (DESC puts nulls first,
    ASC last); ``usgs_id`` last makes the order total."""
    time_desc = F.col("time").desc_nulls_first()
    keys = {
        "recent": [time_desc, F.col("id").desc_nulls_first()],
        "mag_desc": [F.col("mag").desc_nulls_last(), time_desc],
        "mag_asc": [F.col("mag").asc_nulls_last(), time_desc],
        "distance": [F.col("distance_km").asc_nulls_last(), time_desc],
    }[mode]
    return keys + [F.col("usgs_id").asc()]


# --- Paging (L3, L4, W1) ------------------------------------------------------------

def _range_keys(mode: str) -> list[tuple[Column, Column]]:
    """Ranges of a sort mode, coarse to fine: (key, its order).  Each follows the order of ``sort_columns``."""
    def keyed(name: str, key: Column, order: Column) -> tuple[Column, Column]:
        return key.alias(name), order

    day = keyed("_day", F.to_date("time"), F.col("_day").desc_nulls_first())
    second = keyed("_second", F.date_trunc("second", F.col("time")), F.col("_second").desc_nulls_first())
    first = {"mag_desc": [keyed("_mag", F.col("mag"), F.col("_mag").desc_nulls_last())],
             "mag_asc": [keyed("_mag", F.col("mag"), F.col("_mag").asc_nulls_last())],
             "distance": [keyed("_km", F.floor("distance_km"), F.col("_km").asc_nulls_last())], "recent": []}[mode]
    return [*first, day, second]


def narrowed(df: DataFrame, mode: str, offset: int, limit: int) -> tuple[DataFrame, int]:
    """The ranges of ``df`` that hold rows offset+1 .. offset+limit, and how many of their rows come before these.

    Rows are counted by range of the sort key, a partial count in every task:
    days, magnitudes, then seconds, as long as more than TOPK_ROW_LIMIT rows
    would have to be sorted.  No row is sorted or moved for it.
    """
    spark, skip, keys = df.sparkSession, offset, []
    for key in _range_keys(mode):
        if skip + limit <= TOPK_ROW_LIMIT:
            break
        keys.append(key)
        counts = df.groupBy(*[k for k, _ in keys]).agg(F.count(F.lit(1)).alias("_n"))
        before, chosen = 0, []
        for r in counts.orderBy(*[o for _, o in keys]).toLocalIterator():
            if before + r["_n"] > skip and before < skip + limit:
                chosen.append((before, tuple(r)[:-1]))
            before += r["_n"]
            if before >= skip + limit:
                break
        if not chosen:
            return df.limit(0), 0
        skip -= chosen[0][0]
        # At most one range for each row of the page, and one more.
        ranges = spark.createDataFrame([c for _, c in chosen], counts.drop("_n").schema)
        names = ranges.columns
        held = df.select("*", *[k for k, _ in keys]).alias("a").join(
            F.broadcast(ranges.alias("b")), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names], "left_semi").drop(*names)
        if names[-1] == "_day" and len(names) == 1 and all(c[0] is not None for _, c in chosen):  # a filter that reaches the scan
            low, high = min(c[0] for _, c in chosen), max(c[0] for _, c in chosen)
            held = held.filter(F.col("time").between(ts_literal(f"{low} 00:00:00"), ts_literal(f"{high} 23:59:59.999999")))
        df = held
    return df, skip


def page_rows(df: DataFrame, order: list[Column], offset: int, limit: int, mode: str | None = None) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` of ``df`` in ``order``.

    Shallow pages are one top-k (TakeOrderedAndProject).  Deep pages would make
    that top-k hold offset+limit rows in one task.  Where ``mode`` names the
    order, counts by range find the few ranges that hold the page and only their
    rows are sorted; more rows than that with one second's sort key take exact
    positions from a range-partitioned sort (no single-partition window).
    """
    if mode and offset + limit > TOPK_ROW_LIMIT:
        df, offset = narrowed(df, mode, offset, limit)
    if offset + limit <= TOPK_ROW_LIMIT:
        return df.orderBy(*order).offset(offset).limit(limit)
    from .upsert import assign_ids

    pos = assign_ids(df, order, start=0, out="_pos")
    return pos.filter((F.col("_pos") > offset) & (F.col("_pos") <= offset + limit)).orderBy("_pos").drop("_pos")


def with_total(page: DataFrame, matches: DataFrame) -> DataFrame:
    """The match count beside each page row (an empty page carries none).

    The count is one row of partial counts, broadcast to the page when the plan
    runs; nothing is run while the query is built."""
    total = matches.agg(F.count(F.lit(1)).cast("int").alias("total_count"))
    return page.join(F.broadcast(total), how="cross")


def list_columns(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    cols = [c if c not in ("mag", "depth", "longitude", "latitude") else F.col(c).cast("double").alias(c)
            for c in LIST_COLUMNS]
    return df.select(*cols, *(extra or []))


def filtered_events(df: DataFrame, min_mag=-2.0, max_mag=10.0, days_back=7, all_time=False, as_of=None) -> DataFrame:
    return since(mag_between(df, min_mag, max_mag), as_of, days_back, all_time)


def list_events(df: DataFrame, min_mag: float = -2, max_mag: float = 10, limit: int = 100, offset: int = 0,
                days_back: int = 7, all_time: bool = False, sort: str = "recent", as_of=None) -> DataFrame:
    """L3: one page of the filtered list with ``total_count`` on each row."""
    check_args(min_mag, max_mag, limit, offset, days_back)
    f = filtered_events(df, min_mag, max_mag, days_back, all_time, as_of)
    mode = sort_mode(sort)
    page = page_rows(f, sort_columns(mode), offset, limit, mode)
    return with_total(list_columns(page), f)


def event_page(df: DataFrame, page_no: int, size: int = PAGE_SIZE, sort: str = "recent", min_mag: float = -2,
               max_mag: float = 10, as_of=None) -> DataFrame:
    """L4: page walk over everything loaded: pages = ceil(max(total,1)/size), page
    clamped into 1..pages; adds ``page`` and ``pages`` columns.

    Nothing runs while a shallow page is built: the count is one row of the same
    plan, and the page is cut by number from the rows up to it.  A deep page
    counts first, since the clamp decides what is read."""
    f = filtered_events(df, min_mag, max_mag, all_time=True, as_of=as_of)
    mode = sort_mode(sort)
    order, page_no = sort_columns(mode), max(int(page_no), 1)
    matches = f.agg(F.count(F.lit(1)).cast("int").alias("total_count"))
    last = F.greatest(F.lit(1), F.ceil(F.col("total_count") / F.lit(size))).cast("int")
    if page_no * size <= TOPK_ROW_LIMIT:
        upto = f.orderBy(*order).limit(page_no * size).withColumn("_pos", F.row_number().over(Window.orderBy(*order)))
        counted = matches.select("total_count", F.least(F.lit(page_no), last).alias("page"), last.alias("pages"))
        rows = upto.join(F.broadcast(counted), how="cross").filter(F.ceil(F.col("_pos") / F.lit(size)) == F.col("page"))
        return list_columns(rows.orderBy("_pos"), ["total_count", "page", "pages"])
    total, pages = matches.select("total_count", last).first()
    page_no = min(page_no, pages)
    page = page_rows(f, order, (page_no - 1) * size, size, mode)
    return list_columns(page).withColumn("total_count", F.lit(total).cast("int")).withColumn(
        "page", F.lit(page_no)).withColumn("pages", F.lit(pages))


def strongest(df: DataFrame, n: int = 5) -> DataFrame:
    """The n strongest events, magnitude then time descending."""
    order = [F.col("mag").desc_nulls_first(), F.col("time").desc_nulls_first(), F.col("usgs_id").asc()]
    return df.orderBy(*order).limit(n).select(
        "usgs_id", S.round_to("mag", 2).alias("mag"), "place", "time",
        S.round_to("depth", 2).alias("depth"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("latitude").cast("double").alias("latitude"))
