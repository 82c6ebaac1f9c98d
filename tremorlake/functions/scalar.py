"""Column -> Column functions: coercion, classes, region, labels, rounding.

Everything here is a native Catalyst expression (no Python UDF), so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: labels and thresholds results depend on -----------------
MAG_CLASSES = ["Micro", "Leve", "Fuerte", "Severo"]          # < 2, < 4, < 6, else
MAG_EDGES = [2, 4, 6]
DEPTH_CLASSES = ["Superficial", "Intermedia", "Profunda"]     # < 70, < 300, else
DEPTH_EDGES = [70, 300]
NO_PLACE = "Sin ubicación"
NO_VALUE = "Sin dato"
NO_ALERT = "Sin alerta"
ALERT_LABELS = {"green": "Verde", "yellow": "Amarilla", "orange": "Naranja", "red": "Roja"}
STATUS_LABELS = {"reviewed": "Revisado", "automatic": "Automático", "deleted": "Eliminado"}
MAG_COLOURS = {"low": "#2f855a", "mid": "#c98900", "high": "#d65a31", "severe": "#b42318"}
NULL_WORDS = ["nan", "none", "null"]
INSIGHT_TEXT = {
    "none": "Sin datos suficientes",
    "severe": "Hay eventos severos en el análisis; conviene revisar detalle y ubicación.",
    "strong": "Predominan eventos no severos, pero existen sismos fuertes relevantes.",
    "low": "La actividad seleccionada se concentra en magnitudes micro o leves.",
}
DEFAULT_AREA_RADIUS_KM = 700
AREA_RADIUS_MIN_KM, AREA_RADIUS_MAX_KM, AREA_RADIUS_FACTOR = 250, 2500, 1.35


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- Coercion (P2, P3, P5, P23) ---------------------------------------------

def epoch_ms(c: Column | str) -> Column:
    """Epoch milliseconds -> UTC wall-clock timestamp (timestamp_ntz; session TZ is UTC)."""
    return F.timestamp_millis(_c(c).cast("long")).cast("timestamp_ntz")


def to_number(c: Column | str, dtype: str = "double") -> Column:
    """Non-numeric text, NaN and +-inf become null; never 0."""
    d = _c(c).try_cast("double")  # text is parsed, numbers are converted directly
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    out = F.when(ok, d)
    return out if dtype == "double" else out.try_cast(dtype)


def finite(c: Column | str, fill: float | None = None) -> Column:
    """Coerce to a finite double; optional fill for what could not be read."""
    v = to_number(c)
    return v if fill is None else F.coalesce(v, F.lit(float(fill)))


def to_time(c: Column | str) -> Column:
    """P5: timestamps pass through; text is parsed; unreadable -> null."""
    col = _c(c)
    return F.coalesce(col.try_cast("timestamp_ntz"), F.try_to_timestamp(col.cast("string")).cast("timestamp_ntz"))


# --- Classes (P13-P16) ---------------------------------------------------------

def mag_class(c: Column | str, null_as_zero: bool = False, closed: str = "left") -> Column:
    """Magnitude class.

    closed='left'  : <2 Micro, <4 Leve, <6 Fuerte, else Severo (null falls to Severo
                     only if it reaches the expression; filters drop it first).
    null_as_zero   : display form, null counts as 0 -> Micro.
    closed='right' : binned form [-10,2], (2,4], (4,6], (6,10]; outside -> 'nan'.
    """
    m = _c(c)
    if null_as_zero:
        m = F.coalesce(m, F.lit(0))
    if closed == "right":
        return (
            F.when((m >= -10) & (m <= 2), MAG_CLASSES[0])
            .when((m > 2) & (m <= 4), MAG_CLASSES[1])
            .when((m > 4) & (m <= 6), MAG_CLASSES[2])
            .when((m > 6) & (m <= 10), MAG_CLASSES[3])
            .otherwise("nan")
        )
    return (
        F.when(m < MAG_EDGES[0], MAG_CLASSES[0])
        .when(m < MAG_EDGES[1], MAG_CLASSES[1])
        .when(m < MAG_EDGES[2], MAG_CLASSES[2])
        .otherwise(MAG_CLASSES[3])
    )


def mag_colour(c: Column | str) -> Column:
    m = F.coalesce(_c(c), F.lit(0))
    return (
        F.when(m < 2, MAG_COLOURS["low"]).when(m < 4, MAG_COLOURS["mid"])
        .when(m < 6, MAG_COLOURS["high"]).otherwise(MAG_COLOURS["severe"])
    )


def depth_class(c: Column | str) -> Column:
    """<70 Superficial, <300 Intermedia, else Profunda; a null depth is Profunda."""
    d = _c(c)
    return (
        F.when(d < DEPTH_EDGES[0], DEPTH_CLASSES[0])
        .when(d < DEPTH_EDGES[1], DEPTH_CLASSES[1])
        .otherwise(DEPTH_CLASSES[2])
    )


# --- Region (P17, P18) ----------------------------------------------------------

def region(c: Column | str, keep_tail: bool = False) -> Column:
    """Region of a place text.

    Default (API form): blank -> 'Sin ubicación'; with a comma -> text after the
    last comma (may be empty); else with ' of ' -> text after the last ' of ';
    else the place.  '.' matches newlines, as in the reference's regex dialect.

    keep_tail=True (dashboard form): the text is stripped first and an empty
    tail falls back to the whole stripped text.
    """
    p = _c(c)
    if keep_tail:
        text = F.regexp_replace(p, r"^\s+|\s+$", "")
        after_comma = F.regexp_replace(F.substring_index(text, ",", -1), r"^\s+|\s+$", "")
        after_of = F.regexp_replace(F.substring_index(text, " of ", -1), r"^\s+|\s+$", "")
        return (
            F.when(p.isNull() | (p == ""), NO_PLACE)
            .when(text.contains(","), F.when(after_comma == "", text).otherwise(after_comma))
            .when(text.contains(" of "), F.when(after_of == "", text).otherwise(after_of))
            .otherwise(text)
        )
    return (
        F.when(p.isNull() | (F.trim(p) == ""), NO_PLACE)
        .when(p.contains(","), F.trim(F.regexp_replace(p, r"(?s)^.*,\s*", "")))
        .when(F.position(F.lit(" of "), p) > 0, F.trim(F.regexp_replace(p, r"(?s)^.* of\s+", "")))
        .otherwise(p)
    )


# --- Time labels (P19, P20, P28) ----------------------------------------------------

PERIOD_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def period_start(c: Column | str, unit: str) -> Column:
    return F.date_trunc(unit, _c(c)).cast("timestamp_ntz")


def period_label(c: Column | str, unit: str) -> Column:
    return F.date_format(_c(c), PERIOD_FORMATS[unit])


def time_text(c: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm UTC' or '--'."""
    return F.coalesce(F.concat(F.date_format(to_time(c), "yyyy-MM-dd HH:mm"), F.lit(" UTC")), F.lit("--"))


# --- Exact rounding of averages (P21) -------------------------------------------------

def _floor_div(a: Column, b: Column) -> Column:
    """Exact floor(a / b) for non-negative decimal(38,0) a and positive b."""
    a = a.cast("decimal(38,0)")
    b = b.cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def round_half_away(units_sum: Column, n: Column, down_by: int) -> Column:
    """Round ``units_sum / (n * down_by)`` half away from zero to an integer."""
    s = units_sum.cast("decimal(38,0)")
    q = n.cast("decimal(38,0)") * F.lit(down_by)
    mag = _floor_div(F.abs(s) * 2 + q, q * 2)
    return F.when(n > 0, F.signum(s).cast("decimal(38,0)") * mag)


def avg_rounded(c: Column | str, in_scale: int = 2, out_scale: int = 2) -> Column:
    """Aggregate: average of a decimal(_, in_scale) column rounded half away from
    zero to ``out_scale`` places, as double.  Exact for any row count: decimals are
    summed as they are and scaled to integer units once, after the sum."""
    col = _c(c)
    units = (F.sum(col) * F.lit(10 ** in_scale)).cast("decimal(38,0)")
    r = round_half_away(units, F.count(col), 10 ** (in_scale - out_scale))
    return r.cast("double") / F.lit(float(10 ** out_scale))


def avg_of_sums(total: Column | str, many: Column | str, in_scale: int = 2, out_scale: int = 2) -> Column:
    """Aggregate: ``avg_rounded`` over rows that hold sums (decimal(_, in_scale)) and counts of groups; equally exact."""
    units = (F.sum(_c(total)) * F.lit(10 ** in_scale)).cast("decimal(38,0)")
    r = round_half_away(units, F.coalesce(F.sum(_c(many)), F.lit(0)), 10 ** (in_scale - out_scale))
    return r.cast("double") / F.lit(float(10 ** out_scale))


def round_float(c: Column | str, scale: int = 2) -> Column:
    """Float rounding as a data-frame library does it: scale, round half to
    even on the binary value, unscale (used for display tables)."""
    k = float(10 ** scale)
    return F.rint(_c(c).cast("double") * F.lit(k)) / F.lit(k)


def round_to(c: Column | str, scale: int = 2) -> Column:
    """Half-away-from-zero rounding of a decimal to ``scale`` places, as double."""
    return F.round(_c(c).cast("decimal(38,10)"), scale).cast("double")


# --- Text cleaning and labels (P24-P28) ----------------------------------------------

def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (not only blanks)."""
    return F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")


def clean_text(c: Column | str, fallback: str = NO_VALUE) -> Column:
    t = strip(c)
    bad = t.isNull() | (t == "") | F.lower(t).isin(NULL_WORDS)
    return F.when(bad, F.lit(fallback)).otherwise(t)


def _label_map(c: Column, mapping: dict[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[F.lower(c)], c)


def alert_label(c: Column | str) -> Column:
    return _label_map(clean_text(c, NO_ALERT), ALERT_LABELS)


def status_label(c: Column | str) -> Column:
    return _label_map(clean_text(c), STATUS_LABELS)


def number_text(c: Column | str) -> Column:
    """Thousands separators; no decimals for whole numbers, else 2; '--' otherwise."""
    v = to_number(c)
    whole = v == F.floor(v)
    return (
        F.when(v.isNull(), F.lit("--"))
        .when(whole, F.format_number(v, 0))
        .otherwise(F.format_number(v, 2))
    )


# --- Geography helpers (G6, G7) -----------------------------------------------------

def wrap_longitude(lon: Column | str) -> Column:
    """Longitude into [-180, 180): 280 -> -80, 180 -> -180."""
    return F.pmod(_c(lon) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def normalize_point(lat: Column | str, lon: Column | str) -> Column:
    """struct(lat, lon) with wrapped longitude; null when either is not finite or
    the latitude lies outside [-90, 90]."""
    la, lo = to_number(lat), to_number(lon)
    ok = la.isNotNull() & lo.isNotNull() & la.between(-90, 90)
    return F.when(ok, F.struct(la.alias("lat"), wrap_longitude(lo).alias("lon")))


def radius_from_area(area: Column | str) -> Column:
    """Search radius in km for an area in km2: clamp(int(1.35*sqrt(area/pi)), 250, 2500), 700 without area."""
    a = to_number(area)
    r = F.greatest(F.lit(float(AREA_RADIUS_MIN_KM)),
                   F.least(F.lit(float(AREA_RADIUS_MAX_KM)), F.sqrt(a / F.lit(math.pi)) * F.lit(AREA_RADIUS_FACTOR)))
    return F.when(a.isNull() | (a <= 0), F.lit(DEFAULT_AREA_RADIUS_KM)).otherwise(r.cast("int"))


def name_key(c: Column | str) -> Column:
    """Comparable place name: accents, case and repeated blanks do not matter.

    Uses an accent- and case-insensitive collation, so the column works as a
    group, join and window key while keeping the original text.
    """
    t = F.regexp_replace(F.trim(_c(c)), r"\s+", " ")
    return F.collate(t, "UNICODE_CI_AI")


def marker_size(mag: Column | str) -> Column:
    m = F.coalesce(_c(mag).cast("double"), F.lit(0.0))
    return F.greatest(F.lit(4.0), F.least(F.lit(6.0) + m * F.lit(2.2), F.lit(24.0)))


def wkt_point(lon: Column | str, lat: Column | str) -> Column:
    """WKT text of a point, for the edge of the system only."""
    return F.format_string("POINT (%s %s)", _c(lon).cast("string"), _c(lat).cast("string"))
