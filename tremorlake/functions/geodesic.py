"""Geodesic distance on the WGS84 spheroid (G1) and its cheap guards.

The sphere (haversine) is a native expression.  The spheroid distance is
Vincenty's inverse method iterated to convergence over numpy arrays in one
Arrow-batched pandas UDF: a fixed chain of native projections would be inlined
by predicate pushdown into one tree that grows exponentially with the steps.
"""

from __future__ import annotations

import math
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: WGS84 and the mean-radius sphere ------------------------
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
MEAN_RADIUS_M = (2 * WGS84_A + WGS84_B) / 3          # 6371008.77 m
# Largest relative gap seen between the mean sphere and the spheroid (0.56 %),
# widened: outside this ring the sphere decides a radius test on its own.
SPHERE_MARGIN = 0.0075
# A degree of latitude is at least this long anywhere on the spheroid (metres).
MIN_DEGREE_M = 110_574.0
# Radians from the antipode within which the plain iteration is not trusted (it fails within about pi * f).
ANTIPODAL_ARC = 0.03


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance on the mean-radius sphere, metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp = p2 - p1
    dl = F.radians(lon2 - lon1)
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * MEAN_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def _lambda_parts(lam, s1, c1, s2, c2):
    import numpy as np

    sl, cl = np.sin(lam), np.cos(lam)
    ss = np.sqrt((c2 * sl) ** 2 + (c1 * s2 - s1 * c2 * cl) ** 2)
    cs = s1 * s2 + c1 * c2 * cl
    sig = np.arctan2(ss, cs)
    sa = np.where(ss == 0, 0.0, c1 * c2 * sl / np.where(ss == 0, 1.0, ss))
    csa = 1 - sa * sa
    c2m = np.where(csa == 0, 0.0, cs - 2 * s1 * s2 / np.where(csa == 0, 1.0, csa))
    return ss, cs, sig, sa, csa, c2m


def _lambda_step(lam, L, s1, c1, s2, c2):
    """One step of Vincenty's fixed-point iteration on the auxiliary longitude."""
    f = WGS84_F
    ss, cs, sig, sa, csa, c2m = _lambda_parts(lam, s1, c1, s2, c2)
    C = f / 16 * csa * (4 + f * (4 - 3 * csa))
    return L + (1 - C) * f * sa * (sig + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m)))


def _arc(csa, ss, cs, sig, c2m):
    """Length in metres of the arc ``sig`` of the auxiliary sphere (Vincenty's series)."""
    a, b = WGS84_A, WGS84_B
    usq = csa * (a * a - b * b) / (b * b)
    A = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    B = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    dsig = B * ss * (c2m + B / 4 * (cs * (-1 + 2 * c2m * c2m) - B / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))
    return b * A * (sig - dsig)


def _by_azimuth(azimuth, s1, c1, s2, c2):
    """(longitude difference, length) of the geodesic that leaves latitude 1 with
    ``azimuth`` and first meets latitude 2 going north.  Latitudes are reduced,
    with latitude 1 southern and the farther one from the equator."""
    import numpy as np

    f = WGS84_F
    sa1, ca1 = np.sin(azimuth), np.cos(azimuth)
    sa = sa1 * c1
    csa = 1 - sa * sa
    ca2 = np.sqrt(np.maximum((ca1 * c1) ** 2 + (c2 - c1) * (c2 + c1), 0.0)) / c2
    sig1, sig2 = np.arctan2(s1, ca1 * c1), np.arctan2(s2, ca2 * c2)
    om1, om2 = np.arctan2(sa * s1, ca1 * c1), np.arctan2(sa * s2, ca2 * c2)
    sig = sig2 - sig1
    ss, cs, c2m = np.sin(sig), np.cos(sig), np.cos(sig1 + sig2)
    C = f / 16 * csa * (4 + f * (4 - 3 * csa))
    lon = om2 - om1 - (1 - C) * f * sa * (sig + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m)))
    return lon, _arc(csa, ss, cs, sig, c2m)


def _near_antipodal_m(L, u1, u2):
    """Distance of pairs for which the iteration on the longitude may fail.

    Signs and ends are turned so that point 1 lies south and farther from the
    equator; the longitude difference then grows with the start azimuth, which is
    found by bisection over (0, pi).  Raises if a pair is not solved.
    """
    import numpy as np

    L = np.abs((L + np.pi) % (2 * np.pi) - np.pi)
    swap = np.abs(u2) > np.abs(u1)
    u1, u2 = np.where(swap, u2, u1), np.where(swap, u1, u2)
    turn = np.where(u1 > 0, -1.0, 1.0)
    # A point on the equator counts as just south of it.
    u1, u2 = np.minimum(u1 * turn, -1e-15), u2 * turn
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lo, hi = np.zeros_like(L), np.full_like(L, np.pi)
    for _ in range(120):
        mid = (lo + hi) / 2
        short = _by_azimuth(mid, s1, c1, s2, c2)[0] < L
        lo, hi = np.where(short, mid, lo), np.where(short, hi, mid)
    low, high = _by_azimuth(lo, s1, c1, s2, c2), _by_azimuth(hi, s1, c1, s2, c2)
    best = np.where(np.abs(low[0] - L) <= np.abs(high[0] - L), 0, 1)
    lon, dist = np.where(best == 0, low[0], high[0]), np.where(best == 0, low[1], high[1])
    if np.any(np.abs(lon - L) > 1e-7):
        raise ArithmeticError("a near-antipodal distance was not solved")
    return dist


def vincenty_m(lon1, lat1, lon2, lat2, max_steps: int = 60, tol: float = 1e-12):
    """Vincenty's inverse method on numpy arrays (degrees in, metres out).

    Pairs within ANTIPODAL_ARC of the antipode, and any that the fixed-point
    iteration does not settle, are solved by their start azimuth instead.
    NaN in -> NaN out.
    """
    import numpy as np

    f = WGS84_F
    lon1, lat1, lon2, lat2 = np.broadcast_arrays(*(np.asarray(x, dtype="float64") for x in (lon1, lat1, lon2, lat2)))
    L = np.radians(lon2 - lon1)
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = L.copy()
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(max_steps):
            prev, lam = lam, _lambda_step(lam, L, s1, c1, s2, c2)
            if not np.any(np.abs(lam - prev) > tol):
                break
        ss, cs, sig, sa, csa, c2m = _lambda_parts(lam, s1, c1, s2, c2)
        out = np.asarray(np.where(ss == 0, 0.0, _arc(csa, ss, cs, sig, c2m)))
        far = (np.abs(lam - prev) > tol) | (s1 * s2 + c1 * c2 * np.cos(L) < -np.cos(ANTIPODAL_ARC))
        if far.any():
            out[far] = _near_antipodal_m(L[far], u1[far], u2[far])
    return out


def _geodesic_udf():
    @F.pandas_udf("double")
    def geodesic_m(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
        # The Arrow conversion of a pandas result turns NaN (no distance) into null.
        return pd.Series(vincenty_m(lon1.to_numpy("float64", na_value=float("nan")),
                                    lat1.to_numpy("float64", na_value=float("nan")),
                                    lon2.to_numpy("float64", na_value=float("nan")),
                                    lat2.to_numpy("float64", na_value=float("nan"))))

    # Marked non-deterministic on purpose: otherwise Catalyst pushes a filter on
    # the distance below the projection that computes it and the UDF runs twice
    # (once for the filter, once for the output).  Filters below it still apply.
    return geodesic_m.asNondeterministic()


_UDF = None


def geodesic_m(lon1, lat1, lon2, lat2) -> Column:
    """Spheroid distance in metres as a Column (Arrow-batched, numpy-vectorised).

    The iteration count depends on the data (Vincenty stops when converged), so
    this is the one distance that is not a fixed native expression; callers
    apply it only to rows that passed the decimal bounding box.  Null input ->
    null output.
    """
    global _UDF
    if _UDF is None:
        _UDF = _geodesic_udf()
    return _UDF(_col(lon1), _col(lat1), _col(lon2), _col(lat2))


def _col(c) -> Column:
    if isinstance(c, Column):
        return c.cast("double")
    if isinstance(c, str):
        return F.col(c).cast("double")
    return F.lit(float(c))


def lat_span_deg(radius_m: float) -> float:
    """Latitude half-span (degrees) that surely contains a radius around any centre."""
    return radius_m / MIN_DEGREE_M * 1.0001 + 1e-9


def bounding_box(lat: float, lon: float, radius_m: float) -> list[tuple[float, float, float, float]]:
    """Boxes (lat_lo, lat_hi, lon_lo, lon_hi) that together contain every point
    within ``radius_m`` of (lat, lon).  Longitude spans are widened by
    asin(sin(r)/cos(lat)) on the sphere plus a margin, split at the date line,
    and dropped (whole circle) when a pole is inside."""
    dlat = lat_span_deg(radius_m)
    lat_lo, lat_hi = lat - dlat, lat + dlat
    if lat_lo <= -90 or lat_hi >= 90:
        return [(max(lat_lo, -90.0), min(lat_hi, 90.0), -180.0, 180.0)]
    ang = radius_m * (1 + SPHERE_MARGIN) / MEAN_RADIUS_M
    edge_lat = max(abs(lat_lo), abs(lat_hi))
    ratio = math.sin(ang) / max(math.cos(math.radians(edge_lat)), 1e-12)
    if ratio >= 1:
        return [(lat_lo, lat_hi, -180.0, 180.0)]
    dlon = math.degrees(math.asin(ratio)) * 1.0001 + 1e-9
    lo, hi = lon - dlon, lon + dlon
    if lo < -180:
        return [(lat_lo, lat_hi, lo + 360, 180.0), (lat_lo, lat_hi, -180.0, hi)]
    if hi > 180:
        return [(lat_lo, lat_hi, lo, 180.0), (lat_lo, lat_hi, -180.0, hi - 360)]
    return [(lat_lo, lat_hi, lo, hi)]


def _dec(x: float, up: bool) -> Decimal:
    q = Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_CEILING if up else ROUND_FLOOR)
    return q


def box_filter(lat_col: Column, lon_col: Column, boxes) -> Column:
    """Range predicate over decimal(10,6) coordinates; decimal literals keep the
    column uncast so parquet row-group statistics can skip data."""
    cond = None
    for lat_lo, lat_hi, lon_lo, lon_hi in boxes:
        c = (lat_col >= F.lit(_dec(lat_lo, False))) & (lat_col <= F.lit(_dec(lat_hi, True)))
        if not (lon_lo <= -180 and lon_hi >= 180):
            c = c & (lon_col >= F.lit(_dec(lon_lo, False))) & (lon_col <= F.lit(_dec(lon_hi, True)))
        cond = c if cond is None else (cond | c)
    return cond
