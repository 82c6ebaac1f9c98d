"""Geodesic distance against published WGS84 values and the radius edge cases."""

import datetime as dt
from decimal import Decimal

import pytest

from tremorlake.functions import geodesic as G
from tremorlake.operators import radius as RAD


def test_published_constants():
    d = G.vincenty_m([0.0, 0.0, 0.0], [0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [0.0, 1.0, 90.0])
    assert abs(d[0] - 111319.491) < 0.01     # 1 degree along the equator
    assert abs(d[1] - 110574.389) < 0.01     # 1 degree of meridian from the equator
    assert abs(d[2] - 10001965.729) < 0.01   # quarter meridian


def test_sphere_close_to_spheroid():
    import numpy as np

    rng = np.random.default_rng(1)
    lon1, lon2 = rng.uniform(-180, 180, 2000), rng.uniform(-180, 180, 2000)
    lat1, lat2 = rng.uniform(-89, 89, 2000), rng.uniform(-89, 89, 2000)
    v = G.vincenty_m(lon1, lat1, lon2, lat2)
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    s = 2 * G.MEAN_RADIUS_M * np.arcsin(np.sqrt(h))
    ok = v > 1000
    assert np.max(np.abs(s[ok] - v[ok]) / v[ok]) < G.SPHERE_MARGIN


def pts(spark, rows):
    return spark.createDataFrame(
        [(i + 1, f"e{i}", Decimal(str(m)) if m is not None else None, Decimal(f"{lon:.6f}"), Decimal(f"{lat:.6f}"), t,
          "p", "ml", 0, "", "reviewed", 1, Decimal("10.00"))
         for i, (lon, lat, m, t) in enumerate(rows)],
        "id long, usgs_id string, mag decimal(6,2), longitude decimal(10,6), latitude decimal(10,6), "
        "time timestamp_ntz, place string, magType string, tsunami int, alert string, status string, sig int, "
        "depth decimal(10,2)")


T0 = dt.datetime(2024, 1, 20)


@pytest.mark.parametrize("centre,point", [((0.0, 179.9), (-179.9, 0.0)), ((89.9, 0.0), (180.0, 89.9))])
def test_radius_across_date_line_and_pole(spark, centre, point):
    lat, lon = centre
    df = pts(spark, [(point[0], point[1], 1.0, T0)])
    assert RAD.within_km(df, lat, lon, 30).count() == 1
    assert RAD.within_km(df, lat, lon, 20).count() == 0


def test_radius_sort_by_rounded_distance(spark):
    # two points ~1.00 km away: the newer one comes first although it is farther
    older, newer = T0, T0 + dt.timedelta(hours=1)
    df = pts(spark, [(0.0, 1.001 / 110.574389, 1.0, older), (0.0, 1.004 / 110.574389, 1.0, newer)])
    page = RAD.radius_search(df, 0.0, 0.0, dist_km=5, all_time=True)
    rows = page.collect()
    assert [r.distance_km for r in rows] == [1.0, 1.0]
    assert rows[0].usgs_id == "e1"
    assert rows[0].total_count == 2


def test_near_antipodal_published_values():
    d = G.vincenty_m([0.0, 0.0, 0.0], [0.0, 0.0, 0.0], [180.0, 179.5, 179.7], [0.0, 0.5, 0.5])
    assert [round(float(x), 3) for x in d] == pytest.approx([20003931.459, 19936288.579, 19944127.421], abs=2e-3)


def destination(lon1, lat1, azimuth, dist_m):
    """Vincenty's direct problem (always converges): the point reached from
    (lon1, lat1) along ``azimuth`` (radians) after ``dist_m`` metres."""
    import numpy as np

    a, b, f = G.WGS84_A, G.WGS84_B, G.WGS84_F
    tu1 = (1 - f) * np.tan(np.radians(lat1))
    cu1 = 1 / np.sqrt(1 + tu1 * tu1)
    su1 = tu1 * cu1
    sig1 = np.arctan2(tu1, np.cos(azimuth))
    sa = cu1 * np.sin(azimuth)
    csa = 1 - sa * sa
    usq = csa * (a * a - b * b) / (b * b)
    A = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    B = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    sig = dist_m / (b * A)
    for _ in range(200):
        c2m = np.cos(2 * sig1 + sig)
        sn, cn = np.sin(sig), np.cos(sig)
        ds = B * sn * (c2m + B / 4 * (cn * (-1 + 2 * c2m * c2m) - B / 6 * c2m * (-3 + 4 * sn * sn) * (-3 + 4 * c2m * c2m)))
        nxt = dist_m / (b * A) + ds
        done = not np.any(np.abs(nxt - sig) > 1e-13)
        sig = nxt
        if done:
            break
    c2m = np.cos(2 * sig1 + sig)
    sn, cn = np.sin(sig), np.cos(sig)
    tmp = su1 * sn - cu1 * cn * np.cos(azimuth)
    lat2 = np.arctan2(su1 * cn + cu1 * sn * np.cos(azimuth), (1 - f) * np.sqrt(sa * sa + tmp * tmp))
    lam = np.arctan2(sn * np.sin(azimuth), cu1 * cn - su1 * sn * np.cos(azimuth))
    C = f / 16 * csa * (4 + f * (4 - 3 * csa))
    dl = lam - (1 - C) * f * sa * (sig + C * sn * (c2m + C * cn * (-1 + 2 * c2m * c2m)))
    return np.asarray(lon1) + np.degrees(dl), np.degrees(lat2)


def test_near_antipodal_points_by_the_direct_problem():
    """The far end of a known geodesic lies at most its length away, and no pair is longer than half a meridian."""
    import numpy as np

    rng = np.random.default_rng(3)
    n = 4000
    lat1, lon1, az = rng.uniform(-80, 80, n), rng.uniform(-180, 180, n), rng.uniform(0, 2 * np.pi, n)
    # Shortest up to the conjugate point, which lies beyond 0.992 of half a meridian
    # plus what the flattening takes away: compare exactly below that.
    s = rng.uniform(0.9, 0.99, n) * 19_903_593
    lon2, lat2 = destination(lon1, lat1, az, s)
    assert np.max(np.abs(G.vincenty_m(lon1, lat1, lon2, lat2) - s)) < 2e-3
    s = rng.uniform(0.99, 1.0, n) * 20_003_931
    lon2, lat2 = destination(lon1, lat1, az, s)
    d = G.vincenty_m(lon1, lat1, lon2, lat2)
    assert np.all(d <= s + 2e-3) and np.all(d <= 20_003_931.46)
    assert np.max(np.abs(G.vincenty_m(lon2, lat2, lon1, lat1) - d)) < 2e-3


def test_antipodal_sweep_is_solved_and_continuous():
    import numpy as np

    rng = np.random.default_rng(4)
    n = 20000
    lat1, lon1 = rng.uniform(-90, 90, n), rng.uniform(-180, 180, n)
    lat2, lon2 = np.clip(-lat1 + rng.normal(0, 0.4, n), -90, 90), lon1 + 180 + rng.normal(0, 0.8, n)
    d = G.vincenty_m(lon1, lat1, lon2, lat2)
    nudged = G.vincenty_m(lon1, lat1, lon2 + 1e-7, lat2)
    assert np.all(np.isfinite(d)) and np.max(np.abs(nudged - d)) < 0.05
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    sphere = 2 * G.MEAN_RADIUS_M * np.arcsin(np.sqrt(np.minimum(h, 1.0)))
    assert np.max(np.abs(sphere - d) / d) < G.SPHERE_MARGIN
