import datetime as dt
import math

import numpy as np

from blotter.functions import geo, timefn


def test_timestamps(spark):
    df = spark.createDataFrame([(2020, 2, 29, 10, 5), (2020, 2, 31, 10, 0), (2021, 13, 1, 0, 0), (2021, 1, 1, 24, 0),
                                (None, 1, 1, 0, 0)], "y int, m int, d int, h int, mi int")
    got = [r.t for r in df.select(timefn.incident_timestamp("y", "m", "d", "h", "mi").alias("t")).collect()]
    assert got == [dt.datetime(2020, 2, 29, 10, 5), None, None, None, None]


def test_us_date(spark):
    df = spark.createDataFrame([("07/01/2003",), ("13/01/2003",), ("x",)], "s string")
    got = [r.d for r in df.select(timefn.parse_us_date("s").alias("d")).collect()]
    assert got == [dt.date(2003, 7, 1), None, None]


def _forward(lat, lon, zone=10):
    """Forward transverse Mercator (Krueger series), numpy, for round trips."""
    n = geo._N
    a1 = n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16
    a2 = 13 * n ** 2 / 48 - 3 * n ** 3 / 5
    a3 = 61 * n ** 3 / 240
    phi, lam = np.radians(lat), np.radians(lon) - math.radians(zone * 6 - 183)
    c = 2 * math.sqrt(n) / (1 + n)
    t = np.sinh(np.arctanh(np.sin(phi)) - c * np.arctanh(c * np.sin(phi)))
    xi = np.arctan(t / np.cos(lam))
    eta = np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    k = geo.UTM_K0 * geo._A
    e = 500000 + k * (eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate((a1, a2, a3), 1)))
    nn = k * (xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate((a1, a2, a3), 1)))
    return e, nn


def test_utm_round_trip(spark):
    pts = [(49.28, -123.12), (49.20922, -123.13615), (49.31252, -123.04035), (48.0, -125.5)]
    rows = []
    for lat, lon in pts:
        e, n = _forward(lat, lon)
        rows.append((lat, lon, float(e), float(n)))
    df = spark.createDataFrame(rows, "lat double, lon double, e double, n double")
    la, lo = geo.utm_to_latlon("e", "n")
    for r in df.select("lat", "lon", la.alias("la"), lo.alias("lo")).collect():
        assert abs(r.la - r.lat) < 1e-8 and abs(r.lo - r.lon) < 1e-8


def test_utm_known_point_and_range(spark):
    # Central meridian of zone 10 at the false easting: longitude exactly -123.
    df = spark.createDataFrame([(500000.0, 5456789.0), (0.0, 5456789.0), (500000.0, -1.0), (None, 1.0)],
                               "e double, n double")
    la, lo = geo.utm_to_latlon("e", "n")
    got = df.select(la.alias("la"), lo.alias("lo")).collect()
    assert abs(got[0].lo + 123.0) < 1e-12 and 49.0 < got[0].la < 49.5
    assert all(r.la is None and r.lo is None for r in got[1:])


def test_fractional_hour(spark):
    df = spark.createDataFrame([(10, 30), (0, 0), (23, 59)], "h int, m int")
    got = [r.t for r in df.select(timefn.fractional_hour("h", "m").alias("t")).collect()]
    assert got == [10.5, 0.0, 23 + 59 / 60]


def test_timestamps_random_against_python(spark):
    rng = np.random.default_rng(5)
    rows = [tuple(int(v) for v in (rng.integers(1999, 2025), rng.integers(0, 14), rng.integers(0, 33),
                                    rng.integers(0, 26), rng.integers(0, 62))) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, m int, d int, h int, mi int")
    got = df.select("y", "m", "d", "h", "mi", timefn.incident_timestamp("y", "m", "d", "h", "mi").alias("t")).collect()
    for r in got:
        try:
            want = dt.datetime(r.y, r.m, r.d, r.h, r.mi)
        except ValueError:
            want = None
        assert r.t == want, tuple(r)


def test_utm_random_round_trip(spark):
    rng = np.random.default_rng(9)
    lats = rng.uniform(48.3, 50.5, 200)
    lons = rng.uniform(-125.9, -120.1, 200)
    rows = []
    for lat, lon in zip(lats, lons):
        e, n = _forward(lat, lon)
        rows.append((float(lat), float(lon), float(e), float(n)))
    df = spark.createDataFrame(rows, "lat double, lon double, e double, n double")
    la, lo = geo.utm_to_latlon("e", "n")
    worst = max(max(abs(r.la - r.lat), abs(r.lo - r.lon)) for r in df.select("lat", "lon", la.alias("la"),
                                                                               lo.alias("lo")).collect())
    assert worst < 1e-8
